"""A quality classifier taught by overlapping heuristic labellers: fitted posteriors train a hashed linear scorer."""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold.llm.text_counts import COUNTS, text_counts
from pagefold.llm.weak_labels import with_posterior
from pagefold.session import stage_table

# Bound of the sample the scorer is fitted on, and its number of hashed weights; scoring has no bound.
SAMPLE = 6_000
WEIGHTS = 4_096
KEEP_FROM = 0.5
STEPS = 120


def labellers() -> dict[str, tuple[Column, Column]]:
    """(bad if, good if) over the counts of a text; they overlap on purpose, and abstain in between."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    letters = F.greatest(F.col("n_letters"), F.lit(1))
    per_word = F.col("n_symbols") / words
    enough = F.col("n_words") >= 20
    return {
        "symbols": (per_word > 0.25, per_word < 0.05),
        "symbol_density": (F.col("n_symbols") > 0.05 * chars, F.col("n_symbols") < 0.01 * chars),
        "other_characters": (F.col("n_other") > 0.2 * chars, F.col("n_other") < 0.12 * chars),
        "capitals": (F.col("n_upper") > 0.4 * letters, F.col("n_upper") < 0.2 * letters),
        "marks": (F.col("n_marks") > 0.2 * words, F.col("n_marks") < 0.05 * words),
        "windows": (F.col("n_repeat_words") > 0.25 * words, F.col("n_repeat_words") < 0.1 * words),
        "variety": (enough & (F.col("n_distinct") < 0.25 * words), enough & (F.col("n_distinct") > 0.45 * words)),
        "run": (F.col("longest_run") > 4, enough & (F.col("longest_run") < 3)),
        "length": (F.col("n_words") < 10, F.col("n_words") >= 25),
    }


def hashed(text: bytes) -> np.ndarray:
    """Places of a text's features: every word, its last two bytes, whether it repeats its neighbour."""
    words = text.split()
    mask, before = WEIGHTS - 1, b""
    places = [crc32(w) & mask for w in words]
    places += [crc32(w[-2:], 1) & mask for w in words]
    for w in words:
        places.append(crc32(b"=", 2) & mask if w == before else crc32(b"^", 3) & mask if w.isupper() else 0)
        before = w
    return np.array(places, dtype=np.int64)


def features(text: bytes) -> np.ndarray:
    """Feature counts per word, so that a text's length alone says nothing."""
    places = hashed(text)
    return np.bincount(places, minlength=WEIGHTS) * (3 / max(1, len(places)))


def score(text: bytes, weights: np.ndarray, bias: float) -> float:
    places = hashed(text)
    z = bias + (float(weights[places].mean()) * 3 if len(places) else 0.0)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _counts(docs: DataFrame) -> DataFrame:
    """``doc_id, content`` (hash of the text) and the counts of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [text_counts(t.as_buffer().to_pybytes()) for t in batch.column("text")]
            columns = list(zip(*made, strict=True)) if made else [[] for _ in COUNTS]
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], *[pa.array(c, pa.int64()) for c in columns]], names=[*kept, *COUNTS]
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("content"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    return rows.mapInArrow(run, ", ".join(["doc_id long, content long", *[f"{c} long" for c in COUNTS]]))


def fit(sample: DataFrame) -> tuple[np.ndarray, float]:
    """Weights and bias from rows ``text, quality`` (binary, posterior): logistic loss on soft labels.

    The sample is bounded by ``SAMPLE``, its features by ``WEIGHTS`` numbers a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, quality in zip(batch.column("text"), batch.column("quality"), strict=True):
                x = features(text.as_buffer().to_pybytes())
                at = np.nonzero(x)[0]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([at.astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([x[at].astype(np.float32)], pa.list_(pa.float32())),
                        pa.array([quality], pa.float64()),
                    ],
                    names=["at", "x", "y"],
                )

    rows = sample.mapInArrow(run, "at array<int>, x array<float>, y double").collect()
    rows.sort(key=lambda r: (r["y"], r["at"], r["x"]))
    x = np.zeros((len(rows), WEIGHTS), dtype=np.float32)
    for i, r in enumerate(rows):
        x[i, r["at"]] = r["x"]
    y = np.array([r["y"] for r in rows], dtype=np.float32)
    w, b = np.zeros(WEIGHTS, dtype=np.float32), 0.0
    back_w, back_b = w, b
    if len(rows):
        for step in range(1, STEPS + 1):  # accelerated gradient steps
            p = 1 / (1 + np.exp(-np.clip(x @ back_w + back_b, -30, 30)))
            slope, slope_b = x.T @ (p - y) / len(y) + 1e-5 * back_w, float((p - y).mean())
            next_w, next_b = back_w - 1.5 * slope, back_b - 0.7 * slope_b
            pace = step / (step + 3)
            back_w, back_b = next_w + pace * (next_w - w), next_b + pace * (next_b - b)
            w, b = next_w, next_b
    return np.round(w, 5), round(float(b), 5)


def classify(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, score, kept``.

    The labellers' accuracies are fitted on the votes of all documents; the scorer on a sample of
    the smallest hashes, with the posteriors as labels; then every whole text is scored. A text
    without words gets the scorer's bias and is not kept. Nulls count as empty; repeated rows stay;
    an empty table gives no rows; columns other than id and text are not read.
    """
    counts = stage_table(_counts(docs), "counts")
    judged = with_posterior(counts, labellers(), "weak_quality")
    chosen = (
        judged.where(F.col("n_words") > 0)
        .groupBy("content")
        .agg(F.max("weak_quality").alias("quality"))
        .orderBy(F.xxhash64("content"), "content")
        .limit(SAMPLE)
    )
    texts = docs.select(F.xxhash64("text").alias("content"), F.col("text").cast("binary").alias("text"))
    # The sample is bounded, so are its 16 bytes a row; of equal texts, one is as good as another.
    sample = texts.join(F.broadcast(chosen), "content").dropDuplicates(["content"]).select("text", "quality")
    weights, bias = fit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [score(t.as_buffer().to_pybytes(), weights, bias) for t in batch.column("text")]
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], pa.array(made, pa.float64())], names=[*kept, "score"]
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
        (F.coalesce("text", F.lit("")).rlike("[^\\x20\\x09-\\x0D]")).alias("some"),
    )
    scored = rows.mapInArrow(run, "doc_id long, some boolean, score double")
    return scored.select("doc_id", "score", (F.col("some") & (F.col("score") >= KEEP_FROM)).alias("kept"))
