"""Importance resampling towards a target: bucketed word runs, array-scored weights, a cut found by bisection."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagefold.llm.common import numbered, packed, unpacked
from pagefold.session import stage_table

BUCKETS = 10_000
LONGEST = 3
SEED = 42
PERCENT = 5
LEAST_WORDS = 20
# Ends that one counting job tries between the least and the greatest value left.
CUTS = 15
# Words hashed at a time, so that a long text takes bounded memory.
_BLOCK = 65_536
_LAST = -(2**63) + 1
# A-Z become a-z, other ASCII characters that are neither letters nor digits become blanks.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def features(text: bytes, longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[int, Iterator[np.ndarray]]:
    """The number of words of a UTF-8 text, and the buckets of all runs of 1 to ``longest`` words, block by block."""
    words = text.translate(_PLAIN).split()

    def found() -> Iterator[np.ndarray]:
        for at in range(0, len(words), _BLOCK):
            tail = [b" " + w for w in words[at : at + _BLOCK + longest - 1]]
            level = list(map(crc32, words[at : at + _BLOCK]))
            for n in range(1, longest + 1):
                yield np.array(level, dtype=np.uint32) % buckets
                # A checksum goes on where it ended, so a run adds one word to the run before.
                level = list(map(crc32, tail[n:], level))

    return len(words), found()


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket. Every task sends one row per bucket at most, the driver gets ``buckets`` sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text"):
                for block in features(text.as_buffer().to_pybytes(), longest, buckets)[1]:
                    held += np.bincount(block, minlength=buckets)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], names=["bucket", "n"])

    rows = texts.where("text IS NOT NULL").select(F.col("text").cast("binary").alias("text"))
    sums = rows.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(buckets, dtype=np.int64)
    for row in sums:
        counts[row["bucket"]] = row["n"]
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, a thousand times the log ratio of its smoothed shares in target and raw texts, rounded down."""
    n, whole, of = len(raw), int(raw.sum()), int(target.sum())
    ratio = [(t + 1) * (whole + n) / ((s + 1) * (of + n)) for s, t in zip(raw.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def _noise(seed: int, doc_id: int | None) -> int:
    """A Gumbel draw in thousandths that depends on the seed and the id alone; no id counts as an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(
    docs: DataFrame, target: DataFrame, whole: bool = False, longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row, stored; with its ``row`` if ``whole``.

    ``number`` tells the stored rows apart, repeated ones as well.
    """
    rise = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple[int, int, int, int]] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                n_words, blocks = features(text.as_buffer().to_pybytes() if text.is_valid else b"", longest, buckets)
                n_features = weight = 0
                for block in blocks:
                    n_features += len(block)
                    weight += int(rise[block].sum())
                made.append((n_words, n_features, weight, weight + _noise(seed, doc_id)))
            columns = [pa.array(c, pa.int64()) for c in zip(*made, strict=True)] if made else [pa.array([], pa.int64())] * 4
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], *columns], names=[*kept, "n_words", "n_features", "weight", "score"]
            )

    rows = packed(docs).select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        F.col("row.text").cast("binary").alias("text"),
        *(["row"] if whole else []),
    )
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    made = rows.mapInArrow(run, f"{kept}, n_words long, n_features long, weight long, score long")
    return stage_table(made.withColumn("number", F.monotonically_increasing_id()), "scored")


def greatest_cut(rows: DataFrame, value: str, wanted: int) -> int:
    """The greatest integer that at least ``wanted`` (one or more) of the rows reach.

    Every job counts exactly how many rows reach each of ``CUTS`` values between the ends left, so
    the ends close in by four bits a job; only those counts come to the driver.
    """
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while low < high:
        step = max(1, (high - low) // (CUTS + 1))
        marks = list(range(low + step, high + 1, step))[:CUTS]
        held = rows.agg(*[F.count(F.when(F.col(value) >= F.lit(m), True)) for m in marks]).first()
        reached = [m for m, n in zip(marks, held, strict=True) if n >= wanted]
        missed = [m for m, n in zip(marks, held, strict=True) if n < wanted]
        low, high = max(reached, default=low), min(missed, default=high + 1) - 1
    return low


def ranked(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3... by falling score, then rising id, of those drawn; null for all others.

    Of the rows with at least ``least_words`` words the ``percent`` hundredths (rounded down) with the
    highest scores are drawn. Bisection finds the score that just enough rows reach, then, among the
    rows of that score, the id; only the rows drawn are sorted, dealt by range. Missing ids come
    last; rows alike in score and id are taken by their number.
    """
    order = rows.withColumn("__id", F.coalesce(-F.col("doc_id"), F.lit(_LAST)))
    able = order.where(F.col("n_words") >= least_words)
    wanted = able.count() * percent // 100
    if wanted == 0:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    score = greatest_cut(able, "score", wanted)
    above = able.where(F.col("score") > score).count()
    tied = greatest_cut(able.where(F.col("score") == score), "__id", wanted - above)
    drawn = (F.col("n_words") >= least_words) & (
        (F.col("score") > score) | ((F.col("score") == score) & (F.col("__id") >= tied))
    )
    placed = numbered(
        order.where(drawn).withColumns({"__all": F.lit(0), "__score": -F.col("score"), "__id": -F.col("__id")}),
        "__all",
        ["__score", "__id", "number"],
        "__place",
    )
    rank = F.when(F.col("__place") < wanted, F.col("__place") + 1).cast("long").alias("rank")
    chosen = placed.select(*rows.columns, rank)
    return chosen.unionByName(order.where(~drawn).select(*rows.columns, F.lit(None).cast("long").alias("rank")))


def resample_report(docs: DataFrame, target: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_features, weight, score, rank``.

    Null and empty texts have no features, weight 0 and no rank; null ids draw like an empty id and
    come last among ties; repeated rows stay and tie; empty tables give no rows, an empty target
    counts no features. Columns other than ``doc_id`` and ``text`` are not read.
    """
    return ranked(scored(docs, target)).select("doc_id", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents drawn, with their columns and ``rank``; the rest as in ``resample_report``."""
    drawn = ranked(scored(docs, target, whole=True), percent, least_words).where("rank IS NOT NULL")
    return unpacked(drawn, "rank")
