"""Language identification by character n-grams, fitted and scored with aggregates."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagefold.operators.rows import unnest
from pagefold.session import stage_table

# Segments of texts that a Python worker takes up at a time.
_ROWS = 64


@dataclass(frozen=True)
class Grams:
    """``length`` of the n-grams and how many, the most frequent over all languages, the model keeps."""

    length: int = 3
    most: int = 4000
    # Characters of a text that one row holds, so that long texts are many rows.
    segment: int = 20_000


def _segments(texts: DataFrame, keep: list[str], grams: Grams) -> DataFrame:
    """``keep, piece``: the lower-cased ``text``, white space and digits as one blank each, cut so that no n-gram is lost or met twice."""
    plain = F.lower(F.regexp_replace(F.concat(F.lit(" "), "text", F.lit(" ")), "[\\s\\d]+", " "))
    size = F.length("plain")
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor((size - 1) / grams.segment)),
        lambda i: F.substring(F.col("plain"), (i * grams.segment + 1).cast("int"), F.lit(grams.segment + grams.length - 1)),
    )
    segments = unnest(texts.select(*keep, plain.alias("plain")).where(size >= grams.length), keep, pieces, "n", "piece")
    return segments.where(F.length("piece") >= grams.length).select(*keep, "piece")


def gram_rows(texts: DataFrame, keep: list[str], grams: Grams) -> DataFrame:
    """``keep, gram``: every n-gram of the lower-cased ``text``, white space and digits as one blank each."""
    # One pass: a match consumes a character and captures the gram ahead of it; substrings would count from the start each.
    found = F.regexp_extract_all("piece", F.lit(f"(?s)(?=(.{{{grams.length}}}))."), F.lit(1))
    return unnest(_segments(texts, keep, grams), keep, found, "at", "gram").select(*keep, "gram")


def _distinct(texts: list[str], length: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct n-grams of texts that all have one, which of them each n-gram in turn is, and how many each text has."""
    whole = "".join(texts)
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.array([len(t) for t in texts])
    number = len(codes) - length + 1
    keys = codes[:number]
    for k in range(1, length):
        if k > 2:  # three characters fill a number
            keys = np.unique(keys, return_inverse=True)[1].astype(np.uint64)
        keys = keys << np.uint64(21) | codes[k : k + number]
    inside = np.ones(len(codes), dtype=bool)
    for k in range(1, length):
        inside[np.cumsum(sizes) - k] = False
    starts = np.flatnonzero(inside)
    _, first, which = np.unique(keys[starts], return_index=True, return_inverse=True)
    return [whole[i : i + length] for i in starts[first].tolist()], which, sizes - length + 1


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def gram_counts(labelled: DataFrame, grams: Grams) -> DataFrame:
    """``lang, gram, n`` of ``text, lang``: a task counts some texts at a time before they meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            of: dict[str, list[str]] = defaultdict(list)
            for lang, piece in zip(*batch.to_pydict().values(), strict=True):
                of[lang].append(piece)
            for lang, texts in of.items():
                found, which, _ = _distinct(texts, grams.length)
                columns = [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.string()), pa.array(np.bincount(which))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    counted = _segments(labelled, ["lang"], grams).mapInArrow(run, "lang string, gram string, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit_languages(labelled: DataFrame, grams: Grams | None = None) -> DataFrame:
    """``gram, lang, score`` of ``text, lang``: a thousand times the log share of a gram in a language, rounded down.

    Shares are smoothed by one. The table has ``most`` grams at most for every language, whatever
    the size of the collection. Rows without text or language are skipped.
    """
    g = grams or Grams()
    usable = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counts = stage_table(gram_counts(usable, g), "grams")
    kept = counts.groupBy("gram").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "gram").limit(g.most).select("gram")
    held = stage_table(counts.join(kept, "gram"), "kept")
    sums = held.groupBy("lang").agg(F.sum("n").alias("whole"))
    number = held.select("gram").distinct().agg(F.count("*").alias("grams"))
    every = held.select("gram").distinct().join(sums, F.lit(True)).join(number, F.lit(True))
    share = (F.coalesce("n", F.lit(0)) + 1) / (F.col("whole") + F.col("grams"))
    score = F.floor(1000 * F.log(share)).cast("long")
    return stage_table(every.join(held, ["lang", "gram"], "left").select("gram", "lang", score.alias("score")), "languages")


def language_scores(texts: DataFrame, model: DataFrame, grams: Grams | None = None) -> DataFrame:
    """``id, lang, score, grams`` for every language of the model and every text that has a gram of it.

    Grams that the model lacks say nothing. The model, of ``most`` grams at most for every language,
    goes to every task, which passes on one row of sums per segment of a text.
    """
    g = grams or Grams()
    held = model.groupBy("gram", "lang").agg(F.sum("score").alias("score")).collect()
    langs = sorted({r["lang"] for r in held})
    kind = {f.name: f.dataType.simpleString() for f in texts.schema}["id"]
    if not langs:
        return texts.sparkSession.createDataFrame([], f"id {kind}, lang string, score long, grams long")
    places = {gram: n for n, gram in enumerate(sorted({r["gram"] for r in held}))}
    table = np.zeros((len(places), len(langs)), dtype=np.int64)
    for r in held:
        table[places[r["gram"]], langs.index(r["lang"])] = r["score"]
    names = ["id", "grams", *[f"s{n}" for n in range(len(langs))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found, which, sizes = _distinct(batch.column(1).to_pylist(), g.length)
            at = np.array([places.get(gram, -1) for gram in found])[which]
            begins = np.cumsum(sizes) - sizes
            known = np.add.reduceat((at >= 0).astype(np.int64), begins)
            sums = [np.add.reduceat(np.append(scores, 0)[at], begins) for scores in table.T]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v) for v in (known, *sums)]], names=names)

    rows = _segments(texts.where("text IS NOT NULL").select("id", "text"), ["id"], g)
    scored = rows.mapInArrow(run, ", ".join([f"id {kind}", *[f"{n} long" for n in names[1:]]])).where("grams > 0")
    sums = scored.groupBy("id").agg(*[F.sum(n).alias(n) for n in names[1:]])
    each = F.array(*[F.struct(F.lit(lang).alias("lang"), F.col(f"s{n}").alias("score")) for n, lang in enumerate(langs)])
    return unnest(sums, ["id", "grams"], each, "n", "s").select("id", "s.lang", "s.score", "grams")


def detect_languages(texts: DataFrame, model: DataFrame, grams: Grams | None = None) -> DataFrame:
    """``id, lang, score, margin``: the likeliest language of every text with a known gram, and its lead over the next.

    Ties go to the smaller name; texts without a known gram have no row.
    """
    scores = language_scores(texts, model, grams)
    best: Column = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "lang"))
    second = F.lead("score").over(Window.partitionBy("id").orderBy(F.desc("score"), "lang"))
    ranked = scores.withColumns({"place": best, "margin": F.col("score") - second})
    return ranked.where("place = 1").select("id", "lang", "score", "margin")
