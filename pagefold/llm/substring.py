"""Substring deduplication: repeated windows of words, found by FM-indexes over shards of aligned segments.

Indexing the corpus and running every document against every shard would be quadratic. Here a
window of words goes to a shard by the smallest hash among its runs of ``ANCHOR`` words, so equal
windows always meet in one shard, and only windows whose smallest hash occurs twice go at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagefold.llm.fm_index import FMIndex
from pagefold.session import stage_table

WINDOW = 35
ANCHOR = 8
# Windows of a segment, at most: with the words around them they stay within the index's depth of 64.
MOST = 28
# Segments that share an anchor beyond this number go by window instead, each to a shard of its own hash.
CROWDED = 2_000
# Text in a shard, in bytes.
SHARD = 3_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)
# Segments looked at together.
CHUNK = 50_000


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def segments(hashes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, number of windows, twice) of the runs of windows with the same smallest hash.

    It depends on a window's words alone, so equal windows have the same anchor wherever they are.
    ``twice`` tells that the hash stands at more than one place, so that windows of the run itself
    may be equal.
    """
    anchor = min(ANCHOR, window)
    runs = np.zeros(len(hashes) - anchor + 1, dtype=np.uint64)
    for i in range(anchor):
        runs = runs * _MIX + hashes[i : i + len(runs)]
    runs ^= runs >> np.uint64(29)
    runs *= _MIX2
    runs ^= runs >> np.uint64(32)
    wide, span, low = window - anchor + 1, 1, runs
    while span * 2 <= wide:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if wide > span:
        low = np.minimum(low[: span - wide], low[wide - span :])
    place = np.arange(len(low))
    start = np.concatenate([[True], low[1:] != low[:-1]])
    began = np.maximum.accumulate(np.where(start, place, 0))
    start |= (place - began) % MOST == 0
    first = np.flatnonzero(start)
    count = np.diff(np.append(first, len(low)))
    last = first + count - 1
    inside = np.arange(wide)
    twice = np.zeros(len(first), dtype=bool)
    for at in range(0, len(first), CHUNK):  # a block at a time, as each takes a window of hashes
        a, b = first[at : at + CHUNK], last[at : at + CHUNK]
        left, right = (x + runs[x[:, None] + inside].argmin(axis=1) for x in (a, b))
        twice[at : at + CHUNK] = left != right
    return low[first].view(np.int64), first, count, twice


def _profile(docs: DataFrame, window: int) -> DataFrame:
    """Per row ``doc_id, h1, h2, n_words, whole`` (hash of all words) and its segments, coded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, whole, anchors, codes = [], [], [], []
            for scalar in batch.column("text"):
                words = scalar.as_buffer().to_pybytes().split()
                size.append(len(words))
                whole.append(sha256(b" ".join(words)).hexdigest())
                if len(words) < window:
                    anchors.append(None)
                    codes.append(None)
                else:
                    a, first, n, twice = segments(word_hashes(words), window)
                    anchors.append(a)
                    codes.append((first * 64 + n) * 2 + twice)
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in kept],
                    pa.array(size, pa.int64()),
                    pa.array(whole, pa.string()),
                    pa.array(anchors, pa.list_(pa.int64())),
                    pa.array(codes, pa.list_(pa.int64())),
                ],
                names=[*kept, "n_words", "whole", "anchors", "codes"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_identity(), _bytes())
    kind = "doc_id long, h1 long, h2 long, n_words long, whole string, anchors array<long>, codes array<long>"
    return rows.mapInArrow(run, kind)


def _identity() -> list:
    """Two hashes that tell texts apart, 128 bits in all."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2")]


def _bytes():
    return F.coalesce("text", F.lit("")).cast("binary").alias("text")


def _spelled(chosen: DataFrame, window: int) -> DataFrame:
    """The words of chosen segments: ``route, content, id, code, words, n``; crowded ones by window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        signed = lambda v: v - (1 << 64) if v >> 63 else v
        names = ["route", "content", "id", "code", "words"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for key, text, parts in zip(
                batch.column("id").to_pylist(), batch.column("text"), batch.column("parts"), strict=True
            ):
                words = text.as_buffer().to_pybytes().split()
                for part in parts:
                    anchor, code, crowded = (part[f].as_py() for f in ("anchor", "code", "crowded"))
                    first, n = divmod(code, 64)
                    for at, many in [(first + i, 1) for i in range(n)] if crowded else [(first, n)]:
                        spelled = b" ".join(words[at : at + many + window - 1])
                        content = signed(digest(spelled, 1))
                        out.append((content if crowded else anchor, content, key, at * 64 + many, spelled))
                        held += len(spelled)
                    if held > 8_000_000:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names
                        )
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names
                )

    return chosen.mapInArrow(run, "route long, content long, id long, code long, words binary")


def _search(distinct: DataFrame, shards: int, window: int) -> DataFrame:
    """``route, content, mask``: per distinct segment the windows that are found twice or more."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids: dict[bytes, int] = {}
        spelled = [np.array([ids.setdefault(w, len(ids) + 1) for w in s.split()], dtype=np.int64) for s in group["words"]]
        found = FMIndex(spelled, group["held"].to_numpy()).repeated_windows(window)
        masks = [int(sum(1 << int(i) for i in np.flatnonzero(f))) for f in found]
        out = pd.DataFrame({"route": group["route"], "content": group["content"], "mask": masks})
        return out[out["mask"] != 0]

    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(run, "route long, content long, mask long")


def _kept(texts: DataFrame, window: int) -> DataFrame:
    """``id, n_removed, kept`` of texts with the ``marks`` (code, mask) of their repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, kept = [], []
            for text, marks in zip(batch.column("text"), batch.column("marks"), strict=True):
                words = text.as_buffer().to_pybytes().split()
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                for mark in marks.as_py():
                    first, mask = mark["code"] // 64, mark["mask"]
                    while mask:
                        low = (mask & -mask).bit_length() - 1
                        edges[first + low] += 1
                        edges[first + low + window] -= 1
                        mask &= mask - 1
                stays = edges.cumsum()[:-1] == 0
                gone.append(int(len(words) - stays.sum()))
                kept.append(sha256(b" ".join([w for w, s in zip(words, stays.tolist(), strict=True) if s])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["id", "n_removed", "kept"]
            )

    return texts.mapInArrow(run, "id long, n_removed long, kept string")


def removal_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``.

    Every word goes that lies in a window of ``window`` words found anywhere else in the corpus.
    Null texts have no words; equal texts, repeated rows among them, find each other; an empty table
    gives no rows; columns other than id and text are not read.

    Equal texts are one from the start. Segments are counted by anchor; those whose anchor is alone
    cannot be repeated. The others are spelled out, equal ones become one with a weight, and each
    shard's index is searched with its own segments. Several intermediate tables are stored, narrow
    but for the texts that have such segments.
    """
    rows = stage_table(_profile(docs, window), "profiles").withColumn("row", F.monotonically_increasing_id())
    texts = rows.groupBy("h1", "h2").agg(
        F.min("row").alias("id"),
        F.count("*").alias("copies"),
        F.first("anchors").alias("anchors"),
        F.first("codes").alias("codes"),
        F.first("n_words").alias("long"),
    )
    once = stage_table(texts, "texts")
    parts = once.select("id", F.explode_outer(F.arrays_zip("anchors", "codes")).alias("part")).where(
        F.col("part").isNotNull()
    )
    held = parts.groupBy(F.col("part.anchors").alias("anchor")).agg(F.sum(1 + F.col("part.codes") % 2).alias("times")).where("times > 1")
    chosen = (
        parts.select("id", F.col("part.anchors").alias("anchor"), F.shiftright("part.codes", 1).alias("code"))
        .join(held, "anchor")
        .groupBy("id")
        .agg(F.collect_list(F.struct("anchor", "code", (F.col("times") > CROWDED).alias("crowded"))).alias("parts"))
        .join(once.select("id", "h1", "h2", "copies"), "id")
    )
    whole = docs.select(*_identity(), _bytes()).groupBy("h1", "h2").agg(F.first("text").alias("text"))
    searched = stage_table(whole.join(chosen, ["h1", "h2"]).select("id", "copies", "text", "parts"), "searched")
    spelled = _spelled(searched.select("id", "text", "parts"), window)
    seen = stage_table(spelled, "segments")
    distinct = seen.groupBy("route", "content").agg(F.first("words").alias("words"), F.count("*").alias("held"))
    size = seen.agg(F.sum(F.length("words"))).first()[0] or 0
    masks = stage_table(_search(distinct, max(1, -(-size // SHARD)), window), "masks")
    marks = (
        seen.select("route", "content", "id", "code")
        .join(masks, ["route", "content"])
        .groupBy("id")
        .agg(F.collect_list(F.struct("code", "mask")).alias("marks"))
    )
    cut = _kept(searched.where("copies = 1").select("id", "text").join(marks, "id"), window)
    known = once.select("h1", "h2", "id", "copies", "long").join(cut, "id", "left")
    gone = F.when((F.col("copies") > 1) & (F.col("long") >= window), F.col("long")).otherwise(
        F.coalesce("n_removed", F.lit(0))
    )
    empty = F.lit(sha256(b"").hexdigest())
    left = F.when((F.col("copies") > 1) & (F.col("long") >= window), empty).otherwise(F.col("kept"))
    facts = known.select("h1", "h2", gone.cast("long").alias("n_removed"), left.alias("kept"))
    return rows.join(facts, ["h1", "h2"]).select(
        "doc_id", "n_words", "n_removed", F.coalesce("kept", "whole").alias("kept_sha256")
    )
