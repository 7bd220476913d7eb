"""Vectors from the corpus itself: TF-IDF weights, reduced by a randomised singular value decomposition."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold.backends.base import Embedder
from pagefold.functions.text import let
from pagefold.operators.rows import unnest
from pagefold.session import stage_table

# Words are runs of letters and digits, lower-cased.
WORD_GAP = "[^\\p{L}\\p{N}]+"
# Entries of the matrix that a task multiplies at a time, and words whose sums travel together.
_ENTRIES, _WORDS = 50_000, 256


@dataclass(frozen=True)
class Latent:
    """``dims`` directions are kept of ``dims + more`` that ``rounds`` of power iteration look for.

    The vocabulary is the ``terms`` words of most documents, of at least ``least_documents`` each; it
    and its vectors are what the driver and every worker hold. All documents fit the directions.
    """

    dims: int = 64
    more: int = 16
    rounds: int = 2
    terms: int = 50_000
    least_documents: int = 2
    seed: int = 7


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_GAP, -1), lambda w: w != "")


def _counted(found: Column) -> Column:
    """``term, times`` of every word of an array: the lengths of its runs in sorted order."""

    def runs(w: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(1), F.size(w)), lambda i: ~F.get(w, i - 1).eqNullSafe(F.get(w, i)))
        return let(ends, lambda es: F.transform(es, lambda e, k: F.struct(
            F.get(w, e - 1).alias("term"), (e - F.coalesce(F.get(es, k - 1), F.lit(0))).cast("long").alias("times"))))

    none = F.array().cast("array<struct<term:string,times:bigint>>")
    return let(F.sort_array(found), lambda w: F.when(F.size(w) > 0, runs(w)).otherwise(none))


def document_terms(docs: DataFrame) -> DataFrame:
    """``id, term, times`` of ``id, text``; rows of one id are one document.

    Words are counted inside their row, so only rows whose id comes again are shuffled.
    """
    texts = docs.select("id", "text")
    repeated = texts.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select(F.col("id").alias("again"))
    repeated = stage_table(repeated, "repeated")
    same = F.col("id").eqNullSafe(F.col("again"))

    def counted(rows: DataFrame) -> DataFrame:
        pairs = unnest(rows, ["id"], _counted(words(F.col("text"))), "place", "pair")
        return pairs.select("id", F.col("pair.term").alias("term"), F.col("pair.times").alias("times"))

    if repeated.isEmpty():
        return counted(texts)
    merged = counted(texts.join(repeated, same, "left_semi")).groupBy("id", "term").agg(F.sum("times").alias("times"))
    return counted(texts.join(repeated, same, "left_anti")).unionAll(merged)


def term_statistics(held: DataFrame, documents: int, settings: Latent | None = None) -> DataFrame:
    """``term, documents, idf`` of the vocabulary: smoothed inverse document frequencies, ties by the word."""
    s = settings or Latent()
    found = held.groupBy("term").agg(F.count("*").alias("documents")).where(F.col("documents") >= s.least_documents)
    kept = found.orderBy(F.desc("documents"), "term").limit(s.terms)
    idf = F.log(F.lit(float(documents + 1)) / (F.col("documents") + 1)) + 1
    return kept.select("term", "documents", idf.alias("idf"))


def weighted(held: DataFrame, statistics: DataFrame) -> DataFrame:
    """``id, term, weight``: (1 + ln times) * idf, scaled so that every document has length 1.

    The entries of a document meet as one row, which has no more of them than the vocabulary.
    """
    raw = held.where("id IS NOT NULL").join(statistics.select("term", "idf"), "term").select(
        "id", F.struct("term", ((1 + F.log("times")) * F.col("idf")).alias("raw")).alias("entry")
    )
    rows = raw.groupBy("id").agg(F.collect_list("entry").alias("entries"), F.sqrt(F.sum(F.col("entry.raw") * F.col("entry.raw"))).alias("length"))
    each = unnest(rows, ["id", "length"], F.col("entries"), "place", "entry")
    return each.select("id", F.col("entry.term").alias("term"), (F.col("entry.raw") / F.col("length")).alias("weight"))


def _by_document(entries: DataFrame, terms: list[str]) -> DataFrame:
    """The matrix as rows ``at, weight``: per document the numbers of its terms and their weights; stored once.

    A document is one row, however many tasks its entries come from: it has no more of them than the vocabulary.
    """
    spark = entries.sparkSession
    numbers = spark.createDataFrame(pa.table({"term": pa.array(terms, pa.string()), "at": pa.array(range(len(terms)), pa.int32())}))
    met = entries.join(F.broadcast(numbers), "term").select("id", F.struct("at", "weight").alias("entry"))
    rows = met.groupBy("id").agg(F.collect_list("entry").alias("entries"))
    return stage_table(rows.select(F.col("entries.at").alias("at"), F.col("entries.weight").alias("weight")), "matrix")


def _carried(matrix: DataFrame, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the matrix ``A`` and the vectors ``V`` of the words the products ``A' A V`` and ``(A V)' (A V)``, in one pass.

    The rows of ``A V`` stay in their tasks. What a task passes on is as large as ``V``, whatever the number
    of its documents; it goes by blocks of words, and the blocks of all tasks meet before the driver gets their sum.
    """
    spark = matrix.sparkSession
    shared = spark.sparkContext.broadcast(vectors)
    width = vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        back, square = np.zeros_like(v), np.zeros((width, width))
        for batch in batches:
            held = batch.column("at")
            ends = held.offsets.to_numpy()
            numbers = held.values.to_numpy()
            weights = batch.column("weight").values.to_numpy()[batch.column("weight").offsets.to_numpy()[0] :][: ends[-1] - ends[0]]
            numbers, ends = numbers[ends[0] : ends[-1]], ends - ends[0]
            first = 0
            while first < len(ends) - 1:
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + _ENTRIES, side="right")) - 1)
                at, weight = numbers[ends[first] : ends[last]], weights[ends[first] : ends[last], None]
                starts = ends[first:last] - ends[first]
                rows = np.add.reduceat(v[at] * weight, starts, axis=0)
                square += rows.T @ rows
                order = np.argsort(at, kind="stable")
                whose = np.repeat(np.arange(last - first), np.diff(ends[first : last + 1]))[order]
                at = at[order]
                words = np.flatnonzero(np.diff(at, prepend=-1))
                back[at[words]] += np.add.reduceat(rows[whose] * weight[order], words, axis=0)
                first = last
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([square.tobytes()], pa.binary())], names=["block", "part"])
        for n, start in enumerate(range(0, len(back), _WORDS)):
            part = back[start : start + _WORDS]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["block", "part"])

    def added(parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p.as_py()) for p in parts["part"])
        return pa.table({"block": parts["block"][:1], "part": pa.array([total.tobytes()], pa.binary())})

    sums = matrix.mapInArrow(run, "block int, part binary").groupBy("block").applyInArrow(added, "block int, part binary").collect()
    shared.destroy()
    back, square = np.zeros_like(vectors), np.zeros((width, width))
    for r in sums:
        part = np.frombuffer(r["part"]).reshape(-1, width)
        if r["block"] < 0:
            square = part
        else:
            back[r["block"] * _WORDS : r["block"] * _WORDS + len(part)] = part
    return back, (square + square.T) / 2


def _orthonormal(gram: np.ndarray) -> np.ndarray:
    """What turns columns with these products into orthonormal ones; directions that vanish are dropped."""
    values, vectors = np.linalg.eigh(gram)
    held = values > max(values.max(), 0.0) * 1e-12
    return vectors[:, held] / np.sqrt(values[held])


def _directions(entries: DataFrame, terms: list[str], seeds: list[int], s: Latent) -> tuple[np.ndarray, np.ndarray]:
    """Singular values, largest first, and the right vectors: a row per term."""
    width = s.dims + s.more
    vectors = np.array([np.random.default_rng([s.seed, h & (2**63 - 1)]).standard_normal(width) for h in seeds])
    matrix = _by_document(entries, terms)
    for _ in range(s.rounds + 1):
        back, square = _carried(matrix, vectors)
        vectors = back @ _orthonormal(square)
        small = vectors.T @ vectors
        small = (small + small.T) / 2
        if _ < s.rounds:
            vectors = vectors @ _orthonormal(small)
    values, turn = np.linalg.eigh(small)
    order = np.argsort(-values)[: s.dims]
    values = np.sqrt(np.clip(values[order], 0.0, None))
    turn = turn[:, order][:, values > 0] / values[values > 0]
    return values[values > 0], vectors @ turn


def decompose(entries: DataFrame, settings: Latent | None = None) -> tuple[np.ndarray, DataFrame]:
    """Singular values of the matrix ``id, term, weight``, largest first, and ``term, vector``, its right vectors.

    Range finder: random vectors per word are carried to the documents and back, made orthonormal
    by the small square of their products, a few times; the small matrix left is solved on the
    driver. Every pass reads all documents; the driver holds the vectors of the vocabulary, and no row of a document.
    """
    s = settings or Latent()
    found = entries.select("term").distinct().select("term", F.xxhash64("term").alias("seed")).orderBy("term").collect()
    terms = [r["term"] for r in found]
    values, vectors = _directions(entries, terms, [r["seed"] for r in found], s)
    table = pa.table({"term": pa.array(terms, pa.string()), "vector": pa.array(list(vectors), pa.list_(pa.float64()))})
    return values, entries.sparkSession.createDataFrame(table)


class LatentEmbedder(Embedder):
    """Texts to unit vectors: TF-IDF weights times the words' vectors; texts without a known word get zeros."""

    def __init__(self, terms: list[str], idf: np.ndarray, vectors: np.ndarray, name: str = "latent-terms") -> None:
        self.name, self.dim = name, vectors.shape[1]
        self._idf, self._vectors = idf, vectors.astype(np.float32)
        self._terms = terms
        self._at: dict[str, int] = {}

    def __getstate__(self) -> dict[str, object]:
        return {**self.__dict__, "_at": {}}

    def load(self) -> None:
        if not self._at:
            self._at = {t: i for i, t in enumerate(self._terms)}

    def encode(self, texts: list[str]) -> np.ndarray:
        import regex

        self.load()
        out = np.zeros((len(texts), self.dim), dtype=np.float32)
        for row, text in enumerate(texts):
            times: dict[int, int] = {}
            for word in regex.split(WORD_GAP, text.lower()):
                at = self._at.get(word)
                if at is not None:
                    times[at] = times.get(at, 0) + 1
            if times:
                at_ = np.fromiter(times, dtype=np.int64)
                weight = (1 + np.log(np.fromiter(times.values(), dtype=np.float64))) * self._idf[at_]
                vector = (weight / np.linalg.norm(weight)) @ self._vectors[at_]
                out[row] = vector / (np.linalg.norm(vector) or 1.0)
        return out


def fit_embedder(docs: DataFrame, settings: Latent | None = None) -> tuple[LatentEmbedder, np.ndarray]:
    """An embedder fitted on ``id, text`` (ids distinct, nulls skipped), and the singular values."""
    s = settings or Latent()
    usable = docs.where("id IS NOT NULL AND text IS NOT NULL").select("id", "text")
    count = usable.count()
    held = stage_table(document_terms(usable), "terms")
    statistics = stage_table(term_statistics(held, count, s), "statistics")
    found = statistics.select("term", "idf", F.xxhash64("term").alias("seed")).orderBy("term").collect()
    if not found:
        raise ValueError("no word is in enough documents")
    terms = [r["term"] for r in found]
    values, vectors = _directions(weighted(held, statistics), terms, [r["seed"] for r in found], s)
    return LatentEmbedder(terms, np.array([r["idf"] for r in found]), vectors), values
