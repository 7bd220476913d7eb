"""Approximate nearest neighbours: an inverted file of product-quantised vectors, re-ranked exactly.

Fitting cuts the space into cells (k-means) and the differences from the cells' centres into short
codes (k-means per group of dimensions), both on a bounded sample. Every vector is stored with its
cell, its code and itself, in one folder per cell. A search reads the codes of the cells nearest to
a question, estimates distances by table look-up, and measures only the best estimates exactly.
How many cells and candidates a collection needs is measured (``settled``); where the result must be
exact, a check follows that measures whatever could still be nearer (``certain``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagefold.operators.retrieval import top_k
from pagefold.session import stage_table
from pagefold.settings import Settings
from pagefold.sources.tables import path_exists

# Bytes of a matrix of estimates that a task holds at a time.
_MATRIX_BYTES = 16 * 1024 * 1024
_CODES = 256
# Bounds round; whatever is nearer to a limit than this is measured.
_SLACK = 1e-6


@dataclass(frozen=True)
class Quantiser:
    """How an index is fitted and searched; ``cells`` and ``parts`` settle themselves where they are 0.

    ``sample`` rows (by a hash of the id) fit the quantiser, all rows are indexed. Cells are read
    in slices of about ``segment`` rows, each met by at most ``block`` questions at a time. ``refine``
    candidates per neighbour wanted leave every slice.
    """

    cells: int = 0
    parts: int = 0
    sample: int = 100_000
    rounds: int = 12
    segment: int = 50_000
    block: int = 2048
    refine: int = 20


def _rows_of(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(np.float64)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of every point; of equally near ones the first."""
    squares = (centres * centres).sum(axis=1)
    out = np.empty(len(points), dtype=np.int64)
    step = max(1, _MATRIX_BYTES // (8 * len(centres)))
    for at in range(0, len(points), step):
        block = points[at : at + step]
        out[at : at + step] = (squares - 2.0 * (block @ centres.T)).argmin(axis=1)
    return out


def k_means(sample: DataFrame, starts: np.ndarray, rounds: int, cells: np.ndarray | None = None) -> np.ndarray:
    """Centres of shape ``(parts, k, dimensions of a part)`` after some rounds from ``starts``.

    ``sample`` has ``embedding``; with ``cells``, the differences from the nearest of those centres
    are clustered instead. In a round every task sums up its points per part and centre, the sums
    meet per dimension, and the new centres go to the driver: ``k`` times the dimensions, whatever
    the number of rows. A centre that no point is nearest to stays where it was.
    """
    centres = starts
    parts, k, width = centres.shape
    for _ in range(rounds):
        now = centres

        def sums(batches: Iterator[pa.RecordBatch], now: np.ndarray = now) -> Iterator[pa.RecordBatch]:
            counts, totals = np.zeros((parts, k), dtype=np.int64), np.zeros((parts, k, width))
            for batch in batches:
                points = _rows_of(batch.column("embedding"))
                if cells is not None:
                    points = points - cells[nearest(points, cells)]
                for part in range(parts):
                    own = points[:, part * width : (part + 1) * width]
                    to = nearest(own, now[part])
                    counts[part] += np.bincount(to, minlength=k)
                    np.add.at(totals[part], to, own)
            part, code = np.nonzero(counts)
            found = [pa.array(part, pa.int32()), pa.array(code, pa.int32()), pa.array(counts[part, code], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*found, pa.array(list(totals[part, code]), pa.list_(pa.float64()))], names=["part", "code", "n", "total"]
            )

        met = sample.select("embedding").mapInArrow(sums, "part int, code int, n long, total array<double>")
        spread = met.select("part", "code", "n", F.posexplode("total").alias("at", "x"))
        means = spread.groupBy("part", "code", "at").agg((F.sum("x") / F.sum("n")).alias("x"))
        rows = means.groupBy("part", "code").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v"))
        centres = now.copy()
        for row in rows.select("part", "code", F.col("v.x").alias("v")).collect():
            centres[row["part"], row["code"]] = row["v"]
        if np.array_equal(centres, now):
            break
    return centres


class QuantisedIndex:
    """An index at a path: ``rows`` (one folder per cell), ``cells`` (their sizes), ``model`` (centres and codebooks)."""

    def __init__(self, spark: SparkSession, path: str, settings: Quantiser | None = None) -> None:
        self.spark, self.path, self.settings = spark, path, settings or Quantiser()

    def build(self, vectors: DataFrame) -> None:
        """Fit and write the index of ``id, embedding``; rows without a vector, or of another dimension, are left out.

        The dimension is that of the row with the smallest id.
        """
        s = self.settings
        first = vectors.where("embedding IS NOT NULL").orderBy("id").select(F.size("embedding")).first()
        if first is None or not first[0]:
            raise ValueError("no vectors to index")
        dim = first[0]
        usable = vectors.where(F.size("embedding") == dim).select("id", "embedding")
        count = usable.count()
        drawn = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.lit(max(1, min(1_000_000, 1_000_000 * s.sample // count)))
        sample = stage_table(usable.where(drawn) if count > s.sample else usable, "sample")
        cells = s.cells or max(1, min(4096, int(count**0.5)))
        parts = s.parts or next(p for p in (dim // 4, dim // 2, dim, 1) if p and dim % p == 0)
        picked = sample.orderBy(F.xxhash64("id"), "id").limit(max(cells, _CODES)).collect()
        starts = np.unique(np.array([r["embedding"] for r in picked], dtype=np.float64), axis=0)
        coarse = k_means(sample, starts[None, :cells], s.rounds)[0]
        left = starts - coarse[nearest(starts, coarse)]
        books = left[:_CODES].reshape(-1, parts, dim // parts).transpose(1, 0, 2)
        books = k_means(sample, np.ascontiguousarray(books), s.rounds, coarse)
        self._write_model(coarse, books)
        self._write_rows(usable, coarse, books)

    def _write_model(self, coarse: np.ndarray, books: np.ndarray) -> None:
        rows = [("cell", i, v.tolist()) for i, v in enumerate(coarse)]
        rows += [(f"book {p}", i, v.tolist()) for p, book in enumerate(books) for i, v in enumerate(book)]
        frame = self.spark.createDataFrame(rows, "kind string, number int, centre array<double>")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/model")

    def model(self) -> tuple[np.ndarray, np.ndarray]:
        """Centres of the cells, and the codebooks by part; both are bounded by the settings."""
        held: dict[str, dict[int, list[float]]] = {}
        for row in self.spark.read.parquet(f"{self.path}/model").collect():
            held.setdefault(row["kind"], {})[row["number"]] = row["centre"]
        stacked = {k: np.array([v[i] for i in range(len(v))]) for k, v in held.items()}
        return stacked["cell"], np.stack([stacked[f"book {p}"] for p in range(len(stacked) - 1)])

    def _write_rows(self, usable: DataFrame, coarse: np.ndarray, books: np.ndarray) -> None:
        parts, _, width = books.shape

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                points = _rows_of(batch.column("embedding"))
                cell = nearest(points, coarse)
                rest = points - coarse[cell]
                codes = [nearest(rest[:, p * width : (p + 1) * width], books[p]) for p in range(parts)]
                packed = np.stack(codes, axis=1).astype(np.uint8)
                told = np.concatenate([books[p][code] for p, code in enumerate(codes)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        batch.column("embedding"),
                        pa.array([c.tobytes() for c in packed], pa.binary()),
                        pa.array(np.linalg.norm(rest - told, axis=1)),
                        pa.array(np.linalg.norm(rest, axis=1)),
                        pa.array(cell, pa.int32()),
                    ],
                    names=["id", "embedding", "code", "error", "away", "cell"],
                )

        kinds = {f.name: f.dataType.simpleString() for f in usable.schema}
        coded = usable.mapInArrow(encode, f"id {kinds['id']}, embedding {kinds['embedding']}, code binary, error double, away double, cell int")
        # Rebalancing splits big cells into files of even size.
        coded.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{self.path}/rows")
        sizes = self.rows().groupBy("cell").agg(F.count("*").alias("held"), F.max("away").alias("radius"))
        sizes.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/cells")

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/cells")

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def candidates(self, questions: DataFrame, k: int, probes: int, refine: int = 0, certain: bool = False) -> DataFrame:
        """``question_id, cell, id``: those with the best estimates in the cells nearest to every question.

        ``certain`` takes ``limit`` of the questions, a distance that ``k`` entries are known to keep. A code's
        error and a cell's radius bound distances from below: cells and rows that could be within the
        limit are all looked at, and the ``k`` nearest of a slice leave it.

        Small cells share a slice and a large one has several, of about ``segment`` rows. A question goes once to
        every slice with a cell it wants; a task gets one slice and one block of its questions, so neither a popular
        cell nor a full one is one task, and only ``refine`` times ``k`` rows per question and slice leave it.
        """
        s = self.settings
        coarse, books = self.model()
        probes = min(probes, len(coarse))
        parts, codes, width = books.shape
        key = questions.schema["question_id"].dataType
        kind = self.rows().schema["id"].dataType
        keep = (refine or s.refine) * k
        radius, slices, full, last = np.full(len(coarse), -np.inf), {}, 0, 0
        for row in sorted(self.spark.read.parquet(f"{self.path}/cells").collect(), key=lambda r: r["cell"]):
            radius[row["cell"]], held = row["radius"], row["held"]
            if full and full + held > s.segment:
                full, last = 0, last + 1
            segments = -(-held // s.segment)
            slices[row["cell"]] = range(last, last + segments)
            full, last = (full + held, last) if segments == 1 else (0, last + segments)
        questions = questions.select("question_id", "embedding", "limit" if certain else F.lit(float("inf")).alias("limit"))

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                points = _rows_of(batch.column("embedding"))
                far = (coarse * coarse).sum(axis=1) - 2.0 * (points @ coarse.T)
                if certain:
                    limit = np.sqrt(batch.column("limit").to_numpy(zero_copy_only=False))
                    apart = np.sqrt(np.maximum(far + (points * points).sum(axis=1)[:, None], 0))
                    near = [np.flatnonzero(row).tolist() for row in apart - radius <= limit[:, None] + _SLACK]
                else:
                    near = np.argsort(far, axis=1, kind="stable")[:, :probes].tolist()
                wants = []
                for cells in near:
                    own: dict[int, list[int]] = {}
                    for cell in cells:
                        for number in slices.get(cell, ()):
                            own.setdefault(number, []).append(cell)
                    wants.append([{"slice": number, "cells": wanted} for number, wanted in own.items()])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("question_id", "embedding", "limit")),
                     pa.array(wants, pa.list_(pa.struct([("slice", pa.int32()), ("cells", pa.list_(pa.int32()))])))],
                    names=["question_id", "embedding", "limit", "wants"],
                )

        vector = questions.schema["embedding"].dataType.simpleString()
        routed = questions.mapInArrow(
            route, f"question_id {key.simpleString()}, embedding {vector}, limit double, wants array<struct<slice:int,cells:array<int>>>"
        )
        columns = ["question_id", "embedding", "limit"]
        routed = stage_table(routed.select(*columns, F.explode("wants").alias("want")).select(*columns, "want.slice", "want.cells"), "routed")
        # One row per slice that is wanted: the blocks of its questions.
        wanted = stage_table(routed.groupBy("slice").agg(F.ceil(F.count("*") / s.block).alias("blocks")), "plan")
        share = lambda of, n: F.pmod(F.xxhash64(of), F.col(n))
        asked = routed.join(wanted, "slice").select("slice", *columns, "cells", share("question_id", "blocks").alias("block"))
        places = self.spark.createDataFrame([(c, r[0], len(r)) for c, r in slices.items()], "cell int, first int, segments long")
        columns = ["cell", "id", "code", *(["error", "embedding"] if certain else [])]
        held = self.rows().select(*columns).join(F.broadcast(places), "cell")
        held = held.select(*columns, (F.col("first") + share("id", "segments")).cast("int").alias("slice")).join(wanted, "slice").select(
            *columns, "slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
        )

        def scan(rows: pa.Table, asked: pa.Table) -> pa.Table:
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            if rows.num_rows and asked.num_rows:
                # In the order of ids, so that of equal estimates those of the smaller ids are kept.
                rows = rows.sort_by("id")
                coded = np.frombuffer(b"".join(rows["code"].to_pylist()), dtype=np.uint8).reshape(-1, parts)
                wanted, cells = _rows_of(asked["embedding"].combine_chunks()), asked["cells"].to_pylist()
                members = rows["cell"].to_numpy()
                held = {cell: np.flatnonzero(members == cell) for cell in np.unique(members).tolist()}
                if certain:
                    vectors, errors = _rows_of(rows["embedding"].combine_chunks()), rows["error"].to_numpy()
                    names, limits = np.array(rows["id"].to_pylist()), np.sqrt(asked["limit"].to_numpy())
                step = max(1, _MATRIX_BYTES // (8 * max(len(coded), parts * codes)))
                for at in range(0, len(wanted), step):
                    points = wanted[at : at + step]
                    asking: dict[int, list[int]] = {}
                    for q, own in enumerate(cells[at : at + step]):
                        for cell in own:
                            asking.setdefault(cell, []).append(q)
                    guess = np.full((len(points), len(coded)), np.inf)
                    for cell, who in asking.items():
                        place = held.get(cell)
                        if place is None:
                            continue
                        block = (points[who] - coarse[cell]).reshape(-1, parts, 1, width)
                        tables = ((block - books[None]) ** 2).sum(axis=3)
                        sums = np.zeros((len(who), len(place)))
                        for p in range(parts):
                            sums += tables[:, p, coded[place, p]]
                        guess[np.ix_(who, place)] = sums
                    for q, row in enumerate(guess):
                        if certain:
                            close = np.flatnonzero(np.sqrt(row) - errors <= limits[at + q] + _SLACK)
                            close = close[np.isfinite(row[close])]
                            delta = vectors[close] - points[q]
                            exact = (delta * delta).sum(axis=1)
                            best = np.lexsort((names[close], exact))[:k]
                            found.append((np.full(len(best), at + q), close[best], exact[best]))
                            continue
                        near = np.flatnonzero(np.isfinite(row))
                        if len(near) > keep:
                            far = row[near]
                            worst = np.partition(far, keep - 1)[keep - 1]
                            less = near[far < worst]
                            near = np.concatenate([less, near[far == worst][: keep - len(less)]])
                        found.append((np.full(len(near), at + q), near, row[near]))
            who, what, far = (np.concatenate(c) if found else np.empty(0, dtype=np.int64) for c in zip(*found, strict=True)) if found else (
                np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0))
            cell_of = rows["cell"].combine_chunks().take(pa.array(what)) if rows.num_rows else pa.array([], pa.int32())
            return pa.table(
                {
                    "question_id": asked["question_id"].combine_chunks().take(pa.array(who)).cast(to_arrow_type(key)),
                    "cell": cell_of.cast(pa.int32()),
                    "id": rows["id"].combine_chunks().take(pa.array(what)).cast(to_arrow_type(kind)),
                    "guess": pa.array(far, pa.float64()),
                }
            )

        group = ["slice", "block"]
        met = held.groupBy(*group).cogroup(asked.groupBy(*group)).applyInArrow(
            scan, f"question_id {key.simpleString()}, cell int, id {kind.simpleString()}, guess double"
        )
        best = Window.partitionBy("question_id").orderBy("guess", "id")
        ranked = met.withColumn("place", F.row_number().over(best)).where(F.col("place") <= keep)
        return ranked.select("question_id", "cell", "id")

    def search(self, questions: DataFrame, k: int, probes: int = 32, refine: int = 0, certain: bool = False) -> DataFrame:
        """``question_id, id, distance, rank`` as in ``top_k``, of the nearest entries found.

        The candidates' vectors come from the folders of their cells alone; distances are exact, in
        double precision, and ties go to the smaller id. Questions without a vector, or with one of
        another dimension, take no part. With ``certain``, the distances found are the limits of an
        exact check, and the result is that of ``top_k``.
        """
        dim = self.model()[0].shape[1]
        asked = stage_table(questions.select("question_id", "embedding"), "questions").where(F.size("embedding") == dim)
        ranked = self._measured(asked, self.candidates(asked, k, probes, refine), k)
        if not certain:
            return ranked
        known = ranked.groupBy("question_id").agg(F.max("distance").alias("limit"), F.count("*").alias("n")).where(F.col("n") == k)
        limit = F.coalesce("limit", F.lit(float("inf"))).alias("limit")
        limited = stage_table(asked.join(known, "question_id", "left").select("question_id", "embedding", limit), "limits")
        return self._measured(asked, self.candidates(limited, k, probes, certain=True), k)

    def _measured(self, asked: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
        found, size = stage_table(candidates, "candidates"), 8 * self.model()[0].shape[1] + 256
        # Where the questions are few, no vector of an entry is shuffled a second time.
        asked = F.broadcast(asked) if asked.count() * size <= Settings().broadcast_bytes else asked
        entries = self.rows().select("cell", "id", F.col("embedding").alias("vector"))
        both = entries.join(found, ["cell", "id"]).join(asked, "question_id")
        delta = F.zip_with("embedding", "vector", lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
        exact = both.select("question_id", "id", F.aggregate(delta, F.lit(0.0), lambda s, x: s + x).alias("distance"))
        order = Window.partitionBy("question_id").orderBy("distance", "id")
        return exact.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def settled(self, questions: DataFrame, k: int, wanted: float = 0.95, sample: int = 200, probes: int = 32) -> tuple[int, int]:
        """``probes, refine`` with which a search finds so much of the true neighbours of a sample of the questions.

        Both are doubled until it does; in the end all cells are read and all rows measured. The
        sample is by a hash of the id, and its neighbours come from an exact scan.
        """
        refine, dim = self.settings.refine, self.model()[0].shape[1]
        usable = questions.where(F.size("embedding") == dim).select("question_id", "embedding")
        some = stage_table(usable.orderBy(F.xxhash64("question_id"), "question_id").limit(sample), "some")
        exact = stage_table(top_k(self.rows().select("id", "embedding"), some, k), "exact")
        sizes = self.spark.read.parquet(f"{self.path}/cells").agg(F.count("*").alias("cells"), F.sum("held").alias("held")).first()
        while True:
            counted = recall(self.search(some, k, probes, refine), exact).first()
            whole = probes >= sizes["cells"] and refine * k >= sizes["held"]
            if whole or counted["found"] >= wanted * counted["wanted"]:
                return probes, refine
            probes, refine = 2 * probes, 2 * refine


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: ``wanted`` neighbours, and how many of them were ``found``."""
    keys = ["question_id", "id"]
    hit = exact.select(*keys).join(found.select(*keys, F.lit(1).alias("hit")), keys, "left")
    return hit.agg(F.count("*").alias("wanted"), F.count("hit").alias("found"))
