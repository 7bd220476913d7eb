"""Exact nearest neighbours: the ``k`` entries closest to every question.

Distance is squared Euclidean, summed in double precision; ties go to the smaller id. No pair
of question and entry ever becomes a row, and the vectors of the index never move. Questions are
dealt into blocks of bounded bytes; for each block the index is scanned once, every task compares
its entries with it as matrices and passes on its own ``k`` best per question, and only those meet
in the final ranking.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pagefold.session import stage_table
from pagefold.settings import Settings

# Bytes of the matrix of distances that a task holds at a time, and questions compared with one scan.
_MATRIX_BYTES = 32 * 1024 * 1024
_QUESTIONS_PER_SCAN = 4096


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a batch as they lie in the Arrow buffer, without a copy."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


class _Best:
    """The ``k`` smallest ``(distance, id)`` per question over all entries seen so far."""

    def __init__(self, questions: np.ndarray, k: int) -> None:
        self.questions = questions
        self.squares = (questions * questions).sum(axis=1)
        self.k = k
        self.distances = [np.empty(0) for _ in questions]
        self.ids: list[np.ndarray] = [np.empty(0, dtype=object) for _ in questions]

    def add(self, pick: Callable[[np.ndarray], np.ndarray], vectors: np.ndarray) -> None:
        """Offer entries; ``pick`` returns the ids at the given positions, for candidates only."""
        step = max(1, _MATRIX_BYTES // (8 * max(1, len(self.questions))))
        for at in range(0, len(vectors), step):
            block = vectors[at : at + step].astype(np.float64)
            self._add_block(lambda positions, at=at: pick(positions + at), block)

    def _add_block(self, pick: Callable[[np.ndarray], np.ndarray], vectors: np.ndarray) -> None:
        squares = (vectors * vectors).sum(axis=1)
        rough = squares[None, :] + self.squares[:, None] - 2.0 * (self.questions @ vectors.T)
        # The product form rounds; whatever could still be among the k best is measured exactly.
        slack = 1e-9 * (1.0 + squares.max(initial=0.0) + self.squares)
        worst = np.array([d[-1] if len(d) == self.k else np.inf for d in self.distances])
        for q in np.flatnonzero(rough.min(axis=1, initial=np.inf) <= worst + 2 * slack):
            row, limit = rough[q], np.inf
            if len(self.distances[q]) == self.k:
                limit = self.distances[q][-1]
            if len(row) > self.k:
                limit = min(limit, np.partition(row, self.k - 1)[self.k - 1])
            close = np.flatnonzero(row <= limit + 2 * slack[q])
            if len(close) == 0:
                continue
            delta = vectors[close] - self.questions[q]
            exact = np.concatenate([self.distances[q], (delta * delta).sum(axis=1)])
            names = np.concatenate([self.ids[q], pick(close)])
            order = np.lexsort((names, exact))[: self.k]
            self.distances[q], self.ids[q] = exact[order], names[order]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owners = np.repeat(np.arange(len(self.ids)), [len(x) for x in self.ids])
        return owners, np.concatenate(self.ids), np.concatenate(self.distances)


def _rank(best: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy("question_id").orderBy("distance", "id")
    return best.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _broadcast_top(index: DataFrame, rows: list, k: int, key: T.DataType) -> tuple[DataFrame, Broadcast]:
    names = [row["question_id"] for row in rows]
    questions = np.asarray([row["embedding"] for row in rows], dtype=np.float64)
    dim = questions.shape[1]
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast((names, questions))
    id_type = index.schema["id"].dataType
    key_type = to_arrow_type(key)
    schema = T.StructType(
        [
            T.StructField("question_id", key),
            T.StructField("id", id_type),
            T.StructField("distance", T.DoubleType()),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, questions = shared.value
        best = _Best(questions, k)
        arrow_id = None
        for batch in batches:
            ids = batch.column(0)
            arrow_id = ids.type
            best.add(
                lambda at, ids=ids: np.array(ids.take(pa.array(at)).to_pylist(), dtype=object),
                _matrix(batch.column(1), dim),
            )
        if arrow_id is None:
            return
        owners, ids, distances = best.rows()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([names[i] for i in owners], type=key_type),
                pa.array(ids.tolist(), type=arrow_id),
                pa.array(distances),
            ],
            names=["question_id", "id", "distance"],
        )

    usable = index.where(F.size("embedding") == dim).select("id", "embedding")
    return _rank(usable.mapInArrow(scan, schema), k), shared


def top_k(
    index: DataFrame, questions: DataFrame, k: int, settings: Settings | None = None
) -> DataFrame:
    """``question_id, id, distance, rank`` of the ``k`` nearest entries of every question.

    ``index`` has ``id, embedding`` and ``questions`` has ``question_id, embedding``. The dimension
    is that of the first question by id. Questions and entries without a vector, or with one of
    another dimension, take no part; ``left_out`` counts them.
    """
    return top_k_with_bound(index, questions, k, settings)[0]


def left_out(index: DataFrame, questions: DataFrame, dimension: int) -> DataFrame:
    """``side, rows`` of what a ranking at this dimension leaves out."""
    other = ~F.coalesce(F.size("embedding") == dimension, F.lit(False))
    sides = [
        rows.where(other).agg(F.count("*").alias("rows")).select(F.lit(side).alias("side"), "rows")
        for side, rows in (("index", index), ("questions", questions))
    ]
    return sides[0].unionAll(sides[1])


def top_k_with_bound(
    index: DataFrame, questions: DataFrame, k: int, settings: Settings | None = None
) -> tuple[DataFrame, bool]:
    """The ranking, and whether it is known to be small enough to broadcast.

    Question vectors may come from a model, so they are stored once and read from there.
    """
    settings = settings or Settings()
    key = questions.schema["question_id"].dataType
    # A filter before would be pushed down and run a model once more.
    asked = stage_table(questions.select("question_id", "embedding"), "questions")
    asked = asked.where(F.col("embedding").isNotNull())
    first = asked.orderBy("question_id").select(F.size("embedding")).first()
    if first is None:
        names = f"question_id {key.simpleString()}, id {index.schema['id'].dataType.simpleString()}"
        empty = f"{names}, distance double, rank int"
        return index.sparkSession.createDataFrame([], empty), True
    dimension = first[0]
    usable = index.where(F.size("embedding") == dimension)
    asked = asked.where(F.size("embedding") == dimension)
    row_bytes = 8 * dimension + 256
    most = max(1, min(_QUESTIONS_PER_SCAN, settings.broadcast_bytes // row_bytes))
    count = asked.count()
    # Dealt by hash, a block may exceed its share a little; half as many again keep it in bounds.
    blocks = 1 if count <= most else -(-3 * count // (2 * most))
    dealt = F.pmod(F.xxhash64("question_id"), F.lit(blocks))
    parts = [asked if blocks == 1 else asked.where(dealt == n) for n in range(blocks)]
    scans = []
    for part in parts:
        if not (rows := part.collect()):
            continue
        found, shared = _broadcast_top(usable, rows, k, key)
        if blocks > 1:
            # Ranked and stored before the next block comes, so the driver holds one block at a time.
            found = stage_table(found, "ranked")
            shared.destroy()
        scans.append(found)
    return reduce(DataFrame.unionAll, scans), count * k * 256 <= settings.broadcast_bytes
