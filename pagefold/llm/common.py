"""What several operators share: words, rows that keep any columns, distributed running numbers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagefold.session import stage_table

# Words are what stands between these characters.
BLANKS = " \t\n\u000b\f\r"
BLANK_RUN = "[ \\x09-\\x0D]+"
# Rows, and bytes by their mean, that a Python worker takes up before it passes on what they give.
PIECE_ROWS, PIECE_BYTES = 256, 2 * 1024 * 1024


def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches by small slices: what a worker makes of a whole batch stays in its memory afterwards."""
    for batch in batches:
        rows = max(1, min(PIECE_ROWS, batch.num_rows * PIECE_BYTES // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def packed(docs: DataFrame) -> DataFrame:
    """The rows as one struct ``row``: columns added beside it clash with none of theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked(df: DataFrame, *more: Column | str) -> DataFrame:
    """Undo ``packed``; ``more`` columns replace columns of the same name."""
    added = [F.col(c) if isinstance(c, str) else c for c in more]
    names = {c.lower() for c in df.select(*added).columns} if added else set()
    kept = [f for f in df.schema["row"].dataType.names if f.lower() not in names]
    return df.select(*[F.col("row").getField(f).alias(f) for f in kept], *added)


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, BLANK_RUN))).cast("long")


def row_key(doc_id: Column, text: Column) -> Column:
    """Tells rows apart by their id and text; null is an id of its own."""
    return F.struct(
        F.coalesce(doc_id, F.lit(0)).cast("long").alias("id"),
        doc_id.isNull().alias("none"),
        F.xxhash64(text).alias("text"),
        F.coalesce(F.length(text), F.lit(-1)).alias("length"),
    )


def numbered(rows: DataFrame, group: str, order: list[str], number: str) -> DataFrame:
    """Add the position, from 0, of every row among those of its ``group``, without a task per group.

    The rows are dealt by range, so that blocks of the order are tasks; each block counts its rows
    per group, and a row's number is its place in the block after the rows of earlier blocks. A
    group of any size spreads over many blocks. Blocks are stored once, as a second evaluation may
    draw other borders. Ties of the whole order are numbered in any way.
    """
    dealt = rows.repartitionByRange(group, *order).withColumn("__block", F.spark_partition_id())
    blocks = stage_table(dealt, "numbered")
    held = blocks.groupBy(F.col(group).alias("__group"), "__block").agg(F.count("*").alias("__held"))
    earlier = Window.partitionBy("__group").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select(
        "__group",
        F.col("__block").alias("__of"),
        F.coalesce(F.sum("__held").over(earlier), F.lit(0)).alias("__before"),
    )
    inside = Window.partitionBy("__block", group).orderBy(*order)
    return (
        blocks.withColumn("__inside", F.row_number().over(inside))
        .join(before, (F.col("__block") == F.col("__of")) & F.col(group).eqNullSafe(F.col("__group")))
        .withColumn(number, F.col("__before") + F.col("__inside") - 1)
        .drop("__block", "__inside", "__group", "__of", "__before")
    )
