"""The stages as SQL sees them: temporary views of loaded and cleaned pages, and a table function that splits any table."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from pagefold.functions.splitting import check_window

CHUNK = [StructField("chunk_id", IntegerType()), StructField("char_count", IntegerType()), StructField("chunk_text", StringType())]


def windows(text: str, size: int, overlap: int) -> list[str]:
    """Windows of ``size`` characters as in ``fixed_windows``; a blank text gives one empty chunk."""
    if not text.strip():
        return [""]
    step = size - overlap
    return [text[:size]] + [text[at : at + size] for at in range(step, len(text) - overlap, step)]


class SplitTable:
    """``split_table(TABLE(t), 'text', size, overlap)``: the columns of ``t`` but for the text, and its chunks.

    Polymorphic: the result's columns follow from the table given. A null text gives no rows.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, column: AnalyzeArgument, size: AnalyzeArgument, overlap: AnalyzeArgument) -> AnalyzeResult:
        check_window(size.value, overlap.value)
        names = [f.name for f in table.dataType.fields]
        if column.value not in names:
            raise ValueError(f"the table has no column {column.value}")
        kept = [f for f in table.dataType.fields if f.name != column.value]
        return AnalyzeResult(StructType([*kept, *CHUNK]))

    def eval(self, row: Row, column: str, size: int, overlap: int) -> Iterator[tuple[object, ...]]:
        if row[column] is None:
            return
        kept = [v for f, v in zip(row.__fields__, row, strict=True) if f != column]
        for number, chunk in enumerate(windows(row[column], size, overlap)):
            yield (*kept, number, len(chunk), chunk)


def register(spark: SparkSession, **views: DataFrame) -> None:
    """Make the table function known to SQL, and DataFrames such as loaded pages by the names given."""
    spark.udtf.register("split_table", udtf(SplitTable))
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
