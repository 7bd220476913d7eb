"""Document roll-ups that follow a stream: a newer version replaces a document's totals, an old or repeated one changes nothing."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pagefold.operators.chunking import chunk_texts
from pagefold.operators.rollup import mean_size
from pagefold.session import shared_folder
from pagefold.settings import Settings
from pagefold.sinks.chunk_documents import write_rows

TOTALS = "version timestamp, total_pages long, total_chunks long, total_characters long, filled_chunks long"


def page_facts(pages: DataFrame, settings: Settings) -> DataFrame:
    """``source_file, version, page_num`` and the sums of each page's chunks, without any state."""
    pieces = chunk_texts(F.col("text"), settings)
    counted = pages.select("source_file", "version", "page_num", pieces.alias("pieces"))
    lengths = F.transform("pieces", lambda p: F.length(p))
    return counted.select(
        "source_file",
        "version",
        F.col("page_num").cast("long").alias("page_num"),
        F.size("pieces").cast("long").alias("chunks"),
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, b: a + b).alias("characters"),
        F.size(F.filter(lengths, lambda n: n > 0)).cast("long").alias("filled"),
    )


def document_updates(pages: DataFrame, settings: Settings | None = None) -> DataFrame:
    """A stream of ``source_file, version, page_num, text`` to the totals of the documents that have changed.

    The state holds one row of totals per document, in the state store of the task its name belongs
    to. Pages of one version arrive in one batch, as a file is read as a whole; within it repeated
    pages count once. A version that is not newer than the one held is dropped: it was replayed or late.
    """
    settings = settings or Settings(strategy="basic")
    if settings.strategy == "semantic":
        raise ValueError("roll-ups of a stream need the basic or the recursive strategy")

    def update(key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames))
        newest = rows["version"].max()
        held = state.get if state.exists else None
        if pd.isna(newest) or held is not None and newest <= held[0]:
            return
        own = rows[rows["version"] == newest].drop_duplicates("page_num")
        totals = (newest.to_pydatetime(), len(own), int(own["chunks"].sum()), int(own["characters"].sum()), int(own["filled"].sum()))
        state.update(totals)
        yield pd.DataFrame([(key[0], *totals)], columns=["source_file", *[f.split()[0] for f in TOTALS.split(", ")]])

    facts = page_facts(pages, settings)
    return facts.groupBy("source_file").applyInPandasWithState(
        update, f"source_file string, {TOTALS}", TOTALS, "update", GroupStateTimeout.NoTimeout
    )


def headers_of(totals: DataFrame) -> DataFrame:
    """Totals with the mean chunk size, as ``document_headers`` has them."""
    return totals.withColumn("average_chunk_size", mean_size(F.col("total_characters"), F.col("filled_chunks")))


def rollup_stream(pages: DataFrame, path: str, settings: Settings | None = None, name: str = "rollup") -> StreamingQuery:
    """Keep the headers of all documents at ``path``; what is there is processed, then the query stops.

    A batch that runs again after a failure writes the same rows in place of themselves.
    """

    def replace(batch: DataFrame, _: int) -> None:
        write_rows(headers_of(batch), path)

    return (
        document_updates(pages, settings)
        .writeStream.outputMode("update")
        .foreachBatch(replace)
        .option("checkpointLocation", f"{shared_folder(pages.sparkSession)}/stream-{name}")
        .trigger(availableNow=True)
        .start()
    )
