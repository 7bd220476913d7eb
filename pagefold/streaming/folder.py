"""Continuous ingestion: new files of a folder are indexed as they arrive.

The transformations are the batch ones; the sink adds by id, so a batch that is replayed
after a failure adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagefold import schemas
from pagefold.backends.base import Embedder
from pagefold.operators.vector_index import VectorIndex
from pagefold.plans.indexing import index_chunks
from pagefold.plans.ingest import ingest_pages
from pagefold.session import shared_folder
from pagefold.settings import Settings
from pagefold.sources.folder import HANGUL_SUFFIXES, SUFFIXES
from pagefold.sources.loading import OK, load_pages
from pagefold.sources.scanned import Recognition


def watch_folder(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    names = ",".join(SUFFIXES + HANGUL_SUFFIXES)
    return (
        spark.readStream.format("binaryFile")
        .schema(schemas.RAW_FILES)
        .option("pathGlobFilter", f"*.{{{names}}}")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )


def index_stream(
    files: DataFrame,
    index: VectorIndex,
    embedder: Embedder,
    settings: Settings | None = None,
    recognition: Recognition | None = None,
    name: str = "folder",
) -> StreamingQuery:
    """Index every file that is there and stop; run it again, or on a trigger, for later ones."""
    settings = settings or Settings()

    def add_batch(batch: DataFrame, _: int) -> None:
        pages = load_pages(batch, recognition).where(F.col("status") == OK)
        index_chunks(index, ingest_pages(pages, settings, tidy=True), embedder)

    return (
        files.writeStream.foreachBatch(add_batch)
        .option("checkpointLocation", f"{shared_folder(files.sparkSession)}/stream-{name}")
        .trigger(availableNow=True)
        .start()
    )
