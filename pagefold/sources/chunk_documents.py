"""Reading stored chunk documents and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagefold import schemas


def read_chunk_documents(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Chunk documents, one per line, or one per file with ``whole_files``.

    A document that cannot be parsed keeps its text in ``_corrupt_record``.
    """
    schema = f"{schemas.CHUNK_DOCUMENT}, part int, _corrupt_record string"
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    if whole_files:
        reader = reader.option("multiLine", True).option("pathGlobFilter", "*_chunks.json")
    return reader.json(path).drop("folder")


READ, UNREADABLE, EMPTY = "read", "unreadable", "no_chunks"


def document_status(documents: DataFrame) -> DataFrame:
    """``source_file, status, chunks, excerpt``, a row per stored document, those that gave no chunk rows included.

    A document that cannot be parsed has no name; the beginning of its text tells which it is.
    """
    broken = F.col("_corrupt_record").isNotNull()
    chunks = F.coalesce(F.size("chunks"), F.lit(0))
    chunks = F.when(broken | (chunks < 0), F.lit(0)).otherwise(chunks)
    status = F.when(broken, UNREADABLE).when(chunks == 0, EMPTY).otherwise(READ)
    return documents.select(
        F.when(~broken, F.col("source_file")).alias("source_file"),
        status.alias("status"),
        chunks.alias("chunks"),
        F.when(broken, F.substring("_corrupt_record", 1, 80)).alias("excerpt"),
    )


def chunk_rows(documents: DataFrame) -> DataFrame:
    """Chunk rows of the documents; missing ids and counts get their defaults.

    Unreadable documents and those without chunks give none; ``document_status`` reports them.
    """
    return documents.where("_corrupt_record IS NULL").select("source_file", "file_type", F.posexplode("chunks").alias("i", "c")).select(
        "source_file",
        "file_type",
        F.coalesce("c.chunk_id", "i").alias("chunk_id"),
        F.coalesce("c.page_num", F.lit(1)).alias("page_num"),
        F.coalesce("c.text", F.lit("")).alias("text"),
        F.coalesce("c.char_count", F.lit(0)).alias("char_count"),
        "c.split_method",
        "c.language",
        "c.metadata",
        "c.has_structure",
        "c.structure_types",
        "c.warning",
    )


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.VECTORS).parquet(path).drop("folder")
