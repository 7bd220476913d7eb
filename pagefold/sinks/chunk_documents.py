"""Storing chunk documents and vectors; a document is replaced, the others stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagefold.session import stage_table
from pagefold.sources.tables import path_exists

# Rows a folder of a new store should hold, and the number of folders in stores that keep none.
ROWS_PER_FOLDER = 2000
FEWEST, MOST = 16, 8192
UNKEPT = 64


def _folders(rows: DataFrame, path: str) -> int:
    """The store's number of folders: kept beside it, and set by the size of the first batch.

    Documents are found again by a hash of their name modulo that number, so no later caller may change it.
    """
    spark, kept = rows.sparkSession, f"{path}/_layout"
    if path_exists(spark, kept):
        return spark.read.schema("folders int").json(kept).first()[0]
    if path_exists(spark, path):
        return UNKEPT
    folders = max(FEWEST, min(MOST, rows.count() // ROWS_PER_FOLDER))
    spark.range(1).select(F.lit(folders).alias("folders")).coalesce(1).write.json(kept)
    return folders


def _replace(rows: DataFrame, path: str, kind: str) -> None:
    """Write ``rows`` in place of what the store holds of their documents.

    The store is partitioned by a hash of the document name. Only the folders of the given
    documents are read and written again, by dynamic partition overwrite; the rows that stay in
    them are stored elsewhere first, as a folder cannot be read while it is overwritten. Rebalancing
    deals a folder, or one huge document in it, over as many tasks as its size asks for.
    """
    spark = rows.sparkSession
    fresh = stage_table(rows, "fresh")
    known = path_exists(spark, path)
    out = fresh.withColumn("folder", F.pmod(F.xxhash64("source_file"), F.lit(_folders(fresh, path))).cast("int"))
    if known:
        old = spark.read.schema(out.schema).format(kind).load(path)
        touched, names = out.select("folder").distinct(), out.select("source_file").distinct()
        stays = old.join(touched, "folder", "left_semi").join(names, "source_file", "left_anti")
        out = out.unionByName(stage_table(stays.select(out.columns), "stays"))
    (
        out.hint("rebalance", "folder")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("folder")
        .format(kind)
        .save(path)
    )


def write_chunk_documents(records: DataFrame, path: str) -> None:
    """One JSON object per line and record, keyed by the full file name.

    Null fields are left out, as readers treat them as absent; a line per record keeps the
    number of files independent of the number of documents. Other documents at ``path`` stay.
    """
    _replace(records, path, "json")


def write_vectors(vectors: DataFrame, path: str) -> None:
    """Vectors of documents in place of those the store has of them."""
    _replace(vectors, path, "parquet")


def write_rows(rows: DataFrame, path: str) -> None:
    """Rows of documents (``source_file`` and more) in place of those the store has of them."""
    _replace(rows, path, "parquet")
