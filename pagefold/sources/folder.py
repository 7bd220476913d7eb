"""Scanning a folder of documents and routing files by suffix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Suffixes a folder scan accepts, and those that need the Hangul option.
SUFFIXES = (
    "pdf", "txt", "docx", "doc", "pptx", "ppt", "jpg", "jpeg", "png", "bmp", "tiff",
    "xlsx", "xls", "csv",
)
HANGUL_SUFFIXES = ("hwp", "hwpx")
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "tiff")
# Office formats that only their own application can open.
LEGACY_SUFFIXES = ("doc", "ppt", "xls")


def scan_folder(spark: SparkSession, folder: str, hangul: bool = False) -> DataFrame:
    """Files of a folder, not of its subfolders, with their bytes.

    The suffix list is applied while files are listed, before any is opened.
    """
    names = SUFFIXES + HANGUL_SUFFIXES if hangul else SUFFIXES
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{{{','.join(names)}}}")
        .option("recursiveFileLookup", "false")
        .load(folder)
    )


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]+$", 0)


def suffix_of(path: Column) -> Column:
    """Last suffix with its dot, as written; a leading dot does not start one."""
    return F.regexp_extract(path, r"[^/](\.[^./]+)$", 1)


def loader_of(suffix: Column) -> Column:
    """Loader a suffix is routed to; null for formats that are not supported."""
    bare = F.lower(F.regexp_replace(suffix, r"^\.", ""))
    chosen = F.when(bare.isin(*IMAGE_SUFFIXES), "image")
    for name in SUFFIXES + HANGUL_SUFFIXES:
        if name not in IMAGE_SUFFIXES:
            chosen = chosen.when(bare == name, name)
    return chosen


def with_route(files: DataFrame) -> DataFrame:
    """Add ``source_file``, ``file_type`` and ``loader`` from the path."""
    return (
        files.withColumn("source_file", file_name(F.col("path")))
        .withColumn("file_type", suffix_of(F.col("path")))
        .withColumn("loader", loader_of(F.col("file_type")))
    )
