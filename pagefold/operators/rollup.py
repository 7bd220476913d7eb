"""Per-document and per-run summaries, and the nested document record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold import schemas
from pagefold.settings import Settings

PRIVACY_METHOD = "ai_auto"
REPORT = f"struct<page:int,findings:array<{schemas.FINDING}>>"
CHUNK_COLUMNS = (
    "chunk_id",
    "page_num",
    "text",
    "char_count",
    "split_method",
    "language",
    "metadata",
    "has_structure",
    "structure_types",
    "warning",
)


def mean_size(characters: Column, filled: Column) -> Column:
    """Mean over the chunks that have text, to two places; 0 when none has."""
    return F.when(filled > 0, F.bround(characters / filled, 2)).otherwise(F.lit(0.0))


def document_headers(chunks: DataFrame) -> DataFrame:
    """Totals of each document: pages, chunks, characters, mean chunk size, methods used.

    Every page yields at least one chunk, and the first of a page has ``piece_no`` 0, so pages
    are counted without a distinct. All aggregates combine before the shuffle, and the set of
    methods is bounded by the loaders, so one huge document is no hot spot.
    """
    methods = F.col("method") if "method" in chunks.columns else F.lit(None).cast("string")
    kinds = F.col("file_type") if "file_type" in chunks.columns else F.lit(None).cast("string")
    return (
        chunks.groupBy("source_file")
        .agg(
            F.max(kinds).alias("file_type"),
            F.count_if(F.col("piece_no") == 0).alias("total_pages"),
            F.count("*").alias("total_chunks"),
            F.sum("char_count").alias("total_characters"),
            F.count_if(F.col("char_count") > 0).alias("filled_chunks"),
            F.array_sort(F.collect_set(methods)).alias("methods_used"),
        )
        .withColumn(
            "average_chunk_size", mean_size(F.col("total_characters"), F.col("filled_chunks"))
        )
    )


def document_records(chunks: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Nested records: header, chunks and processing facts.

    A document of up to ``chunks_per_record`` chunks is one record. A larger one is several
    with the same header and consecutive ``part`` numbers, so no row grows with the document;
    their chunks together are the whole document.
    """
    settings = settings or Settings()
    fields = [c for c in CHUNK_COLUMNS if c in chunks.columns]
    part = F.floor(F.col("chunk_id") / settings.chunks_per_record).cast("int")
    sortable = [F.map_entries(f).alias(f) if f == "metadata" else F.col(f) for f in fields]
    report = F.lit(None).cast(REPORT)
    if "findings" in chunks.columns:
        report = F.when(
            (F.col("piece_no") == 0) & F.col("findings").isNotNull(),
            F.struct(F.col("page_num").alias("page"), F.col("findings")),
        )
    parts = (
        chunks.withColumn("part", part)
        .groupBy("source_file", "part")
        .agg(
            F.collect_list(F.struct(*sortable)).alias("_chunks"),
            F.collect_list(report).alias("_reports"),
        )
    )
    # Maps cannot be ordered, so metadata is a list of entries while the chunks are sorted.
    restored = F.transform(
        F.array_sort("_chunks"),
        lambda c: F.struct(
            *[
                (F.map_from_entries(c[f]) if f == "metadata" else c[f]).alias(f)
                for f in fields
            ]
        ),
    )
    parts = parts.select(
        "source_file",
        "part",
        restored.alias("chunks"),
        F.when(F.size("_reports") > 0, F.array_sort("_reports")).alias("privacy_findings"),
    )
    info = F.struct(
        F.lit(settings.chunk_size).alias("chunk_size"),
        F.lit(settings.chunk_overlap).alias("chunk_overlap"),
        F.lit("basic" if settings.strategy == "basic" else "langchain").alias("split_method"),
        F.col("methods_used"),
        F.lit(settings.privacy).alias("privacy_filtering"),
        F.lit(PRIVACY_METHOD).alias("privacy_method"),
        F.col("privacy_findings"),
    )
    return parts.join(document_headers(chunks), "source_file").select(
        "source_file",
        "file_type",
        "total_pages",
        "total_chunks",
        "total_characters",
        "average_chunk_size",
        "chunks",
        info.alias("processing_info"),
        "part",
    )


def run_summary(files: DataFrame, headers: DataFrame) -> DataFrame:
    """One row: files that gave a document, files that did not, chunks and characters.

    ``files`` has one row per input file. The join is on the file name, one row per side.
    """
    joined = files.select("source_file").join(
        headers.select("source_file", "total_chunks", "total_characters"), "source_file", "left"
    )
    done = F.col("total_chunks").isNotNull()
    return joined.agg(
        F.count_if(done).alias("succeeded"),
        F.count_if(~done).alias("failed"),
        F.coalesce(F.sum("total_chunks"), F.lit(0)).alias("total_chunks"),
        F.coalesce(F.sum("total_characters"), F.lit(0)).alias("total_characters"),
    )
