"""Files or page rows to chunks, document records and a run summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagefold.backends.base import Corrector
from pagefold.operators.chunking import split_pages
from pagefold.operators.cleaning import clean_pages
from pagefold.operators.normalization import normalize_chunks
from pagefold.operators.privacy import mask_pages
from pagefold.operators.rollup import document_headers, document_records, run_summary
from pagefold.session import stage_table
from pagefold.settings import Settings
from pagefold.sinks.chunk_documents import write_chunk_documents
from pagefold.sources.folder import scan_folder
from pagefold.sources.loading import OK, load_pages, reparse_short_previews
from pagefold.sources.scanned import Recognition


def ingest_pages(
    pages: DataFrame,
    settings: Settings | None = None,
    max_pages: int | None = None,
    corrector: Corrector | None = None,
    tidy: bool = False,
    **detectors: object,
) -> DataFrame:
    """Loaded pages to chunks: whitespace, masking if wanted, splitting, normalising if wanted.

    ``tidy`` pages come from a loader, whose noise filter leaves no whitespace to normalise.
    """
    settings = settings or Settings()
    cleaned = pages if tidy else clean_pages(pages)
    if settings.privacy:
        cleaned = mask_pages(cleaned, settings, **detectors)
        # Numbering reads the pages twice, and splitting is a second Python step on the masked text.
        cleaned = stage_table(cleaned, "masked")
    chunks = split_pages(cleaned, settings, max_pages)
    if settings.normalize:
        chunks = normalize_chunks(chunks, corrector)
    return chunks


@dataclass(frozen=True)
class IngestRun:
    pages: DataFrame
    chunks: DataFrame
    summary: DataFrame


def ingest_folder(
    spark: SparkSession,
    folder: str,
    output: str,
    settings: Settings | None = None,
    recognition: Recognition | None = None,
    hangul: bool = False,
    **options: object,
) -> IngestRun:
    """Read a folder, write its chunk documents, and report what succeeded.

    Pages and chunks are written once to the shared folder: parsing and model calls are costly
    and must not run again for every reader or after a lost executor.
    """
    settings = settings or Settings()
    files = scan_folder(spark, folder, hangul)
    loaded = load_pages(files, recognition)
    if hangul and recognition is not None and recognition.parser is not None:
        loaded = reparse_short_previews(files, loaded, recognition)
    pages = stage_table(loaded, "pages")
    good = pages.where(F.col("status") == OK)
    chunks = stage_table(ingest_pages(good, settings, tidy=True, **options), "chunks")
    write_chunk_documents(document_records(chunks, settings), output)
    every_file = pages.select("path", "source_file").distinct()
    return IngestRun(pages, chunks, run_summary(every_file, document_headers(chunks)))
