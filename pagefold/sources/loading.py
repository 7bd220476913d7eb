"""Files to page rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold.functions.cleaning import clean_ocr_text
from pagefold.functions.language import is_plausible_hangul
from pagefold.functions.markup import elements_text, html_elements
from pagefold.sources.folder import with_route
from pagefold.sources.formats import READERS, Unsupported
from pagefold.sources.scanned import Recognition

PARSED = (
    "path string, source_file string, file_type string, file_bytes long, page_num int, "
    "parts array<string>, method string, status string"
)
PAGE_COLUMNS = ("source_file", "file_type", "page_num", "text", "method", "elements_count", "status")
_PARSED = pa.schema([
    ("path", pa.string()), ("source_file", pa.string()), ("file_type", pa.string()), ("file_bytes", pa.int64()), ("page_num", pa.int32()),
    ("parts", pa.list_(pa.string())), ("method", pa.string()), ("status", pa.string()),
])
# Rows, and bytes of files, that a worker gathers before it passes them on.
PIECE_ROWS, PIECE_BYTES = 500, 4 * 1024 * 1024
OK, NO_TEXT = "ok", "failed: no text"
# Preview text is enough at this many characters per kilobyte, and at least so many.
PREVIEW_CHARS_PER_KB, PREVIEW_MIN_CHARS = 100, 1500


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _PARSED, strict=True)], schema=_PARSED)


def _pieces(files: Iterable[list[tuple]]) -> Iterator[pa.RecordBatch]:
    """The rows of files as batches, each passed on before further files are read."""
    rows: list[tuple] = []
    held = 0
    for found in files:
        rows += found
        held += found[0][3]
        if held >= PIECE_BYTES or len(rows) >= PIECE_ROWS:
            yield _as_batch(rows)
            rows, held = [], 0
    if rows:
        yield _as_batch(rows)


def read_files(files: DataFrame, recognition: Recognition | None = None) -> DataFrame:
    """Parse every file once, whatever its format; a failure is a row with its reason.

    One pass with a choice by suffix per file: a branch per format would scan the folder once
    for each. A file is parsed and passed on in pieces of a few megabytes, however many files Spark
    hands over at once, so that a worker never holds the pages of a whole batch.
    """
    recognition = recognition or Recognition()
    routed = with_route(files).select("path", "source_file", "file_type", "loader", "content")

    def read(loader: str | None, content: bytes) -> list[tuple[list[str], str]]:
        if loader is None:
            raise Unsupported("unknown suffix")
        if loader == "pdf":
            return recognition.read_pdf(content)
        if loader == "image":
            return recognition.read_image(content)
        return READERS[loader](content)

    def pages_of(path: str, name: str, suffix: str, loader: str | None, content: bytes) -> list[tuple]:
        head = (path, name, suffix, len(content))
        try:
            pages = read(loader, content)
        except Unsupported as reason:
            return [(*head, None, None, None, f"unsupported: {reason}")]
        except Exception as error:
            return [(*head, None, None, None, f"failed: {error}")]
        return [(*head, i, *page, OK) for i, page in enumerate(pages, 1)] or [(*head, None, None, None, NO_TEXT)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recognition.load()
        for batch in batches:
            yield from _pieces(pages_of(*[v.as_py() for v in file]) for file in zip(*batch.columns, strict=True))

    return routed.mapInArrow(run, PARSED)


def preview_is_enough(text: Column, file_bytes: Column) -> Column:
    """Whether preview text is long enough for the size of its file."""
    expected = F.floor(file_bytes / 1024 * PREVIEW_CHARS_PER_KB)
    return F.length(text) >= F.greatest(expected, F.lit(PREVIEW_MIN_CHARS))


def load_pages(files: DataFrame, recognition: Recognition | None = None) -> DataFrame:
    """Page rows with cleaned text, plus one row without page number per file that failed."""
    parsed = read_files(files, recognition)
    hangul = F.col("method").isin("hwp_prvtext", "hwpx_xml")
    parts = F.when(hangul, F.filter("parts", is_plausible_hangul)).otherwise(F.col("parts"))
    staged = parsed.withColumn("parts", parts)
    nothing = hangul & (F.size("parts") == 0)
    return (
        staged.withColumn(
            "text", F.when(F.col("status") == OK, clean_ocr_text(F.array_join("parts", "\n")))
        )
        .withColumn("status", F.when(nothing, NO_TEXT).otherwise(F.col("status")))
        .withColumn("page_num", F.when(F.col("status") == OK, F.col("page_num")))
        .withColumn("elements_count", F.lit(None).cast("int"))
        .withColumn(
            "preview_enough",
            F.when(F.col("method") == "hwp_prvtext", preview_is_enough(F.col("text"), F.col("file_bytes"))),
        )
        .select("path", *PAGE_COLUMNS, "preview_enough")
    )


def reparse_short_previews(
    files: DataFrame, pages: DataFrame, recognition: Recognition
) -> DataFrame:
    """Send files whose preview text is too short to the document parser.

    The parser's pages replace the preview where it returns any. Only the files concerned are
    read again, and they are matched by path, so no key is hot.
    """
    short = pages.where(~F.coalesce("preview_enough", F.lit(True))).select("path")
    again = with_route(files).join(short, "path", "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        recognition.load()
        for batch in batches:
            rows = [
                (path, name, suffix, number, page[0][0], page[1])
                for path, name, suffix, content in batch.itertuples(index=False)
                for number, page in enumerate(recognition.parse(bytes(content), suffix[1:]), 1)
            ]
            columns = ["path", "source_file", "file_type", "page_num", "text", "method"]
            yield pd.DataFrame(rows, columns=columns).astype({"page_num": "Int32"})

    better = (
        again.select("path", "source_file", "file_type", "content")
        .mapInPandas(
            run,
            "path string, source_file string, file_type string, page_num int, text string, method string",
        )
        .withColumn("text", clean_ocr_text(F.col("text")))
        .withColumn("status", F.lit(OK))
        .withColumn("elements_count", F.lit(None).cast("int"))
        .withColumn("preview_enough", F.lit(None).cast("boolean"))
    )
    kept = pages.join(better.select("path").distinct(), "path", "left_anti")
    return kept.unionByName(better)


def load_html(pages: DataFrame, key: str, html: str, suffix: str = "html") -> DataFrame:
    """Markup held in a column to one page row each, with the number of elements."""
    staged = pages.select(
        F.col(key).cast("string").alias("source_file"), html_elements(F.col(html)).alias("_elements")
    )
    return staged.select(
        "source_file",
        F.lit(f".{suffix}").alias("file_type"),
        F.lit(1).alias("page_num"),
        clean_ocr_text(elements_text(F.col("_elements"))).alias("text"),
        F.lit(f"unstructured_{suffix}").alias("method"),
        F.size("_elements").alias("elements_count"),
    )


def table_pages(
    table: DataFrame, document: Column, page_num: Column | None = None, method: str = "txt"
) -> DataFrame:
    """Rows of a table that already hold text, as page rows."""
    return table.select(
        document.cast("string").alias("source_file"),
        F.lit(".txt").alias("file_type"),
        (F.lit(1) if page_num is None else page_num).cast("int").alias("page_num"),
        F.col("text"),
        F.lit(method).alias("method"),
        F.lit(None).cast("int").alias("elements_count"),
    )
