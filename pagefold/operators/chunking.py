"""Splitting pages into numbered chunks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagefold.backends.base import LanguageDetector, SentenceSplitter
from pagefold.functions.language import DEFAULT_LANGUAGE, LANGUAGES, guess_language
from pagefold.functions.metadata import with_metadata
from pagefold.functions.recursive import recursive_chunks
from pagefold.functions.splitting import fixed_windows, merge_sentences, sentences
from pagefold.functions.structure import structure_types
from pagefold.functions.text import is_blank
from pagefold.operators.rows import unnest
from pagefold.session import stage_table
from pagefold.settings import Settings

METHOD_NAMES = {"semantic": "semantic", "recursive": "langchain", "basic": "basic"}
NO_TEXT = "no_text"


def detected_language(text: Column, detector: LanguageDetector | None) -> Column:
    """Language of a text; what a detector reports outside the known ones is the default."""
    if detector is None:
        return guess_language(text)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        detector.load()
        for texts in batches:
            yield pd.Series(detector.detect(list(texts)), dtype=object)

    found = run(F.coalesce(text, F.lit("")))
    return F.when(found.isin(*LANGUAGES), found).otherwise(DEFAULT_LANGUAGE)


def sentence_list(text: Column, language: Column, splitter: SentenceSplitter | None) -> Column:
    if splitter is None:
        return sentences(text)

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        splitter.load()
        for texts, languages in batches:
            yield pd.Series(splitter.split(list(texts), list(languages)))

    return run(F.coalesce(text, F.lit("")), language)


def chunk_texts(text: Column, settings: Settings, parts: Column | None = None) -> Column:
    """Chunk texts of one page; a blank page gives one empty chunk.

    ``parts`` are the sentences that the semantic strategy merges.
    """
    size, overlap = settings.chunk_size, settings.chunk_overlap
    if settings.strategy == "semantic":
        pieces = merge_sentences(parts, size, overlap)
    elif settings.strategy == "recursive":
        # Not inside the CASE below: a Python function runs for every row anyway.
        pieces = recursive_chunks(text, size, overlap)
    else:
        pieces = fixed_windows(text, size, overlap)
    return F.when(is_blank(text), F.array(F.lit(""))).otherwise(pieces)


def number_chunks(
    pages: DataFrame, pieces: str, max_pages: int | None = None, block: int = 4096
) -> DataFrame:
    """Add ``first_id``: how many chunks the document has before each page.

    ``max_pages`` is a known bound on pages per document; a page number beyond it fails the job.
    One page needs no shuffle at all;
    up to ``block`` pages take one window per document. Without a bound a document may hold
    any share of the rows, so it is cut into blocks of pages: a window inside each block, plus
    the running total of whole blocks. The totals are sums over a few integers per block, so
    only they meet in one task, never the pages.
    """
    count = F.size(pieces)
    if max_pages is not None:
        # A wrong promise would repeat ids, so every page is held against it.
        wrong = F.concat(F.lit("page beyond max_pages in "), F.col("source_file"))
        kept = F.when(F.col("page_num") <= max_pages, F.col("page_num")).otherwise(F.raise_error(wrong))
        pages = pages.withColumn("page_num", kept.cast(pages.schema["page_num"].dataType))
    if max_pages == 1:
        return pages.withColumn("first_id", F.lit(0).cast("long"))
    before = Window.orderBy("page_num").rowsBetween(Window.unboundedPreceding, -1)
    if max_pages is not None and max_pages <= block:
        window = before.partitionBy("source_file")
        return pages.withColumn(
            "first_id", F.coalesce(F.sum(count).over(window), F.lit(0)).cast("long")
        )
    cut = F.floor((F.col("page_num") - 1) / block).cast("long")
    blocked = pages.withColumn("page_block", cut)
    totals = blocked.groupBy("source_file", "page_block").agg(F.sum(count).alias("chunks"))
    earlier = Window.partitionBy("source_file").orderBy("page_block")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "source_file",
        "page_block",
        F.coalesce(F.sum("chunks").over(earlier), F.lit(0)).alias("block_start"),
    )
    inside = before.partitionBy("source_file", "page_block")
    placed = blocked.withColumn("within", F.coalesce(F.sum(count).over(inside), F.lit(0)))
    return (
        # A left join on unique keys: it disappears from plans that do not use the ids.
        placed.join(starts, ["source_file", "page_block"], "left")
        .withColumn("first_id", F.col("block_start") + F.col("within"))
        .drop("page_block", "block_start", "within")
    )


def split_pages(
    pages: DataFrame,
    settings: Settings | None = None,
    max_pages: int | None = None,
    splitter: SentenceSplitter | None = None,
    detector: LanguageDetector | None = None,
) -> DataFrame:
    """Page rows to chunk rows; ids run from 0 over all pages of a document.

    Page facts (language, metadata, structure) are computed once per page and repeated on its
    chunks; only the semantic strategy has them. ``splitter`` and ``detector`` are model
    backends for it; without them both steps are built-in expressions.
    """
    settings = settings or Settings()
    text = F.col("text")
    columns = ["source_file", "page_num"]
    extra = [c for c in ("file_type", "method", "findings") if c in pages.columns]
    rows = pages.select(*columns, *extra, "text")
    parts = None
    if settings.strategy == "semantic":
        rows = rows.withColumn(
            "language", F.when(~is_blank(text), detected_language(text, detector))
        )
        rows = rows.withColumn("_parts", sentence_list(text, F.col("language"), splitter))
        parts = F.col("_parts")
    if max_pages != 1 and (splitter is not None or detector is not None):
        # Numbering reads the rows twice; a model must not run twice for that.
        rows = stage_table(rows, "sentences")
    rows = rows.withColumn("pieces", chunk_texts(text, settings, parts)).drop("_parts")
    if settings.strategy == "semantic":
        # A blank text has no metadata and no structure.
        rows = with_metadata(rows, text).withColumn("structure_types", structure_types(text))
    else:
        rows = rows.withColumns(
            {
                "language": F.lit(None).cast("string"),
                "metadata": F.lit(None).cast("map<string,string>"),
                "structure_types": F.lit(None).cast("array<string>"),
            }
        )
    # A page that a splitter leaves without pieces has only blanks in it.
    rows = rows.drop("text").withColumn(
        "pieces", F.when(F.size("pieces") > 0, F.col("pieces")).otherwise(F.array(F.lit("")))
    )
    numbered = number_chunks(rows, "pieces", max_pages, settings.pages_per_block)
    kept = [c for c in numbered.columns if c != "pieces"]
    exploded = unnest(numbered, kept, F.col("pieces"), "piece_no", "chunk_text")
    return exploded.select(
        "source_file",
        (F.col("first_id") + F.col("piece_no")).cast("int").alias("chunk_id"),
        "page_num",
        F.col("chunk_text").alias("text"),
        F.length("chunk_text").alias("char_count"),
        F.lit(METHOD_NAMES[settings.strategy]).alias("split_method"),
        "language",
        "metadata",
        F.when(F.col("structure_types").isNotNull(), True).alias("has_structure"),
        "structure_types",
        F.when(F.length("chunk_text") == 0, NO_TEXT).alias("warning"),
        F.col("piece_no").alias("piece_no"),
        *extra,
    )
