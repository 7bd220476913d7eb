"""Spelling normalisation of chunks by a model, with masks kept intact."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pagefold.backends.base import Corrector
from pagefold.functions.masks import protected, restored, windows_of
from pagefold.functions.text import is_blank

RESULT = "struct<text:string,error:string,seconds:double>"


def correct_column(text: Column, corrector: Corrector) -> Column:
    """Model output per text, one call per batch; a failing text comes back unchanged with the error.

    Masks reach the model as tokens; nulls and blank texts do not, and come back null.

    Texts past the token limit are corrected window by window and the windows are joined as
    they are, shared tokens included.
    """

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        corrector.load()

        def windows(text: str) -> list[str]:
            cut = windows_of(corrector.tokens(text))
            return [text] if len(cut) <= 1 else ["".join(tokens) for tokens in cut]

        def alone(text: str, parts: list[str]) -> tuple[str, str | None]:
            try:
                return "".join(corrector.correct(parts)), None
            except Exception as error:
                return text, str(error)

        for texts in batches:
            kept = {i: protected(text) for i, text in enumerate(texts) if text is not None and text.strip()}
            began = time.perf_counter()
            parts = {i: windows(text) for i, (text, _) in kept.items()}
            try:
                fixed = iter(corrector.correct([w for p in parts.values() for w in p]) if parts else [])
                done = {i: ("".join(next(fixed) for _ in p), None) for i, p in parts.items()}
            except Exception:  # some text of the batch: each on its own, so that one fails alone
                done = {i: alone(kept[i][0], p) for i, p in parts.items()}
            # A batch is one call, so its texts share its time.
            each = (time.perf_counter() - began) / max(1, len(kept))
            rows = [
                (restored(done[i][0], kept[i][1]), done[i][1], each) if i in done else (None, None, None)
                for i in range(len(texts))
            ]
            yield pd.DataFrame(rows, columns=["text", "error", "seconds"], dtype=object)

    return run(text)


def normalize_chunks(chunks: DataFrame, corrector: Corrector | None) -> DataFrame:
    """Rewrite chunk texts and record success, original length and error.

    Empty chunks carry no normalisation fields. Without a corrector chunks are unchanged.
    """
    if corrector is None:
        return (
            chunks.withColumn("normalized", F.lit(None).cast("boolean"))
            .withColumn("original_length", F.lit(None).cast("int"))
            .withColumn("normalization_error", F.lit(None).cast("string"))
            .withColumn("normalization_seconds", F.lit(None).cast("double"))
        )
    text = F.col("text")
    filled = F.length(text) > 0
    blank = is_blank(text)
    staged = chunks.withColumn("_result", correct_column(text, corrector))
    error = F.col("_result.error")
    rewritten = F.when(blank | error.isNotNull(), text).otherwise(F.col("_result.text"))
    return (
        staged.withColumn("normalized", F.when(filled, error.isNull()))
        .withColumn("original_length", F.when(filled & error.isNull(), F.length(text)))
        .withColumn("normalization_error", F.when(filled, error))
        .withColumn("normalization_seconds", F.when(filled, F.coalesce("_result.seconds", F.lit(0.0))))
        .withColumn("text", rewritten)
        .withColumn("char_count", F.length("text"))
        .drop("_result")
    )


def normalization_totals() -> list[Column]:
    """The totals as aggregates, for a summary or to be observed while the chunks are written."""
    return [
        F.count("*").alias("chunks"),
        F.count_if(F.col("normalized")).alias("succeeded"),
        F.count_if(~F.col("normalized")).alias("failed"),
        F.sum(F.when(F.col("normalized"), F.col("char_count") - F.col("original_length"))).alias("char_change"),
        F.sum("normalization_seconds").alias("seconds"),
        F.avg("normalization_seconds").alias("mean_seconds"),
    ]


def normalization_summary(chunks: DataFrame) -> DataFrame:
    """Totals over all chunks, with the time that the corrector took in all and per chunk."""
    return chunks.agg(*normalization_totals())


def write_normalized(chunks: DataFrame, write: Callable[[DataFrame], None]) -> dict[str, object]:
    """Write normalised chunks and return their totals, both in one pass over them."""
    seen = Observation("normalization")
    write(chunks.observe(seen, *normalization_totals()))
    return seen.get
