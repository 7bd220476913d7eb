"""Cleaning of page rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagefold.functions.cleaning import clean_ocr_text, clean_text, line_rule, stripped_lines

from pagefold.operators.rows import unnest



def clean_pages(pages: DataFrame) -> DataFrame:
    """What ingestion does after loading: normalise whitespace."""
    return pages.withColumn("text", clean_text(F.col("text")))


def explain_lines(texts: DataFrame, key: str) -> DataFrame:
    """One row per line with the rule that removes it, null when it is kept."""
    lines = unnest(texts, [key], stripped_lines(F.col("text")), "line_no", "line")
    return lines.withColumn("rule", line_rule(F.col("line")))


def count_rules(texts: DataFrame) -> DataFrame:
    """Lines per deciding rule. The keys are the few rule names, so map-side sums do the work."""
    lines = unnest(texts, [], stripped_lines(F.col("text")), "line_no", "line")
    rules = lines.select(F.coalesce(line_rule(F.col("line")), F.lit("kept")).alias("rule"))
    return rules.groupBy("rule").agg(F.count("*").alias("lines"))
