"""Sentence boundaries learned from the collection: which words keep a full stop without ending a sentence."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold.functions.splitting import sentences
from pagefold.operators.rows import unnest

WORD = "\\p{L}+\\.?"
# Stands for white space that is no boundary while a text is split.
_HELD = "\ue000"


@dataclass(frozen=True)
class Stops:
    """``least`` score of an abbreviation; ``always``: how often one has its stop; at most ``most`` of them, the best."""

    least: float = 0.3
    always: float = 0.99
    most: int = 1000


def stop_counts(texts: DataFrame) -> DataFrame:
    """``word, with_stop, without``: how often each lower-cased word of ``text`` has a full stop behind it."""
    words = texts.where("text IS NOT NULL").select(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    rows = unnest(words, [], F.col("words"), "n", "word").select(
        F.lower(F.rtrim("word", F.lit("."))).alias("word"), F.col("word").endswith(".").alias("stop")
    )
    return rows.groupBy("word").agg(F.count_if("stop").alias("with_stop"), F.count_if(~F.col("stop")).alias("without"))


def abbreviations(counts: DataFrame, stops: Stops | None = None) -> DataFrame:
    """``word, with_stop, without, score`` of the words that look like abbreviations.

    The log-likelihood ratio of "nearly always with a stop" against "as often as any word", made
    smaller for long words and for every occurrence without a stop. Ties go to the smaller word.
    """
    s = stops or Stops()
    sums = counts.agg(F.sum("with_stop"), F.sum(F.col("with_stop") + F.col("without"))).first()
    if not sums[0] or sums[0] == sums[1]:
        return counts.withColumn("score", F.lit(0.0)).limit(0)
    usual = sums[0] / sums[1]
    k, rest, size = F.col("with_stop"), F.col("without"), F.length("word")

    def likelihood(p: float) -> Column:
        return k * F.log(F.lit(p)) + rest * F.log(F.lit(1 - p))

    ratio = -2 * (likelihood(usual) - likelihood(s.always))
    score = ratio * F.exp(-size) * F.pow(size.cast("double"), -rest)
    found = counts.where(k > 0).withColumn("score", score).where(F.col("score") >= s.least)
    return found.orderBy(F.desc("score"), "word").limit(s.most)


def learned_sentences(text: Column, words: list[str]) -> Column:
    """Sentences by the rules of ``sentences``, but none ends behind one of ``words`` and its stop."""
    if not words:
        return sentences(text)
    listed = "|".join(re.escape(w) for w in sorted(words, key=lambda w: (-len(w), w)))
    held = F.regexp_replace(text, f"(?iu)(?<!\\p{{L}})({listed})\\.\\s", f"$1.{_HELD}")
    return F.transform(sentences(held), lambda s: F.replace(s, F.lit(_HELD), F.lit(" ")))
