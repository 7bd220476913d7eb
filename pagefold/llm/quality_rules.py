"""Quality rules that vote or abstain; a fitted model of their accuracies decides, not the strictest rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold.llm.text_counts import with_counts
from pagefold.llm.weak_labels import with_posterior
from pagefold.session import stage_table

FEWEST_WORDS = 10
MOST_REPEATED = 20
KEEP_FROM = 0.5


def rules() -> dict[str, tuple[Column, Column]]:
    """(bad if, good if) over the counts of a text; between the two, a rule abstains."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    letters = F.greatest(F.col("n_letters"), F.lit(1))
    enough = F.col("n_words") >= 20
    return {
        "symbols": (F.col("n_symbols") > 0.3 * words, F.col("n_symbols") < 0.1 * words),
        "symbol_density": (F.col("n_symbols") > 0.04 * chars, F.col("n_symbols") < 0.01 * chars),
        "other_characters": (F.col("n_other") > 0.2 * chars, F.col("n_other") < 0.12 * chars),
        "marks": (F.col("n_marks") > 0.3 * words, F.col("n_marks") < 0.1 * words),
        "capitals": (F.col("n_upper") > 0.5 * letters, F.col("n_upper") < 0.25 * letters),
        "lines": (F.col("n_dup_lines") > 0.3 * lines, F.col("n_dup_lines") < 0.1 * lines),
        "windows": (F.col("n_repeat_words") > 0.2 * words, F.col("n_repeat_words") < 0.05 * words),
        "variety": (enough & (F.col("n_distinct") < 0.2 * words), enough & (F.col("n_distinct") > 0.4 * words)),
        "run": (F.col("longest_run") > 5, enough & (F.col("longest_run") < 3)),
        "length": (F.col("n_words") < FEWEST_WORDS, F.col("n_words") >= 30),
        "word_length": ((chars < 2 * words) | (chars > 15 * words), (chars > 3 * words) & (chars < 10 * words)),
    }


def rule_report(docs: DataFrame) -> DataFrame:
    """One row per document: the counts, ``base_failed``, ``quality`` (posterior) and ``kept``.

    Null and empty texts have no words and fail; repeated rows stay; an empty table gives no rows;
    columns other than id and text are not read. The counts are stored once, as all documents'
    votes fit the model before the first is judged.
    """
    counts = stage_table(with_counts(docs), "counts")
    judged = with_posterior(counts, rules(), "quality")
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("quality") >= KEEP_FROM)).alias("kept"),
        "quality",
    )
