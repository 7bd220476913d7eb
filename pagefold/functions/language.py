"""Language guess and the plausibility test for recovered Hangul text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagefold.functions.text import ALNUM, DIGIT_EXTRA, HANGUL, LATIN, count_in, let, strip

KANA = r"\x{3040}-\x{30ff}"
# Languages that are told apart, and the one every other counts as.
LANGUAGES = ("ko", "en", "ja")
DEFAULT_LANGUAGE = "ko"
# Short words that tell English from other languages in Latin letters.
ENGLISH = ("the", "and", "of", "to", "in", "is", "that", "it", "for", "with", "was", "are", "on", "as", "be")
OTHER_LATIN = (
    "le", "la", "les", "des", "et", "que", "une", "est", "dans", "pour", "pas", "du", "der", "die", "und", "das", "ist",
    "nicht", "ein", "mit", "von", "den", "el", "los", "las", "y", "en", "por", "un", "una", "con", "de",
)
# Punctuation that counts as legible, as the body of a regex class.
LEGIBLE_MARKS = r" \n\t.,!?\-()\[\]{}:;@#%&*+=/<>\x22\x27"
# Thresholds of the plausibility test.
MIN_CHARS = 10
MIN_VALID_RATIO = 0.5
MIN_HANGUL_RATIO = 0.05
MIN_HANGUL = 3
MIN_ALNUM = 10
MIN_VALID_RATIO_WITH_ALNUM = 0.3


def guess_language(text: Column) -> Column:
    """Dominant script decides between ``ko``, ``ja`` and Latin; any other language counts as ``ko``.

    Latin text is English unless short words of another language outnumber English ones.

    A stand-in for a statistical detector, which is a model backend and not deterministic.
    """
    counts = F.struct(
        count_in(text, HANGUL).alias("ko"),
        count_in(text, "A-Za-z").alias("en"),
        F.when(text.rlike(f"[{KANA}]"), count_in(text, KANA)).otherwise(0).alias("ja"),
    )
    # One early-exit search settles texts without any East Asian letter; only the rest is counted.
    by_count = let(
        counts,
        lambda c: F.when((c["ko"] >= c["en"]) & (c["ko"] >= c["ja"]), "ko")
        .when(c["en"] >= c["ja"], "en")
        .otherwise("ja"),
    )
    return (
        F.when(text.rlike(f"[{HANGUL}{KANA}]"), by_count)
        .when(text.rlike("[A-Za-z]"), let(F.split(F.lower(text), "[^\\p{L}]+", -1), _latin))
        .otherwise(DEFAULT_LANGUAGE)
    )


def _latin(words: Column) -> Column:
    def count(of: tuple[str, ...]) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(*of)))

    return F.when(count(OTHER_LATIN) > count(ENGLISH), DEFAULT_LANGUAGE).otherwise("en")


def is_plausible_hangul(text: Column) -> Column:
    """True when recovered text looks like a document and not like broken bytes."""
    size = F.length(text)
    valid_class = f"a-zA-Z{LEGIBLE_MARKS}{HANGUL}{LATIN[6:]}\\p{{Nd}}{DIGIT_EXTRA}"

    def on_valid(c: Column) -> Column:
        return (c["valid"] > 0) & (
            (c["valid"] >= size * MIN_VALID_RATIO)
            | ((c["valid"] >= size * MIN_VALID_RATIO_WITH_ALNUM) & (count_in(text, ALNUM) >= MIN_ALNUM))
        )

    # The Hangul tests settle most documents; the wider class is counted only for the rest.
    return let(
        F.struct(
            F.when(text.rlike(f"[{HANGUL}]"), count_in(text, HANGUL)).otherwise(0).alias("hangul")
        ),
        lambda c: F.when(F.coalesce(F.length(strip(text)), F.lit(0)) < MIN_CHARS, False)
        .when((c["hangul"] >= MIN_HANGUL) | (c["hangul"] >= size * MIN_HANGUL_RATIO), c["hangul"] > 0)
        .otherwise(let(F.struct(count_in(text, valid_class).alias("valid")), on_valid)),
    )
