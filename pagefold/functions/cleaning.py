"""Text cleaning: whitespace normalisation and the noise-line cascade for OCR output.

Lines are filtered as an array inside the row: nothing is exploded and regrouped, hence no
shuffle. Cheap tests come before the ones that scan the line, and tests that would need a slow
character class are guarded by a plain range test.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagefold.functions.text import (
    ALNUM,
    DIGIT_EXTRA,
    HANGUL,
    LATIN,
    UNICODE_SPACE,
    collapse_whitespace,
    count_in,
    strip,
)

# Thresholds of the noise cascade.
MIN_LINE_CHARS = 2
MIN_SIGNAL_RATIO = 0.3
SHORT_LINE_CHARS = 10
MIN_SHORT_LETTERS = 3
MAX_SHORT_DIGIT_RATIO = 0.7
MAX_JAMO_RATIO = 0.2
LATIN_CHECK_FROM, LATIN_CHECK_BELOW = 4, 8
MIN_VOWEL_RATIO, MAX_VOWEL_RATIO = 0.15, 0.85
# The loose Hangul letters that mark broken recognition.
LOOSE_JAMO = "ㄱㄴㄷㄹㅁㅂㅅㅇㅈㅊㅋㅌㅍㅎㅏㅑㅓㅕㅗㅛㅜㅠㅡㅣㅐㅔ"
# Block range that holds all of them.
JAMO_RANGE = r"[\x{3131}-\x{3163}]"
# Holds only where at least a third of the characters are letters or digits: words with at most
# two marks between them and one at either end. Settles ordinary lines without counting.
MOSTLY_SIGNAL = f"^[^{ALNUM}]?+[{ALNUM}]++(?:[^{ALNUM}]{{1,2}}+[{ALNUM}]++)*+[^{ALNUM}]?+$"
VOWELS = r"AEIOUaeiou\x{130}"
# The divider every ruled line is rewritten to.
DIVIDER = "─" * 40

# Rule names in the order in which they are tried; the first that holds removes the line.
LINE_RULES = (
    "blank",
    "too_short",
    "specials_only",
    "low_signal",
    "few_letters",
    "mostly_digits",
    "repeated_special",
    "loose_jamo",
    "odd_latin",
)


def clean_text(col: Column) -> Column:
    """Collapse spaces, then turn tabs into spaces, strip lines, drop blank ones; null gives ''.

    Newline runs need no rule of their own, since no blank line survives.
    """
    spaced = F.replace(F.regexp_replace(col, " {2,}", " "), F.lit("\t"), F.lit(" "))
    kept = F.filter(stripped_lines(spaced), lambda line: F.length(line) > 0)
    return F.coalesce(F.array_join(kept, "\n"), F.lit(""))


def _at_least(number: int, char_class: str) -> str:
    """Matches where so many characters belong to the class; scanning ends at the last of them."""
    return f"[{char_class}](?:[^{char_class}]*+[{char_class}]){{{number - 1}}}"


def _rule_tests(line: Column) -> dict[str, Column]:
    size = F.length(line)
    short = size < SHORT_LINE_CHARS
    starts_alnum = line.rlike(f"^[{ALNUM}]")
    latin = count_in(line, LATIN)
    vowel_ratio = count_in(line, VOWELS) / latin
    # Stops scanning at the eighth Latin letter, so long lines leave early.
    few_latin = line.rlike(
        f"^[^{LATIN}]*+(?:[{LATIN}][^{LATIN}]*+){{{LATIN_CHECK_FROM},{LATIN_CHECK_BELOW - 1}}}+$"
    )
    # A short line of mostly digits has fewer than three letters, as none of these counts as a digit; so few lines are counted.
    few_of_any = ~line.rlike(_at_least(MIN_SHORT_LETTERS, "\\p{L}"))
    not_digit_alnum = F.length(F.regexp_replace(line, f"[^{ALNUM}]+|[\\p{{Nd}}{DIGIT_EXTRA}]+", ""))
    return {
        "blank": size == 0,
        "too_short": size < MIN_LINE_CHARS,
        "specials_only": ~starts_alnum & line.rlike(f"^[^{ALNUM}_]+$"),
        "low_signal": ~line.rlike(MOSTLY_SIGNAL) & (count_in(line, ALNUM) < size * MIN_SIGNAL_RATIO),
        "few_letters": short & ~line.rlike(_at_least(MIN_SHORT_LETTERS, LATIN + HANGUL)),
        "mostly_digits": short & few_of_any & ((size - not_digit_alnum) > size * MAX_SHORT_DIGIT_RATIO),
        "repeated_special": ~starts_alnum & line.rlike(r"(?s)(.)\1{2,}"),
        "loose_jamo": line.rlike(JAMO_RANGE)
        & (count_in(line, LOOSE_JAMO) > size * MAX_JAMO_RATIO),
        "odd_latin": few_latin
        & ((vowel_ratio < MIN_VOWEL_RATIO) | (vowel_ratio > MAX_VOWEL_RATIO)),
    }


def line_rule(line: Column) -> Column:
    """Name of the rule that removes a stripped line, null when the line is kept."""
    return _first_rule(_rule_tests(line))


def _first_rule(tests: dict[str, Column]) -> Column:
    chosen = None
    for name in LINE_RULES:
        chosen = F.when(tests[name], name) if chosen is None else chosen.when(tests[name], name)
    return chosen


def is_noise_line(line: Column) -> Column:
    """True when any rule removes the stripped line.

    ``specials_only`` is left out: a line without a letter or digit is always ``low_signal``.
    """
    tests = _rule_tests(line)
    noise = tests["too_short"]
    for name in LINE_RULES[3:]:
        noise = noise | tests[name]
    return noise


def rewrite_line(line: Column) -> Column:
    """Surviving line: whitespace runs become one space, ruled lines one fixed divider.

    The divider case cannot occur after the cascade (such lines hold no letter or digit);
    it is kept so that the function is right on its own.
    """
    spaced = collapse_whitespace(line)
    return F.when(spaced.rlike(r"^[-=_]{3,}$"), F.lit(DIVIDER)).otherwise(spaced)


def stripped_lines(col: Column) -> Column:
    return F.transform(F.split(col, "\n"), strip)


def _keep(test: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda line: ~test(line)


def clean_ocr_text(col: Column) -> Column:
    """Drop noise lines and tidy the rest; null gives ''.

    A line that survives is rewritten in one pass over the joined text: newlines, which only
    separate lines here, are excluded from the whitespace runs by the look-ahead.
    """
    kept = F.filter(stripped_lines(col), _keep(is_noise_line))
    joined = F.regexp_replace(F.array_join(kept, "\n"), f"{UNICODE_SPACE[:-1]}&&[^\n]]+", " ")
    return F.coalesce(joined, F.lit(""))
