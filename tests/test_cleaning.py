from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from pagefold.functions import cleaning
from pagefold.functions.cleaning import DIVIDER, clean_ocr_text, clean_text, line_rule, rewrite_line
from pagefold.functions.text import ALNUM, DIGIT_EXTRA, HANGUL, LATIN, count_in

LINES = [
    ("", "blank"),
    ("가", "too_short"),
    ("---", "specials_only"),
    ("=====", "specials_only"),
    ("___", "low_signal"),
    (".....a1.....", "low_signal"),
    ("é1é2 é", "few_letters"),
    ("abc 12345", None),
    ("abc123456789", None),
    ("abc 1234567"[:9], None),
    ("*** 공지 사항 안내 문서", "repeated_special"),
    ("공지 *** 사항 안내 문서", None),
    ("ㅁㅁ 보고서 자료 ㅏㅏ", "loose_jamo"),
    ("bcdfg 보고서 작성 완료", "odd_latin"),
    ("bcdfghjk 보고서 작성", None),
    # Three letters of nine characters leave at most 0.67 for digits and marks, so the
    # ``mostly_digits`` rule never decides.
    ("abc 1 2 3", None),
    ("①②③④⑤⑥⑦⑧⑨⑩가나다", None),
]


@pytest.mark.parametrize("line,rule", LINES)
def test_golden_lines(column, line, rule):
    assert column(line_rule, [line]) == [rule]


def test_clean_text(column):
    values = ["a  b", "a\t b", "a\n\n\n\nb", None, "", "  x \n \n\t y  ", "　가　\n나"]
    assert column(clean_text, values) == ["a b", "a  b", "a\nb", "", "", "x\ny", "가\n나"]


def test_rewrite(column):
    assert column(rewrite_line, ["가나다   라마\t바사", "-----"]) == ["가나다 라마 바사", DIVIDER]


def test_properties_of_what_stays(column):
    """What the rules promise, whatever the text: stated for the output and for each dropped line."""
    rng = random.Random(7)
    alphabet = "abAEzİK가힣ㅁㅏé①²½漢 \t  12_-=.|*(\x1c"
    texts = [
        "\n".join("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(12))
        for _ in range(300)
    ]
    lines = sorted({line.strip() for text in texts for line in text.split("\n")})
    rules = dict(zip(lines, column(line_rule, lines)))
    assert set(rules.values()) == {rule for _, rule in LINES}
    for line, rule in rules.items():
        words = sum(c.isalnum() for c in line)
        if rule == "blank":
            assert not line
        elif rule == "too_short":
            assert len(line) == 1
        elif rule == "specials_only":
            assert not any(c.isalnum() for c in line)
        elif rule == "low_signal":
            assert words < 0.3 * len(line)
        elif rule == "few_letters":
            assert len(line) < 10
        elif rule == "repeated_special":
            assert not line[0].isalnum() and re.search(r"(.)\1\1", line)
        elif rule is None:
            assert len(line) > 1 and words >= 0.3 * len(line)
    cleaned = column(clean_ocr_text, texts)
    for text, out in zip(texts, cleaned):
        kept = [re.sub(r"\s+", " ", x.strip()) for x in text.split("\n") if rules[x.strip()] is None]
        assert out.split("\n") == (kept or [""])
    # A second run changes nothing, nor does the basic cleaning.
    assert column(clean_text, cleaned) == cleaned
    again = column(clean_ocr_text, cleaned)
    assert all(b == a or len(b) < len(a) for a, b in zip(cleaned, again))


def test_guards_of_short_lines_agree_with_counts(spark):
    """Early ends of scans decide as whole counts do, for lines of letters, digits and marks of several scripts."""
    rng = random.Random(4)
    lines = ["".join(rng.choice("aZ\u0130\u212a가힣ㅁéб中019²①٣ -.\U0001f600") for _ in range(rng.randint(1, 11))) for _ in range(600)]
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    line, size = F.col("line"), F.length("line")
    tests = cleaning._rule_tests(line)
    few = (size < cleaning.SHORT_LINE_CHARS) & (count_in(line, LATIN + HANGUL) < cleaning.MIN_SHORT_LETTERS)
    other = F.length(F.regexp_replace(line, f"[^{ALNUM}]+|[\\p{{Nd}}{DIGIT_EXTRA}]+", ""))
    digits = (size < cleaning.SHORT_LINE_CHARS) & ((size - other) > size * cleaning.MAX_SHORT_DIGIT_RATIO)
    rows = frame.select(tests["few_letters"].alias("a"), few.alias("b"), tests["mostly_digits"].alias("c"), digits.alias("d"), "line").collect()
    assert all(r["a"] == r["b"] and r["c"] == r["d"] for r in rows) and any(r["a"] for r in rows) and any(r["c"] for r in rows)
    assert any(r["d"] is False for r in rows)
    for number in (1, 2, 3):
        found = frame.select(line.rlike(cleaning._at_least(number, LATIN)).alias("a"), (count_in(line, LATIN) >= number).alias("b")).collect()
        assert all(r["a"] == r["b"] for r in found)
