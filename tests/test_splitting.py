from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from pagefold.functions.recursive import SEPARATORS, recursive_chunks, split_recursive
from pagefold.functions.splitting import fixed_windows, merge_sentences, sentences
from pagefold.operators.chunking import split_pages
from pagefold.settings import Settings
from pagefold.sources.loading import table_pages


def test_sentences(column):
    values = ["A b. C d! E?! F", "x.y z. ", "... foo", "한다。 다음！ 끝", "no punct", " \n ", "a.　b"]
    assert column(sentences, values) == [
        ["A b.", "C d!", "E?!", "F"],
        ["x.y z."],
        ["...", "foo"],
        ["한다。", "다음！", "끝"],
        ["no punct"],
        [],
        ["a.", "b"],
    ]


@pytest.mark.parametrize("length,count", [(1, 1), (500, 1), (501, 2), (900, 2), (901, 3), (1300, 3)])
def test_fixed_window_counts(column, length, count):
    assert len(column(lambda c: fixed_windows(c, 500, 100), ["가" * length])[0]) == count


def test_fixed_windows_tile_the_text(column):
    rng = random.Random(3)
    for size, overlap in ((7, 3), (5, 0), (10, 9), (4, 1)):
        texts = ["".join(rng.choice("ab\n가😀") for _ in range(n)) for n in range(1, 60)]
        for text, windows in zip(texts, column(lambda c: fixed_windows(c, size, overlap), texts)):
            step = size - overlap
            count = max(math.ceil((len(text) - size) / step), 0) + 1
            assert windows == [text[i * step : i * step + size] for i in range(count)]


def test_overlap_must_be_smaller():
    with pytest.raises(ValueError):
        Settings(chunk_size=100, chunk_overlap=100)


def merged(parts: list[str], size: int, overlap: int) -> list[str]:
    chunks, now = [], []
    for part in parts:
        if now and sum(map(len, now)) + len(part) > size:
            chunks.append(" ".join(now))
            keep = 0
            while keep < len(now) and sum(len(x) for x in now[len(now) - keep - 1 :]) <= overlap:
                keep += 1
            now = now[len(now) - keep :] if keep else []
        now.append(part)
    return chunks + ([" ".join(now)] if now else [])


def test_merge(spark):
    rng = random.Random(5)
    cases = [[300, 150, 60, 40], [300, 90, 200], [700], [480, 20, 490], [60, 700], []]
    cases += [[rng.choice((10, 60, 99, 100, 101, 300, 520)) for _ in range(rng.randint(1, 25))] for _ in range(200)]
    rows = [(i, [chr(97 + j % 26) * n for j, n in enumerate(case)]) for i, case in enumerate(cases)]
    frame = spark.createDataFrame(rows, "i int, parts array<string>")
    out = frame.select("i", merge_sentences(F.col("parts"), 500, 100).alias("out")).collect()
    for row in out:
        assert row["out"] == merged(rows[row["i"]][1], 500, 100)


def test_recursive_properties(column):
    rng = random.Random(11)
    words = ["alpha", "be", "긴단어", "long", "end.", "why?", "so,", "\n", "\n\n", "다。"]

    # Numbered words and long runs without repetition: every chunk occurs once in its text.
    def word(i):
        run = "".join(chr(0x4E00 + 70 * i + j) for j in range(70))
        return f"{i}{rng.choice(words)}".replace("long", run)

    texts = [" ".join(word(i) for i in range(rng.randint(1, 80))) for _ in range(150)]
    size, overlap = 50, 12
    for text, chunks in zip(texts, column(lambda c: recursive_chunks(c, size, overlap), texts)):
        assert chunks == split_recursive(text, size, overlap)
        assert all(0 < len(c) <= size and c == c.strip() and c in text for c in chunks)
        # Chunks follow each other, and only whitespace may lie between the end of one and the
        # start of the next.
        last, end = -1, 0
        for chunk in chunks:
            reach = end + len(text[end:]) - len(text[end:].lstrip())
            start = text.rfind(chunk, last + 1, reach + len(chunk))
            assert last < start <= reach
            last, end = start, start + len(chunk)
        assert not text[end:].strip()


def test_recursive_known_cases():
    assert split_recursive("aaaa bbbb cccc", 9, 0) == ["aaaa", "bbbb", "cccc"] or split_recursive(
        "aaaa bbbb cccc", 9, 0
    ) == ["aaaa bbbb", "cccc"]
    assert split_recursive("one\n\ntwo\n\nthree", 8, 0) == ["one\n\ntwo", "three"]
    assert split_recursive("abcdefghij", 4, 2) == ["abcd", "cdef", "efgh", "ghij"]
    assert split_recursive("short", 50, 10) == ["short"]
    assert SEPARATORS[-1] == ""


def pages_frame(spark, pages):
    frame = spark.createDataFrame(pages, "doc string, page int, text string")
    return table_pages(frame, F.col("doc"), F.col("page"))


def test_numbering_is_the_same_for_every_layout(spark):
    rng = random.Random(1)
    # One document holds most pages.
    pages = [("hot", p, "x" * rng.choice((0, 10, 30, 95))) for p in range(1, 120)]
    pages += [(f"d{i}", p, "y" * rng.randint(0, 60)) for i in range(20) for p in (1, 2)]
    base = Settings(chunk_size=20, chunk_overlap=5, strategy="basic")
    frame = pages_frame(spark, pages)
    results = []
    for settings, bound in (
        (base, None),
        (base.with_(pages_per_block=7), None),
        (base.with_(pages_per_block=1), None),
        (base, 500),
    ):
        rows = split_pages(frame, settings, bound).collect()
        results.append(sorted((r["source_file"], r["chunk_id"], r["page_num"], r["text"]) for r in rows))
        for doc in {r["source_file"] for r in rows}:
            mine = sorted((r["chunk_id"], r["page_num"]) for r in rows if r["source_file"] == doc)
            assert [c for c, _ in mine] == list(range(len(mine)))
            assert [p for _, p in mine] == sorted(p for _, p in mine)
    assert all(result == results[0] for result in results)


def test_single_page_documents_need_no_shuffle(spark):
    frame = pages_frame(spark, [("a", 1, "x" * 1300), ("b", 1, "  ")])
    chunks = split_pages(frame, Settings(strategy="basic"), max_pages=1)
    assert "Exchange" not in chunks._jdf.queryExecution().executedPlan().toString()
    rows = {(r["source_file"], r["chunk_id"]): r for r in chunks.collect()}
    assert len(rows) == 4
    blank = rows[("b", 0)]
    assert (blank["text"], blank["char_count"], blank["warning"]) == ("", 0, "no_text")


def test_strategies_name_their_method(spark):
    frame = pages_frame(spark, [("a", 1, "회의록\n1. 안건\n내용은 다음과 같다. 끝.")])
    names = {"semantic": "semantic", "recursive": "langchain", "basic": "basic"}
    for strategy, name in names.items():
        row = split_pages(frame, Settings(strategy=strategy)).collect()[0]
        assert row["split_method"] == name
        assert (row["metadata"] is not None) == (strategy == "semantic")
    row = split_pages(frame, Settings()).collect()[0]
    assert row["language"] == "ko" and row["metadata"]["doc_type"] == "회의록"
    assert row["has_structure"] and row["structure_types"] == ["heading", "list"]


def test_model_backends_for_sentences_and_language(spark):
    from pagefold.backends.base import LanguageDetector, SentenceSplitter

    class Lines(SentenceSplitter):
        def split(self, texts, languages):
            return [[f"{lang}:{x}" for x in t.split("\n") if x] for t, lang in zip(texts, languages)]

    class French(LanguageDetector):
        def detect(self, texts):
            return ["en" if "e" in t else "fr" for t in texts]

    frame = pages_frame(spark, [("a", 1, "one\ntwo"), ("b", 1, "xx"), ("c", 1, " ")])
    rows = split_pages(frame, Settings(), splitter=Lines(), detector=French()).collect()
    found = {r["source_file"]: (r["language"], r["text"]) for r in rows}
    assert found == {"a": ("en", "en:one en:two"), "b": ("ko", "ko:xx"), "c": (None, "")}
