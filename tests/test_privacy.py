from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pagefold.backends.base import EntityRecognizer
from pagefold.functions.masks import (
    masks_in,
    protect_masks,
    protected,
    restore_masks,
    restored,
    sentence_batches,
    token_windows,
    windows_of,
)
from pagefold.functions.spans import (
    SPANS,
    accept_labelled,
    contact_spans,
    entity_name,
    findings,
    merge_and_mask,
    merge_spans,
    pattern_spans,
)
from pagefold.operators.privacy import detect, filter_text, findings_by_type
from pagefold.settings import Settings


def merge(spark, cases):
    rows = [(i, [(a, b, "", t, s) for a, b, t, s in case]) for i, case in enumerate(cases)]
    frame = spark.createDataFrame(rows, f"i int, spans {SPANS}")
    out = frame.select("i", merge_spans(F.col("spans")).alias("out")).collect()
    return [[(s["start"], s["end"], s["type"], s["score"]) for s in r["out"]] for r in sorted(out)]


GOLDEN = [
    ([(0, 10, "A", 0.5), (2, 5, "B", 0.9)], [(2, 5, "B", 0.9)]),
    ([(0, 10, "A", 0.9), (2, 5, "B", 0.5)], [(0, 10, "A", 0.9)]),
    ([(0, 10, "A", 0.9), (5, 20, "B", 0.1)], [(5, 20, "B", 0.1)]),
    ([(0, 10, "A", 0.9), (8, 12, "B", 0.99)], [(0, 10, "A", 0.9)]),
    ([(0, 3, "A", 0.5), (3, 6, "B", 0.5)], [(0, 3, "A", 0.5), (3, 6, "B", 0.5)]),
    ([], []),
]


def test_merge_golden(spark):
    assert merge(spark, [c for c, _ in GOLDEN]) == [e for _, e in GOLDEN]


def test_merge_random(spark):
    def resolved(spans):
        kept = []
        for span in sorted(spans, key=lambda s: (s[0], -s[1])):
            rivals = [k for k in kept if k[0] < span[1] and span[0] < k[1]]
            assert len(rivals) <= 1
            if not rivals:
                kept.append(span)
                continue
            inside = span[1] <= rivals[0][1]
            weights = [x[3] if inside else x[1] - x[0] for x in (span, rivals[0])]
            if weights[0] > weights[1]:
                kept[kept.index(rivals[0])] = span
        return kept

    rng = random.Random(2)
    cases = []
    for _ in range(300):
        case = []
        for j in range(rng.randint(0, 9)):
            start = rng.randint(0, 30)
            case.append((start, start + rng.randint(1, 12), f"T{j}", rng.choice((0.5, 0.7, 0.9))))
        cases.append(case)
    assert merge(spark, cases) == [resolved(c) for c in cases]


def test_mask_and_findings(spark):
    spans = [(0, 3, "abc", "A", 0.5), (5, 7, "fg", "B", 0.9)]
    frame = spark.createDataFrame([("abcdefgh", spans), ("xyz", [])], f"text string, spans {SPANS}")
    rows = frame.select(merge_and_mask(F.col("text"), F.col("spans"))["text"].alias("m"), findings(F.col("spans")).alias("f")).collect()
    assert [r["m"] for r in rows] == ["[A]de[B]h", "xyz"]
    assert [(f["type"], f["count"], f["examples"], f["avg_confidence"]) for f in rows[0]["f"]] == [
        ("A", 1, ["abc"], 0.5), ("B", 1, ["fg"], 0.9),
    ]


def test_contact_offsets(column):
    text = "가 a.b@c.org, 9010-1234-5678 010-1234-5678 x@y +82 10-1234-5678."
    found = column(contact_spans, [text])[0]
    assert all(text[s["start"] : s["end"]] == s["text"] for s in found)
    assert [s["text"] for s in found][0] == "a.b@c.org"
    assert "010-1234-5678" in [s["text"] for s in found]


def test_telephone_numbers(column):
    """Numbers as people write them; cards, addresses and dates stay out."""
    numbers = ["+1 (521) 555-2373", "(02) 555-2373", "1 (800)555-1234", "010-1234-5678", "+82 10-1234-5678", "02.123.4567"]
    other = ["4111 1111 1111 1111", "4111-1111-1111-1111", "97.51.17.173", "2024-01-02", "4111111111111111", "(521)"]
    for number in numbers:
        found = column(contact_spans, [f"call {number}, or {number} now"])[0]
        assert [s["text"] for s in found] == [number] * 2, number
    assert all(not found for found in column(contact_spans, [f"see {x} there" for x in other]))
    assert len(column(contact_spans, ["010-1234-5678 010-1234-5679"])[0]) == 2


@pytest.mark.parametrize("make", ["spans", "masks", "batches"])
def test_work_grows_with_the_text(spark, make):
    """Twice the text takes about twice the time; a quadratic step would take four times."""
    import time

    def run(n):
        text = {"spans": "n1 word ", "masks": "[A] word ", "batches": "Some words here. "}[make] * n
        frame = spark.createDataFrame([(text,)], "text string")
        t = F.col("text")
        if make == "spans":
            frame = frame.withColumn("s", pattern_spans(t, "n[0-9]", "N", 0.5))
            out = merge_and_mask(t, F.col("s"))["text"]
        elif make == "masks":
            out = restore_masks(protect_masks(t), masks_in(t))
        else:
            out = F.size(sentence_batches(t)).cast("string")
        start = time.perf_counter()
        frame.select(F.length(out)).collect()
        return time.perf_counter() - start

    run(100)
    small, large = min(run(20_000) for _ in range(2)), min(run(80_000) for _ in range(2))
    assert large < 8 * small + 1


def test_names(column):
    assert column(entity_name, ["PS", "lc", "XX", "Org"]) == ["PERSON", "LOCATION", "XX", "ORGANIZATION"]


def test_labelled(spark):
    raw = [
        (0, 4, "1234", "사번", 0.9), (5, 7, "A1", "사번", 0.9), (8, 12, "A123", "사번", 0.9),
        (13, 15, "과장", "직함", 0.8), (16, 18, "부장", "직급", 0.4), (20, 22, "x", "기타", 0.9),
    ]
    frame = spark.createDataFrame([(raw,)], f"raw {SPANS}")
    out = frame.select(accept_labelled(F.col("raw"), 0.5).alias("o")).first()["o"]
    assert [(s["text"], s["type"]) for s in out] == [("A123", "사번"), ("과장", "직급")]


def numbers():
    class Numbers(EntityRecognizer):
        def recognize(self, texts):
            import re

            return [
                [(m.start(), m.end(), "##" + m.group(), "qt", 0.9) for m in re.finditer(r"\d+", t)]
                + [(0, 1, t[:1], "PS", 0.3)]
                for t in texts
            ]

    return Numbers()


def test_detectors(spark):
    frame = spark.createDataFrame([(0, "room 12 and 345 a@b.org"), (1, ""), (2, None)], "id int, text string")
    rows = {r["id"]: r for r in filter_text(frame, entities=numbers()).collect()}
    assert rows[0]["filtered_text"] == "room 12 and [QUANTITY] [EMAIL_ADDRESS]"
    assert rows[0]["detection_methods"] == ["presidio", "klue_ner_model"]
    assert rows[1]["filtered_text"] == "" and not rows[1]["changes_made"]
    assert rows[2]["filtered_text"] == ""
    kept = detect(frame, Settings(keep_small_numbers=True), entities=numbers()).where("id = 0").first()
    assert [s["text"] for s in kept["spans"]] == ["12", "345", "a@b.org"]


def test_findings_over_a_collection(spark):
    rows = [(i, [(0, 1, f"v{i}", "HOT", 0.5)]) for i in range(50)] + [(99, [(0, 1, "w", "RARE", 1.0)])]
    frame = spark.createDataFrame(rows, f"id int, spans {SPANS}")
    out = {r["type"]: r for r in findings_by_type(frame, ["id"]).collect()}
    assert out["HOT"]["count"] == 50 and out["HOT"]["examples"] == [f"v{i}" for i in range(5)]
    assert out["RARE"]["count"] == 1 and out["RARE"]["avg_confidence"] == 1.0


@pytest.mark.parametrize("text", ["[A] x [가나_B] [a] []", "none", "[A][A]", ""])
def test_masks(column, text):
    protected = column(protect_masks, [text])[0]
    assert "[A]" not in protected
    assert column(lambda c: restore_masks(protect_masks(c), masks_in(c)), [text]) == [text]


def test_token_windows(spark):
    frame = spark.createDataFrame([([str(i) for i in range(n)],) for n in (0, 1, 448, 449, 900)], "t array<string>")
    out = [r["w"] for r in frame.select(token_windows(F.col("t")).alias("w")).collect()]
    assert [len(w) for w in out] == [0, 1, 1, 2, 3]
    assert out[3][1][0] == "384" and out[4][2][-1] == "899"


def test_sentence_batches(column):
    import re

    def expected(text):
        parts, batch, at = [], "", 0
        for mark in [*re.finditer(r"[.!?]\s+|\n\n", text), None]:
            piece = text[at : mark.start() if mark else None].strip()
            if piece and batch and len(batch) + len(piece) > 300:
                parts.append((batch, True))
                batch = ""
            batch = " ".join(filter(None, (batch, piece)))
            if mark:
                parts.append((mark.group(), False))
                at = mark.end()
        return parts + [(batch, True)] * bool(batch)

    rng = random.Random(4)
    texts = [
        "".join(rng.choice(["w" * rng.randint(1, 320), ". ", "\n\n", "! ", " "]) for _ in range(15))
        for _ in range(60)
    ] + ["", "a", ". "]
    for text, parts in zip(texts, column(sentence_batches, texts)):
        assert [(p["text"], p["correct"]) for p in parts] == expected(text)


def test_many_spans_in_one_text(spark):
    """Offsets are placed block by block; the result must not show it."""
    from pagefold.functions.spans import BLOCK, pattern_spans

    text = "가 " + " ".join(f"n{i} word{i}" for i in range(5 * BLOCK))
    frame = spark.createDataFrame([(text,), ("n1 x",), ("none",)], "text string").withColumn(
        "spans", pattern_spans(F.col("text"), r"n[0-9]+", "N", 0.5)
    )
    rows = frame.withColumn("out", merge_and_mask(F.col("text"), F.col("spans"))).select(
        "text", F.col("out.spans").alias("merged"), F.col("out.text").alias("masked")
    ).collect()
    assert [len(r["merged"]) for r in rows] == [5 * BLOCK, 1, 0]
    assert all(r["text"][s["start"] : s["end"]] == s["text"] for r in rows for s in r["merged"])
    assert rows[0]["masked"] == "가 " + " ".join(f"[N] word{i}" for i in range(5 * BLOCK))
    assert [r["masked"] for r in rows[1:]] == ["[N] x", "none"]
    rng = random.Random(9)
    case = []
    for j in range(6 * BLOCK):
        start = rng.randint(0, 3000)
        case.append((start, start + rng.randint(1, 12), f"T{j}", rng.choice((0.5, 0.7, 0.9))))
    (long,) = merge(spark, [case])
    # The same spans in runs that touch nothing outside: cut where nothing overlaps.
    ordered, runs, high = sorted(case, key=lambda s: (s[0], -s[1])), [], -1
    for span in ordered:
        if span[0] >= high:
            runs.append([])
        runs[-1].append(span)
        high = max(high, span[1])
    assert long == [s for out in merge(spark, runs) for s in out]


def test_windows_and_masks_need_no_python(spark):
    """As the helpers for single texts, over odd texts, and without a step that holds a batch of texts in Python."""
    rng = random.Random(3)
    texts = ["", None, "[PS]", "[PS][LC] a [OG]", "<KEEP_0> [PS] <KEEP_7> <KEEP_99999999999> <KEEP_01>", "[ps] [가_] [A B] $1 \\1"]
    texts += ["".join(rng.choice(["[PS]", "<KEEP_1>", "<KEEP_0>", " ", "가", "\n", "[", "]"]) for _ in range(30)) for _ in range(40)]
    tokens = [None, [], *[[f"t{i}" for i in range(n)] for n in (1, 3, 4, 5, 6, 7, 40)]]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    masked = frame.select("text", masks_in(F.col("text")).alias("masks"), protect_masks(F.col("text")).alias("kept"))
    out = masked.select("*", restore_masks(F.col("kept"), F.col("masks")).alias("back"))
    for r in out.collect():
        want = (None, None) if r["text"] is None else protected(r["text"])
        assert (r["kept"], r["back"]) == (want[0], None if r["text"] is None else restored(*want))
    cut = spark.createDataFrame([(t,) for t in tokens], "t array<string>").select("t", token_windows(F.col("t"), 5, 2).alias("w"))
    for r in cut.collect():
        assert r["w"] == (None if r["t"] is None else windows_of(r["t"], 5, 2))
    for plan in (out, cut):
        assert "Python" not in plan._jdf.queryExecution().toString()
