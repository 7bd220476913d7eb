from __future__ import annotations

from pyspark.sql import functions as F

from pagefold.functions.language import guess_language, is_plausible_hangul
from pagefold.functions.metadata import (
    author,
    date_text,
    department,
    document_type,
    title,
    with_metadata,
)
from pagefold.functions.structure import structure_items, structure_types
from pagefold.functions.text import preview


def test_fields(column):
    assert column(title, ["회의록\n2025", "보고합니다.", " 제목 ", "\n본문", "x" * 100, "뭐？"]) == [
        "회의록", None, "제목", None, None, "뭐？",
    ]
    dates = ["회의록\n2025년 1월 15일", "2025-01-15", "2025. 1. 15", "2025/1/5", "25-1-1"]
    assert column(date_text, dates) == ["2025년 1월 15", "2025-01-15", "2025. 1. 15", "2025/1/5", None]
    assert column(department, ["소속: 개발팀", "결과", "부서 ： 회계부", "abc"]) == ["개발팀", "결과", "회계부", None]
    names = ["작성자: 홍길동 대리", "담당자 김철수", "기안자：이영희  팀원", "홍길동"]
    assert column(author, names) == ["홍길동 대리", "김철수", "이영희 팀원", None]
    kinds = ["주간 미팅", "의뢰서", "결과 보고", "제안서", "결재", "x" * 200 + "회의록", "승인된 회의록"]
    assert column(document_type, kinds) == ["회의록", "요청서", "보고서", "계획서", "승인문서", None, "회의록"]


def test_map(spark):
    frame = spark.createDataFrame([("회의록\n2025년 1월 15일",), ("x.",)], "text string")
    maps = [r["metadata"] for r in with_metadata(frame, F.col("text")).collect()]
    assert maps == [{"title": "회의록", "date": "2025년 1월 15", "doc_type": "회의록"}, None]


def test_structure(column):
    text = "가. 제목\n\n[공지]\n1. item\n1. 항목\nx | y\n- x\n했습니다. 그리고\n• 점\n일반"
    found = [(s["line"], s["type"]) for s in column(structure_items, [text])[0]]
    assert found == [
        (0, "heading"), (2, "heading"), (3, "list"), (4, "heading"), (4, "list"), (5, "table"),
        (6, "list"), (7, "heading"), (8, "list"),
    ]
    assert column(structure_types, [text, "일반", "- a"]) == [["heading", "list", "table"], None, ["list"]]


def test_language_and_validity(column):
    assert column(guess_language, ["안녕하세요", "hello", "こんにちは", "", "123"]) == ["ko", "en", "ja", "ko", "ko"]
    values = ["가나다라마바사아자차", "hello wor", "hello world", "é" * 12, None, "ऀ" * 40 + "가나다", "\x01" * 30]
    assert column(is_plausible_hangul, values) == [True, False, True, False, False, True, False]


def test_preview(column):
    assert column(preview, ["가" * 150, "ab"]) == ["가" * 100 + "...", "ab..."]
