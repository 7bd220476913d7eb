"""Document metadata read from page text: title, date, department, author, type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold.functions.text import UNICODE_SPACE, strip

MAX_TITLE_CHARS = 100
DOC_TYPE_SCOPE = 200
# Only the space class needs the Unicode flag; over a whole pattern it slows every literal.
_SP = f"(?U:{UNICODE_SPACE[4:]}*)"

# Endings that rule a first line out as a title.
TITLE_STOPS = (".", "。", "?", "!")
# What a date, a department and an author look like.
DATE_PATTERN = rf"\p{{Nd}}{{4}}[-년./]{_SP}\p{{Nd}}{{1,2}}[-월./]{_SP}\p{{Nd}}{{1,2}}"
LABELLED_DEPARTMENT = rf"(소속|부서|팀){_SP}[:：]?{_SP}([가-힣]+(?:팀|부|과|센터))"
BARE_DEPARTMENT = r"([가-힣]+(?:팀|부|과|센터))"
AUTHOR = (
    rf"(작성자|기안자|담당자){_SP}[:：]?{_SP}([가-힣]{{2,4}}){_SP}"
    r"(팀원|대리|과장|차장|부장|이사)?"
)
# Document types and the words that show them, in order of precedence.
DOC_TYPES = {
    "회의록": ("회의록", "미팅", "회의"),
    "요청서": ("요청서", "신청서", "의뢰서"),
    "보고서": ("보고서", "결과 보고", "진행 보고"),
    "계획서": ("계획서", "기획서", "제안서"),
    "승인문서": ("승인", "결재", "기안"),
}


def _found(col: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def title(text: Column) -> Column:
    """First line, when it is short, not blank and does not end like a sentence."""
    line = strip(F.substring_index(text, "\n", 1))
    ends = F.lit(False)
    for stop in TITLE_STOPS:
        ends = ends | F.endswith(line, F.lit(stop))
    size = F.length(line)
    return F.when((size > 0) & (size < MAX_TITLE_CHARS) & ~ends, line)


def date_text(text: Column) -> Column:
    """First date, as it is written; never parsed."""
    return _found(text, DATE_PATTERN, 0)


def department(text: Column) -> Column:
    """Labelled department, else the first Hangul run that ends like one."""
    return F.coalesce(_found(text, LABELLED_DEPARTMENT, 2), _found(text, BARE_DEPARTMENT, 1))


def author(text: Column) -> Column:
    """Labelled name, with the rank when one follows."""
    found = F.regexp_extract(text, AUTHOR, 0)
    name = _found(found, AUTHOR, 2)
    return F.when(F.length(found) > 0, F.concat_ws(" ", name, _found(found, AUTHOR, 3)))


def document_type(text: Column) -> Column:
    """First type with a keyword in the opening characters."""
    head = F.substring(text, 1, DOC_TYPE_SCOPE)
    chosen = None
    for name, words in DOC_TYPES.items():
        hit = F.contains(head, F.lit(words[0]))
        for word in words[1:]:
            hit = hit | F.contains(head, F.lit(word))
        chosen = F.when(hit, name) if chosen is None else chosen.when(hit, name)
    return chosen


def field_spans(text: Column) -> Column:
    """Where date (``DT``), department (``OG``) and author's name (``PS``) stand first: ``start, end, label`` each.

    Labels that need no reader, to fit a recogniser on.
    """
    name = _found(F.regexp_extract(text, AUTHOR, 0), AUTHOR, 2)
    spans = []
    for label, value in (("DT", date_text(text)), ("OG", department(text)), ("PS", name)):
        start = F.instr(text, value) - 1
        spans.append(
            F.when(
                F.coalesce(F.length(value), F.lit(0)) > 0,
                F.struct(start.alias("start"), (start + F.length(value)).alias("end"), F.lit(label).alias("label")),
            )
        )
    return F.array_compact(F.array(*spans))


FIELDS = {
    "title": title,
    "date": date_text,
    "department": department,
    "author": author,
    "doc_type": document_type,
}


def with_metadata(df: DataFrame, text: Column, name: str = "metadata") -> DataFrame:
    """Add a map of the fields found; null when there is none.

    The fields are columns of their own first, where generated code shares their common parts;
    inside the map functions they would be interpreted one by one.
    """
    staged = df.select("*", *[field(text).alias(f"_{key}") for key, field in FIELDS.items()])
    columns = {key: F.col(f"_{key}") for key in FIELDS}
    entries = F.array_compact(
        F.array(
            *[
                F.when(value.isNotNull(), F.struct(F.lit(key).alias("key"), value.alias("value")))
                for key, value in columns.items()
            ]
        )
    )
    some = F.coalesce(*columns.values()).isNotNull()
    found = F.when(some, F.map_from_entries(entries))
    return staged.withColumn(name, found).drop(*[f"_{key}" for key in FIELDS])
