"""Inputs that Spark derives from the given tables, for formats and scripts they lack."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagefold.session import spread
from pagefold.sources.formats import A, P, R, S, W
from pagefold.sources.tables import load_table

# Files that a worker packs before it passes them on.
_FILES = 100

# One Korean memo per order, written in SQL that both engines read alike.
MEMO_SQL = """
    concat(
      CASE o_orderpriority WHEN '1-URGENT' THEN '승인 요청 문서' WHEN '2-HIGH' THEN '주간 회의록'
        WHEN '3-MEDIUM' THEN '진행 보고 내용.' WHEN '4-NOT SPECIFIED' THEN '신규 계획서'
        ELSE '일반 안내' END, chr(10),
      '작성일: ', CAST(year(o_orderdate) AS STRING), '년 ',
      CAST(month(o_orderdate) AS STRING), '월 ', CAST(day(o_orderdate) AS STRING), '일', chr(10),
      CASE o_orderstatus WHEN 'O' THEN '소속: 개발팀' WHEN 'F' THEN '검토 결과' ELSE '부서 ： 영업부' END, chr(10),
      CASE o_orderstatus WHEN 'P' THEN '담당자 ' ELSE '작성자: ' END,
      translate(CAST(o_custkey AS STRING), '0123456789', '김이박최정강조윤장임'),
      CASE o_orderstatus WHEN 'O' THEN ' 대리' WHEN 'F' THEN '  과장' ELSE '' END, chr(10), chr(10),
      '1. 금액 안내', chr(10),
      '금액 | ', CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING), ' | 원', chr(10),
      '- 고객 ', CAST(o_custkey AS STRING), ' 확인했습니다. 다음 단계로 진행합니다！ 끝', chr(10),
      '[', translate(o_orderpriority, '-', ' '), ']', chr(10),
      '-----', chr(10), '*** ㅁㅁ', chr(10), '가', chr(10),
      '.....a1.....', chr(10), 'ㅁㅁ 보고서 자료 ㅏㅏ', chr(10),
      '2) 처리', chr(9), chr(9), '상태 ', o_orderstatus
    )
"""


def memos(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders")
    return spread(orders).select(
        F.col("o_orderkey").alias("memo_id"), F.expr(MEMO_SQL).alias("text")
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(load_table(spark, folder, "documents"))


def text_files(spark: SparkSession, folder: str) -> DataFrame:
    """A text file per document, as a folder scan would return it."""
    return documents(spark, folder).select(
        F.concat(F.lit("raw/doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
        F.encode("text", "UTF-8").alias("content"),
    )


def csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """A one-row table file per customer."""
    customers = spread(load_table(spark, folder, "customer"))
    return customers.select(
        F.concat(F.lit("raw/c_"), F.col("c_custkey").cast("string"), F.lit(".CSV")).alias("path"),
        F.encode(
            F.concat(
                F.lit("customer,nation,segment\n"),
                F.concat_ws(",", F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string"), "c_mktsegment"),
                F.lit("\n"),
            ),
            "UTF-8",
        ).alias("content"),
    )


def _package(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in parts.items():
            archive.writestr(name, body)
    return out.getvalue()


def _ns(uri: str) -> str:
    return uri.strip("{}")


def _related(targets: dict[str, str]) -> str:
    items = "".join(f'<Relationship Id="{k}" Target="{v}"/>' for k, v in targets.items())
    return f"<Relationships>{items}</Relationships>"


def word_file(paragraphs: list[str], rows: list[list[str]]) -> bytes:
    body = "".join(f"<w:p><w:r><w:t>{escape(p)}</w:t></w:r></w:p>" for p in paragraphs)
    table = "".join(
        "<w:tr>" + "".join(f"<w:tc><w:p><w:r><w:t>{escape(c)}</w:t></w:r></w:p></w:tc>" for c in row) + "</w:tr>"
        for row in rows
    )
    xml = f'<w:document xmlns:w="{_ns(W)}"><w:body>{body}<w:tbl>{table}</w:tbl></w:body></w:document>'
    return _package({"word/document.xml": xml})


def slide_file(slides: list[list[str]]) -> bytes:
    names = f'xmlns:p="{_ns(P)}" xmlns:a="{_ns(A)}" xmlns:r="{_ns(R)}"'
    order = "".join(f'<p:sldId id="{i}" r:id="r{i}"/>' for i in range(len(slides)))
    parts = {
        "ppt/presentation.xml": f"<p:presentation {names}><p:sldIdLst>{order}</p:sldIdLst></p:presentation>",
        "ppt/_rels/presentation.xml.rels": _related(
            {f"r{i}": f"slides/s{i}.xml" for i in range(len(slides))}
        ),
    }
    for i, texts in enumerate(slides):
        shapes = "".join(
            f"<p:sp><p:txBody><a:p><a:r><a:t>{escape(t)}</a:t></a:r></a:p></p:txBody></p:sp>" for t in texts
        )
        parts[f"ppt/slides/s{i}.xml"] = (
            f"<p:sld {names}><p:cSld><p:spTree>{shapes}</p:spTree></p:cSld></p:sld>"
        )
    return _package(parts)


def sheet_file(sheets: dict[str, list[list[str | int | None]]]) -> bytes:
    names = f'xmlns="{_ns(S)}" xmlns:r="{_ns(R)}"'

    def cell(row: int, column: int, value: str | int | None) -> str:
        at = f"{chr(65 + column)}{row}"
        if value is None:
            return ""
        if isinstance(value, int):
            return f'<c r="{at}"><v>{value}</v></c>'
        return f'<c r="{at}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'

    listed = "".join(
        f'<sheet name="{escape(name)}" sheetId="{i}" r:id="r{i}"/>' for i, name in enumerate(sheets)
    )
    parts = {
        "xl/workbook.xml": f"<workbook {names}><sheets>{listed}</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": _related({f"r{i}": f"sheet{i}.xml" for i in range(len(sheets))}),
    }
    for i, rows in enumerate(sheets.values()):
        data = "".join(
            f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row)) + "</row>"
            for r, row in enumerate(rows, 1)
        )
        parts[f"xl/sheet{i}.xml"] = f"<worksheet {names}><sheetData>{data}</sheetData></worksheet>"
    return _package(parts)


def office_files(spark: SparkSession, folder: str) -> DataFrame:
    """An office file per document: the language decides between the three formats."""

    def file(doc_id: int, lang: str, text: str) -> bytes:
        lines = text.split("\n")
        if lang == "en":
            return word_file(lines, [["document", str(doc_id)]])
        if lang == "fr":
            return slide_file([[f"document {doc_id}"], lines])
        return sheet_file({"index": [["document", doc_id]], lang: [[x, None] for x in lines]})

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _FILES):
                piece = batch.slice(at, _FILES)
                paths, *given = piece.columns
                made = [file(*[v.as_py() for v in row]) for row in zip(*given, strict=True)]
                yield pa.RecordBatch.from_arrays([paths, pa.array(made, pa.binary())], names=["path", "content"])

    suffix = F.when(F.col("lang") == "en", ".docx").when(F.col("lang") == "fr", ".pptx").otherwise(".xlsx")
    path = F.concat(F.lit("raw/doc_"), F.col("doc_id").cast("string"), suffix)
    return documents(spark, folder).select(path.alias("path"), "doc_id", "lang", "text").mapInArrow(build, "path string, content binary")
