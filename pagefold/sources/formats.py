"""Reading one file's bytes into page texts: the small format helpers run inside tasks.

Each helper returns ``(parts, method)`` per page. ``parts`` are joined by newlines after the
Spark side has cleaned or rejected them. Only the standard library and pandas are used.
"""

from __future__ import annotations

import io
import re
import zipfile
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd

from pagefold.sources.compound import read_stream
from pagefold.sources.folder import LEGACY_SUFFIXES

Page = tuple[list[str], str]

# Encodings tried in order, and the line that introduces table rows.
TEXT_ENCODINGS = ("utf-8", "utf-8-sig", "cp949", "euc-kr", "latin-1", "ascii")
CSV_ENCODINGS = ("utf-8", "utf-8-sig", "cp949", "euc-kr", "latin-1")
TABLE_MARKER = "[표 데이터]"
SHEET_MARKER = "[시트: {}]"
CELL_SEPARATOR = " | "

# XML namespaces of the office formats.
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


# Cells that pandas prints as they are written, and words that it reads as something else.
_WHOLE = re.compile("0|-?[1-9][0-9]{0,16}")
_PLAIN = re.compile("[A-Za-z]+(?:[ _][A-Za-z]+)*")
_READ_OTHERWISE = frozenset({"na", "nan", "null", "none", "true", "false", "inf", "infinity"})


class Unsupported(Exception):
    """The format needs a component that is not available."""


def read_txt(content: bytes) -> list[Page]:
    for encoding in TEXT_ENCODINGS:
        try:
            text = content.decode(encoding)
        except UnicodeDecodeError:
            continue
        return [([text.replace("\r\n", "\n").replace("\r", "\n")], "txt")]
    raise ValueError("no encoding fits")


def plain_table(content: bytes) -> str | None:
    """A table as pandas prints it, if all its columns are whole numbers or plain words; else null.

    Most small files are such tables, and a frame for each takes many times longer.
    """
    try:
        lines = content.decode("ascii").split("\n")
    except UnicodeDecodeError:
        return None
    if len(lines) < 3 or lines[-1]:
        return None
    rows = [line.split(",") for line in lines[:-1]]
    if len(set(rows[0])) < len(rows[0]) or any(len(row) != len(rows[0]) for row in rows) or not all(map(_PLAIN.fullmatch, rows[0])):
        return None
    columns = []
    for name, *cells in zip(*rows, strict=True):
        if all(map(_WHOLE.fullmatch, cells)):
            name = " " + name  # room for a sign
        elif not all(_PLAIN.fullmatch(c) and c.lower() not in _READ_OTHERWISE for c in cells):
            return None
        width = max(map(len, [name, *cells]))
        columns.append([c.rjust(width) for c in [name, *cells]])
    return "\n".join(map(" ".join, zip(*columns, strict=True)))


def read_csv(content: bytes) -> list[Page]:
    plain = plain_table(content)
    if plain is not None:
        return [([plain], "csv")]
    for encoding in CSV_ENCODINGS:
        try:
            frame = pd.read_csv(io.BytesIO(content), encoding=encoding)
        except Exception:
            continue
        return [([frame.to_string(index=False)], "csv")]
    raise ValueError("no encoding fits")


def _related(archive: zipfile.ZipFile, owner: str) -> dict[str, str]:
    """Relationship ids of a package part and the parts they point to."""
    folder, _, name = owner.rpartition("/")
    root = ElementTree.fromstring(archive.read(f"{folder}/_rels/{name}.rels"))
    targets = {}
    for item in root:
        target = item.get("Target", "")
        targets[item.get("Id")] = target[1:] if target.startswith("/") else f"{folder}/{target}"
    return targets


def _word_text(paragraph: ElementTree.Element) -> str:
    marks = {f"{W}tab": "\t", f"{W}br": "\n", f"{W}cr": "\n"}
    return "".join(
        (node.text or "") if node.tag == f"{W}t" else marks.get(node.tag, "")
        for run in paragraph.iter(f"{W}r")
        for node in run
    )


def _word_row(row: ElementTree.Element) -> list[str]:
    cells = []
    for cell in row.findall(f"{W}tc"):
        text = "\n".join(_word_text(p) for p in cell.findall(f"{W}p")).strip()
        span = cell.find(f"{W}tcPr/{W}gridSpan")
        cells.extend([text] * (int(span.get(f"{W}val", "1")) if span is not None else 1))
    return cells


def read_docx(content: bytes) -> list[Page]:
    """Paragraphs, then a marker line and the rows of all tables."""
    if not zipfile.is_zipfile(io.BytesIO(content)):
        raise Unsupported("legacy Word format")
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{W}body")
    paragraphs = [text for p in body.findall(f"{W}p") if (text := _word_text(p)).strip()]
    rows = [
        line
        for table in body.findall(f"{W}tbl")
        for row in table.findall(f"{W}tr")
        if (line := CELL_SEPARATOR.join(_word_row(row))).strip()
    ]
    text = "\n".join(paragraphs)
    if rows:
        text += "\n\n" + TABLE_MARKER + "\n" + "\n".join(rows)
    return [([text], "docx")]


def read_pptx(content: bytes) -> list[Page]:
    """One page per slide, in the order of the presentation."""
    pages = []
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        owner = "ppt/presentation.xml"
        targets = _related(archive, owner)
        order = ElementTree.fromstring(archive.read(owner)).findall(f"{P}sldIdLst/{P}sldId")
        for slide in order:
            tree = ElementTree.fromstring(archive.read(targets[slide.get(f"{R}id")]))
            texts = []
            for shape in tree.findall(f"{P}cSld/{P}spTree/{P}sp"):
                lines = [
                    "".join(
                        "\v" if node.tag == f"{A}br" else (node.findtext(f"{A}t") or "")
                        for node in paragraph
                        if node.tag in (f"{A}r", f"{A}br", f"{A}fld")
                    )
                    for paragraph in shape.findall(f"{P}txBody/{A}p")
                ]
                texts.append("\n".join(lines).strip())
            pages.append((["\n".join(t for t in texts if t)], "pptx"))
    return pages


# Built-in number formats that show dates or times; day 0 of the serial calendar.
DATE_FORMATS = {*range(14, 23), 45, 46, 47}
EPOCH = datetime(1899, 12, 30)


def _date_styles(archive: zipfile.ZipFile) -> set[int]:
    """Cell styles whose number format shows a date or time."""
    if "xl/styles.xml" not in archive.namelist():
        return set()
    root = ElementTree.fromstring(archive.read("xl/styles.xml"))
    formats = set(DATE_FORMATS)
    for item in root.findall(f"{S}numFmts/{S}numFmt"):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", item.get("formatCode", ""))
        if re.search(r"[dmhysDMHYS]", code):
            formats.add(int(item.get("numFmtId")))
    styles = root.findall(f"{S}cellXfs/{S}xf")
    return {i for i, style in enumerate(styles) if int(style.get("numFmtId", "0")) in formats}


def _number(text: str, is_date: bool) -> str:
    if is_date:
        moment = EPOCH + timedelta(days=float(text))
        return str(moment + timedelta(microseconds=500) if moment.microsecond else moment)
    return str(float(text)) if re.search(r"[.eE]", text) else str(int(text))


def _column(cell: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", cell).group(0):
        number = number * 26 + ord(letter) - ord("A") + 1
    return number


def read_xlsx(content: bytes) -> list[Page]:
    """One page per sheet: a marker line, then the rows with their stored values."""
    pages = []
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        shared = []
        if "xl/sharedStrings.xml" in archive.namelist():
            table = ElementTree.fromstring(archive.read("xl/sharedStrings.xml"))
            shared = [
                "".join(t.text or "" for t in item.findall(f"{S}t") + item.findall(f"{S}r/{S}t"))
                for item in table
            ]
        dates = _date_styles(archive)
        owner = "xl/workbook.xml"
        targets = _related(archive, owner)

        def value(cell: ElementTree.Element) -> str:
            kind, stored = cell.get("t", "n"), cell.findtext(f"{S}v")
            if kind == "inlineStr":
                return "".join(t.text or "" for t in cell.find(f"{S}is").iter(f"{S}t"))
            if stored is None:
                return ""
            if kind == "s":
                return shared[int(stored)]
            if kind == "b":
                return str(stored == "1")
            if kind == "n":
                return _number(stored, int(cell.get("s", "0")) in dates)
            return stored

        for sheet in ElementTree.fromstring(archive.read(owner)).findall(f"{S}sheets/{S}sheet"):
            tree = ElementTree.fromstring(archive.read(targets[sheet.get(f"{R}id")]))
            grid = [
                {_column(c.get("r")): value(c) for c in row.findall(f"{S}c")}
                for row in tree.findall(f"{S}sheetData/{S}row")
            ]
            width = max((max(row) for row in grid if row), default=0)
            lines = (CELL_SEPARATOR.join(row.get(i, "") for i in range(1, width + 1)) for row in grid)
            text = SHEET_MARKER.format(sheet.get("name")) + "\n"
            pages.append(([text + "\n".join(line for line in lines if line.strip())], "xlsx"))
    return pages


def read_hwpx(content: bytes) -> list[Page]:
    """Texts of every section; the Spark side drops implausible sections."""
    sections = []
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for name in archive.namelist():
            if not (name.startswith("Contents/section") and name.endswith(".xml")):
                continue
            try:
                root = ElementTree.fromstring(archive.read(name))
            except ElementTree.ParseError:
                continue
            pieces = (part for node in root.iter() for part in (node.text, node.tail))
            sections.append("\n".join(p.strip() for p in pieces if p and p.strip()))
    return [(sections, "hwpx_xml")]


def read_hwp(content: bytes) -> list[Page]:
    """The preview text of a compound file."""
    data = read_stream(content, "PrvText") or b""
    text = data.decode("utf-16le", errors="ignore").replace("\x00", "")
    return [([text], "hwp_prvtext")]


def unsupported(_: bytes) -> list[Page]:
    raise Unsupported("only its own application can open this format")


READERS = {
    "txt": read_txt,
    "csv": read_csv,
    "docx": read_docx,
    "pptx": read_pptx,
    "xlsx": read_xlsx,
    "hwp": read_hwp,
    "hwpx": read_hwpx,
    **{suffix: unsupported for suffix in LEGACY_SUFFIXES},
}
