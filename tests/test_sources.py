from __future__ import annotations

import io
import random
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pagefold.backends.base import DocumentParser, ImageReader, PdfReader
from pagefold.plans.derived import sheet_file, slide_file, word_file
from pagefold.sources import formats, loading
from pagefold.sources.folder import loader_of, scan_folder, suffix_of
from pagefold.sources.formats import (
    Unsupported,
    read_csv,
    read_docx,
    read_hwpx,
    read_pptx,
    read_txt,
    read_xlsx,
)
from pagefold.sources.loading import load_html, load_pages, preview_is_enough, reparse_short_previews
from pagefold.sources.questions import dialogue
from pagefold.sources.scanned import Recognition


def test_suffix_and_loader(column):
    paths = ["a/b.TXT", "a/.txt", "a/b.tar.xlsx", "b", "x.JPEG", "a.b/c", "y.hwpx", "z.exe"]
    assert column(suffix_of, paths) == [".TXT", "", ".xlsx", "", ".JPEG", "", ".hwpx", ".exe"]
    assert column(lambda c: loader_of(suffix_of(c)), paths) == [
        "txt", None, "xlsx", None, "image", None, "hwpx", None,
    ]


@pytest.mark.parametrize(
    "content,text",
    [
        ("가나\r\n다\r라".encode(), "가나\n다\n라"),
        (b"\xef\xbb\xbfabc", "﻿abc"),
        ("한글 문서".encode("cp949"), "한글 문서"),
        (b"\xff\xfea", "\xff\xfea"),
        (b"", ""),
    ],
)
def test_txt(content, text):
    assert read_txt(content) == [([text], "txt")]


def test_csv():
    (parts, method), = read_csv("이름,값\n가,1.5\n나,2.25\n".encode("cp949"))
    assert method == "csv"
    assert [line.split() for line in parts[0].split("\n")] == [["이름", "값"], ["가", "1.50"], ["나", "2.25"]]
    with pytest.raises(ValueError):
        read_csv(b"")


def test_office():
    word = word_file(["첫 문단", "  ", "둘째 & 문단"], [["a", "b"], ["", ""]])
    assert read_docx(word)[0][0] == ["첫 문단\n둘째 & 문단\n\n[표 데이터]\na | b\n | "]
    with pytest.raises(Unsupported):
        read_docx(b"\xd0\xcf\x11\xe0 old")
    slides = read_pptx(slide_file([["제목", " "], [], ["a", "b"]]))
    assert [p for p, _ in slides] == [["제목"], [""], ["a\nb"]]
    sheets = read_xlsx(sheet_file({"첫": [["a", 1, None], [None, None, "x"]], "빈": []}))
    assert [p for p, _ in sheets] == [["[시트: 첫]\na | 1 | \n |  | x"], ["[시트: 빈]\n"]]


def hwpx(*sections: str) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for i, body in enumerate(sections):
            archive.writestr(f"Contents/section{i}.xml", body)
        archive.writestr("Contents/header.xml", "<h>no</h>")
    return out.getvalue()


def test_hwpx(spark):
    content = hwpx("<s><p>가나다라 마바사 아자차</p> 꼬리말입니다 <q/></s>", "<s>\x7f</s>", "<broken")
    assert read_hwpx(content)[0][0][0] == "가나다라 마바사 아자차\n꼬리말입니다"
    files = spark.createDataFrame([("a/x.hwpx", content), ("a/y.hwpx", hwpx("<s>짧음</s>"))], "path string, content binary")
    rows = {r["source_file"]: r for r in load_pages(files).collect()}
    assert rows["x.hwpx"]["text"] == "가나다라 마바사 아자차\n꼬리말입니다"
    assert rows["x.hwpx"]["method"] == "hwpx_xml"
    assert rows["y.hwpx"]["status"] == "failed: no text" and rows["y.hwpx"]["page_num"] is None


def recognition(parsed=(), broken=False):
    class Pdf(PdfReader):
        """Pages are separated by form feeds."""

        def page_texts(self, content):
            if broken:
                raise ValueError("damaged")
            return content.decode().split("\f")

        def page_count(self, content):
            return len(content.decode().split("\f"))

        def page_image(self, content, page, dpi):
            return content.decode().split("\f")[page - 1].encode()

    class Image(ImageReader):
        def read(self, image):
            if b"unreadable" in image:
                raise ValueError("no text")
            return "recognised " + image.decode()

    class Parser(DocumentParser):
        def parse(self, content, suffix):
            return list(parsed)

    return Recognition(Pdf(), Image(), Parser())


LONG = "native text " * 6


def methods(pages):
    return [method for _, method in pages]


def test_pdf_cascade():
    pages = recognition().read_pdf(f"{LONG}\fshort\f{LONG}".encode())
    assert methods(pages) == ["pdf_text", "pdf_ocr", "pdf_text"]
    assert pages[1][0] == ["recognised short"]
    pages = recognition().read_pdf(f"{LONG}\funreadable".encode())
    assert pages[1] == ([""], "pdf_ocr")
    assert methods(recognition(["a", "b"]).read_pdf(b"short\fx")) == ["vlm_ocr", "vlm_ocr"]
    assert methods(recognition().read_pdf(b"short\funreadable")) == ["pdf_ocr", "ocr_failed"]
    assert methods(recognition(broken=True).read_pdf(LONG.encode())) == ["pdf_ocr"]
    with pytest.raises(Unsupported):
        Recognition().read_pdf(b"x")


def test_folder(spark, tmp_path):
    (tmp_path / "a.txt").write_text("첫 줄입니다\n---\n둘째 줄입니다", encoding="utf-8")
    (tmp_path / "b.csv").write_text("alpha,beta\n1,2\n", encoding="utf-8")
    (tmp_path / "c.docx").write_bytes(word_file(["문서 본문입니다"], []))
    (tmp_path / "d.xls").write_bytes(b"old")
    (tmp_path / "e.png").write_bytes(b"image")
    (tmp_path / "f.exe").write_bytes(b"no")
    (tmp_path / "g.pptx").write_bytes(b"damaged")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "h.txt").write_text("no")
    files = scan_folder(spark, str(tmp_path))
    rows = {r["source_file"]: r for r in load_pages(files, recognition()).collect()}
    assert sorted(rows) == ["a.txt", "b.csv", "c.docx", "d.xls", "e.png", "g.pptx"]
    assert rows["a.txt"]["text"] == "첫 줄입니다\n둘째 줄입니다"
    assert rows["b.csv"]["text"] == "alpha beta"
    assert rows["c.docx"]["text"] == "문서 본문입니다"
    assert rows["d.xls"]["status"].startswith("unsupported")
    assert rows["e.png"]["text"] == "recognised image"
    assert rows["g.pptx"]["status"].startswith("failed") and rows["g.pptx"]["text"] is None


def test_short_previews(spark):
    rows = [("x" * 1500, 1024), ("x" * 1499, 1024), ("x" * 2000, 20 * 1024), ("x" * 1999, 20 * 1024)]
    frame = spark.createDataFrame(rows, "text string, size long")
    out = frame.select(preview_is_enough(F.col("text"), F.col("size")).alias("o")).collect()
    assert [r["o"] for r in out] == [True, False, True, False]
    files = spark.createDataFrame([("a.hwp", b"1"), ("b.hwp", b"2")], "path string, content binary")
    pages = spark.createDataFrame(
        [("a.hwp", "a.hwp", ".hwp", 1, "short", "hwp_prvtext", None, "ok", False),
         ("b.hwp", "b.hwp", ".hwp", 1, "long", "hwp_prvtext", None, "ok", True)],
        "path string, source_file string, file_type string, page_num int, text string, method string,"
        "elements_count int, status string, preview_enough boolean",
    )
    out = reparse_short_previews(files, pages, recognition(["첫 쪽 내용입니다", "둘째 쪽 내용입니다"])).collect()
    assert sorted((r["path"], r["page_num"], r["method"]) for r in out) == [
        ("a.hwp", 1, "vlm_ocr"), ("a.hwp", 2, "vlm_ocr"), ("b.hwp", 1, "hwp_prvtext"),
    ]
    same = reparse_short_previews(files, pages, recognition())
    assert sorted(r["text"] for r in same.collect()) == ["long", "short"]


def test_html(spark):
    html = "<html><head><title>The title</title><style>p{}</style></head><body><p>One <b>bold</b>\nline &amp; more</p><!-- no --><div>Second element</div></body></html>"
    row = load_html(spark.createDataFrame([(1, html)], "id int, html string"), "id", "html").first()
    assert row["text"] == "The title\nOne bold line & more\nSecond element"
    assert (row["elements_count"], row["method"]) == (3, "unstructured_html")


def test_dialogue():
    assert list(dialogue(["a", " ", " b ", "QUIT", "c"])) == ["a", "b"]


def compound_file(streams: dict[str, bytes]) -> bytes:
    """A small compound file: one allocation table, small streams in the mini stream."""
    import struct

    end, free, width, mini = 0xFFFFFFFE, 0xFFFFFFFF, 512, 64
    sectors: list[bytes] = []
    table: list[int] = []

    def store(data: bytes) -> int:
        if not data:
            return end
        first = len(sectors)
        count = -(-len(data) // width)
        for i in range(count):
            sectors.append(data[i * width : (i + 1) * width].ljust(width, b"\0"))
            table.append(first + i + 1 if i + 1 < count else end)
        return first

    store(b"\0" * width)  # place of the allocation table
    entries, small, mini_table = [], b"", []
    for name, data in streams.items():
        if len(data) >= 4096:
            entries.append((name, 2, store(data), len(data)))
            continue
        start, count = len(mini_table), -(-len(data) // mini)
        mini_table += [start + i + 1 for i in range(count - 1)] + [end] * bool(count)
        small += data.ljust(count * mini, b"\0")
        entries.append((name, 2, start if count else end, len(data)))
    entries.insert(0, ("Root Entry", 5, store(small), len(small)))
    directory = b""
    for name, kind, start, size in entries:
        raw = name.encode("utf-16le") + b"\0\0"
        directory += struct.pack("<64sHB49xIQ", raw, len(raw), kind, start, size)
    first_entry = store(directory)
    first_mini = store(struct.pack(f"<{len(mini_table)}I", *mini_table))
    table[0] = 0xFFFFFFFD
    assert len(table) <= 128
    sectors[0] = struct.pack("<128I", *(table + [free] * (128 - len(table))))
    header = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1".ljust(24, b"\0") + struct.pack("<HHHHH6x", 62, 3, 0xFFFE, 9, 6)
    header += struct.pack("<4xI", 1) + struct.pack("<7I", first_entry, 0, 4096, first_mini, 1, end, 0)
    header += struct.pack("<109I", 0, *[free] * 108)
    return header + b"".join(sectors)


def test_hangul_preview(spark):
    from pagefold.sources.compound import read_stream

    short, long = "미리보기 문서의 본문입니다.\r\n둘째 줄의 내용입니다.", "긴 본문 문장입니다. " * 400
    streams = {"FileHeader": b"x" * 100, "PrvText": short.encode("utf-16le"), "Body": b"y" * 5000}
    content = compound_file(streams)
    for name, data in streams.items():
        assert read_stream(content, name) == data
    assert read_stream(content, "Missing") is None
    assert read_stream(compound_file({"PrvText": long.encode("utf-16le")}), "PrvText").decode("utf-16le") == long
    with pytest.raises(ValueError):
        read_stream(b"not one", "PrvText")
    files = [
        ("a.hwp", content),
        ("b.hwp", compound_file({"PrvText": long.encode("utf-16le")})),
        ("c.hwp", compound_file({"Other": b"1"})),
        ("d.hwp", b"damaged"),
    ]
    rows = {r["path"]: r for r in load_pages(spark.createDataFrame(files, "path string, content binary")).collect()}
    assert rows["a.hwp"]["text"] == "미리보기 문서의 본문입니다.\n둘째 줄의 내용입니다."
    assert (rows["a.hwp"]["method"], rows["a.hwp"]["preview_enough"]) == ("hwp_prvtext", False)
    assert rows["b.hwp"]["preview_enough"]
    assert rows["c.hwp"]["status"] == "failed: no text"
    assert rows["d.hwp"]["status"].startswith("failed")


def test_files_are_passed_on_in_pieces():
    """A worker passes pages on while it reads, and does not gather those of a whole batch."""
    read = []

    def files():
        for i in range(24):
            read.append(i)
            page = (f"raw/f{i}.txt", "f.txt", ".txt", 1 << 20)
            yield [(*page, None, None, None, "failed: x")] if i == 2 else [(*page, n, ["a", "b"], "txt", loading.OK) for n in (1, 2)]

    made = loading._pieces(files())
    first = next(made)
    assert len(read) <= 5 and first.to_pylist()[4]["parts"] is None
    assert first.num_rows + sum(b.num_rows for b in made) == 47


def test_plain_tables_are_printed_as_pandas_does(monkeypatch):
    rng = random.Random(1)
    heads = ["a", "bb", "customer", "x y", "Long_Name", "NA", "nan", "A" * 70]
    cells = {
        "whole": ["0", "5", "-3", "123456", "-99999999999", str(10**16)],
        "word": ["BUILDING", "HOUSE HOLD", "a", "e", "inf", "NaN", "True", "NULL", "yes", "T", "B" * 90],
        "odd": ["007", "1.0", "", "a", "3", "-0", "+5", " x", "\t", "가", '"q"', str(10**20), "n/a", "1e5"],
    }
    plain = 0
    for _ in range(600):
        kinds = rng.choices(["whole", "word", "odd"], [6, 5, 1], k=rng.randint(1, 4))
        rows = [rng.choices(heads, k=len(kinds)), *[[rng.choice(cells[k]) for k in kinds] for _ in range(rng.randint(1, 4))]]
        content = "".join(",".join(row) + "\n" for row in rows).encode()
        found = formats.plain_table(content)
        plain += found is not None
        assert found is None or found == pd.read_csv(io.BytesIO(content)).to_string(index=False)
    assert plain > 100
    monkeypatch.setattr(formats.pd, "read_csv", None)
    assert formats.read_csv(b"customer,nation,segment\n123,4,BUILDING\n")[0][0][0].endswith("BUILDING")
