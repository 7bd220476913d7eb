from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from pagefold.backends import FirstSentence, HashingEmbedder
from pagefold.operators.answering import answer_questions
from pagefold.operators.rollup import document_records
from pagefold.operators.vector_index import VectorIndex
from pagefold.plans.indexing import embed_documents, upload_vectors
from pagefold.plans.ingest import ingest_folder, ingest_pages
from pagefold.settings import Settings
from pagefold.sinks.chunk_documents import write_chunk_documents
from pagefold.sources.chunk_documents import chunk_rows, read_chunk_documents, read_vectors
from pagefold.sources.loading import table_pages
from pagefold.sources.questions import questions_frame
from pagefold.streaming.folder import index_stream, watch_folder

MEMO = "회의록\n2025년 1월 15일\n작성자: 홍길동 대리\n첫 번째 안건은 서버 교체입니다. 연락은 a.b@c.org 로 합니다. "


def raw_folder(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "memo.txt").write_text(MEMO + "본문 문장입니다. " * 120, encoding="utf-8")
    (raw / "table.csv").write_text("alpha,beta\n1,2\n", encoding="utf-8")
    (raw / "old.doc").write_bytes(b"old")
    return raw


def test_folder_to_answers(spark, tmp_path):
    settings = Settings(privacy=True)
    run = ingest_folder(spark, str(raw_folder(tmp_path)), str(tmp_path / "chunks"), settings)
    summary = run.summary.first()
    assert (summary["succeeded"], summary["failed"]) == (2, 1)
    documents = read_chunk_documents(spark, str(tmp_path / "chunks"))
    memo = documents.where("source_file = 'memo.txt'").first()
    assert memo["file_type"] == ".txt" and memo["total_pages"] == 1
    assert memo["total_chunks"] == len(memo["chunks"]) > 1
    assert memo["total_characters"] == sum(c["char_count"] for c in memo["chunks"])
    assert [c["chunk_id"] for c in memo["chunks"]] == list(range(memo["total_chunks"]))
    assert memo["chunks"][0]["metadata"]["author"] == "홍길동 대리"
    assert "[EMAIL_ADDRESS]" in memo["chunks"][0]["text"] and "a.b@c.org" not in str(memo["chunks"])
    info = memo["processing_info"]
    assert info["methods_used"] == ["txt"] and info["privacy_findings"][0]["page"] == 1
    chunks = chunk_rows(documents)
    assert summary["total_chunks"] == chunks.count()
    done = embed_documents(chunks, HashingEmbedder(), str(tmp_path / "vectors")).first()
    assert (done["succeeded"], done["failed"], done["vectors"]) == (2, 0, chunks.count())
    index = VectorIndex(spark, str(tmp_path / "index"))
    vectors = read_vectors(spark, str(tmp_path / "vectors"))
    for _ in range(2):
        row = upload_vectors(index, chunks, vectors).first()
        assert (row["uploaded"], row["in_index"]) == (chunks.count(), chunks.count())
    asked = questions_frame(spark, ["서버 교체 안건"])
    answer = answer_questions(index.read(), asked, HashingEmbedder(), FirstSentence()).first()
    assert answer["grade_passed"] and answer["sources"][0]["source_file"] == "memo.txt"


def test_large_documents_are_split_into_parts(spark):
    pages = [("hot", p, "글자 " * 30) for p in range(1, 101)] + [("small", 1, "짧은 글"), ("none", 1, "  ")]
    frame = table_pages(spark.createDataFrame(pages, "d string, p int, text string"), F.col("d"), F.col("p"))
    settings = Settings(chunks_per_record=16, chunk_size=50, chunk_overlap=10, strategy="basic")
    records = document_records(ingest_pages(frame, settings), settings)
    rows = sorted(records.collect(), key=lambda r: (r["source_file"], r["part"]))
    hot = [r for r in rows if r["source_file"] == "hot"]
    assert len(hot) > 1 and {r["total_pages"] for r in hot} == {100}
    ids = [c["chunk_id"] for r in hot for c in r["chunks"]]
    assert ids == list(range(hot[0]["total_chunks"])) and max(len(r["chunks"]) for r in hot) <= 16
    none = next(r for r in rows if r["source_file"] == "none")
    assert (none["total_chunks"], none["average_chunk_size"]) == (1, 0.0)
    small = next(r for r in rows if r["source_file"] == "small")
    assert small["chunks"][0]["text"] == "짧은 글"


def test_writing_a_document_keeps_the_others(spark, tmp_path):
    path, settings = str(tmp_path / "store"), Settings(chunk_size=50, chunk_overlap=10, strategy="basic")

    def write(names, text):
        frame = table_pages(spark.createDataFrame([(n, 1, text) for n in names], "d string, p int, text string"), F.col("d"), F.col("p"))
        write_chunk_documents(document_records(ingest_pages(frame, settings), settings), path)

    write([f"d{i}" for i in range(80)], "first text " * 20)
    write(["d3", "d4", "new"], "second")
    found = {r["source_file"]: len(r["chunks"]) for r in read_chunk_documents(spark, path).collect()}
    assert len(found) == 81 and found["d3"] == found["new"] == 1 and found["d5"] > 1


def test_a_broken_promise_of_pages_fails(spark):
    frame = table_pages(spark.createDataFrame([("d", 1, "a"), ("d", 2, "b")], "d string, p int, text string"), F.col("d"), F.col("p"))
    with pytest.raises(Exception, match="max_pages"):
        ingest_pages(frame, Settings(strategy="basic"), max_pages=1).collect()


def test_stream_indexes_each_file_once(spark, tmp_path):
    raw = raw_folder(tmp_path)
    index = VectorIndex(spark, str(tmp_path / "index"))
    name = uuid.uuid4().hex

    def run():
        files = watch_folder(spark, str(raw), files_per_batch=1)
        index_stream(files, index, HashingEmbedder(), name=name).awaitTermination()
        return index.count()

    first = run()
    assert first > 1
    assert run() == first
    (raw / "later.txt").write_text("나중에 온 문서입니다.", encoding="utf-8")
    assert run() == first + 1


def test_models_run_once_per_page(spark, tmp_path):
    """Numbering looks at the pages twice, but a recogniser sees every page once."""
    from pagefold.backends.base import EntityRecognizer

    seen = spark.sparkContext.accumulator(0)

    class Counting(EntityRecognizer):
        def recognize(self, texts):
            seen.add(len(texts))
            return [[(0, 2, t[:2], "PS", 0.9)] for t in texts]

    pages = [("a", p, "본문 문장입니다.") for p in range(1, 31)]
    frame = table_pages(spark.createDataFrame(pages, "d string, p int, text string"), F.col("d"), F.col("p"))
    chunks = ingest_pages(frame, Settings(privacy=True, pages_per_block=4), entities=Counting())
    rows = chunks.orderBy("chunk_id").collect()
    assert [r["chunk_id"] for r in rows] == list(range(30))
    assert all(r["text"] == "[PERSON] 문장입니다." for r in rows)
    assert seen.value == 30


def test_rollup_of_a_stream_follows_the_newest_version(spark, tmp_path):
    """Batches in turn: first versions, a replay beside newer versions, late ones; the result is that of one batch."""
    import datetime as dt
    import os
    import uuid

    from pagefold.streaming.rollup import headers_of, page_facts, rollup_stream

    kind = "source_file string, version timestamp, page_num int, text string"
    at = lambda n: dt.datetime(2024, 1, 1 + n)
    first = [(f"d{i}", at(5), p, f"text {i} " * (90 * p)) for i in range(12) for p in (1, 2)]
    newer = [(f"d{i}", at(6), 1, "short") for i in range(0, 12, 3)]
    late = [(f"d{i}", at(2), p, "old " * 500) for i in range(12) for p in (1, 2, 3)] + [("new", at(1), 1, " ")]
    batches = [first, first + newer + newer, late, first]
    folder = tmp_path / "in"
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(folder))
        for name in os.listdir(folder):
            if name.endswith(".parquet") and not name.startswith("batch"):
                os.rename(folder / name, folder / f"batch{n}.parquet")
                os.utime(folder / f"batch{n}.parquet", (1000 + n, 1000 + n))
    pages = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(folder))
    settings = Settings(strategy="basic")
    out = str(tmp_path / "headers")
    rollup_stream(pages, out, settings, name=f"test-{uuid.uuid4().hex}").awaitTermination()
    newest = {}
    for name, version, page, text in [r for b in batches for r in b]:
        newest.setdefault(name, {}).setdefault(version, {})[page] = text
    rows = [(n, v, p, t) for n, versions in newest.items() for v in [max(versions)] for p, t in versions[v].items()]
    facts = page_facts(spark.createDataFrame(rows, kind), settings)
    sums = facts.groupBy("source_file", "version").agg(
        F.count("*").alias("total_pages"), F.sum("chunks").alias("total_chunks"),
        F.sum("characters").alias("total_characters"), F.sum("filled").alias("filled_chunks"),
    )
    names = ["source_file", "version", "total_pages", "total_chunks", "total_characters", "filled_chunks", "average_chunk_size"]
    want = sorted(tuple(r) for r in headers_of(sums).select(names).collect())
    assert sorted(tuple(r) for r in spark.read.parquet(out).select(names).collect()) == want and len(want) == 13


def test_splitting_a_table_in_sql(spark):
    from pagefold.functions.splitting import fixed_windows
    from pagefold.plans import sql

    texts = ["x" * n for n in (1, 9, 10, 11, 14, 15, 16, 40)] + [" ", None]
    frame = spark.createDataFrame([(i, "k", t) for i, t in enumerate(texts)], "id long, kind string, text string")
    sql.register(spark, some_pages=frame)
    found = spark.sql("SELECT * FROM split_table(TABLE(some_pages), 'text', 10, 4)")
    assert found.columns == ["id", "kind", "chunk_id", "char_count", "chunk_text"]
    want = {(r["id"], n): c for r in frame.where("text LIKE 'x%'").select("id", fixed_windows(F.col("text"), 10, 4).alias("c")).collect()
            for n, c in enumerate(r["c"])}
    want[len(texts) - 2, 0] = ""
    assert {(r["id"], r["chunk_id"]): r["chunk_text"] for r in found.collect()} == want
    with pytest.raises(Exception, match="no column"):
        spark.sql("SELECT * FROM split_table(TABLE(some_pages), 'other', 10, 4)").collect()
