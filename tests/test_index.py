from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagefold.backends import FirstSentence, HashingEmbedder
from pagefold.backends.base import Corrector, Generator
from pagefold.operators.answering import REFUSAL, answer_questions, assemble, retrieve
from pagefold.operators.embedding import embed_chunks, embeddable
from pagefold.operators.normalization import normalize_chunks
from pagefold.operators.retrieval import left_out, top_k
from pagefold.operators.vector_index import Layout, VectorIndex, index_entries
from pagefold.settings import Settings

CHUNK = "source_file string, chunk_id int, page_num int, text string, char_count int"


def chunks(spark, rows):
    return spark.createDataFrame([(d, c, 1, t, len(t)) for d, c, t in rows], CHUNK)


def test_vectors(spark):
    frame = chunks(spark, [("a", 0, "one two"), ("a", 1, " "), ("b", 0, ""), ("c", 0, "ONE, two!")])
    rows = {(r["source_file"], r["chunk_id"]): r["embedding"] for r in embed_chunks(frame, HashingEmbedder()).collect()}
    assert np.isclose(np.linalg.norm(rows[("a", 0)]), 1)
    assert rows[("a", 0)] == rows[("c", 0)]
    assert rows[("a", 1)] == [0.0] * 64 == rows[("b", 0)]
    assert {r["source_file"] for r in embeddable(frame).collect()} == {"a", "c"}


def test_add_is_idempotent_and_keeps_the_first(spark, tmp_path):
    index = VectorIndex(spark, str(tmp_path / "index"), Settings(index_buckets=4))
    assert not index.exists() and index.count() == 0
    embedder = HashingEmbedder()

    def entries(rows):
        return index_entries(embed_chunks(chunks(spark, rows), embedder))

    index.add(entries([("a.txt", i, f"text {i}") for i in range(20)] + [("b.txt", 0, " ")]))
    assert index.count() == 21
    index.add(entries([("a.txt", i, f"changed {i}") for i in range(25)] + [("a.txt", 24, "changed 24")]))
    found = {r["id"]: r["document"] for r in index.read().collect()}
    assert len(found) == 26 == index.count()
    assert found["a.txt_3"] == "text 3" and found["a.txt_24"] == "changed 24" and found["b.txt_0"] == " "
    index.reset()
    assert index.exists() and index.count() == 0
    index.add(entries([("a.txt", 0, "again")]))
    assert index.count() == 1


def test_the_stored_layout_decides(spark, tmp_path):
    """Written with one number of buckets, added to and read with another: nothing twice, nothing lost."""
    rows = [(f"d{i}.txt", 0, f"word{i}") for i in range(50)]
    entries = index_entries(embed_chunks(chunks(spark, rows), HashingEmbedder()))
    path = str(tmp_path / "index")
    VectorIndex(spark, path, Settings(index_buckets=8)).add(entries)
    index = VectorIndex(spark, path)
    index.add(entries)
    assert index.count() == 50 and index.layout() == Layout(8, 64)
    asked = embed_chunks(chunks(spark, [("q", 0, "word7")]), HashingEmbedder()).select(
        F.lit(1).alias("question_id"), "embedding"
    )
    assert retrieve(index, asked, 10).count() == 10 == retrieve(index.read(), asked, 10).count()
    with pytest.raises(Exception, match="another dimension"):
        index.add(entries.withColumn("id", F.lit("new")).withColumn("embedding", F.array(F.lit(1.0).cast("float"))))


@pytest.mark.parametrize("limit", [32 * 1024 * 1024, 600])
def test_one_rule_for_dimensions(spark, limit):
    index = spark.createDataFrame(
        [(i, [float(i), 0.0]) for i in range(9)] + [(100, [0.0]), (101, None)], "id long, embedding array<float>"
    )
    asked = spark.createDataFrame(
        [(q, [float(q), 0.0]) for q in range(6)] + [(50, [1.0]), (51, None)], "question_id long, embedding array<float>"
    )
    rows = top_k(index, asked, 1, Settings(broadcast_bytes=limit)).collect()
    assert sorted((r["question_id"], r["id"]) for r in rows) == [(q, q) for q in range(6)]
    assert {r["side"]: r["rows"] for r in left_out(index, asked, 2).collect()} == {"index": 2, "questions": 2}


def test_questions_are_embedded_once(spark, tmp_path):
    folder = str(tmp_path)

    class Counting(HashingEmbedder):
        def encode(self, texts):
            with open(f"{folder}/calls", "a") as out:
                out.write("x" * len(texts))
            return super().encode(texts)

    index = indexed(spark, tmp_path / "i", [("a", 0, "Red apples grow."), ("b", 0, "Blue cars drive.")])
    asked = spark.createDataFrame([(i, f"question {i}") for i in range(5)], "question_id long, question string")
    answer_questions(index, asked, Counting(), FirstSentence()).collect()
    assert len((tmp_path / "calls").read_text()) == 5


def brute(vectors, questions, k):
    out = {}
    for q, asked in questions:
        ranked = sorted((float(((np.float32(v).astype(float) - np.float32(asked).astype(float)) ** 2).sum()), i) for i, v in vectors)
        out[q] = [i for _, i in ranked[:k]]
    return out


@pytest.mark.parametrize("limit", [32 * 1024 * 1024, 3000])
def test_nearest_matches_brute_force(spark, limit):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(150, 8))
    # Many exact copies: ties must go to the smaller id on both paths.
    vectors = [(i, base[i % 150].astype(float).tolist()) for i in range(400)]
    questions = [(q, rng.normal(size=8).tolist()) for q in range(40)] + [(99, vectors[7][1])]
    index = spark.createDataFrame(vectors, "id long, embedding array<float>").repartition(5)
    asked = spark.createDataFrame(questions, "question_id long, embedding array<float>")
    rows = top_k(index, asked, 6, Settings(broadcast_bytes=limit)).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["question_id"], []).append(r["id"])
    assert got == brute(vectors, questions, 6)


def test_nearest_edge_cases(spark):
    index = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None), ("c", [0.0])], "id string, embedding array<float>")
    asked = spark.createDataFrame([(1, [0.0, 0.0])], "question_id int, embedding array<float>")
    assert [(r["id"], r["rank"]) for r in top_k(index, asked, 5).collect()] == [("a", 1)]
    assert top_k(index, asked.where("false"), 5).count() == 0


def test_grading(spark):
    rows = [(1, 1, "a", " "), (1, 2, "b", "text b"), (1, 3, "c", "text c"), (2, 1, "d", " "), (2, 2, "e", "  ")]
    found = spark.createDataFrame(rows, "question_id int, rank int, id string, document string").selectExpr(
        "*", "'f' as source_file", "1 as page_num", "0.5D as distance"
    )
    out = {r["question_id"]: r for r in assemble(found, graded=True).collect()}
    assert out[1]["grade_passed"] and out[1]["context"] == "text b\n\ntext c"
    assert [s["id"] for s in out[1]["sources"]] == ["b", "c"]
    assert not out[2]["grade_passed"] and [s["id"] for s in out[2]["sources"]] == ["d", "e"]
    simple = {r["question_id"]: r for r in assemble(found, graded=False).collect()}
    assert simple[2]["grade_passed"] and [s["id"] for s in simple[1]["sources"]] == ["a", "b", "c"]


def indexed(spark, tmp_path, rows):
    index = VectorIndex(spark, str(tmp_path / "index"))
    index.add(index_entries(embed_chunks(chunks(spark, rows), HashingEmbedder())))
    return index


def test_answers(spark, tmp_path):
    index = indexed(spark, tmp_path, [("a", 0, "Red apples grow. They are sweet."), ("b", 0, "Blue cars drive fast.")])
    asked = spark.createDataFrame([(0, "red apples"), (1, "blue cars")], "question_id long, question string")
    rows = answer_questions(index, asked, HashingEmbedder(), FirstSentence()).orderBy("question_id").collect()
    assert [r["answer"] for r in rows] == ["Red apples grow.", "Blue cars drive fast."]
    assert [r["sources"][0]["id"] for r in rows] == ["a_0", "b_0"]
    assert rows[0]["sources"][0]["preview"] == "Red apples grow. They are sweet...."


def test_refusal_and_failure(spark, tmp_path):
    class Failing(Generator):
        def answer(self, prompts, contexts):
            raise RuntimeError("offline")

    blank = indexed(spark, tmp_path / "x", [("a", 0, " ")])
    asked = spark.createDataFrame([(0, "red apples")], "question_id long, question string")
    row = answer_questions(blank, asked, HashingEmbedder(), Failing()).first()
    assert (row["answer"], row["grade_passed"], len(row["sources"])) == (REFUSAL, False, 1)
    full = indexed(spark, tmp_path / "y", [("a", 0, "text")])
    row = answer_questions(full, asked, HashingEmbedder(), Failing()).first()
    assert row["answer"] == "Error: offline" and row["sources"] is None
    empty = full.read().where("false")
    row = answer_questions(empty, asked, HashingEmbedder(), Failing()).first()
    assert (row["answer"], row["grade_passed"]) == (REFUSAL, False)


def test_fetching_reads_only_the_folders_of_the_hits(spark, tmp_path):
    index = indexed(spark, tmp_path, [(f"d{i}", 0, f"word{i}") for i in range(50)])
    asked = embed_chunks(chunks(spark, [("q", 0, "word7")]), HashingEmbedder()).select(
        F.lit(1).alias("question_id"), "embedding"
    )
    found = retrieve(index, asked, 2)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert found.where("rank = 1").first()["source_file"] == "d7"


def test_normalisation(spark):
    class Upper(Corrector):
        def tokens(self, text):
            return text.split(" ")

        def correct(self, texts):
            if "boom" in texts[0]:
                raise ValueError("model failed")
            return [t.upper() for t in texts]

    frame = chunks(spark, [("a", 0, "see [이름] and [EMAIL_ADDRESS]"), ("a", 1, ""), ("a", 2, "boom"), ("a", 3, " ")])
    rows = {r["chunk_id"]: r for r in normalize_chunks(frame, Upper()).collect()}
    assert rows[0]["text"] == "SEE [이름] AND [EMAIL_ADDRESS]"
    assert rows[0]["normalized"] and rows[0]["original_length"] == rows[0]["char_count"]
    assert rows[1]["normalized"] is None and rows[1]["text"] == ""
    assert rows[2]["text"] == "boom" and rows[2]["normalized"] is False and "failed" in rows[2]["normalization_error"]
    assert rows[3]["text"] == " "
    same = normalize_chunks(frame, None).collect()
    assert [r["normalized"] for r in same] == [None] * 4
