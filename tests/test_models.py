"""What is fitted on the collection: quantised index, latent vectors, languages, corrections."""

from __future__ import annotations

import itertools
import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from conftest import TABLES
from pyspark.sql import functions as F

from pagefold.backends import FirstSentence, HashingEmbedder, RankedSentences
from pagefold.backends.tagger import Chain, best_labels, chances, fit_tagger
from pagefold.operators.answering import answer_questions
from pagefold.operators.boundaries import abbreviations, learned_sentences, stop_counts
from pagefold.operators.correction import Channel, best_reading, correct_texts, neighbours, tokens, word_counts
from pagefold.operators.embedding import embed_chunks
from pagefold.operators import language_model, quantised_index
from pagefold.operators.language_model import Grams, detect_languages, fit_languages, gram_rows
from pagefold.operators.latent import Latent, decompose, document_terms, fit_embedder, term_statistics, weighted
from pagefold.operators.quantised_index import Quantiser, QuantisedIndex, k_means, recall
from pagefold.operators.privacy import recognizer_column
from pagefold.operators.retrieval import top_k
from pagefold.operators.vector_index import VectorIndex, index_entries
from pagefold.session import stage_table
from pagefold.settings import Settings

VECTORS = "id long, embedding array<float>"


def clustered(n, dim=16, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, dim))
    return [(i, (centres[i % 12] + 0.3 * draw.normal(size=dim)).tolist()) for i in range(n)]


# --- quantised index --------------------------------------------------------------------------


def test_k_means_is_that_of_lloyd(spark):
    rows = clustered(300, 4)
    points = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    starts = points[:5].copy()
    want = starts.copy()
    for _ in range(4):
        to = ((points[:, None] - want[None]) ** 2).sum(axis=2).argmin(axis=1)
        want = np.array([points[to == k].mean(axis=0) if (to == k).any() else want[k] for k in range(5)])
    found = k_means(spark.createDataFrame(rows, VECTORS).repartition(3), starts[None], 4)[0]
    assert np.allclose(found, want)


@pytest.mark.parametrize("settings", [Quantiser(segment=50, block=7), Quantiser(cells=5, parts=8, sample=200)])
def test_quantised_search(spark, tmp_path, settings):
    entries = spark.createDataFrame([*clustered(1500), (9001, None), (9002, [1.0])], VECTORS)
    asked = spark.createDataFrame([*clustered(40, seed=5), (77, None), (78, [0.0, 1.0])], VECTORS).withColumnRenamed("id", "question_id")
    index = QuantisedIndex(spark, str(tmp_path / "index"), settings)
    index.build(entries)
    assert index.exists() and index.rows().count() == 1500
    exact = top_k(entries, asked, 5)
    every = index.search(asked, 5, probes=4096)
    key = lambda r: (r["question_id"], r["rank"], r["id"], round(r["distance"], 9))
    assert sorted(map(key, every.collect())) == sorted(map(key, exact.collect()))
    counted = recall(index.search(asked, 5, probes=8), exact).first()
    assert counted["wanted"] == 200 and counted["found"] >= 180


def spherical(n, dim=32, seed=2):
    """Vectors that lie about as far from each other as from anything: codes alone mislead."""
    draw = np.random.default_rng(seed)
    return [(i, v.tolist()) for i, v in enumerate(draw.normal(size=(n, dim)))]


def test_a_certain_search_is_exact(spark, tmp_path):
    entries = spark.createDataFrame(spherical(1200), VECTORS)
    asked = spark.createDataFrame([(0, [0.01] * 32), (1, [-0.2] * 32), (2, [3.0] * 32)], VECTORS).withColumnRenamed("id", "question_id")
    index = QuantisedIndex(spark, str(tmp_path / "index"), Quantiser(parts=4, refine=1, segment=70, block=2))
    index.build(entries)
    key = lambda r: (r["question_id"], r["rank"], r["id"], round(r["distance"], 9))
    want = sorted(map(key, top_k(entries, asked, 5).collect()))
    assert sorted(map(key, index.search(asked, 5, probes=4096).collect())) != want
    assert sorted(map(key, index.search(asked, 5, probes=1, certain=True).collect())) == want


def test_settled_searches_find_what_was_wanted(spark, tmp_path):
    entries = spark.createDataFrame(spherical(1200), VECTORS)
    asked = entries.where("id % 20 = 0").withColumnRenamed("id", "question_id")
    index = QuantisedIndex(spark, str(tmp_path / "index"), Quantiser(parts=4, refine=2))
    index.build(entries)
    exact = top_k(entries, asked, 5)
    first = recall(index.search(asked, 5, probes=4), exact).first()
    assert first["found"] < 0.9 * first["wanted"]
    last = recall(index.search(asked, 5, *index.settled(asked, 5, probes=4)), exact).first()
    assert last["found"] >= 0.95 * last["wanted"]


def test_a_question_goes_once_to_a_slice_of_many_cells(spark, tmp_path, monkeypatch):
    """However many cells a question wants, it is stored once for each slice, and no more than wanted leave a slice."""
    kept = {}

    def stage(df, name):
        kept[name] = stage_table(df, name)
        return kept[name]

    monkeypatch.setattr(quantised_index, "stage_table", stage)
    entries = spark.createDataFrame(spherical(600), VECTORS)
    asked = entries.where("id % 20 = 0").withColumnRenamed("id", "question_id")
    for segment, slices in ((50_000, 1), (200, range(3, 8))):
        index = QuantisedIndex(spark, str(tmp_path / f"index-{segment}"), Quantiser(segment=segment, refine=4))
        index.build(entries)
        found = index.search(asked, 5, probes=4096).collect()
        routed = kept["routed"].groupBy("question_id").count().select("count").distinct().collect()
        assert len(routed) == 1 and routed[0][0] in ([slices] if segment > 600 else slices)
        assert kept["candidates"].groupBy("question_id").count().where("count != 20").isEmpty()
        if segment == 50_000:
            first = sorted(map(tuple, kept["candidates"].collect()))
            want = sorted((r["question_id"], r["rank"], r["id"]) for r in found)
        assert sorted(map(tuple, kept["candidates"].collect())) == first
        assert sorted((r["question_id"], r["rank"], r["id"]) for r in found) == want


def test_equal_vectors_and_one_vector(spark, tmp_path):
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(900, [0.0, 1.0])]
    index = QuantisedIndex(spark, str(tmp_path / "equal"), Quantiser(segment=20))
    index.build(spark.createDataFrame(rows, VECTORS))
    asked = spark.createDataFrame([("q", [1.0, 0.0]), ("p", [0.0, 1.0])], "question_id string, embedding array<float>")
    found = {(r["question_id"], r["rank"]): r["id"] for r in index.search(asked, 3).collect()}
    assert found["p", 1] == 900 and all(found["q", n] < 300 for n in (1, 2, 3))
    index = QuantisedIndex(spark, str(tmp_path / "one"))
    index.build(spark.createDataFrame([(5, [0.5, 0.5])], VECTORS))
    assert [r["id"] for r in index.search(asked, 3).collect()] == [5, 5]
    with pytest.raises(ValueError, match="no vectors"):
        index.build(spark.createDataFrame([(5, None)], VECTORS))


def test_answers_from_the_approximate_index(spark, tmp_path):
    kind = "source_file string, chunk_id int, page_num int, text string, char_count int"
    chunks = spark.createDataFrame([(f"d{i}.txt", 0, 1, f"word{i} and more{i % 7}", 20) for i in range(200)], kind)
    entries = VectorIndex(spark, str(tmp_path / "index"), Settings(index_buckets=4))
    entries.add(index_entries(embed_chunks(chunks, HashingEmbedder())))
    nearest = QuantisedIndex(spark, str(tmp_path / "quantised"))
    nearest.build(entries.read().select("id", "embedding"))
    asked = spark.createDataFrame([(i, f"word{i}") for i in range(12)], "question_id long, question string")
    answers = [
        {r["question_id"]: (r["answer"], [s["id"] for s in r["sources"]]) for r in answer_questions(
            entries, asked, HashingEmbedder(), FirstSentence(), settings=Settings(probes=100), nearest=n).collect()}
        for n in (None, nearest)
    ]
    assert answers[0] == answers[1] and len(answers[0]) == 12


def test_a_run_of_terminals_is_a_first_sentence():
    assert FirstSentence().answer([], [". The is it.", "..a b. c", "", " ?! x", "no end"]) == [".", "..a b.", "", "?!", "no end"]


def test_exact_search_keeps_one_block_of_questions(spark):
    entries = spark.createDataFrame(clustered(60, 4), VECTORS)
    asked = spark.createDataFrame(clustered(20_000, 4, 3), VECTORS).withColumnRenamed("id", "question_id")
    found = top_k(entries, asked, 1, Settings(broadcast_bytes=4096 * (8 * 4 + 256)))
    assert found.count() == 20_000
    live = spark.sparkContext._jsc.sc().env().blockManager()
    assert found.inputFiles() and live is not None  # read from stored rankings
    few = asked.where("question_id < 50")
    key = lambda r: (r["question_id"], r["id"], round(r["distance"], 9))
    assert sorted(map(key, found.where("question_id < 50").collect())) == sorted(map(key, top_k(entries, few, 1).collect()))


# --- latent vectors ---------------------------------------------------------------------------


def test_singular_values_are_those_of_the_whole_matrix(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    held = document_terms(docs)
    entries = weighted(held, term_statistics(held, docs.count(), Latent(terms=400))).cache()
    rows = entries.collect()
    ids, terms = ({v: n for n, v in enumerate(sorted({r[c] for r in rows}))} for c in ("id", "term"))
    dense = np.zeros((len(ids), len(terms)))
    for r in rows:
        dense[ids[r["id"]], terms[r["term"]]] = r["weight"]
    assert np.allclose((dense**2).sum(axis=1), 1)
    want = np.linalg.svd(dense, compute_uv=False)
    values, vectors = decompose(entries, Latent(dims=12, more=20, rounds=5))
    assert np.allclose(values, want[:12], rtol=0.01)
    found = np.zeros((len(terms), 12))
    for r in vectors.collect():
        found[terms[r["term"]]] = r["vector"]
    assert np.allclose(found.T @ found, np.eye(12), atol=1e-6)
    assert np.allclose(np.linalg.norm(dense @ found, axis=0), values, rtol=0.01)


def test_a_matrix_of_low_rank(spark):
    rows = [(i, t, 1.0) for i in range(40) for t in (("a", "b") if i % 2 else ("c",))]
    values, vectors = decompose(spark.createDataFrame(rows, "id long, term string, weight double"), Latent(dims=8, more=4))
    assert np.allclose(values, [math.sqrt(40), math.sqrt(20)]) and vectors.count() == 3


def test_neighbours_share_topics_more_often_than_with_hashed_words(spark):
    """Texts of a topic share its words, but any two of them only few."""
    draw = random.Random(3)
    topics = [[f"t{k}w{i}" for i in range(60)] for k in range(8)]
    common = [f"c{i}" for i in range(300)]
    texts = [" ".join(draw.sample(topics[i % 8], 6) + draw.sample(common, 14)) for i in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    embedder, values = fit_embedder(frame, Latent(dims=16, more=16, rounds=3))
    assert list(values) == sorted(values, reverse=True)

    def share(vectors):
        near = vectors @ vectors.T
        np.fill_diagonal(near, -9)
        return np.mean([j % 8 == i % 8 for i in range(400) for j in np.argsort(-near[i])[:5]])

    ours, hashed = share(embedder.encode(texts)), share(HashingEmbedder().encode(texts))
    assert ours > 0.8 and ours > hashed + 0.2
    assert np.allclose(np.linalg.norm(embedder.encode(texts[:5]), axis=1), 1) and not embedder.encode(["", "unknown?"]).any()
    with pytest.raises(ValueError, match="no word"):
        fit_embedder(frame.limit(0))


def test_all_documents_fit_the_directions(spark):
    """Where as many directions are kept as there are kinds of documents, they hold the weights of every one of them."""
    texts = F.concat(F.lit("w"), (F.col("id") % 3).cast("string"), F.lit(" common"))
    _, values = fit_embedder(spark.range(520_000).select("id", texts.alias("text")), Latent(dims=4, more=4, rounds=1))
    assert math.isclose(float((values**2).sum()), 520_000, rel_tol=1e-9)


def test_terms_are_counted_per_id(spark):
    """Rows of one id, also of none, are one document; words are counted inside their row."""
    rows = [(1, "b a B"), (1, "a"), (None, "c"), (None, "c d"), (2, "x y x"), (3, ""), (4, None)]
    found = document_terms(spark.createDataFrame(rows, "id long, text string"))
    want = {(1, "a"): 2, (1, "b"): 2, (None, "c"): 2, (None, "d"): 1, (2, "x"): 2, (2, "y"): 1}
    assert {(r["id"], r["term"]): r["times"] for r in found.collect()} == want and found.count() == 6
    plan = document_terms(spark.range(50).select("id", F.lit("a b a").alias("text")))._jdf.queryExecution().toString()
    assert "Exchange" not in plan


# --- languages --------------------------------------------------------------------------------


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_languages(docs.where("doc_id % 3 != 0").select("text", "lang"))
    found = detect_languages(docs.where("doc_id % 3 = 0").select(F.col("doc_id").alias("id"), "text"), model).collect()
    want = {r["doc_id"]: r["lang"] for r in docs.collect()}
    right = sum(want[r["id"]] == r["lang"] for r in found)
    assert right >= 0.97 * len(found)


def test_languages_of_odd_texts(spark):
    rows = [("aaa bbb aaa", "x"), ("ccc ddd", "y"), (None, "x"), ("eee", None), ("", "z")]
    grams = Grams(segment=4)
    model = fit_languages(spark.createDataFrame(rows, "text string, lang string"), grams)
    assert {r["lang"] for r in model.select("lang").distinct().collect()} == {"x", "y", "z"} - {"z"}
    texts = [(1, "aaa 123 aaa"), (2, "CCC"), (3, None), (4, ""), (5, "qqq"), (6, "bbb " * 50)]
    found = detect_languages(spark.createDataFrame(texts, "id long, text string"), model, grams)
    assert {r["id"]: r["lang"] for r in found.collect()} == {1: "x", 2: "y", 6: "x"}
    whole = detect_languages(spark.createDataFrame(texts, "id long, text string"), model)
    key = lambda r: tuple(r)
    assert sorted(map(key, whole.collect())) == sorted(map(key, found.collect()))


def test_grams_of_a_long_text_take_one_pass(spark):
    """Half a million characters in one row; substrings counted from the start of a segment took a minute a million."""
    frame = spark.createDataFrame([(1, "añ😀 b中z. " * 60_000), (2, "x😀")], "id long, text string")
    started = time.monotonic()
    rows = gram_rows(frame, ["id"], Grams()).groupBy("id", "gram").count().collect()
    assert time.monotonic() - started < 10
    held = {(r["id"], r["gram"]): r["count"] for r in rows}
    assert held[1, "añ😀"] == held[1, "ñ😀 "] == held[1, "中z."] == 60_000 and held[1, ". a"] == 59_999
    assert {g for i, g in held if i == 2} == {" x😀", "x😀 "}


# --- corrections ------------------------------------------------------------------------------


def test_neighbours_are_those_at_one_edit(spark):
    draw = random.Random(8)
    words = list({"".join(draw.choice("abé") for _ in range(draw.randint(3, 6))) for _ in range(400)})
    counts = [(w, 1 if i % 2 else 25) for i, w in enumerate(words)]

    def edits(w):
        yield from (w[:i] + w[i + 1 :] for i in range(len(w)))
        yield from (w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in "abé")
        yield from (w[:i] + c + w[i:] for i in range(len(w) + 1) for c in "abé")
        yield from (w[:i] + w[i + 1] + w[i] + w[i + 2 :] for i in range(len(w) - 1))

    held = dict(counts)
    want = {(w, e) for w, n in counts if n == 1 and len(w) >= 4 for e in set(edits(w)) - {w} if held.get(e, 0) == 25 and len(e) >= 3}
    found = neighbours(spark.createDataFrame(counts, "word string, n long"))
    assert {(r["word"], r["other"]) for r in found.collect()} == want and want


def test_best_reading_is_that_of_all_readings():
    draw = random.Random(9)
    c = Channel()
    for _ in range(200):
        length = draw.randint(1, 4)
        steps = []
        for k in range(length):
            readings = [{"other": f"w{k}", "n": draw.randint(0, 1)}] + [
                {"other": f"o{k}{i}", "n": draw.randint(20, 90)} for i in range(draw.randint(1, 3))
            ]
            steps.append({"word": f"w{k}", "readings": readings, "before": None, "n_before": None, "after": None})
        for a, b in itertools.pairwise(steps):
            a["after"], b["before"] = b["word"], a["word"]
        steps[0] |= {"before": draw.choice([None, "start"]), "n_before": 50}
        steps[-1]["after"] = draw.choice([None, "end"])
        names = [[steps[0]["before"]], *[[r["other"] for r in s["readings"]] for s in steps], [steps[-1]["after"]]]
        pairs = {(x, y): draw.randint(0, 20) for a, b in itertools.pairwise(names) for x in a for y in b if x and y}

        def price(path, steps=steps, pairs=pairs, names=names):
            total, before, n_before = 0.0, names[0][0], steps[0]["n_before"]
            written = [names[0][0], *[s["word"] for s in steps]]
            for k, (r, s) in enumerate(zip(path, steps, strict=True)):
                same = r["other"] == s["word"]
                total -= math.log(1 - c.error_rate) if same else math.log(c.error_rate / (len(s["readings"]) - 1))
                single = max(r["n"], 0.5) / 1000
                if before is None or n_before <= 0:
                    total -= math.log(single)
                else:
                    together = max(0, pairs.get((before, r["other"]), 0) - (same and before == written[k]))
                    total -= math.log(c.pairs * together / n_before + (1 - c.pairs) * single)
                before, n_before = r["other"], r["n"]
            after = steps[-1]["after"]
            if after is not None:
                together = max(0, pairs.get((before, after), 0) - (before == written[-1])) / n_before if n_before > 0 else 0
                total -= math.log(c.pairs * together + (1 - c.pairs) / 1000)
            return total

        best = min(price(p) for p in itertools.product(*[s["readings"] for s in steps]))
        by_name = [{r["other"]: r for r in s["readings"]} for s in steps]
        got = best_reading(steps, pairs, 1000.0, c)
        assert math.isclose(price([by_name[k][w] for k, w in enumerate(got)]), best, abs_tol=1e-9)


def test_planted_misspellings_are_restored_and_clean_words_stay(spark):
    draw = random.Random(10)
    letters = "abcdefghijklmnoprstuvw"
    vocabulary = list({"".join(draw.choice(letters) for _ in range(draw.randint(5, 9))) for _ in range(300)})
    follows = {w: draw.sample(vocabulary, 4) for w in vocabulary}
    rare = ["".join(draw.choice(letters) for _ in range(8)) for _ in range(200)]
    texts, clean, planted = [], [], 0
    for i in range(600):
        words, w = [], draw.choice(vocabulary)
        for _ in range(40):
            words.append(w)
            w = draw.choice(follows[w])
        if i < 200:
            words[20] = rare[i]
        clean.append(" ".join(words))
        if i % 3 == 0:
            at = draw.randrange(5, 15)
            word = words[at]
            k = draw.randrange(len(word) - 1)
            wrong = draw.choice([word[:k] + word[k + 1 :], word[:k] + "z" + word[k:], word[:k] + "x" + word[k + 1 :]])
            words[at] = wrong.capitalize() if i % 2 else wrong
            clean[-1] = " ".join(x.capitalize() if n == at and i % 2 else x for n, x in enumerate(clean[-1].split()))
            planted += 1
        texts.append(" ".join(words) + ". [EMAIL]")
    frame = spark.createDataFrame([*enumerate(texts), (9000, None), (9001, "")], "id long, text string")
    out = {r["id"]: r for r in correct_texts(frame).collect()}
    restored = sum(out[i]["corrected"] == clean[i] + ". [EMAIL]" for i in range(0, 600, 3))
    assert restored >= 0.9 * planted
    untouched = [i for i in range(600) if i % 3]
    assert all(out[i]["corrected"] == texts[i] and out[i]["changes"] == 0 for i in untouched)
    assert out[9000]["corrected"] is None and out[9001]["corrected"] == ""


def test_tokens_and_counts(spark):
    frame = spark.createDataFrame([(1, "Ab ab [NAME] cd-ab"), (2, None), (3, "..")], "id long, text string")
    rows = tokens(frame)
    assert sorted((r["at"], r["word"], r["before"], r["after"]) for r in rows.collect()) == [
        (0, "ab", None, "ab"), (1, "ab", "ab", None), (3, "cd", None, "ab"), (4, "ab", "cd", None),
    ]
    counts = {r["word"]: (r["n"], r["first"]["at"], r["last"]["at"]) for r in word_counts(rows).collect()}
    assert counts == {"ab": (3, 0, 4), "cd": (1, 3, 3)} and Counter(counts).total


def test_corrections_send_no_table_of_the_collection_through_the_driver(spark, capsys):
    words = [f"word{c}{d}{e}" for c in "abcdefgh" for d in "abcdefgh" for e in "abcdefgh"]
    frame = spark.createDataFrame([(i, " ".join(words[i::7] * (30 if i % 2 else 1))) for i in range(7)], "id long, text string")
    for made in (neighbours(word_counts(tokens(frame))), correct_texts(frame)):
        made.explain()
        assert "Broadcast" not in capsys.readouterr().out


# --- tagger -----------------------------------------------------------------------------------


def test_labels_and_chances_are_those_of_all_sequences():
    draw = np.random.default_rng(3)
    for _ in range(60):
        n, k = int(draw.integers(1, 6)), int(draw.integers(2, 5))
        scores, moves = draw.normal(size=(n, k)) * 2, draw.normal(size=(k, k))
        paths = list(itertools.product(range(k), repeat=n))
        totals = [sum(scores[i, p] for i, p in enumerate(q)) + sum(moves[a, b] for a, b in itertools.pairwise(q)) for q in paths]
        assert tuple(best_labels(scores, moves)) == paths[int(np.argmax(totals))]
        weight = np.exp(np.array(totals) - max(totals))
        want = np.zeros((n, k))
        for q, w in zip(paths, weight, strict=True):
            want[range(n), q] += w / weight.sum()
        assert np.allclose(chances(scores, moves), want)


def test_a_fitted_tagger_finds_names_it_has_not_seen(spark):
    draw = random.Random(4)
    name = lambda: "".join(draw.choice("bdfgklmn") + draw.choice("aeiou") for _ in range(3)).capitalize()
    filler = ["we", "met", "and", "Then", "went", "home", "Later", "it", "rained", "Monday"]

    def made():
        text, spans = "", []
        for _ in range(draw.randint(1, 4)):
            text += " ".join(draw.choices(filler, k=draw.randint(2, 5)))
            if draw.random() < 0.7:
                who = f"{name()} {name()}" if draw.random() < 0.5 else name()
                text += " signed by "
                spans.append((len(text), len(text) + len(who), "PS"))
                text += who + draw.choice([".", " today", ","])
            text += "\n"
        return text, spans

    kind = "text string, spans array<struct<start:int,end:int,label:string>>"
    train, test = [made() for _ in range(400)], [made() for _ in range(200)]
    tagger = fit_tagger(spark.createDataFrame([*train, (None, []), ("", [])], kind), ["PS"], Chain(shards=3, epochs=4))
    found = tagger.recognize([t for t, _ in test])
    want = {(i, *s) for i, (_, spans) in enumerate(test) for s in spans}
    got = {(i, a, b, label) for i, spans in enumerate(found) for a, b, _, label, _ in spans}
    assert len(want & got) >= 0.95 * len(want) and len(want & got) >= 0.95 * len(got)
    assert all(t[a:b] == w and 0 <= s <= 1 for (t, _), spans in zip(test, found, strict=True) for a, b, w, _, s in spans)
    assert tagger.recognize(["", "\n\n"]) == [[], []]
    frame = spark.createDataFrame([("we met signed by Bakelo Fina.",), (None,)], "text string")
    rows = frame.select(recognizer_column(F.col("text"), tagger).alias("s")).collect()
    assert [s["text"] for s in rows[0]["s"]] == ["Bakelo Fina"] and not rows[1]["s"]


def test_a_name_may_end_inside_a_word_and_rows_may_come_in_any_order(spark):
    draw = random.Random(5)

    def made():
        who = "".join(draw.choice("김이박최정강조윤장임") for _ in range(draw.choice([2, 3, 4, 5, 5])))
        text = f"소속: 개발팀\n작성자: {who} 대리\n확인했습니다"
        return text, [(13, 13 + min(4, len(who)), "PS")]

    kind = "text string, spans array<struct<start:int,end:int,label:string>>"
    train, test = [made() for _ in range(200)], [made() for _ in range(100)]
    fitted = [fit_tagger(spark.createDataFrame(rows, kind), ["PS"], Chain(shards=2, epochs=4)) for rows in (train, train[::-1])]
    assert np.array_equal(fitted[0].weights, fitted[1].weights) and np.array_equal(fitted[0].moves, fitted[1].moves)
    found = fitted[0].recognize([t for t, _ in test])
    right = sum([(a, b, n) for a, b, _, n, _ in f] == spans for f, (_, spans) in zip(found, test, strict=True))
    assert right >= 95


# --- answers ----------------------------------------------------------------------------------


def test_importance_is_the_dense_eigenvector():
    draw = random.Random(6)
    for _ in range(40):
        sentences = [" ".join(draw.choices(["cat", "dog", "sun", "sea", "ink", "oak", "?"], k=draw.randint(0, 6))) for _ in range(draw.randint(1, 9))]
        model = RankedSentences(pull=draw.choice([0.2, 0.7]))
        question = " ".join(draw.choices(["cat", "sea", "none"], k=3))
        step, start = model.transitions(question, sentences)
        assert np.allclose(step.sum(axis=1), 1)
        whole = model.pull * np.outer(np.ones(len(sentences)), start) + (1 - model.pull) * step
        values, vectors = np.linalg.eig(whole.T)
        top = np.real(vectors[:, np.argmax(np.real(values))])
        assert np.allclose(model.importance(question, sentences), top / top.sum(), atol=1e-8)


def test_answers_name_their_passages():
    context = "The sea is cold. Ships wait.\n\nA cat sat there. The cat likes the warm oven."
    model = RankedSentences(sentences=1)
    assert model.answer(["x\n\nQuestion: what does the cat like\n\nAnswer:", "q"], [context, " "]) == ["The cat likes the warm oven. [2]", ""]


# --- boundaries -------------------------------------------------------------------------------


def test_abbreviations_do_not_end_sentences(spark):
    draw = random.Random(2)
    plain = ["haus", "baum", "geht", "kommt", "sieht", "heute", "morgen", "gern", "oft", "viel"]
    texts = []
    for _ in range(300):
        words = draw.choices(plain, k=6)
        texts.append(f"Dr. {words[0]} {words[1]} z. B. {words[2]}. {words[3].capitalize()} {words[4]} {words[5]}.")
    frame = spark.createDataFrame([*enumerate(texts), (999, None), (1000, "")], "id long, text string")
    found = abbreviations(stop_counts(frame)).collect()
    assert {r["word"] for r in found} == {"dr", "z", "b"} and all(r["without"] == 0 for r in found)
    split = frame.select(learned_sentences(F.col("text"), [r["word"] for r in found]).alias("s")).where("size(s) > 0").collect()
    assert [len(r["s"]) for r in split] == [2] * 300 and split[0]["s"][0].startswith("Dr. ") and " z. B. " in split[0]["s"][0]
    assert abbreviations(stop_counts(frame.limit(0))).count() == 0
    row = spark.createDataFrame([("A b. C",)], "text string").select(learned_sentences(F.col("text"), []).alias("s")).first()
    assert row["s"] == ["A b.", "C"]


def test_language_grams_are_counted_in_their_task(spark):
    """Counts and sums leave a task, not a row per n-gram; both agree with one row per n-gram."""
    rows = [(1, "a \U0001f600b a  1 aB\x00c"), (2, "ab"), (3, ""), (4, None), (5, "été " * 50), (6, "été")]
    frame = spark.createDataFrame([(i, "x" if i % 2 else "y", t) for i, t in rows], "id long, lang string, text string")
    for length in (1, 2, 3, 4, 5):
        g = Grams(length=length, segment=30)
        apart = gram_rows(frame.where("text IS NOT NULL"), ["id", "lang"], g)
        counted = language_model.gram_counts(frame.where("text IS NOT NULL").select("text", "lang"), g)
        assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, apart.groupBy("lang", "gram").count().collect()))
        model = fit_languages(frame.select("text", "lang"), g)
        found = language_model.language_scores(frame.select("id", "text"), model, g)
        want = apart.select("id", "gram").join(model, "gram").groupBy("id", "lang").agg(F.sum("score").alias("score"), F.count("*").alias("n"))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.select("id", "lang", "score", "n").collect()))
        assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_counting_keeps_numbers_and_only_words_at_one_edit_meet(spark, capsys):
    frame = spark.createDataFrame([(i, "house garden [NAME] tree " * 10 + ("huose" if i == 3 else "")) for i in range(5)], "id long, text string")
    counts = word_counts(tokens(frame))
    counts.explain()
    plan = capsys.readouterr().out
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    found = neighbours(counts).collect()
    assert [(r["word"], r["other"], r["n"]) for r in found] == [("huose", "house", 50)]


def test_corrections_store_no_word_of_the_texts(spark, monkeypatch):
    import pagefold.operators.correction as correction

    stored, stage = {}, correction.stage_table

    def noted(df, name):
        made = stage(df, name)
        stored[name] = made.count()
        return made

    monkeypatch.setattr(correction, "stage_table", noted)
    frame = spark.createDataFrame([(i, "house garden tree " * 50 + ("huose" if i == 3 else "")) for i in range(5)], "id long, text string")
    changed = {r["id"]: r["changes"] for r in correct_texts(frame).collect()}
    assert changed == {0: 0, 1: 0, 2: 0, 3: 1, 4: 0}
    assert max(stored.values()) < 20
