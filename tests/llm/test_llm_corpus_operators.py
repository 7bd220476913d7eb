"""Spelling variants, resampling and packing against brute force, on given tables and on small odd ones."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict, deque
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagefold.llm import packing, resampling, spelling
from pagefold.llm.acceptor import Acceptor, common_start, one_edit_pairs

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row string, word string, n string, rank string, score string, block string, ids string, id string"
)
EXTRA = ("r", "w", "n", "k", "s", "b", "i", "d")


def table(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


LONG = " ".join(f"Wort{chr(97 + i % 17)}é{i % 977}, naïve's" for i in range(30_000))
ODD = [
    (1, "Alpha beta gamma alphas alpha Betas", "en", "a", 5),
    (2, "alpha alpha alphx ALPHA bétas bétas bétas bétis bétis bétis", "en", "b", 5),
    (2, "alpha alpha alphx ALPHA bétas bétas bétas bétis bétis bétis", "en", "b", 5),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \t\n\r", "en", None, 4),
    (None, "no id here but words alpha alpha", "en", "a", 3),
    (None, None, None, "b", None),
    (7, LONG, "de", "c", len(LONG)),
    (8, "é ü   x <|endoftext|> É<|EndOfText|> J̌ a b it's IT'S don't. \x1c \x85 z", "fr", "a", 3),
    (9, "word " * 40, "en", "c", 2),
    (10, "word " * 40, "en", "c", 2),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# Spelling variants -------------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_vocabulary(rows):
    times = Counter()
    fold = str.maketrans(spelling.UPPER, spelling.LOWER)
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(fold)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                times[run] += 1
    return {w: n for w, n in times.items() if n >= 3}


def plain_variants(times):
    holes = defaultdict(set)
    for w in times:
        for i in range(len(w)):
            holes[w[:i] + "\0" + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for group in holes.values():
        for a in group:
            near[a] |= group - {a}
    for w in times:
        for i in range(len(w)):
            if (short := w[:i] + w[i + 1 :]) in times:
                near[w].add(short)
                near[short].add(w)
    assert all(one_edit(a, b) for a in near for b in near[a])
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-times[x], x), default=None)
        if best is not None and times[best] >= 2 * times[w]:
            form[w] = best
    out = []
    for w, n in times.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), times[form[w]] if w in form else None))
    return sorted(out)


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abé", min_size=0, max_size=6), max_size=60))
def test_pairs_of_an_acceptor(words):
    listed = sorted(words)
    for length in range(7):
        held = [w for w in listed if len(w) in (length, length + 1)]
        for least in (0, 1, length // 2):
            want = {
                frozenset((a, b))
                for a in held
                for b in held
                if one_edit(a, b)
                and min(len(a), len(b)) == length
                and common_start(a, b) >= least
            }
            found = list(one_edit_pairs(held, length, least)) if held else []
            assert len(found) == len(want) and {frozenset(p) for p in found} == want


def test_acceptor_is_minimal_and_takes_very_long_words():
    accept = Acceptor(["tap", "taps", "top", "tops"])
    assert len(accept.arcs) == 5
    long = "ab" * 20_000
    found = one_edit_pairs(sorted([long, long[:-1] + "c", "x" + long]), len(long), 0)
    assert {frozenset(p) for p in found} == {frozenset((long, long[:-1] + "c")), frozenset((long, "x" + long))}


@pytest.mark.parametrize("part", [1, 8192])
def test_variants_of_given_words(spark, part):
    draw = random.Random(part)
    words = {"".join(draw.choice("abcé") for _ in range(draw.randint(5, 8))): draw.randint(3, 90) for _ in range(1500)}
    words |= {"a" * n: 2**n for n in range(5, 30)}  # one chain of forms
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert sorted(rows_of(spelling.variants(frame, part=part))) == plain_variants(words)


def test_variants_of_documents(spark, docs):
    times = plain_vocabulary([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(rows_of(spelling.variant_report(docs))) == plain_variants(times)
    odd = table(spark, ODD)
    want = plain_variants(plain_vocabulary([r[:2] for r in ODD]))
    assert sorted(rows_of(spelling.variant_report(odd))) == want and ("bétis", None) in {r[:2] for r in want}
    assert spelling.variant_report(odd.limit(0)).count() == 0


# Resampling --------------------------------------------------------------------------------------


def plain_features(text):
    fold = str.maketrans(spelling.UPPER, spelling.LOWER)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(fold))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [crc32(r.encode()) % 10_000 for r in runs]


def plain_resampling(rows, target):
    found = [plain_features(t) for _, t in rows]
    s, t = Counter(), Counter()
    for _, f in found:
        s.update(f)
    for text in target:
        t.update(plain_features(text)[1])
    whole, of = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (whole + 10_000) / ((s[b] + 1) * (of + 10_000)))) for b in range(10_000)]
    out = []
    for (doc_id, _), (n_words, f) in zip(rows, found, strict=True):
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: 5 * len(able) // 100]):
        row[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def test_resampling(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain_resampling(rows, [r.text for r in bench.collect()])
    found = resampling.resample_report(docs, bench)
    assert dict(found.dtypes) == dict.fromkeys(("doc_id", "n_features", "weight", "score", "rank"), "bigint")
    assert sorted(rows_of(found), key=repr) == want
    drawn = resampling.resample(docs, bench).collect()
    ranks = {r[0]: r[4] for r in want if r[4]}
    assert {r.doc_id: r["rank"] for r in drawn} == ranks and drawn[0].asDict().keys() == {*docs.columns, "rank"}


def test_resampling_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(resampling, "_BLOCK", 7)  # so that runs cross blocks
    odd, target = table(spark, ODD), spark.createDataFrame([("alpha word",), (None,), ("",)], "text string")
    found = resampling.resample_report(odd, target)
    assert sorted(rows_of(found), key=repr) == plain_resampling([r[:2] for r in ODD], ["alpha word", None, ""])
    assert resampling.resample_report(odd.limit(0), target).count() == 0
    assert rows_of(resampling.resample_report(odd, target.limit(0))) != []
    kept = resampling.resample(odd, target, percent=50).collect()
    assert sorted(r["rank"] for r in kept) == [1] and kept[0]["score"] == "s"


def test_ties_go_to_smaller_ids_and_repeated_rows_are_cut_exactly(spark):
    scores = [(i, 30, 1, 7, 5, i) for i in range(60)] + [(3, 30, 1, 7, 5, 100 + i) for i in range(20)]
    scores += [(None, 30, 1, 7, 5, 200), (99, 30, 1, 7, 9, 201), (98, 19, 1, 7, 10, 202)]
    frame = spark.createDataFrame(scores, "doc_id long, n_words long, n_features long, weight long, score long, number long")
    able = sorted((r for r in scores if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[5]))
    for percent in (1, 2, 10, 17, 50, 99, 100):
        want = {r[5]: place + 1 for place, r in enumerate(able[: len(able) * percent // 100])}
        found = resampling.ranked(frame, percent).collect()
        assert len(found) == len(scores) and {r.number: r["rank"] for r in found if r["rank"]} == want


# Packing -----------------------------------------------------------------------------------------


with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
    DESCRIPTION = file.read()
REFERENCE = Tokenizer.from_str(DESCRIPTION)


@pytest.fixture(scope="module")
def tokenizer():
    return REFERENCE


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("aAzZ09ß÷ÿýà'.,!?-_<|> \t\n\x0b\x0c\x1c\x85  éÉßİΣς…̌́̇JHTi中़<|endoftext|>")), max_size=30))
def test_ids_are_the_tokenizers(text):
    ids = packing.ids_of(DESCRIPTION)
    found = [int(i) for part in ids.of(text.encode()) for i in np.frombuffer(part, ids.kind)]
    assert found == REFERENCE.encode(text, add_special_tokens=False).ids


def check_packing(rows, pieces, tokenizer, length=4096):
    """``rows`` (id, text), ``pieces`` with their ids: an exact round trip, and hardly any padding."""
    want = Counter((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] > 0
        by_doc[p["doc_id"], p["doc_tokens"]].append((p["start"], ids))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    sizes = []
    for number in range(len(by_sequence)):
        place = 0
        for offset, n in sorted(by_sequence[number]):
            assert offset == place
            place += n
        sizes.append(place)
    full = [n for n in sizes if n == length]
    rest = sizes[len(full) :]
    assert sizes == full + sorted(rest, reverse=True) and len(set(rest)) == len(rest)
    assert all(n & (n - 1) == 0 and n < length for n in rest)
    if all(n == 1 for n in Counter(i for i, _ in rows).values()):
        made = Counter()
        for (doc_id, tokens), parts in by_doc.items():
            ids = [x for _, part in sorted(parts) for x in part]
            assert len(ids) == tokens and [s for s, _ in sorted(parts)] == np.cumsum([0, *[len(p) for _, p in sorted(parts)]])[:-1].tolist()
            made[doc_id, tuple(ids)] += 1
        assert made == want
    assert sum(sizes) == sum(len(ids) * n for (_, ids), n in want.items())


@pytest.mark.parametrize("block", [5000, 1 << 20])
def test_packing_round_trip(spark, docs, tokenizer, monkeypatch, block):
    monkeypatch.setattr(packing, "BLOCK", block)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    pieces = packing.pack(docs).collect()
    check_packing(rows, pieces, tokenizer)
    # Every full window holds every source at its share, but for the few tokens of a block's end.
    share = Counter()
    windows = defaultdict(Counter)
    for p in pieces:
        share[p["source"]] += p["length"]
        windows[p["sequence_id"]][p["source"]] += p["length"]
    whole = sum(share.values())
    for window in windows.values():
        if window.total() == 4096:
            assert all(abs(window[s] - 4096 * n / whole) <= 3 for s, n in share.items())
    report = packing.packing_report(docs)
    types = dict.fromkeys(("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"), "bigint")
    assert dict(report.dtypes) == types
    key = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")
    sums = {tuple(p[k] for k in key): crc32(p["ids"]) for p in pieces}
    assert {tuple(r[k] for k in key): r["ids_crc32"] for r in report.collect()} == sums
    assembled = packing.assemble(packing.pack(docs)).collect()
    assert sum(len(r["ids"]) for r in assembled) == 4 * whole


def test_packing_odd_rows(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "PART", 1000)
    monkeypatch.setattr(packing, "_SEGMENT", 5000)
    odd = [(100 + i, *r[1:]) for i, r in enumerate(ODD)]
    check_packing([r[:2] for r in odd], packing.pack(table(spark, odd)).collect(), tokenizer)
    check_packing([r[:2] for r in ODD], packing.pack(table(spark, ODD)).collect(), tokenizer)
    assert packing.pack(table(spark, ODD).limit(0)).count() == 0


@pytest.mark.parametrize("weights", [{"src0": 5.0, "src1": 0.25}, {}])
def test_packing_with_weights(spark, docs, tokenizer, monkeypatch, weights):
    monkeypatch.setattr(packing, "BLOCK", 20_000)
    pieces = packing.pack(docs, weights=weights).collect()
    check_packing([(r.doc_id, r.text) for r in docs.collect()], pieces, tokenizer)
    first = Counter()
    for p in pieces:
        if p["sequence_id"] < 4:
            first[p["source"]] += p["length"]
    sources = {p["source"] for p in pieces}
    total = sum(weights.get(s, 1.0) for s in sources)
    assert all(abs(first[s] - 4 * 4096 * weights.get(s, 1.0) / total) <= 3 for s in sources)


def test_one_source_has_nearly_all_tokens(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 9000)
    rows = [(i, "some words here " * 50, "en", "hot", 1) for i in range(400)]
    rows += [(1000 + i, "other " * i, "en", f"s{i}", 1) for i in range(40)]
    check_packing([r[:2] for r in rows], packing.pack(table(spark, rows)).collect(), tokenizer)


def test_deficits_are_carried():
    def queues():
        return [deque([[0, 0, 700]]), deque([[1, 0, 299]]), deque([[2, 0, 1]])]

    def run(first, ends):
        held = defaultdict(Counter)
        for end, row, _, n in packing.deficit_round_robin(queues(), first, ends):
            held[end][row] += n
        return held

    held = run(0, list(range(10, 1001, 10)))
    assert all(w.total() == 10 for w in held.values())
    served = Counter()
    for end, window in held.items():
        served.update(window)
        assert abs(served[0] - 0.7 * end) < 2 and abs(served[1] - 0.299 * end) < 2
    assert list(packing.sequences_between(8000, 8200, 9000, 4096)) == [(1, 4096, 8192), (2, 8192, 8704)]
    assert list(packing.sequences_between(8192, 9000, 9000, 4096))[-1] == (5, 8992, 9000)


def test_running_sums(spark):
    rows = [(k, k % 7) for k in range(0, 5000, 3)]
    frame = packing._running(spark.createDataFrame(rows, "k long, v long"), "k", "v", "before", group=64)
    total, want = 0, {}
    for k, v in rows:
        want[k], total = total, total + v
    assert {r["k"]: r["before"] for r in frame.select("k", F.col("before")).collect()} == want
