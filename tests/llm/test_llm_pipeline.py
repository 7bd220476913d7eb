"""The pipeline and the registered queries as the driver runs them."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from pagefold.llm import mixing
from pagefold.llm.oracles import LLM_ORACLES
from pagefold.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
CONTRACT = {
    "op1_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op2_quality_rules": {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean",
    },
    "op3_pii": {
        "doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
        "base_sha256": "string", "spans": "string",
    },
    "op6_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op7_substring": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op9_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op10_sharding": {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
        "grown_shard": "int",
    },
    "op12_resampling": dict.fromkeys(("doc_id", "n_features", "weight", "score", "rank"), "bigint"),
}


def test_every_operator_is_registered_once():
    numbers = [int(m[1]) for name in LLM_QUERIES if (m := re.fullmatch(r"op(\d+)_\w+", name))]
    assert sorted(numbers) == list(range(1, 14))
    assert set(LLM_QUERIES) | {"pipeline"} <= set(driver.queries()) and set(LLM_ORACLES) <= set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_and_types(spark, name):
    out = LLM_QUERIES[name](spark, SF)
    types = dict(out.dtypes)
    assert {c: types[c] for c in CONTRACT[name]} == CONTRACT[name]
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(r[0] for r in out.select("doc_id").collect()) == sorted(r[0] for r in documents.select("doc_id").collect())


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = con.execute(LLM_ORACLES[name])
    names = [c[0] for c in cursor.description]
    rows = [tuple(r) for r in LLM_QUERIES[name](spark, SF).select(*names).collect()]
    assert sorted(rows) == sorted(tuple(r) for r in cursor.fetchall())


def test_words_are_those_of_the_expression(spark):
    text = "a\x0bb\x0cc d e \r\n\tf  "
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    row = mixing.mix_report(spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")).first()
    assert row["size"] == len(words) == len(text.encode().split())
    assert [w.encode() for w in words] == text.encode().split()


def planted(documents, bench):
    """Documents with exact copies, near copies, half copies and passages of the benchmark among them."""
    rng = random.Random(11)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in documents]
    words = [t.split() for _, t, _ in rows]
    long = [i for i, w in enumerate(words) if 120 <= len(w) <= 600][:30]
    added, kinds = [], {}

    def add(kind, text, of):
        doc_id = 1_000_000 + len(added)
        kinds[doc_id] = kind
        added.append((doc_id, text, f"src{of % 3}"))

    for i in long[:12]:
        for _ in range(3):
            add("exact", rows[i][1], i)
    for i in long[12:24]:
        for changes in (1, 2, 14):
            changed = list(words[i])
            for at in rng.sample(range(len(changed)), changes):
                changed[at] = f"neu{rng.randrange(10**6)}"
            add("near" if changes < 3 else "half", " ".join(changed), i)
    passages = [b["text"].split() for b in bench if len(b["text"].split()) >= 16]
    for n, i in enumerate(long[24:]):
        part = passages[n][:16]
        part[5] = "anders" if n % 2 else part[5]
        add("passage", " ".join([*words[i][:60][::-1], *part, *words[i][60:][::-1]]), i)
    return rows + added, kinds


def groups(rows):
    """Per id the smallest id of its group: at least 0.8 of the 5-word shingles of a pair are common, from all pairs."""
    made = []
    for _, text, _ in rows:
        w = text.encode().lower().split()
        made.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))))
    at = {i: i for i in range(len(rows))}

    def top(i):
        while at[i] != i:
            i = at[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        small, large = sorted((len(made[a]), len(made[b])))
        if small >= 0.8 * large and len(made[a] & made[b]) >= 0.8 * len(made[a] | made[b]):
            at[top(a)] = top(b)
    least = {}
    for i, row in enumerate(rows):
        least[top(i)] = min(least.get(top(i), row[0]), row[0])
    return {row[0]: least[top(i)] for i, row in enumerate(rows)}


def longest_agreement(text, items):
    """The most words, out of 13 in a row, that a text has in common with an item at equal distances."""
    split = lambda t: [w for w in re.split(r"[^\w]+|_", t.lower()) if w]
    mine, best = split(text), 0
    for item in items:
        for shift in range(-len(item) + 1, len(mine)):
            same = [0 <= shift + q < len(mine) and mine[shift + q] == w for q, w in enumerate(item)]
            best = max(best, max(sum(same[i : i + 13]) for i in range(max(1, len(same) - 12))))
    return best


def test_pipeline_on_planted_documents(spark, tmp_path):
    """Every stage, on what the one before it kept, against plain Python that shares no code with it."""
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "mixing", "sharding"]
    tables = {n: spark.read.parquet(f"{LARGER}/{n}.parquet") for n in ("documents", "benchmark", "labels")}
    bench = tables["benchmark"].limit(40).collect()
    rows, kinds = planted(tables["documents"].collect(), bench)
    frame = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], tables["documents"].schema)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench).write.parquet(f"{tmp_path}/benchmark.parquet")
    tables["labels"].write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    def step(n):
        nonlocal docs
        docs = corpus_pipeline.STAGES[n][1](spark, docs, str(tmp_path))
        assert docs.columns[: len(frame.columns)] == frame.columns
        assert n == 4 or docs.columns == frame.columns
        docs.write.parquet(f"{tmp_path}/stage{n}.parquet")
        docs = spark.read.parquet(f"{tmp_path}/stage{n}.parquet")
        return [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]

    # Toxicity: known labels. A thousand documents teach few words; a hundred times as many are needed for nearly all.
    one = step(0)
    left = {r[0] for r in one}
    toxic = {r["doc_id"]: r["toxic"] for r in tables["labels"].collect()}
    marked = [i for i, x in toxic.items() if x and i < 1_000_000 and i in {r[0] for r in rows}]
    clean = [i for i, x in toxic.items() if not x and i in {r[0] for r in rows}]
    assert sum(i not in left for i in marked) >= 0.5 * len(marked) and sum(i in left for i in clean) >= 0.97 * len(clean)
    # Near copies: one of each group, and only those.
    two = step(1)
    group = groups(one)
    assert sorted(r[0] for r in two) == sorted(set(group.values()))
    assert all(group[i] != i for i, kind in kinds.items() if kind in ("exact", "near") and i in left)
    assert any(group[i] == i for i, kind in kinds.items() if kind == "half")
    # Benchmark: what agrees in 11 of 13 words goes, what agrees in fewer stays.
    three = step(2)
    items = [[w for w in re.split(r"[^\w]+|_", b["text"].lower()) if w] for b in bench]
    kept = {r[0] for r in three}
    for doc_id, text, _ in two:
        if kinds.get(doc_id) == "passage":
            assert doc_id not in kept and longest_agreement(text, items) >= 11
        elif doc_id not in kept:
            assert longest_agreement(text, items) >= 11
    # Mixing: words per source near the targets, at most two copies.
    four = step(3)
    times = Counter(r[0] for r in four)
    size = {r[0]: len(r[1].split()) for r in three}
    per, taken = Counter(), Counter()
    for doc_id, _, source in three:
        per[source] += size[doc_id]
    for doc_id, _, source in four:
        taken[source] += size[doc_id]
    assert set(times) <= kept and max(times.values()) <= 2
    target = targets(per)
    for source in per:
        most = max(size[i] for i, _, s in three if s == source)
        assert abs(taken[source] - target[source]) <= 2 * most
    # Sharding: the same rows, evenly.
    five = step(4)
    assert Counter(r[0] for r in five) == times
    weight = Counter({n: 0 for n in range(24)})
    for r in docs.collect():
        weight[r["shard"]] += len(r["text"].encode()) + 8
    even = sum(weight.values()) / 24
    assert set(weight) == set(range(24))
    assert max(weight.values()) <= even + 2 * max(len(r[1].encode()) + 8 for r in five)
    again = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter((r["doc_id"], r["shard"]) for r in again.collect()) == Counter((r["doc_id"], r["shard"]) for r in docs.collect())


def targets(per):
    """Sources by name weigh 3, 1, 2, share 150 % of all words, and get at most twice their own."""
    weight = {s: (3, 1, 2)[n % 3] for n, s in enumerate(sorted(per))}
    full = {}
    while True:
        rest = [s for s in per if s not in full]
        if not rest:
            return full
        left = 1.5 * sum(per.values()) - sum(full.values())
        level = {s: weight[s] * left / sum(weight[r] for r in rest) for s in rest}
        over = {s: 2.0 * per[s] for s in rest if level[s] > 2.0 * per[s]}
        if not over:
            return full | level
        full |= over
