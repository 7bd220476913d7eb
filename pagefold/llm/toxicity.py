"""Toxicity: a learned lexicon, matched with spelling errors by an automaton, weighed by its context."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pagefold.llm.common import packed, pieces, unpacked

# Bounds of the sample a model is fitted on, and of the lexicon; scoring has none.
LABELLED = 12_000
LEXICON = 256
THRESHOLD = 0.7
# Stems and words must be this much likelier, in logarithms, in texts marked toxic.
LEAST_EVIDENCE = 2.5
# Where nothing is known of a lexicon's texts: part of the strongest weight from which a word is also found misspelt.
STRONG = 0.8
STEMS = (4, 5, 6, 7)
WORD = re.compile(r"[^\W\d_]+")
# Words and automaton states a task remembers; what is forgotten is computed again.
REMEMBERED, STATES = 50_000, 20_000

# Signs and words of quotation.
QUOTES = "\"“”„«»‹›"
REPORTING = frozenset(
    "said says say called call calls quote quoted quotes word words term wrote writes "
    "sagte sagt nannte wort zitat dit disait mot appelle dijo dice palabra llama".split()
)
QUOTED_PART = 0.25
NEAR = 60


@dataclass
class Lexicon:
    """Weighted entries: whole words, matched with errors, and stems, matched as they begin a word.

    ``forms`` are whole words that a stem stands for, found with errors where the stem is not.
    ``clean`` are words near an entry that clean texts hold too often: they are no misspellings.
    ``learned`` tells that ``clean`` was counted; without it only the strongest words allow errors.
    """

    words: dict[str, float]
    stems: dict[str, float]
    forms: dict[str, str] = field(default_factory=dict)
    clean: frozenset[str] = frozenset()
    learned: bool = False
    _states: dict = field(default_factory=dict, repr=False)
    _known: dict = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self.nodes: list[dict[str, int]] = [{}]
        self.ends: dict[int, str] = {}
        self.begins: dict[int, str] = {}
        self.wholes: dict[int, str] = {}
        for table, marks in ((self.words, self.ends), (self.stems, self.begins), (self.forms, self.wholes)):
            for entry in table:
                at = 0
                for c in entry:
                    if c not in self.nodes[at]:
                        self.nodes[at][c] = len(self.nodes)
                        self.nodes.append({})
                    at = self.nodes[at][c]
                marks[at] = entry
        most = max(self.words.values(), default=0.0)
        self.errors = {w: allowed(w) if self.learned or e >= STRONG * most else 0 for w, e in self.words.items()}
        # Nodes under which only exact entries lie allow no error.
        self.reach = [0] * len(self.nodes)
        for node in range(len(self.nodes) - 1, -1, -1):
            own = self.errors[self.ends[node]] if node in self.ends else 0
            own = max(own, allowed(self.wholes[node])) if node in self.wholes else own
            self.reach[node] = max([own, *(self.reach[child] for child in self.nodes[node].values())])
        self.start = self._closed({(0, 0, "")})

    def _closed(self, states: set[tuple[int, int, str]]) -> frozenset:
        """States with those reached by leaving out letters of an entry; ``skipped`` waits for a swap."""
        todo, all_states = list(states), set(states)
        while todo:
            node, errors, skipped = todo.pop()
            if skipped:
                continue
            for child in self.nodes[node].values():
                more = (child, errors + 1, "")
                if errors + 1 <= self.reach[child] and more not in all_states:
                    all_states.add(more)
                    todo.append(more)
        return frozenset(all_states)

    def _step(self, states: frozenset, c: str) -> frozenset:
        """One letter read by the Levenshtein automata of all entries, walked together on their trie."""
        after: set[tuple[int, int, str]] = set()
        for node, errors, swapped in states:
            if swapped:  # the letter before was the next but one: now the one it jumped over
                if swapped == c:
                    after.add((node, errors, ""))
                continue
            for letter, child in self.nodes[node].items():
                if letter == c:
                    after.add((child, errors, ""))
                elif errors < self.reach[child]:
                    after.add((child, errors + 1, ""))
                    if c in self.nodes[child]:
                        after.add((self.nodes[child][c], errors + 1, letter))
            if errors < self.reach[node]:
                after.add((node, errors + 1, ""))
        return self._closed(after)

    def match(self, word: str) -> tuple[str, float, str] | None:
        """(``word``, ``near`` or ``stem``; weight; entry) of the best entry for a lower-case word."""
        if word in self._known:
            return self._known[word]
        states, stem = self.start, None
        for c in word:
            key = (states, c)
            states = self._states.get(key)
            if states is None:
                if len(self._states) >= STATES:
                    self._states.clear()
                states = self._states[key] = self._step(*key)
            if not states:
                break
            for node, errors, swapped in states if self.begins else ():
                if errors == 0 and not swapped and node in self.begins:
                    stem = self.begins[node]
        found = None
        sure = word in self.clean
        for node, errors, swapped in states:
            if swapped or (errors and sure):
                continue
            if node in self.ends and errors <= self.errors[self.ends[node]]:
                weight = self.words[self.ends[node]] / (1 + errors)
                if found is None or (weight, self.ends[node]) > found[1:]:
                    found = ("near" if errors else "word", weight, self.ends[node])
        if found is None and stem:
            found = ("stem", self.stems[stem], stem)
        for node, errors, swapped in states if found is None and not sure else ():
            if not swapped and node in self.wholes and errors <= allowed(self.wholes[node]):
                entry = self.forms[self.wholes[node]]
                weight = self.stems[entry] / (1 + errors)
                if found is None or (weight, entry) > found[1:]:
                    found = ("near", weight, entry)
        if len(self._known) >= REMEMBERED:
            self._known.clear()
        self._known[word] = found
        return found


def allowed(entry: str) -> int:
    """Errors that may be found in a word: none in short ones, as they would become other words."""
    return 0 if len(entry) < 5 else 1 if len(entry) < 9 else 2


KINDS = ("word", "near", "stem")
FEATURES = 9


def features(text: str, lexicon: Lexicon) -> list[float]:
    """What the score sees: evidence per kind, alone and per length, entries hit, length.

    An entry between quotation marks, or close to a word of reporting, counts a quarter.
    """
    low = text.lower()
    words = WORD.findall(low)
    hits = {w: m for w in set(words) if (m := lexicon.match(w))}
    sums, entries = dict.fromkeys(KINDS, 0.0), set()
    if hits:
        for found in WORD.finditer(low):
            match = hits.get(found[0])
            if match:
                before = low[max(0, found.start() - NEAR) : found.start()]
                after = low[found.end() : found.end() + NEAR]
                opened = sum(before.count(q) for q in QUOTES)
                quoted = (opened % 2 == 1 and any(q in after for q in QUOTES)) or not REPORTING.isdisjoint(
                    WORD.findall(before)[-4:]
                )
                sums[match[0]] += match[1] * (QUOTED_PART if quoted else 1.0)
                entries.add(match[2])
    per = 100 / (len(words) + 20)
    exact = {e for e in entries if e in lexicon.words}
    return [
        *(math.log1p(sums[k]) for k in KINDS),
        *(math.log1p(sums[k] * per) for k in KINDS),
        float(min(len(exact), 6)),
        float(min(len(entries) - len(exact), 6)),
        math.log1p(len(words)) / 10,
    ]


@dataclass(frozen=True)
class Toxicity:
    lexicon: Lexicon
    weights: tuple[float, ...]

    def score(self, text: str) -> float:
        z = sum(w * x for w, x in zip(self.weights, [1.0, *features(text, self.lexicon)], strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic, half`` of at most ``LABELLED`` distinct labelled texts that are not held out.

    Held out are ids whose crc32, as text, leaves 1 by 3. The sample takes the smallest hashes.
    """
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(LABELLED)
    )
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    return rows.groupBy("text").agg(F.max("toxic").alias("toxic")).withColumn(
        "half", F.pmod(F.xxhash64("text", F.lit("half")), F.lit(2))
    )


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Words and stems that texts marked toxic hold far more often than others.

    Counted in texts of the sample; of entries that begin one another the one that explains most
    stays, a word before its stems. Words near an entry are counted likewise, and those that are
    not far more often in texts marked toxic are kept as ``clean``.
    """
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    bad, good = counts.get(1, 0), counts.get(0, 0)
    words = F.array_distinct(F.split(F.lower("text"), "[^\\p{L}]+"))
    each = rows.select("toxic", F.explode_outer(words).alias("word")).where(F.length("word") > 2)
    whole = each.select("toxic", F.lit(True).alias("whole"), F.col("word").alias("entry"), F.lit(1).alias("n"))
    hold = rows.select("toxic", words.alias("words"))

    def stems_of(k: int) -> DataFrame:
        longer = F.filter("words", lambda w: F.length(w) > k)
        stems = F.array_distinct(F.transform(longer, lambda w: F.substring(w, 1, k)))
        made = hold.select("toxic", F.explode_outer(stems).alias("entry"))
        return made.select("toxic", F.lit(False).alias("whole"), "entry", F.lit(1).alias("n"))

    for k in STEMS:
        whole = whole.unionAll(stems_of(k).where(F.col("entry").isNotNull()))
    t, c = F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)), F.sum(F.when(F.col("toxic") == 1, 0).otherwise(1))
    seen = whole.groupBy("entry", "whole").agg(t.alias("t"), c.alias("c")).where(F.col("t") >= max(4, bad // 100))
    evidence = F.log((F.col("t") + 0.5) / (bad + 1) / ((F.col("c") + 0.5) / (good + 1)))
    ranked = (
        seen.withColumn("evidence", evidence)
        .where(F.col("evidence") >= LEAST_EVIDENCE)
        .orderBy(F.desc(F.col("t") * F.col("evidence")), F.desc("whole"), "entry")
        .limit(LEXICON * 8)
        .collect()
    )
    chosen: dict[bool, dict[str, float]] = {True: {}, False: {}}
    forms: dict[str, str] = {}
    taken: list[str] = []
    for r in ranked:
        entry = r["entry"]
        if len(taken) < LEXICON and not any(entry.startswith(o) or o.startswith(entry) for o in taken):
            taken.append(entry)
            chosen[r["whole"]][entry] = round(r["evidence"], 6)
        elif r["whole"]:
            forms |= {entry: o for o in taken if entry.startswith(o) and o in chosen[False]}
    lexicon = Lexicon(chosen[True], chosen[False], forms, learned=True)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [w for w in batch.column("word").to_pylist() if (m := lexicon.match(w)) and m[0] == "near"]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["word"])

    held = each.groupBy("word").agg(t.alias("t"), c.alias("c")).where("c > 0")
    doubtful = held.where(evidence < LEAST_EVIDENCE).select("word")
    clean = frozenset(r["word"] for r in doubtful.mapInArrow(near, "word string").collect())
    return Lexicon(chosen[True], chosen[False], forms, clean, learned=True)


def fit(docs: DataFrame, labels: DataFrame) -> Toxicity:
    """Lexicon from one half of the sample, weights of the features from the other, by Newton's method."""
    rows = training_rows(docs, labels)
    lexicon = learn_lexicon(rows.where("half = 0"))
    held = rows.where("half = 1").select("text", F.col("toxic").cast("int").alias("toxic"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t, lexicon) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("toxic")], ["x", "y"])

    found = held.mapInArrow(run, "x array<double>, y int").collect()
    order = sorted((tuple(r["x"]), r["y"]) for r in found)
    x = np.array([[1.0, *v] for v, _ in order]).reshape(-1, FEATURES + 1)
    y = np.array([v for _, v in order], dtype=float)
    w = np.zeros(FEATURES + 1)
    w[0] = -2.0
    ridge = np.diag([1e-3, *[0.3] * FEATURES])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge @ w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge
        move = np.linalg.solve(bend + 1e-9 * np.eye(len(w)), slope)
        w -= move / max(1.0, float(np.abs(move).max()) / 3)
        if np.abs(move).max() < 1e-8:
            break
    return Toxicity(lexicon, tuple(round(float(v), 9) for v in w))


def _scores(rows: DataFrame, model: Toxicity) -> DataFrame:
    """Add ``score`` to rows with a column ``text``, which is replaced by it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            at = batch.schema.get_field_index("text")
            made = pa.array([model.score(t.as_py() or "") for t in batch.column(at)], pa.float64())
            columns = [made if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(
                columns, names=["score" if n == "text" else n for n in batch.schema.names]
            )

    schema = StructType([StructField("score", DoubleType()) if f.name == "text" else f for f in rows.schema])
    return rows.mapInArrow(run, schema)


def score_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Null texts count as empty and get the score of an empty text; a null id is not held out; rows
    that repeat stay; an empty table gives no rows, and without labels the score says little, but
    is defined. Columns other than id and text are not read.
    """
    scored = _scores(docs.select("doc_id", "text"), fit(docs, labels))
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return scored.select(
        "doc_id",
        (crc % 3 == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows below the threshold, with their columns; nulls and ties as in ``score_report``."""
    rows = packed(docs).select("row", F.col("row.text").alias("text"))
    scored = _scores(rows, fit(docs, labels))
    return unpacked(scored.where(F.col("score") < THRESHOLD))
