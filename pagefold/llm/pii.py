"""Personal data: patterns, and a skip-chain conditional random field that keeps labels consistent in a document."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagefold.session import stage_table

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # the last means none of them

# The patterns of the contract, possessive where that changes no match.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_FROM_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Words with this many digits, or an @, are the field's variables.
DIGITS = 7
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = " .,;:!?'\"()[]{}<>|#*$%&="
# Strength of agreement: the same value again, the next variable in a line of text; its rounds.
SAME, CHAIN, ROUNDS = 4.0, 0.2, 10
NEXT = 40
# Evidence of one word alone is held below what a repetition gives; a span needs this probability.
ALONE, LIKELY = 2.5, 0.6
NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the patterns, leftmost and without overlaps per kind, by start."""
    found = []
    if "@" in text:
        last = 0
        for m in EMAIL_FROM_AT.finditer(text):
            # All characters before the @ that may stand there belong to the leftmost match.
            start = m.start()
            while start > last and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start():
                last = m.end()
                found.append((start, last, 0))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def shape(word: str) -> int:
    """One of a few thousand classes: digits (up to 20), letters or not, which signs."""
    digits = min(20, sum(c.isdigit() for c in word))
    signs = sum(1 << i for i, c in enumerate("@.-+()/_") if c in word)
    return digits * 512 + (256 if any(c.isalpha() for c in word) else 0) + signs


def variables(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, str]]:
    """(start, end, label, shape, value) of base spans and of further words with many digits or an @.

    The value is what a repetition shares: the last digits of a number, the name of an address.
    """
    out, covered, reach = [], iter(spans), 0
    marks = []
    for a, b, k in covered:
        if a >= reach:  # of spans that overlap, the first stands for the place
            marks.append((a, b, k))
            reach = b
    for a, b, k in marks:
        out.append((a, b, k, shape(text[a:b]), value(text[a:b])))
    edges = np.array([m[0] for m in marks]), np.array([m[1] for m in marks])
    for m in _candidates(text):
        word = m[0].strip(EDGE)
        start = m.start() + m[0].find(word) if word else m.start()
        end = start + len(word)
        if not word or not ("@" in word or sum(c in "0123456789" for c in word) >= DIGITS):
            continue
        at = int(np.searchsorted(edges[1], start, side="right")) if marks else 0
        if at < len(marks) and edges[0][at] < end:
            continue
        out.append((start, end, LABELS - 1, shape(word), value(word)))
    return sorted(out)


def _candidates(text: str) -> Iterator[re.Match]:
    """Words that hold a digit or an @; most texts have few, so they are looked for from there."""
    at = 0
    for m in SOME.finditer(text):
        if m.start() < at:
            continue
        start = m.start()
        while start > at and not text[start - 1] in BLANK:
            start -= 1
        word = TOKEN.match(text, start)
        at = word.end()
        yield word


SOME = re.compile(r"[0-9@]")
BLANK = frozenset(" \t\n\v\f\r")


def value(word: str) -> str:
    if "@" in word:
        return word.split("@")[0].lower().strip(EDGE)
    return NOT_DIGIT.sub("", word)[-DIGITS:]


def infer(found: list[tuple[int, int, int, int, str]], unary: dict[int, list[float]]) -> list[tuple[int, int, int]]:
    """Spans beyond the base ones: words whose most likely label, given all others, is an entity.

    Every variable is linked to the next one nearby, and to the next with the same value wherever it
    stands, which is linear in their number. Messages go both ways along all links for some rounds.
    Base spans keep their label.
    """
    free = [i for i, v in enumerate(found) if v[2] == LABELS - 1]
    if len(free) in (0, len(found)):
        return []
    field = np.array([unary.get(v[3], [0.0] * LABELS) for v in found])
    for i, v in enumerate(found):
        if v[2] < LABELS - 1:
            field[i] = -12.0
            field[i, v[2]] = 0.0
    links, last = [], {}
    for i, v in enumerate(found):
        if i and v[0] - found[i - 1][1] <= NEXT:
            links.append((i - 1, i, CHAIN))
        if v[4] in last and len(v[4]) > 2:
            links.append((last[v[4]], i, SAME))
        last[v[4]] = i
    if not links:
        return []
    a = np.array([x[0] for x in links] + [x[1] for x in links])
    b = np.array([x[1] for x in links] + [x[0] for x in links])
    force = np.exp(np.array([x[2] for x in links] * 2))[:, None]
    back = np.roll(np.arange(len(a)), len(links))
    sent = np.zeros((len(a), LABELS))
    for _ in range(ROUNDS):
        belief = field.copy()
        np.add.at(belief, b, sent)
        out = belief[a] - sent[back]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        fresh = np.log(out.sum(axis=1, keepdims=True) + (force - 1) * out)
        fresh -= fresh.max(axis=1, keepdims=True)
        sent = 0.5 * sent + 0.5 * fresh
    belief = field.copy()
    np.add.at(belief, b, sent)
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    belief /= belief.sum(axis=1, keepdims=True)
    more = []
    for i in free:
        k = int(belief[i].argmax())
        if k < LABELS - 1 and belief[i, k] >= LIKELY:
            more.append((found[i][0], found[i][1], k))
    return more


FOUND = ", ".join(
    ["doc_id long", *[f"n_{k} long" for k in KINDS], "base_sha256 string", "base string",
     "variables array<struct<start:long,end:long,label:int,shape:int,value:string>>"]
)


def _detect(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct(
                [("start", pa.int64()), ("end", pa.int64()), ("label", pa.int32()), ("shape", pa.int32()),
                 ("value", pa.string())]
            )
        )
        names = ("start", "end", "label", "shape", "value")
        for batch in batches:
            rows = []
            for scalar in batch.column("text"):
                text = scalar.as_py()
                spans = base_spans(text)
                base = written(spans)
                counts = [sum(s[2] == k for s in spans) for k in range(len(KINDS))]
                found = [dict(zip(names, v, strict=True)) for v in variables(text, spans)]
                rows.append((*counts, sha256(base.encode()).hexdigest(), base, found))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * (len(KINDS) + 3)
            types = [*[pa.int64()] * len(KINDS), pa.string(), pa.string(), kind]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "variables"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, FOUND)


def learn(found: DataFrame) -> dict[int, list[float]]:
    """Log-odds of every label for every shape, from the base spans of all documents.

    Words that no pattern takes count as of no kind, so a shape says an entity only as often as a
    pattern takes it; what one word may say alone is bounded by ``ALONE``. Shapes are some thousands
    at most, whatever the input.
    """
    sums = found.select(F.explode_outer("variables").alias("v")).where("v is not null")
    counts = sums.groupBy(F.col("v.shape").alias("shape"), F.col("v.label").alias("label")).count().collect()
    table: dict[int, list[float]] = {}
    for r in counts:
        table.setdefault(r["shape"], [0.0] * LABELS)[r["label"]] += r["count"]
    out = {}
    for s, row in table.items():
        odds = np.log(np.array(row) + 0.5) - np.log(row[-1] + 0.5)
        out[s] = np.clip(odds, -2 * ALONE, -ALONE).tolist()
        out[s][-1] = 0.0
    return out


def spans_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_email`` to ``n_phone`` and ``base_sha256`` of the patterns' spans, ``spans``.

    ``spans`` holds those and what the field adds: numbers and addresses that no pattern takes but
    that repeat, far away or in another form, one that a pattern takes. Null texts are empty;
    repeated rows stay; an empty table gives no rows; columns other than id and text are not read.
    What the patterns find is stored once: the field's weights are counted in all documents first.
    """
    found = stage_table(_detect(docs), "variables")
    unary = learn(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for base, these in zip(
                batch.column("base").to_pylist(), batch.column("variables").to_pylist(), strict=True
            ):
                more = infer([(v["start"], v["end"], v["label"], v["shape"], v["value"]) for v in these], unary)
                if more:
                    held = [s.split(":") for s in base.split(",")]
                    spans = [(int(a), int(b), KINDS.index(k)) for k, a, b in held] + more
                    base = written(sorted(spans, key=lambda s: (s[0], s[2])))
                out.append(base)
            kept = [n for n in batch.schema.names if n not in ("base", "variables")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], pa.array(out, pa.string())], names=[*kept, "spans"]
            )

    schema = ", ".join(["doc_id long", *[f"n_{k} long" for k in KINDS], "base_sha256 string", "spans string"])
    return found.mapInArrow(run, schema)
