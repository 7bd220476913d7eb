"""Counts of a whole text that rules of quality look at."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANKS = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII = bytes(range(128))
LETTERS = CAPITALS + CAPITALS.lower()
WINDOW = 5

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_upper", "n_letters", "n_other", "n_marks", "longest_run",
)


def repeated(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that are found twice or more, the first included."""
    if len(words) <= window:
        return 0
    starts = zip(*(words[i:] for i in range(window)), strict=False)
    hashes = np.fromiter(map(hash, starts), dtype=np.int64, count=len(words) - window + 1)
    _, back, times = np.unique(hashes, return_inverse=True, return_counts=True)
    if len(times) == len(hashes):
        return 0
    twice = (times > 1)[back]
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[: len(twice)] += twice
    edges[window : window + len(twice)] -= twice
    return int((edges.cumsum()[:-1] > 0).sum())


def text_counts(text: bytes) -> tuple[int, ...]:
    """The numbers named in ``COUNTS``, of UTF-8 text; ``bytes`` splits at ASCII blanks only.

    Capitals and letters are those of ASCII; ``n_other`` are its characters that are neither blank nor letter.
    """
    words = text.split()
    bare = text.translate(None, BLANKS)
    whole = bare.decode("utf-8", "replace")
    lines = [line for line in text.split(b"\n") if line.strip()]
    changes = [i for i, (a, b) in enumerate(zip(words, words[1:], strict=False), 1) if a != b]
    edges = [0, *changes, len(words)]
    return (
        len(words),
        len(whole),
        len(bare) - len(bare.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated(words),
        len(lines),
        len(set(words)),
        len(bare) - len(bare.translate(None, CAPITALS)),
        len(bare) - len(bare.translate(None, LETTERS)),
        len(bare.translate(None, LETTERS)) - len(bare.translate(None, ASCII)),
        bare.count(b"!") + bare.count(b"?"),
        max((b - a for a, b in zip(edges, edges[1:], strict=False)), default=0),
    )


def with_counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every row; a null text has none of anything."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [text_counts(t.as_buffer().to_pybytes()) for t in batch.column("text")]
            columns = [pa.array(c, pa.int64()) for c in zip(*made, strict=True)] if made else [
                pa.array([], pa.int64()) for _ in COUNTS
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *COUNTS])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, ", ".join([f"doc_id {kind}", *[f"{c} long" for c in COUNTS]]))
