"""Order-dependent steps over the numbers of one text: which sentences, spans or pieces go together.

A higher-order fold copies its accumulator at every element, which is quadratic in a large
text. The helpers are linear and see offsets and lengths, one Arrow batch at a time; cutting and
joining strings stays in the JVM, but for masking, where every cut would walk the text anew.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def chunk_bounds(lengths: Sequence[int], size: int, overlap: int) -> list[tuple[int, int]]:
    """First sentence (from 1) and number of sentences of every chunk.

    When a sentence would take the open ones past ``size``, those are a chunk, and their
    longest suffix within ``overlap`` opens the next. Joining spaces do not count.
    """
    bounds: list[tuple[int, int]] = []
    first = used = 0
    for i, length in enumerate(lengths):
        if used + length > size and i > first:
            bounds.append((first + 1, i - first))
            used, start = 0, i
            while start > first and used + lengths[start - 1] <= overlap:
                start -= 1
                used += lengths[start]
            first = start
        used += length
    if first < len(lengths):
        bounds.append((first + 1, len(lengths) - first))
    return bounds


def chunk_bounds_column(lengths: Column, size: int, overlap: int) -> Column:
    @F.pandas_udf("array<array<int>>")
    def run(rows: pd.Series) -> pd.Series:
        return rows.map(lambda r: None if r is None else chunk_bounds(r.tolist(), size, overlap))

    return run(lengths)


def kept_spans(starts: Sequence[int], ends: Sequence[int], scores: Sequence[float]) -> list[int]:
    """Positions (from 0) of the spans that stay, in order; those kept never overlap.

    By start, longest first, a span can only meet the last one kept: inside it, the higher score
    stays; over its edge, the longer; at equality the earlier. The loser's rest stays uncovered.
    """
    order = sorted(range(len(starts)), key=lambda i: (starts[i], -ends[i], i))
    kept: list[int] = []
    for i in order:
        last = kept[-1] if kept else i
        inside = starts[i] >= starts[last] and ends[i] <= ends[last]
        meets = starts[i] < ends[last] and ends[i] > starts[last]
        if not kept or not (inside or meets):
            kept.append(i)
        elif scores[i] > scores[last] if inside else ends[i] - starts[i] > ends[last] - starts[last]:
            kept[-1] = i
    return kept


def kept_spans_column(starts: Column, ends: Column, scores: Column) -> Column:
    @F.pandas_udf("array<int>")
    def run(a: pd.Series, b: pd.Series, s: pd.Series) -> pd.Series:
        rows = zip(a, b, s)
        return pd.Series([None if x is None else kept_spans(x.tolist(), y.tolist(), z.tolist()) for x, y, z in rows])

    return run(starts, ends, scores)


def masked(text: str, starts: Sequence[int], ends: Sequence[int], types: Sequence[str]) -> str:
    parts, at = [], 0
    for start, end, kind in zip(starts, ends, types):
        parts += [text[at:start], "[", kind, "]"]
        at = end
    return "".join([*parts, text[at:]])


def resolved_column(text: Column, starts: Column, ends: Column, scores: Column, types: Column) -> Column:
    """Kept spans and the masked text in one call; a call that takes another's result cannot be planned here."""

    @F.pandas_udf("struct<kept:array<int>,masked:string>")
    def run(t: pd.Series, a: pd.Series, b: pd.Series, s: pd.Series, k: pd.Series) -> pd.DataFrame:
        kept, out = [], []
        for x, starts, ends, scores, types in zip(t, a, b, s, k):
            if x is None:
                kept.append(None)
                out.append(None)
                continue
            starts, ends = starts.tolist(), ends.tolist()
            order = kept_spans(starts, ends, scores.tolist())
            kept.append(order)
            out.append(masked(x, [starts[i] for i in order], [ends[i] for i in order], [types[i] for i in order]))
        return pd.DataFrame({"kept": pd.Series(kept, dtype=object), "masked": pd.Series(out, dtype=object)})

    return run(text, starts, ends, scores, types)


def batch_parts(lengths: Sequence[int], marks: int, limit: int) -> list[list[int]]:
    """Ordered parts of a text cut at delimiters: ``[1, first, number]`` of its filled pieces, or ``[0, i, 1]``.

    A delimiter comes as soon as it is read, a batch of pieces once the next would take it, with
    the spaces between, past ``limit``. Positions count from 1, pieces among the filled ones.
    """
    parts: list[list[int]] = []
    first, number, used, filled = 1, 0, 0, 0
    for i, length in enumerate(lengths):
        if length > 0:
            filled += 1
            if number and used + length > limit:
                parts.append([1, first, number])
                number = 0
            if number:
                number, used = number + 1, used + 1 + length
            else:
                first, number, used = filled, 1, length
        if i < marks:
            parts.append([0, i + 1, 1])
    if number:
        parts.append([1, first, number])
    return parts


def batch_parts_column(lengths: Column, marks: Column, limit: int) -> Column:
    @F.pandas_udf("array<array<int>>")
    def run(rows: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series(
            [None if r is None else batch_parts(r.tolist(), int(n), limit) for r, n in zip(rows, counts)], dtype=object
        )

    return run(lengths, marks)
