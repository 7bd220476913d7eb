"""Recursive character splitting as a vectorised function.

The separators are tried from coarse to fine; the recursion has no built-in counterpart, so
one Arrow batch of texts is split at a time in the Python worker.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagefold.functions.splitting import check_window

# Separators from coarse to fine; the empty one means single characters.
SEPARATORS = ("\n\n", "\n", "。", ". ", "! ", "? ", ", ", " ", "")


def _cut(text: str, separator: str) -> list[str]:
    """Pieces with the separator kept at the start of the piece that follows it."""
    if not separator:
        return list(text)
    head, *rest = text.split(separator)
    return [p for p in (head, *(separator + piece for piece in rest)) if p]


def _pack(pieces: list[str], size: int, overlap: int, out: list[str]) -> None:
    """Join neighbouring pieces up to ``size``, carrying at most ``overlap`` into the next."""
    first, used = 0, 0

    def emit(stop: int) -> None:
        chunk = "".join(pieces[first:stop]).strip()
        if chunk:
            out.append(chunk)

    for i, piece in enumerate(pieces):
        if used + len(piece) > size and i > first:
            emit(i)
            while first < i and (used > overlap or used + len(piece) > size):
                used -= len(pieces[first])
                first += 1
        used += len(piece)
    if first < len(pieces):
        emit(len(pieces))


def split_recursive(text: str, size: int, overlap: int, level: int = 0) -> list[str]:
    while SEPARATORS[level] and SEPARATORS[level] not in text:
        level += 1
    out: list[str] = []
    waiting: list[str] = []
    for piece in _cut(text, SEPARATORS[level]):
        if len(piece) < size:
            waiting.append(piece)
            continue
        _pack(waiting, size, overlap, out)
        waiting = []
        if level + 1 < len(SEPARATORS):
            out.extend(split_recursive(piece, size, overlap, level + 1))
        else:
            out.append(piece)
    _pack(waiting, size, overlap, out)
    return out


def recursive_chunks(text: Column, size: int, overlap: int) -> Column:
    check_window(size, overlap)

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: split_recursive(t, size, overlap) if t else [])

    return split(text)
