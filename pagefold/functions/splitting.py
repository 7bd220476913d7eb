"""Splitting text: sentences, fixed windows, and the greedy sentence merge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagefold.functions.kernels import chunk_bounds_column
from pagefold.functions.text import UNICODE_SPACE, let, strip

# Sentence terminals (ASCII and full-width).
TERMINALS = ".!?。！？"


def sentences(col: Column) -> Column:
    """Cut after a run of terminals that whitespace follows; strip and drop blanks."""
    # Whitespace first, then a look behind it: far fewer positions are looked behind.
    space = UNICODE_SPACE[4:]
    pieces = F.split(col, f"(?U:{space})(?<=[{TERMINALS}](?s:.))(?U:{space}*)")
    return F.filter(F.transform(pieces, strip), lambda s: F.length(s) > 0)


def check_window(size: int, overlap: int) -> None:
    if size <= 0 or overlap < 0:
        raise ValueError("size must be positive and overlap must not be negative")
    if overlap >= size:
        raise ValueError("overlap must be smaller than size, else the windows never advance")


def fixed_windows(col: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` characters, each starting ``overlap`` before the previous end.

    One regex pass: every match consumes a step and captures a whole window ahead of it.
    Past the start, a window begins only where more than ``overlap`` characters remain,
    for otherwise the previous window has already reached the end.
    """
    check_window(size, overlap)
    step = size - overlap
    pattern = f"(?s)(?=(.{{1,{size}}}))(?:\\A|(?=.{{{overlap + 1}}})).{{1,{step}}}"
    return F.regexp_extract_all(col, F.lit(pattern), F.lit(1))


def merge_sentences(parts: Column, size: int, overlap: int) -> Column:
    """Greedy merge of sentences into chunks of ``size``, sharing up to ``overlap``.

    Only the lengths leave the JVM; the bounds that come back cut and join the sentences here.
    ``parts`` is used twice, so it should be a column and not an expression.
    """
    bounds = chunk_bounds_column(F.transform(parts, F.length), size, overlap)
    both = F.struct(parts.alias("parts"), bounds.alias("bounds"))

    def cut(row: Column) -> Column:
        return F.transform(
            row["bounds"], lambda b: F.array_join(F.slice(row["parts"], b[0], b[1]), " ")
        )

    return let(both, cut)
