"""Keeping masks intact while a model rewrites the text around them, and cutting model input."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagefold.functions.kernels import batch_parts_column
from pagefold.functions.splitting import check_window
from pagefold.functions.text import UNICODE_SPACE, let, strip

# What a mask looks like and the token that stands in for the i-th one.
MASK = r"\[[A-Z가-힣_]+\]"
TOKEN_HEAD, TOKEN_TAIL = "<KEEP_", ">"
BATCH_CHARS = 300
WINDOW_TOKENS, WINDOW_OVERLAP = 448, 64


def masks_in(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(MASK), F.lit(0))


def protected(text: str) -> tuple[str, list[str]]:
    """A text with tokens for its masks, and the masks; normalisation and the columns below use it alike."""
    masks = re.findall(MASK, text)
    gaps = re.split(MASK, text)
    tokens = [f"{TOKEN_HEAD}{i}{TOKEN_TAIL}" for i in range(len(masks))]
    return "".join(a + b for a, b in zip(gaps, [*tokens, ""])), masks


def restored(text: str, masks: list[str]) -> str:
    def back(found: re.Match) -> str:
        i = int(found[1])
        return masks[i] if i < len(masks) else found[0]

    return re.sub(f"{TOKEN_HEAD}(0|[1-9][0-9]*){TOKEN_TAIL}", back, text)


def protect_masks(text: Column) -> Column:
    """The i-th mask becomes the i-th token; as ``protected``, for a column."""

    def joined(gaps: Column) -> Column:
        token = lambda i: F.concat(F.lit(TOKEN_HEAD), i.cast("string"), F.lit(TOKEN_TAIL))
        return F.array_join(F.transform(gaps, lambda gap, i: F.when(i < F.size(gaps) - 1, F.concat(gap, token(i))).otherwise(gap)), "")

    return let(F.split(text, MASK, -1), joined)


def restore_masks(text: Column, masks: Column) -> Column:
    """Every token becomes its mask again; tokens beyond the masks stay. As ``restored``, for columns."""
    token = f"{TOKEN_HEAD}(0|[1-9][0-9]*){TOKEN_TAIL}"
    found = F.regexp_extract_all(text, F.lit(token), F.lit(1))
    row = F.struct(F.split(text, token, -1).alias("gaps"), found.alias("numbers"), masks.alias("masks"))

    def joined(x: Column) -> Column:
        def back(number: Column) -> Column:
            # No text has masks enough for a longer number.
            at = F.when(F.length(number) <= 9, number).cast("int")
            return F.coalesce(F.get(x["masks"], at), F.concat(F.lit(TOKEN_HEAD), number, F.lit(TOKEN_TAIL)))

        return F.array_join(F.zip_with(x["gaps"], x["numbers"], lambda gap, n: F.concat(gap, F.coalesce(back(n), F.lit("")))), "")

    return let(row, joined)


def windows_of(tokens: Sequence[str], size: int = WINDOW_TOKENS, overlap: int = WINDOW_OVERLAP) -> list[list[str]]:
    """Windows over tokens, each sharing ``overlap`` of them with the one before; none of no tokens."""
    last = max(0, -(-(len(tokens) - size) // (size - overlap)))
    starts = [i * (size - overlap) for i in range(last + 1)] if len(tokens) else []
    return [list(tokens[at : at + size]) for at in starts]


def token_windows(tokens: Column, size: int = WINDOW_TOKENS, overlap: int = WINDOW_OVERLAP) -> Column:
    """The same over a column of token arrays; no text leaves the JVM."""
    check_window(size, overlap)
    step = size - overlap

    def cut(row: Column) -> Column:
        last = F.greatest(F.lit(0), F.ceil((F.size(row) - size) / step).cast("int"))
        windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(row, i * step + 1, F.lit(size)))
        return F.when(F.size(row) > 0, windows).otherwise(F.when(row.isNotNull(), F.filter(windows, lambda w: F.size(w) > 0)))

    return let(tokens, cut)


def sentence_batches(text: Column, limit: int = BATCH_CHARS) -> Column:
    """Ordered ``array<struct<text,correct>>``: batches to correct and delimiters to keep.

    A delimiter is emitted as soon as it is read, a batch once the next piece would take it
    past ``limit``; joining the texts gives the rewritten document.
    """
    delimiter = rf"(?:[.!?]{UNICODE_SPACE[4:]}+|\n\n)"
    pattern = f"(?U){delimiter}"
    gaps = F.split(text, pattern, -1)
    marks = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    row = F.struct(F.transform(gaps, strip).alias("gaps"), marks.alias("marks"))
    lengths = F.transform(gaps, lambda gap: F.length(strip(gap)))
    parts = batch_parts_column(lengths, F.size(marks), limit)

    def built(x: Column) -> Column:
        def part(p: Column) -> Column:
            words = F.array_join(F.slice(x["filled"], F.get(p, 1), F.get(p, 2)), " ")
            correct = F.get(p, 0) == 1
            return F.struct(
                F.when(correct, words).otherwise(F.get(x["marks"], F.get(p, 1) - 1)).alias("text"),
                correct.alias("correct"),
            )

        return F.transform(x["parts"], part)

    def with_filled(x: Column) -> Column:
        filled = F.filter(x["row"]["gaps"], lambda gap: F.length(gap) > 0)
        return let(
            F.struct(filled.alias("filled"), x["row"]["marks"].alias("marks"), x["parts"].alias("parts")), built
        )

    return let(F.struct(row.alias("row"), parts.alias("parts")), with_filled)
