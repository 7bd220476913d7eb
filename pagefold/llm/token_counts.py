"""Token counts that follow edits: a tree of sums over each text's pre-tokens, re-encoded where an edit reaches."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary cuts texts into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A pre-token depends on its own characters and on this many after it, at most.
CONTEXT = 2
LEAF = 64
REMEMBERED = 500_000


class Counter:
    """Tokens of single pre-tokens, remembered up to a bound."""

    def __init__(self, vocabulary: str = VOCABULARY) -> None:
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            n = self.known[piece] = len(self.encoding.encode_ordinary(piece))
        return n


class CountedText:
    """A text, its pre-tokens in leaves, and a segment tree of their characters and tokens."""

    def __init__(self, text: str, counter: Counter) -> None:
        self.text, self.counter = text, counter
        pieces = counter.pattern.findall(text)
        self.encoded = 0  # pre-tokens looked at again because of edits
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        tokens = np.fromiter(map(counter.count, pieces), dtype=np.int64, count=len(pieces))
        cuts = np.arange(0, max(1, len(pieces)), LEAF)
        self.leaves: list[tuple[list[int], list[int]] | None] = [None] * len(cuts)
        self._lengths, self._tokens = lengths, tokens
        self.width = 1 << (len(cuts) - 1).bit_length() if len(cuts) > 1 else 1
        self.chars = np.zeros(2 * self.width, dtype=np.int64)
        self.sums = np.zeros(2 * self.width, dtype=np.int64)
        if len(pieces):
            self.chars[self.width : self.width + len(cuts)] = np.add.reduceat(lengths, cuts)
            self.sums[self.width : self.width + len(cuts)] = np.add.reduceat(tokens, cuts)
        level = self.width
        while level > 1:
            half = level // 2
            for tree in (self.chars, self.sums):
                tree[half:level] = tree[level : 2 * level : 2] + tree[level + 1 : 2 * level : 2]
            level = half

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1])

    @property
    def n_pieces(self) -> int:
        return sum(len(self._leaf(i)[0]) for i in range(len(self.leaves)))

    def _leaf(self, i: int) -> tuple[list[int], list[int]]:
        """Lengths and tokens of a leaf; leaves that no edit has touched are read from the arrays."""
        leaf = self.leaves[i]
        if leaf is None:
            part = slice(i * LEAF, (i + 1) * LEAF)
            leaf = self.leaves[i] = (self._lengths[part].tolist(), self._tokens[part].tolist())
        return leaf

    def _find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and the leaf's first character."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if place >= start + self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return min(node - self.width, len(self.leaves) - 1), start

    def _put(self, i: int, lengths: list[int], tokens: list[int]) -> None:
        self.leaves[i] = (lengths, tokens)
        node = i + self.width
        self.chars[node], self.sums[node] = sum(lengths), sum(tokens)
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def edit(self, at: int, removed: int, inserted: str) -> None:
        """Replace ``removed`` characters at ``at``; both are cut to the text.

        Cutting restarts at the pre-token in reach of the edit and stops where, behind the edit, a
        new border falls on an old one: from there on nothing can differ.
        """
        at = max(0, min(at, len(self.text)))
        removed = max(0, min(removed, len(self.text) - at))
        old_end, shift = at + removed, len(inserted) - removed
        old_length = len(self.text)
        self.text = self.text[:at] + inserted + self.text[old_end:]
        reach = max(0, at - CONTEXT)
        first, start = self._find(reach) if old_length else (0, 0)
        if start > reach:
            first, start = 0, 0
        lengths, tokens = self._leaf(first)
        skip = 0
        while skip < len(lengths) and start + lengths[skip] <= reach:
            start += lengths[skip]
            skip += 1
        # Old borders from here on, leaf by leaf.
        leaf, index, border = first, skip, start
        fresh_lengths, fresh_tokens, place = lengths[:skip], tokens[:skip], start
        settled = old_length == 0
        for found in self.counter.pattern.finditer(self.text, start):
            place = found.end()
            fresh_lengths.append(place - found.start())
            fresh_tokens.append(self.counter.count(found[0]))
            self.encoded += 1
            if place - shift < old_end:
                continue
            while border < place - shift:
                while index >= len(self._leaf(leaf)[0]):
                    leaf, index = leaf + 1, 0
                border += self._leaf(leaf)[0][index]
                index += 1
            if border == place - shift:
                settled = True
                break
        if not settled or place == len(self.text) or old_length == 0:
            leaf, index = len(self.leaves) - 1, len(self._leaf(len(self.leaves) - 1)[0])
        rest = self._leaf(leaf)
        rest = rest[0][index:], rest[1][index:]
        for i in range(first + 1, leaf + 1):
            self._put(i, [], [])
        self._put(first, fresh_lengths + rest[0], fresh_tokens + rest[1])


def attach_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """Documents with the array ``edits`` of their rows ``doc_id, step, at, removed, inserted``.

    A document's edits are applied by step; null ids have none.
    """
    own = edits.groupBy(F.col("doc_id").alias("of")).agg(
        F.array_sort(F.collect_list(F.struct("step", "at", "removed", "inserted"))).alias("edits")
    )
    return docs.join(own, F.col("doc_id") == F.col("of"), "left").drop("of")


def sample_edits(doc_id: Column, text: Column) -> Column:
    """An edit log for every document, from its own id and text: a cut, a correction, a quotation."""
    size = F.length(F.coalesce(text, F.lit("")))

    def place(step: int) -> Column:
        return F.pmod(F.xxhash64(doc_id, F.lit(step)), F.greatest(size, F.lit(1)).cast("long"))

    quoted = F.concat(F.lit(' "'), F.substring(F.coalesce(text, F.lit("")), 1, 80), F.lit('" '))
    made = [(place(0), F.lit(40), F.lit("")), (place(1), F.lit(3), F.lit(" [sic]")), (place(2), F.lit(0), quoted)]
    return F.array(
        *[
            F.struct(
                F.lit(n).alias("step"),
                at.alias("at"),
                removed.cast("long").alias("removed"),
                inserted.alias("inserted"),
            )
            for n, (at, removed, inserted) in enumerate(made)
        ]
    )


def count_edited(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per row of ``doc_id, text, edits``: ``doc_id, n_tokens, n_edited, n_pieces, n_encoded``.

    Tokens before and after the edits, pre-tokens before, and how many were encoded again. Null texts
    count as empty, null edits or fields as none, places beyond the text as its end; repeated rows
    stay; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            rows = []
            for text, edits in zip(batch.column("text"), batch.column("edits"), strict=True):
                counted = CountedText(text.as_py(), counter)
                before, pieces = counted.n_tokens, len(counted._lengths)
                for e in edits.as_py() or ():
                    counted.edit(e["at"] or 0, e["removed"] or 0, e["inserted"] or "")
                rows.append((before, counted.n_tokens, pieces, counted.encoded))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns]],
                names=["doc_id", "n_tokens", "n_edited", "n_pieces", "n_encoded"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "edits"
    )
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_edited long, n_pieces long, n_encoded long")


def edit_report(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``count_edited`` over every document with its ``sample_edits``."""
    logged = docs.select("doc_id", "text", sample_edits(F.col("doc_id"), F.col("text")).alias("edits"))
    return count_edited(logged, vocabulary)
