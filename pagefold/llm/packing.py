"""Packing token sequences to a mixture: deficit round-robin over source queues, block by block."""

from __future__ import annotations

import re
from array import array
from collections import deque
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagefold.llm.common import packed
from pagefold.session import stage_table

LENGTH = 4096
END = 2
# Tokens a row holds at most, and tokens of a block, the unit that one task packs.
PART = 65_536
BLOCK = 1 << 20
# Words remembered, twice: when so many are, those before them are forgotten.
_REMEMBERED = 700_000
_LONGEST_WORD = 48
_SEGMENT = 1 << 20
_GAP = re.compile(rb"[\x09-\x0d ]").search
# Lower-case letters of ASCII and Latin-1, which the tokenizer's steps before its pairs leave alone, and marks behind.
_PLAIN = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!,.:;?]*)").fullmatch
# Between a letter or digit and one of these marks every text is cut.
_MARKED = re.compile(rb"(.*[0-9A-Za-z])([!,.:;?]+)", re.DOTALL).fullmatch


class Ids(dict):  # type: ignore[type-arg]
    """Token ids, as bytes, of what stands between two blanks; remembered up to a bound.

    The tokenizer drops blanks and never joins across them, so a text's ids are those of its
    words. Upper case is folded by the tokenizer too; doing so before makes words meet, but not
    where a combining mark follows (composition goes by case) or a special token may be spelled out.
    """

    def __init__(self, description: str) -> None:
        super().__init__()
        self.before: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_str(description)
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.kind = np.dtype(self.code)
        self.pieces = self.tokenizer.model.tokenize

    def __missing__(self, word: bytes) -> bytes:
        value = self.before.get(word)
        if value is None:
            value = self._made(word)
        if len(word) <= _LONGEST_WORD:
            if len(self) >= _REMEMBERED:
                self.before = dict(self)
                self.clear()
            self[word] = value
        return value

    def _made(self, word: bytes) -> bytes:
        cut = _PLAIN(word)
        if cut and not cut[2]:
            spelt = word.decode("latin-1")
            return array(self.code, [p.id for p in self.pieces(spelt if word.isascii() else spelt.translate(_SPELT))]).tobytes()
        if cut := cut or _MARKED(word):
            return self[cut[1]] + self[cut[2]]
        return array(self.code, self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()

    def of(self, text: bytes) -> Iterator[bytes]:
        """The ids of a UTF-8 text, segment by segment."""
        folded = text if b"\xcc" in text or b"\xcd" in text or b"<|" in text else text.lower()
        at = 0
        while at < len(folded):
            gap = _GAP(folded, at + _SEGMENT) if len(folded) - at > _SEGMENT else None
            to = gap.start() if gap else len(folded)
            yield b"".join(map(self.__getitem__, folded[at:to].split()))
            at = to


def _letters_of_bytes() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: printable ones of Latin-1 as themselves, others from 256 on, in order."""
    other = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return {b: chr(256 + n) for n, b in enumerate(other)}


_SPELT = _letters_of_bytes()
_known: dict[str, Ids] = {}


def ids_of(description: str) -> Ids:
    """One memory per worker process, which serves its later tasks too."""
    if description not in _known:
        _known.clear()
        _known[description] = Ids(description)
    return _known[description]


def tokenized(docs: DataFrame, description: str, end: int = END) -> tuple[DataFrame, int]:
    """Every document's ids, ``end`` last, in rows of at most ``PART`` tokens, stored; and the bytes of an id.

    ``task, queued``: the task and how many tokens of the row's source it has met before, which
    gives every token a place in its source's queue once the tasks' totals are summed up.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(description)
    width = Ids(description).kind.itemsize
    closing = end.to_bytes(width, "little")
    names = ["task", "source", "queued", "doc_id", "start", "n", "doc_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, task = ids_of(shipped.value), TaskContext.get().partitionId()
        queued: dict[str | None, int] = {}
        for batch in batches:
            rows: list[tuple[object, ...]] = []
            held = 0
            for doc_id, source, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("source").to_pylist(), batch.column("text"), strict=True
            ):
                whole = b"".join([*ids.of(text.as_buffer().to_pybytes()), closing])
                before, n = queued.get(source, 0), len(whole) // width
                queued[source] = before + n
                for at in range(0, n, PART):
                    part = whole[at * width : (at + PART) * width]
                    rows.append((task, source, before + at, doc_id, at, len(part) // width, n, part))
                    held += len(part)
                    if held > 1 << 24:
                        yield _batch(rows, names)
                        rows, held = [], 0
            yield _batch(rows, names)

    rows = packed(docs).select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        F.col("row.source").cast("string").alias("source"),
        F.coalesce(F.col("row.text"), F.lit("")).cast("binary").alias("text"),
    )
    made = rows.mapInArrow(
        run, "task int, source string, queued long, doc_id long, start long, n long, doc_tokens long, ids binary"
    )
    return stage_table(made, "tokens"), width


def _batch(rows: list[tuple[object, ...]], names: list[str]) -> pa.RecordBatch:
    kinds = {"task": pa.int32(), "source": pa.string(), "ids": pa.binary()}
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kinds.get(n, pa.int64())) for c, n in zip(columns, names, strict=True)], names=names
    )


def _running(rows: DataFrame, key: str, value: str, to: str, group: int = 1024) -> DataFrame:
    """Add the sum of ``value`` over all smaller ``key``s (distinct, from 0): sums of groups first, then inside each."""
    earlier = Window.orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(F.floor(F.col(key) / group).alias("__of")).agg(F.sum(value).alias("__sum"))
    base = sums.select("__of", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__of").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    marked = rows.withColumn("__of", F.floor(F.col(key) / group))
    marked = marked.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return marked.join(base, "__of").withColumn(to, F.col("__base") + F.col("__inside")).drop("__of", "__base", "__inside")


def sequences_between(first: int, last: int, total: int, length: int) -> Iterator[tuple[int, int, int]]:
    """Number, start and end of the sequences that meet the stretch ``first`` to ``last`` of ``total`` tokens.

    All hold ``length`` tokens; what is left at the end goes to sequences of falling powers of two.
    """
    full = total // length
    number = first // length
    while number < full and number * length < last:
        yield number, number * length, (number + 1) * length
        number += 1
    if number >= full:
        number, start = full, full * length
        rest = total - start
        for bit in reversed(range(length.bit_length())):
            if rest >> bit & 1:
                if start < last and start + (1 << bit) > first:
                    yield number, start, start + (1 << bit)
                number, start = number + 1, start + (1 << bit)


def deficit_round_robin(
    queues: list[deque[list[int]]], first: int, ends: list[int]
) -> Iterator[tuple[int, int, int, int]]:
    """Serve the queues until all are empty: ``end, row, from, tokens`` of every piece, in order.

    ``queues`` hold ``[row, next token, tokens left]``. At every window each queue's deficit grows
    by its share of the window; it is served that many tokens, whole ones, and keeps the rest for the
    next window. What then is free goes, a token each, to the queues with the greatest deficits.
    """
    left = [sum(part[2] for part in queue) for queue in queues]
    whole = sum(left)
    share = [n / whole for n in left]
    deficit = [0.0] * len(queues)
    place = first
    for end in ends:
        room = end - place
        for i, s in enumerate(share):
            deficit[i] += s * room
        take = [min(left[i], max(0, int(d))) for i, d in enumerate(deficit)]
        free = room - sum(take)
        step = 1 if free > 0 else -1
        turn = sorted(range(len(queues)), key=lambda i: (step * (take[i] - deficit[i]), i))
        while free:
            for i in turn:
                if free and 0 <= take[i] + step <= left[i]:
                    take[i] += step
                    free -= step
        for i, tokens in enumerate(take):
            deficit[i] -= tokens
            left[i] -= tokens
            while tokens:
                part = queues[i][0]
                n = min(tokens, part[2])
                yield end, part[0], part[1], n
                part[1], part[2], tokens = part[1] + n, part[2] - n, tokens - n
                if not part[2]:
                    queues[i].popleft()
        place = end


def pack(
    docs: DataFrame, description: str | None = None, length: int = LENGTH, weights: dict[str, float] | None = None, end: int = END
) -> DataFrame:
    """Pieces ``doc_id, source, start, length, ids, doc_tokens, sequence_id, offset`` of full sequences.

    ``ids`` are little-endian unsigned 32-bit integers. Sources are queues that advance at a rate
    each: their tokens (all end together), or ``weights`` (sources not named weigh 1), under which a
    queue that runs out leaves its share to the others. Equal stretches of that advance are blocks of at
    most ``BLOCK`` tokens, give or take one a source, whatever the size of a source or document; how
    many tokens the earlier blocks hold, in all and of each source, follows from sums, so every
    block goes on in the very window, and with the deficits, where the one before it ends.

    Null and empty texts hold the end token alone; null sources are one source, null ids stay null;
    repeated rows are packed repeatedly; an empty table gives no rows; other columns are not read.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("the length of sequences must be a power of two")
    if description is None:
        with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
            description = file.read()
    parts, width = tokenized(docs, description, end)
    held = parts.groupBy("task", "source").agg(F.sum("n").alias("n"))
    held = stage_table(held, "held")
    if weights is None:
        weight: Column = F.col("size").cast("double")
    else:
        named = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.lit(None)
        weight = F.coalesce(named[F.col("source")] if weights else named, F.lit(1.0)).cast("double")
    sources = held.groupBy("source").agg(F.sum("n").alias("size")).withColumn("weight", weight)
    total, weighed, longest = sources.agg(F.sum("size"), F.sum("weight"), F.max(F.col("size") / F.col("weight"))).first()
    if not total:
        return _no_pieces(docs)
    # Stretches of the advance: the first holds the most tokens, as no queue has run out.
    blocks = max(1, int(-(-longest * weighed // BLOCK)))
    queue = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        held.withColumn("before", F.coalesce(F.sum("n").over(queue), F.lit(0)))
        .join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .select(F.col("task").alias("at"), F.col("source").alias("of"), "before", "size",
                (F.col("weight") * F.lit(longest) / F.lit(float(blocks))).alias("rate"))
    )
    before = stage_table(before, "before")

    def reached(block: Column) -> Column:
        """Tokens of the source in the blocks before this one."""
        return F.when(block >= blocks, F.col("size")).otherwise(F.least("size", F.floor(block * F.col("rate"))))

    def block_of(token: Column) -> Column:
        """The block of a token of the source; rounding may miss it by one."""
        near = F.ceil((token + 1) / F.col("rate")) - 1
        near = F.greatest(F.lit(0).cast("long"), F.least(F.lit(blocks - 1).cast("long"), near))
        return F.when(reached(near) > token, near - 1).when(reached(near + 1) <= token, near + 1).otherwise(near)

    placed = parts.join(before, (F.col("task") == F.col("at")) & F.col("source").eqNullSafe(F.col("of"))).drop("at", "of")
    placed = placed.withColumn("place", F.col("before") + F.col("queued"))
    placed = placed.withColumn(
        "block", F.explode(F.sequence(block_of(F.col("place")), block_of(F.col("place") + F.col("n") - 1)))
    )
    cut = placed.withColumns(
        {
            "from": F.greatest("place", reached(F.col("block"))),
            "to": F.least(F.col("place") + F.col("n"), reached(F.col("block") + 1)),
        }
    ).where("from < to")
    slices = cut.select(
        "block",
        "source",
        "doc_id",
        "from",
        (F.col("start") + F.col("from") - F.col("place")).alias("start"),
        (F.col("to") - F.col("from")).alias("n"),
        "doc_tokens",
        F.expr(f"substring(ids, cast((from - place) * {width} + 1 as int), cast((to - from) * {width} as int))").alias("ids"),
    )
    sums = stage_table(slices.groupBy("block").agg(F.sum("n").alias("n")), "blocks")
    starts = _running(sums, "block", "n", "first").select(F.col("block").alias("of"), "first", F.col("n").alias("held"))
    kind = np.dtype(np.uint16 if width == 2 else np.uint32).newbyteorder("<")

    def fill(rows: pa.Table, start: pa.Table) -> pa.Table:
        first, count = start["first"][0].as_py(), start["held"][0].as_py()
        rows = rows.sort_by([("source", "ascending"), ("from", "ascending")])
        sources, sizes = rows["source"].to_pylist(), rows["n"].to_pylist()
        whole = np.frombuffer(b"".join(rows["ids"].to_pylist()), dtype=kind).astype("<u4").tobytes()
        begins = [4 * n for n in accumulate(sizes, initial=0)]
        queues: dict[str | None, deque[list[int]]] = {}
        for i, source in enumerate(sources):
            queues.setdefault(source, deque()).append([i, 0, sizes[i]])
        windows = list(sequences_between(first, first + count, total, length))
        by_end = {min(stop, first + count): (number, begin) for number, begin, stop in windows}
        found: list[tuple[int, int, bytes, int, int, int]] = []
        place = first
        for stop, row, at, n in deficit_round_robin(list(queues.values()), first, list(by_end)):
            number, begin = by_end[stop]
            first_byte = begins[row] + 4 * at
            found.append((row, at, whole[first_byte : first_byte + 4 * n], n, number, place - begin))
            place += n
        at_row, at_token, pieces, sizes_, numbers, offsets = zip(*found, strict=True)
        taken = rows.take(pa.array(at_row))
        return pa.table(
            {
                "doc_id": taken["doc_id"],
                "source": taken["source"],
                "start": pa.array(np.asarray(taken["start"]) + np.array(at_token)),
                "length": pa.array(sizes_, pa.int64()),
                "ids": pa.array(pieces, pa.binary()),
                "doc_tokens": taken["doc_tokens"],
                "sequence_id": pa.array(numbers, pa.int64()),
                "offset": pa.array(offsets, pa.int64()),
            }
        )

    return slices.groupBy("block").cogroup(starts.groupBy("of")).applyInArrow(fill, _PIECES)


_PIECES = "doc_id long, source string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _no_pieces(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame([], _PIECES)


def assemble(pieces: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, starts``: one row per sequence, of at most its length in tokens."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    made = pieces.groupBy("sequence_id").agg(parts.alias("parts"))
    return made.select(
        "sequence_id",
        F.aggregate(F.col("parts.ids"), F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
        F.col("parts.offset").alias("starts"),
    )


def packing_report(docs: DataFrame) -> DataFrame:
    """One row per piece, with the checksum of its ids in place of them; cases as in ``pack``."""
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
