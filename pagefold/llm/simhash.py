"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold.llm import minhash
from pagefold.llm.common import packed, row_key, unpacked
from pagefold.llm.components import components
from pagefold.session import stage_table

SHINGLE = 3
SEED = 42
BITS = 2
# Four blocks of 16 bits: two differing bits leave two of them alike.
BLOCKS = 4
# Fingerprints that share a key are compared in pairs up to this number; see ``links``.
PAIRED = 8
_LANES = np.uint64(0x0000000100000001)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a UTF-8 text, as a signed integer.

    ``bytes`` methods lower-case A-Z only and split at ASCII blanks only, as wanted.
    """
    words = text.lower().split()
    if not words:
        return 0
    shingles: Iterable[tuple[bytes, ...]] = zip(*(words[i:] for i in range(shingle)), strict=False)
    if len(words) < shingle:
        shingles = [tuple(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in map(b" ".join, shingles)], dtype=np.uint64)
    bits = np.empty(64, dtype=np.uint64)
    for i in range(32):  # two counters in each sum, 32 bits apart
        both = ((hashes >> np.uint64(i)) & _LANES).sum(dtype=np.uint64)
        bits[i], bits[i + 32] = both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)
    value = sum(1 << i for i, most in enumerate(2 * bits > len(hashes)) if most)
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``key, doc_id, fingerprint`` of every row, from whole texts; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            prints = [fingerprint(t.as_buffer().to_pybytes(), shingle) for t in texts]
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(prints, pa.int64())], names=[*kept, "fingerprint"]
            )

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("content"),
        F.coalesce(F.length("text"), F.lit(-1)).alias("length"),
        text.alias("text"),
    )
    made = rows.mapInArrow(run, "doc_id long, content long, length int, fingerprint long")
    key = F.struct(
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.col("doc_id").isNull().alias("none"),
        F.col("content").alias("text"),
        "length",
    )
    return made.select(key.alias("key"), "doc_id", "fingerprint")


def _keys(value: Column, blocks: int, bits: int) -> Column:
    """Every choice of blocks that must agree, as (number of the choice, its bits)."""
    width = 64 // blocks
    out = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - bits)):
        mask = sum(((1 << width) - 1) << (width * b) for b in chosen)
        mask = mask - (1 << 64) if mask >> 63 else mask
        out.append(F.struct(F.lit(n).alias("choice"), value.bitwiseAND(F.lit(mask)).alias("part")))
    return F.array(*out)


def links(prints: DataFrame) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints that connect all at most ``BITS`` bits apart.

    Fingerprints are joined on pairs of 16-bit blocks and their distance is verified. Where more
    than ``PAIRED`` share a key, all their pairs would be too many: each then names itself and its
    64 neighbours at one bit, and those that name the same value, which are at most two bits apart
    as any two so close do, are linked to the smallest of them. That connects the same components.
    """
    distinct = prints.select("fingerprint").distinct()
    keyed = distinct.select(
        "fingerprint", F.explode(_keys(F.col("fingerprint"), BLOCKS, BITS)).alias("key")
    ).select("fingerprint", "key.choice", "key.part")
    shared = keyed.groupBy("choice", "part").agg(F.count("*").alias("held")).where(F.col("held") > 1)
    close = stage_table(keyed.join(shared, ["choice", "part"]), "close")
    few = close.where(F.col("held") <= PAIRED)
    a = few.select("choice", "part", F.col("fingerprint").alias("a"))
    b = few.select("choice", "part", F.col("fingerprint").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS
    paired = a.join(b, ["choice", "part"]).where((F.col("a") < F.col("b")) & near).select("a", "b")
    many = close.where(F.col("held") > PAIRED).select("fingerprint").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)])
    named = many.select("fingerprint", F.explode(flips).alias("flip")).select(
        "fingerprint", F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("value")
    )
    least = named.groupBy("value").agg(F.min("fingerprint").alias("b"), F.count("*").alias("n")).where("n > 1")
    starred = named.join(least, "value").where(F.col("fingerprint") != F.col("b"))
    return paired.unionAll(starred.select(F.col("fingerprint").alias("a"), "b"))


def near_groups(docs: DataFrame) -> DataFrame:
    """``key, doc_id, fingerprint, root, component_id`` of every row.

    ``component_id`` is the smallest id of the component, null if it has none; ``root`` tells
    components apart. Equal fingerprints, that of texts without a word among them, are one node.
    """
    prints = stage_table(fingerprints(docs), "prints")
    roots = components(links(prints))
    held = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    nodes = held.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least"
    )
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    known = nodes.select("fingerprint", "root").join(least, "root")
    return prints.join(known, "fingerprint").select("key", "doc_id", "fingerprint", "root", "component_id")


def group_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Null and empty texts have fingerprint zero and are linked like any other; repeated rows stay;
    an empty table gives no rows; other columns are not read.
    """
    return near_groups(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def close_pairs(nodes: DataFrame) -> DataFrame:
    """``a, b, sizes``: pairs of ``node, size, fingerprint`` that connect all whose fingerprints link.

    Nodes of one fingerprint are paired with the smallest of them, and the smallest of linked fingerprints with each other.
    """
    worded = nodes.where("size > 0").select("node", "size", "fingerprint")
    heads = stage_table(worded.groupBy("fingerprint").agg(F.min(F.struct("node", "size")).alias("head")), "heads")
    equal = worded.join(heads, "fingerprint").where(F.col("node") != F.col("head.node"))
    a = heads.select(F.col("fingerprint").alias("a"), F.col("head").alias("x"))
    b = heads.select(F.col("fingerprint").alias("b"), F.col("head").alias("y"))
    linked = links(heads).distinct().join(a, "a").join(b, "b").select("x", "y")
    pairs = equal.select(F.struct("node", "size").alias("x"), F.col("head").alias("y")).unionAll(linked)
    sizes = F.col("x.size") + F.col("y.size")
    return stage_table(pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"), sizes.alias("sizes")), "close-pairs")


def drop_near_duplicates(
    docs: DataFrame, shingle: int = minhash.SHINGLE, similarity: float = minhash.SIMILARITY
) -> DataFrame:
    """One row of each group of near copies, the one with the smallest id, with its columns.

    Near copies share at least ``similarity`` of their word shingles; groups are the components of
    such pairs. Fingerprints link first, as in ``group_report``, and whole sets of shingles confirm
    those links. Pairs at the least similarity differ in about 10 of 64 bits, so an exact check
    follows: ``minhash`` compares what the fingerprints leave apart. Texts without a word are one
    group. Of rows with the same smallest id, or without any, one stays, whichever text comes first by hash.
    """
    nodes = minhash.node_rows(docs, shingle, fingerprint)
    winners = minhash.first_rows(docs, nodes, close_pairs(nodes), shingle, similarity)
    rows = packed(docs).withColumn("key", row_key(F.col("row.doc_id"), F.col("row.text")))
    kept = rows.join(winners, F.col("key") == F.col("winner"))
    # Rows alike in id and text; as text, columns of any type have an order.
    first = kept.groupBy("key").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return unpacked(first.select("row"))
