"""Sharding by a k-d tree over the documents' metadata, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagefold.llm.common import numbered, packed, unpacked
from pagefold.session import stage_table

SHARDS = 24
OVERHEAD = 8
# A coordinate has 24 bits; the text's hash below it keeps equal texts side by side.
COORDINATE, BELOW = 24, 39
SHIFTS = (47, 31, 15, 0)
# A cut may miss its place by this part of a leaf; groups of equal texts up to WHOLE of one stay together.
SLACK, WHOLE = 0.002, 0.04


@dataclass(frozen=True)
class Cut:
    """Rows under ``key`` of a dimension, and under ``row`` where they have just that key, go left."""

    dimension: int = 0
    key: int = 0
    row: int = 0
    left: int = 0
    right: int = 0


def default_dimensions(text: Column) -> list[Column]:
    """Length, bytes beyond one per character (alphabet), and the shares of blanks and of line ends.

    All depend on the text alone, so that equal texts share their place.
    """
    size, chars = F.octet_length(text), F.length(text)
    whole = F.greatest(size, F.lit(1))
    return [
        F.log1p(size.cast("double")),
        (size - chars) / whole,
        (size - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))) / whole,
        (size - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))) / whole,
    ]


def _placed(
    rows: DataFrame, text: Column, doc_id: Column, dimensions: list[Column] | None, drop: str | None = None
) -> DataFrame:
    """``rows`` (without ``drop``) with ``size``, ``keys`` (one per dimension) and ``own``, all non-negative; stored.

    A dimension is scaled by the range it has in these rows; the text's hash stands below it. ``own``
    is the hash of the id above one of the row's number, so that nothing is left that no cut can divide.
    """
    whole = F.coalesce(text, F.lit(""))
    made = [F.coalesce(d.cast("double"), F.lit(0.0)) for d in dimensions or default_dimensions(whole)]
    kept = [c for c in rows.columns if c != drop]
    held = rows.select(
        *kept,
        (F.octet_length(whole) + OVERHEAD).cast("long").alias("size"),
        F.array(*made).alias("places"),
        F.shiftrightunsigned(F.xxhash64(whole), 64 - BELOW).alias("below"),
        F.shiftrightunsigned(F.xxhash64(doc_id, F.lit("row")), 1).alias("id_hash"),
        F.monotonically_increasing_id().alias("number"),
    )
    stored = stage_table(held, "points")
    axes = range(len(made))
    ends = stored.agg(*[f(F.get("places", F.lit(d))) for d in axes for f in (F.min, F.max)]).first()
    top = 2**COORDINATE - 1
    keys = []
    for d in axes:
        low, high = ends[2 * d] or 0.0, ends[2 * d + 1] or 0.0
        scaled = F.floor((F.get("places", F.lit(d)) - low) * (top / (high - low) if high > low else 0.0))
        keys.append(F.shiftleft(F.least(F.greatest(scaled, F.lit(0)), F.lit(top)).cast("long"), BELOW) + F.col("below"))
    among = 2**24 - 1
    own = F.col("id_hash").bitwiseAND(F.lit(~among)) + F.xxhash64("number").bitwiseAND(F.lit(among))
    return stored.select(*kept, "size", F.array(*keys).alias("keys"), own.alias("own"))


def _assign(levels: list[list[Cut]], level: int = 0, cell: int = 0) -> Column:
    """The cell of a row after all levels, as nested tests in which every cut stands once."""
    if level == len(levels):
        return F.lit(cell)
    cut = levels[level][cell]
    right = _assign(levels, level + 1, cut.right)
    if cut.left == cut.right:
        return right
    key = F.get("keys", F.lit(cut.dimension))
    under = key < cut.key
    if cut.row:
        under = under | ((key == cut.key) & (F.col("own") < cut.row))
    return F.when(under, _assign(levels, level + 1, cut.left)).otherwise(right)


def _bucket(rows: DataFrame, value: Column, goals: dict[int, float]) -> dict[int, tuple[int, int, int, int]]:
    """Per cell the bucket in which the running weight reaches the goal: number, weight before, weight, rows."""
    sums = rows.groupBy("cell", value.alias("bucket")).agg(F.sum("size").alias("w"), F.count("*").alias("n"))
    cells = sorted(goals)
    goal = F.get(
        F.array(*[F.lit(float(goals[c])) for c in cells]),
        F.array_position(F.array(*[F.lit(c) for c in cells]), F.col("cell")).cast("int") - 1,
    )
    until = Window.partitionBy("cell").orderBy("bucket")
    hit = (
        sums.where(F.col("cell").isin(cells))
        .withColumn("after", F.sum("w").over(until))
        .where((F.col("after") >= goal) & (F.col("after") - F.col("w") < goal))
    )
    return {r["cell"]: (r["bucket"], r["after"] - r["w"], r["w"], r["n"]) for r in hit.collect()}


def _narrow(rows: DataFrame, value: Column, found: dict[int, int], shift: int) -> DataFrame:
    """Rows whose value starts with the digits found for their cell."""
    cells = sorted(found)
    prefix = F.get(
        F.array(*[F.lit(found[c]).cast("long") for c in cells]),
        F.array_position(F.array(*[F.lit(c) for c in cells]), F.col("cell")).cast("int") - 1,
    )
    return rows.where(F.col("cell").isin(cells) & (F.shiftright(value, shift) == prefix))


def _medians(rows: DataFrame, goals: dict[int, float], dimension: dict[int, int], leaf: float) -> dict[int, Cut]:
    """The cut of every cell at its weighted median (or other part), digit by digit.

    A round sums the weights under the next 16 bits of the keys, at most 65,536 sums per cell, and
    keeps the digit that holds the goal. It ends when what shares the digits found is light enough,
    and the nearer edge is the cut. A heavier group of equal texts is cut by its rows' own hashes.
    """
    cells = sorted(goals)
    axis = F.get(
        F.array(*[F.lit(dimension[c]) for c in cells]),
        F.array_position(F.array(*[F.lit(c) for c in cells]), F.col("cell")).cast("int") - 1,
    )
    rows = rows.where(F.col("cell").isin(cells)).withColumn("key", F.get("keys", axis))
    cuts: dict[int, Cut] = {}
    goals, prefix, at = dict(goals), {}, 63

    def edge(bucket: int, before: int, weight: int, goal: float) -> int:
        return bucket if goal - before <= before + weight - goal else bucket + 1

    for shift in SHIFTS:
        part = rows if at == 63 else _narrow(rows, F.col("key"), prefix, at)
        found = _bucket(part, F.shiftright("key", shift), {c: goals[c] for c in goals if c not in cuts})
        prefix = {}
        for c, (bucket, before, weight, n) in found.items():
            if weight <= SLACK * leaf or n == 1 or (shift == 0 and weight <= WHOLE * leaf):
                cuts[c] = Cut(dimension[c], edge(bucket, before, weight, goals[c]) << shift)
            else:
                goals[c] -= before
                prefix[c] = bucket
        at = shift
        if not prefix:
            return cuts
    keys = dict(prefix)
    part = _narrow(rows, F.col("key"), keys, 0)
    prefix, at = {}, 63
    for shift in SHIFTS:
        here = part if at == 63 else _narrow(part, F.col("own"), prefix, at)
        found = _bucket(here, F.shiftright("own", shift), {c: goals[c] for c in keys if c not in cuts})
        prefix = {}
        for c, (bucket, before, weight, n) in found.items():
            if weight <= SLACK * leaf or n == 1 or shift == 0:
                cuts[c] = Cut(dimension[c], keys[c], edge(bucket, before, weight, goals[c]) << shift)
            else:
                goals[c] -= before
                prefix[c] = bucket
        at = shift
        if not prefix:
            break
    return cuts


def kd_tree(points: DataFrame, shards: int = SHARDS) -> list[list[Cut]]:
    """The levels of the tree over ``size, keys, own``: at each, one cut per cell.

    A cell of n leaves is cut, along its widest dimension, into n // 2 leaves and the rest, at the
    place where the weights are in that proportion; so every leaf holds its n-th of the bytes. The
    driver holds one cut per inner node, whatever the number of rows. For more than some hundred
    shards, shard each shard again: the tests for a row are one expression.
    """
    size = points.agg(F.max(F.size("keys")), F.sum("size")).first()
    if not size or not size[1]:
        return []
    leaf = size[1] / shards
    levels: list[list[Cut]] = []
    leaves = [shards]
    while max(leaves) > 1:
        celled = points.select("size", "keys", "own", _assign(levels).alias("cell"))
        axes = range(size[0])
        spans = celled.groupBy("cell").agg(
            F.sum("size").alias("w"),
            *[(F.max(F.get("keys", F.lit(d))) - F.min(F.get("keys", F.lit(d)))).alias(f"d{d}") for d in axes],
        )
        info = {r["cell"]: r for r in spans.collect()}
        open_cells = [c for c, n in enumerate(leaves) if n > 1 and c in info]
        widest = {c: max(axes, key=lambda d: (info[c][f"d{d}"], -d)) for c in open_cells}
        goals = {c: info[c]["w"] * (leaves[c] // 2) / leaves[c] for c in open_cells}
        cuts = _medians(celled, goals, widest, leaf)
        level, below = [], []
        for c, n in enumerate(leaves):
            if n == 1:
                level.append(Cut(left=len(below), right=len(below)))
                below.append(1)
            else:
                cut = cuts.get(c, Cut())
                level.append(Cut(cut.dimension, cut.key, cut.row, len(below), len(below) + 1))
                below += [n // 2, n - n // 2]
        levels.append(level)
        leaves = below
    return levels


def shard_report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``bytes``. Null texts count as empty; equal texts share a shard unless a cut falls
    into a group of over 4 % of a shard, which is then cut by its rows, those of one id included;
    repeated rows stay; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select("doc_id", "text")
    crc = F.crc32(F.coalesce("text", F.lit(""))).alias("crc")
    points = _placed(rows.select("doc_id", crc, "text"), F.col("text"), F.col("doc_id"), None, drop="text")
    placed = points.select("doc_id", "size", "crc", "own", _assign(kd_tree(points, shards)).alias("shard"))
    slots = numbered(placed, "shard", ["crc", "doc_id", "own"], "slot")
    return slots.select(
        "doc_id",
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard(docs: DataFrame, shards: int = SHARDS, dimensions: list[Column] | None = None) -> DataFrame:
    """The documents with their ``shard`` (replacing such a column), nearly equal in bytes.

    ``dimensions`` are numeric columns of ``docs``, such as metadata; null counts as 0. The rows are
    stored once beside their places and never shuffled. Nulls, ties and repeated rows as in ``shard_report``.
    """
    rows = packed(docs.withColumn("__dimensions", F.array(*dimensions)) if dimensions else docs)
    axes = [F.get("row.__dimensions", F.lit(i)) for i in range(len(dimensions))] if dimensions else None
    points = _placed(rows, F.col("row.text"), F.col("row.doc_id"), axes)
    out = unpacked(points.withColumn("shard", _assign(kd_tree(points, shards))), "shard")
    return out.drop("__dimensions") if dimensions else out
