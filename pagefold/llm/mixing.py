"""Mixing sources to target weights by systematic sampling, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold.llm.common import numbered, packed, unpacked, word_count
from pagefold.session import stage_table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``source, source_size, target`` of rows ``source, size``.

    Sources in code point order, null last, weigh ``weights``, repeating. They share ``share`` times
    all sizes; no target exceeds ``most`` times its source, and what is over goes to the others by
    weight. With T to share, C the targets at their limit and W the weights of the rest, a source
    gets its weight times (T - C) / W; the limits met are settled by rounds over the table of
    sources, each of which brings the driver two numbers.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Null sorts last by a flag, as ranges put it first.
    ranked = numbered(
        totals.withColumn("all", F.lit(0)).withColumn("none", F.col("source").isNull()),
        "all",
        ["none", "source"],
        "rank",
    )
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = stage_table(
        ranked.select(
            "source", "source_size", F.get(cycle, (F.col("rank") % len(weights)).cast("int")).alias("weight")
        ),
        "sources",
    )
    whole = sources.agg(F.sum("source_size")).first()[0] or 0
    limit = F.lit(most) * F.col("source_size")
    level, held = None, None
    while True:
        full = F.lit(False) if level is None else limit <= F.col("weight") * F.lit(level[0]) / F.lit(level[1])
        row = sources.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(full, True)),
        ).first()
        if row[1] == 0:
            target: Column = limit
            break
        if row[2] == held:
            target = F.when(full, limit).otherwise(F.col("weight") * F.lit(level[0]) / F.lit(level[1]))
            break
        level, held = (share * whole - row[0], row[1]), row[2]
    return sources.select("source", "source_size", target.alias("target"))


def copies_of_rows(
    sized: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = "mix",
) -> DataFrame:
    """``sized`` (``source, size, doc_id`` and more) with ``source_size, target`` and how often each row enters the mix.

    Within a source every row is expected ``target / source_size`` times. The rows are laid out by
    size and id, their expectations are summed up, one offset per source drawn from ``seed`` is
    added, and a row enters once (``copies``) for every integer its stretch crosses. Neighbours have
    similar sizes, so the words taken differ from the target by little more than one document.
    Rows that agree in source, size and id share the crossings of their stretch in any order, and
    are dealt to as many tasks as other rows.
    """
    targets = source_targets(sized.select("source", "size"), weights, share, most)
    tied = sized.withColumn("__tie", F.xxhash64(F.monotonically_increasing_id()))
    placed = numbered(tied, "source", ["size", "doc_id", "__tie"], "__place").drop("__tie")
    joined = placed.join(
        targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    ).drop("of")
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce("source", F.lit("")))), 1, 8), 16, 10)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = drawn.cast("double") / F.lit(4294967296.0)
    return (
        joined.withColumn("__rate", rate)
        .withColumn("__offset", offset)
        .withColumn(
            "copies",
            F.floor(F.col("__rate") * (F.col("__place") + 1) + F.col("__offset"))
            - F.floor(F.col("__rate") * F.col("__place") + F.col("__offset")),
        )
        .drop("__rate", "__offset", "__place")
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken`` (words, repeats counted).

    Null texts have size 0; null sources are one source, ranked last; an empty table gives no rows;
    repeated rows stay repeated. Columns other than ``doc_id``, ``text`` and ``source`` are not read.
    """
    rows = copies_of_rows(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    return rows.select(
        "doc_id",
        "size",
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The documents of the mix, with their columns; one taken twice is there twice.

    The text goes with its row while rows are numbered: by range, and once more to its block's count.
    Nulls, ties and repeated rows as in ``mix_report``.
    """
    sized = packed(docs).select(
        "row",
        F.col("row.doc_id").alias("doc_id"),
        F.col("row.source").alias("source"),
        word_count(F.col("row.text")).alias("size"),
    )
    chosen = copies_of_rows(sized, weights, share).where(F.col("copies") > 0)
    again = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return unpacked(chosen.select("row", again.alias("copy")).drop("copy"))
