"""A model of voters that agree or abstain: accuracies by expectation-maximisation, posteriors per pattern."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GOOD, BAD, NONE = 1, -1, 0
ROUNDS = 200


# How voters are taken to vote before any text is seen: bad, abstain, good.
ON_GOOD = (0.02, 0.18, 0.80)
ON_BAD = (0.35, 0.20, 0.45)
PULL = 0.05


def posteriors(patterns: list[tuple[list[int], int]], prior: float = 0.85) -> tuple[list[float], list]:
    """Posterior quality of each vote pattern (votes, times seen), and how each voter votes per class.

    Two classes of texts; in each, a voter votes bad, abstains or votes good with rates of its own.
    A voter is accurate where its rates differ between the classes. Rates start at ``ON_GOOD`` and
    ``ON_BAD`` and are drawn back to them by ``PULL`` of all texts, which keeps the classes from
    changing places and single voters from certainty. The order of patterns does not matter.
    """
    if not patterns:
        return [], []
    seen = np.array([n for _, n in patterns], dtype=float)
    cast = np.array([v for v, _ in patterns], dtype=int).reshape(len(patterns), -1)
    one = np.stack([cast == BAD, cast == NONE, cast == GOOD], axis=2).astype(float)
    voters = one.shape[1]
    start = [np.tile(ON_BAD, (voters, 1)), np.tile(ON_GOOD, (voters, 1))]
    rates, share, pull = list(start), prior, PULL * seen.sum() + 2.0
    quality = np.full(len(patterns), -1.0)
    for _ in range(ROUNDS):
        bad, good = (np.einsum("pvc,vc->p", one, np.log(r)) for r in rates)
        fresh = 1 / (1 + np.exp(np.clip(bad + np.log(1 - share) - good - np.log(share), -700, 700)))
        done = np.abs(fresh - quality).max() < 1e-12
        quality = fresh
        if done:
            break
        for k, w in enumerate((seen * (1 - quality), seen * quality)):
            rates[k] = (np.einsum("p,pvc->vc", w, one) + pull * start[k]) / (w.sum() + pull)
        share = float(np.clip(((seen * quality).sum() + prior * pull) / (seen.sum() + pull), 0.02, 0.98))
    return [round(float(q), 9) for q in quality], [r.tolist() for r in rates]


def votes(bad: Column, good: Column) -> Column:
    """The vote of a rule; where neither holds, or a value is missing, it abstains."""
    return F.when(bad, BAD).when(good, GOOD).otherwise(NONE)


def with_posterior(rows: DataFrame, rules: dict[str, tuple[Column, Column]], name: str) -> DataFrame:
    """Add the posterior quality of rows by rules (bad if, good if).

    All rows count: their vote patterns, at most three to the number of rules whatever the input,
    are summed up by Spark, the model is fitted on the sums, and the result is joined back.
    """
    voted = rows.withColumn("__votes", F.array(*[votes(*r) for r in rules.values()]))
    sums = sorted((list(r["__votes"]), r["n"]) for r in voted.groupBy("__votes").agg(F.count("*").alias("n")).collect())
    quality, _ = posteriors(sums)
    if not sums:
        return voted.withColumn(name, F.lit(None).cast("double")).drop("__votes")
    table = rows.sparkSession.createDataFrame(
        [(v, q) for (v, _), q in zip(sums, quality, strict=True)], f"__pattern array<int>, `{name}` double"
    )
    # At most 3 ** rules rows of a few bytes.
    return voted.join(F.broadcast(table), F.col("__votes") == F.col("__pattern")).drop("__votes", "__pattern")
