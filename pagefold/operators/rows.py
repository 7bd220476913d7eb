"""Turning array columns into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, keep: list[str], array: Column, position: str, value: str) -> DataFrame:
    """One row per element with its position; empty arrays give none.

    A plain explode makes the optimiser infer ``size(array) > 0`` and push it to the scan,
    which computes a costly array expression again, before any repartitioning. The outer form
    is not rewritten, and its placeholder rows are dropped afterwards.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias(position, value))
    return rows.where(F.col(position).isNotNull())
