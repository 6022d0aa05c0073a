"""Consecutive numbers over a whole table without one task that sorts it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..runtime import fresh, materialize


def numbered(rows: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """``rows`` with a column ``name``: 0, 1, 2, ... in the given order, ties in any.

    Rows are sorted once across partitions and written with their partition and place, so
    that counts and rows are of the same ranges; places are then ranked within each
    range and the counts of the ranges before it are added.
    """
    p, i, r, b = (fresh(rows, x) for x in ("__part", "__place", "__rank", "__before"))
    ordered = materialize(rows.orderBy(*order).withColumn(p, F.spark_partition_id()).withColumn(i, F.monotonically_increasing_id()))
    local = ordered.withColumn(r, F.row_number().over(W.partitionBy(p).orderBy(i)))
    counts = ordered.groupBy(p).agg(F.count(F.lit(1)).alias(b))
    before = counts.select(p, (F.sum(b).over(W.orderBy(p)) - F.col(b)).alias(b))  # a row per partition
    return local.join(F.broadcast(before), p).withColumn(name, F.col(b) + F.col(r) - 1).select(*rows.columns, name)


def every_nth(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """Every nth row in the given order, the first included."""
    at = fresh(rows, "__at")
    return numbered(rows, order, at).filter(F.col(at) % n == 0).drop(at)
