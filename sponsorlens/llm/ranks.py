"""Positions of rows inside their groups, without a window over a whole group.

Rows are dealt by ranges of (group, order) and sorted there, so that a group of
any size spreads over tasks; the few counts of each task's groups give what
comes before it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_name, written


def ranked(df: DataFrame, group: list[str], order: list[str], pos: str = "pos", total: str = "total") -> DataFrame:
    """``df`` (a written table) with the 0-based place of each row in its group and the group's size.

    Nulls are a group and come first in the order. Rows equal in group and
    order are numbered in some order, and spread over tasks by their place in the table.
    """
    salt, at, part = (fresh_name(df, c) for c in ("salt", "at", "part"))
    keys = [*group, *order, salt]
    placed = df.withColumn(salt, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(placed.drop(salt).withColumn(at, F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn(part, F.shiftright(at, 33))
    counts = placed.groupBy(part, *group).agg(F.count("*").alias("rows"), F.min(at).alias("first"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = F.sum("rows").over(whole.orderBy(part).rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")
    counts = counts.select(F.col(part).alias("_part"), *(F.col(g).alias(f"_{g}") for g in group),
                           (before - F.col("first")).alias("_shift"), F.sum("rows").over(whole).alias("_total"))
    on = F.col(part) == F.col("_part")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return placed.join(counts, on).select(*df.columns, (F.col(at) + F.col("_shift")).alias(pos), F.col("_total").alias(total))
