"""Consecutive numbers over a table's order, without any task that sees more than its own range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomgrid.llm.common import store

_AT = 33
"""Bits of a row's place within its partition, as Spark numbers them."""


def ordinals(rows: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """`rows` (stored) with `ordinal`, from 0 within each group, and `group_rows`, the rows of the group.

    Group columns hold no null. Rows are range-partitioned on group and order with their number as last key, so a hot
    group, and rows that are equal throughout, are cut as well. They are stored in that order; what comes before a
    range takes one small row per range and group.
    """
    numbered = rows.withColumn("__row", F.monotonically_increasing_id())
    keys = [*map(F.col, group), *order, F.col("__row")]
    ranged = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__row")
    kept = store(ranged.withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", _AT)
    ranges = kept.groupBy(*group, part.alias("__part")).agg(
        F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    whole = Window.partitionBy(*group, F.lit(0))
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        *group,
        "__part",
        (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(whole).alias("group_rows"),
    )
    joined = kept.withColumn("__part", part).join(starts, [*group, "__part"])
    return joined.withColumn("ordinal", F.col("__at") + F.col("__shift")).drop("__at", "__part", "__shift")
