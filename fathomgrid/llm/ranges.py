"""Running sums over a whole table, range by range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(
    df: DataFrame, part: str, order: list[Column], sums: dict[str, Column], group: str | None = None
) -> DataFrame:
    """Inclusive running sums over the rows of each `group`, ordered by `part` and then `order`.

    `part` numbers consecutive ranges of the order. Each range is summed alone; what the ranges before
    it hold comes from one small row per range. So a range is all that one task sorts, whatever the
    size of the group. Rows must be stored: both reads have to see the same ones.
    """
    keys = [group, part] if group else [part]
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = df.groupBy(*keys).agg(*(F.sum(v).alias(f"__{n}") for n, v in sums.items()))
    before = Window.orderBy(part) if group is None else Window.partitionBy(group).orderBy(part)
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *keys, *(F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__{n}") for n in sums)
    )
    summed = df.select("*", *(F.sum(v).over(within).alias(f"__in_{n}") for n, v in sums.items()))
    return summed.join(starts, keys).select(
        *(F.col(f"`{c}`") for c in df.columns), *((F.col(f"__in_{n}") + F.col(f"__{n}")).alias(n) for n in sums)
    )
