"""Running computations over ordered groups that hold up when one group is huge.

`scan` adds running columns (last value seen, previous row's value, running sum) per group.
Groups of ordinary size take one shuffle and a plain window. When the largest group would be
too much for one task, rows are range-partitioned on (group, order), so a group is cut into
consecutive chunks; each chunk is windowed alone and receives the state its predecessors left.
A chunk can continue at most one group, so there are no more carried rows than chunks and
broadcasting them is bounded by the partition count. Both ways give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomgrid.session import reliable

GROUP_ROWS = 4_000_000
"""Rows of one group that a single task may sort."""


@dataclass(frozen=True)
class Layout:
    """Row counts that decide between a plain and a chunked window."""

    rows: int
    largest: int
    limit: int = GROUP_ROWS

    @property
    def chunked(self) -> bool:
        return self.largest > self.limit

    @property
    def chunks(self) -> int:
        return max(2, math.ceil(2 * self.rows / self.limit))


@dataclass(frozen=True)
class Running:
    name: str
    kind: str
    value: Column


def last_seen(name: str, value: Column) -> Running:
    """Latest non-null value up to and including the row."""
    return Running(name, "last", value)


def previous(name: str, value: Column) -> Running:
    """The value of the row before, null for the first row of a group."""
    return Running(name, "previous", value)


def running_sum(name: str, value: Column) -> Running:
    """Sum up to and including the row; nulls count as zero."""
    return Running(name, "sum", F.coalesce(value, F.lit(0)))


def measure(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> Layout:
    """Count rows and the largest group: one narrow, map-side combined pass, one row back."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.agg(F.max("n").alias("largest"), F.sum("n").alias("rows")).first()
    return Layout(top["rows"] or 0, top["largest"] or 0, limit or GROUP_ROWS)


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[Running],
    layout: Layout | None = None,
) -> DataFrame:
    """Add `columns` to `df`, running within `keys` along `order` (which must be unique per group)."""
    layout = layout or measure(df, keys)
    if not layout.chunked:
        return _windowed(df, keys, order, columns)
    return _chunked(df, keys, order, columns, layout)


def _over(column: Running, window) -> Column:
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if column.kind == "last":
        return F.last(column.value, ignorenulls=True).over(upto)
    if column.kind == "previous":
        return F.lag(column.value).over(window)
    return F.sum(column.value).over(upto)


def _windowed(df, keys, order, columns) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({c.name: _over(c, window) for c in columns})


def _chunked(df, keys, order, columns, layout) -> DataFrame:
    values = {f"__v{i}": c.value for i, c in enumerate(columns)}
    cut = reliable(
        df.withColumns(values)
        .repartitionByRange(layout.chunks, *keys, *order)
        .withColumn("__chunk", F.spark_partition_id())
    )
    position = F.struct(*order)
    left_by, into, combined = [], [], {}
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("__chunk", *keys).orderBy(*order)
    for i, c in enumerate(columns):
        value = F.col(f"__v{i}")
        if c.kind == "sum":
            left_by.append(F.sum(value).alias(f"__s{i}"))
            into.append(F.sum(f"__s{i}").over(before).alias(f"__c{i}"))
            combined[c.name] = F.col(f"__w{i}") + F.coalesce(F.col(f"__c{i}"), F.lit(0))
            continue
        # A one-field struct keeps "a row with a null value" apart from "no row at all".
        boxed = F.struct(value.alias("v"))
        if c.kind == "last":
            boxed = F.when(value.isNotNull(), boxed)
            left_by.append(F.max_by(boxed, F.when(value.isNotNull(), position)).alias(f"__s{i}"))
        else:
            left_by.append(F.max_by(boxed, position).alias(f"__s{i}"))
        into.append(F.last(f"__s{i}", ignorenulls=True).over(before).alias(f"__c{i}"))
        combined[c.name] = F.coalesce(F.col(f"__w{i}"), F.col(f"__c{i}"))["v"]

    within = {}
    for i, c in enumerate(columns):
        value = F.col(f"__v{i}")
        if c.kind == "last":
            value = F.when(value.isNotNull(), F.struct(value.alias("v")))
        elif c.kind == "previous":
            value = F.struct(value.alias("v"))
        within[f"__w{i}"] = _over(Running("", c.kind, value), inside)

    renamed = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    carried = (
        cut.groupBy("__chunk", *keys)
        .agg(*left_by)
        .select(
            F.col("__chunk").alias("__into"),
            *renamed,
            *into,
            F.row_number().over(Window.partitionBy(*keys).orderBy("__chunk")).alias("__nth"),
        )
        .filter("__nth > 1")
        .drop("__nth")
    )
    same = F.col("__chunk") == F.col("__into")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return (
        cut.withColumns(within)
        .join(F.broadcast(carried), same, "left")
        .withColumns(combined)
        .select(*df.columns, *combined)
    )
