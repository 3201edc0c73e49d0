"""Row-local array expressions: rounding, axes, sample statistics.

Arrays stay inside their row, so none of these shuffles or explodes samples. `bind` gives a
computed array a name inside one expression; without it a lambda that mentions the array
would evaluate it again for every element.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once."""
    return F.transform(F.array(value), body)[0]


def half_even(x: Column, digits: int) -> Column:
    """Scale, round half to even, scale back, all in binary floating point."""
    scale = float(10**digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def to_doubles(xs: Column) -> Column:
    return F.transform(xs, lambda x: x.cast("double"))


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def nans_to_nulls(xs: Column) -> Column:
    return F.transform(xs, nan_to_null)


def linspace(stop: Column, count: Column) -> Column:
    """`count` evenly spaced doubles from 0 to `stop`; the last one is exactly `stop`."""
    last = count - 1
    width = stop / F.nullif(last.cast("double"), F.lit(0.0))
    return F.when(
        count > 0,
        bind(
            F.struct(last.alias("last"), width.alias("width"), stop.alias("stop")),
            lambda a: F.transform(
                F.sequence(F.lit(0).cast("long"), a["last"].cast("long")),
                lambda j: F.when(j == 0, F.lit(0.0)).when(j == a["last"], a["stop"]).otherwise(j * a["width"]),
            ),
        ),
    ).when(count <= 0, F.array().cast("array<double>"))


def stored_height(max_depth: Column, step: Column) -> Column:
    """Bins of the stored depth axis."""
    return (F.ceil(max_depth) / step).cast("long")


def stored_depths(step: Column, height: Column) -> Column:
    """Stored depth axis: two decimals, shifted by a centimetre."""
    return F.transform(linspace(step * height, height), lambda d: half_even(d, 2) + F.lit(0.01))


def single(x: Column) -> Column:
    """Value of `x` in single precision, as a double."""
    return x.cast("float").cast("double")


def depth_bins(max_depth: Column, step: Column) -> Column:
    """Bins of the regridded depth axis; range and step pass through single precision."""
    ratio = (single(max_depth) / single(step)).cast("float")
    return ratio.cast("long") + 1


def regrid_depths(max_depth: Column, bins: Column) -> Column:
    return linspace(single(max_depth), bins)


def differences(xs: Column) -> Column:
    """Differences of neighbouring elements; a null neighbour gives null."""
    pairs = lambda a: F.zip_with(
        F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))),
        F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(0))),
        lambda lo, hi: hi - lo,
    )
    return bind(xs, lambda a: F.when(F.size(a) > 1, pairs(a)).otherwise(F.array().cast("array<double>")))


def smallest_step(ranges: Column) -> Column:
    """Smallest difference of neighbouring ranges, missing values ignored."""
    return F.array_min(differences(nans_to_nulls(ranges)))


def largest(xs: Column) -> Column:
    return F.array_max(nans_to_nulls(xs))


def all_missing(xs: Column) -> Column:
    return F.forall(xs, lambda x: x.isNull() | F.isnan(x))
