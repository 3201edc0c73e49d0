"""Tracklines: splitting at gaps and at the antimeridian, simplification.

A line is the points of one (cruise, segment, side), one row per point, whatever its length. A row per
line exists only as an exchange format, made by `line_strings` of the lines that are asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomgrid.functions import geo, times
from fathomgrid.operators.ordered import Layout, measure, previous, running_sum, scan
from fathomgrid.session import reliable

# Documented defaults of the map products.
SPLIT_MS = 900_000
PRECISION = 5
MAX_ZOOM = 7
MIN_TOLERANCE = 0.001
MAX_TOLERANCE = 0.1

LINE = ("cruise", "segment", "side")
SPAN_POINTS = 10_000
"""Points of one span that a single task simplifies; longer spans are divided by Spark first."""


def split_tracks(
    points: DataFrame,
    gap_ms: int = SPLIT_MS,
    keys: Sequence[str] = ("cruise",),
    layout: Layout | None = None,
) -> DataFrame:
    """Number the segments of each track; a gap of at least `gap_ms` starts a new one.

    `points`: the keys, ts, seq (unique within the keys), longitude, latitude.
    """
    keys = list(keys)
    layout = layout or measure(points, keys)
    micros = times.epoch_micros(F.col("ts"))
    gaps = scan(points, keys, ["ts", "seq"], [previous("__before", micros)], layout)
    starts = (micros - F.col("__before") >= F.lit(gap_ms * 1000)).cast("long")
    split = scan(gaps, keys, ["ts", "seq"], [running_sum("segment", starts)], layout)
    return split.drop("__before")


def track_points(
    split: DataFrame,
    precision: int = PRECISION,
    keys: Sequence[str] = ("cruise",),
    layout: Layout | None = None,
) -> DataFrame:
    """Points of lines with rounded coordinates and their place in the line; repeats in a row dropped.

    A step of more than half a turn crosses the antimeridian. The segment is cut there: `side` counts
    the crossings before, and both sides get a point on the border, at the time of the point behind it.
    """
    group = [*keys, "segment"]
    layout = layout or measure(split, group)
    rounded = split.filter(F.col("longitude").isNotNull() & F.col("latitude").isNotNull()).withColumns(
        {c: geo.coordinate(F.col(c), precision) for c in ("longitude", "latitude")}
    )
    here = F.struct(F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    compared = scan(rounded, group, ["ts", "seq"], [previous("__before", here)], layout)
    moved = compared.filter(
        F.col("__before").isNull()
        | (F.col("__before.lon") != F.col("longitude"))
        | (F.col("__before.lat") != F.col("latitude"))
    )
    # A dropped repeat lies where its predecessor does, so the row before serves for the kept point before.
    x, y, bx, by = F.col("longitude"), F.col("latitude"), F.col("__before.lon"), F.col("__before.lat")
    crossing = F.coalesce(F.abs(x - bx) > 180.0, F.lit(False))
    sided = scan(moved, group, ["ts", "seq"], [running_sum("side", crossing.cast("long"))], layout)
    turn = F.signum(bx)
    border = 180.0 * turn
    # From border to border there is no way to share.
    share = F.coalesce(F.try_divide(border - bx, x + 360.0 * turn - bx), F.lit(0.0))
    at = geo.coordinate(by + share * (y - by), precision)
    place = lambda sub, side, lon, lat: F.struct(
        F.lit(sub).alias("sub"), side.alias("side"), lon.alias("longitude"), lat.alias("latitude")
    )
    side = F.col("side")
    own = place(2, side, x, y)
    both = F.array(place(0, side - 1, border, at), place(1, side, -border, at), own)
    # A point on the border itself needs no second one.
    needed = F.filter(
        both,
        lambda p: (p["sub"] == 2)
        | ((p["sub"] == 0) & ((p["longitude"] != bx) | (p["latitude"] != by)))
        | ((p["sub"] == 1) & ((p["longitude"] != x) | (p["latitude"] != y))),
    )
    rest = [c for c in sided.columns if c not in ("__before", "side", "longitude", "latitude")]
    placed = sided.select(*rest, F.inline(F.when(crossing, needed).otherwise(F.array(own))))
    line = [*group, "side"]
    numbered = scan(placed, line, ["ts", "seq", "sub"], [running_sum("__n", F.lit(1).cast("long"))], layout)
    return numbered.withColumn("point_idx", F.col("__n") - 1).drop("__n", "sub")


def with_ends(points: DataFrame, keys: Sequence[str] = LINE) -> DataFrame:
    """Place and position of the first and last point of its line beside every point."""
    at = F.struct("point_idx", F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    ends = points.groupBy(*keys).agg(
        F.min_by(at, "point_idx").alias("first_point"), F.max_by(at, "point_idx").alias("last_point")
    )
    return points.join(ends, list(keys))


def line_strings(points: DataFrame, keys: Sequence[str] = LINE) -> DataFrame:
    """One row per line with its points in order: the form maps exchange, as long as the line is."""
    at = F.struct("point_idx", "ts", F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    ordered = F.array_sort(F.collect_list(at))
    return points.groupBy(*keys).agg(
        F.transform(
            ordered, lambda p: F.struct(p["ts"].alias("ts"), p["lon"].alias("lon"), p["lat"].alias("lat"))
        ).alias("points")
    )


def point_importance(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """Largest tolerance at which line simplification still keeps each point.

    The point farthest from the chord of its ends is where a line is divided, whatever the
    tolerance is; a point survives a tolerance when its own distance and those of all divisions
    above it exceed it. One pass therefore answers every tolerance. Ends are always kept.
    """
    n = len(xs)
    kept = np.full(n, np.inf)
    stack = [(0, n - 1, np.inf)] if n > 2 else []
    while stack:
        a, b, cap = stack.pop()
        if b - a < 2:
            continue
        px, py = xs[a + 1 : b] - xs[a], ys[a + 1 : b] - ys[a]
        dx, dy = xs[b] - xs[a], ys[b] - ys[a]
        length = dx * dx + dy * dy
        along = np.clip((px * dx + py * dy) / length, 0.0, 1.0) if length > 0 else np.zeros(b - a - 1)
        ex, ey = px - along * dx, py - along * dy
        away = np.sqrt(ex * ex + ey * ey)
        far = int(np.argmax(away))
        cap = min(cap, float(away[far]))
        mid = a + 1 + far
        kept[mid] = cap
        stack.append((a, mid, cap))
        stack.append((mid, b, cap))
    return kept


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _importance(xs: pd.Series, ys: pd.Series) -> pd.Series:
    """Importance of the points between the first and the last."""
    made = (point_importance(np.asarray(x, float), np.asarray(y, float)) for x, y in zip(xs, ys))
    return pd.Series([kept[1:-1] for kept in made])


def _away() -> Column:
    """Distance of a point from the chord of its span, as in `point_importance`."""
    px, py = F.col("longitude") - F.col("__a.lon"), F.col("latitude") - F.col("__a.lat")
    dx, dy = F.col("__b.lon") - F.col("__a.lon"), F.col("__b.lat") - F.col("__a.lat")
    length = dx * dx + dy * dy
    along = F.when(
        length > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), (px * dx + py * dy) / F.when(length > 0, length)))
    ).otherwise(0.0)
    ex, ey = px - along * dx, py - along * dy
    return F.sqrt(ex * ex + ey * ey)


def with_importance(
    points: DataFrame, keys: Sequence[str] = LINE, span_points: int = SPAN_POINTS
) -> DataFrame:
    """Importance of every point of every line: the largest tolerance at which it is kept.

    A span of more than `span_points` points is divided at its farthest point by an aggregate over all of
    them, span by span and round by round; what is left is short enough for one task each. The division
    is that of the whole line, so the result does not depend on `span_points`.
    """
    keys = list(keys)
    span = [*keys, "__a"]
    here = F.struct("point_idx", F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    rows = with_ends(points, keys)
    inside = (F.col("point_idx") != F.col("__a.point_idx")) & (F.col("point_idx") != F.col("__b.point_idx"))
    state = (
        rows.withColumnsRenamed({"first_point": "__a", "last_point": "__b"})
        .withColumn("__cap", F.lit(float("inf")))
        .withColumn("importance", F.when(~inside, F.lit(float("inf"))))
    )
    open_point = F.col("importance").isNull()
    long_span = open_point & (F.col("__b.point_idx") - F.col("__a.point_idx") > span_points)
    longest = points.agg(F.max("point_idx")).first()[0] or 0
    while longest > span_points:
        state = reliable(state)
        far = (
            state.filter(long_span)
            .withColumn("__d", _away())
            .groupBy(*span)
            .agg(F.max_by(here, F.struct("__d", -F.col("point_idx"))).alias("__m"), F.max("__d").alias("__away"))
        )
        cut = state.join(far, span, "left")
        hit = open_point & F.col("__m").isNotNull()
        cap = F.least("__cap", "__away")
        idx, m = F.col("point_idx"), F.col("__m.point_idx")
        state = cut.withColumns(
            {
                "importance": F.when(hit & (idx == m), cap).otherwise(F.col("importance")),
                "__cap": F.when(hit, cap).otherwise(F.col("__cap")),
                "__a": F.when(hit & (idx > m), F.col("__m")).otherwise(F.col("__a")),
                "__b": F.when(hit & (idx < m), F.col("__m")).otherwise(F.col("__b")),
            }
        ).drop("__m", "__away")
        longest = state.filter(long_span).agg(F.max(F.col("__b.point_idx") - F.col("__a.point_idx"))).first()[0] or 0

    between = F.array_sort(F.collect_list(here))
    spans = state.filter(open_point).groupBy(*span, "__b", "__cap").agg(between.alias("__p"))
    whole = F.concat(F.array("__a"), F.col("__p"), F.array("__b"))
    weighed = spans.select(
        *keys,
        "__cap",
        "__p",
        _importance(F.transform(whole, lambda q: q["lon"]), F.transform(whole, lambda q: q["lat"])).alias("__i"),
    )
    found = weighed.select(*keys, "__cap", F.inline(F.arrays_zip("__p", "__i"))).select(
        *keys, F.col("__p.point_idx").alias("point_idx"), F.least("__cap", "__i").alias("__found")
    )
    joined = state.join(found, [*keys, "point_idx"], "left")
    return joined.select(*points.columns, F.coalesce("importance", "__found").alias("importance"))


def tolerance_at(
    zoom: int,
    max_zoom: int = MAX_ZOOM,
    smallest: float = MIN_TOLERANCE,
    largest: float = MAX_TOLERANCE,
) -> float:
    """Tolerance of a zoom level: largest at 0, smallest at the deepest, evenly spaced in logarithm."""
    return largest * (smallest / largest) ** (zoom / max_zoom if max_zoom else 1.0)


def tolerances(
    max_zoom: int = MAX_ZOOM, smallest: float = MIN_TOLERANCE, largest: float = MAX_TOLERANCE
) -> list[float]:
    """Tolerances of the zoom levels from 0 to `max_zoom`."""
    return [tolerance_at(z, max_zoom, smallest, largest) for z in range(max_zoom + 1)]


def simplify(weighed: DataFrame, tolerance: float) -> DataFrame:
    """Points farther than `tolerance` from the simpler line; `weighed` has their importance."""
    return weighed.filter(F.col("importance") > tolerance)


def simplify_by_zoom(
    weighed: DataFrame,
    max_zoom: int = MAX_ZOOM,
    smallest: float = MIN_TOLERANCE,
    largest: float = MAX_TOLERANCE,
) -> DataFrame:
    """The kept points of every zoom level from 0 to `max_zoom`, with `z`."""
    return at_levels(weighed, tolerances(max_zoom, smallest, largest))


def at_levels(weighed: DataFrame, levels: Sequence[float]) -> DataFrame:
    """Points once per zoom level whose tolerance their importance exceeds."""
    each = F.array(*[F.struct(F.lit(z).alias("z"), F.lit(t).alias("t")) for z, t in enumerate(levels)])
    kept = F.filter(each, lambda level: F.col("importance") > level["t"])
    return weighed.withColumn("z", F.explode(F.transform(kept, lambda level: level["z"])))
