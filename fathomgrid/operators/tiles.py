"""Map tiles and geohash cells of tracks.

A tile row is a stretch of a line within one tile: a straight piece with its two ends. Stretches follow each
other by (from_idx, start); `part` numbers the visits of a line, so a line that leaves a tile and comes
back has two parts there. Rows have this one form however many lines a tile holds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomgrid.functions import geo
from fathomgrid.operators.ordered import Layout, measure, previous, running_sum, scan
from fathomgrid.operators.tracks import LINE, MAX_ZOOM, at_levels, with_ends
from fathomgrid.session import stored

TILE_KEY = ("z", "x", "y")
ORDER = ("from_idx", "start")


def tile_points(points: DataFrame, max_zoom: int = MAX_ZOOM) -> DataFrame:
    """Tile of each point at every zoom level."""
    zooms = points.withColumn("z", F.explode(F.sequence(F.lit(0), F.lit(max_zoom))))
    return zooms.withColumns(
        {
            "x": geo.tile_x(F.col("longitude"), F.col("z")),
            "y": geo.tile_y(F.col("latitude"), F.col("z")),
        }
    )


def edges(levelled: DataFrame, keys: Sequence[str] = LINE, layout: Layout | None = None) -> DataFrame:
    """Straight steps between the points a line keeps at a zoom level; a lone point steps nowhere.

    `levelled`: the line's keys, z, point_idx, longitude, latitude, last_point.
    """
    here = F.struct("point_idx", F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    group = [*keys, "z"]
    stepped = scan(levelled, group, ["point_idx"], [previous("__from", here)], layout)
    lone = F.col("last_point.point_idx") == 0
    return stepped.filter(F.col("__from").isNotNull() | lone).select(
        *group,
        F.coalesce("__from.point_idx", "point_idx").alias("from_idx"),
        F.col("point_idx").alias("to_idx"),
        F.coalesce("__from.lon", "longitude").alias("lon0"),
        F.coalesce("__from.lat", "latitude").alias("lat0"),
        F.col("longitude").alias("lon1"),
        F.col("latitude").alias("lat1"),
    )


def _crossings(a: Column, b: Column) -> Column:
    """Shares of the way from a to b at which whole numbers are passed."""
    low, high = F.floor(F.least(a, b)) + 1, F.ceil(F.greatest(a, b)) - 1
    none = F.array().cast("array<double>")
    return F.when(low <= high, F.transform(F.sequence(low, high), lambda k: (k - a) / (b - a))).otherwise(none)


def tile_lines(
    points: DataFrame,
    levels: Sequence[float] | int = MAX_ZOOM,
    keys: Sequence[str] = LINE,
    layout: Layout | None = None,
) -> DataFrame:
    """Lines cut at the borders of every tile they cross, at every zoom level.

    `levels` is the deepest zoom, or a tolerance per zoom level for points with an `importance`: a level
    then keeps the points whose importance exceeds its tolerance.

    Each edge is cut within its row: the shares of its way at which it passes a tile border are sorted,
    and each stretch between two of them lies in the tile of its middle. An edge passes at most twice
    as many borders as the map has tiles across.

    Points of levels and stretches are stored once each, so that what measures them reads them back and neither
    `points` nor its simplification is run again for a count. `layout` is that of the levels, where it is known.
    """
    keys = list(keys)
    ended = with_ends(points, keys).drop("first_point")
    if isinstance(levels, int):
        levelled = ended.withColumn("z", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    else:
        levelled = at_levels(ended, levels)
    group = [*keys, "z"]
    levelled = stored(levelled.select(*group, "point_idx", "longitude", "latitude", "last_point"), "levels")
    steps = edges(levelled, keys, layout or measure(levelled, group))
    side = F.pow(F.lit(2.0), F.col("z"))
    placed = steps.withColumns(
        {
            "__u0": geo.map_x(F.col("lon0")) * side,
            "__v0": geo.map_y(F.col("lat0")) * side,
            "__u1": geo.map_x(F.col("lon1")) * side,
            "__v1": geo.map_y(F.col("lat1")) * side,
        }
    )
    u0, v0, u1, v1 = (F.col(f"__{c}") for c in ("u0", "v0", "u1", "v1"))
    cuts = F.array_sort(
        F.array_distinct(
            F.concat(F.array(F.lit(0.0)), _crossings(u0, u1), _crossings(v0, v1), F.array(F.lit(1.0)))
        )
    )
    cut = placed.withColumn("__cuts", cuts)
    pieces = F.transform(
        F.slice("__cuts", F.lit(1), F.size("__cuts") - 1),
        lambda t, i: F.struct(t.alias("start"), F.get(F.col("__cuts"), i + 1).alias("stop")),
    )
    each = cut.select(
        *group, "from_idx", "to_idx", "lon0", "lat0", "lon1", "lat1", "__u0", "__v0", "__u1", "__v1", F.inline(pieces)
    )
    middle = (F.col("start") + F.col("stop")) / 2.0
    tiled = each.withColumns(
        {"x": geo.tile_of(u0 + middle * (u1 - u0), side), "y": geo.tile_of(v0 + middle * (v1 - v0), side)}
    )
    tiled = stored(tiled, "stretches")
    # Both passes run over the same rows.
    layout = measure(tiled, group)
    cell = F.struct("x", "y")
    entered = scan(tiled, group, list(ORDER), [previous("__cell", cell)], layout)
    moved = (F.col("__cell.x") != F.col("x")) | (F.col("__cell.y") != F.col("y"))
    visited = scan(entered, group, list(ORDER), [running_sum("part", F.coalesce(moved, F.lit(False)).cast("long"))], layout)

    def lon(t: Column) -> Column:
        return F.when(t == 0, F.col("lon0")).when(t == 1, F.col("lon1")).otherwise(
            F.col("lon0") + t * (F.col("lon1") - F.col("lon0"))
        )

    def lat(t: Column) -> Column:
        across = F.lit(math.pi) * (1.0 - 2.0 * (v0 + t * (v1 - v0)) / side)
        return F.when(t == 0, F.col("lat0")).when(t == 1, F.col("lat1")).otherwise(F.degrees(F.atan(F.sinh(across))))

    start, stop = F.col("start"), F.col("stop")
    ends = {"start_lon": lon(start), "start_lat": lat(start), "stop_lon": lon(stop), "stop_lat": lat(stop)}
    return visited.select(
        *keys, *TILE_KEY, "part", "from_idx", "to_idx", "start", "stop", *[c.alias(n) for n, c in ends.items()]
    )


def replace_cruises(
    existing: DataFrame, fresh: DataFrame, cruises: DataFrame | None = None
) -> DataFrame:
    """Tile rows of all cruises: those of `fresh` replace earlier rows of the same cruises.

    `cruises` names the published cruises, so that one whose fresh tiles are empty loses its old ones.
    """
    renewed = (fresh if cruises is None else cruises).select("cruise").distinct()
    kept = existing.join(renewed, "cruise", "left_anti")
    return kept.unionByName(fresh)


def tile_summary(tile_rows: DataFrame, keys: Sequence[str] = LINE) -> DataFrame:
    """Cruises, parts of lines and stretches per tile. Counted per line first: the coarsest tile holds all."""
    per_line = tile_rows.groupBy(*TILE_KEY, *keys).agg(
        F.count(F.lit(1)).alias("stretches"), F.count_distinct("part").alias("parts")
    )
    per_cruise = per_line.groupBy(*TILE_KEY, "cruise").agg(
        F.sum("stretches").alias("stretches"), F.sum("parts").alias("parts")
    )
    return per_cruise.groupBy(*TILE_KEY).agg(
        F.count(F.lit(1)).alias("cruises"), F.sum("parts").alias("parts"), F.sum("stretches").alias("stretches")
    )


def merge_tiles(tile_rows: DataFrame, keys: Sequence[str] = LINE) -> DataFrame:
    """Rows of all cruises in the order of tiles, and within a tile by line, part and place.

    Rows are dealt by range of all these columns, so the coarsest tile, which holds every line, is spread
    over as many tasks as it has rows for, and a reader of one tile reads neighbouring files.
    """
    order = [*TILE_KEY, *keys, "part", *ORDER]
    return tile_rows.repartitionByRange(*order).sortWithinPartitions(*order)


def geohash_cells(
    points: DataFrame, precision: int = 5, keys: Sequence[str] = ("cruise",)
) -> DataFrame:
    """Pings and first and last time per geohash cell and cruise."""
    return (
        points.withColumn("geohash", geo.geohash(F.col("latitude"), F.col("longitude"), precision))
        .filter(F.col("geohash").isNotNull())
        .groupBy("geohash", *keys)
        .agg(
            F.count(F.lit(1)).alias("ping_count"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
    )
