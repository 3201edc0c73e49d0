"""Map products of cruise tracks: simplified tiles and geohash cells."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from fathomgrid.operators import tiles, tracks
from fathomgrid.operators.ordered import measure
from fathomgrid.session import stored
from fathomgrid.sources import tables


@dataclass(frozen=True)
class MapStage:
    """`points` are the points of lines with their importance."""

    points: DataFrame
    tile_rows: DataFrame
    cells: DataFrame


def map_stage(
    points: DataFrame,
    gap_ms: int = tracks.SPLIT_MS,
    precision: int = tracks.PRECISION,
    max_zoom: int = tracks.MAX_ZOOM,
    smallest: float = tracks.MIN_TOLERANCE,
    largest: float = tracks.MAX_TOLERANCE,
    geohash_precision: int = 5,
) -> MapStage:
    """Lines, tiles and cells of `points`: cruise, ts, seq, longitude, latitude."""
    # Segments are never larger than their track, so one measurement serves their steps.
    layout = measure(points, ["cruise"])
    split = tracks.split_tracks(points, gap_ms, layout=layout)
    # Simplification and tiles read their input several times, so each is stored before it.
    lines = stored(tracks.track_points(split, precision, layout=layout), "line-points")
    weighed = stored(tracks.with_importance(lines), "weighed")
    rows = tiles.tile_lines(weighed, tracks.tolerances(max_zoom, smallest, largest))
    return MapStage(weighed, rows, tiles.geohash_cells(points, geohash_precision))


def publish(
    stage: MapStage, existing_tiles: DataFrame | None = None, cruises: DataFrame | None = None
) -> DataFrame:
    """Merged tiles of all cruises, those of this stage replacing their earlier versions."""
    rows = stage.tile_rows
    if existing_tiles is not None:
        rows = tiles.replace_cruises(existing_tiles, rows, cruises)
    return tiles.merge_tiles(rows)


def publish_into(path: str, stage: MapStage, cruises: DataFrame | None = None) -> int:
    """The same into a store of tiles, of which only the folders of this stage's cruises are written again."""
    return tables.publish_tiles(stage.tile_rows.sparkSession, path, stage.tile_rows, cruises)
