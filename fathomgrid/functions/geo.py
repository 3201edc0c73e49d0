"""Positions: points, precision, map tiles, geohash cells."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Map latitude limit, geohash alphabet.
MERCATOR_LIMIT = 85.05112878
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def point(longitude: Column, latitude: Column) -> Column:
    """GeoJSON point in longitude, latitude order; null without a position."""
    return F.when(
        latitude.isNotNull() & longitude.isNotNull(),
        F.struct(F.lit("Point").alias("type"), F.array(longitude, latitude).alias("coordinates")),
    )


def coordinate(x: Column, digits: int = 5) -> Column:
    return F.round(x, digits)


def in_bounds(latitude: Column, longitude: Column) -> Column:
    """Missing positions pass; NaN does not."""
    return (latitude.isNull() | latitude.between(-90.0, 90.0)) & (
        longitude.isNull() | longitude.between(-180.0, 180.0)
    )


def map_x(longitude: Column) -> Column:
    """Place on the square map from west to east, 0 to 1."""
    return (longitude + 180.0) / 360.0


def map_y(latitude: Column) -> Column:
    """Place on the square map from north to south, 0 to 1."""
    clamped = F.greatest(F.lit(-MERCATOR_LIMIT), F.least(latitude, F.lit(MERCATOR_LIMIT)))
    angle = F.radians(clamped)
    height = F.ln(F.tan(angle) + F.lit(1.0) / F.cos(angle))
    return (F.lit(1.0) - height / F.lit(math.pi)) / 2.0


def tile_of(place: Column, side: Column) -> Column:
    """Tile number of a place given in tiles; the map's far edge belongs to the last tile."""
    return F.greatest(F.lit(0).cast("long"), F.least(F.floor(place), side.cast("long") - 1))


def tile_x(longitude: Column, zoom: Column) -> Column:
    side = F.pow(F.lit(2.0), zoom)
    return tile_of(map_x(longitude) * side, side)


def tile_y(latitude: Column, zoom: Column) -> Column:
    side = F.pow(F.lit(2.0), zoom)
    return tile_of(map_y(latitude) * side, side)


def geohash(latitude: Column, longitude: Column, precision: int = 5) -> Column:
    """Geohash text: longitude and latitude halvings interleaved, five bits per letter.

    A letter takes three bits of one axis and two of the other, in turn, so it is picked from the
    alphabet in the order of those two small numbers.
    """
    if not 1 <= precision <= 12:
        raise ValueError("precision must lie between 1 and 12")
    lon_bits, lat_bits = (5 * precision + 1) // 2, 5 * precision // 2
    lon, lat = _cell(longitude, -180.0, 360.0, lon_bits), _cell(latitude, -90.0, 180.0, lat_bits)
    letters = []
    for k in range(precision):
        lon_bits, lat_bits = lon_bits - (3 - k % 2), lat_bits - (2 + k % 2)
        three, two = ((lon, lon_bits), (lat, lat_bits)) if k % 2 == 0 else ((lat, lat_bits), (lon, lon_bits))
        place = _bits(*three, 7) * 4 + _bits(*two, 3)
        letters.append(F.substring(F.lit(_LETTERS), place.cast("int") + 1, F.lit(1)))
    return F.when(latitude.isNotNull() & longitude.isNotNull(), F.concat(*letters))


def _interleaved(three: int, two: int) -> int:
    """Five bits: those of `three` at places 0, 2, 4 and those of `two` at places 1, 3."""
    bits = [three >> 2 & 1, two >> 1 & 1, three >> 1 & 1, two & 1, three & 1]
    return sum(bit << 4 - i for i, bit in enumerate(bits))


_LETTERS = "".join(GEOHASH_ALPHABET[_interleaved(n // 4, n % 4)] for n in range(32))


def _bits(cell: Column, shift: int, mask: int) -> Column:
    return F.shiftright(cell, shift).bitwiseAND(F.lit(mask).cast("long"))


def _cell(x: Column, low: float, span: float, bits: int) -> Column:
    size = float(2**bits)
    cell = F.floor((x - F.lit(low)) / F.lit(span) * F.lit(size))
    return F.greatest(F.lit(0).cast("long"), F.least(cell, F.lit(2**bits - 1).cast("long")))
