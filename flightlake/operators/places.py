"""Bounding weather scans to the planned places.

Landed weather has a ``place`` column, the cell's place on the Morton curve, and its
files are sorted by it.  The cells of a plan become a few stretches of the curve:
literal predicates that let the scan skip the row groups of all other regions.
The stretches only widen what is read; the join on ``cell`` decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.functions.geo import cell_place

PLACE_COLUMN = "place"
#: Metadata of the place column: cells in a row of the grid.
GRID_COLUMNS = "grid_columns"
#: Tiles of the globe that are told apart (what the driver may get) and stretches in a predicate.
MOST_TILES = 1 << 14
MOST_STRETCHES = 32


def tile_bits(n_lon: int, most: int = MOST_TILES) -> int:
    """Low bits of a place inside a tile, so that a grid of ``n_lon`` by ``n_lon / 2`` has at most ``most`` tiles."""
    bits = 0
    while (n_lon // (1 << bits) + 1) * (n_lon // (2 << bits) + 1) > most:
        bits += 1
    return 2 * bits


def joined_stretches(tiles: list[int], most: int = MOST_STRETCHES) -> list[tuple[int, int]]:
    """Neighbouring tiles as stretches (first, last); the smallest gaps are closed until at most ``most`` are left."""
    tiles = sorted(set(tiles))
    gaps = sorted(((b - a, k) for k, (a, b) in enumerate(zip(tiles, tiles[1:], strict=False)) if b - a > 1), reverse=True)
    cuts = sorted(k for _, k in gaps[:most - 1])
    starts, ends = [0, *[k + 1 for k in cuts]], [*cuts, len(tiles) - 1]
    return [(tiles[a], tiles[b]) for a, b in zip(starts, ends, strict=True)] if tiles else []


def bound_to_places(weather: DataFrame, keys: DataFrame) -> DataFrame:
    """``weather`` without the row groups that hold no ``cell`` of ``keys``; as it is if it has no ``place`` column.

    One distinct over the keys' tiles; at most ``MOST_TILES`` numbers reach the driver.
    Rows without a place stay.
    """
    n_lon = weather.schema[PLACE_COLUMN].metadata.get(GRID_COLUMNS) if PLACE_COLUMN in weather.columns else None
    if not n_lon:
        return weather
    bits = tile_bits(n_lon)
    tile = F.shiftright(cell_place("cell", n_lon), bits).alias("tile")
    found = [r.tile for r in keys.select(tile).distinct().collect() if r.tile is not None]
    place = F.col(PLACE_COLUMN)
    wanted = place.isNull()
    for lo, hi in joined_stretches(found):
        wanted = wanted | ((place >= F.lit(lo << bits)) & (place < F.lit((hi + 1) << bits)))
    return weather.where(wanted)
