"""Space-filling cells: one number per place, so that a box becomes a few ranges
of numbers that a Parquet scan can prune by.

The globe is cut into 1024 by 1024 cells. A cell's number interleaves the bits
of its row and column (Morton order), so near cells mostly have near numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremor.config import Region
from tremor.functions.numeric import nan_to_null

CELL_COLUMN = "cell"
CELL_BITS = 10
_SIDE = 1 << CELL_BITS
_LAT, _LON = (-90.0, _SIDE / 180.0), (-180.0, _SIDE / 360.0)  # origin, cells per degree


def _index(value: Column, origin: float, per_degree: float) -> Column:
    """Row or column of a coordinate; what lies beyond the globe's edge counts to the edge."""
    scaled = (nan_to_null(value) - F.lit(origin)) * F.lit(per_degree)
    return F.floor(F.greatest(F.least(scaled, F.lit(float(_SIDE - 1))), F.lit(0.0))).cast("int")


def _spread(index: Column) -> Column:
    """The bits of ``index``, each followed by a zero bit."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        index = index.bitwiseOR(F.shiftleft(index, shift)).bitwiseAND(F.lit(mask))
    return index


def cell_code(lat: Column, lon: Column) -> Column:
    """Cell number of a place; null where a coordinate is missing."""
    known = nan_to_null(lat).isNotNull() & nan_to_null(lon).isNotNull()
    row, column = _index(lat, *_LAT), _index(lon, *_LON)
    return F.when(known, F.shiftleft(_spread(row), 1).bitwiseOR(_spread(column)))


def _edge(value: float, origin: float, per_degree: float) -> int:
    # The same operations as _index: rounding moves a box's edge and the places on it alike.
    return math.floor(max(min((value - origin) * per_degree, float(_SIDE - 1)), 0.0))


def cell_ranges(region: Region, max_ranges: int = 24) -> list[tuple[int, int]]:
    """Closed ranges of cell numbers that hold every place of the box (and some
    beside it): quadrants inside the box, neighbours joined, and then the
    smallest gaps closed until there are at most ``max_ranges``."""
    rows = _edge(region.min_lat, *_LAT), _edge(region.max_lat, *_LAT)
    columns = _edge(region.min_lon, *_LON), _edge(region.max_lon, *_LON)
    ranges: list[list[int]] = []

    def visit(row: int, column: int, side: int, first: int) -> None:
        if row > rows[1] or row + side <= rows[0] or column > columns[1] or column + side <= columns[0]:
            return
        inside = rows[0] <= row and row + side - 1 <= rows[1] and columns[0] <= column and column + side - 1 <= columns[1]
        if inside or side == 1:
            last = first + side * side - 1
            if ranges and ranges[-1][1] == first - 1:
                ranges[-1][1] = last
            else:
                ranges.append([first, last])
            return
        half = side // 2
        for k in range(4):
            visit(row + half * (k >> 1), column + half * (k & 1), half, first + k * half * half)

    if rows[0] <= rows[1] and columns[0] <= columns[1]:
        visit(0, 0, _SIDE, 0)
    gaps = sorted(range(1, len(ranges)), key=lambda i: ranges[i][0] - ranges[i - 1][1], reverse=True)
    starts = sorted([0, *gaps[: max_ranges - 1]]) if ranges else []
    return [(ranges[a][0], ranges[b - 1][1]) for a, b in zip(starts, [*starts[1:], len(ranges)])]


def in_cells(cell: Column, region: Region, max_ranges: int = 24) -> Column:
    """Whether a cell may hold places of the box: comparisons of the plain column
    with constants, which reach the Parquet scan."""
    inside = F.lit(False)
    for first, last in cell_ranges(region, max_ranges):
        inside = inside | cell.between(first, last)
    return inside
