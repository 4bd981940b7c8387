"""Positions as cells of a space-filling curve.

Latitude and longitude are cut into 2^31 steps each, and the bits of the two take turns in one whole
number (the Z-order curve), so that points near each other mostly have numbers near each other. A box is
covered by ranges of cells, which a scan of a table in the order of cells can use to skip files and row groups.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of a cell for each of latitude and longitude.
CELL_BITS = 31
#: Ranges that cover a box at most.
COVER_RANGES = 32

#: After each shift, the bits that are kept: standard masks to spread bits over every second place.
_SPREAD = [
    (16, 0x0000FFFF0000FFFF),
    (8, 0x00FF00FF00FF00FF),
    (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333),
    (1, 0x5555555555555555),
]


def _step(value: Column, low: float, span: float) -> Column:
    """The step of a coordinate; the upper end of the scale belongs to the last."""
    steps = float(1 << CELL_BITS)
    at = F.floor((value - F.lit(low)) / F.lit(span) * F.lit(steps))
    return F.least(F.greatest(at, F.lit(0).cast("bigint")), F.lit((1 << CELL_BITS) - 1).cast("bigint"))


def _spread(step: Column) -> Column:
    for shift, mask in _SPREAD:
        step = step.bitwiseOR(F.shiftleft(step, shift)).bitwiseAND(F.lit(mask))
    return step


def cell(lat: Column, lon: Column) -> Column:
    """The cell of a position; null without one. Latitudes are from -90 to 90, longitudes from -180 to 180."""
    y, x = _spread(_step(lat, -90.0, 180.0)), _spread(_step(lon, -180.0, 360.0))
    return F.shiftleft(y, 1).bitwiseOR(x)


def _places(low: float, high: float, start: float, span: float) -> tuple[int, int]:
    at = lambda v: min(max(int((v - start) / span * (1 << CELL_BITS)), 0), (1 << CELL_BITS) - 1)
    return at(low), at(high)


def cover(
    lat_min: float, lat_max: float, lon_min: float, lon_max: float, ranges: int = COVER_RANGES
) -> list[tuple[int, int]]:
    """Ranges of cells, ``ranges`` at most, that hold every cell of a box, in order.

    Squares of the curve that the box cuts are quartered, the largest first, as long as there may be more ranges.
    A box from a larger to a smaller longitude goes over the 180th meridian.
    """
    if ranges < 2:
        raise ValueError("at least two ranges are needed")
    if lat_min > lat_max:
        return []
    if lon_min > lon_max:
        parts = cover(lat_min, lat_max, lon_min, 180.0, ranges // 2) if ranges > 3 else [(0, (1 << 2 * CELL_BITS) - 1)]
        return _joined(sorted(parts + (cover(lat_min, lat_max, -180.0, lon_max, ranges // 2) if ranges > 3 else [])))
    (y0, y1), (x0, x1) = _places(lat_min, lat_max, -90.0, 180.0), _places(lon_min, lon_max, -180.0, 360.0)
    whole: list[tuple[int, int]] = []
    # Squares by their lowest step in each direction and the bits of their side, all of one size.
    open_, bits = [(0, 0)], CELL_BITS
    while True:
        split = []
        for y, x in open_:
            side = 1 << bits
            if y0 <= y and y + side - 1 <= y1 and x0 <= x and x + side - 1 <= x1:
                whole.append(_square(y, x, bits))
            else:
                split.append((y, x))
        if bits == 0 or not split:
            break
        half = 1 << (bits - 1)
        quarters = [
            (y + dy, x + dx)
            for y, x in split
            for dy in (0, half)
            for dx in (0, half)
            if y + dy <= y1 and y + dy + half > y0 and x + dx <= x1 and x + dx + half > x0
        ]
        if len(_joined(sorted(whole + [_square(y, x, bits - 1) for y, x in quarters]))) > ranges:
            break
        open_, bits = quarters, bits - 1
    return _joined(sorted(whole + [_square(y, x, bits) for y, x in split]))


def _square(y: int, x: int, bits: int) -> tuple[int, int]:
    first = 0
    for i in range(bits, CELL_BITS):
        first |= (x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1
    return first, first + (1 << 2 * bits) - 1


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in ranges:
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out
