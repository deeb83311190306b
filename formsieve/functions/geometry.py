"""Coordinates: template space has its origin at the bottom of the page, page space at the top."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
PAGE_HEIGHT = 792.0
TEXT_BOX_EXTRA_BOTTOM = 5.0
TEXT_BOX_PAD_X = 4.0
TEXT_BOX_PAD_Y = 2.0
REGION_PAD = 3.0
DEFAULT_OFFSET = 8.0
LINE_TOLERANCE = 4.0


def box_top(y1: Column, dy: Column) -> Column:
    return F.lit(PAGE_HEIGHT) - y1 + dy


def box_bottom(y0: Column, dy: Column) -> Column:
    return F.lit(PAGE_HEIGHT) - y0 + dy


def image_rect(x0: Column, y0: Column, x1: Column, y1: Column, dy: Column, dpi: float) -> Column:
    scale = dpi / 72.0
    return F.struct((x0 * scale).cast("int").alias("px0"), (box_top(y1, dy) * scale).cast("int").alias("py0"),
                    (x1 * scale).cast("int").alias("px1"), (box_bottom(y0, dy) * scale).cast("int").alias("py1"))


def cell(c: Column, size: float) -> Column:
    return F.floor(c / size)


def cells(lo: Column, hi: Column, size: float) -> Column:
    """Grid cells an interval touches, with a little slack for rounding; the exact test follows in the join."""
    return F.sequence(cell(lo - 1e-6, size), cell(hi + 1e-6, size))


def reading_order(top: Column | str, x0: Column | str, ord_: Column | str) -> Column:
    """Rows by half-even rounded top, then left to right; `ord` keeps equal positions in input order."""
    return F.struct(F.bround(top).alias("row"), F.col(x0).alias("x") if isinstance(x0, str) else x0.alias("x"),
                    F.col(ord_).alias("o") if isinstance(ord_, str) else ord_.alias("o"))
