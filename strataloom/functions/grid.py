"""Grid arithmetic as Column expressions: affine transforms, windows, block keys.

A transform maps (column, row) to world coordinates: x = c + col * a, y = f + row * e.
Rows run downwards, so e is negative on a north-up raster; nothing here assumes its sign.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Affine:
    a: float
    b: float
    c: float
    d: float
    e: float
    f: float

    @classmethod
    def from_origin(cls, west: float, north: float, width: float, height: float) -> Affine:
        """North-up transform of cells of width x height whose outer corner is (west, north)."""
        return cls(width, 0.0, west, 0.0, -height, north)

    @property
    def cell_size(self) -> float:
        return abs(self.a)

    def bounds(self, n_rows: int, n_cols: int) -> tuple[float, float, float, float]:
        xs, ys = sorted((self.c, self.c + n_cols * self.a)), sorted((self.f, self.f + n_rows * self.e))
        return xs[0], ys[0], xs[1], ys[1]


GRID = Affine(1.0, 0.0, 0.0, 0.0, 1.0, 0.0)


def centre(transform: Affine, r: Column, c: Column) -> tuple[Column, Column]:
    """World coordinates of cell centres."""
    return F.lit(transform.c) + (c + 0.5) * transform.a, F.lit(transform.f) + (r + 0.5) * transform.e


def cell_of(transform: Affine, x: Column, y: Column) -> tuple[Column, Column]:
    """Row and column of the cell that holds a point."""
    return F.floor((y - transform.f) / transform.e).cast("int"), F.floor((x - transform.c) / transform.a).cast("int")


def block(place: Column, size: int) -> Column:
    return F.floor(place / F.lit(size)).cast("int")


def window_of(transform: Affine, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> dict[str, Column]:
    """Fractional window of bounds."""
    left, right = (xmin - transform.c) / transform.a, (xmax - transform.c) / transform.a
    top, bottom = ((ymin, ymax) if transform.e > 0 else (ymax, ymin))
    top, bottom = (top - transform.f) / transform.e, (bottom - transform.f) / transform.e
    return {"col_off": left, "row_off": top, "width": right - left, "height": bottom - top}


def clip_window(window: dict[str, Column], n_rows: Column | int, n_cols: Column | int) -> dict[str, Column]:
    """A window inside the raster; one that lies outside has a width or height of zero or less."""
    n_rows, n_cols = (x if isinstance(x, Column) else F.lit(float(x)) for x in (n_rows, n_cols))
    left, top = F.greatest(window["col_off"], F.lit(0.0)), F.greatest(window["row_off"], F.lit(0.0))
    right = F.least(window["col_off"] + window["width"], n_cols)
    bottom = F.least(window["row_off"] + window["height"], n_rows)
    return {"col_off": left, "row_off": top, "width": right - left, "height": bottom - top}


def require_window(window: dict[str, Column]) -> dict[str, Column]:
    """The window, with an error at run time where it is empty."""
    empty = (window["width"] <= 0) | (window["height"] <= 0)
    checked = F.when(empty, F.raise_error(F.lit("the window lies outside the raster")).cast("double")).otherwise(window["width"])
    return window | {"width": checked}


def slice_of(window: dict[str, Column]) -> dict[str, Column]:
    """Whole offsets and sizes, halves to even."""
    return {k: F.bround(v, 0).cast("int") for k, v in window.items()}


def window_transform(transform: Affine, window: dict[str, Column]) -> dict[str, Column]:
    """Origin of the (unrounded) window."""
    return {"c": F.lit(transform.c) + window["col_off"] * transform.a, "f": F.lit(transform.f) + window["row_off"] * transform.e}
