"""Burning polygon values into a grid, and composite elevation models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.functions.grid import GRID, Affine
from strataloom.functions.scale import burned
from strataloom.operators.raster import mosaic
from strataloom.operators.zonal import cells_inside, level_search


def burn(polygons: DataFrame, cells: DataFrame, transform: Affine = GRID) -> DataFrame:
    """(r, c, h): value of the polygon that a cell's centre lies in, the one with the highest `seq` where they overlap.

    polygons: id, seq, value and geometry columns; null values burn nothing. Cells outside all are left out.
    """
    inside = cells_inside(polygons.where("value is not null"), cells.select("r", "c", F.lit(None).cast("double").alias("h")), transform)
    return inside.groupBy("r", "c").agg(F.max_by("value", "seq").alias("h"))


def onto_grid(burnt: DataFrame, cells: DataFrame) -> DataFrame:
    """All cells of the grid, null where nothing was burnt."""
    return cells.select("r", "c").join(burnt.select("r", "c", "h"), ["r", "c"], "left")


def floor_levels(polygons: DataFrame, cells: DataFrame, step: float, offset_m: float = 0.05, scale: float = 0.01, transform: Affine = GRID) -> DataFrame:
    """`polygons` with `vloerpeil` (the level found, without offset) and `value` (what is burnt); both null without a level in reach."""
    found = level_search(polygons, cells, step=step, transform=transform).select("id", F.col("level").alias("vloerpeil"))
    return polygons.join(found, "id", "left").withColumn("value", burned(F.col("vloerpeil"), scale, offset_m))


def burn_floor_levels(polygons: DataFrame, cells: DataFrame, step: float, offset_m: float = 0.05, scale: float = 0.01, transform: Affine = GRID) -> DataFrame:
    """(r, c, h): floor levels burnt into the grid of the elevation raster."""
    return burn(floor_levels(polygons, cells, step, offset_m, scale, transform), cells, transform)


def composite(ground: DataFrame, *above: DataFrame) -> DataFrame:
    """Buildings and others over the ground."""
    return mosaic([ground, *above])
