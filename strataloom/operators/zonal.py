"""Polygons over rasters: percentiles of cells inside, and the search for a level around.

Polygons have an id and the columns xmin, ymin, xmax, ymax; with a column `edges` they are
any polygon, without it boxes. Cells and polygons meet by an equi-join on square blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.functions import geom
from strataloom.functions.grid import GRID, Affine, block, centre

BLOCK = 16


def candidates(polygons: DataFrame, cells: DataFrame, reach: float, transform: Affine = GRID, size: int = BLOCK) -> DataFrame:
    """Polygons (id ...) beside the cells (r, c, h, x, y) of all blocks that their box, grown by `reach`, touches."""
    c_edges = [(F.col(a) + s * reach - transform.c) / transform.a for a, s in (("xmin", -1), ("xmax", 1))]
    r_edges = [(F.col(a) + s * reach - transform.f) / transform.e for a, s in (("ymin", -1), ("ymax", 1))]
    span = lambda e: F.sequence(block(F.least(*e), size), block(F.greatest(*e), size))
    spread = polygons.withColumn("bc", F.explode(span(c_edges))).withColumn("br", F.explode(span(r_edges)))
    x, y = centre(transform, F.col("r"), F.col("c"))
    keyed = cells.select("r", "c", "h", x.alias("x"), y.alias("y"), block(F.col("r"), size).alias("br"), block(F.col("c"), size).alias("bc"))
    return spread.join(keyed, ["br", "bc"])


def _is_inside(polygons: DataFrame) -> Column:
    if "edges" in polygons.columns:
        return geom.inside(F.col("edges"), F.col("x"), F.col("y"))
    return (F.col("x") >= F.col("xmin")) & (F.col("x") < F.col("xmax")) & (F.col("y") >= F.col("ymin")) & (F.col("y") < F.col("ymax"))


def _distance(polygons: DataFrame) -> Column:
    x, y = F.col("x"), F.col("y")
    return geom.distance(F.col("edges"), x, y) if "edges" in polygons.columns else geom.box_distance(x, y, *(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")))


def cells_inside(polygons: DataFrame, cells: DataFrame, transform: Affine = GRID) -> DataFrame:
    """Polygons beside the cells whose centre lies inside."""
    return candidates(polygons, cells, 0.0, transform).where(_is_inside(polygons))


def zonal_percentile(polygons: DataFrame, cells: DataFrame, percentile: float = 75, transform: Affine = GRID, whole: bool = True) -> DataFrame:
    """(id, level): exact percentile (linear) of the valid cells inside; polygons without any are left out.

    A whole-number raster cuts the result towards zero.
    """
    found = cells_inside(polygons, cells.where("h is not null"), transform)
    level = F.percentile("h", percentile / 100)
    return found.groupBy("id").agg((level.cast("int") if whole else level).alias("level"))


def _search(polygons: DataFrame, cells: DataFrame, step: float, percentile: float, rounds: int, transform: Affine, whole: bool) -> DataFrame:
    near = candidates(polygons, cells, step * rounds, transform).withColumn("distance", _distance(polygons))
    ring = F.greatest(F.lit(1), F.ceil(F.col("distance") / step)).cast("int")
    near = near.where(F.col("distance") <= step * rounds).withColumn("rounds", ring)
    first = near.groupBy("id", "rounds").agg(F.percentile("h", percentile / 100).alias("level"))
    best = first.groupBy("id").agg(F.min("rounds").alias("rounds"), F.min_by("level", "rounds").alias("level"))
    return best.withColumn("level", F.col("level").cast("int") if whole else F.col("level"))


def level_search(polygons: DataFrame, cells: DataFrame, step: float = 1, percentile: float = 75, rounds: int = 20, transform: Affine = GRID, whole: bool = True, first_rounds: int = 2) -> DataFrame:
    """(id, rounds, level): the percentile of all cells within rounds * step, for the least rounds that reach a valid cell.

    Most polygons have a cell close by, so all are searched `first_rounds` far, and only those
    without one at full reach; the rounds found within the first reach are final. Polygons
    without a cell in reach are left out.
    """
    valid = cells.where("h is not null")
    if rounds <= first_rounds:
        return _search(polygons, valid, step, percentile, rounds, transform, whole)
    close = _search(polygons, valid, step, percentile, first_rounds, transform, whole)
    # All columns of `close` are asked for here too, so both branches are the same plan and its exchange is used twice.
    beside = polygons.join(close.withColumnsRenamed({"rounds": "_rounds", "level": "_level"}), "id", "left")
    rest = beside.where("_rounds is null and _level is null").select(*polygons.columns)
    return close.unionByName(_search(rest, valid, step, percentile, rounds, transform, whole))


