"""Rasters as cells (r, c, h): mosaics, overviews, footprints, blocks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.functions.grid import Affine, block, cell_of


def mosaic(layers: Sequence[DataFrame]) -> DataFrame:
    """One raster of layers (r, c, h) on one grid: later layers lie on top, nodata lets through.

    One shuffle by cell; the winner is combined before it.
    """
    if not layers:
        raise ValueError("a mosaic of no layers has no grid; give an empty layer instead")
    marked = [layer.select("r", "c", "h", F.lit(i).alias("priority")) for i, layer in enumerate(layers)]
    every = marked[0]
    for layer in marked[1:]:
        every = every.unionByName(layer)
    return every.groupBy("r", "c").agg(F.max_by("h", F.when(F.col("h").isNotNull(), F.col("priority"))).alias("h"))


def mosaic_resolution(meta: DataFrame) -> DataFrame:
    """Mean cell size of the members."""
    return meta.agg(F.avg(F.abs("a")).alias("resolution"))


def overview_factors(cell_size: float, sizes: Sequence[float] = (5, 25)) -> list[int]:
    """Factors of the overviews that are coarser than the raster."""
    return [int(s / cell_size) for s in sizes if s > cell_size]


def overview(cells: DataFrame, factor: int) -> DataFrame:
    """Mean of the valid cells of factor x factor groups; a group without any is null."""
    return cells.groupBy(block(F.col("r"), factor).alias("r"), block(F.col("c"), factor).alias("c")).agg(F.avg("h").alias("h"))


def footprints(meta: DataFrame) -> DataFrame:
    """Bounds of each raster from its transform and size."""
    x2, y2 = F.col("c") + F.col("n_cols") * F.col("a"), F.col("f") + F.col("n_rows") * F.col("e")
    return meta.select(
        "raster_id", "tile_id", "crs",
        F.least("c", x2).alias("xmin"), F.least("f", y2).alias("ymin"), F.greatest("c", x2).alias("xmax"), F.greatest("f", y2).alias("ymax"),
    )


def sample_points(cells: DataFrame, points: DataFrame, transform: Affine) -> DataFrame:
    """`points` (x, y and others) with the value h of the cell that holds each; points outside go."""
    r, c = cell_of(transform, F.col("x"), F.col("y"))
    return points.withColumns({"r": r, "c": c}).join(cells.select("r", "c", "h"), ["r", "c"])


def read_window(cells: DataFrame, row_off: int, col_off: int, height: int, width: int, keep_place: bool = False) -> DataFrame:
    """Cells of a window, counted from its corner unless `keep_place`."""
    there = cells.where(F.col("r").between(row_off, row_off + height - 1) & F.col("c").between(col_off, col_off + width - 1))
    return there if keep_place else there.withColumns({"r": F.col("r") - row_off, "c": F.col("c") - col_off})


def to_blocks(cells: DataFrame, size: int, n_rows: Column | int, n_cols: Column | int) -> DataFrame:
    """Blocks (br, bc, n_rows, n_cols, data) of at most size x size cells, row by row; cells that are not there are null.

    Each cell is set at its place in the block's array, in time proportional to the block. The raster's size may be
    columns of `cells` that are the same in all rows.
    """
    br, bc = block(F.col("r"), size), block(F.col("c"), size)
    size_of = lambda n, at: F.least(F.lit(size), (n if isinstance(n, Column) else F.lit(n)) - at * size).cast("int")
    rows = cells.select(br.alias("br"), bc.alias("bc"), size_of(n_rows, br).alias("n_rows"), size_of(n_cols, bc).alias("n_cols"), (F.col("r") - br * size).alias("r"), (F.col("c") - bc * size).alias("c"), F.col("h").cast("double").alias("h"))

    def place(group: pa.Table) -> pa.Table:
        r, c = group.column("r").to_numpy(), group.column("c").to_numpy()
        height, width = group.column("n_rows")[0].as_py(), group.column("n_cols")[0].as_py()
        data, known = np.zeros(height * width), np.zeros(height * width, bool)
        h = group.column("h")
        at = (r * width + c)[h.is_valid().to_numpy()]
        data[at], known[at] = h.drop_null().to_numpy(), True
        cells = pa.ListArray.from_arrays(pa.array([0, len(data)], pa.int32()), pa.array(data, mask=~known))
        return pa.table({**{n: group.column(n)[:1].combine_chunks() for n in ("br", "bc", "n_rows", "n_cols")}, "data": cells})

    return rows.groupBy("br", "bc").applyInArrow(place, "br int, bc int, n_rows int, n_cols int, data array<double>")


def to_cells(blocks: DataFrame, size: int) -> DataFrame:
    """Cells of blocks that begin at multiples of `size`; other columns stay."""
    others = [c for c in blocks.columns if c not in ("br", "bc", "n_rows", "n_cols", "data")]
    flat = blocks.select(*others, "br", "bc", "n_cols", F.posexplode("data").alias("i", "h"))
    r = (F.col("br") * size + F.floor(F.col("i") / F.col("n_cols"))).cast("int")
    c = (F.col("bc") * size + F.col("i") % F.col("n_cols")).cast("int")
    return flat.select(*others, r.alias("r"), c.alias("c"), "h")


def valid(cells: DataFrame, value: Column | None = None) -> DataFrame:
    """Cells that hold data."""
    return cells.where((F.col("h") if value is None else value).isNotNull())
