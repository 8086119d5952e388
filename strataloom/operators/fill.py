"""Void fill: inverse distance from the nearest valid cell of each quadrant.

Quadrants are closed, so a cell on an axis counts in both beside it; the nearest by
(distance, dr, dc) of a quadrant within `search` cells has weight 1 / distance. A hole
without any stays a hole. The result depends on the mosaic alone, not on its tiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def void_fill(cells: DataFrame, search: int, wanted: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """`cells` (r, c, h) with holes filled as doubles; `wanted`, a condition over r, c and the columns `keep`, says which cells come back.

    In each column the nearest valid cell above and below every row comes from two window
    functions over at most `search` rows; a hole then meets 2 search + 1 columns by an
    equi-join on (r, c): rows grow with the distance, not with its square.
    """
    rows = cells.select("r", "c", F.col("h").cast("double").alias("h"), *keep)
    wanted = F.lit(True) if wanted is None else wanted
    near = Window.partitionBy("c").orderBy("r")
    at = F.when(F.col("h").isNotNull(), F.struct(F.col("r").alias("row"), "h"))
    seen = rows.withColumns({
        "above": F.last(at, ignorenulls=True).over(near.rangeBetween(-search, 0)),
        "below": F.first(at, ignorenulls=True).over(near.rangeBetween(0, search)),
    }).where("above is not null or below is not null")
    holes = rows.where(F.col("h").isNull() & wanted).select("r", F.col("c").alias("hole"))
    offsets = holes.withColumn("dc", F.explode(F.sequence(F.lit(-search), F.lit(search)))).withColumn("c", F.col("hole") + F.col("dc"))
    met = offsets.join(seen.select("r", "c", "above", "below"), ["r", "c"])

    def nearest(which: str, side: Column) -> Column:
        dr = F.col(f"{which}.row") - F.col("r")
        d2 = dr * dr + F.col("dc") * F.col("dc")
        fits = side & F.col(which).isNotNull() & (d2 <= search * search)
        return F.min(F.when(fits, F.struct(d2.alias("d2"), dr.alias("dr"), F.col("dc").alias("dc"), F.col(f"{which}.h").alias("h"))))

    left, right = F.col("dc") <= 0, F.col("dc") >= 0
    quadrants = {f"q{i}": nearest(which, side) for i, (which, side) in enumerate((w, s) for w in ("above", "below") for s in (left, right))}
    found = met.groupBy("r", F.col("hole").alias("c")).agg(*[q.alias(name) for name, q in quadrants.items()])
    weight = lambda q: F.when(F.col(q).isNotNull(), 1 / F.sqrt(F.col(f"{q}.d2").cast("double"))).otherwise(F.lit(0.0))
    part = lambda q: F.when(F.col(q).isNotNull(), F.col(f"{q}.h") / F.sqrt(F.col(f"{q}.d2").cast("double"))).otherwise(F.lit(0.0))
    sums = [sum((f(q) for q in list(quadrants)[1:]), f(list(quadrants)[0])) for f in (part, weight)]
    filled = found.select("r", "c", (sums[0] / F.nullif(sums[1], F.lit(0.0))).alias("filled"))
    return rows.where(wanted).join(filled, ["r", "c"], "left").select("r", "c", F.coalesce("h", "filled").alias("h"), F.col("h").isNull().alias("was_hole"))


def stored(h: Column) -> Column:
    """A filled value as a whole number: halves away from zero."""
    return F.round(h, 0).cast("int")
