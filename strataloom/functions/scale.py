"""Units and nodata: metres to whole centimetres, sentinels to nulls, offsets by scale."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataloom.schema import INT16_NODATA


def to_null(value: Column, nodata: Column | float | None) -> Column:
    """A sentinel becomes null; without one, values stay. A NaN sentinel is met by NaN."""
    return value if nodata is None else F.when(value != (nodata if isinstance(nodata, Column) else F.lit(nodata)), value)


def to_sentinel(value: Column, nodata: Column | float = INT16_NODATA) -> Column:
    return F.coalesce(value, nodata if isinstance(nodata, Column) else F.lit(nodata))


def metres_to_cm(value: Column) -> Column:
    """Whole centimetres, cut towards zero in single precision; null stays, and what 16 bits cannot hold becomes null."""
    # Both factors are floats: with a whole number the product would be a double and round differently.
    return (value.cast("float") * F.lit(100).cast("float")).try_cast("smallint")


def scaled(value: Column, m_to_cm: bool = True) -> tuple[Column, float]:
    """The stored value and its scale."""
    return (metres_to_cm(value), 0.01) if m_to_cm else (value, 1.0)


def burned(level: Column, scale: Column | float, offset_m: float = 0.05) -> Column:
    """Level plus offset as stored: whole centimetres at a scale of 0.01, else the offset itself; then cut towards zero."""
    scale = scale if isinstance(scale, Column) else F.lit(scale)
    offset = F.when(scale == F.lit(0.01), F.lit(float(round(offset_m * 100)))).otherwise(F.lit(float(offset_m)))
    return (level.cast("double") + offset).cast("int")
