"""GeoJSON feature collections."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.functions import geom


def _plain(value):
    """Coordinates whose inner lists a mixed inference has kept as text."""
    if isinstance(value, str):
        return json.loads(value)
    return [_plain(v) for v in value] if isinstance(value, list) else value


def with_geometry(df: DataFrame, json_col: str, crs: int | None = None) -> DataFrame:
    """`df` with geom (WKB) and box columns in place of a GeoJSON text column."""
    kept = [c for c in df.columns if c != json_col]
    kinds = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != json_col), "geom binary", *(f"{n} double" for n in ("xmin", "ymin", "xmax", "ymax"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                shape = json.loads(text) if text else None
                if shape and "coordinates" in shape:
                    shape["coordinates"] = _plain(shape["coordinates"])
                found.append(geom.from_geojson(shape) if shape else None)
            boxes = [(g and geom.bounds(g)) or (None,) * 4 for g in found]
            cols = [pa.array([b[i] for b in boxes], pa.float64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.binary()), *cols], [*kept, "geom", "xmin", "ymin", "xmax", "ymax"])

    out = df.select(*kept, json_col).mapInArrow(run, ", ".join(kinds))
    return out if crs is None else out.withColumn("crs", F.lit(crs))


def shape_of(wkb: bytes) -> dict:
    """A geometry as a GeoJSON mapping."""
    kind, content = geom.decode(wkb)
    single = kind in (geom.POINT, geom.LINE, geom.POLYGON)
    return {"type": geom.NAMES[kind], "coordinates": content if single else [c for _, c in geom._flat(kind, content)]}


@F.pandas_udf(T.StringType())
def to_geojson(wkb: pd.Series) -> pd.Series:
    """GeoJSON text of WKB; null stays."""
    return wkb.map(lambda g: None if g is None else json.dumps(shape_of(bytes(g))))


def read_geojson(spark: SparkSession, path: str, crs: int = 28992) -> DataFrame:
    """Properties as columns, geom, box columns and crs of each feature of the collections at `path`."""
    raw = spark.read.option("multiLine", True).json(path)
    features = raw.select(F.explode("features").alias("f")).select("f.properties.*", F.to_json("f.geometry").alias("_geometry"))
    return with_geometry(features, "_geometry", crs)
