"""Rasters, tiles, buildings and points derived from the driver's tables by arithmetic."""

from __future__ import annotations

import io
import json
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.functions import geom, scale
from strataloom.functions.grid import Affine
from strataloom.schema import INT16_NODATA
from strataloom.sources import geojson, tiff


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(r, c, elevation_m): metres, null where the event is an error."""
    e = table(spark, sf_dir, "events")
    r, c = F.floor(F.col("event_id") / 100).cast("int"), (F.col("event_id") % 100).cast("int")
    return e.select(r.alias("r"), c.alias("c"), F.when(F.col("event_type") != "error", F.col("value") / 10 - 5).alias("elevation_m"))


def dem_cm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dem(spark, sf_dir).select("r", "c", scale.metres_to_cm(F.col("elevation_m")).alias("h"))


def dsm(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    r, c = F.floor(F.col("o_orderkey") / 100).cast("int"), (F.col("o_orderkey") % 100).cast("int")
    return o.select(r.alias("r"), c.alias("c"), F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 1000)).cast("int").alias("h"))


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    x, y = (20 * (F.col("s_suppkey") % 5)).cast("double"), (20 * F.floor(F.col("s_suppkey") / 5)).cast("double")
    return s.select(F.col("s_name").alias("kaart_index"), x.alias("xmin"), y.alias("ymin"), (x + 20).alias("xmax"), (y + 20).alias("ymax"))


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    x, y = k * 7 % 95, k * 13 % 97
    return table(spark, sf_dir, "customer").select(
        k.alias("id"), k.alias("seq"), F.col("c_mktsegment").alias("segment"),
        (x + 0.25).alias("xmin"), (y + 0.25).alias("ymin"), (x + 1.5 + F.col("c_nationkey") % 4).alias("xmax"), (y + 1.5 + k % 3).alias("ymax"),
    )


def triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lower left half of some buildings, as edges."""
    edge = lambda a, b, c, d: F.struct(F.col(a).alias("x1"), F.col(b).alias("y1"), F.col(c).alias("x2"), F.col(d).alias("y2"))
    edges = F.array(edge("xmin", "ymin", "xmax", "ymin"), edge("xmax", "ymin", "xmin", "ymax"), edge("xmin", "ymax", "xmin", "ymin"))
    return buildings(spark, sf_dir).where("segment = 'BUILDING'").withColumn("edges", edges)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(k.alias("id"), (k * 11 % 100 + 0.5).alias("x"), (k * 3 % 100 + 0.5).alias("y"))


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raster metadata of the tiles: cells of 0.5 or 1 m, north up."""
    t = tiles(spark, sf_dir)
    size = F.when(F.substring("kaart_index", -1, 1).isin("0", "2", "4", "6", "8"), F.lit(0.5)).otherwise(F.lit(1.0))
    return t.select(
        F.col("kaart_index").alias("raster_id"), F.col("kaart_index").alias("tile_id"), (20 / size).cast("int").alias("n_rows"), (20 / size).cast("int").alias("n_cols"),
        size.alias("a"), F.lit(0.0).alias("b"), F.col("xmin").alias("c"), F.lit(0.0).alias("d"), (-size).alias("e"), F.col("ymax").alias("f"), F.lit(28992).alias("crs"),
    )


def folder(spark: SparkSession, name: str) -> str:
    """A new folder for files that a query writes and reads: in spark.checkpoint.dir, or of this machine where all tasks run here."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{shared.removeprefix('file://').rstrip('/')}/{name}-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix=f"strataloom-{name}-")
    os.makedirs(path, exist_ok=True)
    return path


def _write(path: str, raw: bytes) -> None:
    """A file, whole or not there."""
    own = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        f.write(raw)
    os.replace(own, path)


def tile_files(spark: SparkSession, sf_dir: str, zipped: bool = False) -> str:
    """Folder of the elevation grid as GeoTIFFs of 20 rows x 100 columns in whole centimetres, one a task; each in a zip archive if so asked."""
    target = folder(spark, "tiles")

    def write(group: pa.Table) -> pa.Table:
        tile = group.column("tile")[0].as_py()
        data = np.full((20, 100), INT16_NODATA, np.int16)
        data[group.column("r").to_numpy() - tile * 20, group.column("c").to_numpy()] = group.column("h").combine_chunks().fill_null(INT16_NODATA).to_numpy()
        raw = tiff.write(data, tiff.Profile("int16", Affine.from_origin(0.0, 20.0 * -tile, 1.0, 1.0), INT16_NODATA, 0.01, 28992), [5])
        if zipped:
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w") as z:
                z.writestr("readme.txt", "no raster")
                z.writestr("tile.TIF", raw)
            raw = packed.getvalue()
        path = f"{target}/tile_{tile:06d}.{'zip' if zipped else 'tif'}"
        _write(path, raw)
        return pa.table({"file": [path]})

    grouped = dem_cm(spark, sf_dir).select(F.floor(F.col("r") / 20).alias("tile"), "r", "c", "h").groupBy("tile")
    grouped.applyInArrow(write, "file string").count()
    return target


def with_boxes(rows: DataFrame) -> DataFrame:
    """`rows` with geom, the polygon of the box columns as WKB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            corners = zip(*(batch.column(n).to_pylist() for n in ("xmin", "ymin", "xmax", "ymax")), strict=True)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([geom.box(*b) for b in corners], pa.binary())], [*batch.schema.names, "geom"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("geom", T.BinaryType())]))


def geojson_file(rows: DataFrame, target: str) -> str:
    """A collection of a (small) index: properties and geom of each row."""
    others = [c for c in rows.columns if c != "geom"]
    found = [{"type": "Feature", "properties": {c: r[c] for c in others}, "geometry": json.loads(r["json"])} for r in rows.select(*others, geojson.to_geojson(F.col("geom")).alias("json")).toLocalIterator()]
    _write(f"{target}/index.json", json.dumps({"type": "FeatureCollection", "features": found}).encode())
    return f"{target}/index.json"


def gml_archive(rows: DataFrame, target: str) -> str:
    """An extract as the topography service sends it: one archive, a GML member for each value of `member`, from rows (member, id, geom)."""
    path = f"{target}/extract.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for (name,) in rows.select("member").distinct().sort("member").collect():  # a few kinds of features
            with z.open(f"{name}.gml", "w") as f:
                f.write(b'<c:FeatureCollection xmlns:c="c" xmlns:g="http://www.opengis.net/gml">')
                for r in rows.where(F.col("member") == name).sort("id").toLocalIterator():
                    corners = " ".join(f"{x!r} {y!r}" for x, y in geom.vertices(bytes(r["geom"])))
                    shape = f'<g:Polygon srsName="EPSG:28992"><g:exterior><g:LinearRing><g:posList>{corners}</g:posList></g:LinearRing></g:exterior></g:Polygon>'
                    f.write(f"<c:featureMember><c:pand><c:id>{r['id']}</c:id><c:outline>{shape}</c:outline></c:pand></c:featureMember>".encode())
                f.write(b"</c:FeatureCollection>")
    return path
