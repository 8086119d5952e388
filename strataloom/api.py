"""The library's calls by purpose: get elevation, features and topography, fill tiles, burn floor levels.

Where a call writes GeoTIFFs, each task writes one tile at a time into a folder that the
driver and the executors share, under a name of its own, and renames it when it is whole.
"""

from __future__ import annotations

import logging
import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import replace
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.config import DataStore, Settings
from strataloom.functions import geom
from strataloom.functions.grid import Affine
from strataloom.operators import burn, fill, raster, tiles
from strataloom.operators.tiles import KEY, AHNService
from strataloom.schema import INT16_NODATA
from strataloom.sources import archive, extract_job, fetch, geojson, gpkg, tiff, vrt, wfs

logger = logging.getLogger(__name__)
#: Cells of a square that a halo is found by.
HALO_BLOCK = 64
create_vrt_file, list_tif_files_in_vrt_file = vrt.create_vrt_file, vrt.list_tif_files_in_vrt_file


def array_float_m_to_cm_int(data: np.ndarray, nodata: float | None) -> tuple[np.ndarray, int]:
    """Metres to whole centimetres of 16 bits, cut towards zero; what does not fit becomes nodata too."""
    with np.errstate(over="ignore", invalid="ignore"):
        cm = np.trunc(data.astype(np.float32) * np.float32(100))
    lost = ~np.isfinite(cm) | (cm <= INT16_NODATA) | (cm > -(INT16_NODATA + 1))
    if nodata is not None:
        lost |= data == nodata
    return np.where(lost, INT16_NODATA, np.where(lost, 0, cm)).astype(np.int16), INT16_NODATA


def create_download_dir(root_dir: str | Path, model: str = "dtm", cell_size: str = "05", ahn_version: int = 4) -> Path:
    """Folder of a product; the version is part of its name, so versions never share one."""
    path = Path(root_dir) / f"AHN{ahn_version}_{model.upper()}_{cell_size}m"
    path.mkdir(parents=True, exist_ok=True)
    return path


def get_tiles_features(spark: SparkSession, poly_mask: bytes | None = None, select_indices: Sequence[str] | None = None, ahn_service: AHNService | None = None, model: str = "dtm", cell_size: str = "05", ahn_version: int = 4, index_file: str | None = None) -> DataFrame:
    """Tile index of a service, masked and then selected by key; index_file stands for the download."""
    service = ahn_service or AHNService()
    url = service.get_tiles_url(model, cell_size, ahn_version)
    if index_file is None:
        index_file = str(fetch.download(url, DataStore().ahn_dir / f"index-{service.service}-{ahn_version}-{model}_{cell_size}{Path(url).suffix}"))
    if service.service == "ahn_pdok":
        raw = geojson.read_geojson(spark, index_file)
    else:
        raw = gpkg.read_gpkg(spark, index_file, tiles.STREAM_6_LAYER if ahn_version == 6 else None)
    found = service.tile_index(raw, ahn_version)
    if poly_mask is not None:
        found = tiles.mask(geom.with_edges(found), poly_mask).drop("edges")
    return found if select_indices is None else tiles.select_strict(found, select_indices).drop("position")


def _write_tile(folder: str, name: str, data: np.ndarray, profile: tiff.Profile) -> str:
    """A tile with overviews; whole or not there."""
    path = f"{folder}/{name}.tif"
    own = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        f.write(tiff.write(data, profile, raster.overview_factors(profile.transform.cell_size)))
    os.replace(own, path)
    return path


def get_ahn_rasters(spark: SparkSession, ahn_dir: str | Path | None = None, poly_mask: bytes | None = None, select_indices: Sequence[str] | None = None, model: str = "dtm", cell_size: str = "05", ahn_version: int = 4, service: str = "ahn_pdok", missing_only: bool = True, create_vrt: bool = True, save_tiles_index: bool = False, index_file: str | None = None, settings: Settings | None = None) -> Path:
    """Tiles of an elevation product as GeoTIFFs: the mosaic file, or the folder without `create_vrt`.

    A tile that cannot be had or read is logged and left out; the others are written.
    """
    found = get_tiles_features(spark, poly_mask, select_indices, AHNService(service), model, cell_size, ahn_version, index_file)
    field = AHNService(service).download_url_field(model, cell_size, ahn_version)
    folder = create_download_dir(ahn_dir or DataStore().ahn_dir, model, cell_size, ahn_version)
    if save_tiles_index:
        gpkg.write_gpkg(found, folder / f"{folder.name}.gpkg", folder.name)
    wanted = tiles.select_url(found, field)
    if missing_only:
        there = [(f.stem,) for f in folder.glob("*.tif")]
        wanted = tiles.missing(wanted, spark.createDataFrame(there, f"{KEY} string"))
    in_cm, target = (settings or Settings()).m_to_cm, str(folder)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, url in zip(frame[KEY], frame["url"], strict=True):
                try:
                    raw, kind = fetch.get(url)
                    if archive.is_zip(kind, url):
                        raw = archive.first_member(raw, ".tif")
                    data, profile = tiff.read(raw)
                    if in_cm:
                        data, nodata = array_float_m_to_cm_int(data, profile.nodata)
                        profile = replace(profile, dtype="int16", nodata=nodata, scale=0.01)
                    else:
                        profile = replace(profile, scale=1.0)
                    _write_tile(target, key, data, profile)
                    error = None
                except Exception as e:  # one tile does not stop the others; the driver reports it
                    error = f"{type(e).__name__}: {e}"
                yield pd.DataFrame({KEY: [key], "error": [error]})

    # One row a tile comes back.
    for row in wanted.distinct().repartition(64, KEY).mapInPandas(work, f"{KEY} string, error string").where("error is not null").toLocalIterator():
        logger.error("tile %s: %s", row[KEY], row["error"])
    return create_vrt_file(folder / f"{folder.name}.vrt", folder) if create_vrt else folder


def mosaic_cells(spark: SparkSession, files: Sequence[str | Path]) -> tuple[DataFrame, DataFrame, Affine]:
    """Cells (r, c, h, raster_id, priority) of files on the grid of the first, their metadata with r0 and c0, and that grid.

    The grid's origin is the upper left corner of them all. A file that cannot be read is an error.
    """
    names = [str(f) for f in files]
    contents = spark.read.format("binaryFile").load(names).select("path", "content")
    blocks = tiff.scan(contents)
    meta = tiff.metadata(contents)
    rows = meta.collect()  # one row a file
    if bad := [r for r in rows if r["error"]]:
        raise ValueError(f"{bad[0]['path']}: {bad[0]['error']}")
    first = min(rows, key=lambda r: names.index(_local(r["path"])))
    grid = Affine(first["a"], 0.0, min(r["c"] for r in rows), 0.0, first["e"], max(r["f"] for r in rows))
    order = spark.createDataFrame([(_local(n), i) for i, n in enumerate(names)], "_path string, priority int")
    place = {"r0": F.round((F.col("f") - grid.f) / grid.e).cast("int"), "c0": F.round((F.col("c") - grid.c) / grid.a).cast("int"), "_path": F.regexp_replace("path", "^file:/+", "/")}
    meta = spark.createDataFrame(rows, meta.schema).withColumns(place).join(order, "_path", "left").drop("_path")
    cells = raster.to_cells(blocks.select("raster_id", "path", "br", "bc", "n_rows", "n_cols", "data"), tiff.TILE)
    cells = cells.join(F.broadcast(meta.select("path", "r0", "c0", "priority")), "path")  # one row a file, as the driver has just read them
    return cells.select((F.col("r") + F.col("r0")).alias("r"), (F.col("c") + F.col("c0")).alias("c"), "h", "raster_id", "priority"), meta, grid


def _local(path: str) -> str:
    return "/" + path.removeprefix("file:").lstrip("/")


def _write_tiles(cells: DataFrame, meta: DataFrame, folder: Path) -> None:
    """Tiles of cells (raster_id, r, c, h) on the mosaic's grid, in the shape that `meta` has for each."""
    target = str(folder)
    columns = ["raster_id", "height", "width", "a", "e", "c", "f", "nodata", "scale", "crs", "dtype", "r0", "c0"]
    facts = {r["raster_id"]: r.asDict() for r in meta.select(*columns).collect()}

    def work(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        m = facts[key[0]]
        kind = np.dtype(m["dtype"])
        nodata = m["nodata"] if m["nodata"] is not None else (np.nan if kind.kind == "f" else 0)
        data = np.full((m["height"], m["width"]), nodata, kind)
        known = frame[frame["h"].notna()]
        value = known["h"].to_numpy(float)
        if kind.kind in "iu":
            value = np.trunc(value + np.copysign(0.5, value))  # halves away from zero
        data[known["r"].to_numpy() - m["r0"], known["c"].to_numpy() - m["c0"]] = value.astype(kind)
        profile = tiff.Profile(m["dtype"], Affine(m["a"], 0.0, m["c"], 0.0, m["e"], m["f"]), m["nodata"], m["scale"], m["crs"])
        return pd.DataFrame({"file": [_write_tile(target, key[0], data, profile)]})

    cells.select("raster_id", "r", "c", "h").groupBy("raster_id").applyInPandas(work, "file string").count()


def _files_near(spark: SparkSession, files: Sequence[Path], wanted: set[str], search: int) -> list[Path]:
    """The wanted files and those within `search` cells of one, in their order; from metadata alone."""
    meta = tiff.metadata(spark.read.format("binaryFile").load([str(f) for f in files]).select("path", "content")).collect()  # one row a file
    if bad := [r for r in meta if r["error"]]:
        raise ValueError(f"{bad[0]['path']}: {bad[0]['error']}")
    box = np.array([(min(r["c"], r["c"] + r["width"] * r["a"]), min(r["f"], r["f"] + r["height"] * r["e"]), max(r["c"], r["c"] + r["width"] * r["a"]), max(r["f"], r["f"] + r["height"] * r["e"])) for r in meta])
    reach = (search + 1) * max(abs(r["a"]) for r in meta)
    near: set[str] = set()
    for i in [i for i, r in enumerate(meta) if r["raster_id"] in wanted]:
        hit = (box[:, 0] <= box[i, 2] + reach) & (box[:, 2] >= box[i, 0] - reach) & (box[:, 1] <= box[i, 3] + reach) & (box[:, 3] >= box[i, 1] - reach)
        near |= {_local(meta[j]["path"]) for j in np.flatnonzero(hit)}
    # The first file gives the grid, so it stays.
    return [f for n, f in enumerate(files) if n == 0 or _local(str(f)) in near]


def interpolate_ahn_tiles(spark: SparkSession, ahn_vrt_file: str | Path, indices: Sequence[str] | None = None, max_search_distance: float = 100, dir_name: str = "ahn_filled", create_vrt: bool = True, missing_only: bool = False, datastore: DataStore | None = None) -> Path:
    """Tiles of a mosaic with holes filled from the whole mosaic: the new mosaic file, or the folder.

    max_search_distance counts cells, as the fill does. Unknown indices are ignored;
    `missing_only` leaves the tiles that the folder has.
    """
    folder = (datastore or DataStore()).processed / dir_name
    folder.mkdir(parents=True, exist_ok=True)
    files = list_tif_files_in_vrt_file(ahn_vrt_file)
    wanted = {f.stem for f in files if indices is None or f.stem in set(indices)}
    if missing_only:
        wanted -= {f.stem for f in folder.glob("*.tif")}
    if wanted:
        search = int(max_search_distance)
        files = _files_near(spark, files, wanted, search)
        cells, meta, _ = mosaic_cells(spark, files)
        asked = F.broadcast(spark.createDataFrame([(w,) for w in sorted(wanted)], "raster_id string"))
        # Cells of the wanted tiles and of a halo as wide as the search; nothing beyond it can count.
        boxes = meta.join(asked, "raster_id").select(*[e.alias(n) for n, e in (("top", F.col("r0")), ("left", F.col("c0")), ("bottom", F.col("r0") + F.col("height")), ("right", F.col("c0") + F.col("width")))])
        tile = lambda at: F.floor(F.col(at) / HALO_BLOCK)
        spans = [F.sequence(F.floor((F.col(lo) - search) / HALO_BLOCK), F.floor((F.col(hi) - 1 + search) / HALO_BLOCK)) for lo, hi in (("top", "bottom"), ("left", "right"))]
        near = boxes.select(F.explode(spans[0]).alias("br"), spans[1].alias("bcs")).select("br", F.explode("bcs").alias("bc")).distinct()
        near = cells.withColumns({"br": tile("r"), "bc": tile("c")}).join(F.broadcast(near) if len(wanted) <= 1000 else near, ["br", "bc"], "left_semi").drop("br", "bc")
        near = near.join(asked.withColumn("asked", F.lit(True)), "raster_id", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
        whole = near.groupBy("r", "c").agg(F.max_by("h", F.when(F.col("h").isNotNull(), F.col("priority"))).alias("h"), F.max("asked").alias("asked"))
        filled = fill.void_fill(whole, search, F.col("asked"), keep=("asked",)).select("r", "c", "h")
        own = near.where("asked").select("raster_id", "r", "c")
        _write_tiles(own.join(filled, ["r", "c"]), meta, folder)
    return create_vrt_file(folder / f"{folder.name}.vrt", folder) if create_vrt else folder


def rasterize_bag(spark: SparkSession, dem_raster: str | Path, bag: DataFrame, bag_pand_tif: str | Path, buffer_step_m: float, elevation_offset_m: float = 0.05) -> DataFrame:
    """Burn floor levels of polygons (geom, optionally seq) into a GeoTIFF on the raster's grid; `bag` with vloerpeil comes back.

    The raster may be a GeoTIFF or a mosaic file. A polygon without a level in reach burns nothing.
    """
    dem_raster, out = Path(dem_raster), Path(bag_pand_tif)
    files = list_tif_files_in_vrt_file(dem_raster) if dem_raster.suffix == ".vrt" else [dem_raster.resolve()]
    cells, meta, grid = mosaic_cells(spark, files)
    whole = cells.groupBy("r", "c").agg(F.max_by("h", F.when(F.col("h").isNotNull(), F.col("priority"))).alias("h"))
    first = meta.orderBy("priority").first()
    shapes = bag if "seq" in bag.columns else bag.withColumn("seq", F.monotonically_increasing_id())
    shapes = geom.with_edges(shapes.withColumn("_row", F.monotonically_increasing_id())).withColumn("id", F.col("_row")) if "id" not in bag.columns else geom.with_edges(shapes)
    whole_numbers = np.dtype(first["dtype"]).kind in "iu"
    levels = burn.floor_levels(shapes.select("id", "seq", "edges", "xmin", "ymin", "xmax", "ymax"), whole, buffer_step_m, elevation_offset_m, first["scale"], grid)
    if not whole_numbers:
        logger.info("levels of a raster of floats are cut to whole numbers, as burning does")
    burnt = burn.burn(levels, whole, grid)
    size = meta.agg(F.max(F.col("r0") + F.col("height")).alias("height"), F.max(F.col("c0") + F.col("width")).alias("width")).first()
    facts = spark.createDataFrame([(out.stem, size["height"], size["width"], grid.a, grid.e, grid.c, grid.f, first["nodata"], first["scale"], first["crs"], first["dtype"], 0, 0)], "raster_id string, height int, width int, a double, e double, c double, f double, nodata double, scale double, crs int, dtype string, r0 int, c0 int")
    out.parent.mkdir(parents=True, exist_ok=True)
    _write_tiles(burn.onto_grid(burnt, whole).withColumn("raster_id", F.lit(out.stem)), facts, out.parent)
    return shapes.join(levels.select("id", "vloerpeil"), "id").drop("edges")


def download_bag_light(download_dir: str | Path | None = None, overwrite: bool = True, root: str = wfs.BAG_URL) -> Path:
    return fetch.download(f"{root}/atom/downloads/bag-light.gpkg", Path(download_dir or DataStore().bag_dir) / "bag-light.gpkg", overwrite)


def get_bag_features(spark: SparkSession, bbox: tuple[float, float, float, float], *, layer: str = "pand", source: str = "wfs", bag_light_gpkg: str | Path | None = None, wfs_crs: int = 28992, url: str = f"{wfs.BAG_URL}/wfs/v2_0") -> DataFrame:
    """Buildings or addresses in an extent, from the service or from the national file."""
    if source == "wfs":
        return wfs.read_wfs(spark, bbox, wfs.TYPE_NAMES[layer], wfs_crs, url)
    path = Path(bag_light_gpkg) if bag_light_gpkg else DataStore().bag_dir / "bag-light.gpkg"
    return gpkg.read_gpkg(spark, str(path), layer, bbox)


def get_bgt_features(spark: SparkSession, featuretypes: Sequence[str], poly_mask: bytes | None = None, download_dir: str | Path | None = None, crs: int = 28992, poll_interval_s: float = 5, root: str = extract_job.BGT_ROOT) -> Path:
    """Topography as one GeoPackage a feature type: the folder that holds them."""
    folder = Path(download_dir or DataStore().bgt_dir)
    job = extract_job.submit(featuretypes, poly_mask, root)
    packed = fetch.download(extract_job.poll(job, poll_interval_s, root=root), folder / f"download-{job}.zip", timeout=600)
    try:
        found = extract_job.read_extract(spark, packed, crs)
        flat = found.select("file", "id", "layer", F.to_json("attributes").alias("attributes"), "geom").cache()
        for (name,) in flat.select("file").distinct().collect():  # one row a feature type
            gpkg.write_gpkg(flat.where(F.col("file") == name).drop("file"), folder / f"{name}.gpkg", name, crs)
        flat.unpersist()
    finally:
        packed.unlink()
    return folder


__all__ = [
    "AHNService", "array_float_m_to_cm_int", "create_download_dir", "create_vrt_file", "download_bag_light", "get_ahn_rasters", "get_bag_features",
    "get_bgt_features", "get_tiles_features", "interpolate_ahn_tiles", "list_tif_files_in_vrt_file", "mosaic_cells", "rasterize_bag",
]
