"""One query for each operator, over the derived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataloom.functions import geom, grid, scale
from strataloom.operators import burn, fill, raster, tiles, zonal
from strataloom.plans import fixtures as fx
from strataloom.sources import archive, geojson, gml, gpkg, tiff, vrt
from strataloom.sources.wfs import CAP, PAGE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SEARCH = 5
MASK = geom.polygon([[(15.0, 15.0), (70.0, 15.0), (15.0, 70.0), (15.0, 15.0)]])
AREA = (20.5, 20.5, 60.5, 60.5)
PRODUCT = tiles.AHNService()


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def pages(features: DataFrame, size: int, cap: int) -> DataFrame:
    """Rows (page, features, first_id, last_id): features (id) in pages by rank of id, none that begins at or beyond the cap.

    Ids are counted by ranges and the few ranges summed up, so no task orders all features.
    """
    spread = features.withColumn("range", F.floor(F.col("id") / size))
    counts = spread.groupBy("range").agg(F.count("*").alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for about `size` ids
    starts = counts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    n = F.col("start") + F.row_number().over(Window.partitionBy("range").orderBy("id")) - 1
    paged = spread.join(starts, "range").withColumn("page", F.floor(n / size).cast("int")).where(F.col("page") * size < cap)
    return paged.groupBy("page").agg(F.count("*").alias("features"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def _keys(spark: SparkSession, sf_dir: str) -> list[str]:
    return [r[0] for r in fx.tiles(spark, sf_dir).select("kaart_index").sort("kaart_index").limit(4).collect()]


@query
def scale_m_to_cm(s: SparkSession, d: str) -> DataFrame:
    return fx.dem(s, d).select("r", "c", scale.scaled(F.col("elevation_m"))[0].cast("int").alias("h"))


@query
def scale_switch_raw(s: SparkSession, d: str) -> DataFrame:
    value, factor = scale.scaled(F.col("elevation_m"), m_to_cm=False)
    return fx.dem(s, d).select("r", "c", F.round(value, 4).alias("h"), F.lit(factor).alias("scale"))


@query
def nodata_filter(s: SparkSession, d: str) -> DataFrame:
    stored = fx.dem_cm(s, d).select("r", "c", scale.to_sentinel(F.col("h").cast("int")).alias("h"))
    return raster.valid(stored.withColumn("h", scale.to_null(F.col("h"), -32768)))


@query
def tile_index_urls(s: SparkSession, d: str) -> DataFrame:
    t = fx.tiles(s, d)
    keyed = tiles.AHNService("ahn_datastroom").tile_index(t.withColumnRenamed("kaart_index", "AHN"), 4)
    old = keyed.select("kaart_index", "AHN")
    new = tiles.with_product_urls(t.withColumnRenamed("kaart_index", "AHN"), "AHN").select("AHN", "dtm_05", "dtm_5", "dsm_05", "dsm_5")
    return old.join(new, "AHN")


@query
def tile_url_field(s: SparkSession, d: str) -> DataFrame:
    t = tiles.with_product_urls(fx.tiles(s, d), "kaart_index")
    return tiles.select_url(t, PRODUCT.download_url_field(model="dsm", cell_size="5", ahn_version=6))


@query
def tile_mask_intersects(s: SparkSession, d: str) -> DataFrame:
    return tiles.mask(fx.tiles(s, d), MASK).select("kaart_index", "xmin", "ymin")


@query
def tile_select_strict(s: SparkSession, d: str) -> DataFrame:
    keys = _keys(s, d)
    return tiles.select_strict(fx.tiles(s, d), [keys[2], keys[0], keys[2]]).select("position", "kaart_index", "xmin")


@query
def tile_select_lenient(s: SparkSession, d: str) -> DataFrame:
    return tiles.select_lenient(fx.tiles(s, d), [*_keys(s, d)[:2], "no such tile"]).select("kaart_index", "xmin", "ymin")


@query
def tile_missing_only(s: SparkSession, d: str) -> DataFrame:
    t = fx.tiles(s, d)
    return tiles.missing(t, t.where("xmin < 40")).select("kaart_index", "xmin", "ymin")


@query
def tile_neighbours(s: SparkSession, d: str) -> DataFrame:
    return tiles.neighbours(fx.tiles(s, d), 5.0, 20.0)


@query
def tile_total_bounds(s: SparkSession, d: str) -> DataFrame:
    return tiles.total_bounds(fx.tiles(s, d))


@query
def tile_buffered_window(s: SparkSession, d: str) -> DataFrame:
    """Read window of each tile grown by 10, clipped to a raster of 100 x 100 cells of 0.8, and its slice and origin."""
    t = grid.Affine.from_origin(0.0, 80.0, 0.8, 0.8)
    grown = [F.col(c) + k for c, k in (("xmin", -10), ("ymin", -10), ("xmax", 10), ("ymax", 10))]
    window = grid.clip_window(grid.window_of(t, *grown), 100, 100)
    places = grid.slice_of(window)
    origin = grid.window_transform(t, window)
    rows = fx.tiles(s, d).where((window["width"] > 0) & (window["height"] > 0))
    window = grid.require_window(window)
    return rows.select("kaart_index", *[F.round(v, 4).alias(k) for k, v in window.items()], *[v.alias(f"whole_{k}") for k, v in places.items()], *[F.round(v, 4).alias(f"origin_{k}") for k, v in origin.items()])


@query
def bbox_features(s: SparkSession, d: str) -> DataFrame:
    own = tuple(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))
    return fx.buildings(s, d).where(geom.boxes_meet(own, tuple(map(F.lit, AREA)))).select("id", "xmin", "ymin", "xmax", "ymax")


@query
def wfs_pages(s: SparkSession, d: str) -> DataFrame:
    """Features of each page as a paged service would give them: pages of 1,000 until one is short, none begun at or beyond the cap of 50,000."""
    return pages(fx.buildings(s, d).select("id"), PAGE, CAP)


@query
def page_concat(s: SparkSession, d: str) -> DataFrame:
    b = fx.buildings(s, d).select("id", "segment")
    return b.where("id % 2 = 1").unionByName(b.where("id % 2 = 0").select("id"), allowMissingColumns=True)


@query
def point_sample(s: SparkSession, d: str) -> DataFrame:
    return raster.sample_points(fx.dem_cm(s, d), fx.points(s, d), grid.GRID).select("id", "r", "c", F.col("h").cast("int").alias("h"))


@query
def zonal_percentile(s: SparkSession, d: str) -> DataFrame:
    return zonal.zonal_percentile(fx.buildings(s, d), fx.dem_cm(s, d))


@query
def zonal_percentile_params(s: SparkSession, d: str) -> DataFrame:
    inside = zonal.cells_inside(fx.buildings(s, d), fx.dem_cm(s, d).where("h is not null"))
    return inside.groupBy("id").agg(*[F.round(F.percentile("h", p / 100), 4).alias(f"p{p}") for p in (25, 50, 90)])


@query
def floor_level_search(s: SparkSession, d: str) -> DataFrame:
    return zonal.level_search(fx.buildings(s, d), fx.dem_cm(s, d))


@query
def floor_level_search_step(s: SparkSession, d: str) -> DataFrame:
    return zonal.level_search(fx.buildings(s, d), fx.dem_cm(s, d), step=2.0, percentile=50, rounds=10)


@query
def burn_polygons(s: SparkSession, d: str) -> DataFrame:
    shapes = fx.triangles(s, d).withColumn("value", (F.col("seq") % 1000).cast("int"))
    return burn.burn(shapes, fx.dem_cm(s, d))


@query
def offset_by_scale(s: SparkSession, d: str) -> DataFrame:
    levels = zonal.zonal_percentile(fx.buildings(s, d), fx.dem_cm(s, d))
    return levels.select("id", scale.burned(F.col("level"), 0.01).alias("scaled"), scale.burned(F.col("level"), 1.0).alias("unscaled"))


@query
def floor_level_burn(s: SparkSession, d: str) -> DataFrame:
    cells = fx.dem_cm(s, d)
    return burn.onto_grid(burn.burn_floor_levels(fx.buildings(s, d), cells, step=1.0), cells)


@query
def void_fill(s: SparkSession, d: str) -> DataFrame:
    return fill.void_fill(fx.dem_cm(s, d), SEARCH).where("was_hole").select("r", "c", F.round("h", 4).alias("h"))


@query
def void_fill_tile_subset(s: SparkSession, d: str) -> DataFrame:
    """Two tiles of 20 x 20 cells, filled from the whole mosaic."""
    wanted = F.col("r").between(0, 19) & F.col("c").between(20, 59)
    return fill.void_fill(fx.dem_cm(s, d), SEARCH, wanted).select("r", "c", fill.stored(F.col("h")).alias("h"))


@query
def overview_5(s: SparkSession, d: str) -> DataFrame:
    return raster.overview(fx.dem_cm(s, d), raster.overview_factors(1.0)[0]).select("r", "c", F.round("h", 4).alias("h"))


@query
def overview_25(s: SparkSession, d: str) -> DataFrame:
    return raster.overview(fx.dem_cm(s, d), raster.overview_factors(1.0)[1]).select("r", "c", F.round("h", 4).alias("h"))


@query
def mosaic_priority(s: SparkSession, d: str) -> DataFrame:
    return raster.mosaic([fx.dem_cm(s, d).withColumn("h", F.col("h").cast("int")), fx.dsm(s, d)]).where("h is not null")


@query
def mosaic_resolution(s: SparkSession, d: str) -> DataFrame:
    return raster.mosaic_resolution(fx.meta(s, d)).select(F.round("resolution", 6).alias("resolution"))


@query
def composite_dem(s: SparkSession, d: str) -> DataFrame:
    """Filled ground with floor levels of buildings on top: the whole product."""
    cells = fx.dem_cm(s, d)
    ground = fill.void_fill(cells, SEARCH).select("r", "c", fill.stored(F.col("h")).alias("h"))
    return burn.composite(ground, burn.burn_floor_levels(fx.buildings(s, d), cells, step=1.0))


@query
def raster_footprints(s: SparkSession, d: str) -> DataFrame:
    return raster.footprints(fx.meta(s, d)).drop("raster_id")


@query
def raster_blocks(s: SparkSession, d: str) -> DataFrame:
    """Cells to blocks and back."""
    cells = fx.dem_cm(s, d)
    sized = cells.crossJoin(F.broadcast(cells.agg((F.max("r") + 1).alias("n_rows"))))  # one row
    return raster.to_cells(raster.to_blocks(sized, 32, F.col("n_rows"), 100), 32).select("r", "c", F.col("h").cast("int").alias("h"))


@query
def windowed_read(s: SparkSession, d: str) -> DataFrame:
    return raster.read_window(fx.dem_cm(s, d), 2, 30, 40, 50).select("r", "c", F.col("h").cast("int").alias("h"))


@query
def geometry_type_distinct(s: SparkSession, d: str) -> DataFrame:
    """Kinds of geometries written and read as WKB."""
    rows = fx.buildings(s, d).select("id")
    point_ = F.concat(F.unhex(F.lit("0101000000")), F.unhex(F.lit("00" * 16)))
    polygon_ = F.lit(geom.box(0, 0, 1, 1))
    return rows.select(geom.geometry_kind(F.when(F.col("id") % 4 == 0, point_).otherwise(polygon_)).alias("kind")).distinct()


@query
def feature_count(s: SparkSession, d: str) -> DataFrame:
    b = fx.buildings(s, d)
    return b.groupBy("segment").agg(F.count("*").alias("features"), F.every(F.col("segment").startswith("B")).alias("all_b"))


@query
def geotiff_round_trip(s: SparkSession, d: str) -> DataFrame:
    """Valid cells of the grid, written as GeoTIFFs and scanned back from the folder."""
    blocks = tiff.scan(tiff.files(s, fx.tile_files(s, d)))
    cells = raster.to_cells(blocks.select("f", "br", "bc", "n_rows", "n_cols", "data"), tiff.TILE)
    return raster.valid(cells).select((F.col("r") - F.col("f").cast("int")).alias("r"), "c", F.col("h").cast("int").alias("h"))


@query
def geotiff_metadata(s: SparkSession, d: str) -> DataFrame:
    """Size, place, nodata and scale of every file of the folder, without decoding a cell."""
    rows = tiff.metadata(tiff.files(s, fx.tile_files(s, d)))
    return rows.select("raster_id", "height", "width", F.col("f").alias("top"), F.col("nodata").cast("int").alias("nodata"), "scale", "crs", "dtype")


@query
def gpkg_round_trip(s: SparkSession, d: str) -> DataFrame:
    """Buildings written as a layer of a GeoPackage, and those in an extent read back through its R-tree."""
    path = f"{fx.folder(s, 'gpkg')}/buildings.gpkg"
    gpkg.write_gpkg(fx.with_boxes(fx.buildings(s, d)).select("id", "segment", "geom"), path, "pand")
    return gpkg.read_gpkg(s, path, "pand", AREA).select("id", "segment", "xmin", "ymin", "xmax", "ymax", "crs")


@query
def geojson_round_trip(s: SparkSession, d: str) -> DataFrame:
    """The tile index written as a GeoJSON collection and read back."""
    path = fx.geojson_file(fx.with_boxes(fx.tiles(s, d)).select(F.col("kaart_index").alias("kaartbladNr"), "geom"), fx.folder(s, "geojson"))
    return tiles.AHNService("ahn_pdok").tile_index(geojson.read_geojson(s, path)).select("kaart_index", "xmin", "ymin", "xmax", "ymax")


@query
def zipped_gml(s: SparkSession, d: str) -> DataFrame:
    """Buildings of each segment as a GML member of one archive, read back with member, attributes and bounds."""
    path = fx.gml_archive(fx.with_boxes(fx.buildings(s, d)).select(F.lower("segment").alias("member"), "id", "geom"), fx.folder(s, "gml"))
    found = gml.scan(archive.members(tiff.files(s, path, "*"), ".gml"))
    stem = F.regexp_extract("member", r"([^/]+)\.[^./]+$", 1)
    return found.select(stem.alias("file"), F.col("attributes")["id"].cast("long").alias("id"), "xmin", "ymin", "xmax", "ymax", "crs")


@query
def zipped_raster(s: SparkSession, d: str) -> DataFrame:
    """The first raster member of each archive of a folder, as cells on the grid."""
    found = archive.members(tiff.files(s, fx.tile_files(s, d, zipped=True), "*.zip"), ".tif", only_first=True)
    cells = raster.to_cells(tiff.scan(found).select("f", "br", "bc", "n_rows", "n_cols", "data"), tiff.TILE)
    return raster.valid(cells).select((F.col("r") - F.col("f").cast("int")).alias("r"), "c", F.col("h").cast("int").alias("h"))


@query
def mosaic_members(s: SparkSession, d: str) -> DataFrame:
    """Stems of the files of a virtual mosaic, in its order."""
    target = fx.tile_files(s, d)
    path = vrt.create_vrt_file(f"{target}/tiles.vrt", target)
    names = [(i, f.stem) for i, f in enumerate(vrt.list_tif_files_in_vrt_file(path))]
    return s.createDataFrame(names, "position int, member string")


@query
def geometry_to_geojson(s: SparkSession, d: str) -> DataFrame:
    """Buildings' footprints as GeoJSON, and their first corner read from it."""
    rows = fx.with_boxes(fx.buildings(s, d)).select("id", geojson.to_geojson(F.col("geom")).alias("json"))
    corner = lambda i: F.get_json_object("json", f"$.coordinates[0][0][{i}]").cast("double")
    return rows.select("id", F.get_json_object("json", "$.type").alias("kind"), corner(0).alias("x"), corner(1).alias("y"))
