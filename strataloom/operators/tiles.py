"""Tile index: service rules, download columns, selection, neighbours."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.functions import geom

#: Places of the public elevation services (fixed values).
PDOK_INDEX = "https://service.pdok.nl/rws/ahn/atom/downloads/{model}_{cell_size}m/kaartbladindex.json"
STREAM_INDEX = "https://basisdata.nl/hwh-ahn/AUX/bladwijzer.gpkg"
STREAM_INDEX_6 = "https://basisdata.nl/hwh-ahn/AUX/bladwijzer_AHN6.gpkg"
STREAM_6_ROOT = "https://fsn1.your-objectstorage.com/hwh-ahn/AHN6/"
STREAM_6_LAYER = "bladindeling_aoi"
#: Of version 6: column, folder and mark in the file name.
STREAM_6_PRODUCTS = (("dtm_05", "02a_DTM_50cm", "M"), ("dtm_5", "02b_DTM_5m", "M5"), ("dsm_05", "03a_DSM_50cm", "R"), ("dsm_5", "03b_DSM_5m", "R5"))
KEY = "kaart_index"


@dataclass(frozen=True)
class AHNService:
    """Rules of an elevation service: `ahn_datastroom` (versions 3-6, both cell sizes) or `ahn_pdok` (version 4 at 0.5 m)."""

    service: str = "ahn_datastroom"

    def __post_init__(self) -> None:
        if self.service not in ("ahn_pdok", "ahn_datastroom"):
            raise ValueError(f"service should be 'ahn_pdok' or 'ahn_datastroom', not {self.service!r}")

    def validate(self, cell_size: str, ahn_version: int, model: str = "dtm") -> None:
        pdok = self.service == "ahn_pdok"
        rules = (
            (model in ("dtm", "dsm"), f"model should be 'dtm' or 'dsm', not {model!r}"),
            (cell_size in ("05", "5"), f"cell_size should be '05' or '5', not {cell_size!r}"),
            (ahn_version in (3, 4, 5, 6), f"ahn_version should be 3 to 6, not {ahn_version!r}"),
            (not pdok or cell_size == "05", "ahn_pdok only has cell_size '05'"),
            (not pdok or ahn_version == 4, "ahn_pdok only has ahn_version 4"),
        )
        for holds, message in rules:
            if not holds:
                raise ValueError(message)

    def get_tiles_url(self, model: str = "dtm", cell_size: str = "05", ahn_version: int = 4) -> str:
        self.validate(cell_size, ahn_version, model)
        if self.service == "ahn_pdok":
            return PDOK_INDEX.format(model=model, cell_size=cell_size)
        return STREAM_INDEX_6 if ahn_version == 6 else STREAM_INDEX

    def download_url_field(self, model: str = "dtm", cell_size: str = "05", ahn_version: int = 4) -> str:
        """Name of the index column that holds a tile's URL."""
        self.validate(cell_size, ahn_version, model)
        if self.service == "ahn_pdok":
            return "url"
        return f"{model}_{cell_size}" if ahn_version == 6 else f"AHN{ahn_version}_{cell_size}M_{'M' if model == 'dtm' else 'R'}"

    def tile_index(self, raw: DataFrame, ahn_version: int = 4) -> DataFrame:
        """The index with its key: renamed, prefixed, or with the product URLs of version 6."""
        if self.service == "ahn_pdok":
            return raw.withColumnRenamed("kaartbladNr", KEY)
        if ahn_version < 6:
            return raw.withColumn(KEY, F.concat(F.lit("M_"), F.col("AHN")))
        return with_product_urls(raw, "bladnaam", ahn_version).withColumnRenamed("bladnaam", KEY)


def with_product_urls(tiles: DataFrame, name_col: str, ahn_version: int = 6) -> DataFrame:
    """Four URL columns of a version 6 tile."""
    url = lambda folder, mark: F.concat(F.lit(f"{STREAM_6_ROOT}{folder}/AHN{ahn_version}_2025_{mark}_"), F.col(name_col), F.lit(".TIF"))
    return tiles.withColumns({column: url(folder, mark) for column, folder, mark in STREAM_6_PRODUCTS})


def select_url(tiles: DataFrame, field: str) -> DataFrame:
    return tiles.select(KEY, F.col(field).alias("url"))


def mask(tiles: DataFrame, wkb: bytes | None) -> DataFrame:
    """Rows whose geometry meets the mask (touching counts): box columns first, then edges where `tiles` has them."""
    if wkb is None:
        return tiles
    own = tuple(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))
    near = tiles.where(geom.boxes_meet(own, tuple(F.lit(float(v)) for v in geom.bounds(wkb))))
    edges = F.col("edges") if "edges" in tiles.columns else box_edges()
    return near.where(geom.intersects(edges, geom.edge_literal(wkb)))


def box_edges() -> Column:
    """Edges of the box columns."""
    corner = [("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax")]
    return F.array(*[F.struct(F.col(a).alias("x1"), F.col(b).alias("y1"), F.col(c).alias("x2"), F.col(d).alias("y2")) for (a, b), (c, d) in zip(corner, corner[1:] + corner[:1], strict=True)])


def _keys(tiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    return tiles.sparkSession.createDataFrame(list(enumerate(keys)), f"position int, {KEY} string")


def select_strict(tiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the keys in the order asked (column `position`), repeated as asked; KeyError if one is not there."""
    asked = _keys(tiles, keys)
    lost = [r[0] for r in asked.join(tiles, KEY, "left_anti").select(KEY).distinct().sort(KEY).collect()]
    if lost:
        raise KeyError(f"not in the index: {lost}")
    return F.broadcast(asked).join(tiles, KEY).sort("position")


def select_lenient(tiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is among the keys; unknown keys are ignored."""
    return tiles.where(F.col(KEY).isin(list(keys)))


def missing(tiles: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows whose key is not among those of `existing`."""
    return tiles.join(existing.select(KEY), KEY, "left_anti")


def neighbours(tiles: DataFrame, distance: float, size: float) -> DataFrame:
    """Pairs (kaart_index, neighbour) of tiles at most `distance` apart, a tile itself included.

    Tiles meet in squares of `size` that their grown box covers, by an equi-join; a pair
    is kept in the square that holds the lower corner of what the two share.
    """
    spot = lambda lo, hi: F.sequence(F.floor(lo / size), F.floor(hi / size))
    d = F.lit(float(distance))
    left = tiles.select(KEY, *[F.col(c).alias(f"{c}1") for c in ("xmin", "ymin", "xmax", "ymax")])
    left = left.withColumn("sx", F.explode(spot(F.col("xmin1") - d, F.col("xmax1") + d))).withColumn("sy", F.explode(spot(F.col("ymin1") - d, F.col("ymax1") + d)))
    right = tiles.select(F.col(KEY).alias("neighbour"), "xmin", "ymin", "xmax", "ymax")
    right = right.withColumn("sx", F.explode(spot(F.col("xmin"), F.col("xmax")))).withColumn("sy", F.explode(spot(F.col("ymin"), F.col("ymax"))))
    dx = F.greatest(F.col("xmin") - F.col("xmax1"), F.lit(0.0), F.col("xmin1") - F.col("xmax"))
    dy = F.greatest(F.col("ymin") - F.col("ymax1"), F.lit(0.0), F.col("ymin1") - F.col("ymax"))
    first = (F.col("sx") == F.floor(F.greatest(F.col("xmin1") - d, F.col("xmin")) / size)) & (F.col("sy") == F.floor(F.greatest(F.col("ymin1") - d, F.col("ymin")) / size))
    return left.join(right, ["sx", "sy"]).where(first & (F.sqrt(dx * dx + dy * dy) <= d)).select(KEY, "neighbour")


def total_bounds(features: DataFrame) -> DataFrame:
    return features.agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))
