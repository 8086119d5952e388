"""Paged WFS: pages by start index until one is short, with a cap that keeps what came."""

from __future__ import annotations

import json
import logging
import urllib.parse
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from strataloom.functions import geom
from strataloom.sources import fetch

logger = logging.getLogger(__name__)

#: Public building and address service (fixed values), and its limits.
BAG_URL = "https://service.pdok.nl/lv/bag"
TYPE_NAMES = {"pand": "bag:pand", "verblijfsobject": "bag:verblijfsobject"}
PAGE, CAP = 1000, 50_000


def bbox_text(bbox: tuple[float, float, float, float], crs: int) -> str:
    return ",".join([*map(str, bbox), f"EPSG:{crs}"])


def pages(url: str, type_name: str, bbox: tuple[float, float, float, float] | None, crs: int = 28992, page: int = PAGE, cap: int = CAP) -> Iterator[list[dict]]:
    """GeoJSON features of each page. At the cap or beyond it warns and stops; that page is whole."""
    params = {"service": "WFS", "version": "2.0.0", "request": "GetFeature", "typeNames": type_name, "srsName": f"EPSG:{crs}", "count": page, "outputFormat": "application/json"}
    if bbox is not None:
        params["bbox"] = bbox_text(bbox, crs)
    start = 0
    while True:
        raw, _ = fetch.get(url, params | {"startIndex": start})
        found = json.loads(raw).get("features") or []
        if not found:
            return
        yield found
        start += len(found)
        if start >= cap:
            logger.warning("%s features or more from %s: the rest is left", cap, urllib.parse.urlsplit(url).path)
            return
        if len(found) < page:
            return


class WfsSource(DataSource):
    """format("wfs"): options url, typeName, bbox "xmin,ymin,xmax,ymax", crs, count, cap."""

    @classmethod
    def name(cls) -> str:
        return "wfs"

    def schema(self) -> str:
        return "id string, properties map<string,string>, geom binary, xmin double, ymin double, xmax double, ymax double, crs int"

    def reader(self, schema) -> DataSourceReader:
        return _WfsReader(dict(self.options))


class _WfsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o = self.options
        bbox = tuple(map(float, o["bbox"].split(","))) if o.get("bbox") else None
        crs = int(o.get("crs", 28992))
        for page in pages(o["url"], o["typename"], bbox, crs, int(o.get("count", PAGE)), int(o.get("cap", CAP))):
            for f in page:
                wkb = geom.from_geojson(f["geometry"]) if f.get("geometry") else None
                text = {k: None if v is None else v if isinstance(v, str) else json.dumps(v) for k, v in (f.get("properties") or {}).items()}
                yield f.get("id"), text, wkb, *((wkb and geom.bounds(wkb)) or (None,) * 4), crs


def read_wfs(spark: SparkSession, bbox: tuple[float, float, float, float], type_name: str = "bag:pand", crs: int = 28992, url: str = f"{BAG_URL}/wfs/v2_0", page: int = PAGE, cap: int = CAP) -> DataFrame:
    """Features in an extent; an error of any page fails the read."""
    spark.dataSource.register(WfsSource)
    options = {"url": url, "typeName": type_name, "bbox": ",".join(map(str, bbox)), "crs": crs, "count": page, "cap": cap}
    return spark.read.format("wfs").options(**options).load()
