"""GeoPackage (a SQLite file): a Python data source by ranges of row ids, and a writer."""

from __future__ import annotations

import os
import sqlite3
import struct
import tempfile
from collections.abc import Iterator, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from strataloom.functions import geom

_SQL_TYPES = {"INTEGER": "long", "INT": "long", "MEDIUMINT": "long", "SMALLINT": "int", "TINYINT": "int", "BOOLEAN": "boolean", "REAL": "double", "DOUBLE": "double", "FLOAT": "double", "BLOB": "binary"}
_ENVELOPES = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}


def wkb_of(blob: bytes | None) -> bytes | None:
    """WKB of a GeoPackage geometry; None where it is null or marked empty."""
    if blob is None or blob[:2] != b"GP" or blob[3] & 0x10:
        return None
    return blob[8 + _ENVELOPES[blob[3] >> 1 & 7] :]


def blob_of(wkb: bytes, crs: int) -> bytes:
    x1, y1, x2, y2 = geom.bounds(wkb)
    return b"GP\0\x03" + struct.pack("<i4d", crs, x1, x2, y1, y2) + wkb


def layers(path: str) -> list[str]:
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        return [r[0] for r in db.execute("SELECT table_name FROM gpkg_contents WHERE data_type = 'features' ORDER BY rowid")]


class _Layer:
    def __init__(self, options: dict):
        self.path = options["path"].removeprefix("file://")
        if not os.path.exists(self.path):
            raise FileNotFoundError(self.path)
        self.name = options.get("layer") or layers(self.path)[0]
        self.bbox = tuple(map(float, options["bbox"].split(","))) if options.get("bbox") else None
        self.parts = int(options.get("partitions", 8))
        with self.open() as db:
            row = db.execute("SELECT column_name, srs_id FROM gpkg_geometry_columns WHERE table_name = ?", (self.name,)).fetchone()
            if row is None:
                raise ValueError(f"no layer {self.name!r} in {self.path}")
            self.geometry, self.crs = row
            self.columns = [(r[1], r[2].upper().split("(")[0]) for r in db.execute(f'PRAGMA table_info("{self.name}")') if r[1] != self.geometry]
            self.tree = db.execute("SELECT name FROM sqlite_master WHERE name = ?", (f"rtree_{self.name}_{self.geometry}",)).fetchone()
            self.range = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.name}"').fetchone()

    def open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class GpkgSource(DataSource):
    """format("gpkg"): options path, layer (default the first), bbox "xmin,ymin,xmax,ymax", partitions."""

    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def schema(self) -> str:
        layer = _Layer(self.options)
        return ", ".join([*(f"`{n}` {_SQL_TYPES.get(k, 'string')}" for n, k in layer.columns), "geom binary, xmin double, ymin double, xmax double, ymax double, crs int"])

    def reader(self, schema) -> DataSourceReader:
        return _GpkgReader(self.options)


class _GpkgReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> Sequence[InputPartition]:
        layer = _Layer(self.options)
        low, high = layer.range
        if low is None:
            return [_Range(0, -1)]
        step = max(1, -(-(high - low + 1) // layer.parts))
        return [_Range(a, min(a + step - 1, high)) for a in range(low, high + 1, step)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        layer = _Layer(self.options)
        names = "".join(f't."{n}", ' for n, _ in layer.columns)
        sql, values = f'SELECT {names}t."{layer.geometry}" FROM "{layer.name}" t WHERE t.rowid BETWEEN ? AND ?', [partition.low, partition.high]
        if layer.bbox and layer.tree:
            x1, y1, x2, y2 = layer.bbox
            sql += f' AND t.rowid IN (SELECT id FROM "{layer.tree[0]}" WHERE minx <= ? AND maxx >= ? AND miny <= ? AND maxy >= ?)'
            values += [x2, x1, y2, y1]
        with layer.open() as db:
            for row in db.execute(sql, values):
                wkb = wkb_of(row[-1])
                box = geom.bounds(wkb) if wkb else None
                if layer.bbox and (not box or box[0] > layer.bbox[2] or box[2] < layer.bbox[0] or box[1] > layer.bbox[3] or box[3] < layer.bbox[1]):
                    continue
                own = [bool(v) if k == "BOOLEAN" and v is not None else v if _SQL_TYPES.get(k) or v is None else str(v) for v, (_, k) in zip(row, layer.columns, strict=False)]
                yield (*own, wkb, *(box or (None,) * 4), layer.crs)


def read_gpkg(spark: SparkSession, path: str, layer: str | None = None, bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    """A layer of a GeoPackage; the file must be where executors can open it. FileNotFoundError where it is not."""
    if not Path(path).exists():
        raise FileNotFoundError(path)
    spark.dataSource.register(GpkgSource)
    reader = spark.read.format("gpkg").option("path", str(path))
    if layer:
        reader = reader.option("layer", layer)
    if bbox:
        reader = reader.option("bbox", ",".join(map(str, bbox)))
    return reader.load()


def write_gpkg(df: DataFrame, path: str | Path, layer: str, crs: int = 28992, geom_col: str = "geom") -> Path:
    """One layer of rows, a partition at a time through the driver; the file is there as a whole or not at all."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    columns = [c for c in df.columns if c not in (geom_col, "xmin", "ymin", "xmax", "ymax", "crs")]
    kinds = {f.name: {"bigint": "INTEGER", "int": "INTEGER", "smallint": "INTEGER", "double": "REAL", "float": "REAL", "boolean": "BOOLEAN", "binary": "BLOB"}.get(f.dataType.simpleString(), "TEXT") for f in df.schema}
    handle, own = tempfile.mkstemp(dir=path.parent, suffix=".part")
    os.close(handle)
    db = sqlite3.connect(own)
    db.executescript("""
        PRAGMA application_id = 1196444487;
        CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER PRIMARY KEY, organization TEXT, organization_coordsys_id INTEGER, definition TEXT, description TEXT);
        CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT, description TEXT, last_change TEXT, min_x REAL, min_y REAL, max_x REAL, max_y REAL, srs_id INTEGER);
        CREATE TABLE gpkg_geometry_columns (table_name TEXT PRIMARY KEY, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z INTEGER, m INTEGER);
    """)
    fields = "".join(f', "{c}" {kinds[c]}' for c in columns if c != "fid")
    columns = [c for c in columns if c != "fid"]
    db.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY, geom BLOB{fields})')
    db.execute(f'CREATE VIRTUAL TABLE "rtree_{layer}_geom" USING rtree(id, minx, maxx, miny, maxy)')
    total = None
    for n, row in enumerate(df.toLocalIterator(), 1):
        wkb = row[geom_col]
        db.execute(f'INSERT INTO "{layer}" VALUES (?, ?{", ?" * len(columns)})', (n, blob_of(bytes(wkb), crs) if wkb else None, *(row[c] for c in columns)))
        if wkb:
            b = geom.bounds(bytes(wkb))
            db.execute(f'INSERT INTO "rtree_{layer}_geom" VALUES (?, ?, ?, ?, ?)', (n, b[0], b[2], b[1], b[3]))
            total = b if total is None else (min(total[0], b[0]), min(total[1], b[1]), max(total[2], b[2]), max(total[3], b[3]))
    db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', NULL)", (f"EPSG:{crs}", crs, crs))
    db.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, '', NULL, ?, ?, ?, ?, ?)", (layer, layer, *(total or (None,) * 4), crs))
    db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'GEOMETRY', ?, 0, 0)", (layer, crs))
    db.commit()
    db.close()
    os.replace(own, path)
    return path
