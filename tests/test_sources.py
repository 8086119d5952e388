"""Scans and sinks against local files and a local HTTP server."""

import io
import json
import logging
import threading
import zipfile
import zlib
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataloom import api, log
from strataloom.config import DataStore, Settings
from strataloom.functions import geom
from strataloom.functions.grid import Affine
from strataloom.sources import archive, extract_job, fetch, geojson, gml, gpkg, tiff, vrt, wfs


def profile(dtype="int16", height=4, nodata=-9999.0, scale=1.0, west=0.0, north=None):
    return tiff.Profile(dtype, Affine.from_origin(west, height if north is None else north, 1, 1), nodata, scale, 28992)


@pytest.fixture
def server():
    """Answers by path: handler(path, query, body) -> (status, content type, bytes)."""
    routes = {}

    class Handler(BaseHTTPRequestHandler):
        def _answer(self):
            url = urlsplit(self.path)
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0))
            found = routes.get(url.path)
            status, kind, raw = found({k: v[0] for k, v in parse_qs(url.query).items()}, body) if found else (404, "text/plain", b"")
            self.send_response(status)
            self.send_header("Content-Type", kind)
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        do_GET = do_POST = _answer

        def log_message(self, *args):
            pass

    httpd = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}", routes
    httpd.shutdown()


# TIFF


@pytest.mark.parametrize("dtype", ["uint8", "int16", "uint16", "int32", "float32", "float64"])
def test_tiff_round_trip(dtype):
    data = np.random.default_rng(1).integers(0, 200, (300, 270)).astype(dtype)
    p = profile(dtype, 300, 7.0, 0.01)
    raw = tiff.write(data, p, [5, 25])
    back, q = tiff.read(raw)
    assert (back == data).all() and q == p
    small, r = tiff.read(raw, level=1)
    assert small.shape == (60, 54) and r.transform.a == 5.0
    assert len(tiff.directories(raw)[1]) == 3


def strips(data, compression, predictor, order="<", pack=lambda b: b):
    """A striped TIFF written by hand, four rows a strip."""
    import struct

    height, width = data.shape
    kind = data.dtype.newbyteorder(order)
    pieces = []
    for r in range(0, height, 4):
        piece = data[r : r + 4]
        if predictor == 2:
            raw = np.concatenate([piece[:, :1], np.diff(piece, axis=1)], 1).astype(kind).tobytes()
        elif predictor == 3:
            planes = piece.astype(piece.dtype.newbyteorder(">")).view(np.uint8).reshape(len(piece), width, -1).transpose(0, 2, 1).reshape(len(piece), -1)
            raw = np.concatenate([planes[:, :1], np.diff(planes, axis=1)], 1).astype(np.uint8).tobytes()
        else:
            raw = piece.astype(kind).tobytes()
        pieces.append(pack(raw))
    body = bytearray(b"II*\0\0\0\0\0" if order == "<" else b"MM\0*\0\0\0\0")
    offsets = []
    for piece in pieces:
        offsets.append(len(body))
        body += piece
    tags = [(256, 4, [width]), (257, 4, [height]), (258, 3, [data.itemsize * 8]), (259, 3, [compression]), (273, 4, offsets), (277, 3, [1]), (278, 4, [4]), (279, 4, [len(x) for x in pieces]), (317, 3, [predictor]), (339, 3, [{"u": 1, "i": 2, "f": 3}[data.dtype.kind]])]
    entries = b""
    for tag, code, values in tags:
        raw = struct.pack(order + {3: "H", 4: "I"}[code] * len(values), *values)
        if len(raw) > 4:
            place = struct.pack(order + "I", len(body))
            body += raw
            raw = place
        entries += struct.pack(order + "HHI", tag, code, len(values)) + raw.ljust(4, b"\0")
    body += b"\0" * (len(body) % 2)
    struct.pack_into(order + "I", body, 4, len(body))
    return bytes(body) + struct.pack(order + "H", len(tags)) + entries + b"\0\0\0\0"


def lzw(raw):
    """Codes of 9 bits only, with a clear before the table grows."""
    bits, n = [], 0
    for i, b in enumerate(raw):
        if i % 200 == 0:
            bits.append(256)
        bits.append(b)
    bits.append(257)
    total = 0
    for code in bits:
        total = total << 9 | code
        n += 9
    return (total << (-n % 8)).to_bytes((n + 7) // 8, "big")


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("compression,pack", [(1, bytes), (8, zlib.compress), (5, lzw), (32773, lambda b: b"".join(bytes([0, x]) for x in b))])
def test_tiff_strips(order, compression, pack):
    data = np.arange(70, dtype=np.int16).reshape(10, 7) * 37 - 900
    assert (tiff.read(strips(data, compression, 1, order, pack))[0] == data).all()


def test_tiff_predictors():
    data = np.random.default_rng(1).normal(size=(9, 6)).astype(np.float32)
    assert (tiff.read(strips(data, 8, 3, "<", zlib.compress))[0] == data).all()
    whole = np.arange(54, dtype=np.int16).reshape(9, 6) ** 2
    assert (tiff.read(strips(whole, 8, 2, "<", zlib.compress))[0] == whole).all()


def test_scan_and_broken_file(spark, tmp_path):
    data = np.arange(12, dtype=np.int16).reshape(3, 4)
    data[1, 1] = -9999
    (tmp_path / "a.tif").write_bytes(tiff.write(data, profile(height=3)))
    (tmp_path / "b.tif").write_bytes(b"no tiff")
    (tmp_path / "c.txt").write_bytes(b"")
    rows = {r["raster_id"]: r for r in tiff.scan(tiff.files(spark, str(tmp_path))).collect()}
    assert set(rows) == {"a", "b"} and "ValueError" in rows["b"]["error"]
    assert rows["a"]["data"] == [None if v == -9999 else float(v) for v in data.ravel()]
    meta = tiff.metadata(tiff.files(spark, str(tmp_path))).where("error is null").first()
    assert (meta["height"], meta["width"], meta["e"], meta["crs"]) == (3, 4, -1.0, 28992)


# archives, GML


def zipped(**files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, raw in files.items():
            z.writestr(name.replace("__", "."), raw)
    return out.getvalue()


def test_members(spark):
    df = spark.createDataFrame([("x", zipped(a__txt=b"", b__TIF=b"1", c__tif=b"2")), ("y", zipped(a__txt=b"")), ("z", b"broken")], "path string, content binary")
    first = {r["path"]: r for r in archive.members(df, ".tif", only_first=True).collect()}
    assert bytes(first["x"]["content"]) == b"1" and first["y"]["error"] and first["z"]["error"]
    assert archive.members(df.where("path = 'x'"), ".tif").count() == 2
    assert archive.is_zip("application/zip", "u") and archive.is_zip(None, "http://x/a.ZIP") and not archive.is_zip("image/tiff", "a.tif")


GML = """<CityModel xmlns="http://www.opengis.net/citygml/2.0" xmlns:gml="http://www.opengis.net/gml" xmlns:b="http://b">
<cityObjectMember><b:Waterdeel gml:id="w1"><b:naam>Sloot</b:naam><b:geo2d><gml:Polygon srsName="urn:ogc:def:crs:EPSG::28992"><gml:exterior><gml:LinearRing><gml:posList>0 0 4 0 4 4 0 4 0 0</gml:posList></gml:LinearRing></gml:exterior><gml:interior><gml:LinearRing><gml:posList>1 1 2 1 2 2 1 1</gml:posList></gml:LinearRing></gml:interior></gml:Polygon></b:geo2d></b:Waterdeel></cityObjectMember>
<cityObjectMember><b:Pand gml:id="p1"><b:geo2d><gml:MultiSurface><gml:surfaceMember><gml:Polygon><gml:exterior><gml:LinearRing><gml:posList srsDimension="3">0 0 9 1 0 9 1 1 9 0 0 9</gml:posList></gml:LinearRing></gml:exterior></gml:Polygon></gml:surfaceMember></gml:MultiSurface></b:geo2d></b:Pand></cityObjectMember>
<cityObjectMember><b:Pand gml:id="p2"><b:punt><gml:Point><gml:pos>5 6</gml:pos></gml:Point></b:punt></b:Pand></cityObjectMember>
</CityModel>""".encode()


def test_gml(spark):
    df = spark.createDataFrame([("bgt_water.gml", GML)], "member string, content binary")
    rows = {r["id"]: r for r in gml.scan(df).select("*", geom.geometry_kind(F.col("geom")).alias("kind")).collect()}
    assert {k: r["kind"] for k, r in rows.items()} == {"w1": "Polygon", "p1": "MultiPolygon", "p2": "Point"}
    assert rows["w1"]["attributes"] == {"naam": "Sloot"} and rows["w1"]["layer"] == "Waterdeel" and len(geom.decode(bytes(rows["w1"]["geom"]))[1]) == 2
    assert (rows["p1"]["xmax"], rows["p1"]["ymax"], rows["p1"]["crs"]) == (1.0, 1.0, 28992)


# GeoJSON, GeoPackage


def square(x, y):
    return [[[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1], [x, y]]]


def feature(i, x, y):
    return {"type": "Feature", "id": f"pand.{i}", "properties": {"kaartbladNr": f"k{i}", "url": f"u{i}", "n": i}, "geometry": {"type": "Polygon", "coordinates": square(x, y)}}


def test_geojson(spark, tmp_path):
    mixed = {"type": "Feature", "properties": {"kaartbladNr": "p"}, "geometry": {"type": "Point", "coordinates": [7, 8]}}
    (tmp_path / "index.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature(1, 0, 0), feature(2, 3, 4), mixed]}))
    rows = {r["kaartbladNr"]: r for r in geojson.read_geojson(spark, str(tmp_path / "index.json")).collect()}
    assert (rows["k2"]["xmin"], rows["k2"]["ymax"], rows["k2"]["url"], rows["k2"]["crs"]) == (3.0, 5.0, "u2", 28992)
    assert bytes(rows["p"]["geom"]) == geom.point(7, 8)


def test_gpkg_round_trip(spark, tmp_path):
    rows = [(f"b{i}", i, i / 2, geom.box(i, 0, i + 1, 1)) for i in range(30)] + [("none", None, None, None)]
    df = spark.createDataFrame(rows, "id string, n long, v double, geom binary")
    path = gpkg.write_gpkg(df, tmp_path / "x.gpkg", "pand")
    assert gpkg.layers(str(path)) == ["pand"]
    back = gpkg.read_gpkg(spark, str(path), "pand")
    got = {r["id"]: (r["n"], r["v"], None if r["geom"] is None else bytes(r["geom"])) for r in back.collect()}
    assert got == {r[0]: r[1:] for r in rows}
    near = gpkg.read_gpkg(spark, str(path), "pand", (3.5, 0.2, 5.0, 0.8))
    assert {r["id"] for r in near.collect()} == {"b3", "b4", "b5"}
    with pytest.raises(FileNotFoundError):
        gpkg.read_gpkg(spark, str(tmp_path / "no.gpkg"))
    with pytest.raises(Exception, match="no layer"):
        gpkg.read_gpkg(spark, str(path), "other").collect()


# WFS, downloads, jobs


@pytest.mark.parametrize("total,asked", [(0, 1), (999, 1), (1000, 2), (1001, 2), (2500, 3)])
def test_wfs_pages(server, total, asked):
    root, routes = server
    seen = []

    def answer(q, _):
        seen.append(q)
        start = int(q["startIndex"])
        return 200, "application/json", json.dumps({"features": [feature(i, i, 0) for i in range(start, min(total, start + int(q["count"])))]}).encode()

    routes["/wfs/v2_0"] = answer
    got = [f for page in wfs.pages(f"{root}/wfs/v2_0", "bag:pand", (0, 0, 9, 9)) for f in page]
    assert len(got) == total and len(seen) == asked
    assert seen[0]["bbox"] == "0,0,9,9,EPSG:28992" and seen[0]["typeNames"] == "bag:pand"


def test_wfs_cap_keeps_what_came(server, caplog):
    root, routes = server
    routes["/w"] = lambda q, _: (200, "application/json", json.dumps({"features": [feature(i, 0, 0) for i in range(10)]}).encode())
    with caplog.at_level(logging.WARNING):
        assert sum(map(len, wfs.pages(f"{root}/w", "t", None, page=10, cap=25))) == 30
    assert "the rest is left" in caplog.text


def test_bag_features(spark, server, tmp_path):
    root, routes = server
    routes["/w"] = lambda q, _: (200, "application/json", json.dumps({"features": [feature(i, i, 0) for i in range(3)] if q["startIndex"] == "0" else []}).encode())
    rows = api.get_bag_features(spark, (0, 0, 9, 9), url=f"{root}/w").collect()
    assert [r["id"] for r in rows] == ["pand.0", "pand.1", "pand.2"] and rows[0]["properties"]["n"] == "0"
    with pytest.raises(KeyError):
        api.get_bag_features(spark, (0, 0, 9, 9), layer="other")
    with pytest.raises(Exception, match="404"):
        api.get_bag_features(spark, (0, 0, 9, 9), url=f"{root}/gone").collect()
    with pytest.raises(FileNotFoundError):
        api.get_bag_features(spark, (0, 0, 9, 9), source="gpkg", bag_light_gpkg=tmp_path / "no.gpkg")


def test_download(server, tmp_path):
    root, routes = server
    routes["/atom/downloads/bag-light.gpkg"] = lambda *_: (200, "x", b"new")
    path = api.download_bag_light(tmp_path, root=root)
    path.write_bytes(b"old")
    assert api.download_bag_light(tmp_path, overwrite=False, root=root).read_bytes() == b"old"
    assert api.download_bag_light(tmp_path, root=root).read_bytes() == b"new"
    with pytest.raises(Exception, match="404"):
        fetch.download(f"{root}/gone", tmp_path / "gone")
    assert [p.name for p in tmp_path.iterdir()] == ["bag-light.gpkg"]


def test_topography(spark, server, tmp_path):
    root, routes = server
    state = iter([{"status": "RUNNING", "progress": 5}, {"status": "COMPLETED", "_links": {"download": {"href": "/f.zip"}}}])
    bodies = []

    def post(_, body):
        bodies.append(json.loads(body))
        return 200, "application/json", b'{"downloadRequestId": "j1"}'

    routes[extract_job.CUSTOM] = post
    routes[f"{extract_job.CUSTOM}/j1/status"] = lambda *_: (200, "application/json", json.dumps(next(state)).encode())
    routes["/f.zip"] = lambda *_: (200, "application/zip", zipped(bgt_waterdeel__gml=GML, readme__txt=b""))
    folder = api.get_bgt_features(spark, ["waterdeel"], geom.point(1, 2), tmp_path, poll_interval_s=0.01, root=root)
    assert bodies == [{"featuretypes": ["waterdeel"], "format": "citygml", "geofilter": "POLYGON ((1 2, 1 2, 1 2, 1 2, 1 2))"}]
    assert [p.name for p in folder.iterdir()] == ["bgt_waterdeel.gpkg"]
    assert gpkg.read_gpkg(spark, str(folder / "bgt_waterdeel.gpkg")).count() == 3


def test_job_failure_and_deadline(server):
    root, routes = server
    routes[f"{extract_job.CUSTOM}/a/status"] = lambda *_: (200, "application/json", b'{"status": "FAILED"}')
    routes[f"{extract_job.CUSTOM}/b/status"] = lambda *_: (200, "application/json", b'{"status": "RUNNING", "progress": 1}')
    with pytest.raises(RuntimeError):
        extract_job.poll("a", root=root)
    with pytest.raises(TimeoutError):
        extract_job.poll("b", 0.01, 0.05, root=root)


def test_extract_without_gml(spark, tmp_path):
    (tmp_path / "x.zip").write_bytes(zipped(a__txt=b""))
    with pytest.raises(ValueError):
        extract_job.read_extract(spark, tmp_path / "x.zip")


# mosaics and the calls that write rasters


def test_vrt(tmp_path, caplog):
    for n, name in enumerate(("b", "a")):
        (tmp_path / f"{name}.tif").write_bytes(tiff.write(np.full((2, 2), n, np.int16), profile(height=2, west=2.0 * n)))
    out = vrt.create_vrt_file(tmp_path / "v.vrt", tmp_path)
    assert [p.name for p in vrt.list_tif_files_in_vrt_file(out)] == ["a.tif", "b.tif"]
    (tmp_path / "empty").mkdir()
    with caplog.at_level(logging.WARNING):
        assert vrt.create_vrt_file(tmp_path / "empty" / "x.vrt", tmp_path / "empty") == tmp_path / "empty" / "x.vrt"
    assert len(caplog.records) == 1


@pytest.fixture
def store(tmp_path):
    return DataStore(data_dir=tmp_path / "data")


def test_get_rasters(spark, server, tmp_path):
    root, routes = server
    data = np.full((6, 6), 1.239, np.float32)
    data[0, 0] = -9999
    p = profile("float32", 6)
    routes["/a.tif"] = lambda *_: (200, "image/tiff", tiff.write(data, p))
    routes["/b"] = lambda *_: (200, "application/zip", zipped(x__TIF=tiff.write(data, p)))
    routes["/c"] = lambda *_: (200, "application/zip", b"broken")
    index = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"kaartbladNr": k, "url": root + u}, "geometry": {"type": "Polygon", "coordinates": square(i, 0)}} for i, (k, u) in enumerate((("A", "/a.tif"), ("B", "/b"), ("C", "/c"), ("D", "/gone")))]}
    (tmp_path / "i.json").write_text(json.dumps(index))
    out = api.get_ahn_rasters(spark, tmp_path / "ahn", index_file=str(tmp_path / "i.json"), save_tiles_index=True)
    folder = out.parent
    assert out.name == "AHN4_DTM_05m.vrt" and sorted(f.name for f in folder.glob("*.tif")) == ["A.tif", "B.tif"] and (folder / "AHN4_DTM_05m.gpkg").exists()
    back, q = tiff.read((folder / "B.tif").read_bytes())
    assert back[0, 0] == -32768 and back[1, 1] == 123 and q.scale == 0.01 and q.dtype == "int16"
    (folder / "A.tif").write_bytes(b"kept")
    api.get_ahn_rasters(spark, tmp_path / "ahn", select_indices=["A"], create_vrt=False, index_file=str(tmp_path / "i.json"))
    assert (folder / "A.tif").read_bytes() == b"kept"
    api.get_ahn_rasters(spark, tmp_path / "ahn", poly_mask=geom.box(0.2, 0.2, 0.4, 0.4), missing_only=False, create_vrt=False, index_file=str(tmp_path / "i.json"), settings=Settings(m_to_cm=False))
    assert tiff.read((folder / "A.tif").read_bytes())[1].dtype == "float32"
    with pytest.raises(KeyError):
        api.get_ahn_rasters(spark, tmp_path / "ahn", select_indices=["X"], index_file=str(tmp_path / "i.json"))
    with pytest.raises(ValueError):
        api.get_ahn_rasters(spark, cell_size="5")


def test_fill_tiles_across_their_edge(spark, tmp_path, store):
    left, right = np.full((4, 4), 7, np.int16), np.full((4, 4), 7, np.int16)
    left[1, 3] = right[1, 0] = -9999
    for name, data, west in (("A", left, 0.0), ("B", right, 4.0)):
        (tmp_path / f"{name}.tif").write_bytes(tiff.write(data, profile(scale=0.5, west=west)))
    mosaic = vrt.create_vrt_file(tmp_path / "m.vrt", tmp_path)
    out = api.interpolate_ahn_tiles(spark, mosaic, max_search_distance=3, datastore=store)
    back, p = tiff.read((out.parent / "A.tif").read_bytes())
    assert out.name == "ahn_filled.vrt" and (back == 7).all() and p.scale == 0.5 and p.transform.f == 4.0
    (out.parent / "B.tif").unlink()
    (out.parent / "A.tif").write_bytes(b"kept")
    folder = api.interpolate_ahn_tiles(spark, mosaic, ["A", "B", "no such"], 3, create_vrt=False, missing_only=True, datastore=store)
    assert (folder / "A.tif").read_bytes() == b"kept" and (tiff.read((folder / "B.tif").read_bytes())[0] == 7).all()


@pytest.mark.parametrize("scale,expected", [(0.01, 105), (1.0, 100)])
def test_rasterize_buildings(spark, tmp_path, scale, expected):
    dem = tmp_path / "dem.tif"
    dem.write_bytes(tiff.write(np.full((5, 5), 100, np.int16), profile(height=5, scale=scale)))
    shapes = spark.createDataFrame([(geom.box(1, 1, 4, 4),), (geom.box(500, 500, 501, 501),)], "geom binary")
    levels = api.rasterize_bag(spark, dem, shapes, tmp_path / "out" / "bag_pand.tif", buffer_step_m=0.1)
    back, p = tiff.read((tmp_path / "out" / "bag_pand.tif").read_bytes())
    assert back.max() == expected and (back == -9999).sum() == 16 and p.scale == scale
    assert sorted((r["vloerpeil"] for r in levels.collect()), key=str) == [100, None]


def test_m_to_cm_array():
    data = np.array([0.29, -0.299, -9999, 400, np.nan], np.float32)
    got, nodata = api.array_float_m_to_cm_int(data, -9999)
    assert got.tolist() == [29, -29, -32768, -32768, -32768] and nodata == -32768 and got.dtype == np.int16


# configuration and logging


def test_store_and_settings(tmp_path, monkeypatch):
    env = tmp_path / ".datastore"
    env.write_text(f"DATA_DIR={tmp_path}/a\nprocessed_data_dir={tmp_path}/p\n# x=y\n")
    s = DataStore(env_file=str(env))
    assert not (tmp_path / "a").exists()  # nothing is made before it is asked for
    assert s.bag_dir == tmp_path / "a" / "source_data" / "bag" and s.bag_dir.is_dir() and s.processed == tmp_path / "p"
    monkeypatch.setenv("M_TO_CM", "false")
    assert Settings().m_to_cm is False and Settings(m_to_cm=True).m_to_cm is True


def test_logger(tmp_path):
    before = list(logging.getLogger().handlers)
    log.init_logger("x", tmp_path / "a" / "1.log")
    log.init_logger("x", tmp_path / "a" / "1.log", debug=True).debug("first")
    log.init_logger("x", tmp_path / "2.log").info("second")
    own = [h for h in logging.getLogger().handlers if h not in before]
    assert len(own) == 2 and "first" in (tmp_path / "a" / "1.log").read_text() and "second" in (tmp_path / "2.log").read_text()
    for h in own:
        logging.getLogger().removeHandler(h)
        h.close()
