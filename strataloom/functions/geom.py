"""Geometry: a WKB codec, and predicates over edge lists as Column expressions.

A polygon or multipolygon is an array of edges (x1, y1, x2, y2) over all its rings. The
even-odd rule over all edges makes holes and parts right without naming rings; the test
is half open in y, so that an edge between two polygons gives a point to one of them.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.schema import EDGES

Ring = Sequence[tuple[float, float]]
POINT, LINE, POLYGON, MULTI_POINT, MULTI_LINE, MULTI_POLYGON, COLLECTION = range(1, 8)
NAMES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}


def box(xmin: float, ymin: float, xmax: float, ymax: float) -> bytes:
    return polygon([[(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin)]])


def point(x: float, y: float) -> bytes:
    return struct.pack("<BIdd", 1, POINT, x, y)


def _ring(ring: Ring) -> bytes:
    return struct.pack("<I", len(ring)) + b"".join(struct.pack("<dd", x, y) for x, y in ring)


def line(points: Ring) -> bytes:
    return struct.pack("<BI", 1, LINE) + _ring(points)


def polygon(rings: Sequence[Ring]) -> bytes:
    return struct.pack("<BII", 1, POLYGON, len(rings)) + b"".join(map(_ring, rings))


def collect(kind: int, parts: Sequence[bytes]) -> bytes:
    """A multi-geometry of single ones."""
    return struct.pack("<BII", 1, kind, len(parts)) + b"".join(parts)


def decode(wkb: bytes) -> tuple[int, list]:
    """Kind and content: a point, a list of points, a list of rings, or a list of (kind, content). Z and M are dropped."""
    kind, content, _ = _decode(wkb, 0)
    return kind, content


def _decode(raw: bytes, at: int) -> tuple[int, list, int]:
    order = "<" if raw[at] else ">"
    (code,) = struct.unpack_from(order + "I", raw, at + 1)
    at += 5
    extra = bool(code & 0x80000000) + bool(code & 0x40000000)
    if code & 0x20000000:
        at += 4
    code &= 0x1FFFFFFF
    extra = extra or {0: 0, 1: 1, 2: 1, 3: 2}[code // 1000]
    kind, width = code % 1000, 2 + extra

    def points(at: int) -> tuple[list, int]:
        (n,) = struct.unpack_from(order + "I", raw, at)
        flat = struct.unpack_from(f"{order}{n * width}d", raw, at + 4)
        return [(flat[i], flat[i + 1]) for i in range(0, n * width, width)], at + 4 + 8 * n * width

    if kind == POINT:
        return kind, list(struct.unpack_from(order + "dd", raw, at)), at + 8 * width
    if kind == LINE:
        content, at = points(at)
        return kind, content, at
    (n,) = struct.unpack_from(order + "I", raw, at)
    at += 4
    content = []
    for _ in range(n):
        if kind == POLYGON:
            ring, at = points(at)
            content.append(ring)
        else:
            part, inner, at = _decode(raw, at)
            content.append((part, inner))
    return kind, content, at


def _flat(kind: int, content: list) -> Iterator[tuple[int, list]]:
    if kind > POLYGON:
        for k, c in content:
            yield from _flat(k, c)
    else:
        yield kind, content


def vertices(wkb: bytes) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for kind, content in _flat(*decode(wkb)):
        out += [tuple(content)] if kind == POINT else content if kind == LINE else [p for ring in content for p in ring]
    return out


def bounds(wkb: bytes) -> tuple[float, float, float, float] | None:
    found = vertices(wkb)
    if not found:
        return None
    xs, ys = zip(*found, strict=True)
    return min(xs), min(ys), max(xs), max(ys)


def edges(wkb: bytes) -> list[tuple[float, float, float, float]]:
    """Edges of all rings and lines; a point is one edge of no length."""
    out = []
    for kind, content in _flat(*decode(wkb)):
        if kind == POINT:
            out.append((*content, *content))
        for part in [content] if kind == LINE else content if kind == POLYGON else []:
            ring = part if kind == LINE or part[0] == part[-1] else [*part, part[0]]
            out += [(*p, *q) for p, q in zip(ring, ring[1:], strict=False)]
    return out


def wkt(wkb: bytes) -> str:
    number = lambda v: repr(int(v)) if v == int(v) else repr(v)
    pair = lambda p: f"{number(p[0])} {number(p[1])}"
    row = lambda ps: "(" + ", ".join(map(pair, ps)) + ")"

    def body(kind: int, content: list) -> str:
        if kind == POINT:
            return f"({pair(content)})"
        if kind == LINE:
            return row(content)
        if kind == POLYGON:
            return "(" + ", ".join(map(row, content)) + ")"
        if kind == COLLECTION:
            return "(" + ", ".join(f"{NAMES[k].upper()} {body(k, c)}" for k, c in content) + ")"
        return "(" + ", ".join(body(k, c) for k, c in content) + ")"

    kind, content = decode(wkb)
    return f"{NAMES[kind].upper()} {body(kind, content)}"


def as_polygon(wkb: bytes) -> bytes:
    """A polygon as it is; any other geometry as its bounding box."""
    return wkb if decode(wkb)[0] == POLYGON else box(*bounds(wkb))


def from_geojson(geometry: dict) -> bytes:
    """WKB of a GeoJSON geometry."""
    kind = geometry["type"]
    flat = lambda ps: [(float(p[0]), float(p[1])) for p in ps]
    if kind == "GeometryCollection":
        return collect(COLLECTION, [from_geojson(g) for g in geometry["geometries"]])
    at = geometry["coordinates"]
    single = {"Point": lambda c: point(float(c[0]), float(c[1])), "LineString": lambda c: line(flat(c)), "Polygon": lambda c: polygon([flat(r) for r in c])}
    if kind in single:
        return single[kind](at)
    return collect({"MultiPoint": MULTI_POINT, "MultiLineString": MULTI_LINE, "MultiPolygon": MULTI_POLYGON}[kind], [single[kind[5:]](c) for c in at])


def with_edges(df: DataFrame, geom_col: str = "geom") -> DataFrame:
    """`df` with edges, xmin, ymin, xmax and ymax of a WKB column; null where it is null or empty."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in ("edges", "xmin", "ymin", "xmax", "ymax")), f"edges {EDGES}, xmin double, ymin double, xmax double, ymax double"])
    kept = [f.name for f in df.schema if f.name not in ("edges", "xmin", "ymin", "xmax", "ymax")]
    df = df.select(*kept)
    at = kept.index(geom_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(n, pa.float64()) for n in ("x1", "y1", "x2", "y2")]))
        for batch in batches:
            raw = batch.column(at).to_pylist()
            lists = [None if g is None else [dict(zip(("x1", "y1", "x2", "y2"), e, strict=True)) for e in edges(g)] for g in raw]
            boxes = [(None,) * 4 if g is None else bounds(g) or (None,) * 4 for g in raw]
            cols = [pa.array([b[i] for b in boxes], pa.float64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, kind), *cols], [*kept, "edges", "xmin", "ymin", "xmax", "ymax"])

    return df.mapInArrow(run, schema)


def edge_literal(wkb: bytes) -> Column:
    return F.array(*[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), e, strict=True)]) for e in edges(wkb)])


def geometry_kind(geom: Column) -> Column:
    """Name of a little-endian WKB geometry's kind, read from its second byte."""
    code = F.conv(F.hex(F.substring(geom, 2, 1)), 16, 10).cast("int")
    return F.element_at(F.create_map(*[F.lit(x) for k, v in NAMES.items() for x in (k, v)]), code)


def box_distance(x: Column, y: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Distance of a point from a box, zero inside."""
    dx = F.greatest(xmin - x, F.lit(0.0), x - xmax)
    dy = F.greatest(ymin - y, F.lit(0.0), y - ymax)
    return F.sqrt(dx * dx + dy * dy)


def inside(edge_list: Column, x: Column, y: Column) -> Column:
    """Even-odd rule over all edges, half open in y."""

    def crosses(e: Column) -> Column:
        meets = (e["y1"] > y) != (e["y2"] > y)
        at = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])
        return F.when(meets, x < at).otherwise(F.lit(False))

    return F.size(F.filter(edge_list, crosses)) % 2 == 1


def edge_distance(edge_list: Column, x: Column, y: Column) -> Column:
    """Distance of a point from the nearest edge."""

    def one(e: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        long = dx * dx + dy * dy
        t = F.when(long > 0, F.least(F.greatest(((x - e["x1"]) * dx + (y - e["y1"]) * dy) / F.nullif(long, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0))
        px, py = x - (e["x1"] + t * dx), y - (e["y1"] + t * dy)
        return F.sqrt(px * px + py * py)

    return F.array_min(F.transform(edge_list, one))


def distance(edge_list: Column, x: Column, y: Column) -> Column:
    """Distance of a point from a polygon, zero inside."""
    return F.when(inside(edge_list, x, y), F.lit(0.0)).otherwise(edge_distance(edge_list, x, y))


def boxes_meet(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Whether two boxes (xmin, ymin, xmax, ymax) share a point; touching counts."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def intersects(a: Column, b: Column) -> Column:
    """Whether two edge lists share a point, or one holds the other; touching counts."""

    def side(px: Column, py: Column, qx: Column, qy: Column, rx: Column, ry: Column) -> Column:
        return F.signum((qx - px) * (ry - py) - (qy - py) * (rx - px))

    def on(px: Column, py: Column, e: Column) -> Column:
        return (F.least(e["x1"], e["x2"]) <= px) & (px <= F.greatest(e["x1"], e["x2"])) & (F.least(e["y1"], e["y2"]) <= py) & (py <= F.greatest(e["y1"], e["y2"]))

    def meet(p: Column, q: Column) -> Column:
        s1, s2 = side(p["x1"], p["y1"], p["x2"], p["y2"], q["x1"], q["y1"]), side(p["x1"], p["y1"], p["x2"], p["y2"], q["x2"], q["y2"])
        s3, s4 = side(q["x1"], q["y1"], q["x2"], q["y2"], p["x1"], p["y1"]), side(q["x1"], q["y1"], q["x2"], q["y2"], p["x2"], p["y2"])
        touch = ((s1 == 0) & on(q["x1"], q["y1"], p)) | ((s2 == 0) & on(q["x2"], q["y2"], p)) | ((s3 == 0) & on(p["x1"], p["y1"], q)) | ((s4 == 0) & on(p["x2"], p["y2"], q))
        return ((s1 * s2 < 0) & (s3 * s4 < 0)) | touch

    crossing = F.exists(a, lambda p: F.exists(b, lambda q: meet(p, q)))
    return crossing | inside(b, a[0]["x1"], a[0]["y1"]) | inside(a, b[0]["x1"], b[0]["y1"])
