"""GML features: attributes as a map of text, the first geometry as WKB."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from strataloom.functions import geom

_MEMBERS = frozenset(["featureMember", "featureMembers", "member", "cityObjectMember"])
_GEOMETRIES = frozenset("Point LineString Curve Polygon Surface MultiPoint MultiCurve MultiLineString MultiSurface MultiPolygon CompositeSurface PolyhedralSurface".split())


def _name(element: ET.Element) -> str:
    return element.tag.rpartition("}")[2]


def _numbers(element: ET.Element, width: int) -> list[tuple[float, float]]:
    """Points of an element's pos, posList and coordinates, in order; arcs are taken as lines between their points."""
    out: list[tuple[float, float]] = []
    for e in element.iter():
        kind = _name(e)
        if kind in ("pos", "posList"):
            width = int(e.get("srsDimension") or width)
            flat = [float(v) for v in (e.text or "").split()]
            if kind == "pos":
                width = len(flat)
            found = [(flat[i], flat[i + 1]) for i in range(0, len(flat) - 1, width)]
        elif kind == "coordinates":
            found = [tuple(map(float, p.split(",")[:2])) for p in (e.text or "").split()]
        else:
            continue
        out += [p for i, p in enumerate(found) if i or not out or p != out[-1]]
    return out


def _wkb(element: ET.Element, width: int = 2) -> bytes:
    kind = _name(element)
    width = int(element.get("srsDimension") or width)
    if kind == "Point":
        return geom.point(*_numbers(element, width)[0])
    if kind in ("LineString", "Curve"):
        return geom.line(_numbers(element, width))
    if kind in ("Polygon", "PolygonPatch"):
        rings = [_numbers(e, width) for e in element.iter() if _name(e) in ("exterior", "interior", "outerBoundaryIs", "innerBoundaryIs")]
        return geom.polygon(rings)
    if kind == "Surface":
        patches = [_wkb(e, width) for e in element.iter() if _name(e) == "PolygonPatch"]
        return patches[0] if len(patches) == 1 else geom.collect(geom.MULTI_POLYGON, patches)
    parts = []
    for e in element:
        for inner in e if _name(e) not in _GEOMETRIES else [e]:
            if _name(inner) in _GEOMETRIES:
                parts.append(_wkb(inner, width))
    flat = [geom._flat(*geom.decode(p)) for p in parts]
    singles = [(k, c) for group in flat for k, c in group]
    to_wkb = {geom.POINT: lambda c: geom.point(*c), geom.LINE: geom.line, geom.POLYGON: geom.polygon}
    multi = {"MultiPoint": geom.MULTI_POINT, "MultiCurve": geom.MULTI_LINE, "MultiLineString": geom.MULTI_LINE}.get(kind, geom.MULTI_POLYGON)
    return geom.collect(multi, [to_wkb[k](c) for k, c in singles])


def features(raw: bytes) -> Iterator[dict]:
    """Features of a document: id, layer (element name), attributes, geom and crs (None where the file names none)."""
    depth_open: list[str] = []
    for event, element in ET.iterparse(io.BytesIO(raw), ("start", "end")):
        if event == "start":
            depth_open.append(_name(element))
            continue
        depth_open.pop()
        if not depth_open or depth_open[-1] not in _MEMBERS:
            continue
        attributes: dict[str, str] = {}
        wkb, crs = None, None

        def walk(e: ET.Element) -> None:
            nonlocal wkb, crs
            for child in e:
                kind = _name(child)
                if kind in _GEOMETRIES:
                    if wkb is None:
                        wkb = _wkb(child)
                        for x in child.iter():
                            if found := re.search(r"(\d+)$", x.get("srsName") or ""):
                                crs = int(found[1])
                                break
                elif len(child) == 0:
                    if (child.text or "").strip():
                        attributes.setdefault(kind, child.text.strip())
                else:
                    walk(child)

        walk(element)
        own = next((v for k, v in element.attrib.items() if k.rpartition("}")[2] == "id"), None)
        yield {"id": own, "layer": _name(element), "attributes": attributes, "geom": wkb, "crs": crs}
        element.clear()


SCHEMA = "member string, id string, layer string, attributes map<string,string>, geom binary, xmin double, ymin double, xmax double, ymax double, crs int"


def scan(members: DataFrame, crs: int = 28992) -> DataFrame:
    """Features of GML documents (member, content); `crs` where a document names none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("member", pa.string()), ("id", pa.string()), ("layer", pa.string()), ("attributes", pa.map_(pa.string(), pa.string())), ("geom", pa.binary()), *((n, pa.float64()) for n in ("xmin", "ymin", "xmax", "ymax")), ("crs", pa.int32())])
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows: list[dict] = []
                for f in features(raw.as_py()):
                    box = (geom.bounds(f["geom"]) if f["geom"] else None) or (None,) * 4
                    rows.append(f | {"member": name, "attributes": list(f["attributes"].items()), "crs": f["crs"] or crs} | dict(zip(("xmin", "ymin", "xmax", "ymax"), box, strict=True)))
                    if len(rows) == 2000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return members.where("content is not null").select("member", "content").mapInArrow(run, SCHEMA)
