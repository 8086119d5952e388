import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataloom.functions import geom, grid, scale


def test_metres_to_cm(spark):
    values = [0.29, -0.299, 1.005, 327.67, 400.0, -400.0, None, float("nan"), 12.345]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(scale.metres_to_cm(F.col("v"))).collect()
    expected = [29, -29, None, 32767, None, None, None, None, 1234]
    expected[2] = int(np.float32(1.005) * np.float32(100))
    assert [r[0] for r in rows] == expected


def test_sentinels(spark):
    df = spark.createDataFrame([(-9999.0,), (1.5,), (None,)], "v double")
    assert [r[0] for r in df.select(scale.to_null(F.col("v"), -9999.0)).collect()] == [None, 1.5, None]
    assert [r[0] for r in df.select(scale.to_sentinel(F.col("v"), -9999.0)).collect()] == [-9999.0, 1.5, -9999.0]


def test_offset(spark):
    df = spark.createDataFrame([(100,), (-100,), (None,)], "v int")
    assert [tuple(r) for r in df.select(scale.burned(F.col("v"), 0.01), scale.burned(F.col("v"), 1.0)).collect()] == [(105, 100), (-95, -99), (None, None)]


def test_north_up_grid(spark):
    t = grid.Affine.from_origin(0, 6, 1, 1)
    assert t.bounds(6, 6) == (0, 0, 6, 6)
    r, c = grid.cell_of(t, F.lit(0.5), F.lit(5.5))
    x, y = grid.centre(t, F.lit(0), F.lit(2))
    assert tuple(spark.range(1).select(r, c, x, y).first()) == (0, 0, 2.5, 5.5)


def test_window_outside_raises(spark):
    t = grid.Affine.from_origin(0, 4, 1, 1)
    w = grid.require_window(grid.clip_window(grid.window_of(t, *map(F.lit, (99.0, 99.0, 111.0, 111.0))), 4, 4))
    with pytest.raises(Exception, match="outside the raster"):
        spark.range(1).select(w["width"]).collect()


def test_slice_rounds_half_to_even(spark):
    w = grid.slice_of({"a": F.lit(0.5), "b": F.lit(1.5), "c": F.lit(2.5)})
    assert tuple(spark.range(1).select(*w.values()).first()) == (0, 2, 2)


SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0), (1.0, 1.0)]


def test_wkb_round_trip():
    p = geom.polygon([SQUARE, HOLE])
    m = geom.collect(geom.MULTI_POLYGON, [p, geom.box(6, 6, 7, 7)])
    assert geom.decode(p) == (3, [SQUARE, HOLE])
    assert geom.bounds(m) == (0, 0, 7, 7)
    assert geom.wkt(geom.box(0, 0, 1, 2)) == "POLYGON ((0 0, 1 0, 1 2, 0 2, 0 0))"
    assert geom.wkt(geom.point(1.5, 2)) == "POINT (1.5 2)"
    assert geom.wkt(geom.as_polygon(m)) == "POLYGON ((0 0, 7 0, 7 7, 0 7, 0 0))"
    assert geom.from_geojson({"type": "Polygon", "coordinates": [SQUARE, HOLE]}) == p
    assert geom.from_geojson({"type": "MultiPolygon", "coordinates": [[SQUARE, HOLE], [geom.decode(geom.box(6, 6, 7, 7))[1][0]]]}) == m


def test_polygon_predicates(spark):
    shapes = spark.createDataFrame([(geom.collect(geom.MULTI_POLYGON, [geom.polygon([SQUARE, HOLE]), geom.box(6, 6, 7, 7)]),), (None,)], "geom binary")
    e = geom.with_edges(shapes).where("geom is not null")
    at = lambda x, y: e.select(geom.inside(F.col("edges"), F.lit(x), F.lit(y)), geom.distance(F.col("edges"), F.lit(x), F.lit(y))).first()
    assert tuple(at(0.5, 0.5)) == (True, 0.0)
    assert tuple(at(2.0, 2.0)) == (False, 1.0)  # in the hole
    assert tuple(at(6.5, 6.5)) == (True, 0.0)
    assert tuple(at(5.0, 2.0)) == (False, 1.0)
    meets = lambda w: e.select(geom.intersects(F.col("edges"), geom.edge_literal(w))).first()[0]
    assert meets(geom.box(3.5, 3.5, 5, 5)) and meets(geom.box(4, 1, 5, 2)) and meets(geom.box(-1, -1, 9, 9))
    assert not meets(geom.box(1.5, 1.5, 2.5, 2.5)) and not meets(geom.box(4.5, 4.5, 5.5, 5.5))
    assert e.select(geom.geometry_kind(F.col("geom"))).first()[0] == "MultiPolygon"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=3, max_size=7, unique=True))
def test_inside_agrees_with_a_winding_sum(spark, corners):
    """Points off all edges: crossing parity against angles summed around the point."""
    ring = [(float(x), float(y)) for x, y in corners]
    ring.append(ring[0])
    points = [(x + 0.317, y + 0.713) for x in range(0, 12, 3) for y in range(0, 12, 3)]
    df = spark.createDataFrame(points, "x double, y double")
    got = [r[0] for r in df.select(geom.inside(geom.edge_literal(geom.polygon([ring])), F.col("x"), F.col("y"))).collect()]
    for (x, y), found in zip(points, got, strict=True):
        a = np.unwrap([np.arctan2(q - y, p - x) for p, q in ring])
        assert found == (round((a[-1] - a[0]) / (2 * np.pi)) % 2 == 1)
