import numpy as np
import pytest
from pyspark.sql import functions as F

from strataloom.functions import geom
from strataloom.functions.grid import Affine
from strataloom.operators import burn, fill, raster, tiles, zonal


def cells(spark, data):
    rows = [(r, c, None if np.isnan(v) else float(v)) for (r, c), v in np.ndenumerate(np.asarray(data, float))]
    return spark.createDataFrame(rows, "r int, c int, h double")


def grid_of(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["r"], r["c"]] = np.nan if r["h"] is None else r["h"]
    return out


def brute_fill(data, search):
    out = data.copy()
    for r, c in np.argwhere(np.isnan(data)):
        top = bottom = 0.0
        for up in (True, False):
            for left in (True, False):
                found = [
                    (dr * dr + dc * dc, dr, dc, data[r + dr, c + dc])
                    for dr in (range(-search, 1) if up else range(search + 1)) for dc in (range(-search, 1) if left else range(search + 1))
                    if dr * dr + dc * dc <= search * search and 0 <= r + dr < data.shape[0] and 0 <= c + dc < data.shape[1] and not np.isnan(data[r + dr, c + dc])
                ]
                if found:
                    d2, _, _, v = min(found)
                    top, bottom = top + v / np.sqrt(d2), bottom + 1 / np.sqrt(d2)
        if bottom:
            out[r, c] = top / bottom
    return out


def test_one_hole_of_a_constant(spark):
    data = np.full((6, 6), 10.0)
    data[2, 2] = np.nan
    got = grid_of(fill.void_fill(cells(spark, data), 2), (6, 6))
    assert np.allclose(got, 10)


@pytest.mark.parametrize("search", [1, 3])
def test_fill_against_brute_force(spark, search):
    rng = np.random.default_rng(search)
    data = rng.normal(size=(12, 9)).round(2)
    data[rng.random(data.shape) < 0.5] = np.nan
    data[4:9, 3:8] = np.nan  # a hole beyond the search
    got = grid_of(fill.void_fill(cells(spark, data), search), data.shape)
    assert np.allclose(got, brute_fill(data, search), equal_nan=True)


def test_fill_crosses_tile_edges(spark):
    data = np.full((4, 8), np.nan)
    data[:, 0], data[:, 7] = 1.0, 3.0
    whole = grid_of(fill.void_fill(cells(spark, data), 7), data.shape)
    part = grid_of(fill.void_fill(cells(spark, data), 7, F.col("c") >= 4), data.shape)
    assert np.allclose(part[:, 4:], whole[:, 4:]) and np.isnan(part[:, :4]).all()


def test_all_nodata_stays(spark):
    assert np.isnan(grid_of(fill.void_fill(cells(spark, np.full((3, 3), np.nan)), 2), (3, 3))).all()


def test_stored_rounds_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (1.4,), (None,)], "h double")
    assert [r[0] for r in df.select(fill.stored(F.col("h"))).collect()] == [3, -3, 1, None]


def boxes(spark, rows):
    return spark.createDataFrame(rows, "id int, seq int, xmin double, ymin double, xmax double, ymax double")


def test_percentile_of_a_box_and_of_its_edges(spark):
    data = np.arange(36).reshape(6, 6)
    shape = boxes(spark, [(1, 1, 1.0, 1.0, 4.0, 4.0), (2, 2, 50.0, 50.0, 60.0, 60.0)])
    expected = int(np.percentile(data[1:4, 1:4], 75))
    assert [tuple(r) for r in zonal.zonal_percentile(shape, cells(spark, data)).collect()] == [(1, expected)]
    edged = shape.withColumn("edges", tiles.box_edges())
    assert [tuple(r) for r in zonal.zonal_percentile(edged, cells(spark, data)).collect()] == [(1, expected)]


def test_search_takes_the_first_round_that_finds_and_cells_inside_count(spark):
    data = np.full((40, 40), np.nan)
    data[20, 20], data[20, 26] = 5, 9
    shape = boxes(spark, [(1, 1, 20.0, 20.0, 21.0, 21.0), (2, 2, 10.0, 20.0, 12.0, 21.0), (3, 3, 0.0, 0.0, 1.0, 1.0)])
    got = {r["id"]: (r["rounds"], r["level"]) for r in zonal.level_search(shape, cells(spark, data)).collect()}
    assert got == {1: (1, 5), 2: (9, 5)}  # 3 has none within 20


def test_two_phases_equal_one(spark):
    rng = np.random.default_rng(3)
    data = rng.integers(0, 99, (30, 30)).astype(float)
    data[rng.random(data.shape) < 0.93] = np.nan
    shape = boxes(spark, [(i, i, x := float(rng.uniform(0, 28)), y := float(rng.uniform(0, 28)), x + 1.3, y + 0.9) for i in range(20)])
    two = sorted(map(tuple, zonal.level_search(shape, cells(spark, data)).collect()))
    one = sorted(map(tuple, zonal._search(shape, cells(spark, data).where("h is not null"), 1, 75, 20, zonal.GRID, True).collect()))
    assert two == one


def test_later_polygon_wins_and_null_burns_nothing(spark):
    shape = boxes(spark, [(1, 1, 0.0, 0.0, 3.0, 3.0), (2, 2, 2.0, 0.0, 4.0, 1.0), (3, 3, 0.0, 0.0, 4.0, 4.0)]).withColumn("value", F.when(F.col("id") < 3, F.col("id") * 10))
    got = grid_of(burn.onto_grid(burn.burn(shape, cells(spark, np.zeros((4, 4)))), cells(spark, np.zeros((4, 4)))), (4, 4))
    assert got[0, 2] == 20 and got[1, 1] == 10 and np.isnan(got[3, 3])


@pytest.mark.parametrize("scale,expected", [(0.01, 105), (1.0, 100)])
def test_floor_levels(spark, scale, expected):
    t = Affine.from_origin(0, 5, 1, 1)
    got = burn.burn_floor_levels(boxes(spark, [(1, 1, 1.0, 1.0, 4.0, 4.0)]), cells(spark, np.full((5, 5), 100)), 0.1, scale=scale, transform=t)
    assert {r["h"] for r in got.collect()} == {expected} and got.count() == 9


def test_mosaic_lets_nodata_through(spark):
    low, high = cells(spark, [[1, 2, np.nan]]), cells(spark, [[7, np.nan, np.nan]])
    got = grid_of(raster.mosaic([low, high]), (1, 3))
    assert got[0, 0] == 7 and got[0, 1] == 2 and np.isnan(got[0, 2])
    with pytest.raises(ValueError):
        raster.mosaic([])


def test_overviews(spark):
    assert raster.overview_factors(0.5) == [10, 50] and raster.overview_factors(5) == [5] and raster.overview_factors(1) == [5, 25]
    got = grid_of(raster.overview(cells(spark, [[1, 3, np.nan], [np.nan, 5, np.nan]]), 2), (1, 2))
    assert got[0, 0] == 3 and np.isnan(got[0, 1])


def test_blocks_round_trip(spark):
    data = np.random.default_rng(1).normal(size=(10, 7))
    data[3, 3] = np.nan
    back = raster.to_cells(raster.to_blocks(cells(spark, data), 4, 10, 7), 4)
    assert np.allclose(grid_of(back, data.shape), data, equal_nan=True)


def index(spark):
    return spark.createDataFrame([(f"t{i}", 20.0 * i, 0.0, 20.0 * i + 20, 20.0) for i in range(4)], "kaart_index string, xmin double, ymin double, xmax double, ymax double")


def test_selection(spark):
    assert [r["kaart_index"] for r in tiles.select_strict(index(spark), ["t2", "t0", "t2"]).collect()] == ["t2", "t0", "t2"]
    with pytest.raises(KeyError, match="t9"):
        tiles.select_strict(index(spark), ["t1", "t9"])
    assert tiles.select_strict(index(spark), []).count() == 0
    assert tiles.select_lenient(index(spark), ["t1", "t9"]).count() == 1
    assert tiles.missing(index(spark), index(spark).where("kaart_index = 't1'")).count() == 3
    assert tiles.mask(index(spark), geom.box(20, 5, 21, 6)).count() == 2  # touching counts
    assert tiles.mask(index(spark), None).count() == 4


def test_neighbours_hold_the_tile_itself(spark):
    got = {tuple(r) for r in tiles.neighbours(index(spark), 1.0, 20.0).collect()}
    assert got == {(f"t{i}", f"t{j}") for i in range(4) for j in range(4) if abs(i - j) <= 1}


def test_service_rules():
    s = tiles.AHNService()
    assert s.get_tiles_url(ahn_version=5).endswith("bladwijzer.gpkg") and s.get_tiles_url(ahn_version=6).endswith("AHN6.gpkg")
    assert tiles.AHNService("ahn_pdok").get_tiles_url().endswith("dtm_05m/kaartbladindex.json")
    assert s.download_url_field("dtm", "05", 4) == "AHN4_05M_M" and s.download_url_field("dsm", "5", 3) == "AHN3_5M_R" and s.download_url_field("dsm", "5", 6) == "dsm_5"
    for service, args in (("ahn_pdok", ("dtm", "5", 4)), ("ahn_pdok", ("dtm", "05", 5)), ("ahn_datastroom", ("dtm", "05", 2)), ("ahn_datastroom", ("dtm", "1", 4)), ("ahn_datastroom", ("dem", "05", 4))):
        with pytest.raises(ValueError):
            tiles.AHNService(service).get_tiles_url(*args)
    with pytest.raises(ValueError):
        tiles.AHNService("other")
