"""DuckDB SQL for the queries, written naively on the same derived tables."""

from __future__ import annotations

_VIEWS = """
WITH dem AS (
  SELECT (event_id // 100)::INTEGER AS r, (event_id % 100)::INTEGER AS c,
         CASE WHEN event_type <> 'error' THEN value / 10 - 5 END AS elevation_m FROM events),
dem_cm AS (SELECT r, c, trunc(elevation_m::FLOAT * 100::FLOAT)::SMALLINT AS h FROM dem),
dsm AS (
  SELECT (o_orderkey // 100)::INTEGER AS r, (o_orderkey % 100)::INTEGER AS c,
         CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice / 1000)::INTEGER END AS h FROM orders),
tile AS (
  SELECT s_name AS kaart_index, (20 * (s_suppkey % 5))::DOUBLE AS xmin, (20 * (s_suppkey // 5))::DOUBLE AS ymin,
         (20 * (s_suppkey % 5) + 20)::DOUBLE AS xmax, (20 * (s_suppkey // 5) + 20)::DOUBLE AS ymax FROM supplier),
building AS (
  SELECT c_custkey AS id, c_custkey AS seq, c_mktsegment AS segment,
         (c_custkey * 7 % 95 + 0.25)::DOUBLE AS xmin, (c_custkey * 13 % 97 + 0.25)::DOUBLE AS ymin,
         (c_custkey * 7 % 95 + 1.5 + c_nationkey % 4)::DOUBLE AS xmax, (c_custkey * 13 % 97 + 1.5 + c_custkey % 3)::DOUBLE AS ymax
  FROM customer),
point AS (SELECT p_partkey AS id, (p_partkey * 11 % 100 + 0.5)::DOUBLE AS x, (p_partkey * 3 % 100 + 0.5)::DOUBLE AS y FROM part),
meta AS (
  SELECT kaart_index AS tile_id, CASE WHEN right(kaart_index, 1) IN ('0','2','4','6','8') THEN 0.5 ELSE 1.0 END::DOUBLE AS a, xmin, ymin, xmax, ymax FROM tile),
hole AS (SELECT r, c FROM dem_cm WHERE h IS NULL),
cand AS (
  SELECT hole.r, hole.c, v.h::DOUBLE AS h, v.r - hole.r AS dr, v.c - hole.c AS dc, (v.r - hole.r) ** 2 + (v.c - hole.c) ** 2 AS d2
  FROM hole JOIN dem_cm v ON v.h IS NOT NULL AND v.r BETWEEN hole.r - 5 AND hole.r + 5 AND v.c BETWEEN hole.c - 5 AND hole.c + 5
  WHERE (v.r - hole.r) ** 2 + (v.c - hole.c) ** 2 <= 25),
quad AS (
  SELECT r, c, min_by(h, (d2, dr, dc)) AS h, min(d2) AS d2 FROM (
    SELECT *, 1 AS q FROM cand WHERE dr <= 0 AND dc <= 0 UNION ALL SELECT *, 2 FROM cand WHERE dr <= 0 AND dc >= 0
    UNION ALL SELECT *, 3 FROM cand WHERE dr >= 0 AND dc <= 0 UNION ALL SELECT *, 4 FROM cand WHERE dr >= 0 AND dc >= 0)
  GROUP BY r, c, q),
filled AS (SELECT r, c, sum(h / sqrt(d2)) / sum(1 / sqrt(d2)) AS h FROM quad GROUP BY r, c),
ground AS (SELECT d.r, d.c, coalesce(d.h::DOUBLE, f.h) AS h FROM dem_cm d LEFT JOIN filled f ON d.r = f.r AND d.c = f.c)
"""


def _search(step: float, rounds: int, percentile: float) -> str:
    return f"""
near AS (
  SELECT b.id, v.h, greatest(1, ceil(sqrt(greatest(b.xmin - v.c - 0.5, 0, v.c + 0.5 - b.xmax) ** 2 + greatest(b.ymin - v.r - 0.5, 0, v.r + 0.5 - b.ymax) ** 2) / {step}))::INTEGER AS k,
         sqrt(greatest(b.xmin - v.c - 0.5, 0, v.c + 0.5 - b.xmax) ** 2 + greatest(b.ymin - v.r - 0.5, 0, v.r + 0.5 - b.ymax) ** 2) AS dist
  FROM building b JOIN dem_cm v ON v.h IS NOT NULL AND v.c + 0.5 BETWEEN b.xmin - {step * rounds} AND b.xmax + {step * rounds} AND v.r + 0.5 BETWEEN b.ymin - {step * rounds} AND b.ymax + {step * rounds}),
best AS (SELECT id, min(k) AS k FROM near WHERE dist <= {step * rounds} GROUP BY id),
level AS (
  SELECT n.id, b.k AS rounds, trunc(quantile_cont(n.h::DOUBLE, {percentile}))::INTEGER AS level
  FROM near n JOIN best b ON n.id = b.id AND n.k = b.k WHERE n.dist <= {step * rounds} GROUP BY n.id, b.k)
"""


_INSIDE = "v.c + 0.5 >= b.xmin AND v.c + 0.5 < b.xmax AND v.r + 0.5 >= b.ymin AND v.r + 0.5 < b.ymax"
_BURN = f"""burnt AS (
  SELECT v.r, v.c, max_by((l.level + 5)::INTEGER, b.seq) AS h FROM dem_cm v JOIN building b ON {_INSIDE} JOIN level l ON l.id = b.id GROUP BY v.r, v.c)"""
_ZONAL = f"SELECT b.id, trunc(quantile_cont(v.h::DOUBLE, 0.75))::INTEGER AS level FROM building b JOIN dem_cm v ON v.h IS NOT NULL AND {_INSIDE} GROUP BY b.id"
_ROOT = "https://fsn1.your-objectstorage.com/hwh-ahn/AHN6/"


def _url(folder: str, mark: str) -> str:
    return f"'{_ROOT}{folder}/AHN6_2025_{mark}_' || kaart_index || '.TIF'"


_URLS = ", ".join(f"{_url(folder, mark)} AS {name}" for name, folder, mark in (("dtm_05", "02a_DTM_50cm", "M"), ("dtm_5", "02b_DTM_5m", "M5"), ("dsm_05", "03a_DSM_50cm", "R"), ("dsm_5", "03b_DSM_5m", "R5")))
_TILE = "'tile_' || lpad(t::VARCHAR, 6, '0')"
_TAIL = {
    "scale_m_to_cm": "SELECT r, c, h::INTEGER AS h FROM dem_cm",
    "scale_switch_raw": "SELECT r, c, round(elevation_m, 4) AS h, 1.0::DOUBLE AS scale FROM dem",
    "nodata_filter": "SELECT r, c, h::INTEGER AS h FROM dem_cm WHERE h IS NOT NULL",
    "tile_index_urls": f"SELECT kaart_index AS \"AHN\", 'M_' || kaart_index AS kaart_index, {_URLS} FROM tile",
    "tile_url_field": f"SELECT kaart_index, {_url('03b_DSM_5m', 'R5')} AS url FROM tile",
    # A box meets the triangle x >= 15, y >= 15, x + y <= 85 where the nearest corner does.
    "tile_mask_intersects": "SELECT kaart_index, xmin, ymin FROM tile WHERE xmax >= 15 AND ymax >= 15 AND greatest(xmin, 15) + greatest(ymin, 15) <= 85",
    "tile_select_strict": "SELECT p.position::INTEGER AS position, t.kaart_index, t.xmin FROM (VALUES (0, 3), (1, 1), (2, 3)) p(position, n) JOIN (SELECT *, row_number() OVER (ORDER BY kaart_index) AS n FROM tile) t ON t.n = p.n",
    "tile_select_lenient": "SELECT kaart_index, xmin, ymin FROM tile ORDER BY kaart_index LIMIT 2",
    "tile_missing_only": "SELECT kaart_index, xmin, ymin FROM tile WHERE xmin >= 40",
    "tile_neighbours": "SELECT a.kaart_index, b.kaart_index AS neighbour FROM tile a JOIN tile b ON sqrt(greatest(b.xmin - a.xmax, 0, a.xmin - b.xmax) ** 2 + greatest(b.ymin - a.ymax, 0, a.ymin - b.ymax) ** 2) <= 5",
    "tile_total_bounds": "SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM tile",
    "tile_buffered_window": """
, w AS (
  SELECT kaart_index, greatest((xmin - 10) / 0.8::DOUBLE, 0) AS l, least((xmax + 10) / 0.8::DOUBLE, 100) AS r2,
         greatest((ymax + 10 - 80) / -0.8::DOUBLE, 0) AS t, least((ymin - 10 - 80) / -0.8::DOUBLE, 100) AS b FROM tile)
SELECT kaart_index, round(l, 4) AS col_off, round(t, 4) AS row_off, round(r2 - l, 4) AS width, round(b - t, 4) AS height,
       round_even(l, 0)::INTEGER AS whole_col_off, round_even(t, 0)::INTEGER AS whole_row_off, round_even(r2 - l, 0)::INTEGER AS whole_width, round_even(b - t, 0)::INTEGER AS whole_height,
       round(l * 0.8::DOUBLE, 4) AS origin_c, round(80 - t * 0.8::DOUBLE, 4) AS origin_f
FROM w WHERE r2 > l AND b > t""",
    "bbox_features": "SELECT id, xmin, ymin, xmax, ymax FROM building WHERE xmin <= 60.5 AND xmax >= 20.5 AND ymin <= 60.5 AND ymax >= 20.5",
    "wfs_pages": "SELECT (n // 1000)::INTEGER AS page, count(*) AS features, min(id) AS first_id, max(id) AS last_id FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS n FROM building) WHERE (n // 1000) * 1000 < 50000 GROUP BY 1",
    "page_concat": "SELECT id, CASE WHEN id % 2 = 1 THEN segment END AS segment FROM building",
    "point_sample": "SELECT p.id, v.r, v.c, v.h::INTEGER AS h FROM point p JOIN dem_cm v ON v.r = floor(p.y) AND v.c = floor(p.x)",
    "zonal_percentile": _ZONAL,
    "zonal_percentile_params": f"SELECT b.id, {', '.join(f'round(quantile_cont(v.h::DOUBLE, {p / 100}), 4) AS p{p}' for p in (25, 50, 90))} FROM building b JOIN dem_cm v ON v.h IS NOT NULL AND {_INSIDE} GROUP BY b.id",
    "floor_level_search": f", {_search(1, 20, 0.75)} SELECT id, rounds, level FROM level",
    "floor_level_search_step": f", {_search(2, 10, 0.5)} SELECT id, rounds, level FROM level",
    "burn_polygons": f"SELECT v.r, v.c, max_by((b.seq % 1000)::INTEGER, b.seq) AS h FROM dem_cm v JOIN building b ON b.segment = 'BUILDING' AND {_INSIDE} AND (v.c + 0.5 - b.xmin) / (b.xmax - b.xmin) + (v.r + 0.5 - b.ymin) / (b.ymax - b.ymin) < 1 GROUP BY v.r, v.c",
    "offset_by_scale": f"SELECT id, (level + 5)::INTEGER AS scaled, trunc(level + 0.05)::INTEGER AS unscaled FROM ({_ZONAL})",
    "floor_level_burn": f", {_search(1, 20, 0.75)}, {_BURN} SELECT d.r, d.c, b.h FROM dem_cm d LEFT JOIN burnt b ON d.r = b.r AND d.c = b.c",
    "void_fill": "SELECT hole.r, hole.c, round(f.h, 4) AS h FROM hole LEFT JOIN filled f ON f.r = hole.r AND f.c = hole.c",
    "void_fill_tile_subset": "SELECT r, c, round(h, 0)::INTEGER AS h FROM ground WHERE r BETWEEN 0 AND 19 AND c BETWEEN 20 AND 59",
    "overview_5": "SELECT (r // 5)::INTEGER AS r, (c // 5)::INTEGER AS c, round(avg(h), 4) AS h FROM dem_cm GROUP BY 1, 2",
    "overview_25": "SELECT (r // 25)::INTEGER AS r, (c // 25)::INTEGER AS c, round(avg(h), 4) AS h FROM dem_cm GROUP BY 1, 2",
    "mosaic_priority": "SELECT r, c, coalesce(s.h, d.h::INTEGER) AS h FROM dem_cm d FULL JOIN dsm s USING (r, c) WHERE coalesce(s.h, d.h::INTEGER) IS NOT NULL",
    "mosaic_resolution": "SELECT round(avg(abs(a)), 6) AS resolution FROM meta",
    "composite_dem": f", {_search(1, 20, 0.75)}, {_BURN} SELECT g.r, g.c, coalesce(b.h, round(g.h, 0)::INTEGER) AS h FROM ground g LEFT JOIN burnt b ON g.r = b.r AND g.c = b.c",
    "raster_footprints": "SELECT tile_id, 28992 AS crs, xmin, ymin, xmax, ymax FROM meta",
    "raster_blocks": "SELECT r, c, h::INTEGER AS h FROM dem_cm",
    "windowed_read": "SELECT (r - 2)::INTEGER AS r, (c - 30)::INTEGER AS c, h::INTEGER AS h FROM dem_cm WHERE r BETWEEN 2 AND 41 AND c BETWEEN 30 AND 79",
    "geometry_type_distinct": "SELECT DISTINCT CASE WHEN id % 4 = 0 THEN 'Point' ELSE 'Polygon' END AS kind FROM building",
    "geotiff_round_trip": "SELECT r, c, h::INTEGER AS h FROM dem_cm WHERE h IS NOT NULL",
    "geotiff_metadata": f"SELECT {_TILE} AS raster_id, 20 AS height, 100 AS width, (-20 * t)::DOUBLE AS top, -32768 AS nodata, 0.01::DOUBLE AS scale, 28992 AS crs, 'int16' AS dtype FROM (SELECT DISTINCT r // 20 AS t FROM dem_cm)",
    "gpkg_round_trip": "SELECT id, segment, xmin, ymin, xmax, ymax, 28992 AS crs FROM building WHERE xmin <= 60.5 AND xmax >= 20.5 AND ymin <= 60.5 AND ymax >= 20.5",
    "geojson_round_trip": "SELECT kaart_index, xmin, ymin, xmax, ymax FROM tile",
    "zipped_gml": "SELECT lower(segment) AS file, id, xmin, ymin, xmax, ymax, 28992 AS crs FROM building",
    "zipped_raster": "SELECT r, c, h::INTEGER AS h FROM dem_cm WHERE h IS NOT NULL",
    "mosaic_members": f"SELECT (row_number() OVER (ORDER BY t) - 1)::INTEGER AS position, {_TILE} AS member FROM (SELECT DISTINCT r // 20 AS t FROM dem_cm)",
    "geometry_to_geojson": "SELECT id, 'Polygon' AS kind, xmin AS x, ymin AS y FROM building",
    "feature_count": "SELECT segment, count(*) AS features, bool_and(starts_with(segment, 'B')) AS all_b FROM building GROUP BY segment",
}
ORACLES: dict[str, str] = {name: _VIEWS + tail for name, tail in _TAIL.items()}
