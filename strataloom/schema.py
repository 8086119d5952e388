"""Schemas of rasters, tile indexes and features, as DDL."""

from __future__ import annotations

#: Whole-number nodata value of stored rasters (the least 16-bit integer).
INT16_NODATA = -32768

#: a to f: x = c + col * a, y = f + row * e, with b = d = 0.
RASTER_META = "raster_id string, tile_id string, n_rows int, n_cols int, a double, b double, c double, d double, e double, f double, nodata double, scale double, crs int, dtype string"
RASTER_CELL = "raster_id string, r int, c int, h double"
RASTER_BLOCK = "raster_id string, br int, bc int, n_rows int, n_cols int, data array<double>"
EDGES = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
FEATURE = "id string, layer string, geom binary, xmin double, ymin double, xmax double, ymax double, crs int"
