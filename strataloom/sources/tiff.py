"""GeoTIFF codec (classic TIFF) and raster scans.

Reads strips or tiles, little or big endian, without compression or with deflate, LZW or
PackBits, predictors 1 to 3, whole numbers and floats of 8 to 64 bits. Writes tiled
deflate files with the horizontal predictor on whole numbers, a scale, nodata and overviews.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strataloom.functions.grid import Affine

# Tag numbers of the TIFF and GeoTIFF standards (fixed values).
SUBFILE, WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 254, 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_SIZES, PLANAR = 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_SIZES, FORMAT = 317, 322, 323, 324, 325, 339
PIXEL_SCALE, TIE_POINT, TRANSFORM, GEO_KEYS, METADATA, NODATA = 33550, 33922, 34264, 34735, 42112, 42113
PROJECTED_CRS, GEOGRAPHIC_CRS = 3072, 2048
_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 7: "B", 8: "h", 9: "i", 10: "ii", 11: "f", 12: "d"}
_KINDS = {1: "u", 2: "i", 3: "f"}
TILE = 256


@dataclass(frozen=True)
class Profile:
    dtype: str
    transform: Affine
    nodata: float | None = None
    scale: float = 1.0
    crs: int | None = None


def _lzw(raw: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, highest bit first."""
    out, table, width, held, bits, before = bytearray(), [], 9, 0, 0, b""
    for byte in raw:
        held, bits = held << 8 | byte, bits + 8
        while bits >= width:
            code = held >> (bits - width) & (1 << width) - 1
            bits -= width
            held &= (1 << bits) - 1
            if code == 256:
                table, width, before = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
                continue
            if code == 257:
                return bytes(out)
            word = table[code] if code < len(table) else before + before[:1]
            out += word
            if before:
                table.append(before + word[:1])
                width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
            before = word
    return bytes(out)


def _packbits(raw: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(raw):
        n = raw[i]
        if n < 128:
            out += raw[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += raw[i + 1 : i + 2] * (257 - n)
            i += 2
    return bytes(out)


def _unpacked(raw: bytes, compression: int) -> bytes:
    if compression == 1:
        return raw
    if compression in (8, 32946):
        return zlib.decompress(raw)
    if compression == 5:
        return _lzw(raw)
    if compression == 32773:
        return _packbits(raw)
    raise ValueError(f"TIFF compression {compression} is not supported")


def directories(raw: bytes) -> tuple[str, list[dict[int, tuple]]]:
    """Byte order and tags of each directory."""
    order = {b"II": "<", b"MM": ">"}.get(raw[:2])
    if order is None or struct.unpack_from(order + "H", raw, 2)[0] != 42:
        raise ValueError("not a classic TIFF file")
    (at,) = struct.unpack_from(order + "I", raw, 4)
    found = []
    while at:
        (n,) = struct.unpack_from(order + "H", raw, at)
        tags = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", raw, at + 2 + 12 * k)
            code = _TYPES.get(kind)
            if code is None:
                continue
            size = struct.calcsize("=" + code) * count
            place = at + 10 + 12 * k
            if size > 4:
                (place,) = struct.unpack_from(order + "I", raw, place)
            tags[tag] = (raw[place : place + count],) if code == "s" else struct.unpack_from(order + code * count, raw, place)
        found.append(tags)
        (at,) = struct.unpack_from(order + "I", raw, at + 2 + 12 * n)
    return order, found


def read(raw: bytes, band: int = 1, level: int = 0) -> tuple[np.ndarray, Profile]:
    """A band of the image (level 0) or of an overview, as stored, and its profile."""
    order, found = directories(raw)
    tags = found[level]
    width, height, samples = tags[WIDTH][0], tags[HEIGHT][0], tags.get(SAMPLES, (1,))[0]
    if not 1 <= band <= samples:
        raise ValueError(f"band {band} of {samples}")
    kind = np.dtype(f"{order}{_KINDS[tags.get(FORMAT, (1,))[0]]}{tags[BITS][0] // 8}")
    tiled = TILE_OFFSETS in tags
    w, h = (tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0]) if tiled else (width, min(tags.get(ROWS_PER_STRIP, (height,))[0], height))
    offsets, sizes = (tags[TILE_OFFSETS], tags[TILE_SIZES]) if tiled else (tags[STRIP_OFFSETS], tags[STRIP_SIZES])
    planes = tags.get(PLANAR, (1,))[0] == 2
    inner = 1 if planes else samples
    across, down = -(-width // w), -(-height // h)
    out = np.zeros((down * h, across * w), kind.newbyteorder("="))
    for i in range(across * down):
        k = i + (band - 1) * across * down * planes
        piece = _unpacked(raw[offsets[k] : offsets[k] + sizes[k]], tags.get(COMPRESSION, (1,))[0])
        rows = h if tiled else min(h, height - i // across * h)
        predictor = tags.get(PREDICTOR, (1,))[0]
        if predictor == 3:
            bytes_ = np.frombuffer(piece, np.uint8, rows * w * inner * kind.itemsize).reshape(rows, w * inner * kind.itemsize)
            bytes_ = np.cumsum(bytes_.reshape(rows, -1, inner), axis=1, dtype=np.uint8).reshape(rows, kind.itemsize, w * inner)
            data = np.ascontiguousarray(bytes_.transpose(0, 2, 1)).view(kind.newbyteorder(">")).reshape(rows, w, inner)
        else:
            data = np.frombuffer(piece, kind, rows * w * inner).reshape(rows, w, inner)
            if predictor == 2:
                data = np.cumsum(data, axis=1, dtype=kind.newbyteorder("="))
        y, x = i // across * h, i % across * w
        out[y : y + rows, x : x + w] = data[:, :, 0 if planes else band - 1]
    return out[:height, :width], _profile(tags, found[0], out.dtype, width, height)


def describe(raw) -> tuple[int, int, Profile]:
    """Rows, columns and profile of the image, without its cells; `raw` may be bytes or a memory map."""
    order, found = directories(raw)
    tags = found[0]
    kind = np.dtype(f"{_KINDS[tags.get(FORMAT, (1,))[0]]}{tags[BITS][0] // 8}")
    return tags[HEIGHT][0], tags[WIDTH][0], _profile(tags, tags, kind, tags[WIDTH][0], tags[HEIGHT][0])


def _profile(tags: dict, first: dict, dtype: np.dtype, width: int, height: int) -> Profile:
    t = Affine(1.0, 0.0, 0.0, 0.0, 1.0, 0.0)
    if TRANSFORM in first:
        m = first[TRANSFORM]
        t = Affine(m[0], m[1], m[3], m[4], m[5], m[7])
    elif PIXEL_SCALE in first and TIE_POINT in first:
        (sx, sy, _), (i, j, _, x, y, _) = first[PIXEL_SCALE][:3], first[TIE_POINT][:6]
        t = Affine(sx, 0.0, x - i * sx, 0.0, -sy, y + j * sy)
    if tags is not first:
        t = replace(t, a=t.a * first[WIDTH][0] / width, e=t.e * first[HEIGHT][0] / height)
    nodata = first.get(NODATA, (b"",))[0].strip(b"\0 ").decode()
    meta = first.get(METADATA, (b"",))[0].decode(errors="replace")
    scale = re.search(r'<Item[^>]*role="scale"[^>]*>([^<]+)<', meta)
    keys = first.get(GEO_KEYS, ())
    crs = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    return Profile(dtype.name, t, float(nodata) if nodata else None, float(scale[1]) if scale else 1.0, crs.get(PROJECTED_CRS) or crs.get(GEOGRAPHIC_CRS))


def _overview(data: np.ndarray, factor: int, nodata: float | None) -> np.ndarray:
    """Mean of valid cells of each factor x factor group, as in operators.raster.overview."""
    height, width = (-(-n // factor) for n in data.shape)
    whole = np.full((height * factor, width * factor), np.nan)
    whole[: data.shape[0], : data.shape[1]] = np.where(data == nodata, np.nan, data) if nodata is not None else data
    groups = whole.reshape(height, factor, width, factor).transpose(0, 2, 1, 3).reshape(height, width, -1)
    count = (~np.isnan(groups)).sum(2)
    mean = np.nansum(groups, 2) / np.maximum(count, 1)
    mean = np.where(count > 0, np.rint(mean) if data.dtype.kind in "iu" else mean, nodata if nodata is not None else 0)
    return mean.astype(data.dtype)


def write(data: np.ndarray, profile: Profile, overviews: Sequence[int] = ()) -> bytes:
    """Bytes of a GeoTIFF of one band with overviews by these factors."""
    data = np.ascontiguousarray(data.astype(np.dtype(profile.dtype)))
    images = [data, *(_overview(data, f, profile.nodata) for f in overviews if f > 1)]
    body, places = bytearray(b"II*\0\0\0\0\0"), []
    for n, image in enumerate(images):
        height, width = image.shape
        across, down = -(-width // TILE), -(-height // TILE)
        padded = np.zeros((down * TILE, across * TILE), image.dtype)
        padded[:height, :width] = image
        whole = image.dtype.kind in "iu"
        offsets, sizes = [], []
        for y in range(down):
            for x in range(across):
                tile = padded[y * TILE : (y + 1) * TILE, x * TILE : (x + 1) * TILE]
                if whole:
                    tile = np.concatenate([tile[:, :1], np.diff(tile.astype(np.int64), axis=1).astype(image.dtype)], 1)
                packed = zlib.compress(np.ascontiguousarray(tile).astype(image.dtype.newbyteorder("<")).tobytes())
                offsets.append(len(body))
                sizes.append(len(packed))
                body += packed
        t = profile.transform
        tags: list[tuple[int, int, tuple]] = [
            (SUBFILE, 4, (int(n > 0),)), (WIDTH, 4, (width,)), (HEIGHT, 4, (height,)), (BITS, 3, (image.dtype.itemsize * 8,)), (COMPRESSION, 3, (8,)), (PHOTOMETRIC, 3, (1,)),
            (SAMPLES, 3, (1,)), (PLANAR, 3, (1,)), (PREDICTOR, 3, (2 if whole else 1,)), (TILE_WIDTH, 4, (TILE,)), (TILE_HEIGHT, 4, (TILE,)), (TILE_OFFSETS, 4, tuple(offsets)), (TILE_SIZES, 4, tuple(sizes)),
            (FORMAT, 3, ({"u": 1, "i": 2, "f": 3}[image.dtype.kind],)),
        ]
        if n == 0:
            if t.b or t.d or t.e > 0:
                tags.append((TRANSFORM, 12, (t.a, t.b, 0.0, t.c, t.d, t.e, 0.0, t.f, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)))
            else:
                tags += [(PIXEL_SCALE, 12, (t.a, -t.e, 0.0)), (TIE_POINT, 12, (0.0, 0.0, 0.0, t.c, t.f, 0.0))]
            if profile.crs:
                tags.append((GEO_KEYS, 3, (1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, PROJECTED_CRS, 0, 1, profile.crs)))
            items = f'<Item name="SCALE" sample="0" role="scale">{profile.scale!r}</Item>' if profile.scale != 1 else ""
            items += '<Item name="OVERVIEW_RESAMPLING">average</Item>' if len(images) > 1 else ""
            if items:
                tags.append((METADATA, 2, (f"<GDALMetadata>{items}</GDALMetadata>\0".encode(),)))
            if profile.nodata is not None:
                text = repr(int(profile.nodata)) if profile.nodata == int(profile.nodata) else repr(profile.nodata)
                tags.append((NODATA, 2, (f"{text}\0".encode(),)))
        entries = []
        for tag, kind, values in sorted(tags):
            raw = values[0] if kind == 2 else struct.pack("<" + _TYPES[kind] * len(values), *values)
            if len(raw) > 4:
                body += b"\0" * (len(body) % 2)
                place, raw = len(body), raw
                body += raw
                entries.append(struct.pack("<HHII", tag, kind, len(raw) if kind == 2 else len(values), place))
            else:
                entries.append(struct.pack("<HHI", tag, kind, len(raw) if kind == 2 else len(values)) + raw.ljust(4, b"\0"))
        body += b"\0" * (len(body) % 2)
        places.append(len(body))
        body += struct.pack("<H", len(entries)) + b"".join(entries) + b"\0\0\0\0"
    struct.pack_into("<I", body, 4, places[0])
    for a, b in zip(places, places[1:], strict=False):
        (n,) = struct.unpack_from("<H", body, a)
        struct.pack_into("<I", body, a + 2 + 12 * n, b)
    return bytes(body)


def files(spark: SparkSession, path: str | Sequence[str], pattern: str = "*.tif") -> DataFrame:
    """(path, content) of the files right in one or more folders."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(paths).select("path", "content")


BLOCKS = "raster_id string, path string, br int, bc int, n_rows int, n_cols int, data array<double>, a double, b double, c double, d double, e double, f double, height int, width int, nodata double, scale double, crs int, dtype string, error string"


def scan(contents: DataFrame, size: int = TILE, band: int = 1) -> DataFrame:
    """Blocks of rasters (path, content); nodata is null. A file that cannot be read gives one row with its error."""
    names = [part.split()[0] for part in BLOCKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}
        schema = pa.schema([(part.split()[0], kinds[part.split()[1]]) for part in BLOCKS.split(", ")])
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                stem = path.rstrip("/").rpartition("/")[2].rpartition(".")[0]
                base = dict.fromkeys(names) | {"raster_id": stem, "path": path}
                try:
                    data, p = read(raw.as_py(), band)
                except Exception as e:
                    yield pa.RecordBatch.from_pylist([base | {"error": f"{type(e).__name__}: {e}"}], schema)
                    continue
                t = p.transform
                base |= {"a": t.a, "b": t.b, "c": t.c, "d": t.d, "e": t.e, "f": t.f, "height": data.shape[0], "width": data.shape[1], "nodata": p.nodata, "scale": p.scale, "crs": p.crs, "dtype": p.dtype}
                for r in range(0, data.shape[0], size):
                    rows = []
                    for k in range(0, data.shape[1], size):
                        piece = data[r : r + size, k : k + size].astype(np.float64)
                        null = np.isnan(piece) if p.nodata is None or np.isnan(p.nodata) else (data[r : r + size, k : k + size] == p.nodata)
                        values = pa.array(piece.ravel(), mask=null.ravel()).to_pylist()
                        rows.append(base | {"br": r // size, "bc": k // size, "n_rows": piece.shape[0], "n_cols": piece.shape[1], "data": values})
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return contents.select("path", "content").mapInArrow(run, BLOCKS)


META = "raster_id string, path string, height int, width int, a double, b double, c double, d double, e double, f double, nodata double, scale double, crs int, dtype string, error string"


def metadata(contents: DataFrame) -> DataFrame:
    """One row of metadata for each raster (path, content); no cell is decoded. A file that cannot be read has an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}
        schema = pa.schema([(part.split()[0], kinds[part.split()[1]]) for part in META.split(", ")])
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                row = dict.fromkeys(schema.names) | {"raster_id": path.rstrip("/").rpartition("/")[2].rpartition(".")[0], "path": path}
                try:
                    height, width, p = describe(raw.as_py())
                    row |= {"height": height, "width": width, "nodata": p.nodata, "scale": p.scale, "crs": p.crs, "dtype": p.dtype} | {n: getattr(p.transform, n) for n in "abcdef"}
                except Exception as e:
                    row["error"] = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_pylist([row], schema)

    return contents.select("path", "content").mapInArrow(run, META)
