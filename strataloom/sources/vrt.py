"""Virtual mosaics: an XML list of tiles on one grid, later ones on top."""

from __future__ import annotations

import logging
import mmap
import xml.etree.ElementTree as ET
from collections.abc import Sequence
from pathlib import Path

from strataloom.sources import tiff

logger = logging.getLogger(__name__)

_TYPES = {"uint8": "Byte", "int8": "Int8", "int16": "Int16", "uint16": "UInt16", "int32": "Int32", "uint32": "UInt32", "float32": "Float32", "float64": "Float64"}


def tif_files(directory: str | Path | Sequence[str | Path]) -> list[Path]:
    """*.tif right in one or more folders: folders in their order, files by name."""
    folders = [directory] if isinstance(directory, (str, Path)) else directory
    return [f.resolve() for d in folders for f in sorted(Path(d).glob("*.tif"))]


def create_vrt_file(vrt_file: str | Path, directory: str | Path | Sequence[str | Path]) -> Path:
    """A mosaic of the folders' tiles at their mean resolution; without tiles it warns and writes none."""
    vrt_file, found = Path(vrt_file), tif_files(directory)
    if not found:
        logger.warning("no vrt-file created: no tif-files in %s", directory)
        return vrt_file
    parts = []
    for f in found:
        with f.open("rb") as opened, mmap.mmap(opened.fileno(), 0, access=mmap.ACCESS_READ) as raw:
            height, width, profile = tiff.describe(raw)
        parts.append((f, (height, width), profile))
    boxes = [p.transform.bounds(*shape) for _, shape, p in parts]
    xmin, ymin, xmax, ymax = min(b[0] for b in boxes), min(b[1] for b in boxes), max(b[2] for b in boxes), max(b[3] for b in boxes)
    size = sum(p.transform.cell_size for _, _, p in parts) / len(parts)
    first = parts[0][2]
    root = ET.Element("VRTDataset", rasterXSize=str(round((xmax - xmin) / size)), rasterYSize=str(round((ymax - ymin) / size)))
    if first.crs:
        ET.SubElement(root, "SRS").text = f"EPSG:{first.crs}"
    ET.SubElement(root, "GeoTransform").text = ", ".join(map(repr, (xmin, size, 0.0, ymax, 0.0, -size)))
    band = ET.SubElement(root, "VRTRasterBand", dataType=_TYPES[first.dtype], band="1")
    if first.nodata is not None:
        ET.SubElement(band, "NoDataValue").text = repr(first.nodata)
    if first.scale != 1:
        ET.SubElement(band, "Scale").text = repr(first.scale)
    for (f, (rows, cols), p), b in zip(parts, boxes, strict=True):
        source = ET.SubElement(band, "ComplexSource" if p.nodata is not None else "SimpleSource")
        ET.SubElement(source, "SourceFilename", relativeToVRT="0").text = f.as_posix()
        ET.SubElement(source, "SourceBand").text = "1"
        ET.SubElement(source, "SrcRect", xOff="0", yOff="0", xSize=str(cols), ySize=str(rows))
        ET.SubElement(source, "DstRect", xOff=repr((b[0] - xmin) / size), yOff=repr((ymax - b[3]) / size), xSize=repr((b[2] - b[0]) / size), ySize=repr((b[3] - b[1]) / size))
        if p.nodata is not None:
            ET.SubElement(source, "NODATA").text = repr(p.nodata)
    vrt_file.parent.mkdir(parents=True, exist_ok=True)
    ET.indent(root)
    ET.ElementTree(root).write(vrt_file)
    return vrt_file


def list_tif_files_in_vrt_file(vrt_file: str | Path) -> list[Path]:
    """Members of a mosaic, without the mosaic itself."""
    names = [e.text for e in ET.parse(vrt_file).iter("SourceFilename")]
    return [Path(n) for n in names if n != Path(vrt_file).as_posix()]
