"""Members of zip archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def is_zip(content_type: str | None, url: str) -> bool:
    return "zip" in (content_type or "").lower() or url.lower().endswith("zip")


def first_member(raw: bytes, suffix: str) -> bytes:
    """The first member with the suffix, in any case; ValueError where there is none."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        for name in z.namelist():
            if name.lower().endswith(suffix):
                return z.read(name)
    raise ValueError(f"no {suffix} in the archive")


def members(archives: DataFrame, suffix: str, only_first: bool = False) -> DataFrame:
    """(path, member, content, error) of archives (path, content); an archive without the suffix, or broken, gives one row with an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("member", pa.string()), ("content", pa.binary()), ("error", pa.string())])
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(raw.as_py())) as z:
                        names = [n for n in z.namelist() if n.lower().endswith(suffix)]
                        for name in names[:1] if only_first else names:
                            yield pa.RecordBatch.from_pylist([{"path": path, "member": name, "content": z.read(name), "error": None}], schema)
                        if not names:
                            raise ValueError(f"no {suffix} in the archive")
                except (zipfile.BadZipFile, ValueError) as e:
                    yield pa.RecordBatch.from_pylist([{"path": path, "member": None, "content": None, "error": str(e)}], schema)

    return archives.select("path", "content").mapInArrow(run, "path string, member string, content binary, error string")
