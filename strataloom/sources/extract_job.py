"""Topography extracts: a job is submitted, polled and fetched; the archive's GML members are features."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.functions import geom
from strataloom.sources import archive, fetch, gml, tiff

logger = logging.getLogger(__name__)

#: Public topography service (fixed values).
BGT_ROOT = "https://api.pdok.nl"
CUSTOM = "/lv/bgt/download/v1_0/full/custom"
FAILURES = frozenset(["FAILED", "ERROR", "CANCELLED", "EXPIRED"])


def submit(feature_types: Iterable[str], mask: bytes | None = None, root: str = BGT_ROOT) -> str:
    """Id of a new job; a mask that is no polygon counts as its bounding box."""
    body: dict = {"featuretypes": list(feature_types), "format": "citygml"}
    if mask is not None:
        body["geofilter"] = geom.wkt(geom.as_polygon(mask))
    job = fetch.post_json(root + CUSTOM, body)["downloadRequestId"]
    logger.debug("download request %s", job)
    return job


def poll(job: str, interval_s: float = 5, deadline_s: float = 3600, root: str = BGT_ROOT) -> str:
    """URL of the finished extract; RuntimeError where the job fails, TimeoutError at the deadline."""
    end = time.monotonic() + deadline_s
    while True:
        state = json.loads(fetch.get(f"{root}{CUSTOM}/{job}/status")[0])
        if state["status"] == "COMPLETED":
            return root + state["_links"]["download"]["href"]
        if state["status"] in FAILURES:
            raise RuntimeError(f"job {job}: {state['status']}")
        logger.debug("job %s: %s, progress %s", job, state["status"], state.get("progress"))
        if time.monotonic() + interval_s > end:
            raise TimeoutError(f"job {job} is not complete after {deadline_s} s")
        time.sleep(interval_s)


def read_extract(spark: SparkSession, path: str | Path, crs: int = 28992) -> DataFrame:
    """Features of all GML members of an archive, with a column `file` (the member's stem); ValueError where it has none."""
    found = archive.members(tiff.files(spark, str(path), "*"), ".gml")
    lost = found.where("member is null").select("error").first()
    if lost:
        raise ValueError(lost["error"])
    stem = F.regexp_extract("member", r"([^/]+)\.[^./]+$", 1)
    return gml.scan(found, crs).withColumn("file", stem)
