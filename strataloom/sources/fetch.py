"""HTTP by the standard library, on the driver."""

from __future__ import annotations

import json
import os
import urllib.parse
import urllib.request
import uuid
from pathlib import Path

CHUNK = 1 << 20


def get(url: str, params: dict | None = None, timeout: float = 60) -> tuple[bytes, str]:
    """Content and content type; an HTTP error is raised."""
    if params:
        url = f"{url}?{urllib.parse.urlencode(params, safe=':,')}"
    with urllib.request.urlopen(url, timeout=timeout) as r:
        return r.read(), r.headers.get("Content-Type", "")


def post_json(url: str, body: dict, timeout: float = 60) -> dict:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"})
    with urllib.request.urlopen(request, timeout=timeout) as r:
        return json.loads(r.read())


def download(url: str, target: str | Path, overwrite: bool = True, timeout: float = 30) -> Path:
    """A file in chunks; it is there as a whole or not at all. An existing one stays unless `overwrite`."""
    target = Path(target)
    if target.exists() and not overwrite:
        return target
    target.parent.mkdir(parents=True, exist_ok=True)
    own = target.with_name(f".{target.name}.{uuid.uuid4().hex}")
    try:
        with urllib.request.urlopen(url, timeout=timeout) as r, own.open("wb") as f:
            while chunk := r.read(CHUNK):
                f.write(chunk)
        os.replace(own, target)
    finally:
        own.unlink(missing_ok=True)
    return target
