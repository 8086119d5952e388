"""Places of data and settings, from arguments, environment or a file of NAME=value lines."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path


def _env(file: str) -> dict[str, str]:
    """NAME=value lines of a file, under what the environment says; names in any case."""
    found = {}
    if os.path.exists(file):
        for line in Path(file).read_text().splitlines():
            name, sep, value = line.strip().partition("=")
            if sep and not name.startswith("#"):
                found[name.strip().lower()] = value.strip().strip("\"'")
    return found | {k.lower(): v for k, v in os.environ.items()}


@dataclass(frozen=True)
class DataStore:
    """data_dir holds source_data and processed_data, unless those are given; folders are made when they are asked for."""

    data_dir: Path | None = None
    source_data_dir: Path | None = None
    processed_data_dir: Path | None = None
    env_file: str = ".datastore"
    _made: dict = field(default_factory=dict, repr=False, compare=False)

    def __post_init__(self) -> None:
        env = _env(self.env_file)
        data = Path(self.data_dir or env.get("data_dir") or Path.cwd() / "data")
        for name, value in (("data_dir", data), ("source_data_dir", self.source_data_dir or env.get("source_data_dir") or data / "source_data"), ("processed_data_dir", self.processed_data_dir or env.get("processed_data_dir") or data / "processed_data")):
            object.__setattr__(self, name, Path(value))

    def _dir(self, path: Path) -> Path:
        path.mkdir(parents=True, exist_ok=True)
        return path

    @property
    def processed(self) -> Path:
        return self._dir(self.processed_data_dir)

    @property
    def ahn_dir(self) -> Path:
        return self._dir(self.source_data_dir / "ahn")

    @property
    def bgt_dir(self) -> Path:
        return self._dir(self.source_data_dir / "bgt")

    @property
    def bag_dir(self) -> Path:
        return self._dir(self.source_data_dir / "bag")


@dataclass
class Settings:
    """m_to_cm: store metres as whole centimetres."""

    m_to_cm: bool | None = None
    env_file: str = ".env"

    def __post_init__(self) -> None:
        if self.m_to_cm is None:
            self.m_to_cm = _env(self.env_file).get("m_to_cm", "true").lower() in ("1", "true", "yes", "on")
