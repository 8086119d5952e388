"""Logging on the driver: one rotating file behind the root logger, set up again without doubles."""

from __future__ import annotations

import logging
from logging.handlers import RotatingFileHandler
from pathlib import Path

FORMAT = "%(asctime)s %(levelname)s %(name)s: %(message)s"
MAX_BYTES, BACKUPS = 5 * 1024 * 1024, 5


def get_logger(name: str | None = None) -> logging.Logger:
    return logging.getLogger(name)


def _own(kind: type) -> list[logging.Handler]:
    return [h for h in logging.getLogger().handlers if type(h) is kind and getattr(h, "_strataloom", False)]


def _add(handler: logging.Handler, level: int) -> None:
    handler._strataloom = True
    handler.setLevel(level)
    handler.setFormatter(logging.Formatter(FORMAT))
    logging.getLogger().addHandler(handler)


def init_logger(name: str | None = None, log_file: str | Path | None = None, debug: bool = False) -> logging.Logger:
    """The logger `name`. A new log_file takes the place of the one before; calling again only sets the level."""
    level = logging.DEBUG if debug else logging.INFO
    logging.getLogger().setLevel(level)
    if not _own(logging.StreamHandler):
        _add(logging.StreamHandler(), level)
    if log_file is not None:
        path = Path(log_file).absolute()
        path.parent.mkdir(parents=True, exist_ok=True)
        for handler in _own(RotatingFileHandler):
            if Path(handler.baseFilename) != path:
                logging.getLogger().removeHandler(handler)
                handler.close()
        if not _own(RotatingFileHandler):
            _add(RotatingFileHandler(path, maxBytes=MAX_BYTES, backupCount=BACKUPS, encoding="utf-8"), level)
    for kind in (logging.StreamHandler, RotatingFileHandler):
        for handler in _own(kind):
            handler.setLevel(level)
    return logging.getLogger(name)
