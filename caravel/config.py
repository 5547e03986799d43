"""Configuration from the environment, logging and output places."""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass, field
from pathlib import Path


def _env(name: str, default: str) -> str:
    """A variable's value; unset and empty ones give the default."""
    return os.environ.get(name) or default


@dataclass(frozen=True)
class SourceConfig:
    """Where the legacy database is; ``url`` is a JDBC URL."""

    url: str = field(default_factory=lambda: _env("CARAVEL_SOURCE_URL", ""))
    user: str = field(default_factory=lambda: _env("CARAVEL_SOURCE_USER", ""))
    password: str = field(default_factory=lambda: _env("CARAVEL_SOURCE_PASSWORD", ""), repr=False)
    charset: str = field(default_factory=lambda: _env("CARAVEL_SOURCE_CHARSET", "WIN1252"))
    driver: str = field(default_factory=lambda: _env("CARAVEL_SOURCE_DRIVER", ""))

    def options(self) -> dict[str, str]:
        given = {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}
        return {k: v for k, v in given.items() if v}


@dataclass(frozen=True)
class TargetConfig:
    """Where tables are loaded to: a database of the session catalog, or a folder of Parquet tables."""

    database: str = field(default_factory=lambda: _env("CARAVEL_TARGET_DATABASE", "default"))
    folder: str = field(default_factory=lambda: _env("CARAVEL_TARGET_FOLDER", ""))


@dataclass(frozen=True)
class Config:
    source: SourceConfig = field(default_factory=SourceConfig)
    target: TargetConfig = field(default_factory=TargetConfig)
    dump_dir: str = field(default_factory=lambda: _env("CARAVEL_DUMP_DIR", "dump"))

    @classmethod
    def from_env(cls, dotenv: str | None = None) -> Config:
        """The environment's configuration; a file of NAME=value lines fills in what the environment does not set."""
        if dotenv and Path(dotenv).exists():
            for line in Path(dotenv).read_text().splitlines():
                name, eq, value = line.partition("=")
                if eq and not name.lstrip().startswith("#"):
                    os.environ.setdefault(name.strip(), value.strip().strip("'\""))
        return cls()


def dump_path(name: str, folder: str) -> Path:
    """A file's place below the dump folder, which is made if missing."""
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    return path


def setup_logging(path: str | None = None, level: int = logging.INFO) -> logging.Logger:
    log = logging.getLogger("caravel")
    log.setLevel(level)
    if not log.handlers:
        form = logging.Formatter("%(asctime)s %(levelname)s %(message)s")
        for handler in [logging.StreamHandler(), *([logging.FileHandler(path, encoding="utf-8")] if path else [])]:
            handler.setFormatter(form)
            log.addHandler(handler)
    return log
