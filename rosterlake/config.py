"""Configuration of a merge run, read from YAML or JSON on the driver."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any


@dataclass
class SourceConfig:
    name: str
    type: str
    path: str
    mapping: dict[str, str] = field(default_factory=dict)
    options: dict[str, Any] = field(default_factory=dict)


@dataclass
class NormalizationConfig:
    date_fields: list[str] = field(default_factory=list)
    phone_fields: list[str] = field(default_factory=list)
    default_phone_region: str = "RU"
    id_fields: list[str] = field(default_factory=list)
    text_fields: list[str] = field(default_factory=list)
    uppercase_fields: list[str] = field(default_factory=list)


@dataclass
class MergeConfig:
    deduplicate_on: list[str] = field(default_factory=list)
    keep: str | bool = "first"
    combine_columns: list[str] = field(default_factory=list)


@dataclass
class QualityConfig:
    required_fields: list[str] = field(default_factory=list)
    drop_if_empty: list[str] = field(default_factory=list)
    drop_if_filled: list[str] = field(default_factory=list)
    drop_if_matches: dict[str, str] = field(default_factory=dict)
    patterns: dict[str, str] = field(default_factory=dict)
    min_total_rows: int = 0


@dataclass
class DatabaseConfig:
    """Where results go: a JDBC url, or a folder or table prefix that Spark writes."""

    url: str = ""
    table_all: str = "registry_all"
    table_persons: str = "registry_persons"
    table_orgs: str = "registry_orgs"
    directory: str = "output"


@dataclass
class LoggingConfig:
    directory: str = "logs"
    level: str = "INFO"


@dataclass
class AppConfig:
    sources: list[SourceConfig]
    normalization: NormalizationConfig = field(default_factory=NormalizationConfig)
    merge: MergeConfig = field(default_factory=MergeConfig)
    quality: QualityConfig = field(default_factory=QualityConfig)
    database: DatabaseConfig = field(default_factory=DatabaseConfig)
    logging: LoggingConfig = field(default_factory=LoggingConfig)


def read_raw(path: str | Path) -> dict[str, Any]:
    path = Path(path)
    if not path.exists():
        raise FileNotFoundError(f"no such configuration file: {path}")
    kind = path.suffix.lower()
    if kind == ".json":
        return json.loads(path.read_text(encoding="utf-8"))
    if kind in (".yaml", ".yml"):
        import yaml

        return yaml.safe_load(path.read_text(encoding="utf-8")) or {}
    raise ValueError(f"a configuration file is yaml, yml or json, not {path.suffix!r}")


def from_raw(raw: dict[str, Any]) -> AppConfig:
    """Unknown keys in a section raise TypeError; without sources, ValueError."""
    if not raw.get("sources"):
        raise ValueError("the configuration names no source")
    sources = [SourceConfig(s["name"], str(s["type"]).lower(), s["path"], s.get("mapping", {}), s.get("options", {})) for s in raw["sources"]]
    kinds = {"normalization": NormalizationConfig, "merge": MergeConfig, "quality": QualityConfig, "database": DatabaseConfig, "logging": LoggingConfig}
    return AppConfig(sources, **{k: kind(**(raw.get(k) or {})) for k, kind in kinds.items()})


def load_config(path: str | Path) -> AppConfig:
    return from_raw(read_raw(path))
