"""Writers: the three tables of a merged list, findings, reports and baselines."""

from __future__ import annotations

import json
import logging
import sys
from datetime import datetime
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DatabaseConfig
from ..functions import text as T
from ..storage import materialize, number_rows

# Columns of the exported tables.
EXPORT_COLUMNS = {
    "full_name": "naimenovanie_fio", "kind": "tip_subekta", "category": "kategoriya", "birth_date": "data_rozhdeniya",
    "inn": "inn", "reg_date": "data_vklyucheniya", "address": "adres", "source": "istochnik",
}


def prepare_export(df: DataFrame) -> DataFrame:
    """The export columns that df has, with the kind's label and an id in row order."""
    name = F.col("full_name").cast("string")
    kind = T.classify_kind(T.normalize(name), F.coalesce(name, F.lit("")))
    labelled = df.withColumn("kind", F.when(kind == "person", T.KIND_LABELS["person"]).otherwise(T.KIND_LABELS["org"]))
    chosen = [F.col(c).alias(n) for c, n in EXPORT_COLUMNS.items() if c in labelled.columns]
    order = ["_src_ord", "_row_ord"]
    numbered = number_rows(labelled.select(*chosen, *order), [F.col(c) for c in order])
    return numbered.drop(*order)


def split_by_kind(prepared: DataFrame) -> dict[str, DataFrame]:
    """Persons and organizations with ids of their own, in the order of the whole table."""
    out = {}
    for kind, label in T.KIND_LABELS.items():
        part = prepared.where(F.col("tip_subekta") == label).withColumnRenamed("id", "__all")
        out[kind] = number_rows(part, [F.col("__all")]).drop("__all")
    return out


def write_table(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Replaces a table: over JDBC, as Parquet in a folder, or as a saved table without a url. What is written has been computed
    before the old one goes."""
    df = materialize(df, "out")
    if url.startswith("jdbc:"):
        df.write.mode("overwrite").option("truncate", True).jdbc(url, table, properties=properties or {})
    elif url:
        df.write.mode("overwrite").parquet(f"{url}/{table}")
    else:
        df.write.mode("overwrite").saveAsTable(table)


def export(df: DataFrame, cfg: DatabaseConfig) -> list[str]:
    prepared = materialize(prepare_export(df), "export")
    parts = split_by_kind(prepared)
    for frame, name in ((prepared, cfg.table_all), (parts["person"], cfg.table_persons), (parts["org"], cfg.table_orgs)):
        write_table(frame, cfg.url, name)
    return [cfg.table_all, cfg.table_persons, cfg.table_orgs]


def write_json(path: str | Path, data: Any) -> Path:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(data, ensure_ascii=False, indent=2), encoding="utf-8")
    return path


def write_notice(directory: str | Path, sources: list[tuple[str, str]], name: str = "DISCLAIMER.txt") -> Path:
    """Where the data come from, and what a hit is: a candidate for review."""
    lines = [
        f"Generated: {datetime.now():%Y-%m-%d %H:%M}", "",
        "The data were gathered by a program from public lists and are given as they are.",
        "Categories are those of the sources and no judgement of their own; check them against the source before use.",
        "A match of names is a candidate for review by a person and identifies nobody.", "",
        "Sources:", *(f"  - {n}: {u}" for n, u in sources),
    ]
    path = Path(directory) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return path


def setup_logger(directory: str | Path = "logs", level: str = "INFO") -> logging.Logger:
    """Logs to stdout and to run_<time>.log; a second call changes nothing."""
    log = logging.getLogger("rosterlake")
    if not log.handlers:
        Path(directory).mkdir(parents=True, exist_ok=True)
        form = logging.Formatter("%(asctime)s %(levelname)s %(message)s")
        for h in (logging.StreamHandler(sys.stdout), logging.FileHandler(Path(directory) / f"run_{datetime.now():%Y%m%d_%H%M%S}.log", encoding="utf-8")):
            h.setFormatter(form)
            log.addHandler(h)
        log.setLevel(level)
    return log
