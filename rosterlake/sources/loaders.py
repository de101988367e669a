"""The reader of each kind of source; new kinds are added to READERS."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SourceConfig
from . import files, html_lists
from .http import fetch, read_api


def _page(path: str, options: dict[str, Any]) -> str:
    if path.lower().startswith(("http://", "https://")):
        return fetch(path, options=options).text(options.get("encoding"))
    with open(path, encoding=options.get("encoding") or "utf-8") as f:
        return f.read()


READERS: dict[str, Callable[[SparkSession, str, dict[str, Any]], DataFrame]] = {
    "csv": files.read_csv,
    "json": files.read_json,
    "xml": files.read_xml,
    "excel": files.read_excel,
    "api": read_api,
    "web": lambda spark, path, o: html_lists.read_html_table(spark, _page(path, o), o),
    "html_list": lambda spark, path, o: html_lists.read_html_list(spark, _page(path, o), o),
    "parquet": lambda spark, path, o: spark.read.parquet(path).withColumn("_row_ord", F.monotonically_increasing_id()),
}


def load(spark: SparkSession, source: SourceConfig) -> DataFrame:
    if source.type not in READERS:
        raise ValueError(f"unknown kind of source {source.type!r}; known are {', '.join(sorted(READERS))}")
    return READERS[source.type](spark, source.path, source.options)


def read_registry(spark: SparkSession, cfg: dict[str, Any]) -> DataFrame:
    """original, category, ord of a list: a JDBC or saved table by column name, else a CSV file by column place; null is empty."""
    db = cfg.get("registry_db")
    if db:
        if str(db.get("url", "")).startswith("jdbc:"):
            df = spark.read.jdbc(db["url"], db["table"], properties=db.get("properties") or {})
        else:
            df = spark.read.parquet(f"{db['url']}/{db['table']}") if db.get("url") else spark.table(db["table"])
        name, category = db.get("name_column", "naimenovanie_fio"), db.get("category_column", "kategoriya")
        order = F.col("id").cast("long") if "id" in df.columns else F.monotonically_increasing_id()
    else:
        df = files.read_csv(spark, cfg["registry_csv"], cfg)
        name, category = df.columns[cfg.get("name_column_index", 1)], df.columns[cfg.get("category_column_index", 2)]
        order = F.col("_row_ord")
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    return df.select(text(name).alias("original"), text(category).alias("category"), order.alias("ord"))
