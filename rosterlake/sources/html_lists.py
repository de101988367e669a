"""Numbered lists and tables in HTML pages as frames."""

from __future__ import annotations

import re
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from ..shipping import ship

# What starts an entry in a running text, and in an item.
ENTRY = r"(?:^|\n)\s*(\d{1,4})[.)]\s+"
ITEM = r"^\s*(\d{1,6})[.)]\s+(.*)$"


def container(html: str | None, selector: str | None) -> H.Node:
    root = H.parse(html)
    found = H.select(root, selector) if selector else [root]
    return found[0] if found else root


def split_entries(text: str) -> list[tuple[str, str]]:
    """(number, body) of a running text; a full stop at the end of a body goes."""
    parts = re.split(ENTRY, text)
    return [(n, re.sub(r"\s+", " ", b).strip().rstrip(".")) for n, b in zip(parts[1::2], parts[2::2], strict=True)]


def item_entries(items: list[str]) -> list[tuple[str, str]]:
    """(number, body) of the items that start with a number; bodies keep their full stop."""
    found = (re.match(ITEM, i, re.S) for i in items)
    return [(m[1], re.sub(r"\s+", " ", m[2]).strip()) for m in found if m]


def entries_of(html: str | None, container_selector: str | None, item_selector: str | None) -> list[tuple[str, str]]:
    root = container(html, container_selector)
    if item_selector:
        return item_entries([n.text(separator=" ", strip=True) for n in H.select(root, item_selector)])
    return split_entries("\n".join(root.strings(hidden=True)))


def entries(pages: DataFrame, options: dict[str, Any], keep: tuple[str, ...] = ()) -> DataFrame:
    """pages: html and `keep`. One row per entry: keep, pos, num, raw."""
    ship(pages.sparkSession)
    box, item = options.get("container_selector"), options.get("item_selector")

    @F.pandas_udf("array<struct<num: string, raw: string>>")
    def parse(html: pd.Series) -> pd.Series:
        return pd.Series([[{"num": n, "raw": b} for n, b in entries_of(h, box, item)] for h in html])

    exploded = pages.select(*keep, F.posexplode(parse("html")).alias("pos", "e"))
    return exploded.select(*keep, "pos", "e.num", "e.raw")


def name_of(body: Column, basis_markers: list[str] | None = None, name_until: str | None = None) -> Column:
    """The part before the first bracket that opens with a marker, else before name_until; without marks at the end."""
    cut = body
    until = F.when(body.rlike(f"(?U){name_until}"), F.regexp_extract(body, f"(?Us)^(.*?)(?:{name_until})", 1)).otherwise(body) if name_until else body
    if basis_markers:
        marker = rf"[(\[]\s*(?:{'|'.join(basis_markers)})"
        cut = F.when(body.rlike(f"(?iU){marker}"), F.regexp_extract(body, f"(?iUs)^(.*?)(?:{marker})", 1)).otherwise(until)
    elif name_until:
        cut = until
    name = F.regexp_replace(T.strip(cut), r"(?U)[\s,;.]+$", "")
    return T.strip(F.regexp_replace(name, r"(?U)\s*[(\[]\s*$", ""))


def extract(body: Column, pattern: str) -> Column:
    """Group 1 of the first match if the pattern has groups, else the match; null without one."""
    group = 1 if re.compile(pattern).groups else 0
    return F.when(body.rlike(f"(?U){pattern}"), F.regexp_extract(body, f"(?U){pattern}", group))


def build_records(found: DataFrame, options: dict[str, Any], keep: tuple[str, ...] = ()) -> DataFrame:
    """num, raw, name and a column for each entry of extract; bodies under min_len characters go."""
    body = F.col("raw")
    kept = found.where(F.char_length(body) >= int(options.get("min_len", 5)))
    named = name_of(body, options.get("basis_markers"), options.get("name_until")).alias("name")
    return kept.select(*keep, "pos", "num", "raw", named, *(extract(body, p).alias(c) for c, p in (options.get("extract") or {}).items()))


def read_html_list(spark: SparkSession, html: str, options: dict[str, Any]) -> DataFrame:
    pages = spark.createDataFrame([(html,)], "html string")
    return build_records(entries(pages, options), options).withColumnRenamed("pos", "_row_ord").withColumn("_row_ord", F.col("_row_ord").cast("long"))


def read_html_table(spark: SparkSession, html: str, options: dict[str, Any]) -> DataFrame:
    """Options: match, table_index, header (row or list of rows; the last one names the columns), columns (by position, cuts to the
    lesser width), skiprows."""
    found = H.tables(html, options.get("match", ".+"))
    if not found:
        raise ValueError("no table matches")
    rows = found[options.get("table_index", 0)]
    header = options.get("header")
    width = max(map(len, rows), default=0)
    names = [str(i) for i in range(width)]
    if header is not None:
        last = max(header) if isinstance(header, list) else int(header)
        names = [*rows[last], *names[len(rows[last]) :]]
        rows = rows[last + 1 :]
    if options.get("columns"):
        names = list(options["columns"])[: min(width, len(options["columns"]))]
    rows = rows[int(options.get("skiprows", 0)) :]
    data = [(*(r[i] if i < len(r) else "nan" for i in range(len(names))), n) for n, r in enumerate(rows)]
    return spark.createDataFrame(data, ", ".join([*(f"`{n}` string" for n in names), "_row_ord long"]))
