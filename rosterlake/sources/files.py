"""Files as frames of text columns, with the row's place in `_row_ord`."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S


SPARK_ENCODINGS = ("iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32", "utf-8")


def _placed(df: DataFrame) -> DataFrame:
    return df.withColumn("_row_ord", F.monotonically_increasing_id())


def read_csv(spark: SparkSession, path: str, options: dict[str, Any]) -> DataFrame:
    """All texts; an empty cell is the empty text, not null. Encodings that Spark's reader doesn't know (old code pages) are decoded
    file by file on the executors first."""
    encoding = options.get("encoding", "utf-8").lower()
    known = encoding in SPARK_ENCODINGS
    csv = {"header": True, "inferSchema": False, "sep": options.get("sep", ","), "multiLine": True, "quote": '"', "escape": '"', "enforceSchema": False}
    if known:
        df = spark.read.options(**csv, encoding=encoding).csv(path)
    else:
        whole = spark.read.format("binaryFile").load(path).select(F.col("content"))
        lines = whole.rdd.flatMap(lambda r: bytes(r[0]).decode(encoding).splitlines())
        df = spark.read.options(**csv).csv(lines)
    return _placed(df.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns)))


def flat_columns(schema: S.StructType, prefix: str = "", path: str = "") -> list[Column]:
    """Leaves of nested structs as text columns named by their dotted path; lists stay one cell, as JSON."""
    out = []
    for f in schema.fields:
        name, at = f"{prefix}{f.name}", f"{path}`{f.name}`"
        if isinstance(f.dataType, S.StructType):
            out += flat_columns(f.dataType, f"{name}.", f"{at}.")
        elif isinstance(f.dataType, S.ArrayType | S.MapType):
            out.append(F.to_json(F.col(at)).alias(name))
        else:
            out.append(F.col(at).cast("string").alias(name))
    return out


def flatten_records(df: DataFrame) -> DataFrame:
    """(_row_ord, record as JSON text) to flat text columns; the schema is the union of what the records have, read as text."""
    records = df.select("record")
    schema = df.sparkSession.read.options(primitivesAsString=True).json(records.rdd.map(lambda r: r[0])).schema
    parsed = df.select("_row_ord", F.from_json("record", schema).alias("r"))
    return parsed.select(*flat_columns(schema, path="r."), "_row_ord")


def read_json(spark: SparkSession, path: str, options: dict[str, Any]) -> DataFrame:
    """One document whose records lie under records_path; values are read as text, so 5 stays 5."""
    df = spark.read.options(multiLine=True, primitivesAsString=True).json(path)
    names = options.get("records_path")
    if names:
        column = F.col(".".join(f"`{n}`" for n in names.split(".")))
        kind = df.select(column.alias("r")).schema["r"].dataType
        if isinstance(kind, S.ArrayType):
            df = df.select(F.posexplode(column).alias("_row_ord", "r"))
        else:
            df = df.select(F.lit(0).alias("_row_ord"), column.alias("r"))
        inner = df.schema["r"].dataType
        return df.select(*flat_columns(inner, path="r."), F.col("_row_ord").cast("long").alias("_row_ord"))
    return _placed(df).select(*flat_columns(df.schema), "_row_ord")


def read_xml(spark: SparkSession, path: str, options: dict[str, Any]) -> DataFrame:
    """Each record_tag element (or the last step of xpath) is a row; attributes have plain names."""
    tag = options.get("record_tag") or str(options.get("xpath", "record")).rstrip("/").split("/")[-1] or "record"
    df = spark.read.options(rowTag=tag, attributePrefix="", inferSchema=False).xml(path)
    return _placed(df.select(*flat_columns(df.schema)))


def read_excel(spark: SparkSession, path: str, options: dict[str, Any]) -> DataFrame:
    """Sheets as texts (leading zeros stay), read by pandas; a workbook fits one process. A url is downloaded, or searched for its
    first link to a workbook with find_link_on_page."""
    import io
    from urllib.parse import urljoin

    import pandas as pd

    from ..functions.html import parse
    from .http import fetch

    source: Any = path
    if path.lower().startswith(("http://", "https://")):
        if options.get("find_link_on_page"):
            endings = tuple(options.get("link_extensions", (".xlsx", ".xls")))
            links = [n.attrs["href"] for n in parse(fetch(path, options=options).text()).walk() if n.tag == "a" and "href" in n.attrs]
            hit = next((h for h in links if h.lower().split("?")[0].endswith(endings)), None)
            if hit is None:
                raise ValueError(f"no link to {endings} on {path}")
            path = urljoin(path, hit)
        source = io.BytesIO(fetch(path, options=options).content)
    frame = pd.read_excel(source, sheet_name=options.get("sheet_name", 0), header=options.get("header", 0), dtype=str, engine=options.get("engine"))
    frame.columns = [str(c) for c in frame.columns]
    rows = [(*(None if pd.isna(v) else v for v in r), i) for i, r in enumerate(frame.itertuples(index=False))]
    schema = S.StructType([*(S.StructField(c, S.StringType()) for c in frame.columns), S.StructField("_row_ord", S.LongType())])
    return spark.createDataFrame(rows, schema)
