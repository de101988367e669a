"""Content signatures of sources, and their comparison with a baseline."""

from __future__ import annotations

import hashlib
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What tells a change, by method.
KEYS = {"http_headers": ("etag", "last_modified", "content_length"), "api_registry": ("registry_last_modified", "size"), "content": ("count", "hash")}


def row_text(df: DataFrame) -> Column:
    """All cells as text with | between; null is nan."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("nan")) for c in df.columns if not c.startswith("_")]
    return F.concat_ws("|", *cells)


def content_signature(df: DataFrame) -> dict[str, Any]:
    """count, and the first 16 hex digits of the SHA-1 of the sorted rows: order-free, sensitive to repeated rows. The rows are sorted
    on the cluster and pass the driver one partition at a time; an empty frame hashes to what its column names give."""
    names = [c for c in df.columns if not c.startswith("_")]
    digest, n = hashlib.sha1(), 0
    for (line,) in df.select(row_text(df).alias("line")).orderBy("line").toLocalIterator():
        digest.update(("\n" if n else "").encode() + line.encode())
        n += 1
    if not n:
        digest.update("\n".join(sorted(names)).encode())
    return {"count": n, "hash": digest.hexdigest()[:16]}


def parallel_signature(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """count and an order-free hash (sum of row hashes) per group, in one pre-aggregated pass at any size. It is no SHA-1 of sorted
    rows: compare it with its own kind only."""
    data = [c for c in df.columns if not c.startswith("_") and c not in (by or [])]
    line = F.concat_ws("|", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("nan")) for c in data))
    word = F.conv(F.substring(F.sha1(line), 1, 12), 16, 10).cast("decimal(38,0)")
    return df.groupBy(*(by or [])).agg(F.count("*").alias("count"), F.sum(word).cast("string").alias("hash"))


def sums_signature(df: DataFrame) -> DataFrame:
    """parallel_signature as one row with a map `signature`. Its kind is part of it: a baseline of another kind tells nothing."""
    found = parallel_signature(df)
    return found.select(F.create_map(F.lit("kind"), F.lit("sums"), F.lit("count"), F.col("count").cast("string"), F.lit("hash"), F.coalesce("hash", F.lit("0"))).alias("signature"))


def changed(method: Column, current: Column, base: Column) -> Column:
    """Whether any key of the method differs between two map columns; null equals null."""
    out = F.lit(None).cast("boolean")
    for name, keys in KEYS.items():
        differs = F.lit(False)
        for k in keys:
            differs = differs | ~F.element_at(current, k).eqNullSafe(F.element_at(base, k))
        out = F.when(method == name, differs).otherwise(out)
    return F.coalesce(out, F.lit(False))


def statuses(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """current: name, method, signature, error; baseline: name, signature. Adds baseline and status: error, new, changed or unchanged.
    A baseline whose content was signed in another way is none."""
    joined = current.join(baseline.select("name", F.col("signature").alias("baseline")), "name", "left")
    other = (F.col("method") == "content") & ~F.element_at("signature", "kind").eqNullSafe(F.element_at("baseline", "kind"))
    joined = joined.withColumn("baseline", F.when(~F.coalesce(other, F.lit(False)), F.col("baseline")))
    status = F.when(F.col("error").isNotNull(), "error").when(F.col("baseline").isNull(), "new")
    status = status.when(changed(F.col("method"), F.col("signature"), F.col("baseline")), "changed").otherwise("unchanged")
    return joined.withColumn("status", status)
