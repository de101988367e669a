"""Helpers that the corpus operators share: table access, durable cuts of lineage, Arrow batching."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from ..storage import Scratch, materialize

#: A batch is worked off in slices of about so many characters, which bounds the numpy temporaries of a task.
SLICE_CHARS = 500_000
#: Bytes of an Arrow batch that Spark sends to a worker.
BATCH_BYTES = 8 << 20
#: Bytes up to which the rows that a step looks up are broadcast.
BROADCAST_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ddl_of(df: DataFrame) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)


def with_rows_of(docs: DataFrame, rows: DataFrame, how: str, size: Column | int = 64) -> DataFrame:
    """docs joined by doc_id with rows, which are written and then broadcast only if they take at most BROADCAST_BYTES; size: bytes of
    a row in memory, an upper bound. Beyond that both sides are shuffled."""
    rows = materialize(rows, "rows-by-doc")
    return docs.join(sized(rows, size), "doc_id", how)


def sized(rows: DataFrame, size: Column | int = 64) -> DataFrame:
    """rows (written ones), marked for a broadcast if they are small enough for it."""
    total = rows.count() * size if isinstance(size, int) else rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(rows) if total <= BROADCAST_BYTES else rows


def trim() -> None:
    """Gives freed memory back to the system, where the C library can."""
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], ddl: str) -> DataFrame:
    """df.mapInArrow, after this package has been sent to the executors. Batches of long texts are bounded by bytes (a session's
    own setting under the bound stays), and workers, which Spark keeps for later tasks, return their memory."""
    spark = df.sparkSession
    ship(spark)
    given = re.fullmatch(r"(\d+)b?", spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"))
    if given and not 0 < int(given[1]) <= BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        yield from function(batches)
        trim()

    return df.mapInArrow(run, ddl)


def text_slices(texts: list[str | None], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges [a, b) of consecutive texts holding about `limit` characters; one long text makes a range of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
