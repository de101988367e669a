"""Incremental screening with Structured Streaming: new page files are screened once; the checkpoint is the set of pages done."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.html import visible
from ..plans.screen import screen
from ..shipping import ship

PAGE_SCHEMA = "page_id long, url string, html string"


def screen_stream(spark: SparkSession, pages_dir: str, patterns: DataFrame, findings_dir: str, checkpoint: str, max_files: int = 100, fuzzy_options: dict[str, Any] | None = None) -> StreamingQuery:
    """Reads Parquet files of pages as they come and appends findings. A batch writes to a folder of its own number in overwrite
    mode, so that a batch that is run again replaces its findings, and a run adds to those of earlier ones.
    With fuzzy_options, hits by similarity are found as in screen()."""
    ship(spark)
    pages = spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(pages_dir)

    def one(batch: DataFrame, number: int) -> None:
        seen = batch.withColumn("v", visible(F.col("html"))).select("url", "v.title", "v.text").dropDuplicates(["url"])
        screen(seen, patterns, fuzzy_options).write.mode("overwrite").parquet(f"{findings_dir}/batch={number}")

    return pages.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
