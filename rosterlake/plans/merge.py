"""A merge run: load, clean and gate each source, union, normalize, filter, deduplicate, gate, export."""

from __future__ import annotations

import argparse
import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AppConfig, load_config
from ..operators import clean
from ..sources import sinks
from ..sources.loaders import load
from ..storage import materialize


@dataclass
class Merged:
    rows: DataFrame
    report: clean.QualityReport


def collect_sources(spark: SparkSession, cfg: AppConfig) -> list[DataFrame]:
    """Clean frames of the sources that work. Spark is lazy, so each one is written here: an error leaves out its source alone, and so
    does a count under min_rows."""
    log = sinks.setup_logger(cfg.logging.directory, cfg.logging.level)
    frames = []
    for source in cfg.sources:
        try:
            cleaned = materialize(clean.clean_source(load(spark, source), source), "source")
            n, least = cleaned.count(), int(source.options.get("min_rows", 0))
            if n < least:
                log.error("[%s] left out: %d rows, at least %d are expected", source.name, n, least)
                continue
            frames.append(cleaned)
            log.info("[%s] %d rows", source.name, n)
        except Exception:
            log.exception("[%s] left out", source.name)
    return frames


def merge(frames: list[DataFrame], cfg: AppConfig) -> Merged:
    """Quality comes before deduplication, so that an excluded row can't displace an active one."""
    combined = materialize(clean.normalize_columns(clean.combine(frames), cfg.normalization), "combined")
    report = clean.quality_report(combined, cfg.quality)
    rows = materialize(clean.deduplicate(clean.quality_filter(combined, cfg.quality), cfg.merge), "merged")
    n = rows.count()
    report.duplicates_removed, report.total_rows = report.total_rows - n, n
    return Merged(rows, report)


def run(spark: SparkSession, cfg: AppConfig) -> int:
    """0: exported; 1: no source; 2: fewer rows than min_total_rows, nothing written."""
    log = sinks.setup_logger(cfg.logging.directory, cfg.logging.level)
    frames = collect_sources(spark, cfg)
    if not frames:
        log.error("no source could be loaded")
        return 1
    merged = merge(frames, cfg)
    log.info("\n%s", merged.report.as_text())
    if merged.report.total_rows < cfg.quality.min_total_rows:
        log.error("nothing exported: %d rows, at least %d are expected", merged.report.total_rows, cfg.quality.min_total_rows)
        return 2
    log.info("written: %s", ", ".join(sinks.export(merged.rows, cfg.database)))
    sinks.write_notice(cfg.database.directory, [(s.name, s.path) for s in cfg.sources])
    return 0


def gate_sources(df: DataFrame, minimums: dict[str, int]) -> DataFrame:
    """The same gate on one combined frame: rows of sources that have enough of them."""
    least = F.coalesce(*(F.when(F.col("source") == s, n) for s, n in minimums.items()), F.lit(0)) if minimums else F.lit(0)
    good = df.groupBy("source").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("source")
    return df.join(good, "source", "left_semi")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Merge published lists into one.")
    parser.add_argument("--config", "-c", default="config.yaml")
    args = parser.parse_args(argv)
    try:
        return run(SparkSession.builder.getOrCreate(), load_config(args.config))
    except Exception:
        sinks.setup_logger().exception("the run failed")
        return 1


if __name__ == "__main__":
    sys.exit(main())
