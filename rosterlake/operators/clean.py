"""From a raw source to clean rows: mapping, cells, constants; union; normalization; quality; duplicates.

Row order is part of the results, and Spark has none: `_src_ord` (place of the source) and `_row_ord` (place in the source) carry it
from the scan on.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MergeConfig, NormalizationConfig, QualityConfig, SourceConfig
from ..functions import text as T

ORDER = ("_src_ord", "_row_ord")


def _data(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ORDER]


def apply_mapping(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Selected and renamed columns in the order of the mapping; targets without a source column are null and come last."""
    if not mapping:
        return df
    order = [F.col(c) for c in ORDER if c in df.columns]
    present = [F.col(f"`{s}`").alias(d) for s, d in mapping.items() if s in df.columns]
    have = {d for s, d in mapping.items() if s in df.columns}
    missing = dict.fromkeys(d for d in mapping.values() if d not in have)
    return df.select(*present, *(F.lit(None).cast("string").alias(d) for d in missing), *order)


def clean_source(df: DataFrame, source: SourceConfig) -> DataFrame:
    """Mapped, cleaned rows that are not all null, with constants (not cleaned, over mapped ones) and the source's name."""
    mapped = apply_mapping(df, source.mapping)
    cells = _data(mapped)
    cleaned = mapped.select(*(T.clean_cell(F.col(f"`{c}`")).alias(c) for c in cells), *(c for c in ORDER if c in mapped.columns))
    cleaned = cleaned.na.drop(how="all", subset=cells) if cells else cleaned
    constants = source.options.get("constants") or {}
    return cleaned.withColumns({c: F.lit(v).cast("string") for c, v in constants.items()} | {"source": F.lit(source.name)})


def combine(frames: list[DataFrame]) -> DataFrame | None:
    """Union by name in first-seen column order; each frame's place becomes `_src_ord`."""
    marked = [f.withColumn("_src_ord", F.lit(i)) for i, f in enumerate(frames)]
    if not marked:
        return None
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    return out.select(*_data(out), *(c for c in ORDER if c in out.columns))


def normalize_columns(df: DataFrame, cfg: NormalizationConfig) -> DataFrame:
    steps = [
        (cfg.date_fields, T.normalize_date),
        (cfg.phone_fields, T.normalize_phone),
        (cfg.id_fields, T.normalize_id),
        ([c for c in cfg.text_fields if c not in cfg.id_fields], T.normalize_address),
        (cfg.uppercase_fields, lambda c: F.upper(F.col(c))),
    ]
    for names, rule in steps:
        df = df.withColumns({c: rule(c) for c in names if c in df.columns})
    return df


@dataclass
class QualityReport:
    total_rows: int = 0
    duplicates_removed: int = 0
    dropped_empty: int = 0
    dropped_filled: int = 0
    missing_required: dict[str, int] = field(default_factory=dict)
    pattern_violations: dict[str, int] = field(default_factory=dict)

    def as_text(self) -> str:
        # The wording of the report.
        lines = [
            "===== Отчёт о качестве данных =====",
            f"Итоговых строк:           {self.total_rows}",
            f"Удалено дубликатов:       {self.duplicates_removed}",
            f"Удалено пустых (по ключу): {self.dropped_empty}",
            f"Удалено по стоп-полю:      {self.dropped_filled}",
        ]
        if self.missing_required:
            lines += ["Пропуски в обязательных полях:", *(f"   - {c}: {n}" for c, n in self.missing_required.items())]
        if self.pattern_violations:
            lines += ["Нарушения шаблонов (regex):", *(f"   - {c}: {n}" for c, n in self.pattern_violations.items())]
        return "\n".join(lines)


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def keep_conditions(df: DataFrame, cfg: QualityConfig) -> tuple[Column, Column]:
    """(not empty where it must not be, not filled and not matching where it must not be)."""
    not_empty = _all([T.filled(c) for c in cfg.drop_if_empty if c in df.columns])
    free = [~F.coalesce(T.filled(c), F.lit(False)) for c in cfg.drop_if_filled if c in df.columns]
    free += [~F.coalesce(F.col(c).rlike(f"(?iU){p}"), F.lit(False)) for c, p in cfg.drop_if_matches.items() if c in df.columns]
    return F.coalesce(not_empty, F.lit(False)), _all(free)


def quality_filter(df: DataFrame, cfg: QualityConfig) -> DataFrame:
    not_empty, free = keep_conditions(df, cfg)
    return df.where(not_empty & free)


def quality_counts(df: DataFrame, cfg: QualityConfig) -> DataFrame:
    """One row with all counters, from one pass: dropped_empty, dropped_filled, total_rows, missing__*, violations__*."""
    not_empty, free = keep_conditions(df, cfg)
    kept = not_empty & free
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    out = [count(~not_empty).alias("dropped_empty"), count(not_empty & ~free).alias("dropped_filled"), count(kept).alias("total_rows")]
    out += [count(kept & F.col(c).isNull()).alias(f"missing__{c}") for c in cfg.required_fields if c in df.columns]
    out += [count(kept & F.col(c).isNotNull() & ~F.col(c).rlike(f"(?U)^(?:{p})")).alias(f"violations__{c}") for c, p in cfg.patterns.items() if c in df.columns]
    return df.agg(*out)


def quality_report(df: DataFrame, cfg: QualityConfig) -> QualityReport:
    row = quality_counts(df, cfg).first().asDict()
    named = lambda head: {k.removeprefix(head): n for k, n in row.items() if k.startswith(head) and n}
    return QualityReport(row["total_rows"], 0, row["dropped_empty"], row["dropped_filled"], named("missing__"), named("violations__"))


def deduplicate(df: DataFrame, cfg: MergeConfig) -> DataFrame:
    """One row per normalized key: the first, the last, or (keep False) only rows without a duplicate. Combined columns list the
    group's distinct values in the order of their first appearance.

    Both parts are pre-aggregated: the kept row as a minimum or maximum over its order, the values once per key and value."""
    keys = [c for c in cfg.deduplicate_on if c in df.columns]
    if not keys:
        return df
    combined = [c for c in cfg.combine_columns if c in df.columns]
    names = [f"__key{i}" for i in range(len(keys))]
    keyed = df.withColumns({n: T.dedup_key(c) for n, c in zip(names, keys, strict=True)})
    order = F.struct(*ORDER)
    pick = F.max_by if cfg.keep == "last" else F.min_by
    rows = keyed.groupBy(*names).agg(pick(F.struct(*df.columns), order).alias("__row"), F.count("*").alias("__n"))
    if cfg.keep is False:
        rows = rows.where("__n = 1")
    out = rows.select(*names, "__row.*")
    for c in combined:
        value = T.strip(c)
        seen = keyed.where(value.isNotNull() & (value != "") & (F.lower(value) != "nan"))
        seen = seen.groupBy(*names, value.alias("__value")).agg(F.min(order).alias("__at"))
        lists = seen.groupBy(*names).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__at", "__value"))), lambda x: x["__value"]), "; ").alias("__all"))
        out = out.join(lists, names, "left").withColumn(c, F.coalesce("__all", F.lit(""))).drop("__all")
    return out.select(*df.columns)
