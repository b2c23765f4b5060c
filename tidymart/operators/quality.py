"""Data-quality metrics, scorecard and gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidymart.contracts import (
    CASES_A,
    CASES_B,
    QUALITY_NOTES,
    QUALITY_TARGETS,
    RISK_COLUMNS,
    SITE_NAMES,
    SITE_PREFIX,
    STAGE_LEVEL_LIMITS,
    YEAR_RANGE,
)
from tidymart.functions import numeric


@dataclass(frozen=True)
class QualitySpec:
    """Which columns and limits the metrics look at."""

    rules: tuple[tuple[str, tuple[str, ...]], ...] = (
        (CASES_A, tuple(SITE_PREFIX + s.upper() for s in SITE_NAMES)),
        (CASES_B, RISK_COLUMNS),
    )
    ratio_marker: str = "pct_"
    stage: str = "ciclo_vida"
    level: str = "nivel_educativo"
    level_separator: str = "."
    stage_limits: Mapping[str, int | None] = field(default_factory=lambda: dict(STAGE_LEVEL_LIMITS))
    year: str = "anio"
    years: tuple[int, int] = YEAR_RANGE


def _sum(weight: Column, condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0))


def _cells(columns: Sequence[str], test, weight: Column) -> Column:
    hits = F.lit(0).cast("bigint")
    for c in columns:
        hits = hits + test(F.col(c)).cast("bigint")
    return F.sum(hits * weight)


def metric_parts(df: DataFrame, spec: QualitySpec = QualitySpec(), weight: Column | None = None) -> dict[str, Column]:
    """The sums behind the metrics, as aggregates: sums of parts of a table are those of the whole.

    ``weight`` says how many rows of the checked table one row stands for. Parts without columns to look at are absent.
    """
    weight = F.lit(1).cast("bigint") if weight is None else weight
    rows = F.sum(weight)
    parts = {"rows": rows, "filled": _cells(df.columns, lambda c: c.isNotNull(), weight), "cells": rows * len(df.columns)}
    ratios = [c for c in df.columns if spec.ratio_marker in c]
    if ratios:
        parts["ratios_valid"] = _cells(ratios, lambda c: numeric.in_range(c, 0, 1), weight)
        parts["ratios"] = rows * len(ratios)
    for k, (cases, columns) in enumerate(spec.rules):
        total = F.lit(0)
        for c in columns:
            total = total + F.coalesce(F.col(c), F.lit(0))
        empty = F.col(cases) == 0
        parts[f"empty_{k}"] = _sum(weight, empty)
        parts[f"wrong_{k}"] = _sum(weight, empty & (total != 0))
    level = numeric.leading_int(F.col(spec.level), spec.level_separator)
    passes = F.lit(False)
    for stage, limit in spec.stage_limits.items():
        same = F.col(spec.stage) == stage
        passes = passes | (same if limit is None else same & (level <= limit))
    parts["valid"] = _sum(weight, F.coalesce(passes, F.lit(False)))
    parts["leveled"] = _sum(weight, level.isNotNull())
    if spec.year in df.columns:
        year = F.col(spec.year)
        parts["timely"] = _sum(weight, numeric.in_range(year, *spec.years))
        parts["dated"] = _sum(weight, year.isNotNull())
    return parts


def metrics_of(parts: Mapping[str, Column], spec: QualitySpec = QualitySpec()) -> dict[str, Column]:
    """The metrics from their parts, which may be aggregates or columns of stored sums.

    - completitud: share of cells that are not null
    - exactitud: share of ratio cells in [0, 1]; null when there is no ratio column
    - consistencia: mean over the rules: of the rows without cases, the share whose parts sum to 0
    - unicidad (where the distinct rows are counted as ``kinds``): share of distinct full rows
    - validez: rows that pass the stage/level rule over rows with a numeric level. Stages without a limit pass even
      when the level is not a number, so the value can exceed 100
    - actualidad: rows with a year in the range over rows with a year; null when there is no year column
    """
    none = F.lit(None).cast("double")

    def share(part, whole):
        return numeric.percentage(parts[part], parts[whole]) if whole in parts else none

    rates = F.lit(0.0)
    for k in range(len(spec.rules)):
        rows, wrong = parts[f"empty_{k}"], parts[f"wrong_{k}"]
        rates = rates + F.when(rows == 0, F.lit(1.0)).otherwise(
            1 - F.try_divide(wrong.cast("double"), rows.cast("double"))
        )
    metrics = {
        "completitud": share("filled", "cells"),
        "exactitud": share("ratios_valid", "ratios"),
        "consistencia": numeric.round_half_even(rates / len(spec.rules) * 100, 2),
        "validez": share("valid", "leveled"),
        "actualidad": share("timely", "dated"),
    }
    if "kinds" in parts:
        metrics["unicidad"] = share("kinds", "rows")
    return metrics


def row_metrics(df: DataFrame, spec: QualitySpec = QualitySpec(), weight: Column | None = None) -> dict:
    """The metrics that one pass over the rows gives, as aggregate expressions; for ``weight`` see :func:`metric_parts`."""
    return metrics_of(metric_parts(df, spec, weight), spec)


def quality_metric(df: DataFrame, name: str, spec: QualitySpec = QualitySpec()) -> DataFrame:
    """One metric as a one-row table; a single pass without a shuffle of rows."""
    if name == "unicidad":
        return uniqueness(df)
    return df.agg(row_metrics(df, spec)[name].alias(name))


def uniqueness(df: DataFrame) -> DataFrame:
    """Share of distinct full rows."""
    kinds = df.groupBy(*df.columns).agg(F.count("*").alias("__n"))
    return kinds.agg(numeric.percentage(F.count("*"), F.sum("__n")).alias("unicidad"))


def quality_metrics(df: DataFrame, spec: QualitySpec = QualitySpec()) -> DataFrame:
    """All six metrics as one row.

    Uniqueness needs the distinct rows with their multiplicity. The other metrics are computed
    from that same result, weighted, so the input is read and shuffled once.
    """
    kinds = df.groupBy(*df.columns).agg(F.count("*").alias("__n"))
    metrics = metrics_of(metric_parts(df, spec, F.col("__n")) | {"kinds": F.count("*")}, spec)
    return kinds.agg(*(metrics[m].alias(m) for m in QUALITY_TARGETS))


def quality_parts(df: DataFrame, by: str, spec: QualitySpec = QualitySpec()) -> DataFrame:
    """The parts of all six metrics for each value of a column, as a table to be stored.

    A row belongs to one value, so distinct rows add up, too; :func:`stored_metrics` reads the table.
    """
    kinds = df.groupBy(*df.columns).agg(F.count("*").alias("__n"))
    parts = metric_parts(df, spec, F.col("__n")) | {"kinds": F.count("*")}
    return kinds.groupBy(by).agg(*(column.alias(name) for name, column in parts.items()))


def stored_metrics(parts: DataFrame, by: str, spec: QualitySpec = QualitySpec()) -> DataFrame:
    """All six metrics as one row, from stored parts: the rows behind them are not read."""
    names = [c for c in parts.columns if c != by]
    sums = parts.agg(*(F.sum(c).alias(c) for c in names))
    metrics = metrics_of({c: F.col(c) for c in names}, spec)
    return sums.select(*(metrics[m].alias(m) for m in QUALITY_TARGETS))


def quality_scorecard(
    df: DataFrame, spec: QualitySpec = QualitySpec(), targets: Mapping = QUALITY_TARGETS
) -> DataFrame:
    """Six rows: metric, value, target, pass flag, observation."""
    return scorecard_of(quality_metrics(df, spec), targets)


def scorecard_of(metrics: DataFrame, targets: Mapping = QUALITY_TARGETS) -> DataFrame:
    """The scorecard from the one row of metrics."""
    names = list(targets)
    rows = metrics.unpivot([], names, "metrica", "valor")
    lines = None
    for name, (target, exact) in targets.items():
        value = F.col("valor")
        passed = F.coalesce(value == target if exact else value >= target, F.lit(False))
        full, partial = QUALITY_NOTES[name]
        line = F.struct(
            F.lit(target).cast("double").alias("meta"),
            passed.alias("cumple"),
            F.when(value == 100, full).otherwise(partial).alias("observaciones"),
        )
        lines = F.when(F.col("metrica") == name, line) if lines is None else lines.when(
            F.col("metrica") == name, line
        )
    return rows.withColumn("line", lines).select("metrica", "valor", "line.*")


def quality_gate(scorecard: DataFrame, enforce: bool = False) -> DataFrame:
    """One row: approved or warning, and the metrics that fail. ``enforce`` makes a failure raise."""
    failing = F.array_sort(F.collect_list(F.when(~F.col("cumple"), F.col("metrica"))))
    gate = scorecard.agg(
        F.every("cumple").alias("aprobado"),
        F.when(F.every("cumple"), "APROBADO").otherwise("ADVERTENCIAS").alias("estado"),
        F.array_join(failing, ",").alias("no_cumplen"),
    )
    if not enforce:
        return gate
    message = F.concat(F.lit("quality gate: "), F.col("no_cumplen"))
    return gate.withColumn("aprobado", F.when(F.col("aprobado"), True).otherwise(F.raise_error(message).cast("boolean")))
