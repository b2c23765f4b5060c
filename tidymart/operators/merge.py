"""Join of two tidy tables, derived ratios and match diagnostics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidymart.contracts import (
    CASES,
    CASES_A,
    CASES_B,
    CLASS_COLUMN,
    KEY,
    RISK_COLUMNS,
    SITE_PREFIX,
)
from tidymart.functions import numeric, text
from tidymart.operators.schema import columns_with_prefix, present_columns, rename_if_absent
from tidymart.sources.files import read_csv

HOW = {"inner": "inner", "left": "left", "right": "right", "outer": "full_outer"}


def prepare(df: DataFrame, cases: str, measures: Sequence[str], refold: bool) -> DataFrame:
    """Name the case count and, for tables that come from outside, fold and coerce again."""
    df = rename_if_absent(df, CASES, cases)
    if not refold:
        return df
    texts = [
        f.name
        for f in df.schema.fields
        if f.name in (*KEY, CLASS_COLUMN) and f.dataType.typeName() == "string"
    ]
    counts = present_columns(df, (cases, *measures))
    plain = df.withColumns(
        {c: text.lowered(F.col(c)) for c in texts} | {c: numeric.to_count(F.col(c)) for c in counts}
    )
    if "anio" in texts:
        texts.remove("anio")
        plain = plain.withColumn("anio", numeric.to_year(F.col("anio")))
    return plain.withColumns({c: text.unaccent(F.col(c)) for c in texts})


def merge_key(a: DataFrame, b: DataFrame, with_class: bool = False) -> list[str]:
    shared_class = CLASS_COLUMN in a.columns and CLASS_COLUMN in b.columns
    return [*KEY, CLASS_COLUMN] if with_class and shared_class else list(KEY)


def join_on_key(
    a: DataFrame,
    b: DataFrame,
    key: Sequence[str],
    how: str = "inner",
    null_safe: Sequence[str] = (),
    suffixes: tuple[str, str] = ("_spa", "_sui"),
) -> DataFrame:
    """Equi-join that keeps one copy of the key and tells other shared columns apart.

    Columns in ``null_safe`` match null with null.
    """
    clash = [c for c in a.columns if c in b.columns and c not in key]
    a = a.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    b = b.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    if not null_safe:
        return a.join(b, list(key), HOW[how])
    left, right = a.alias("a"), b.alias("b")
    same = [
        F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) if c in null_safe else F.col(f"a.{c}") == F.col(f"b.{c}")
        for c in key
    ]
    joined_key = (F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in key)
    return left.join(right, same, HOW[how]).select(
        *joined_key,
        *(F.col(f"a.{c}") for c in a.columns if c not in key),
        *(F.col(f"b.{c}") for c in b.columns if c not in key),
    )


def add_ratios(df: DataFrame, sites: Sequence[str], risks: Sequence[str]) -> DataFrame:
    """``pct_*``: risks over the cases of B, sites over the cases of A."""
    ratios = {}
    if CASES_B in df.columns:
        ratios |= {f"pct_{c}": numeric.safe_ratio(F.col(c), F.col(CASES_B)) for c in risks}
    if CASES_A in df.columns:
        ratios |= {f"pct_{c.lower()}": numeric.safe_ratio(F.col(c), F.col(CASES_A)) for c in sites}
    return df.withColumns(ratios) if ratios else df


def merge_sources(
    a: DataFrame,
    b: DataFrame,
    how: str = "inner",
    with_class: bool = False,
    ratios: bool = True,
    site_prefix: str = SITE_PREFIX,
    risk_columns: Sequence[str] = RISK_COLUMNS,
    refold: bool = True,
    null_safe: Sequence[str] = ("anio",),
) -> DataFrame:
    """Join two tidy tables on the shared key and derive the ratios.

    Tables made by :func:`tidymart.operators.tidy.tidy` in the same job are clean and have no
    null key; for them pass ``refold=False, null_safe=()`` to save the work.
    """
    sites = columns_with_prefix(a, site_prefix)
    risks = present_columns(b, risk_columns)
    a = prepare(a, CASES_A, sites, refold)
    b = prepare(b, CASES_B, risks, refold)
    merged = join_on_key(a, b, merge_key(a, b, with_class), how, null_safe)
    measures = present_columns(merged, [*sites, *risks, CASES_A, CASES_B])
    if how != "inner":
        merged = merged.fillna(0, subset=measures)
    if not ratios:
        return merged
    return add_ratios(merged, present_columns(merged, sites), present_columns(merged, risks))


def load_and_merge(spark: SparkSession, a_csv: str, b_csv: str, **options) -> DataFrame:
    """Merge two tidy tables that lie as CSV files."""
    return merge_sources(read_csv(spark, a_csv), read_csv(spark, b_csv), **options)


def merge_qc(
    a: DataFrame,
    b: DataFrame,
    how: str = "inner",
    with_class: bool = False,
    refold: bool = True,
) -> DataFrame:
    """Row counts of both sides and of their join, and the rows without a partner.

    A key with m rows on one side and n on the other joins to m*n rows, so counting both sides
    per key answers everything: one union, one aggregation, no join.
    """
    a, b = prepare(a, CASES_A, (), refold), prepare(b, CASES_B, (), refold)
    key = merge_key(a, b, with_class)

    def side(df, in_a, in_b):
        return df.select(*key, F.lit(in_a).alias("in_a"), F.lit(in_b).alias("in_b"))

    per_key = (
        side(a, 1, 0)
        .unionByName(side(b, 0, 1))
        .groupBy(*key)
        .agg(F.sum("in_a").alias("na"), F.sum("in_b").alias("nb"))
    )
    only_a = F.coalesce(F.sum(F.when(F.col("nb") == 0, F.col("na"))), F.lit(0))
    only_b = F.coalesce(F.sum(F.when(F.col("na") == 0, F.col("nb"))), F.lit(0))
    matched = F.coalesce(F.sum(F.col("na") * F.col("nb")), F.lit(0))
    merged = {
        "inner": matched,
        "left": matched + only_a,
        "right": matched + only_b,
        "outer": matched + only_a + only_b,
    }[how]
    return per_key.agg(
        F.coalesce(F.sum("na"), F.lit(0)).alias("rows_spa"),
        F.coalesce(F.sum("nb"), F.lit(0)).alias("rows_sui"),
        merged.alias("rows_merged"),
        only_a.alias("spa_without_match"),
        only_b.alias("sui_without_match"),
        F.lit(",".join(key)).alias("key_used"),
    )
