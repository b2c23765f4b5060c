"""Column selection and contract checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def select_rename(df: DataFrame, rename: Mapping[str, str], required: Iterable[str]) -> DataFrame:
    """Keep the expected columns that exist, under their new names."""
    require_columns(df, required)
    return df.select(*(F.col(c).alias(n) for c, n in rename.items() if c in df.columns))


def columns_with_prefix(df: DataFrame, prefix: str, ignore_case: bool = False) -> list[str]:
    if ignore_case:
        return [c for c in df.columns if c.upper().startswith(prefix.upper())]
    return [c for c in df.columns if c.startswith(prefix)]


def present_columns(df: DataFrame, candidates: Iterable[str]) -> list[str]:
    return [c for c in candidates if c in df.columns]


def first_existing(df: DataFrame, candidates: Iterable[str]) -> Column | None:
    return next((F.col(c) for c in candidates if c in df.columns), None)


def rename_if_absent(df: DataFrame, old: str, new: str) -> DataFrame:
    if old in df.columns and new not in df.columns:
        return df.withColumnRenamed(old, new)
    return df


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, violations) for columns that must not be null; one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.unpivot([], list(columns), "column", "violations")


def unique_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")


def fk_orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a dimension row, with the number of fact rows that use them."""
    used = fact.groupBy(key).agg(F.count("*").alias("rows"))
    return used.join(dimension.select(key), key, "left_anti")


def check_rows(
    df: DataFrame, not_null: Mapping[str, str], unique: Sequence[str], foreign: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The rows with the ``reason`` for which a table with these constraints refuses them (null: none) and ``copies``.

    ``not_null`` gives the reason for each column that must not be null, ``unique`` the key that must not repeat, and
    ``foreign`` for each column the table whose column of that name must hold its value. The first broken constraint
    counts, in this order: null, foreign key, repeated key. Identical rows are one row with their number as
    ``copies``. Of the rows that share a key and break nothing else the least is accepted, once; the others, and
    the rest of its copies, are refused as ``repeated key``. As in a database, a key with a null in it repeats no other.

    Copies and the least row are found by partial sums in the map tasks, so a key that holds many rows reaches the
    next step as one row per task. Referenced tables are written ones, which the planner broadcasts if they are small.
    """
    rows = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    reason = F.lit(None).cast("string")
    for column, said in reversed(list(not_null.items())):
        reason = F.when(F.col(column).isNull(), said).otherwise(reason)
    rows = rows.withColumn("reason", reason)
    for k, (column, table) in enumerate((foreign or {}).items()):
        known = table.select(F.col(column).alias(f"__f{k}")).distinct()
        rows = rows.join(known, F.col(column) == F.col(f"__f{k}"), "left")
        orphan = F.col(column).isNotNull() & F.col(f"__f{k}").isNull() & F.col("reason").isNull()
        rows = rows.withColumn("reason", F.when(orphan, f"no row for {column}").otherwise(F.col("reason"))).drop(f"__f{k}")
    others = [c for c in df.columns if c not in unique]
    measures = F.struct(*others) if others else F.struct(F.lit(0).alias("__none"))
    sound = rows.where(F.col("reason").isNull()).groupBy(*unique).agg(F.min(measures).alias("__least"))
    rows = rows.join(sound, list(unique), "left")
    least = F.coalesce(measures.eqNullSafe(F.col("__least")), F.lit(False))
    partial = F.lit(False)
    for c in unique:
        partial = partial | F.col(c).isNull()
    kinds = F.when(partial | F.col("reason").isNotNull(), F.array(_kind(F.col("reason"), F.col("copies")))).otherwise(
        F.array(
            _kind(F.lit(None), F.when(least, 1).otherwise(0)),
            _kind(F.lit("repeated key"), F.col("copies") - F.when(least, 1).otherwise(0)),
        )
    )
    split = rows.select(*df.columns, F.inline(F.filter(kinds, lambda x: x["copies"] > 0)))
    return split.select(*df.columns, "reason", "copies")


def _kind(reason: Column, copies: Column) -> Column:
    return F.struct(reason.cast("string").alias("reason"), copies.cast("bigint").alias("copies"))
