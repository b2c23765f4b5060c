"""Distinct counts and quantiles that are kept per load and merged, so that earlier rows are not read again.

A load stores one small sketch per column. Sketches of the same settings merge without loss: the sketch of the union
of loads has the error of a sketch over all their rows, however many loads there are. Exact counts and quantiles
remain in :mod:`tidymart.operators.profile`; they read all rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Logarithm of the buckets of a distinct sketch; a sketch has at most 2**12 * 8 bits.
LG_BUCKETS = 12
#: Size parameter of a quantile sketch.
QUANTILE_SIZE = 800
DISTINCT, QUANTILES = "distinct", "quantiles"
_SCHEMA = "kind string, column string, sketch binary"


def distinct_error(lg_buckets: int = LG_BUCKETS) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / math.sqrt(1 << lg_buckets)


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """By how much the rank of a quantile is off, as a share of all rows, in 99 of 100 cases."""
    return 2.446 / size**0.9433


def sketch_columns(
    df: DataFrame,
    distinct: Sequence[str] = (),
    quantiles: Sequence[str] = (),
    lg_buckets: int = LG_BUCKETS,
    size: int = QUANTILE_SIZE,
) -> DataFrame:
    """(kind, column, sketch) of a load, in one pass; what is shuffled is one sketch per task and column.

    Nulls are not counted. Values are counted as texts and quantiles taken of doubles; NaN has no rank and is left out.
    A load without values has an empty sketch, which merges as nothing.
    """

    def number(c: str) -> Column:
        value = F.col(c).cast("double")
        return F.when(~F.isnan(value), value)

    lines = {(DISTINCT, c): F.hll_sketch_agg(F.col(c).cast("string"), lg_buckets) for c in distinct}
    lines |= {(QUANTILES, c): F.kll_sketch_agg_double(number(c), size) for c in quantiles}
    row = df.agg(*(sketch.alias(f"__{i}") for i, sketch in enumerate(lines.values())))
    each = (
        F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("column"), F.col(f"__{i}").alias("sketch"))
        for i, (kind, c) in enumerate(lines)
    )
    return row.select(F.inline(F.array(*each)))


def store_sketches(sketches: DataFrame, folder: str, load: str) -> None:
    """Keep the sketches of a load; a repeated load replaces its own."""
    sketches.coalesce(1).write.mode("overwrite").parquet(f"{folder}/load={load}")


def stored_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(f"{folder}/*").where(F.col("sketch").isNotNull())


def merged_distinct_counts(sketches: DataFrame) -> DataFrame:
    """(column, distinct_values): estimates over the union of all loads."""
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.where(F.col("kind") == DISTINCT).groupBy("column").agg(union.alias("distinct_values"))


def merged_quantiles(sketches: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, n, probability, value): quantiles over the union of all loads; n is the exact number of values.

    The value is one of the column's values. A column without values has none and is absent.
    """
    union = sketches.where(F.col("kind") == QUANTILES).groupBy("column").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    counted = union.withColumn("n", F.kll_sketch_get_n_double("sketch")).where("n > 0")
    each = F.array(
        *(
            F.struct(F.lit(p).cast("double").alias("probability"), F.kll_sketch_get_quantile_double("sketch", F.lit(p).cast("double")).alias("value"))
            for p in probabilities
        )
    )
    return counted.select("column", "n", F.inline(each))
