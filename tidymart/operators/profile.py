"""Counts, frequencies, descriptions and reports over one table."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidymart.contracts import MISSING, PROFILE_TEXTS
from tidymart.functions import numeric
from tidymart.session import written


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("bigint"))


def text_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    columns = df.columns if columns is None else columns
    return [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value as text, n) for all columns at once; null is a value.

    Equal values meet in the map tasks already, so the shuffle moves distinct values only.
    """
    as_text = df.select(*(F.col(c).cast("string").alias(c) for c in columns))
    long = as_text.unpivot([], list(columns), "column", "value")
    return long.groupBy("column", "value").agg(F.count("*").alias("n"))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls), most nulls first; one pass over the table."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    return counts.unpivot([], df.columns, "column", "nulls").orderBy(F.desc("nulls"), "column")


def sentinel_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, sentinels): how often each text column holds the missing label."""
    texts = text_columns(df, columns)
    counts = df.agg(*(F.count_if(F.col(c) == MISSING).alias(c) for c in texts))
    return counts.unpivot([], texts, "column", "sentinels")


def duplicate_key_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of rows that share their key with another row (all members count)."""
    sizes = df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    return sizes.agg(_or_zero(F.sum("n")).alias("duplicates_by_key"))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, distinct values) without null; exact."""
    columns = df.columns if columns is None else list(columns)
    return value_counts(df, columns).groupBy("column").agg(F.count("value").alias("distinct_values"))


def distinct_counts_approx(
    df: DataFrame, columns: Sequence[str] | None = None, rsd: float = 0.02
) -> DataFrame:
    """Estimate of :func:`distinct_counts` from one pass without shuffling the values."""
    columns = df.columns if columns is None else list(columns)
    counts = df.agg(*(F.approx_count_distinct(c, rsd).alias(c) for c in columns))
    return counts.unpivot([], columns, "column", "distinct_values")


def frequency_table(df: DataFrame, column: str) -> DataFrame:
    """(value, n), most frequent first."""
    return (
        df.groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def frequency_share(df: DataFrame, column: str) -> DataFrame:
    """Frequencies with null as a value, and their share of all rows rounded to 4 digits."""
    # Written, so that the table is read once and not again for the total.
    counts = written(df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")), "frequencies")
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", numeric.safe_ratio(F.col("n"), total)).orderBy(F.desc("n"), "value")


def labelled_frequency(df: DataFrame, column: str, label: Callable[[Column], Column]) -> DataFrame:
    """Frequencies of the labels of a text column; every spelling is labelled once, not every row."""
    spellings = df.groupBy(column).agg(F.count("*").alias("n"))
    return (
        spellings.groupBy(label(F.col(column)).alias("value"))
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def topk_frequency(
    df: DataFrame, column: str, k: int = 10, label: Callable[[Column], Column] | None = None
) -> DataFrame:
    """The k most frequent values (or labels of values) that are not null."""
    table = labelled_frequency(df, column, label) if label else frequency_table(df, column)
    return table.where(F.col("value").isNotNull()).limit(k)


def topk_heavy(df: DataFrame, column: str, k: int = 10, tracked: int = 4096) -> DataFrame:
    """The k most frequent values that are not null, exactly: (value, n). Values are not shuffled where a proof is found.

    One pass keeps at most ``tracked`` / 0.75 counters per task, rounded up to a power of two m, and merges them. A value that
    it does not return is at most as frequent as the least estimate returned, nor, unless the list of ``tracked`` items is full,
    more frequent than twice the error of the counters, 3.5 / m of all rows. A second pass counts the returned values exactly, one
    row per task and value. If the k-th of them is above that bound, or if they are all rows, nothing else can be among the
    first k. Otherwise (no k values stand out) all values are counted as in :func:`topk_frequency`.
    Counters hold whole values, so memory is ``tracked`` times the length of a value. Ties go to the smallest value.
    """
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0).cast(df.schema[column].dataType)  # 0.0 and -0.0 are one value
    values = df.select(value.alias("value")).where(F.col("value").isNotNull())
    sketch = values.agg(
        F.call_function("approx_top_k", F.col("value"), F.lit(tracked), F.lit(tracked)).alias("items"),
        F.count("*").alias("rows"),
    )
    # One row of `tracked` items at most; written, so that the table is not read again for it.
    sketch = written(sketch, "counters")
    candidates = sketch.select(F.inline("items")).select(F.col("item").alias("value"), F.col("count").alias("estimate"))
    counted = (
        values.join(F.broadcast(candidates.select("value")), "value", "left_semi")
        .groupBy("value")
        .agg(F.count("*").alias("n"))
    )
    counted = written(counted, "heavy")  # `tracked` rows at most
    size, least, rows = sketch.select(
        F.size("items"), F.array_min(F.transform("items", lambda item: item["count"])), "rows"
    ).first()
    counters = 1 << math.ceil(math.log2(math.ceil(tracked / 0.75)))
    bound = least if size == tracked else min(least or 0, 2 * 3.5 * rows / counters)
    first = counted.orderBy(F.desc("n"), "value").limit(k)
    reach = first.agg(F.count("*").alias("found"), F.min("n").alias("n")).first()
    everything = (counted.agg(F.sum("n")).first()[0] or 0) == rows
    if everything or (reach["found"] == k and reach["n"] > bound):
        return first
    return topk_frequency(df.select(value.alias(column)), column, k)


def topk_sum(df: DataFrame, group: str, measure: Column, k: int = 10) -> DataFrame:
    """The k groups with the largest sum; rows without a group do not count."""
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(F.col(group).alias("value"))
        .agg(F.coalesce(F.sum(measure), F.lit(0.0)).alias("total"))
        .orderBy(F.desc("total"), "value")
        .limit(k)
    )


def mode_by_group(df: DataFrame, group: str, value: str, weight: Column | None = None) -> DataFrame:
    """Most frequent value per group, the smallest one on a tie.

    Counts per (group, value) come first; picking the winner then needs one small buffer per
    group, however many rows or values the group has. ``weight`` is the number of rows that a
    row stands for.
    """
    counts = (
        df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
        .groupBy(group, value)
        .agg((F.count("*") if weight is None else F.sum(weight)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col(value).alias("value")))
    return counts.groupBy(group).agg(best.alias("best")).select(
        group, F.col("best.value").alias("mode"), (-F.col("best.rank")).alias("n")
    )


def _largest_range(values: DataFrame) -> int:
    sizes = values.groupBy("range").agg(F.count("*").alias("n"))
    return sizes.agg(F.max("n").alias("n")).first()["n"] or 0


def counted_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Written table (column, value, n) of the distinct numbers of all columns; null is left out."""
    names = list(columns)
    wide = df.select(*(F.col(c).cast("double").alias(c) for c in names))
    long = wide.unpivot([], names, "column", "value").where("value is not null")
    return written(long.groupBy("column", "value").agg(F.count("*").alias("n")), "values")


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    pieces: int = 32,
    sortable: int = 1_000_000,
) -> DataFrame:
    """Exact interpolated quantiles: (column, probability, value)."""
    return quantiles_of(counted_values(df, columns), probabilities, pieces, sortable)


def quantiles_of(
    values: DataFrame, probabilities: Sequence[float], pieces: int = 32, sortable: int = 1_000_000
) -> DataFrame:
    """Quantiles of counted values: (column, probability, value).

    A round splits each search range at approximate cut points, sees from the counts in which pieces the
    wanted ranks lie, and goes on with those pieces only, until every range holds at most ``sortable``
    distinct values: this is the most that any task puts in order. A range that can't be split fails.
    """
    values = values.withColumn("range", F.col("column"))
    # At most two rows per column and probability: where each wanted rank is looked for.
    wanted = (
        values.groupBy("column", "range")
        .agg(F.sum("n").alias("total"))
        .withColumn("probability", F.explode(F.array(*map(F.lit, map(float, probabilities)))))
        .withColumn("position", (F.col("total") - 1) * F.col("probability"))
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("position"), F.ceil("position")))))
        .withColumn("before", F.lit(0).cast("bigint"))
        .select("column", "range", "probability", "position", "rank", "before")
    )
    largest = _largest_range(values)
    while largest > sortable:
        shares = [i / pieces for i in range(1, pieces)]
        cuts = values.groupBy("range").agg(
            F.percentile_approx("value", shares, 100 * pieces).alias("cuts")
        )
        piece = F.size(F.filter("cuts", lambda cut: cut < F.col("value")))
        # One row per range, and there are no more ranges than wanted ranks.
        placed = values.join(F.broadcast(cuts), "range").select(
            "column", "value", "n", "range", F.concat_ws("/", "range", F.lpad(piece.cast("string"), 4, "0")).alias("piece")
        )
        earlier = W.partitionBy("range").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
        # At most `pieces` rows per range.
        sizes = (
            placed.groupBy("range", "piece")
            .agg(F.sum("n").alias("size"))
            .withColumn("skip", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        )
        start = F.col("before") + F.col("skip")
        found = wanted.join(sizes, "range").where(
            (F.col("rank") >= start) & (F.col("rank") < start + F.col("size"))
        )
        wanted = written(
            found.select("column", F.col("piece").alias("range"), "probability", "position", "rank", start.alias("before")),
            "wanted",
        )
        ranges = wanted.select(F.col("range").alias("piece")).distinct()
        values = written(
            placed.join(F.broadcast(ranges), "piece", "left_semi").select(
                "column", "value", "n", F.col("piece").alias("range")
            ),
            "values",
        )
        before, largest = largest, _largest_range(values)
        if largest >= before:
            raise RuntimeError(f"a range of {largest} values could not be split further")
    ordered = W.partitionBy("range").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    ranked = values.select("range", "value", "n", F.sum("n").over(ordered).alias("upto"))
    hits = ranked.join(F.broadcast(wanted), "range").where(
        "rank >= before + upto - n and rank < before + upto"
    )
    low, high = F.min("value"), F.max("value")
    part = F.first("position") - F.floor(F.first("position"))
    return hits.groupBy("column", "probability").agg((low + (high - low) * part).alias("value"))


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std (sample), min, quartiles and max per numeric column."""
    names = list(columns)
    values = counted_values(df, names)
    sums = values.groupBy("column").agg(
        F.sum("n").alias("count"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    # One row per column; the squares are taken around the mean, so nothing cancels.
    off = F.col("value") - F.col("mean")
    squares = values.join(F.broadcast(sums), "column").groupBy("column").agg(F.sum(off * off * F.col("n")).alias("squares"))
    every = df.sparkSession.createDataFrame([(c,) for c in names], "column string")
    basics = (
        every.join(F.broadcast(sums), "column", "left")
        .join(F.broadcast(squares), "column", "left")
        .withColumn("count", _or_zero(F.col("count")))
        .withColumn("std", F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1))))
    )

    def quartile(p):
        return F.max(F.when(F.col("probability") == p, F.col("value")))

    quartiles = quantiles_of(values, [0.25, 0.5, 0.75]).groupBy("column").agg(
        quartile(0.25).alias("q25"), quartile(0.5).alias("q50"), quartile(0.75).alias("q75")
    )
    # One row per column on both sides.
    return basics.join(F.broadcast(quartiles), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, distinct values, most frequent value (smallest on a tie) and its frequency."""
    rank = F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("rank"), "value"))
    return (
        value_counts(df, columns)
        .groupBy("column")
        .agg(
            _or_zero(F.sum(F.when(F.col("value").isNotNull(), F.col("n")))).alias("count"),
            F.count("value").alias("unique"),
            F.min(rank).alias("best"),
        )
        .select(
            "column",
            "count",
            "unique",
            F.col("best.value").alias("top"),
            (-F.col("best.rank")).alias("freq"),
        )
    )


def duplicate_sample(df: DataFrame, key: Sequence[str], columns: Sequence[str], k: int = 10) -> DataFrame:
    """The first k rows, in key order, that share their key with another row.

    The k smallest repeated keys cover the first k such rows, so the lookup has k rows at most.
    """
    repeated = (
        df.groupBy(*(F.col(c).alias(f"__{c}") for c in key))
        .agg(F.count("*").alias("__n"))
        .where("__n > 1")
        .orderBy(*(f"__{c}" for c in key))
        .limit(k)
    )
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key]
    rows = df.join(F.broadcast(repeated), same, "left_semi").select(*columns)
    return rows.orderBy(*key, *(c for c in columns if c not in key)).limit(k)


def pivot_sum(
    df: DataFrame, index: str, column: str, measure: Column, values: Sequence, others: str | None = None
) -> DataFrame:
    """index x column sums: null where no row exists, 0 where rows exist without a number.

    ``values`` names the columns of the result, so no job has to find them first. Any other value fails the job, or is
    summed in the column ``others`` where that is named; nothing is left out unseen.
    """
    cell = F.when(F.count(F.lit(1)) > 0, F.coalesce(F.sum(measure), F.lit(0.0)))
    rows = df.where(F.col(index).isNotNull() & F.col(column).isNotNull())
    value = F.col(column).cast("string")
    rest = F.raise_error(F.concat(F.lit("no column is named for "), value)).cast("string") if others is None else F.lit(others)
    named = F.when(F.col(column).isin(*values), value).otherwise(rest)
    grouped = rows.groupBy(index, named.alias("__column")).agg(cell.alias("__cell"))
    names = [str(v) for v in values] + ([] if others is None else [others])
    return grouped.groupBy(index).pivot("__column", names).agg(F.first("__cell", ignorenulls=True))


def qc_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, nulls and sentinels per key column, rows with a repeated key.

    All of it follows from the rows per key, so one aggregation serves the whole report.
    """
    per_key = df.groupBy(*key).agg(F.count("*").alias("__n"))
    n = F.col("__n")

    def rows_where(condition):
        return _or_zero(F.sum(F.when(condition, n)))

    return per_key.agg(
        _or_zero(F.sum(n)).alias("rows"),
        F.struct(*(rows_where(F.col(c).isNull()).alias(c) for c in key)).alias("nulls_by_col"),
        F.struct(
            *(rows_where(F.col(c) == MISSING).alias(c) for c in text_columns(df, key))
        ).alias("sin_dato_by_col"),
        rows_where(n > 1).alias("duplicates_by_key"),
    )


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Five rows per column: type, nulls, distinct values, duplicates, problem examples.

    Examples are up to three nulls, else up to three repeated values in value order.
    """
    columns = [c for c in (df.columns if columns is None else columns) if c in df.columns]
    counts = written(value_counts(df, columns), "value-counts")  # read twice, counted once
    n, value = F.col("n"), F.col("value")
    totals = counts.groupBy("column").agg(
        F.sum("n").alias("total"),
        _or_zero(F.sum(F.when(value.isNull(), n))).alias("nulls"),
        F.count("value").alias("distinct_values"),
        F.count("*").alias("kinds"),
    )
    # The rank limit is applied in every task before the rows of a column meet.
    rank = F.row_number().over(W.partitionBy("column").orderBy("value"))
    repeated = (
        counts.where(value.isNotNull() & (n > 1))
        .withColumn("rank", rank)
        .where("rank <= 3")
        .groupBy("column")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "value", "n"))).alias("tops"))
        .select(
            "column",
            F.slice(
                F.flatten(
                    F.transform(
                        "tops",
                        lambda t: F.array_repeat(t["value"], F.least(t["n"] - 1, F.lit(3)).cast("int")),
                    )
                ),
                1,
                3,
            ).alias("repeats"),
        )
    )
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name in columns}
    kind = F.lit(None).cast("string")
    for name, label in kinds.items():
        kind = F.when(F.col("column") == name, label).otherwise(kind)
    said = PROFILE_TEXTS
    nulls, unique, dups = F.col("nulls"), F.col("distinct_values"), F.col("total") - F.col("kinds")
    examples = F.col("examples")

    def listed(values):
        return F.concat(F.lit("["), F.array_join(values, ", "), F.lit("]"))

    some_nulls = F.array_repeat(F.lit("null"), F.least(nulls, F.lit(3)).cast("int"))
    problems = (
        F.when(nulls > 0, listed(some_nulls))
        .when(F.size("repeats") > 0, listed(F.col("repeats")))
        .otherwise(said["examples_none"])
    )

    def line(metric, shown, note):
        return F.struct(
            F.lit(said[metric]).alias("metric"), shown.cast("string").alias("value"), note.alias("observation")
        )

    def note(condition, then, number, otherwise):
        return F.when(condition, said[then]).otherwise(F.format_string(said[otherwise], number))

    reliable = F.when(examples == said["examples_none"], said["reliable"]).otherwise(said["review"])
    checked = F.when(F.col("kind") == "string", said["type_text"]).otherwise(said["type_ok"])
    lines = F.array(
        line("type", F.col("kind"), checked),
        line("nulls", nulls, note(nulls == 0, "nulls_none", nulls, "nulls_some")),
        line("unique", unique, note(unique == F.col("total"), "unique_all", unique, "unique_some")),
        line("dups", dups, note(dups == 0, "dups_none", dups, "dups_some")),
        line("examples", examples, reliable),
    )
    # One row per column on both sides.
    return (
        totals.join(F.broadcast(repeated), "column", "left")
        .withColumn("kind", kind)
        .withColumn("examples", problems)
        .select("column", F.inline(lines))
    )
