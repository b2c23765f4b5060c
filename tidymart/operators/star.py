"""Star schema: dimensions with stable surrogate keys, fact table, denormalised feed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidymart.contracts import (
    CLASS_COLUMN,
    DIMENSION_SCHEMAS,
    DIMENSIONS,
    FACT_KEYS,
    FACT_MEASURES,
    KEY,
    SITE_PREFIX,
    SITE_MEASURES,
    measure_type,
)
from tidymart.operators.scale import number_rows
from tidymart.session import written

NATURAL = (*KEY, CLASS_COLUMN)
NULL_LABEL = "nan"  # what a null natural key is stored as


def _label(name: str) -> Column:
    return F.col(name) if name == "anio" else F.coalesce(F.col(name), F.lit(NULL_LABEL))


def natural_keys(merged: DataFrame) -> DataFrame:
    """The merged table with text keys that are never null."""
    return merged.withColumns({c: _label(c) for c in NATURAL if c != "anio"})


def one_spelling(merged: DataFrame, collation: str = "UNICODE_CI_AI", columns: Sequence[str] = NATURAL) -> DataFrame:
    """Text keys that are equal under a collation get one spelling: that of the first row in key order.

    For tables that come unfolded, as a database with such a collation compares them. Call it before
    :func:`build_dimensions`; nulls stay null. Every distinct spelling is compared once, not every row: spellings meet in
    the map tasks, and the table from spelling to spelling is a written one, which the planner broadcasts if it is small.
    Only where a column has more than one spelling of a key, the rows get a join at all.
    """
    order = [F.col(c) for c in NATURAL if c in merged.columns]
    for c in (c for c in columns if isinstance(merged.schema[c].dataType, T.StringType)):
        spellings = merged.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("__as")).agg(F.min(F.struct(*order)).alias("__first"))
        spellings = written(spellings, "spellings")
        first = spellings.groupBy(F.collate("__as", collation).alias("__same")).agg(F.min_by("__as", "__first").alias("__one"))
        same = F.collate("__as", collation) == F.col("__same")
        changed = written(spellings.join(first, same).where(F.col("__as") != F.col("__one")).select("__as", "__one"), "respelled")
        if changed.isEmpty():
            continue
        names = merged.columns
        respelled = merged.join(changed, F.col(c) == F.col("__as"), "left")
        merged = respelled.withColumn(c, F.coalesce("__one", c)).select(*names)
    return merged


def dimension_members(merged: DataFrame) -> DataFrame:
    """(table, natural key columns, first): the members of all four dimensions in one pass.

    Grouping sets give every natural key with its first appearance in key order; columns of
    other dimensions are null. Members meet in the map tasks, so only distinct ones are shuffled.
    """
    keys = {t: natural for t, (_, natural) in DIMENSIONS.items()}
    sets = [[F.col(c) for c in natural] for natural in keys.values()]
    first = F.min(F.struct(*(F.col(c).alias(f"first_{c}") for c in NATURAL)))
    grouped = (
        natural_keys(merged)
        .select(*NATURAL)
        .groupingSets(sets, *(F.col(c) for c in NATURAL))
        .agg(first.alias("first"), F.grouping_id().alias("set"))
    )
    # grouping_id: one bit per column, 1 where the column is not part of the set.
    table = F.lit(None).cast("string")
    for name, natural in keys.items():
        bits = sum(1 << (len(NATURAL) - 1 - i) for i, c in enumerate(NATURAL) if c not in natural)
        table = F.when(F.col("set") == bits, name).otherwise(table)
    return grouped.select(table.alias("table"), *NATURAL, "first")


def _known_members(existing: Mapping[str, DataFrame]) -> DataFrame | None:
    """The members of loaded dimensions in one table: (table, natural key columns, id)."""
    known = None
    for table, dimension in existing.items():
        key, natural = DIMENSIONS[table]
        columns = [
            (F.col(c) if c in natural else F.lit(None)).cast("bigint" if c == "anio" else "string").alias(c)
            for c in NATURAL
        ]
        part = dimension.select(F.lit(table).alias("table"), *columns, F.col(key).cast("bigint").alias("id"))
        known = part if known is None else known.unionByName(part)
    return known


def build_dimensions(
    merged: DataFrame, existing: Mapping[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """The four dimensions: known members keep their id, new ones follow in first-appearance order."""
    known = _known_members(existing or {})
    members = dimension_members(merged)
    if known is not None:
        same = [F.col("m.table") == F.col("k.table")]
        same += [F.col(f"m.{c}").eqNullSafe(F.col(f"k.{c}")) for c in NATURAL]
        members = members.alias("m").join(known.alias("k"), same, "left_anti")
    numbered = number_rows(members, [F.col("table"), F.col("first")], "at")

    # Four rows each: where the numbers of a table start, and its highest id so far.
    starts = numbered.groupBy("table").agg((F.min("at") - 1).alias("before"))
    highest = F.lit(0)
    if known is not None:
        starts = starts.join(known.groupBy("table").agg(F.max("id").alias("highest")), "table", "left")
        highest = F.coalesce(F.col("highest"), F.lit(0))
    number = (F.col("at") - F.col("before") + highest).alias("id")
    every = numbered.join(F.broadcast(starts), "table").select("table", *NATURAL, number)
    if known is not None:
        every = known.unionByName(every)
    every = written(every, "dimensions", ["table"])

    def dimension(table):
        key, natural = DIMENSIONS[table]
        schema = DIMENSION_SCHEMAS[table]
        return every.where(F.col("table") == table).select(
            F.col("id").cast("int").alias(key), *(F.col(c).cast(schema[c].dataType).alias(c) for c in natural)
        )

    return {t: dimension(t) for t in DIMENSIONS}


def measure_source(measure: str, site_prefix: str = SITE_PREFIX) -> str:
    """Column of the merged table that feeds a fact measure."""
    for site in SITE_MEASURES:
        bare = site.removeprefix("sitio_")
        if measure == site:
            return (site_prefix + bare).upper()
        if measure == f"pct_{site}":
            return f"pct_{site_prefix.lower()}{bare}"
    return measure


def build_fact(
    merged: DataFrame, dimensions: Mapping[str, DataFrame], site_prefix: str = SITE_PREFIX
) -> DataFrame:
    """Surrogate keys instead of natural keys, and the 32 measures (0 where a column is missing).

    The dimensions are written tables, so the planner knows their size: below the broadcast
    threshold they go to every executor, above it the join is by key, where adaptive execution
    splits the partitions of a hot member.
    """
    fact = natural_keys(merged)
    for table, (_, natural) in DIMENSIONS.items():
        fact = fact.join(dimensions[table], list(natural), "left")

    def measure(name):
        source = measure_source(name, site_prefix)
        column = F.col(source) if source in merged.columns else F.lit(0)
        return column.cast(measure_type(name)).alias(name)

    return fact.select(*FACT_KEYS, *(measure(m) for m in FACT_MEASURES))


def number_facts(fact: DataFrame, dimensions: Mapping[str, DataFrame], start: int = 0) -> DataFrame:
    """Add a dense ``id_fact`` in natural-key order."""
    wide = denormalize(fact, dimensions)
    numbered = number_rows(wide, [F.col(c) for c in NATURAL], "id_fact", start)
    return numbered.select("id_fact", *fact.columns)


def denormalize(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """The fact with the natural keys of its dimensions; unknown ids give null."""
    wide = fact
    for table, (key, _) in DIMENSIONS.items():
        wide = wide.join(dimensions[table], key, "left")
    naturals = [c for _, natural in DIMENSIONS.values() for c in natural]
    return wide.select(*fact.columns, *naturals)


def load_stats(fact: DataFrame) -> DataFrame:
    """Rows of this load and the members of each dimension that it uses."""
    names = ("tiempo", "ubicacion", "perfil", "clasificacion")
    used = fact.groupBy(*FACT_KEYS).agg(F.count("*").alias("n"))
    return used.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("registros_procesados"),
        *(F.count_distinct(k).alias(f"dimensiones_{n}") for k, n in zip(FACT_KEYS, names)),
    )


def new_facts(fact: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows whose four keys are not loaded yet: loading the same data again adds nothing."""
    return fact.join(loaded.select(*FACT_KEYS).distinct(), list(FACT_KEYS), "left_anti")
