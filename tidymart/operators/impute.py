"""Imputation of a missing zone by the most frequent zone of its place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidymart.contracts import ZONE_MISSING_RE
from tidymart.functions import text
from tidymart.operators.profile import mode_by_group
from tidymart.session import written

BEFORE, AFTER = "zona_antes", "zona"


def _bad(c: Column) -> Column:
    return c.isNull() | text.bad_text(c)


def impute_mode(df: DataFrame, zone: str, place: str) -> DataFrame:
    """Fill missing zones with the mode of their place; adds ``zona_antes`` and ``zona``.

    The modes are learned from rows where both are known. A missing zone whose place is missing
    or has no mode becomes null. Zones and places are compared and returned without white space at their ends.
    Only rows that need a zone and name a place are joined to the mode table; it is a written table, so the
    planner knows its size and whether these rows must be shuffled. Adaptive execution splits a hot place.
    """
    stripped = {BEFORE: text.strip(F.col(zone)), "__place": text.strip(F.col(place))}
    clean = df.withColumns(stripped)
    # The modes need each pair of spellings once, with its number of rows.
    pairs = df.groupBy(zone, place).agg(F.count("*").alias("__n")).withColumns(stripped)
    known = pairs.where(~_bad(F.col(BEFORE)) & ~_bad(F.col("__place")))
    modes = written(mode_by_group(known, "__place", BEFORE, F.col("__n")).drop("n"), "modes")
    fillable = _bad(F.col(BEFORE)) & ~_bad(F.col("__place"))
    others = clean.where(~fillable).withColumn(
        AFTER, F.when(~_bad(F.col(BEFORE)), F.col(BEFORE))
    )
    filled = clean.where(fillable).join(modes, "__place", "left").withColumn(AFTER, F.col("mode"))
    out = [*df.columns, BEFORE, AFTER]
    return others.select(*out).unionByName(filled.select(*out))


def impute_metrics(imputed: DataFrame) -> DataFrame:
    """Missing before, imputed, still missing (as text; with null), and rows really resolved.

    ``imputadas`` is the drop in missing *texts*, so it also counts texts that became null;
    ``resueltas`` counts the rows that got a zone.
    """
    before, after = F.col(BEFORE), F.col(AFTER)
    pairs = imputed.groupBy(BEFORE, AFTER).agg(F.count("*").alias("n"))

    def rows_where(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return pairs.agg(
        rows_where(text.bad_text(before)).alias("antes_sin_dato"),
        (rows_where(text.bad_text(before)) - rows_where(text.bad_text(after))).alias("imputadas"),
        rows_where(text.bad_text(after)).alias("aun_sin_dato"),
        rows_where(_bad(after)).alias("aun_sin_dato_o_nulo"),
        rows_where(_bad(before) & ~_bad(after)).alias("resueltas"),
    )


def before_after_topk(imputed: DataFrame, k: int = 10, pattern: str = ZONE_MISSING_RE) -> DataFrame:
    """The k most frequent zones before and after, side by side: (value, antes, despues)."""

    # One pass over the rows; both sides are counted from the pairs of spellings.
    pairs = written(imputed.groupBy(BEFORE, AFTER).agg(F.count("*").alias("n")), "before-after")

    def top(column, label):
        labelled = pairs.groupBy(text.regex_missing(F.col(column), pattern).alias("value"))
        return labelled.agg(F.sum("n").alias(label)).orderBy(F.desc(label), "value").limit(k)

    return top(BEFORE, "antes").join(top(AFTER, "despues"), "value", "full_outer")
