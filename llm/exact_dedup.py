"""Exact dedup by skew-safe combining: local groups, salted digest groups, then one winner per content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidymart.session import written


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_groups(docs: DataFrame, id_column="doc_id", text_column="text", salts: int = 16, digest=content_digest):
    """One row per document: id, ``keep_id``, ``group_size``, ``kept`` and ``digest``.

    Texts are equal when they are identical; the largest id of equal texts stays. Three groupings compare
    the full content: in the map task (partial aggregation), within (digest, salt), and over the salts'
    winners. The salt comes from the id, so a group that holds a third of all rows is spread over `salts` tasks
    and reaches the last grouping as at most `salts` rows.

    A null text counts as empty, an empty table gives no rows, and other columns are ignored. Rows that repeat
    id and text are each listed and count in ``group_size``; all of them are ``kept`` if their id wins. A null
    id is kept only if its whole group has null ids. Texts that share a digest without being equal stay
    apart: their rows are matched by content.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("__id"), text.alias("__text")).withColumn("__digest", digest(F.col("__text")))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("__id"), F.lit(salts)))
    local = salted.groupBy("__digest", "__salt", "__text").agg(F.max("__id").alias("__keep"), F.count("*").alias("__n"))
    whole = local.groupBy("__digest", "__text").agg(F.max("__keep").alias("keep_id"), F.sum("__n").alias("group_size"))
    winners = written(whole.select("__digest", "keep_id", "group_size"), "exact-winners")

    clashing = winners.groupBy("__digest").agg(F.count("*").alias("__contents")).filter("__contents > 1").select("__digest")
    keys = rows.select("__id", "__digest")
    if clashing.isEmpty():
        matched = keys.join(winners, "__digest")
    else:
        clashing = written(clashing, "exact-clashing")
        plain = winners.join(clashing, "__digest", "left_anti")
        shared = rows.join(clashing, "__digest", "left_semi")
        found = local.join(clashing, "__digest", "left_semi").groupBy("__digest", "__text")
        contents = found.agg(F.max("__keep").alias("keep_id"), F.sum("__n").alias("group_size"))
        by_text = shared.join(contents, ["__digest", "__text"]).select("__digest", "__id", "keep_id", "group_size")
        matched = keys.join(plain, "__digest").select("__digest", "__id", "keep_id", "group_size").unionByName(by_text)
    return matched.select(
        F.col("__id").alias(id_column),
        "keep_id",
        "group_size",
        F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("__digest").alias("digest"),
    )


def drop_exact_copies(docs: DataFrame, id_column="doc_id", text_column="text", salts: int = 16) -> DataFrame:
    """The rows that stay, with all their columns; a row repeated with its id and text stays once."""
    groups = exact_groups(docs, id_column, text_column, salts)
    losers = written(groups.filter(~F.col("kept")).select(F.col(id_column).alias("__id"), "digest"), "exact-losers")
    text = F.coalesce(F.col(text_column), F.lit(""))
    marked = docs.withColumn("__digest", content_digest(text))
    same = marked["__digest"].eqNullSafe(losers["digest"]) & marked[id_column].eqNullSafe(losers["__id"])
    kept = marked.join(losers, same, "left_anti")
    repeated = docs.groupBy(id_column).agg(F.count("*").alias("__n")).filter("__n > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates([id_column, "__digest"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
