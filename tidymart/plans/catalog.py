"""Every registered query: name -> function of (session, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidymart.contracts import DIMENSIONS, FEED_SCHEMA, KEY, PLACE_MISSING_RE, ZONE_MISSING_RE
from tidymart.functions import numeric, text
from tidymart.operators import impute, merge, profile, quality, schema, sketches, star
from tidymart.operators import tidy as tidying
from tidymart.plans.driver_tables import (
    NUMERIC_COLUMNS,
    PIVOT_ZONES,
    QUALITY_HERE,
    RISKS_HERE,
    SITE_PREFIX_HERE,
    SPEC_A,
    SPEC_B,
    STAGES_HERE,
    raw_a,
    raw_a_with_class,
    raw_b,
    table,
)
from tidymart.plans.mart import MartSpec, build_mart, load_star, mart_summary
from tidymart.plans.refresh import Refreshed, refresh_mart
from tidymart.session import scratch_path, written
from tidymart.sources import files, paged, tables
from tidymart.streaming import feed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STAGE_LABELS = {"automobile": "auto", "building": "obra"}
LEVEL_TEXTS = (("urgent", "alta"), ("not specified", "sin especificar"))
PAGE_ROWS = 1000
BUCKETS = 8


def query(name: str):
    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


# Shared inputs -------------------------------------------------------------


def tidy_a(spark, folder):
    return tidying.tidy(raw_a(spark, folder), SPEC_A)


def tidy_b(spark, folder, split_class=True):
    return tidying.tidy(raw_b(spark, folder), SPEC_B, split_class=split_class)


def merged(spark, folder, how="inner"):
    return merge.merge_sources(
        tidy_a(spark, folder),
        tidy_b(spark, folder),
        how=how,
        site_prefix=SITE_PREFIX_HERE,
        risk_columns=RISKS_HERE,
        refold=False,
        null_safe=(),
    )


def star_tables(spark, folder):
    rows = written(merged(spark, folder), "merged")
    dimensions = star.build_dimensions(rows)
    return rows, star.build_fact(rows, dimensions, SITE_PREFIX_HERE), dimensions


def tally(df: DataFrame, source: str, result) -> DataFrame:
    """Apply a function to every spelling in a column: (source, result, rows)."""
    spellings = df.groupBy(F.col(source)).agg(F.count("*").alias("n"))
    return spellings.select(F.col(source).alias("source"), result.alias("result"), "n")


# Scalar functions ------------------------------------------------------------


@query("text_fold")
def text_fold(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.fold(F.col("text")).alias("folded"))


@query("unify_missing")
def unify_missing(spark, folder):
    return tally(raw_a(spark, folder), "NOMBREUPZ", text.unify_missing(F.col("NOMBREUPZ")))


@query("dict_map_default")
def dict_map_default(spark, folder):
    return tally(raw_a(spark, folder), "SEXO", text.standardize_sex(F.col("SEXO")))


@query("dict_map_passthrough")
def dict_map_passthrough(spark, folder):
    stage = text.standardize_stage(F.col("CURSO_DE_VIDA"), STAGE_LABELS)
    return tally(raw_a(spark, folder), "CURSO_DE_VIDA", stage)


@query("substring_replace")
def substring_replace(spark, folder):
    level = text.standardize_level(F.col("NIVELEDUCATIVO"), LEVEL_TEXTS)
    return tally(raw_a(spark, folder), "NIVELEDUCATIVO", level)


@query("classify")
def classify(spark, folder):
    return tally(raw_b(spark, folder), "clasificacion", text.classify(F.col("clasificacion")))


@query("yes_flag")
def yes_flag(spark, folder):
    rows = raw_a(spark, folder).unpivot([], ["SITIO_VIVIENDA", "SITIO_PARQUE"], "site", "answer")
    return tally(rows, "answer", text.yes_flag(F.col("answer")))


@query("positive_flag")
def positive_flag(spark, folder):
    rows = raw_b(spark, folder).unpivot([], list(RISKS_HERE), "risk", "answer")
    return tally(rows, "answer", numeric.positive_flag(F.col("answer")))


@query("numeric_coerce")
def numeric_coerce(spark, folder):
    cases = F.col("CASOS")
    both = F.struct(numeric.to_number(cases).alias("number"), numeric.to_count(cases).alias("cases"))
    return tally(raw_a(spark, folder), "CASOS", both).select("source", "result.*", "n")


@query("safe_ratio")
def safe_ratio(spark, folder):
    ratio = numeric.safe_ratio(F.col("l_tax"), F.col("l_discount"))
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", ratio.alias("ratio"))


@query("leading_int")
def leading_int(spark, folder):
    level = numeric.leading_int(F.col("NIVELEDUCATIVO"), "-")
    return tally(raw_a(spark, folder), "NIVELEDUCATIVO", level)


@query("regex_missing")
def regex_missing(spark, folder):
    spellings = raw_a(spark, folder).groupBy("NOMBREUPZ", "LOCALIDAD").agg(F.count("*").alias("n"))
    zone = text.regex_missing(F.col("NOMBREUPZ"), ZONE_MISSING_RE)
    place = text.regex_missing(F.col("LOCALIDAD"), PLACE_MISSING_RE)
    return spellings.groupBy(zone.alias("zone"), place.alias("place")).agg(F.sum("n").alias("n"))


# Schema handling -------------------------------------------------------------


@query("select_rename")
def select_rename(spark, folder):
    return schema.select_rename(raw_a(spark, folder), SPEC_A.rename, SPEC_A.required)


@query("first_existing_column")
def first_existing_column(spark, folder):
    rows = raw_b(spark, folder)
    label = schema.first_existing(rows, SPEC_B.class_candidates).alias("label")
    fallback = tidying.class_label(rows.drop("clasificacion"), SPEC_B).alias("fallback")
    return rows.groupBy(label, fallback).agg(F.count("*").alias("n"))


@query("not_null_violations")
def not_null_violations(spark, folder):
    rows = raw_a(spark, folder)
    return schema.not_null_violations(rows, rows.columns)


@query("unique_violations")
def unique_violations(spark, folder):
    """Profiles are not unique on sex alone: the violations are the sexes with several profiles."""
    dimensions = star_tables(spark, folder)[2]
    return schema.unique_violations(dimensions["dim_perfil_demografico"], ["sexo"])


@query("fk_orphans")
def fk_orphans(spark, folder):
    """Zones of source A before cleaning, checked against the cleaned zone dimension."""
    dimension = star_tables(spark, folder)[2]["dim_ubicacion"]
    zones = raw_a(spark, folder).select(text.unify_missing(F.col("NOMBREUPZ")).alias("upz"))
    return schema.fk_orphans(zones, dimension, "upz")


# Tidy ------------------------------------------------------------------------


@query("strict_key_filter")
def strict_key_filter(spark, folder):
    return tidying.strict_key_filter(tidying.label_keys(raw_a(spark, folder), SPEC_A, pin=True))


@query("tidy_weighted")
def tidy_weighted(spark, folder):
    return tidy_a(spark, folder)


@query("tidy_counts")
def tidy_counts(spark, folder):
    return tidy_b(spark, folder)


@query("tidy_counts_5key")
def tidy_counts_5key(spark, folder):
    return tidy_b(spark, folder, split_class=False)


@query("tidy_rows")
def tidy_rows(spark, folder):
    return tidying.tidy_rows(raw_a(spark, folder), SPEC_A)


@query("optional_zone_filter")
def optional_zone_filter(spark, folder):
    return tidying.tidy_rows(raw_b(spark, folder), SPEC_B, split_class=True, drop_missing=True)


# Merge -----------------------------------------------------------------------

for _how in merge.HOW:
    QUERIES[f"merge_{_how}"] = partial(merged, how=_how)


@query("merge_with_class")
def merge_with_class(spark, folder):
    a = tidying.tidy(raw_a_with_class(spark, folder), SPEC_A, split_class=True)
    return merge.merge_sources(
        a,
        tidy_b(spark, folder),
        with_class=True,
        site_prefix=SITE_PREFIX_HERE,
        risk_columns=RISKS_HERE,
        refold=False,
        null_safe=(),
    )


@query("merge_files")
def merge_files(spark, folder):
    """Both tidy tables go through CSV files and are folded and coerced again."""
    paths = scratch_path(spark, "tidy_a_csv"), scratch_path(spark, "tidy_b_csv")
    for df, path in zip((tidy_a(spark, folder), tidy_b(spark, folder)), paths):
        files.write_csv(df, path)
    return merge.load_and_merge(
        spark, *paths, how="outer", site_prefix=SITE_PREFIX_HERE, risk_columns=RISKS_HERE
    )


@query("merge_qc")
def merge_qc(spark, folder):
    return merge.merge_qc(tidy_a(spark, folder), tidy_b(spark, folder), refold=False)


# Profile ---------------------------------------------------------------------


@query("null_counts")
def null_counts(spark, folder):
    documents = table(spark, folder, "documents")
    return profile.null_counts(documents.join(table(spark, folder, "labels"), "doc_id", "left"))


@query("sentinel_counts")
def sentinel_counts(spark, folder):
    rows = raw_a(spark, folder).select(*(c.alias(n) for n, c in tidying.key_columns(SPEC_A).items()))
    return profile.sentinel_counts(rows)


@query("duplicate_key_rows")
def duplicate_key_rows(spark, folder):
    return profile.duplicate_key_rows(raw_a(spark, folder), list(SPEC_A.rename))


@query("distinct_counts")
def distinct_counts(spark, folder):
    return profile.distinct_counts(raw_b(spark, folder))


@query("distinct_counts_approx")
def distinct_counts_approx(spark, folder):
    """The exact counts, and whether the estimate is within five standard errors of each."""
    rows, error = raw_b(spark, folder), 0.02
    estimate = profile.distinct_counts_approx(rows, rsd=error).withColumnRenamed("distinct_values", "estimate")
    exact = profile.distinct_counts(rows)
    off = F.abs(F.col("estimate") - F.col("distinct_values"))
    close = (off <= 5 * error * F.col("distinct_values")).alias("close")
    return exact.join(estimate, "column").select("column", "distinct_values", close)


def _sketched(spark, rows: DataFrame, **columns) -> DataFrame:
    """The rows come in three loads; each stores its sketches, and only those are read afterwards."""
    folder = scratch_path(spark, "sketches")
    for load in range(3):
        part = rows.where(F.pmod(F.xxhash64(*rows.columns), F.lit(3)) == load)
        sketches.store_sketches(sketches.sketch_columns(part, **columns), folder, str(load))
    return sketches.stored_sketches(spark, folder)


@query("distinct_counts_merged")
def distinct_counts_merged(spark, folder):
    """The exact counts, and whether the merged estimate is within five standard errors of each."""
    rows = raw_b(spark, folder)
    stored = _sketched(spark, rows, distinct=rows.columns)
    estimate = sketches.merged_distinct_counts(stored).withColumnRenamed("distinct_values", "estimate")
    exact = profile.distinct_counts(rows)
    off = F.abs(F.col("estimate") - F.col("distinct_values"))
    close = (off <= 5 * sketches.distinct_error() * F.col("distinct_values")).alias("close")
    return exact.join(estimate, "column").select("column", "distinct_values", close)


@query("quartiles_merged")
def quartiles_merged(spark, folder):
    """The number of values per column, and whether the rank of each merged quartile is within three times the stated error."""
    rows = table(spark, folder, "lineitem").select(*NUMERIC_COLUMNS)
    found = written(sketches.merged_quantiles(_sketched(spark, rows, quantiles=NUMERIC_COLUMNS)), "quartiles")
    limit = 3 * sketches.rank_error()
    values = rows.select(*(F.col(c).cast("double").alias(c) for c in NUMERIC_COLUMNS)).unpivot([], list(NUMERIC_COLUMNS), "column", "x")
    ranks = values.join(F.broadcast(found), "column").groupBy("column", "probability", "n").agg(
        F.count_if(F.col("x") < F.col("value")).alias("below"), F.count_if(F.col("x") <= F.col("value")).alias("upto")
    )
    low, high = F.col("below") / F.col("n") <= F.col("probability") + limit, F.col("upto") / F.col("n") >= F.col("probability") - limit
    return ranks.select("column", "probability", "n", (low & high).alias("close"))


@query("frequency_share")
def frequency_share(spark, folder):
    return profile.frequency_share(raw_a(spark, folder), "NOMBREUPZ")


def _zone_label(c):
    return text.regex_missing(c, ZONE_MISSING_RE)


@query("frequency_table")
def frequency_table(spark, folder):
    return profile.labelled_frequency(raw_a(spark, folder), "NOMBREUPZ", _zone_label)


@query("topk_frequency")
def topk_frequency(spark, folder):
    return profile.topk_frequency(raw_a(spark, folder), "NOMBREUPZ", 10, _zone_label)


@query("topk_heavy")
def topk_heavy(spark, folder):
    """Three columns: few zones, users with few enough values to be tracked, and parts that are nearly even (counted in full)."""
    columns = (
        (raw_a(spark, folder), "NOMBREUPZ"),
        (table(spark, folder, "events"), "user_id"),
        (table(spark, folder, "lineitem"), "l_partkey"),
    )
    every = None
    for df, column in columns:
        top = profile.topk_heavy(df, column, 10, 256)
        part = top.select(F.lit(column).alias("column"), F.col("value").cast("string").alias("value"), "n")
        every = part if every is None else every.unionByName(part)
    return every


@query("topk_sum")
def topk_sum(spark, folder):
    return profile.topk_sum(raw_a(spark, folder), "NOMBREUPZ", numeric.to_number(F.col("CASOS")), 10)


@query("mode_by_group")
def mode_by_group(spark, folder):
    return profile.mode_by_group(raw_a(spark, folder), "LOCALIDAD", "NOMBREUPZ")


@query("describe_numeric")
def describe_numeric(spark, folder):
    described = profile.describe_numeric(table(spark, folder, "lineitem"), NUMERIC_COLUMNS)
    numbers = [c for c in described.columns if c not in ("column", "count")]
    return described.withColumns({c: F.round(c, 4) for c in numbers})


@query("describe_text")
def describe_text(spark, folder):
    rows = raw_a(spark, folder)
    return profile.describe_text(rows, rows.columns)


@query("duplicate_sample")
def duplicate_sample(spark, folder):
    key = list(SPEC_A.rename)
    return profile.duplicate_sample(raw_a(spark, folder), key, [*key, "CASOS"], 10)


@query("pivot_sum")
def pivot_sum(spark, folder):
    cases = numeric.to_number(F.col("CASOS"))
    return profile.pivot_sum(raw_a(spark, folder), "ANO", "NOMBREUPZ", cases, PIVOT_ZONES)


@query("qc_report")
def qc_report(spark, folder):
    report = profile.qc_report(tidy_b(spark, folder), [*KEY, "clasificacion"])
    return report.select(
        "rows",
        *(F.col(f"nulls_by_col.{c}").alias(f"nulls_{c}") for c in (*KEY, "clasificacion")),
        *(F.col(f"sin_dato_by_col.{c}").alias(f"sin_dato_{c}") for c in (*KEY[1:], "clasificacion")),
        "duplicates_by_key",
    )


@query("column_profile")
def column_profile(spark, folder):
    return profile.column_profile(merged(spark, folder))


@query("distinct_rows")
def distinct_rows(spark, folder):
    return raw_b(spark, folder).distinct()


# Imputation ------------------------------------------------------------------


def _imputed(spark, folder):
    return impute.impute_mode(raw_a(spark, folder), "NOMBREUPZ", "LOCALIDAD")


@query("impute_mode")
def impute_mode(spark, folder):
    group = ["LOCALIDAD", impute.BEFORE, impute.AFTER]
    return _imputed(spark, folder).groupBy(*group).agg(F.count("*").alias("n"))


@query("impute_metrics")
def impute_metrics(spark, folder):
    return impute.impute_metrics(_imputed(spark, folder))


@query("before_after_topk")
def before_after_topk(spark, folder):
    return impute.before_after_topk(_imputed(spark, folder), 10)


# Quality ---------------------------------------------------------------------

_METRIC_QUERIES = {
    "q_completeness": "completitud",
    "q_accuracy": "exactitud",
    "q_consistency": "consistencia",
    "q_uniqueness": "unicidad",
    "q_validity": "validez",
    "q_timeliness": "actualidad",
}


def _metric(spark, folder, metric):
    return quality.quality_metric(merged(spark, folder), metric, QUALITY_HERE)


for _name, _m in _METRIC_QUERIES.items():
    QUERIES[_name] = partial(_metric, metric=_m)


@query("quality_scorecard")
def quality_scorecard(spark, folder):
    return quality.quality_scorecard(merged(spark, folder), QUALITY_HERE)


@query("quality_gate")
def quality_gate(spark, folder):
    return quality.quality_gate(quality_scorecard(spark, folder))


# Star schema -----------------------------------------------------------------

_DIMENSION_QUERIES = {
    "dim_time": "dim_tiempo",
    "dim_location": "dim_ubicacion",
    "dim_profile": "dim_perfil_demografico",
    "dim_class": "dim_clasificacion",
}


def _dimension(spark, folder, name):
    return star.build_dimensions(merged(spark, folder))[name]


for _name, _t in _DIMENSION_QUERIES.items():
    QUERIES[_name] = partial(_dimension, name=_t)


@query("dim_incremental")
def dim_incremental(spark, folder):
    """A first load of the later years, then everything: known members keep their ids."""
    rows = written(merged(spark, folder), "merged")
    first = star.build_dimensions(rows.where("anio >= 1998"))
    second = star.build_dimensions(rows, first)
    out = None
    for name, (key, natural) in DIMENSIONS.items():
        member = F.concat_ws("|", *(F.col(c).cast("string") for c in natural))
        part = second[name].select(F.lit(name).alias("table"), F.col(key).alias("id"), member.alias("member"))
        out = part if out is None else out.unionByName(part)
    return out


@query("fact_build")
def fact_build(spark, folder):
    return star_tables(spark, folder)[1]


@query("fact_numbered")
def fact_numbered(spark, folder):
    _, fact, dimensions = star_tables(spark, folder)
    return star.number_facts(fact, dimensions).select("id_fact", *star.FACT_KEYS, "casos_spa", "casos_sui")


@query("load_stats")
def load_stats(spark, folder):
    return star.load_stats(star_tables(spark, folder)[1])


@query("star_denormalize")
def star_denormalize(spark, folder):
    _, fact, dimensions = star_tables(spark, folder)
    return star.denormalize(star.number_facts(fact, dimensions), dimensions)


@query("mart_build")
def mart_build(spark, folder):
    spec = MartSpec(SPEC_A, SPEC_B, SITE_PREFIX_HERE, RISKS_HERE, QUALITY_HERE)
    mart = build_mart(
        raw_a(spark, folder), raw_b(spark, folder), scratch_path(spark, "mart"), "first", spec
    )
    return mart_summary(mart)


def _refreshed(spark, folder) -> Refreshed:
    """Two loads: the early years with half of the later ones, and the other half, which touches the later years only."""
    spec = MartSpec(SPEC_A, SPEC_B, SITE_PREFIX_HERE, RISKS_HERE, QUALITY_HERE)
    a, b = written(raw_a(spark, folder), "raw-a"), written(raw_b(spark, folder), "raw-b")
    target = scratch_path(spark, "refreshed")

    def late(df, year):
        return F.coalesce((F.col(year) > "1996") & (F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 0), F.lit(False))

    late_a, late_b = late(a, "ANO"), late(b, "ano_notificacion")
    refresh_mart(a.where(~late_a), b.where(~late_b), target, "first", spec)
    return refresh_mart(a.where(late_a), b.where(late_b), target, "second", spec)


@query("refresh_merged")
def refresh_merged(spark, folder):
    mart = _refreshed(spark, folder)
    return mart.merged.select(*merged(spark, folder).columns)


@query("refresh_scorecard")
def refresh_scorecard(spark, folder):
    return _refreshed(spark, folder).scorecard


@query("refresh_star")
def refresh_star(spark, folder):
    mart = _refreshed(spark, folder)
    wide = star.denormalize(mart.fact.drop("anio"), mart.dimensions)
    return wide.select(*star.NATURAL, "casos_spa", "casos_sui", "sitio_vivienda", "pct_conflicto_pareja")


@query("observed_reports")
def observed_reports(spark, folder):
    """The reports that come with the writes of the batch job: (stage, metric, value)."""
    spec = MartSpec(SPEC_A, SPEC_B, SITE_PREFIX_HERE, RISKS_HERE, QUALITY_HERE)
    mart = build_mart(raw_a(spark, folder), raw_b(spark, folder), scratch_path(spark, "observed"), "first", spec)
    every = mart.scorecard.select(F.lit("merged").alias("stage"), F.col("metrica").alias("metric"), F.col("valor").alias("value"))
    for name, report in (("tidy_a", mart.report_a), ("tidy_b", mart.report_b)):
        flat = report.select(
            "rows",
            *(F.col(f"nulls_by_col.{c}").alias(f"nulls_{c}") for c in report.schema["nulls_by_col"].dataType.names),
            *(F.col(f"sin_dato_by_col.{c}").alias(f"sin_dato_{c}") for c in report.schema["sin_dato_by_col"].dataType.names),
            "duplicates_by_key",
        )
        long = flat.select(*(F.col(c).cast("double").alias(c) for c in flat.columns)).unpivot([], flat.columns, "metric", "value")
        every = every.unionByName(long.select(F.lit(name).alias("stage"), "metric", "value"))
    return every


@query("merge_bucketed")
def merge_bucketed(spark, folder):
    """Both tidy tables are written in buckets of the shared key and merged from there."""
    sides = []
    for name, df in (("a", tidy_a(spark, folder)), ("b", tidy_b(spark, folder))):
        path = scratch_path(spark, f"buckets-{name}")
        sides.append(tables.write_bucketed(df, path.rsplit("/", 1)[1].replace("-", "_"), path, KEY, BUCKETS))
    return merge.merge_sources(*sides, site_prefix=SITE_PREFIX_HERE, risk_columns=RISKS_HERE, refold=False, null_safe=())


@query("dim_collated")
def dim_collated(spark, folder):
    """Zones in three spellings, by year, as a database compares them: one member each, and the rows that refer to it."""
    zone, year = F.col("upz"), F.col("anio") % 3
    spelled = F.when(year == 1, F.upper(zone)).when(year == 2, F.replace(zone, F.lit("nacion"), F.lit("Nación"))).otherwise(zone)
    rows = written(merged(spark, folder).withColumn("upz", spelled), "unfolded")
    same = written(star.one_spelling(rows), "collated")
    members = star.build_dimensions(same)["dim_ubicacion"]
    used = star.natural_keys(same).groupBy("upz").agg(F.count("*").alias("n"))
    return members.join(used, "upz", "left").select("id_ubicacion", "upz", "n")


@query("load_set_aside")
def load_set_aside(spark, folder):
    """A merged table from outside with rows that have no year, rows that repeat, and counts that are missing."""
    rows = written(merged(spark, folder), "merged")
    undated = rows.where("anio = 1996").withColumn("anio", F.lit(None).cast("bigint"))
    uncounted = rows.withColumn("casos_sui", F.when(F.col("anio") != 1995, F.col("casos_sui")))
    broken = uncounted.unionByName(undated).unionByName(rows.where("anio = 1997"))
    load = load_star(broken, scratch_path(spark, "loaded"), "first", SITE_PREFIX_HERE)
    kept = load.fact.select(F.lit("loaded").alias("reason"), F.lit(1).cast("bigint").alias("copies"))
    every = load.set_aside.select("reason", "copies").unionByName(kept)
    return every.groupBy("reason").agg(F.sum("copies").alias("n"))


# Sources and sinks -----------------------------------------------------------


@query("csv_scan")
def csv_scan(spark, folder):
    """Columns are wanted in another order than the files have them, and texts hold line breaks."""
    rows = raw_a(spark, folder)
    path = scratch_path(spark, "raw_a_csv")
    files.write_csv(rows.select(*sorted(rows.columns)), path)
    return files.read_csv(spark, path, rows.columns, multiline=True)


@query("land_records")
def land_records(spark, folder):
    suppliers = table(spark, folder, "supplier")
    path = scratch_path(spark, "landed")
    columns = list(reversed(suppliers.columns))
    files.land(suppliers, path, columns, "csv")
    return files.read_csv(spark, path, suppliers.columns)


def _answers(spark, folder, customers: DataFrame | None = None) -> DataFrame:
    """The customers as answers of a paged API: (offset, answer), at most PAGE_ROWS records each."""
    customers = table(spark, folder, "customer") if customers is None else customers
    record = F.struct(*(F.col(c).cast("string").alias(c) for c in customers.columns))
    offset = (F.col("c_custkey") - F.col("c_custkey") % PAGE_ROWS).alias("offset")
    pages = customers.groupBy(offset).agg(F.collect_list(record).alias("records"))
    total = customers.agg(F.count("*")).scalar()
    result = F.struct("records", total.alias("total"))
    return pages.select("offset", F.struct(F.lit(True).alias("success"), result.alias("result")).alias("answer"))


@query("explode_records")
def explode_records(spark, folder):
    path = scratch_path(spark, "answers")
    _answers(spark, folder).select("answer.*").write.json(path)
    columns = table(spark, folder, "customer").columns
    return files.explode_records(files.read_envelopes(spark, path, columns))


@query("union_pages")
def union_pages(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
    )
    return files.union_pages([customers, suppliers])


@query("to_json_feed")
def to_json_feed(spark, folder):
    """Encode the wide table as JSON and decode it again."""
    lines = files.to_json_feed(star_denormalize(spark, folder))
    record = F.from_json("value", FEED_SCHEMA)
    return lines.select(record.alias("record")).select("record.*")


# Streams ---------------------------------------------------------------------


def _consumed(spark, lines: DataFrame, name: str, read=feed.stored_table, **options) -> DataFrame:
    """Publish lines as text files, let the stream take them in, and read what it wrote."""
    base = scratch_path(spark, name)
    lines.write.text(f"{base}/in")
    source = feed.read_feed(spark, "text", {}, f"{base}/in")
    feed.consume(source, f"{base}/table", f"{base}/rejects", f"{base}/state", **options).awaitTermination()
    if read is feed.reject_table:
        return feed.reject_table(spark, f"{base}/rejects")
    return feed.stored_table(spark, f"{base}/table", options.get("schema", FEED_SCHEMA))


@query("stream_filter")
def stream_filter(spark, folder):
    lines = files.to_json_feed(star_denormalize(spark, folder))
    return _consumed(spark, lines, "stream", wanted=STAGES_HERE)


EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("amount", T.IntegerType()),
    ]
)
EVENT_TYPES = ("click", "view")


def _event_lines(spark, folder) -> DataFrame:
    """Every event as one line: some are not JSON, some lack the type, some have a text amount."""
    n = F.col("event_id")
    key = F.concat(F.lit('{"event_id":'), n.cast("string"))
    kind = F.when(n % 5 == 0, "").when(n % 9 == 0, ',"event_type":null').otherwise(
        F.concat(F.lit(',"event_type":"'), F.col("event_type"), F.lit('"'))
    )
    amount = F.when(n % 11 == 0, ',"amount":"x"}').otherwise(
        F.concat(F.lit(',"amount":'), (n % 100).cast("string"), F.lit("}"))
    )
    line = F.when(n % 7 == 0, F.concat(F.lit("not json "), n.cast("string"))).otherwise(
        F.concat(key, kind, amount)
    )
    return table(spark, folder, "events").select(line.alias("value"))


def _events(spark, folder, read):
    return _consumed(
        spark,
        _event_lines(spark, folder),
        "events",
        read,
        schema=EVENT_SCHEMA,
        field="event_type",
        wanted=EVENT_TYPES,
    )


@query("stream_events")
def stream_events(spark, folder):
    return _events(spark, folder, feed.stored_table)


@query("stream_unique")
def stream_unique(spark, folder):
    """The feed is published three times: twice to one job, and to a job with a checkpoint of its own; keys are state."""
    base = scratch_path(spark, "unique")
    lines = _event_lines(spark, folder)
    for published, job in (("in", "one"), ("in", "one"), ("again", "two")):
        lines.write.mode("append").text(f"{base}/{published}")
        source = feed.read_feed(spark, "text", {}, f"{base}/{published}")
        landed, rejects, state = (f"{base}/{x}" for x in ("landing", "rejects", f"state-{job}"))
        options = {"schema": EVENT_SCHEMA, "field": "event_type", "wanted": EVENT_TYPES}
        feed.consume(source, landed, rejects, state, **options).awaitTermination()
        feed.settle(spark, landed, f"{base}/table", f"{base}/keys", ["event_id"], EVENT_SCHEMA).awaitTermination()
    return feed.stored_table(spark, f"{base}/table", EVENT_SCHEMA)


@query("stream_missing_field")
def stream_missing_field(spark, folder):
    return _events(spark, folder, feed.reject_table).where(F.col("outcome") == feed.MISSING_FIELD)


@query("stream_rejects")
def stream_rejects(spark, folder):
    return _events(spark, folder, feed.reject_table).where(F.col("outcome") == feed.REJECTED)


@query("paged_source")
def paged_source(spark, folder):
    """One saved answer per file, read back page by page through the data source."""
    path = scratch_path(spark, "pages")
    answers = _answers(spark, folder).select(
        "offset", F.to_json("answer", {"ignoreNullFields": "false"}).alias("text")
    )
    answers.write.partitionBy("offset").text(path)
    return paged.read_pages(spark, paged.FolderFetcher(path), PAGE_ROWS, table(spark, folder, "customer").columns)


@query("paged_stream")
def paged_stream(spark, folder):
    """Three runs of the extractor with one checkpoint: over a part that ends inside a page, over all, over all again."""
    customers = table(spark, folder, "customer")
    target, checkpoint = scratch_path(spark, "extracted"), scratch_path(spark, "extract-state")
    early = customers.where(F.col("c_custkey") < customers.agg(F.expr("max(c_custkey) div 2")).scalar())
    saved = []
    for part in (early, customers):
        saved.append(scratch_path(spark, "answers"))
        text = F.to_json("answer", {"ignoreNullFields": "false"}).alias("text")
        _answers(spark, folder, part).select("offset", text).write.partitionBy("offset").text(saved[-1])
    for path in (saved[0], saved[1], saved[1]):
        fetch = paged.FolderFetcher(path)
        paged.extract_new(spark, fetch, target, checkpoint, customers.columns, PAGE_ROWS).awaitTermination()
    return spark.read.parquet(target)
