"""The whole batch job: two raw tables to a scored, loaded star schema."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidymart.contracts import (
    CLASS_COLUMN,
    CONSUMPTION,
    DIMENSIONS,
    FACT_COUNTS,
    FACT_KEYS,
    KEY,
    NOTIFICATIONS,
    QUALITY_TARGETS,
    RISK_COLUMNS,
    SITE_PREFIX,
    SourceSpec,
)
from tidymart.operators.merge import merge_qc, merge_sources
from tidymart.operators.observe import key_report, key_sums, observed_metrics, write_observed
from tidymart.operators.profile import text_columns
from tidymart.operators.quality import QualitySpec, metric_parts, quality_gate, scorecard_of
from tidymart.operators.schema import check_rows
from tidymart.operators.star import build_dimensions, build_fact, load_stats, new_facts, number_facts
from tidymart.operators.tidy import tidy
from tidymart.session import written
from tidymart.sources.files import write_report
from tidymart.sources.tables import FACT_TABLE, loaded_before, read_star, write_star


@dataclass(frozen=True)
class MartSpec:
    a: SourceSpec = CONSUMPTION
    b: SourceSpec = NOTIFICATIONS
    site_prefix: str = SITE_PREFIX
    risk_columns: tuple[str, ...] = RISK_COLUMNS
    quality: QualitySpec = QualitySpec()


@dataclass(frozen=True)
class Mart:
    tidy_a: DataFrame
    tidy_b: DataFrame
    merged: DataFrame
    report_a: DataFrame
    report_b: DataFrame
    match: DataFrame
    scorecard: DataFrame
    gate: DataFrame
    fact: DataFrame
    dimensions: Mapping[str, DataFrame]
    stats: DataFrame
    set_aside: DataFrame


@dataclass(frozen=True)
class Load:
    """A loaded star: the facts of the load, the members as of it, and the rows that broke a constraint with their reason."""

    fact: DataFrame
    dimensions: Mapping[str, DataFrame]
    set_aside: DataFrame


#: Why a fact is refused: a key without a member, as in a database that looks it up, or a count that is missing.
FACT_CONTRACT = {key: f"no member of {table}" for table, (key, _) in DIMENSIONS.items()} | {
    c: f"null {c}" for c in FACT_COUNTS
}


def checked_facts(fact: DataFrame, dimensions: Mapping[str, DataFrame], name: str) -> tuple[DataFrame, DataFrame]:
    """The facts that keep the contract, and the others with ``reason`` and ``copies``.

    Both are parts of one written table: the rows are checked while they are written, once.
    """
    foreign = {key: dimensions[table] for table, (key, _) in DIMENSIONS.items()}
    marked = check_rows(fact, FACT_CONTRACT, FACT_KEYS, foreign).withColumn("accepted", F.col("reason").isNull())
    stored = written(marked, name, ["accepted"])
    return stored.where("accepted").select(*fact.columns), stored.where("not accepted").drop("accepted")


def load_star(
    merged: DataFrame,
    folder: str,
    load: str,
    site_prefix: str = SITE_PREFIX,
    existing: Mapping[str, DataFrame] | None = None,
) -> Load:
    """Load a merged table into the star in `folder`, whatever it comes from.

    Members that other loads know keep their ids; ``existing`` names other ones to start from. Rows without a year have
    no member and are set aside, as are missing counts and repeated keys; they stay as the table
    ``set_aside`` of the load. A fact whose keys are loaded already is left out, and numbers follow the highest one.
    """
    spark = merged.sparkSession
    loaded, members = loaded_before(spark, folder, load)
    dimensions = build_dimensions(merged.where(F.col("anio").isNotNull()), members if existing is None else existing)
    fact, refused = checked_facts(build_fact(merged, dimensions, site_prefix), dimensions, "facts")
    highest = 0
    if loaded is not None:
        fact = new_facts(fact, loaded)
        highest = loaded.agg(F.max("id_fact")).first()[0] or 0
    write_star(number_facts(fact, dimensions, highest), dimensions, folder, load)
    path = f"{folder}/set_aside/load={load}"
    refused.write.mode("overwrite").parquet(path)
    return Load(
        fact=spark.read.parquet(f"{folder}/{FACT_TABLE}/load={load}"),
        dimensions=read_star(spark, folder, load)[1],
        set_aside=spark.read.schema(refused.schema).parquet(path),
    )


def build_mart(
    raw_a: DataFrame,
    raw_b: DataFrame,
    folder: str,
    load: str,
    spec: MartSpec = MartSpec(),
    existing: Mapping[str, DataFrame] | None = None,
) -> Mart:
    """Clean, join, score and load; every stage is a Parquet table that the next one reads.

    Written stages keep the raw tables from being read again, and give the planner true sizes. The reports of the tidy
    tables and the scorecard are observed while their stages are written: the tidy tables are grouped by their keys, so no
    key repeats and no two merged rows are equal, and everything else adds up row by row.
    Running the same load again replaces its tables. A load adds to the other loads in the folder: members keep
    their ids (``existing`` names other ones to start from), facts whose keys are loaded are left out, and the
    numbers of new facts follow the highest loaded one.
    """
    spark = raw_a.sparkSession

    def place(name: str) -> str:
        return f"{folder}/{name}/load={load}"

    def stage(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(place(name))
        return spark.read.parquet(place(name))

    def tidy_stage(df: DataFrame, name: str, key: list[str]) -> tuple[DataFrame, DataFrame]:
        table, seen = write_observed(df, place(name), key_sums(df, key))
        return table, key_report(spark, seen, key, text_columns(df, key))

    tidy_a, report_a = tidy_stage(tidy(raw_a, spec.a), "tidy_a", list(KEY))
    tidy_b, report_b = tidy_stage(tidy(raw_b, spec.b, split_class=True), "tidy_b", [*KEY, CLASS_COLUMN])
    clean = {"refold": False}
    joined = merge_sources(
        tidy_a,
        tidy_b,
        site_prefix=spec.site_prefix,
        risk_columns=spec.risk_columns,
        null_safe=(),
        **clean,
    )
    merged, seen = write_observed(joined, place("merged"), metric_parts(joined, spec.quality))
    scorecard = scorecard_of(observed_metrics(spark, seen, QUALITY_TARGETS, spec.quality))
    reports = {
        "report_a": report_a,
        "report_b": report_b,
        "match": merge_qc(tidy_a, tidy_b, **clean),
        "scorecard": scorecard,
        "gate": quality_gate(scorecard),
    }
    reports = {name: stage(report, name) for name, report in reports.items()}
    for name, report in reports.items():
        write_report(report, f"{folder}/reports/load={load}/{name}")

    star = load_star(merged, f"{folder}/star", load, spec.site_prefix, existing)
    return Mart(
        tidy_a=tidy_a,
        tidy_b=tidy_b,
        merged=merged,
        fact=star.fact,
        dimensions=star.dimensions,
        stats=load_stats(star.fact),
        set_aside=star.set_aside,
        **reports,
    )


def mart_summary(mart: Mart) -> DataFrame:
    """(stage, metric, value): what the job did, as one long table."""

    def lines(df: DataFrame, stage: str, columns) -> DataFrame:
        wide = df.select(*(F.col(c).cast("double").alias(c) for c in columns))
        long = wide.unpivot([], list(columns), "metric", "value")
        return long.select(F.lit(stage).alias("stage"), "metric", "value")

    match = [c for c in mart.match.columns if c != "key_used"]
    quality = mart.scorecard.select(
        F.lit("quality").alias("stage"), F.col("metrica").alias("metric"), F.col("valor").alias("value")
    )
    return (
        lines(mart.match, "merge", match)
        .unionByName(quality)
        .unionByName(lines(mart.stats, "load", mart.stats.columns))
    )
