"""Upkeep of a mart by deltas: new raw rows are summed, added to the stored tables, and only touched years are written.

All sums of the tidy tables are additive, and the year is part of every key. So a delta changes the stored tables in its
own years alone: their sums, their merged rows, their part of the quality metrics, and their facts. A manifest per load
names for each table and year the version that holds it; versions that a delta does not touch stay as they are.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidymart.contracts import CLASS_COLUMN, DIMENSIONS, FACT_KEYS, KEY, SourceSpec
from tidymart.operators.merge import merge_sources
from tidymart.operators.quality import quality_gate, quality_parts, scorecard_of, stored_metrics
from tidymart.operators.star import build_dimensions, build_fact, load_stats, number_facts
from tidymart.operators.tidy import tidy
from tidymart.plans.mart import MartSpec, checked_facts
from tidymart.session import written

YEAR = KEY[0]
_MANIFEST = "seq bigint, load string, name string, year bigint, version string"


@dataclass
class Manifest:
    """Which version holds each year of each table, as of one load."""

    folder: str
    load: str
    seq: int
    versions: dict[tuple[str, int | None], str] = field(default_factory=dict)

    @classmethod
    def before(cls, spark: SparkSession, folder: str, load: str) -> Manifest:
        """What the load starts from: the last manifest before it. A repeated load starts where it did."""
        try:
            rows = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest/*").collect()  # a row per load, table and year
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            rows = []
        own = {r["seq"] for r in rows if r["load"] == load}
        last = max((r["seq"] for r in rows), default=0)
        seq = own.pop() if own else last + 1
        if seq < last:
            raise ValueError(f"load {load} can't be repeated, a later load adds to it")
        base = max((r["seq"] for r in rows if r["seq"] < seq), default=None)
        versions = {(r["name"], r["year"]): r["version"] for r in rows if r["seq"] == base}
        return cls(folder, load, seq, versions)

    def commit(self, spark: SparkSession) -> None:
        """Everything is written; from now on it counts."""
        rows = [(self.seq, self.load, name, year, version) for (name, year), version in self.versions.items()]
        table = spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.folder}/manifest/load={self.load}")

    def years(self, name: str) -> set[int]:
        return {year for n, year in self.versions if n == name and year is not None}

    def read(self, spark: SparkSession, name: str, years: Iterable[int] | None = None) -> DataFrame | None:
        """The stored rows of a table, of all years or of some; None where there are none. Only those years are read."""
        paths = defaultdict(list)
        for year in sorted(self.years(name) if years is None else self.years(name) & set(years)):
            version = self.versions[name, year]
            paths[version].append(f"{self.folder}/{name}/{version}/{YEAR}={year}")
        out = None
        for version, folders in paths.items():
            part = spark.read.option("basePath", f"{self.folder}/{name}/{version}").parquet(*folders)
            part = part.withColumn(YEAR, F.col(YEAR).cast("bigint"))
            out = part if out is None else out.unionByName(part)
        return out

    def put(self, df: DataFrame, name: str) -> list[int]:
        """Write rows as a new version of their years; years that are not in them keep theirs."""
        version = f"{self.load}-{uuid.uuid4().hex[:12]}"
        path = f"{self.folder}/{name}/{version}"
        df.write.partitionBy(YEAR).parquet(path)
        try:
            found = df.sparkSession.read.parquet(path).select(F.col(YEAR).cast("bigint")).distinct().collect()
        except AnalysisException as empty:
            if "UNABLE_TO_INFER_SCHEMA" not in str(empty):
                raise
            found = []
        years = sorted(r[0] for r in found)  # as many as the data have years
        self.versions |= {(name, year): version for year in years}
        return years


@dataclass(frozen=True)
class Refreshed:
    """The mart as of a load, the years that the load touched, and the rows it set aside with their reason.

    A table without rows is None: as long as the sources have no key in common there is nothing behind the tidy tables.
    """

    touched: tuple[int, ...]
    tidy_a: DataFrame | None
    tidy_b: DataFrame | None
    merged: DataFrame | None
    scorecard: DataFrame | None
    gate: DataFrame | None
    fact: DataFrame | None
    dimensions: Mapping[str, DataFrame]
    stats: DataFrame | None
    set_aside: DataFrame | None


def _added(manifest: Manifest, delta: DataFrame, name: str, key: list[str]) -> list[int]:
    """Add the sums of a delta to the stored sums of its years."""
    spark = delta.sparkSession
    years = [r[0] for r in delta.select(YEAR).distinct().collect()]
    stored = manifest.read(spark, name, years)
    every = manifest.read(spark, name)
    if every is not None and set(every.columns) != set(delta.columns):
        raise ValueError(f"the columns of {name} have changed, build the mart anew: {sorted(set(every.columns) ^ set(delta.columns))}")
    if stored is not None:
        sums = [c for c in delta.columns if c not in key]
        delta = stored.unionByName(delta).groupBy(*key).agg(*(F.sum(c).alias(c) for c in sums))
    return manifest.put(delta, name)


def _summed(raw: DataFrame, spec: SourceSpec, name: str, split_class: bool) -> DataFrame:
    return written(tidy(raw, spec, split_class=split_class), f"delta-{name}")


def refresh_mart(raw_a: DataFrame, raw_b: DataFrame, folder: str, load: str, spec: MartSpec = MartSpec()) -> Refreshed:
    """Add the raw rows of a load to the mart in `folder`; the first load builds it.

    Every raw row belongs to one load. What is read and written follows the delta and the stored sums of its years: other years
    are not touched, and their versions are the same files afterwards. Members and facts keep their ids; facts of touched
    years have new measures. The scorecard adds up the stored parts of the years, so no merged row of another
    year is read for it.

    The last load may be repeated, after a failure or with other rows: it starts from the same manifest and replaces what
    it wrote. Files of failed attempts are named by no manifest. The tables must have the same columns in each load.
    """
    spark = raw_a.sparkSession
    manifest = Manifest.before(spark, folder, load)
    key_b = [*KEY, CLASS_COLUMN]
    touched = set(_added(manifest, _summed(raw_a, spec.a, "a", False), "tidy_a", list(KEY)))
    touched |= set(_added(manifest, _summed(raw_b, spec.b, "b", True), "tidy_b", key_b))

    sides = [manifest.read(spark, name, touched) for name in ("tidy_a", "tidy_b")]
    set_aside = None
    if all(side is not None for side in sides):
        options = {"site_prefix": spec.site_prefix, "risk_columns": spec.risk_columns}
        merged = merge_sources(*sides, refold=False, null_safe=(), **options)
        again = manifest.put(merged, "merged")
        rows = manifest.read(spark, "merged", again)
        if rows is not None:
            manifest.put(quality_parts(rows, YEAR, spec.quality), "parts")
            set_aside = _load_years(manifest, rows, again, spec)
    manifest.commit(spark)
    return _as_of(spark, manifest, tuple(sorted(touched)), set_aside, spec)


def _members(spark: SparkSession, manifest: Manifest) -> dict[str, DataFrame]:
    version = manifest.versions.get(("members", None))
    return {t: spark.read.parquet(f"{manifest.folder}/members/{version}/{t}") for t in DIMENSIONS} if version else {}


def _load_years(manifest: Manifest, merged: DataFrame, years: list[int], spec: MartSpec) -> DataFrame:
    """Load the merged rows of some years: members are added, facts of those years are written anew under their ids."""
    spark = merged.sparkSession
    dimensions = build_dimensions(merged, _members(spark, manifest))
    version = f"{manifest.load}-{uuid.uuid4().hex[:12]}"
    for table, members in dimensions.items():
        members.write.parquet(f"{manifest.folder}/members/{version}/{table}")
    manifest.versions["members", None] = version

    fact, refused = checked_facts(build_fact(merged, dimensions, spec.site_prefix), dimensions, "refreshed-facts")
    known, every = manifest.read(spark, "fact", years), manifest.read(spark, "fact")
    highest = 0
    numbered = None
    if every is not None:
        highest = every.agg(F.max("id_fact")).first()[0] or 0
    if known is not None:
        ids = known.select("id_fact", *FACT_KEYS)
        numbered = fact.join(ids, list(FACT_KEYS)).select("id_fact", *fact.columns)
        fact = fact.join(ids, list(FACT_KEYS), "left_anti")
    new = number_facts(fact, dimensions, highest)
    facts = new if numbered is None else numbered.unionByName(new)
    key, natural = DIMENSIONS["dim_tiempo"]
    dated = facts.join(dimensions["dim_tiempo"].select(key, F.col(natural[0]).cast("bigint").alias(YEAR)), key)
    manifest.put(dated, "fact")
    path = f"{manifest.folder}/set_aside/load={manifest.load}"
    refused.write.mode("overwrite").parquet(path)
    return spark.read.schema(refused.schema).parquet(path)


def _as_of(spark, manifest: Manifest, touched: tuple[int, ...], set_aside: DataFrame | None, spec: MartSpec) -> Refreshed:
    def table(name):
        return manifest.read(spark, name)

    parts, fact = table("parts"), table("fact")
    scorecard = None if parts is None else scorecard_of(stored_metrics(parts, YEAR, spec.quality))
    return Refreshed(
        touched=touched,
        tidy_a=table("tidy_a"),
        tidy_b=table("tidy_b"),
        merged=table("merged"),
        scorecard=scorecard,
        gate=None if scorecard is None else quality_gate(scorecard),
        fact=fact,
        dimensions=_members(spark, manifest),
        stats=None if fact is None else load_stats(fact.where(F.col(YEAR).isin(*touched))),
        set_aside=set_aside,
    )
