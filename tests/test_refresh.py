import os

import golden
import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidymart.contracts import SITE_PREFIX
from tidymart.operators import star
from tidymart.operators.merge import merge_sources
from tidymart.operators.quality import quality_scorecard
from tidymart.operators.schema import check_rows
from tidymart.operators.tidy import tidy
from tidymart.plans.mart import FACT_CONTRACT, MartSpec, load_star
from tidymart.plans.refresh import refresh_mart

SPEC = MartSpec(site_prefix=SITE_PREFIX, quality=golden.RULES)


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def full(a, b):
    merged = merge_sources(tidy(a, SPEC.a), tidy(b, SPEC.b, split_class=True), site_prefix=SITE_PREFIX, refold=False, null_safe=())
    dimensions = star.build_dimensions(merged)
    fact = star.build_fact(merged, dimensions)
    return merged, quality_scorecard(merged, SPEC.quality), star.denormalize(fact, dimensions)


def test_deltas_equal_a_full_build(spark, tmp_path):
    a, b = golden.raw_a(spark, tmp_path).cache(), golden.raw_b(spark, tmp_path).cache()
    folder = str(tmp_path / "mart")
    early = refresh_mart(a.where("ANO like '%2020'"), b.where("ano_notificacion = '2020'"), folder, "1", SPEC)
    assert early.touched == (2020,) and early.fact.count() == 3
    before = files(folder)
    ids = {r[0]: tuple(r[1:]) for r in early.fact.select("id_fact", *star.FACT_KEYS).collect()}

    late_a = a.where("ANO not like '%2020' or ANO is null")
    late_b = b.where("ano_notificacion <> '2020'")
    later = refresh_mart(late_a, late_b, folder, "2", SPEC)
    assert set(later.touched) == {2021, 2022}
    # Nothing of the other year was written, and what is read for it are the files of the first load.
    after = files(folder)
    assert all(after[f] == t for f, t in before.items())
    assert not [f for f in after if f not in before and "anio=2020" in f]
    assert {f for f in later.tidy_a.inputFiles() if "anio=2020" in f} == {f for f in early.tidy_a.inputFiles()}

    merged, scorecard, wide = full(a, b)
    assert rows(later.merged.select(*merged.columns)) == rows(merged)
    assert rows(later.scorecard) == rows(scorecard)
    found = star.denormalize(later.fact.drop("anio"), later.dimensions)
    naturals = [*star.NATURAL, *star.FACT_MEASURES]
    assert rows(found.select(*naturals)) == rows(wide.select(*naturals))
    now = {r[0]: tuple(r[1:]) for r in later.fact.select("id_fact", *star.FACT_KEYS).collect()}
    assert sorted(now) == [1, 2, 3, 4] and all(now[k] == v for k, v in ids.items())
    assert rows(later.stats) == [(1, 1, 1, 1, 1)]

    # More rows of a year that is there: sums, merged rows and facts of that year change, ids stay.
    third = refresh_mart(a.where("ANO = '2020'"), b.limit(0), folder, "3", SPEC)
    assert third.touched == (2020,)
    merged, scorecard, _ = full(a.union(a.where("ANO = '2020'")), b)
    assert rows(third.merged.select(*merged.columns)) == rows(merged) and rows(third.scorecard) == rows(scorecard)
    assert {r[0]: tuple(r[1:]) for r in third.fact.select("id_fact", *star.FACT_KEYS).collect()} == now
    assert third.set_aside.count() == 0 and rows(third.gate, "estado") == [("ADVERTENCIAS",)]

    # The last load may be repeated, with the same result; an earlier one may not.
    again = refresh_mart(a.where("ANO = '2020'"), b.limit(0), folder, "3", SPEC)
    assert rows(again.merged.select(*merged.columns)) == rows(merged)
    with pytest.raises(ValueError, match="later load"):
        refresh_mart(late_a, late_b, folder, "2", SPEC)
    with pytest.raises(ValueError, match="columns of tidy_a"):
        refresh_mart(a.withColumn(SITE_PREFIX + "OTRO", F.lit("si")), b, folder, "4", SPEC)


def test_a_delta_without_rows_changes_nothing(spark, tmp_path):
    a, b = golden.raw_a(spark, tmp_path), golden.raw_b(spark, tmp_path)
    folder = str(tmp_path / "mart")
    first = refresh_mart(a, b, folder, "1", SPEC)
    before = files(f"{folder}/fact")
    none = refresh_mart(a.limit(0), b.limit(0), folder, "2", SPEC)
    assert none.touched == () and files(f"{folder}/fact") == before
    assert rows(none.fact) == rows(first.fact) and rows(none.scorecard) == rows(first.scorecard)


def test_sources_that_meet_later(spark, tmp_path):
    a, b = golden.raw_a(spark, tmp_path), golden.raw_b(spark, tmp_path)
    folder = str(tmp_path / "mart")
    alone = refresh_mart(a, b.limit(0), folder, "1", SPEC)
    assert alone.merged is None and alone.fact is None and alone.tidy_b is None and alone.tidy_a.count() == 4
    both = refresh_mart(a.limit(0), b, folder, "2", SPEC)
    assert rows(both.merged.select(*full(a, b)[0].columns)) == rows(full(a, b)[0])


def test_rows_that_break_a_constraint(spark):
    parents = spark.createDataFrame([(1,), (2,)], "k int")
    data = [(1, "a", 5), (1, "a", 5), (1, "a", 3), (2, "b", None), (2, None, 1), (3, "c", 1), (None, "d", 1), (None, "d", 1), (2, "c", 7)]
    df = spark.createDataFrame(data, "k int, t string, n int")
    out = check_rows(df, {"k": "no k", "n": "null n"}, ["k", "t"], {"k": parents})
    assert rows(out) == sorted(
        [(1, "a", 3, None, 1), (1, "a", 5, "repeated key", 2), (2, "b", None, "null n", 1), (2, None, 1, None, 1)]
        + [(3, "c", 1, "no row for k", 1), (None, "d", 1, "no k", 2), (2, "c", 7, None, 1)],
        key=lambda t: tuple((v is not None, str(v)) for v in t),
    )
    assert out.agg(F.sum("copies")).first()[0] == len(data)
    assert check_rows(df.limit(0), {"k": "no k"}, ["k"]).count() == 0


def test_a_load_sets_bad_rows_aside(spark, tmp_path):
    merged = golden.merged(spark, tmp_path)
    bad = merged.withColumn("anio", F.lit(None).cast("bigint")).limit(1)
    repeated = merged.limit(1)
    broken = merged.withColumn("casos_sui", F.lit(None).cast("bigint")).withColumn("upz", F.lit("otra")).limit(1)
    load = load_star(merged.union(bad).union(repeated).union(broken), str(tmp_path / "star"), "1")
    assert rows(load.set_aside, "reason", "copies") == [("no member of dim_tiempo", 1), ("null casos_sui", 1), ("repeated key", 1)]
    assert load.fact.count() == 4 and set(FACT_CONTRACT) <= set(load.set_aside.columns)
    # Loading again replaces the table of refused rows; loading more adds its own.
    load_star(merged, str(tmp_path / "star"), "1")
    assert spark.read.parquet(str(tmp_path / "star" / "set_aside")).count() == 0
