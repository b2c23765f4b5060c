import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidymart.operators import sketches


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(30_000).select(
        "id", (F.col("id") * 7919 % 12_007).alias("many"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("few"),
        F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).otherwise(F.pow(F.col("id") / 1000, 2)).alias("x"),
        F.lit(None).cast("double").alias("none"),
    )
    return df.repartition(5).cache()


def stored(spark, table, folder, loads):
    for k in range(loads):
        part = table.where(F.col("id") % loads == k)
        sketches.store_sketches(sketches.sketch_columns(part, ["many", "few", "none"], ["x", "none"]), folder, str(k))
    return sketches.stored_sketches(spark, folder)


@pytest.mark.parametrize("loads", [1, 8])
def test_merged_sketches_are_within_their_error(spark, table, tmp_path, loads):
    kept = stored(spark, table, str(tmp_path), loads)
    counts = dict(rows(sketches.merged_distinct_counts(kept)))
    assert abs(counts["many"] - 12_007) <= 5 * sketches.distinct_error() * 12_007
    assert counts["few"] == 5 and counts["none"] == 0
    values = sorted(r[0] for r in table.where("not isnan(x)").select("x").collect())
    found = sketches.merged_quantiles(kept, (0.1, 0.25, 0.5, 0.9)).collect()
    assert {r["column"] for r in found} == {"x"} and len(found) == 4
    for r in found:
        assert r["n"] == len(values)
        rank = sum(v <= r["value"] for v in values) / len(values)
        assert abs(rank - r["probability"]) < 3 * sketches.rank_error()


def test_a_repeated_load_replaces_its_sketch_and_no_row_is_read_again(spark, table, tmp_path):
    folder = str(tmp_path)
    kept = stored(spark, table, folder, 2)
    before = dict(rows(sketches.merged_distinct_counts(kept)))
    sketches.store_sketches(sketches.sketch_columns(table.where("id % 2 = 1"), ["many", "few", "none"], ["x", "none"]), folder, "1")
    again = sketches.merged_distinct_counts(sketches.stored_sketches(spark, folder))
    assert dict(rows(again)) == before
    assert all("/load=" in f for f in again.inputFiles()) and len(again.inputFiles()) == 2


def test_an_empty_load(spark, table, tmp_path):
    sketches.store_sketches(sketches.sketch_columns(table.limit(0), ["few"], ["x"]), str(tmp_path), "0")
    kept = sketches.stored_sketches(spark, str(tmp_path))
    assert rows(sketches.merged_distinct_counts(kept)) in ([], [("few", 0)])
    assert sketches.merged_quantiles(kept).count() == 0
