import random
from decimal import Decimal

import pandas as pd
import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidymart.operators import profile


@pytest.fixture(scope="module")
def frame(spark):
    dice = random.Random(7)
    data = [
        (
            dice.choice(["a", "a", "a", "b", "sin dato", None]),
            dice.choice(["x", "y", None]),
            dice.choice([None, *range(5)]),
            dice.gauss(10, 300) if dice.random() < 0.9 else None,
        )
        for _ in range(3000)
    ]
    df = spark.createDataFrame(data, "g string, h string, k int, v double").repartition(5)
    return df, pd.DataFrame(data, columns=["g", "h", "k", "v"])


def heavy_frame(spark):
    """A few heavy values among many rare ones, ties, nulls, and both zeros."""
    n = F.col("id")
    often = F.when(n % 3 == 0, F.concat(F.lit("h"), (n % 7).cast("string")))
    return spark.range(0, 60_000, 1, 6).select(
        F.when(n % 11 == 0, None).otherwise(F.coalesce(often, F.concat(F.lit("u"), n.cast("string")))).alias("skewed"),
        (n % 5).alias("few"),
        n.alias("even"),
        F.when(n % 2 == 0, F.lit(0.0)).when(n % 4 == 1, F.lit(-0.0)).otherwise(F.lit(float("nan"))).alias("x"),
        F.lit(None).cast("string").alias("none"),
    )


@pytest.mark.parametrize("column", ["skewed", "few", "even", "x", "none"])
@pytest.mark.parametrize("k", [1, 5, 12])
def test_heavy_values_are_the_most_frequent_ones(spark, column, k):
    df = heavy_frame(spark)
    want = profile.topk_frequency(df.withColumn("x", F.col("x") + 0.0), column, k)
    got = profile.topk_heavy(df, column, k, 256)
    assert [(repr(r[0]), r[1]) for r in got.collect()] == [(repr(r[0]), r[1]) for r in want.collect()]


def test_heavy_values_are_found_without_a_shuffle_of_values(spark):
    plan = profile.topk_heavy(heavy_frame(spark), "skewed", 5, 256)._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan  # the counted candidates, not the rows
    assert "Range" in profile.topk_heavy(heavy_frame(spark), "even", 5, 64)._jdf.queryExecution().optimizedPlan().toString()


def test_counts_per_column(frame):
    df, pdf = frame
    nulls = [tuple(r) for r in profile.null_counts(df).collect()]
    assert dict(nulls) == pdf.isna().sum().to_dict()
    assert [n for _, n in nulls] == sorted((n for _, n in nulls), reverse=True)
    assert dict(rows(profile.distinct_counts(df))) == pdf.nunique().to_dict()
    assert dict(rows(profile.sentinel_counts(df))) == {"g": int((pdf.g == "sin dato").sum()), "h": 0}
    approx = dict(rows(profile.distinct_counts_approx(df)))
    for column, exact in pdf.nunique().items():
        assert abs(approx[column] - exact) <= 0.1 * exact


def test_duplicates_count_all_members_and_null_equals_null(frame):
    df, pdf = frame
    key = ["g", "h", "k", "v"]
    assert profile.duplicate_key_rows(df, key).first()[0] == int(pdf.duplicated(key, keep=False).sum())
    assert profile.duplicate_key_rows(df.limit(0), key).first()[0] == 0


def test_frequencies(frame):
    df, pdf = frame
    counts = pdf.g.value_counts(dropna=False)
    out = profile.frequency_share(df, "g").collect()
    assert [r.n for r in out] == list(counts)
    assert {r.value: r.share for r in out} == {
        (None if pd.isna(k) else k): round(v / len(pdf), 4) for k, v in counts.items()
    }
    assert [(r.value, r.n) for r in profile.topk_frequency(df, "g", 2).collect()] == [
        (k, v) for k, v in pdf.g.value_counts().head(2).items()
    ]


def test_topk_sum_drops_the_null_group_and_counts_an_all_null_sum_as_zero(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None), (None, 9.0), ("c", 3.0)], "g string, v double")
    out = [tuple(r) for r in profile.topk_sum(df, "g", F.col("v"), 3).collect()]
    assert out == [("a", 3.0), ("c", 3.0), ("b", 0.0)]


def test_mode_takes_the_smallest_value_on_a_tie(spark):
    df = spark.createDataFrame([("p", v) for v in "baba"] + [("q", "z"), ("q", None), ("r", None), (None, "a")], "g string, v string")
    assert rows(profile.mode_by_group(df, "g", "v")) == [("p", "a", 2), ("q", "z", 1)]


@pytest.mark.parametrize("pieces,sortable", [(32, 1_000_000), (4, 300), (32, 5)])
def test_quantiles_are_exact(frame, pieces, sortable):
    df, pdf = frame
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    out = profile.quantiles(df, ["k", "v"], probabilities, pieces, sortable)
    got = {(r["column"], r.probability): r.value for r in out.collect()}
    for column in ("k", "v"):
        for p in probabilities:
            assert got[(column, p)] == pytest.approx(pdf[column].quantile(p), rel=1e-12)


def test_describe(frame):
    df, pdf = frame
    for row in profile.describe_numeric(df, ["k", "v"]).collect():
        expected = pdf[row["column"]].describe()
        assert list(row)[1:] == pytest.approx(list(expected[["count", "mean", "std", "min", "25%", "50%", "75%", "max"]]))
    for row in profile.describe_text(df, ["g", "h"]).collect():
        expected = pdf[row["column"]].describe()
        assert (row["count"], row.unique, row.freq) == (expected["count"], expected["unique"], expected["freq"])
        assert row.top == pdf[row["column"]].mode().iloc[0]


def test_describe_of_nothing(spark):
    df = spark.createDataFrame([(None, None)], "v double, t string")
    assert rows(profile.describe_numeric(df, ["v"])) == [("v", 0, None, None, None, None, None, None, None)]
    assert rows(profile.describe_text(df, ["t"])) == [("t", 0, 0, None, None)]


def test_duplicate_sample(spark):
    df = spark.createDataFrame([("b", 1, 5), ("b", 1, 4), ("a", None, 2), ("a", None, 3), ("c", 1, 1)], "g string, k int, v int")
    out = profile.duplicate_sample(df, ["g", "k"], ["g", "k", "v"], 3)
    assert [tuple(r) for r in out.collect()] == [("a", None, 2), ("a", None, 3), ("b", 1, 4)]


def test_pivot_tells_no_rows_from_no_numbers(spark):
    df = spark.createDataFrame(
        [("2020", "a", "1"), ("2020", "a", "2"), ("2020", "b", "x"), ("2021", "b", "4"), (None, "a", "1"), ("2021", None, "1")],
        "y string, z string, v string",
    )
    out = profile.pivot_sum(df, "y", "z", F.col("v").try_cast("double"), ["a", "b"])
    assert rows(out, "y", "a", "b") == [("2020", 3.0, 0.0), ("2021", None, 4.0)]


def test_qc_report(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "sin dato"), (2, None)], "anio int, upz string")
    out = profile.qc_report(df, ["anio", "upz"]).first()
    assert out.rows == 4 and out.duplicates_by_key == 2
    assert out.nulls_by_col.asDict() == {"anio": 1, "upz": 1}
    assert out.sin_dato_by_col.asDict() == {"upz": 1}


def test_column_profile(spark):
    df = spark.createDataFrame(
        [(1, "a", None, Decimal(1)), (2, "a", 5, Decimal(1)), (3, "b", None, Decimal(1)), (4, "b", 6, Decimal(1))],
        "i int, t string, n int, d decimal(5,0)",
    )
    out = {(r["column"], r.metric): (r.value, r.observation) for r in profile.column_profile(df).collect()}
    assert out[("i", "Tipo de dato")] == ("int", "Correcto")
    assert out[("t", "Tipo de dato")] == ("string", "Verificar formato de texto")
    assert out[("i", "Valores únicos")] == ("4", "Cumple unicidad total")
    assert out[("i", "Ejemplos de problemas")] == ("Ninguno", "Columna confiable")
    assert out[("t", "Ejemplos de problemas")] == ("[a, b]", "Revisar valores")
    assert out[("d", "Ejemplos de problemas")] == ("[1, 1, 1]", "Revisar valores")
    assert out[("n", "Valores nulos")] == ("2", "Presenta 2 nulos")
    # 4 rows, 3 kinds when null counts as one
    assert out[("n", "Duplicados")] == ("1", "1 duplicados encontrados")
    assert out[("n", "Ejemplos de problemas")] == ("[null, null]", "Revisar valores")


def test_pivot_leaves_no_value_out_unseen(spark):
    df = spark.createDataFrame([("1", "a", 1.0), ("1", "c", 2.0), ("1", "d", 4.0), ("2", "d", None)], "y string, z string, v double")
    with pytest.raises(Exception, match="no column is named for"):
        profile.pivot_sum(df, "y", "z", F.col("v"), ["a", "b"]).collect()
    out = profile.pivot_sum(df, "y", "z", F.col("v"), ["a", "b"], others="rest")
    assert out.columns == ["y", "a", "b", "rest"] and rows(out) == [("1", 1.0, None, 6.0), ("2", None, None, 0.0)]
