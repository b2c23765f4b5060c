import random
from dataclasses import replace

import golden
import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidymart.contracts import CONSUMPTION, KEY, NOTIFICATIONS
from tidymart.operators import schema, tidy
from tidymart.plans.driver_tables import SPEC_A, SPEC_B

SITES = ["SITIOHABITUALCONSUMO_VIVIENDA", "SITIOHABITUALCONSUMO_PARQUE"]
RISKS = ["maltrato_sexual", "conflicto_pareja"]


def test_golden_weighted(spark, tmp_path):
    assert rows(golden.tidy_a(spark, tmp_path), *KEY, "casos", *SITES) == golden.TIDY_A


def test_golden_counts(spark, tmp_path):
    assert rows(golden.tidy_b(spark, tmp_path), *KEY, "clasificacion", "casos", *RISKS) == golden.TIDY_B


def test_row_mode_keeps_rows_and_plain_flags(spark, tmp_path):
    out = tidy.tidy_rows(golden.raw_a(spark, tmp_path), CONSUMPTION)
    assert out.columns == [*KEY, "casos", *SITES]
    assert rows(out, "upz", "casos", *SITES) == [
        ("bosa", 1, 0, 0), ("engativa", 2, 0, 1), ("engativa", 3, 1, 0), ("suba", 0, 1, 0), ("suba", 4, 1, 1),
    ]


def test_aggregation_equals_sum_of_clean_rows(spark, tmp_path):
    for raw, spec, split in (
        (golden.raw_a(spark, tmp_path), CONSUMPTION, False),
        (golden.raw_b(spark, tmp_path), NOTIFICATIONS, True),
    ):
        clean = tidy.tidy_rows(raw, spec, split)
        flags = [c for c in clean.columns if c not in (*KEY, "clasificacion", "casos")]
        group = [*KEY, "clasificacion"] if split else list(KEY)
        slow = clean.groupBy(*group).agg(
            F.sum("casos").alias("casos"), *(F.sum(F.col(c) * F.col("casos")).alias(c) for c in flags)
        )
        fast = tidy.tidy(raw, spec, split)
        assert rows(fast, *slow.columns) == rows(slow)


def test_missing_required_column(spark):
    df = spark.createDataFrame([("2020", "x")], "ANO string, SEXO string")
    with pytest.raises(ValueError, match="CASOS.*NOMBREUPZ"):
        tidy.tidy(df, CONSUMPTION)


def test_class_falls_back_to_the_missing_label(spark, tmp_path):
    raw = golden.raw_b(spark, tmp_path).drop("clasificaciondelaconducta")
    out = tidy.tidy(raw, NOTIFICATIONS, split_class=True)
    assert {r.clasificacion for r in out.collect()} == {"sin dato"}
    second = raw.withColumn("clasificacion_conducta", F.lit("Intento"))
    assert {r.clasificacion for r in tidy.tidy(second, NOTIFICATIONS, split_class=True).collect()} == {"intento"}


def test_sites_match_in_any_case_and_risks_may_be_absent(spark, tmp_path):
    raw = golden.raw_a(spark, tmp_path).withColumnRenamed(SITES[0], "SitioHabitualConsumo_Vivienda")
    assert "SitioHabitualConsumo_Vivienda" in tidy.tidy(raw, CONSUMPTION).columns
    raw = golden.raw_b(spark, tmp_path).drop("maltrato_sexual")
    assert "maltrato_sexual" not in tidy.tidy(raw, NOTIFICATIONS).columns


def test_an_all_null_text_column_and_no_rows_keep_the_schema(spark, tmp_path):
    raw = golden.raw_a(spark, tmp_path).withColumn("NIVELEDUCATIVO", F.lit(None).cast("string"))
    out = tidy.tidy(raw, CONSUMPTION)
    assert out.count() == 0
    assert out.columns == [*KEY, "casos", *SITES]


def test_dropping_the_missing_zone_changes_nothing_after_the_strict_filter(spark, tmp_path):
    raw = golden.raw_a(spark, tmp_path)
    assert rows(tidy.tidy(raw, CONSUMPTION, drop_missing=True)) == rows(tidy.tidy(raw, CONSUMPTION))


def test_strict_filter(spark):
    df = spark.createDataFrame(
        [(2020, "a", "b", "c", "d"), (None, "a", "b", "c", "d"), (2020, " S/D ", "b", "c", "d"), (2020, "a", None, "c", "d"), (2020, "a", "b", "NAN", "d")],
        "anio long, upz string, sexo string, ciclo_vida string, nivel_educativo string",
    )
    assert rows(tidy.strict_key_filter(df)) == [(2020, "a", "b", "c", "d")]


def test_one_key_with_most_rows(spark):
    """A hot key and many spellings: the sums stay whole."""
    dice = random.Random(3)
    spellings = ["Suba", "SUBA", " suba", "Súba", "suba\t"]
    data = [
        ("2020", dice.choice(spellings) if dice.random() < 0.7 else f"zona {dice.randrange(50)}", "H", "Juventud", "1. x", str(dice.randrange(4)), dice.choice(["Sí", "no"]))
        for _ in range(5000)
    ]
    df = spark.createDataFrame(data, "ANO string, NOMBREUPZ string, SEXO string, CURSO_DE_VIDA string, NIVELEDUCATIVO string, CASOS string, SITIOHABITUALCONSUMO_PARQUE string").repartition(4)
    out = {r.upz: (r.casos, r.SITIOHABITUALCONSUMO_PARQUE) for r in tidy.tidy(df, CONSUMPTION).collect()}
    hot = [d for d in data if "zona" not in d[1]]
    assert out["suba"] == (sum(int(d[5]) for d in hot), sum(int(d[5]) for d in hot if d[6] == "Sí"))
    assert sum(v[0] for v in out.values()) == sum(int(d[5]) for d in data)


def test_plan_has_no_python_and_sums_before_each_shuffle(spark, tmp_path):
    a = tidy.tidy(golden.raw_a(spark, tmp_path), CONSUMPTION)
    b = tidy.tidy(golden.raw_b(spark, tmp_path), NOTIFICATIONS, split_class=True)
    for df in (a, b):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan
        assert plan.count("Exchange hashpartitioning") == 2
        assert "partial_sum" in plan
        # The raw rows are not filtered by folded text: no translate below the first aggregation.
        first = plan[plan.rindex("partial_sum"):]
        assert "- Filter" not in first


def test_specs_name_the_same_key():
    for spec in (CONSUMPTION, NOTIFICATIONS, SPEC_A, SPEC_B, replace(SPEC_A)):
        assert list(spec.rename.values()) == list(KEY)


def test_contract_checks(spark):
    fact = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (None, 3)], "a int, b int")
    dim = spark.createDataFrame([(1,), (2,)], "b int")
    assert rows(schema.not_null_violations(fact, ["a", "b"])) == [("a", 1), ("b", 0)]
    assert rows(schema.unique_violations(fact, ["a"])) == [(1, 2)]
    assert rows(schema.fk_orphans(fact, dim, "b")) == [(3, 1)]
    assert schema.select_rename(fact, {"a": "x", "zz": "y"}, ["a"]).columns == ["x"]


def test_texts_are_folded_once_and_below_no_filter(spark):
    """The optimizer must not move the filter on folded keys below their projection."""
    raw = spark.createDataFrame([tuple("x" * 9)], "ANO string, NOMBREUPZ string, SEXO string, CURSO_DE_VIDA string, NIVELEDUCATIVO string, CASOS string, SITIO_VIVIENDA string, SITIO_PARQUE string, LOCALIDAD string")
    for df, folds in (
        (tidy.tidy_rows(raw, SPEC_A), 6),
        (tidy.strict_key_filter(tidy.label_keys(raw, SPEC_A, pin=True)), 4),
        (tidy.tidy(raw, SPEC_A), 6),
    ):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("translate(") == folds
        assert not any("translate(" in line for line in plan.splitlines() if "Filter" in line)
