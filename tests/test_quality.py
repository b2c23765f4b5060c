import golden
import pytest
from helpers import rows

from tidymart.contracts import QUALITY_TARGETS
from tidymart.operators import quality

GOLDEN = {"completitud": 96.88, "exactitud": 87.5, "consistencia": 100.0, "unicidad": 100.0, "validez": 100.0, "actualidad": 100.0}


def test_golden_metrics_one_by_one_and_together(spark, tmp_path):
    merged = golden.merged(spark, tmp_path)
    assert len(merged.columns) == 16
    assert quality.quality_metrics(merged, golden.RULES).first().asDict() == GOLDEN
    for name, value in GOLDEN.items():
        assert quality.quality_metric(merged, name, golden.RULES).first()[0] == value


def test_repeated_rows_weigh_in_every_metric(spark, tmp_path):
    merged = golden.merged(spark, tmp_path)
    twice = merged.unionByName(merged.where("casos_spa = 0"))
    together = quality.quality_metrics(twice, golden.RULES).first().asDict()
    apart = {n: quality.quality_metric(twice, n, golden.RULES).first()[0] for n in GOLDEN}
    assert together == apart
    assert together["unicidad"] == 80.0


def test_scorecard_and_gate(spark, tmp_path):
    card = quality.quality_scorecard(golden.merged(spark, tmp_path), golden.RULES)
    by_name = {r.metrica: r for r in card.collect()}
    assert list(by_name) and set(by_name) == set(QUALITY_TARGETS)
    assert by_name["completitud"].cumple and not by_name["exactitud"].cumple
    assert by_name["unicidad"].observaciones == "No hay duplicados"
    assert rows(quality.quality_gate(card)) == [(False, "ADVERTENCIAS", "exactitud")]
    assert rows(quality.quality_gate(card.where("cumple"), enforce=True)) == [(True, "APROBADO", "")]
    with pytest.raises(Exception, match="quality gate: exactitud"):
        quality.quality_gate(card, enforce=True).collect()


def test_consistency_counts_rows_without_cases_but_with_parts(spark):
    df = spark.createDataFrame([(0, 1, 0, 0), (0, 0, 0, 2), (3, 1, 1, 1), (0, None, 5, 1)], "casos_spa int, s int, casos_sui int, r int")
    spec = quality.QualitySpec(rules=(("casos_spa", ("s",)), ("casos_sui", ("r",))))
    # 1 of 3 rows wrong, 1 of 2 rows wrong -> (2/3 + 1/2) / 2
    assert quality.quality_metric(df, "consistencia", spec).first()[0] == 58.33


def test_validity_can_exceed_one_hundred(spark):
    df = spark.createDataFrame(
        [("infancia", "5. x"), ("infancia", "6. x"), ("adultez", "sin dato"), ("adultez", "9. x"), ("primera infancia", "1. x"), ("vejez", None)],
        "ciclo_vida string, nivel_educativo string",
    )
    # valid: infancia 5, both adultez, vejez = 4; numeric levels = 4
    assert quality.quality_metric(df, "validez").first()[0] == 100.0
    assert quality.quality_metric(df.where("ciclo_vida in ('adultez', 'vejez')"), "validez").first()[0] == 300.0


def test_nothing_to_measure_is_null(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert quality.quality_metric(df, "exactitud").first()[0] is None
    assert quality.quality_metric(df, "actualidad").first()[0] is None
    years = spark.createDataFrame([(None,), (2015,), (2026,), (2025,)], "anio int")
    assert quality.quality_metric(years, "actualidad").first()[0] == 66.67
    assert quality.uniqueness(df.limit(0)).first()[0] is None
