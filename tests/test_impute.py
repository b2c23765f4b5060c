import pytest
from helpers import rows

from tidymart.operators import impute

DATA = [
    ("L1", "Suba"), ("L1", "Suba"), ("L1", "Bosa"), ("L1", None), ("L1", "sin dato"), (" L1 ", "N.A."),
    ("L2", "Usme"), ("L2", "Bosa"), ("L2", ""), ("L3", "na"), (None, "s/d"), ("sin dato", None), ("sin dato", "Fontibón"),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(DATA, "loc string, upz string")


EXPECTED = sorted(
    [
        ("L1", "Suba"), ("L1", "Suba"), ("L1", "Bosa"), ("L1", "Suba"), ("L1", "Suba"), (" L1 ", "Suba"),
        ("L2", "Usme"), ("L2", "Bosa"), ("L2", "Bosa"), ("L3", None), (None, None), ("sin dato", None), ("sin dato", "Fontibón"),
    ],
    key=str,
)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_broadcast_and_shuffled_lookup_agree(spark, raw, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        check_imputed(impute.impute_mode(raw, "upz", "loc"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def check_imputed(out):
    assert out.columns == ["loc", "upz", impute.BEFORE, impute.AFTER]
    assert sorted([(r["loc"], r[impute.AFTER]) for r in out.collect()], key=str) == EXPECTED


def test_metrics_count_texts_that_became_null_as_imputed(raw):
    out = impute.impute_metrics(impute.impute_mode(raw, "upz", "loc")).first().asDict()
    assert out == {"antes_sin_dato": 5, "imputadas": 5, "aun_sin_dato": 0, "aun_sin_dato_o_nulo": 3, "resueltas": 4}


def test_before_and_after(raw):
    out = impute.before_after_topk(impute.impute_mode(raw, "upz", "loc"), 2)
    # Empty text is no spelling of "missing" for the pattern; the ties go by name.
    assert rows(out) == [("bosa", 2, 3), ("sin dato", 6, None), ("suba", None, 5)]
