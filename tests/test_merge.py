import random

import golden
from helpers import rows
from pyspark.sql import functions as F

from tidymart.contracts import KEY
from tidymart.operators import merge
from tidymart.sources import tables
from tidymart.sources.files import write_csv

RATIOS = [
    "pct_maltrato_sexual", "pct_conflicto_pareja",
    "pct_sitiohabitualconsumo_vivienda", "pct_sitiohabitualconsumo_parque",
]


def test_golden_merge(spark, tmp_path):
    out = golden.merged(spark, tmp_path)
    assert rows(out, "upz", "clasificacion", "casos_spa", "casos_sui", *RATIOS) == golden.MERGED


def test_golden_match_counts(spark, tmp_path):
    a, b = golden.tidy_a(spark, tmp_path), golden.tidy_b(spark, tmp_path)
    assert rows(merge.merge_qc(a, b)) == [(4, 5, 4, 1, 1, ",".join(KEY))]


def test_every_way_to_join_fills_measures_with_zero(spark, tmp_path):
    a, b = golden.tidy_a(spark, tmp_path), golden.tidy_b(spark, tmp_path)
    counts = {}
    for how in merge.HOW:
        out = merge.merge_sources(a, b, how=how)
        counts[how] = out.count()
        assert counts[how] == merge.merge_qc(a, b, how).first().rows_merged
        measures = [c for c in out.columns if c not in (*KEY, "clasificacion") and not c.startswith("pct_")]
        assert out.where(" or ".join(f"{c} is null" for c in (*measures, *KEY))).count() == 0
    assert counts == {"inner": 4, "left": 5, "right": 5, "outer": 6}
    lone = merge.merge_sources(a, b, how="left").where("upz = 'bosa'").first()
    assert (lone.casos_spa, lone.casos_sui, lone.clasificacion, lone.pct_maltrato_sexual) == (1, 0, None, None)


def test_ratios_are_optional(spark, tmp_path):
    assert not [c for c in golden.merged(spark, tmp_path, ratios=False).columns if c.startswith("pct_")]


def test_files_give_the_same_merge(spark, tmp_path):
    a, b = golden.tidy_a(spark, tmp_path), golden.tidy_b(spark, tmp_path)
    write_csv(a, str(tmp_path / "ta"))
    write_csv(b, str(tmp_path / "tb"))
    out = merge.load_and_merge(spark, str(tmp_path / "ta"), str(tmp_path / "tb"))
    direct = merge.merge_sources(a, b)
    assert dict(out.dtypes) == dict(direct.dtypes)
    assert rows(out, *direct.columns) == rows(direct)


def test_outside_tables_are_folded_and_a_null_year_matches_a_null_year(spark):
    a = spark.createDataFrame([(None, " SÚBA", "h", "x", "y", "3")], "anio long, upz string, sexo string, ciclo_vida string, nivel_educativo string, casos string")
    b = spark.createDataFrame([(None, "suba", "H", "X", "y", "5"), (2020, "suba", "H", "X", "y", "5")], a.schema)
    out = merge.merge_sources(a, b)
    assert rows(out) == [(None, "suba", "h", "x", "y", 3, 5)]
    assert rows(merge.merge_qc(a, b))[0][:5] == (1, 2, 1, 0, 1)


def test_class_in_the_key_only_when_both_sides_have_it(spark, tmp_path):
    a, b = golden.tidy_a(spark, tmp_path), golden.tidy_b(spark, tmp_path)
    assert merge.merge_key(a, b, True) == list(KEY)
    with_class = a.withColumn("clasificacion", F.lit("ideacion"))
    assert merge.merge_key(with_class, b, True) == [*KEY, "clasificacion"]
    assert merge.merge_sources(with_class, b, with_class=True).count() == 1
    both = merge.merge_sources(with_class, b).columns
    assert "clasificacion_spa" in both and "clasificacion_sui" in both


def test_match_counts_equal_real_joins_on_repeated_keys(spark):
    dice = random.Random(5)

    def side(n):
        return spark.createDataFrame(
            [(dice.randrange(4), dice.choice("ab"), "s", "c", "n", 1) for _ in range(n)],
            "anio long, upz string, sexo string, ciclo_vida string, nivel_educativo string, casos long",
        )

    a, b = side(30).where("not (anio = 1 and upz = 'a')"), side(40).where("anio <> 2")
    for how in merge.HOW:
        qc = merge.merge_qc(a, b, how).first()
        assert qc.rows_merged == merge.merge_sources(a, b, how=how).count()
    assert qc.spa_without_match == a.join(b, list(KEY), "left_anti").count()
    assert qc.sui_without_match == b.join(a, list(KEY), "left_anti").count()


def test_an_empty_side(spark, tmp_path):
    a, b = golden.tidy_a(spark, tmp_path), golden.tidy_b(spark, tmp_path)
    assert rows(merge.merge_qc(a.limit(0), b.limit(0)))[0][:5] == (0, 0, 0, 0, 0)
    assert rows(merge.merge_qc(a.limit(0), b))[0][:5] == (0, 5, 0, 0, 5)


def test_bucketed_tables_join_and_group_without_moving_rows(spark, tmp_path):
    a, b = golden.tidy_a(spark, tmp_path), golden.tidy_b(spark, tmp_path)
    plain = merge.merge_sources(a, b, refold=False, null_safe=())
    sides = [
        tables.write_bucketed(df, f"merge_{name}", str(tmp_path / name), KEY, 4) for name, df in (("a", a), ("b", b))
    ]
    again = [
        tables.open_bucketed(spark, f"again_{name}", str(tmp_path / name), df.schema, KEY, 4) for name, df in (("a", a), ("b", b))
    ]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for pair in (sides, again):
            merged = merge.merge_sources(*pair, refold=False, null_safe=())
            assert rows(merged, *plain.columns) == rows(plain)
            assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
            sums = merged.groupBy(*KEY, "clasificacion").count()
            assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in ("merge_a", "merge_b", "again_a", "again_b"):
            spark.sql(f"drop table {name}")
