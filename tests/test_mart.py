import json

import golden
from helpers import rows

from pyspark.sql import functions as F

from tidymart.contracts import KEY, QUALITY_TARGETS, SITE_PREFIX
from tidymart.operators.observe import key_report, observed_metrics, write_observed
from tidymart.operators.profile import qc_report
from tidymart.operators.quality import metric_parts, quality_scorecard
from tidymart.plans.driver_tables import QUALITY_HERE
from tidymart.plans.mart import MartSpec, build_mart, mart_summary
from tidymart.plans.oracle import MERGED_COLUMNS
from tidymart.sources.tables import read_star


def test_whole_job_and_a_second_load(spark, tmp_path):
    a, b = golden.raw_a(spark, tmp_path), golden.raw_b(spark, tmp_path)
    folder, spec = str(tmp_path / "mart"), MartSpec(site_prefix=SITE_PREFIX, quality=golden.RULES)
    first = build_mart(a, b.where("ano_notificacion <> '2020'"), folder, "1", spec)
    assert rows(first.stats) == [(1, 1, 1, 1, 1)]
    known = read_star(spark, f"{folder}/star", "1")[1]

    second = build_mart(a, b, folder, "2", spec, known)
    assert rows(second.dimensions["dim_tiempo"]) == [(1, 2021), (2, 2020)]
    assert rows(second.dimensions["dim_ubicacion"]) == [(1, "suba"), (2, "engativa")]
    # The fact of the first load is left out of the second, and numbers go on.
    facts = read_star(spark, f"{folder}/star", "2")[0]
    assert sorted(r.id_fact for r in facts.collect()) == [1, 2, 3, 4]
    assert rows(second.stats)[0][0] == 3
    summary = {(r.stage, r.metric): r.value for r in mart_summary(second).collect()}
    assert summary[("merge", "rows_merged")] == 4.0
    assert summary[("quality", "completitud")] == 96.88
    assert summary[("load", "dimensiones_perfil")] == 2.0

    report = next((tmp_path / "mart" / "reports" / "load=2" / "report_b").glob("*.json"))
    assert json.loads(report.read_text()) == {
        "rows": 5,
        "nulls_by_col": dict.fromkeys(["anio", "upz", "sexo", "ciclo_vida", "nivel_educativo", "clasificacion"], 0),
        "sin_dato_by_col": {**dict.fromkeys(["upz", "sexo", "ciclo_vida", "nivel_educativo"], 0), "clasificacion": 1},
        "duplicates_by_key": 0,
    }

    # Running the load again replaces its tables.
    loaded = rows(second.fact)
    again = build_mart(a, b, folder, "2", spec, known)
    assert read_star(spark, f"{folder}/star", "2")[0].count() == 4
    assert rows(again.fact) == loaded
    # Loaded members are known by default, and a third load of the same data adds nothing.
    third = build_mart(a, b, folder, "3", spec)
    assert rows(third.dimensions["dim_tiempo"]) == [(1, 2021), (2, 2020)]
    assert third.fact.count() == 0 and read_star(spark, f"{folder}/star", "3")[0].count() == 4


def test_observed_reports_equal_those_that_read_the_stages(spark, tmp_path):
    a, b = golden.raw_a(spark, tmp_path), golden.raw_b(spark, tmp_path)
    spec = MartSpec(site_prefix=SITE_PREFIX, quality=golden.RULES)
    for name, part in (("all", b), ("none", b.where("ano_notificacion = '1900'"))):
        mart = build_mart(a, part, str(tmp_path / f"observed-{name}"), "1", spec)
        assert rows(mart.report_a) == rows(qc_report(mart.tidy_a, KEY))
        assert rows(mart.report_b) == rows(qc_report(mart.tidy_b, [*KEY, "clasificacion"]))
        assert rows(mart.scorecard) == rows(quality_scorecard(mart.merged, golden.RULES))
        again = qc_report(mart.tidy_b, [*KEY, "clasificacion"])
        assert mart.report_b.schema.simpleString() == again.schema.simpleString()


def test_observed_sums_need_no_other_read(spark, tmp_path):
    path = str(tmp_path / "table")
    table, seen = write_observed(spark.range(10).repartition(3), path, {"n": F.count(F.lit(1)), "s": F.sum("id")})
    assert seen == {"n": 10, "s": 45} and table.count() == 10
    for report in (key_report(spark, {"rows": 1, "nulls_id": 0}, ["id"], []), observed_metrics(spark, observed_parts(spark), QUALITY_TARGETS)):
        assert report.inputFiles() == [] and report.count() == 1


def observed_parts(spark):
    frame = spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in MERGED_COLUMNS.items()))
    return dict.fromkeys(metric_parts(frame, QUALITY_HERE))
