import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm.queries import ORACLE, QUERIES

FOLDER = os.environ.get("TIDYMART_TEST_FOLDER", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], FOLDER).cache())
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_filters_return_the_columns_of_documents(stages):
    for df in stages[1:5]:
        assert df.columns == stages[0].columns
        assert ids(df) <= ids(stages[0])


def test_toxicity_drops_what_the_query_predicts(spark, stages):
    predicted = {r["doc_id"] for r in QUERIES["op7_toxicity_fm"](spark, FOLDER).filter("predicted = 1").collect()}
    assert ids(stages[0]) - ids(stages[1]) == predicted


def test_one_of_each_text_stays(stages):
    kept = stages[1].groupBy(F.coalesce("text", F.lit("")).alias("t")).agg(F.max("doc_id").alias("i")).select("i").collect()
    assert ids(stages[2]) == {r["i"] for r in kept}


def test_one_of_each_linked_group_stays(stages):
    from test_jaccard_join import expected

    rows = [(r["doc_id"], r["text"]) for r in stages[2].select("doc_id", "text").collect()]
    assert ids(stages[3]) == {i for i, _, c in expected(rows, corpus_pipeline.Threshold()) if i == c}


def test_documents_with_benchmark_items_go(spark, stages):
    from test_decontaminate import words

    items = [" ".join(words(r["text"])) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for r in stages[4].collect():
        text = f" {' '.join(words(r['text']))} "
        assert not any(f" {item} " in text for item in items)
    gone = stages[3].join(stages[4], "doc_id", "left_anti").collect()
    assert len(gone) < 0.2 * stages[3].count()


def test_all_documents_that_are_left_are_packed(stages):
    assert ids(stages[5]) == ids(stages[4])


def test_run_equals_its_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(tuple, stages[5].collect()))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    found = QUERIES[name](spark, FOLDER)
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(repr, map(tuple, found.select(*columns).collect()))) == sorted(map(repr, cursor.fetchall()))


def test_empty_tables(spark, tmp_path):
    for t in ("documents", "pages", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    for name, query in QUERIES.items():
        assert query(spark, str(tmp_path)).count() == 0, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
