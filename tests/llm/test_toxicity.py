import random

import numpy as np
import pytest
from cases import documents, prose
from pyspark.sql import functions as F

from llm.queries import QUERIES
from llm.toxicity import Model, drop_toxic, fit, raw_scores, score, train


def pairs_table(spark, n=600):
    """Toxic is an insult with a group word; either alone is clean."""
    r = random.Random(1)
    texts, labels = [], []
    for i in range(1, n + 1):
        insult, group = r.random() < 0.5, r.random() < 0.5
        words = prose(r, 30).split() + ["vermin!"] * insult + ["Hillfolk"] * group
        r.shuffle(words)
        texts.append(" ".join(words))
        labels.append((i, int(insult and group), 5, "x"))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int, score int, text string")


def test_pairs_are_learned(spark):
    docs, labels = pairs_table(spark)
    model = train(docs, labels.filter("doc_id <= 400"))
    found = score(docs, model).join(labels.select("doc_id", "toxic"), "doc_id").filter("doc_id > 400").collect()
    right = np.mean([(r["score"] >= 0.5) == bool(r["toxic"]) for r in found])
    assert right > 0.95
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    left = kept.join(labels.select("doc_id", "toxic"), "doc_id").agg(F.sum("toxic"), F.count("*")).first()
    assert left[0] < 15 and left[1] > 430


def test_raw_scores_equal_the_sum_over_pairs():
    r = np.random.default_rng(2)
    model = Model(np.arange(9, dtype=np.uint64), 0.3, r.normal(size=9), r.normal(size=(9, 3)))
    present = [0, 3, 4, 8]
    want = 0.3 + sum(model.weights[i] for i in present)
    want += sum(model.factors[i] @ model.factors[j] for k, i in enumerate(present) for j in present[:k])
    assert raw_scores(np.array(present), np.zeros(4, int), 1, model)[0] == pytest.approx(want)


def test_pairs_alone_can_be_fitted():
    lists = [np.array(x) for x in ([], [0], [1], [0, 1])] * 200
    model = fit(lists, np.array([0, 0, 0, 1.0] * 200), np.arange(2, dtype=np.uint64), epochs=60)
    raw = [raw_scores(x, np.zeros(len(x), int), 1, model)[0] for x in lists[:4]]
    assert raw[3] > 0 > max(raw[:3])


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op7_toxicity_fm"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out")
    found = found.toPandas()
    toxic, clean = found.score[found.toxic == 1].to_numpy(), found.score[found.toxic == 0].to_numpy()
    assert (toxic[:, None] > clean[None]).mean() > 0.8
    assert (clean < 0.5).mean() > 0.97


def test_scores_depend_on_the_text_alone(spark):
    docs = documents(spark, ["a vermin", (None, "a vermin"), (7, "a vermin"), (7, "a vermin"), None, "", "x " * 9000])
    _, labels = pairs_table(spark)
    model = train(pairs_table(spark)[0], labels)
    found = score(docs, model).collect()
    assert len(found) == 7 and all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found}) <= 3


@pytest.mark.parametrize("kind", ["none", "all clean", "all toxic", "nulls"])
def test_labels_that_teach_nothing(spark, kind):
    docs = documents(spark, ["a", "b", None])
    rows = {"none": [], "all clean": [(1, 0), (2, 0)], "all toxic": [(1, 1), (2, 1)], "nulls": [(None, 1), (1, None)]}[kind]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    model = train(docs, labels)
    assert score(docs, model).filter("score < 0.5").count() == 3 and score(docs.limit(0), model).count() == 0
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))


def test_the_machine_beats_a_linear_model_on_pairs(spark):
    docs, labels = pairs_table(spark)
    model = train(docs, labels.filter("doc_id <= 400"))
    alone = Model(model.terms, model.bias, model.weights, np.zeros((len(model.terms), 1)))
    marks = labels.select("doc_id", "toxic").filter("doc_id > 400")
    right = []
    for m in (model, alone):
        found = score(docs, m).join(marks, "doc_id").collect()
        right.append(np.mean([(r["score"] >= 0.5) == bool(r["toxic"]) for r in found]))
    assert right[0] > right[1]
