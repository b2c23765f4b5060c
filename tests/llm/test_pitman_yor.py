import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import corpus, documents
from pyspark.sql import functions as F

from llm import pitman_yor
from llm.pitman_yor import COARSE, FINE, Guess, Process, Seating, probabilities, score_texts, seat

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def split(text):
    return [*re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(LOWER)), None]


def is_held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def test_counts_and_base_score_equal_brute_force(spark):
    docs = documents(spark, [*corpus(8), (None, "a b"), (4, "again"), (4, "again")])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    counts = Counter(w for i, t in rows if not is_held_out(i) for w in split(t))
    total, known = sum(counts.values()), len(counts)
    want = []
    for i, text in rows:
        words = split(text)
        base = sum(math.log10((counts[w] + 1) / (total + known + 1)) for w in words)
        want.append((i, is_held_out(i), len(words), sum(counts[w] > 0 for w in words), total, round(base, 6)))
    found = score_texts(docs)
    got = [(*r[:5], round(r[5], 6)) for r in found.drop("score").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert found.filter("score >= 0 or score is null or isnan(score)").count() == 0


def test_result_does_not_depend_on_tasks(spark, monkeypatch):
    docs = documents(spark, corpus(9))
    one = {r["doc_id"]: r["score"] for r in score_texts(docs).collect()}
    monkeypatch.setattr(pitman_yor, "TOKENS_IN_TASK", 1000)
    many = {r["doc_id"]: r["score"] for r in score_texts(docs.repartition(5), frequent=50).collect()}
    assert one.keys() == many.keys() and all(many[k] == pytest.approx(one[k]) for k in one)


def test_model_beats_add_one_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sums = score_texts(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def test_probabilities_sum_to_one():
    r = np.random.default_rng(1)
    rows = np.unique(np.stack([r.integers(1, 40, 300) << 8, r.integers(0, FINE, 300)], 1), axis=0)
    count = r.integers(1, 200, len(rows))
    fine = np.bincount(rows[:, 1], count, FINE)
    seating = Seating(rows[:, 0].astype(np.uint64), rows[:, 1].astype(np.uint64), count, Process(), Guess.before(fine))
    for _ in seating.sampled():
        after = Guess.after(fine, seating.totals(), len(seating.words))
        for history in (0, 5, 77, 255):
            ask = np.append(seating.words, np.uint64(1 << 40))
            p = probabilities(seating, after, ask, np.full(len(ask), history))
            assert p.sum() == pytest.approx(1) and (p > 0).all()


def seatings(customers, discount, weight):
    """Weight of each number of tables, over all ways to seat the customers one after another."""
    found = Counter()

    def come(left, tables, so_far):
        if not left:
            found[len(tables)] += so_far
            return
        for i, size in enumerate(tables):
            come(left - 1, [*tables[:i], size + 1, *tables[i + 1 :]], so_far * (size - discount))
        come(left - 1, [*tables, 1], so_far * weight)

    come(customers - 1, [1], weight)
    return found


def drawn(customers, weight, discount, rows, draw=1):
    return seat(np.full(rows, customers), np.full(rows, weight), discount, np.arange(rows, dtype=np.uint64) << np.uint64(8), np.zeros(rows, int), draw)


@pytest.mark.parametrize(("customers", "discount", "weight"), [(2, 0.5, 0.3), (5, 0.75, 0.02), (6, 0.6, 4.0), (7, 0.5, 1.0), (4, 0.0, 2.0)])
def test_tables_have_the_distribution_of_all_seatings(customers, discount, weight):
    rows = 40_000
    want = seatings(customers, discount, weight)
    got = Counter(drawn(customers, weight, discount, rows).astype(int).tolist())
    assert set(got) <= set(want)
    for t, w in want.items():
        share = w / sum(want.values())
        assert got[t] / rows == pytest.approx(share, abs=4 * math.sqrt(share * (1 - share) / rows) + 1e-4)


@pytest.mark.parametrize("weight", [0.05, 1.0, 20.0, 150.0])
def test_tables_of_many_customers_are_near_the_exact_mean(weight):
    """Beyond `EXACT` the mean is held against the recursion over all customers."""
    customers, discount = 4 * pitman_yor.EXACT, 0.6
    t = np.arange(1, customers + 1)
    log = np.where(t == 1, math.log(weight), -np.inf)
    for c in range(1, customers):
        opened = np.append(-np.inf, log[:-1]) + math.log(weight)
        log = np.logaddexp(opened, log + np.log(np.maximum(c - discount * t, 1e-300)))
        log -= log.max()
    share = np.exp(log) / np.exp(log).sum()
    tables = drawn(customers, weight, discount, 2000)
    assert ((tables >= 1) & (tables <= customers)).all()
    assert tables.mean() == pytest.approx((share * t).sum(), rel=0.05)


def test_no_training_rows_and_empty_table(spark):
    held = [i for i in range(1, 60) if is_held_out(i)]
    docs = documents(spark, [(i, "some words") for i in held])
    assert [r["n_known"] for r in score_texts(docs).collect()] == [0] * len(held)
    assert score_texts(docs.limit(0)).count() == 0
    assert COARSE < FINE
