import itertools
import math
import random
import unicodedata
from collections import Counter

import numpy as np
import pytest
from cases import documents

from llm import language_mix as mix
from llm.queries import QUERIES

WORDS = {"aa": "river stone the house window walking", "bb": "fluß straße das über schön zwölf", "cc": "niño año el corazón lluvia mañana"}
M64 = (1 << 64) - 1


def prose(r, lang, n):
    return " ".join(r.choice(WORDS[lang].split()) for _ in range(n))


def slow_bin(gram):
    value = 0
    for c in gram:
        value = (value * (0x110000 + 1) + ord(c)) & M64
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        value ^= value >> shift
        value = value * factor & M64
    return (value >> 40) % mix.BINS


def slow_units(text):
    """Bins of each unit of a text, letter by letter."""
    runs, run = [], ""
    for c in (text or "") + " ":
        if unicodedata.category(c)[0] in "LM":
            run += c.lower() if len(c.lower()) == 1 else c
        elif run:
            runs.append(f" {run} ")
            run = ""
    units = []
    for run in runs:
        grams = [slow_bin(run[k : k + 3]) for k in range(len(run) - 2)]
        units += [grams[k : k + mix.UNIT_LETTERS] for k in range(0, len(grams), mix.UNIT_LETTERS)]
    return units


def slow_mixture(likelihood, members, rounds=2000):
    share = {k: 1 / len(members) for k in members}
    for _ in range(rounds):
        new = dict.fromkeys(members, 0.0)
        for p in likelihood:
            total = sum(share[k] * p[k] for k in members)
            for k in members:
                new[k] += share[k] * p[k] / total / len(likelihood)
        share = new
    return share, sum(math.log(sum(share[k] * p[k] for k in members)) for p in likelihood)


def slow_choice(units, model, penalty):
    """The best of all subsets by penalised likelihood."""
    logs = [[sum(float(model.log_probability[b, k]) for b in unit) for k in range(len(model.languages))] for unit in units]
    likelihood = [[math.exp(x - max(row)) for x in row] for row in logs]
    best = None
    for size in range(1, len(model.languages) + 1):
        for members in itertools.combinations(range(len(model.languages)), size):
            share, fit = slow_mixture(likelihood, members, 1 if size == 1 else 400)
            value = fit - size * penalty * 0.5 * math.log(len(units) + 1)
            if best is None or value > best[0] + 1e-9:
                best = value, share
    top = max(best[1], key=lambda k: best[1][k])
    return model.languages[top], best[1][top], {model.languages[k] for k in best[1]}


@pytest.fixture(scope="module")
def learned(spark):
    r = random.Random(1)
    rows = [(i, prose(r, lang, 40), lang) for i, lang in enumerate(list(WORDS) * 30)]
    rows += [(200, "no language here", None), (201, None, "aa"), (202, "", "bb")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return rows, mix.train(table)


def test_counts_equal_brute_force(learned):
    rows, model = learned
    assert model.languages == ["aa", "bb", "cc"]
    counts = {k: Counter() for k in model.languages}
    for _, text, lang in rows:
        if lang:
            for unit in slow_units(text):
                counts[lang].update(unit)
    for k, lang in enumerate(model.languages):
        total = sum(counts[lang].values()) + 0.5 * mix.BINS
        want = np.log(np.array([counts[lang][b] + 0.5 for b in range(mix.BINS)]) / total)
        assert np.allclose(model.log_probability[:, k], want, atol=1e-4)


def test_predictions_equal_the_best_of_all_sets(spark, learned):
    _, model = learned
    r = random.Random(2)
    texts = [prose(r, lang, n) for lang in WORDS for n in (1, 2, 5, 60)]
    texts += [prose(r, "aa", 60) + " " + prose(r, "bb", 30), prose(r, "cc", 20) + "\n" + prose(r, "aa", 25)]
    texts += [" ".join(prose(r, lang, 25) for lang in WORDS), prose(r, "bb", 80) + " river", "ÜBER Straße 12 das", "a", "x" * 100]
    found = mix.predict(documents(spark, texts), model).collect()
    got = {r["doc_id"]: r for r in found}
    for k, text in enumerate(texts, 1):
        lang, score, members = slow_choice(slow_units(text), model, 4.0)
        if abs(score - 1 / max(1, len(members))) > 0.02 or len(members) == 1:
            assert got[k]["lang_pred"] == lang, text
        assert set(got[k]["languages"]) == members, text
        assert got[k]["score"] == pytest.approx(score, abs=0.02)
    assert {len(r["languages"]) for r in found} == {1, 2, 3}


def test_a_single_language_is_kept_only_where_no_set_pays():
    r = np.random.default_rng(3)
    logs = np.log(r.dirichlet((1, 1, 1), size=60))
    bounds = np.array([0, 1, 21, 60])
    chosen, share = mix.choose(logs, bounds, 0.5)
    assert np.allclose(share.sum(1), 1) and (share[~chosen] == 0).all()
    for a, b, row in zip(bounds, bounds[1:], chosen, strict=False):
        values = {}
        for size in (1, 2, 3):
            for members in itertools.combinations(range(3), size):
                fit = slow_mixture(np.exp(logs[a:b]).tolist(), members, 1500)[1]
                values[members] = fit - size * 0.25 * math.log(b - a + 1)
        assert values[tuple(np.flatnonzero(row))] > max(values.values()) - 0.05


def test_texts_without_letters(spark, learned):
    texts = [None, "", " \t", "123 $$$ !!", "́", "中文字符" * 50, "7 a", (None, "river"), (5, "river"), (5, "river"), "river " * 50_000]
    found = [tuple(r)[:3] for r in mix.predict(documents(spark, texts), learned[1]).orderBy("doc_id").collect()]
    by_id = {r[0]: r for r in found}
    assert all(by_id[k][1:] == ("und", 0.0) for k in (1, 2, 3, 4))
    assert all(by_id[k][1] in WORDS for k in (6, 7)) and all(0 <= r[2] <= 1 for r in found)
    assert sum(r[0] in (None, 5) and r[1] == "aa" for r in found) == 3 and len(found) == len(texts)


def test_nothing_to_learn_from(spark):
    none = documents(spark, ["a text", None])  # lang is null
    model = mix.train(none)
    assert model.languages == [] and [r["lang_pred"] for r in mix.predict(none, model).collect()] == ["und", "und"]
    assert mix.predict(none.limit(0), model).count() == 0 and mix.train(none.limit(0)).languages == []
    two = spark.createDataFrame([("a b", "x"), ("c d", "y"), ("e", "y"), ("f", "z")], "text string, lang string")
    assert mix.train(two, most_languages=2).languages == ["x", "y"]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op13_language_mixture"](spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert len(found) == 1000 and found.score.between(0, 1).all()
    held = found[found.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.99
