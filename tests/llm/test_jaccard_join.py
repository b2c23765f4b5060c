import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from cases import corpus, documents, mutated, prose
from pyspark.sql import functions as F

from llm import components as components_module
from llm import jaccard_join
from llm.components import components
from llm.jaccard_join import PrefixTree, Scheme, Threshold, keep_one_of_each, likely_groups, linked_components

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def runs(text, n):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(LOWER))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def expected(rows, t):
    sets = defaultdict(list)
    for i, text in rows:
        if i is not None:
            sets[i].append(runs(text, t.n))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(i, s) for i, all_ in sets.items() for s in all_]
    for k, (i, a) in enumerate(flat):
        for j, b in flat[:k]:
            if a and b and t.whole * len(a & b) >= t.part * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    out = [(i, len(runs(text, t.n)), None if i is None else find(i)) for i, text in rows]
    return sorted(out, key=str)


def near_copies(seed):
    """Chains of copies with growing numbers of edits, around the threshold."""
    r = random.Random(seed)
    texts = []
    for n in (6, 9, 15, 40, 80, 200):
        text = prose(r, n)
        texts.append(text)
        for _ in range(8):
            text = mutated(r, text, r.choice((0, 1, 1, 2, 3)))
            texts.append(text)
    return texts


@pytest.mark.parametrize("limit", [2_000_000, 1500])
@pytest.mark.parametrize("threshold", [Threshold(4, 85, 100), Threshold()])
def test_components_equal_brute_force(spark, monkeypatch, threshold, limit):
    monkeypatch.setattr(jaccard_join, "RUNS_IN_TRIE", limit)
    docs = documents(spark, [*corpus(3), *near_copies(5), (None, "a b c"), (None, None), (2, "again here it is, this one"), (2, "again")])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = linked_components(docs, threshold).collect()
    assert sorted(map(tuple, found), key=str) == expected(rows, threshold)


def test_group_of_copies_and_shared_passage(spark):
    r = random.Random(4)
    base, passage = prose(r, 80), prose(r, 60)
    texts = [base] * 150 + [mutated(r, base, 1) for _ in range(150)] + [f"{passage} {prose(r, 90)}" for _ in range(100)]
    docs = documents(spark, texts)
    found = linked_components(docs, Threshold(4, 85, 100)).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, found), key=str) == expected(rows, Threshold(4, 85, 100))


@pytest.mark.parametrize("share", [0, 0.1, 0.5, 1])
def test_linked_sets_share_a_key_whatever_is_flagged(share):
    r = random.Random(2)
    flags = np.random.default_rng(3).random(jaccard_join.BUCKETS) < share
    scheme = Scheme(Threshold(4, 85, 100), flags)
    for size in [*range(1, 40), 100, 500]:
        a = sorted(r.getrandbits(64) for _ in range(size))
        for _ in range(20):
            b = list(a)
            for _ in range(r.randrange(0, max(1, size // 6))):
                x = r.random()
                if x < 0.4 and b:
                    b.pop(r.randrange(len(b)))
                elif x < 0.7:
                    b.append(r.getrandbits(64))
                elif b:
                    b[r.randrange(len(b))] = r.getrandbits(64)
            b = sorted(set(b))
            if b and Threshold(4, 85, 100).linked(len(set(a) & set(b)), len(a), len(b)):
                keys, owner = scheme.keys(np.array(a + b, np.uint64), np.array([0, len(a), len(a) + len(b)]))
                assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


def test_tree_finds_every_component():
    r = random.Random(6)
    t = Threshold(1, 70, 100)
    sets = [sorted(r.sample(range(30), r.randrange(1, 20))) for _ in range(150)]
    tree = PrefixTree(t)
    for s in sorted(sets, key=len):
        tree.add(np.array(s, np.uint64))
    ordered = [frozenset(s) for s in sorted(sets, key=len)]
    for a in range(len(ordered)):
        for b in range(a):
            if t.linked(len(ordered[a] & ordered[b]), len(ordered[a]), len(ordered[b])):
                assert tree.find(a) == tree.find(b)
    assert all(t.linked(len(ordered[a] & ordered[b]), len(ordered[a]), len(ordered[b])) for a, b in tree.links)


def test_likely_groups_keep_all_links_and_part_passages():
    r = random.Random(9)
    t = Threshold(1, 80, 100)
    passage = [r.getrandbits(60) for _ in range(40)]
    sets = [np.array(sorted({*passage, *(r.getrandbits(60) for _ in range(60))}), np.uint64) for _ in range(50)]
    near = [r.getrandbits(60) for _ in range(100)]
    sets += [np.array(sorted({*near[: 100 - k], *(r.getrandbits(60) for _ in range(k))}), np.uint64) for k in range(20)]
    groups = likely_groups(sets, t)
    assert all(i >= 50 for g in groups for i in g)
    of = {i: k for k, g in enumerate(groups) for i in g}
    for a in range(len(sets)):
        for b in range(a):
            if t.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b])):
                assert of[a] == of[b]


@pytest.mark.parametrize("limit", [500_000, 7])
def test_components_of_a_chain_and_a_star(spark, monkeypatch, limit):
    monkeypatch.setattr(components_module, "LINKS_IN_TASK", limit)
    links = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert Counter(found.values()) == {1: 60, 100: 60, 200: 2}


def test_one_of_each_stays(spark):
    texts = ["one two three four five six seven"] * 3 + ["other words", None, ""]
    docs = documents(spark, texts)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5, 6]
    assert linked_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [2_000_000, 300])
def test_an_id_with_several_texts_keeps_the_links_of_each(spark, monkeypatch, limit):
    monkeypatch.setattr(jaccard_join, "RUNS_IN_TRIE", limit)
    r = random.Random(8)
    texts = []
    for i in range(12):
        a, b, c = (prose(r, 60) for _ in range(3))
        # Two texts of one size under one id, with near copies under other ids, and a copy of a third one.
        texts += [(10 * i + 1, a), (10 * i + 1, b), (10 * i + 2, mutated(r, a, 1)), (10 * i + 3, mutated(r, b, 1))]
        texts += [(10 * i + 4, c), (10 * i + 6, c), (10 * i + 6, prose(r, 60)), (10 * i + 5, texts[-1][1]), (10 * i + 5, c)]
    docs = documents(spark, texts)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = linked_components(docs, Threshold(4, 80, 100)).collect()
    assert sorted(map(tuple, found), key=str) == expected(rows, Threshold(4, 80, 100))


@pytest.mark.parametrize("boilerplate", [0.7, 0.9])
def test_no_group_holds_more_than_two_cells(spark, monkeypatch, tmp_path, boilerplate):
    """Many unlinked documents that share most of their text; with more of it, chains of links among them."""
    monkeypatch.setattr(jaccard_join, "RUNS_IN_TRIE", 2000)
    r = random.Random(12)
    n, t = 200, Threshold(2, 80, 100)
    words_ = [f"w{k}" for k in range(n)]
    texts = []
    for i in range(60):
        own = [w if k < boilerplate * n else f"d{i}x{k}" for k, w in enumerate(words_)]
        texts.append(" ".join(own))
    texts += [mutated(r, texts[i], 1) for i in (3, 30)]
    seen = []
    real = jaccard_join._cells

    def watched(members, threshold):
        seen.extend(x["runs"] for x in members.dropDuplicates(["cell", "set_id"]).groupBy("cell").agg(F.sum("size").alias("runs")).collect())
        return real(members, threshold)

    monkeypatch.setattr(jaccard_join, "_cells", watched)
    docs = documents(spark, texts)
    rows = [(x["doc_id"], x["text"]) for x in docs.collect()]
    found = linked_components(docs, t).collect()
    assert sorted(map(tuple, found), key=str) == expected(rows, t)
    # Sets are dealt by hash, so a cell is a little uneven.
    assert seen and max(seen) <= 2 * 2 * jaccard_join.RUNS_IN_TRIE


def test_linked_sets_share_a_rarest_run():
    r = random.Random(14)
    t = Threshold(1, 80, 100)
    levels = np.random.default_rng(4).integers(0, 9, jaccard_join.BUCKETS).astype(np.uint8)
    for size in [*range(1, 30), 100, 400]:
        a = sorted(r.getrandbits(64) for _ in range(size))
        for _ in range(20):
            b = sorted({*r.sample(a, size - r.randrange(0, size // 5 + 1)), *(r.getrandbits(64) for _ in range(r.randrange(0, size // 5 + 1)))})
            if t.linked(len(set(a) & set(b)), len(a), len(b)):
                keys, owner = jaccard_join.rarest_runs(np.array(a + b, np.uint64), np.array([0, len(a), len(a) + len(b)]), levels, t)
                assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


def test_keys_are_handed_over_in_batches_of_a_bounded_size(monkeypatch):
    """The rows are the same, but no batch that leaves a task grows with the keys that it combines."""
    values = np.arange(1, 1001, dtype=np.uint64) % 700
    sets = np.arange(1000) // 100
    whole = [tuple(r.values()) for b in jaccard_join._combined([(values, sets)]) for r in b.to_pylist()]
    monkeypatch.setattr(jaccard_join, "ROWS_IN_BATCH", 64)
    batches = list(jaccard_join._combined([(values[:300], sets[:300]), (values[300:], sets[300:])]))
    assert max(len(b) for b in batches) <= 64
    assert [tuple(r.values()) for b in batches for r in b.to_pylist()] == whole
    assert len(whole) > 700


def test_each_node_has_one_component_however_often_it_is_linked(spark, monkeypatch):
    monkeypatch.setattr(components_module, "LINKS_IN_TASK", 7)
    links = spark.createDataFrame([(1, i) for i in range(2, 30)] * 4, "a long, b long").repartition(4)
    found = [tuple(r) for r in components(links, "a", "b").collect()]
    assert sorted(found) == [(i, 1) for i in range(1, 30)]


def families(seed, copies):
    """Near copies of three texts, most of them with more edits than links bear, and texts of their own."""
    r = random.Random(seed)
    texts = [prose(r, 60) for _ in range(10)]
    for _ in range(3):
        base = prose(r, 120)
        texts += [mutated(r, base, r.randrange(1, 14)) for _ in range(copies)]
    return texts


def cell(texts, t):
    rows = pd.DataFrame({"set_id": range(len(texts)), "size": [len(runs(x, t.n)) for x in texts], "text": texts})
    return rows.assign(cell="0", label=rows["set_id"])


@pytest.mark.parametrize("threshold", [Threshold(4, 85, 100), Threshold(2, 70, 100), Threshold(1, 60, 100)])
def test_sets_given_by_their_differences_link_as_whole_ones(threshold):
    for seed in range(3):
        texts = families(seed, 40)
        found = jaccard_join._join_cell(cell(texts, threshold), threshold)
        sets = [runs(x, threshold.n) for x in texts]
        parent = list(range(len(texts)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in found.itertuples(index=False):
            assert threshold.linked(len(sets[a] & sets[b]), len(sets[a]), len(sets[b]))
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
        component = {i: c for i, _, c in expected(list(enumerate(texts)), threshold)}
        assert [find(i) for i in range(len(texts))] == [component[i] for i in range(len(texts))]


def test_parts_of_a_group_are_its_families():
    r = random.Random(3)
    bases = [[r.getrandbits(60) for _ in range(100)] for _ in range(3)]
    sets = [np.array(sorted({*r.sample(bases[k % 3], 92), *(r.getrandbits(60) for _ in range(6)), k % 7}), np.uint64) for k in range(60)]
    parts = jaccard_join.parted(sets, Threshold(1, 80, 100))
    assert sorted(map(sorted, parts)) == [list(range(k, 60, 3)) for k in range(3)]


def test_work_of_a_set_grows_little_with_the_family(monkeypatch):
    """Many near copies that are not linked cost a few steps each, not one for each node of the tree."""
    t = Threshold(4, 85, 100)
    r = random.Random(1)
    base = prose(r, 400)
    texts = [mutated(r, base, r.randrange(3, 20)) for _ in range(400)]
    real, calls = np.searchsorted, []
    monkeypatch.setattr(jaccard_join.np, "searchsorted", lambda *a, **b: calls.append(1) or real(*a, **b))
    jaccard_join._join_cell(cell(texts, t), t)
    assert len(calls) < 20 * len(texts)


def test_cells_of_few_bytes_are_not_put_in_one_task(spark):
    t = Threshold(4, 85, 100)
    rows = [(str(k), 2 * k + i, 6, 2 * k + i, f"a b c d e f g h w{k}") for k in range(24) for i in (0, 1)]
    members = spark.createDataFrame(rows, "cell string, set_id long, size long, label long, text string")
    found = jaccard_join._cells(members, t).withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r["a"], r["b"]) for r in found) == [(2 * k, 2 * k + 1) for k in range(24)]
    assert len({r["task"] for r in found}) > 1
