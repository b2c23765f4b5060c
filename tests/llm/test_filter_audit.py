import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from cases import corpus, prose

from llm.filter_audit import RadixTrie, adaptive_prefixes, audit_filters, filter_masks, least_ids, text_mask

SCHEMA = "doc_id long, text string, source string, mask int, `group` long, least long, part int, prefix string"


def rows(n=150, seed=5):
    r = random.Random(seed)
    texts = corpus(seed, 40) + ["SHOUT " * 60, prose(r, 60) + " $", "Word " * 49, "Ünï ÄÖ " * 30, "same text " * 60]
    texts += [prose(r, 80)] * 30 + [prose(r, 70) + str(k) for k in range(5)]
    boiler = prose(r, 90)
    texts += [boiler + str(k % 9) for k in range(30)]
    out = [(i, t, (None, "", "src a", "src b")[i % 4]) for i, t in enumerate(texts, 1)]
    out += [(3, texts[2], "src a"), (None, "no id", "src b"), (None, "no id", None), (9999, "no id", "src b"), (9, texts[20], "src a")]
    return out


def table(spark, data):
    r = random.Random(1)
    data = [(i, t, s, 1, 2, 3, 4, "x") for i, t, s in r.sample(data, len(data))]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def slow_masks(data):
    least = {}
    for i, t, _ in data:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    out = []
    for i, t, s in data:
        t = t or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        flags = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t)]
        flags += [any(c in "#$%&*|" for c in t), i is not None and i > least[t]]
        out.append((i, s or "", sum(f << k for k, f in enumerate(flags))))
    return out


def slow_audit(data, labels):
    marks = defaultdict(lambda: [0, 0])
    for i, q, t in labels:
        if i is None:
            continue
        marks[i][0] |= q == 1
        marks[i][1] |= t == 1
    masks = slow_masks(data)
    out = {}
    shapley = defaultdict(int)
    for order in itertools.permutations("ABCDE"):
        for part in {p for _, p, _ in masks}:
            alive = [(i, m) for i, p, m in masks if p == part]
            every = list(alive)
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                gone = [(i, m) for i, m in alive if m & bit]
                alive = [(i, m) for i, m in alive if not m & bit]
                fails = [m for _, m in every if m & bit]
                out[part, "".join(order), step] = [
                    len(alive), len(gone), len(fails) - len(gone), sum(m == bit for m in fails),
                    sum(marks[i][0] for i, _ in gone), sum(marks[i][1] for i, _ in gone),
                ]
                shapley[part, f] += len(gone)
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


@pytest.mark.parametrize("prefix_bytes", [300, 8 << 20])
def test_masks_equal_brute_force(spark, prefix_bytes):
    data = rows()
    found = filter_masks(table(spark, data), prefix_bytes=prefix_bytes, partition_bytes=20_000)
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, slow_masks(data)))


def test_audit_equals_every_order_run_step_by_step(spark):
    data = rows()
    r = random.Random(2)
    labels = [(i, r.randrange(2), r.randrange(2)) for i, _, _ in data if i and r.random() < 0.6]
    labels += [(3, 0, 1), (3, 1, None), (None, 1, 1), (77777, 1, 1)]
    found = audit_filters(table(spark, data), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = sorted(tuple(x) for x in found.collect())
    assert len(got) == 600 * 3 and got == slow_audit(data, labels)


def test_masks_of_single_texts():
    assert text_mask(b"", 0) == 1
    assert text_mask(("a " * 50).encode(), 100) == 2
    assert text_mask(" ".join(f"w{k}" for k in range(50)).encode(), 300) == 0
    assert text_mask(" ".join(f"Ww{k}" for k in range(50)).encode(), 300) == 4
    assert text_mask(b"a|b", 3) == 9


def test_trie_holds_the_least_id_of_each_text():
    r = random.Random(3)
    texts = ["".join(r.choice("ab") for _ in range(r.randrange(0, 9))).encode() for _ in range(400)]
    trie, least = RadixTrie(), {}
    for k, t in enumerate(texts):
        number = r.choice((None, r.randrange(1000)))
        trie.insert(t, number, k)
        least.setdefault(t, None)
        if number is not None:
            least[t] = number if least[t] is None else min(least[t], number)
    found = {k: n for n, keys in trie.terminals() for k in keys}
    assert found == {k: least[t] for k, t in enumerate(texts)}
    deep = RadixTrie()
    for k in range(3000):
        deep.insert(b"a" * k, k, k)
    assert sorted(n for n, _ in deep.terminals()) == list(range(3000))


def test_prefixes_grow_where_texts_share_them(spark):
    texts = [(k, "shared beginning " * 5 + str(k), k, 90) for k in range(40)] + [(100 + k, "other" + str(k), k, 8) for k in range(40)]
    texts += [(200 + k, "copied " * 10, k, 70) for k in range(40)]
    df = spark.createDataFrame(texts, "`group` long, text string, least long, bytes long")
    found = {r["group"]: r for r in adaptive_prefixes(df, most=500).collect()}
    assert len(found) == 120
    assert all(len(found[k]["prefix"]) > 64 for k in range(40)) and all(len(found[100 + k]["prefix"]) <= 16 for k in range(40))
    assert {found[200 + k]["salts"] for k in range(40)} == {6}
    least = {r["group"]: r["least"] for r in least_ids(df, 500, 700).collect()}
    assert least == {**{k: k for k in range(40)}, **{100 + k: k for k in range(40)}, **{200 + k: 0 for k in range(40)}}


def test_empty_tables(spark):
    empty = table(spark, rows()).limit(0)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(empty, none).collect() == []
    found = audit_filters(table(spark, [(1, None, None)]), none).toPandas()
    assert len(found) == 600 and set(found["part"]) == {""}
    assert np.array_equal(found[found.filter_order.str[0] == "A"].query("step == 1")["removed"], np.ones(24))
