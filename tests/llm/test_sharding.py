import heapq
import zlib
from collections import defaultdict

from cases import corpus, documents

from llm.sharding import longest_first, shard_documents


def test_heap_schedule_is_longest_first():
    units = [("a", 7), ("b", 7), ("c", 6), ("d", 5), ("e", 5), ("f", 4), ("g", 4)]
    loads = [0, 0, 0]
    for name, shard in longest_first(units, 3):
        loads[shard] += dict(units)[name]
    assert max(loads) <= (4 / 3) * -(-sum(s for _, s in units) // 3)
    assert dict(longest_first(units, 3))["a"] == 0 and dict(longest_first(units, 3))["b"] == 1


def test_equal_texts_stay_together_and_loads_are_near_plain_schedule(spark):
    docs = documents(spark, [*corpus(n=200), (None, "a"), (4, "repeated"), (4, "repeated")])
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    out = shard_documents(docs, shards=4).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in out if r["doc_id"] is not None) == sorted(
        (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in rows if i is not None
    )
    shards = defaultdict(set)
    slots, loads = defaultdict(list), defaultdict(int)
    for r in out:
        shards[r["text_crc32"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in shards.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = defaultdict(int)
    for _, t in rows:
        groups[t] += len(t.encode()) + 1
    plain = [0] * 4
    for size in sorted(groups.values(), reverse=True):
        heapq.heapreplace(plain, plain[0] + size)
    assert max(loads.values()) <= max(plain) * 1.02


def test_one_group_of_a_third_of_all_bytes(spark):
    docs = documents(spark, ["x" * 100] * 100 + ["y%d" % i * 30 for i in range(300)])
    out = shard_documents(docs, shards=4).collect()
    assert len(out) == 400 and len({r["shard"] for r in out if r["size"] == 101}) == 1


def test_empty_table(spark):
    assert shard_documents(documents(spark, ["a"]).limit(0)).count() == 0
