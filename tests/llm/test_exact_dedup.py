from collections import defaultdict

import pytest
from cases import corpus, documents
from pyspark.sql import functions as F

from llm.exact_dedup import content_digest, drop_exact_copies, exact_groups


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), i == keep) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [content_digest, lambda t: F.pmod(F.crc32(t.cast("binary")), F.lit(3))])
def test_groups_equal_brute_force_even_if_digests_clash(spark, digest):
    texts = [*corpus(), (None, "a"), (None, "only null ids"), (None, "only null ids"), (5, "again"), (5, "again")]
    docs = documents(spark, texts)
    found = exact_groups(docs, salts=4, digest=digest).select("doc_id", "keep_id", "group_size", "kept").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, found), key=str) == expected(rows)


def test_one_of_each_text_stays_with_all_columns(spark):
    docs = documents(spark, ["a", "b", "a", None, "", (9, "c"), (9, "c")])
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == [(2, "b"), (3, "a"), (5, ""), (9, "c")]


def test_empty_table(spark):
    empty = documents(spark, ["a"]).limit(0)
    assert exact_groups(empty).count() == 0 and drop_exact_copies(empty).count() == 0


def test_hot_group_is_counted_whole(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    top = exact_groups(docs).orderBy(F.desc("group_size")).first()
    assert (top["group_size"], top["keep_id"]) == (1000, 2997)
