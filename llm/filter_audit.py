"""Interaction of quality filters in every order, with duplicate flags from radix tries over whole texts.

Texts are range-partitioned by prefixes that grow only where many texts share them. A partition inserts its texts into
a compressed trie whose terminals hold the least id, and a walk over the trie tells every text that id. The flags of a
document become the bits of a mask. Masks are counted per part, and since an order of filters sees a document only
through its mask, all orders follow from the counts.
"""

from __future__ import annotations

import itertools
import os
import re
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import words
from tidymart.session import written

FILTERS = "ABCDE"
DUPLICATE = FILTERS.index("E")
MASKS = 1 << len(FILTERS)
LEAST_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
#: UTF-8 bytes of text that share a prefix before the prefix grows, and that a partition is to hold.
PREFIX_BYTES = 8 << 20
PARTITION_BYTES = 32 << 20
FIRST_PREFIX = 16

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = re.compile(rb"[#$%&*|]")


def text_mask(text: bytes, points: int) -> int:
    """Bits of the filters A to D that a text fails; words end at ASCII white space."""
    found = text.split()
    mask = len(found) < LEAST_WORDS
    mask |= (100 * len(set(found)) < DISTINCT_PERCENT * len(found)) << 1
    mask |= (100 * (len(text) - len(text.translate(None, _CAPITALS))) > CAPITAL_PERCENT * points) << 2
    return mask | (_SYMBOLS.search(text) is not None) << 3


class RadixTrie:
    """Compressed trie of byte strings; each terminal holds the least id inserted there and the rows that ended there."""

    def __init__(self):
        self.root = _Node(b"")

    def insert(self, text: bytes, least: int | None, row) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = _Node(text[at:])
            elif text[at : at + len(child.label)] != child.label:
                shared = len(os.path.commonprefix((child.label, text[at : at + len(child.label)])))
                middle = _Node(child.label[:shared])
                child.label = child.label[shared:]
                middle.children[child.label[0]] = child
                child = node.children[text[at]] = middle
            at += len(child.label)
            node = child
        if least is not None and (node.least is None or least < node.least):
            node.least = least
        node.rows.append(row)

    def terminals(self):
        """(least id, rows) of every text, on a stack of its own: texts may be nested deeply."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node.rows:
                yield node.least, node.rows
            stack.extend(node.children.values())


class _Node:
    __slots__ = ("children", "label", "least", "rows")

    def __init__(self, label: bytes):
        self.label, self.children, self.least, self.rows = label, {}, None, []


def _texts(column: pa.Array):
    """(row, UTF-8 bytes) of a column, null as empty."""
    whole, starts = words.utf8(column)
    view = memoryview(whole)
    for k, (a, b) in enumerate(itertools.pairwise(starts.tolist())):
        yield k, bytes(view[a:b])


_AUDIT_DDL = "doc_id long, part string, mask int, `group` long, text string, least long, bytes long"


def _audit_batches(batches):
    """Masks of A to D, and the batch's own groups of equal texts: the first row of a group carries the text."""
    serial = 0
    for batch in batches:
        place = batch.column(2)[0].as_py() if len(batch) else 0
        ids = batch.column(0).to_pylist()
        points = pc.utf8_length(batch.column(3)).fill_null(0).to_pylist()
        first, masks, leader, least = {}, [], [], {}
        for k, text in _texts(batch.column(3)):
            at = first.setdefault(text, k)
            masks.append(text_mask(text, points[k]) if at == k else masks[at])
            leader.append(at)
            if ids[k] is not None and (least.get(at) is None or ids[k] < least[at]):
                least[at] = ids[k]
        own = np.arange(len(batch)) == np.array(leader, np.int64)
        sizes = pa.array([len(t) for t in first], pa.int64())
        texts = pc.if_else(pa.array(own, pa.bool_()), batch.column(3).fill_null(""), pa.scalar(None, pa.string()))
        keys = (np.int64(place) << np.int64(40)) + serial + np.array(leader, np.int64)
        spread = np.cumsum(own) - 1
        sizes = pc.if_else(pa.array(own, pa.bool_()), sizes.take(pa.array(spread)), pa.scalar(None, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(keys), texts]
            + [pa.array([least.get(k) if o else None for k, o in enumerate(own.tolist())], pa.int64()), sizes],
            ["doc_id", "part", "mask", "group", "text", "least", "bytes"],
        )
        serial += len(batch)


def adaptive_prefixes(texts: DataFrame, most: int = PREFIX_BYTES, first: int = FIRST_PREFIX) -> DataFrame:
    """The texts with the column ``prefix``: the shortest of 16, 32, 64 ... code points under which at most `most` bytes lie.

    A prefix that is the whole text stops growing. Equal texts have equal prefixes. Sizes are summed over all
    texts; each round reads only those whose prefix was too common, and there are as many rounds as doublings.
    ``salts`` is above one only where copies of one text make up more than `most` bytes.
    """
    length, open_texts, done = first, texts, None
    while True:
        marked = open_texts.withColumn("prefix", F.substring(F.col("text"), F.lit(1), F.lit(length)))
        sizes = marked.groupBy("prefix").agg(F.sum("bytes").alias("__bytes"), F.max(F.char_length("text")).alias("__longest"))
        heavy = written(sizes.filter(F.col("__bytes") > most), "audit-prefixes")
        if heavy.isEmpty():
            done = marked.withColumn("salts", F.lit(1)) if done is None else done.unionByName(marked.withColumn("salts", F.lit(1)))
            return done
        joined = marked.join(heavy, "prefix", "left")
        whole = F.col("__longest") <= length
        salts = F.when(F.col("__bytes").isNull(), 1).otherwise(F.ceil(F.col("__bytes") / most)).cast("int")
        settled = joined.filter(F.col("__bytes").isNull() | whole).withColumn("salts", salts).drop("__bytes", "__longest")
        done = settled if done is None else done.unionByName(settled)
        open_texts = joined.filter(F.col("__bytes").isNotNull() & ~whole).drop("prefix", "__bytes", "__longest")
        open_texts = written(open_texts, "audit-open")
        length *= 2


_TRIE_DDL = "`group` long, same long, least long, text string"


def _trie_batches(batches, keep_text: bool):
    """The walk over the partition's trie: (row key, key of the first row of the same text, least id)."""
    trie, texts = RadixTrie(), {}
    for batch in batches:
        keys, least = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for k, text in _texts(batch.column(1)):
            trie.insert(text, least[k], keys[k])
            if keep_text:
                texts.setdefault(text, keys[k])
    firsts = {key: text.decode() for text, key in texts.items()}
    held = [], [], [], []
    for least, rows in trie.terminals():
        for key in rows:
            for column, value in zip(held, (key, rows[0], least, firsts.get(key)), strict=True):
                column.append(value)
        if len(held[0]) >= 4096:
            yield _trie_batch(held)
            held = [], [], [], []
    yield _trie_batch(held)


def _trie_batch(held) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(held, kinds, strict=True)], ["group", "same", "least", "text"])


def _through_tries(texts: DataFrame, partitions: int, by: list[str], keep_text: bool) -> DataFrame:
    dealt = texts.repartitionByRange(partitions, *by).select("group", "text", "least")
    return dealt.mapInArrow(partial(_trie_batches, keep_text=keep_text), _TRIE_DDL)


def least_ids(texts: DataFrame, prefix_bytes: int = PREFIX_BYTES, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(group, least): for each row (group, text, least, bytes) the least id of all rows with an identical text.

    Where copies of one text exceed `prefix_bytes`, they are dealt under salts first and only the first row of each
    salt goes on, so no trie takes in an unbounded group.
    """
    total = texts.agg(F.sum("bytes")).first()[0] or 0
    partitions = max(1, -(-int(total) // partition_bytes))
    marked = adaptive_prefixes(texts, prefix_bytes)
    plain = _through_tries(marked.filter("salts = 1"), partitions, ["prefix"], False).select("group", "least")
    crowded = written(marked.filter("salts > 1").withColumn("salt", F.pmod(F.xxhash64("group"), F.col("salts"))), "audit-crowded")
    if crowded.isEmpty():
        return plain
    salted = written(_through_tries(crowded, partitions, ["prefix", "salt"], True), "audit-salted")
    winners = salted.filter("`group` = same").select("group", "text", "least")
    winners = winners.withColumn("prefix", F.substring("text", 1, FIRST_PREFIX))
    settled = _through_tries(winners, partitions, ["prefix"], False).select(F.col("group").alias("same"), "least")
    return plain.unionByName(salted.select("group", "same").join(settled, "same").select("group", "least"))


def filter_masks(docs: DataFrame, prefix_bytes=PREFIX_BYTES, partition_bytes=PARTITION_BYTES, id_column="doc_id", text_column="text", part_column="source") -> DataFrame:
    """(doc_id, part, mask) of every row: bit k is set if the document fails filter k of ABCDE.

    A null text is empty, a null part the empty string. E needs a smaller id with an identical text: rows that repeat the
    least id pass, a null id neither fails nor makes others fail. An empty table gives no rows, other columns are ignored.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
        F.spark_partition_id().alias("place"),
        F.col(text_column).cast("string").alias("text"),
    )
    audited = written(rows.mapInArrow(_audit_batches, _AUDIT_DDL), "audit-rows")
    texts = audited.filter(F.col("text").isNotNull()).select("group", "text", "least", "bytes")
    found = least_ids(texts, prefix_bytes, partition_bytes)
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).cast("int")
    joined = audited.select("doc_id", "part", "mask", "group").join(found, "group")
    return joined.select("doc_id", "part", F.col("mask").bitwiseOR(F.shiftleft(copy, DUPLICATE)).alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame, id_column="doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each mask, and how many of them are labelled good and toxic.

    A document with several label rows is good, or toxic, if one of them says so; without labels, or
    without an id, it is neither.
    """
    marks = labels.groupBy(F.col(id_column).cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad")
    )
    joined = masks.join(marks, "doc_id", "left")
    return joined.groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if(F.col("good") == 1).alias("good"), F.count_if(F.col("bad") == 1).alias("toxic"))


def steps() -> list[tuple[str, int, int, int]]:
    """(order, step from 1, bit of its filter, bits of the filters before it) for all orders."""
    found = []
    for order in itertools.permutations(range(len(FILTERS))):
        before = 0
        for k, f in enumerate(order):
            found.append(("".join(FILTERS[i] for i in order), k + 1, 1 << f, before))
            before |= 1 << f
    return found


_STEPS = steps()
_COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_ORDERS_DDL = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COLUMNS)


def step_counts(n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The seven counts of every step, from the documents (good and toxic ones) of each mask."""
    mask = np.arange(MASKS)
    own = np.array([s[2] for s in _STEPS])[:, None]
    before = np.array([s[3] for s in _STEPS])[:, None]
    fails, gone = (mask & own) > 0, (mask & before) > 0
    removed = fails & ~gone
    # A filter is the first of the failing ones in one order out of as many as fail.
    orders = len(_STEPS) // len(FILTERS)
    share = np.where(fails, orders // np.maximum(1, [int(m).bit_count() for m in mask]), 0)
    return np.stack([(~fails & ~gone) @ n, removed @ n, (fails & gone) @ n, (mask == own) @ n, removed @ good, removed @ toxic, share @ n], 1)


def _order_batches(batches):
    for batch in batches:
        parts = batch.column(0).to_pylist()
        lists = [np.array(batch.column(k).to_pylist(), np.int64) for k in (1, 2, 3)]
        for k, part in enumerate(parts):
            counts = step_counts(*(x[k] for x in lists))
            columns = [pa.array([part] * len(_STEPS)), pa.array([s[0] for s in _STEPS]), pa.array([s[1] for s in _STEPS], pa.int32())]
            columns += [pa.array(c) for c in counts.T]
            yield pa.RecordBatch.from_arrays(columns, ["part", "filter_order", "step", *_COLUMNS])


def audit_orders(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, zeros included, from (part, mask, n, good, toxic)."""

    def of_mask(column):
        sums = (F.sum(F.when(F.col("mask") == m, F.col(column)).otherwise(0)) for m in range(MASKS))
        return F.array(*sums).alias(column)

    wide = counts.groupBy("part").agg(of_mask("n"), of_mask("good"), of_mask("toxic"))
    return wide.mapInArrow(_order_batches, _ORDERS_DDL)


def audit_filters(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The audit of `docs`; see :func:`filter_masks` for nulls, ties and repeated rows."""
    return audit_orders(mask_counts(filter_masks(docs, **options), labels))
