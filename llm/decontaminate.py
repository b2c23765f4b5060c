"""Benchmark decontamination: CGK embeddings, bit-sampling hashes, exact edit distance of the whole item.

The CGK walk reads a window word by word; at each step a random bit of (step, word) tells whether it moves on. Two
windows a few edits apart soon read the same words at the same steps again, so their edit distance shows as
Hamming distance between what they read. A hash table samples a few steps of the walk; windows that read the
same words there are candidates, and the edit distance of the whole item against the document decides.

Walks begin at each word of an item and of a text and cover up to half of the item, eight words at most, instead of the
whole window: edits spoil the walks that pass them, so a long item keeps many whole ones. Recall is measured by
length in the tests; items of four words and less allow no edit and are always found.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import words
from tidymart.session import written

#: Words of all items whose tables are broadcast at once; more items are taken in blocks.
BLOCK_WORDS = 400_000
_BUCKET_BITS = np.uint64(44)


@dataclass(frozen=True)
class Search:
    """`similarity`: 1 - edits / words of the item. Items below `least_words` can't tell a passage: only a text that is one is found.

    Each table samples `sampled` steps; there are as many tables as make a window whose walk agrees in `agree` of
    its steps a candidate with probability `recall`.
    """

    similarity: float = 0.8
    least_words: int = 3
    recall: float = 0.9
    agree: float = 0.8
    sampled: int = 4
    seed: int = 11

    @property
    def tables(self) -> int:
        return max(1, math.ceil(math.log(1 - self.recall) / math.log(1 - self.agree**self.sampled)))

    def edits(self, n: int) -> int:
        return int(n * (1 - self.similarity) + 1e-9)

    def anchor_words(self, n: int) -> int:
        """Words that a walk covers on average: a power of two, half of the item at most and 8 at most; 0 is one step.

        A window of the item's size has a walk from each of its words, so edits spoil only those that pass them.
        """
        return 1 << min(3, (n // 2).bit_length() - 1) if n > 1 else 0

    def steps(self, span: int) -> list[np.ndarray]:
        """The sampled steps of each table of walks of 2 * span steps."""
        random = np.random.default_rng(self.seed + span)
        steps = max(1, 2 * span)
        return [np.sort(random.choice(steps, min(self.sampled, steps), replace=False)) for _ in range(self.tables)]


def walk_keys(hashes: np.ndarray, first: np.ndarray, spans: list[int], search: Search):
    """(span, table, keys, ends) of the walks from every word, text by text.

    `ends` tells where the last sampled step was read; a walk that has left its text reads nothing there. The
    coins of a word are bits of its value, so a word moves a walk alike wherever it is read.
    """
    count = np.diff(first)
    text = np.repeat(np.arange(len(count)), count)
    # A word of no value, which no walk leaves, stands behind each text.
    padded = np.zeros(len(hashes) + len(count), np.uint64)
    begin = np.arange(len(hashes)) + text
    padded[begin] = words.mix(hashes ^ np.uint64(search.seed))
    wanted = {(span, t): steps for span in spans for t, steps in enumerate(search.steps(span))}
    keys = {name: np.full(len(begin), np.uint64(name[0] * 1000 + name[1] + 1)) for name in wanted}
    at = begin
    for step in range(max(1, 2 * max(spans)) if spans else 0):
        read = padded[at]
        for name, steps in wanted.items():
            if step in steps:
                keys[name] += read
                keys[name] *= np.uint64(0x9E3779B97F4A7C15)
                if step == steps[-1]:
                    yield *name, keys.pop(name), read
        at = at + ((read >> np.uint64(step + 8)) & np.uint64(1)).view(np.int64)


class Tables:
    """The hash tables of a block of items: keys of the walks from each of their words."""

    def __init__(self, items: list[tuple[int, np.ndarray]], search: Search):
        self.search = search
        self.items = items
        lengths = np.array([len(h) for _, h in items], np.int64)
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        hashes = np.concatenate([h for _, h in items]) if items else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(items)), lengths)
        spans = np.array([search.anchor_words(n) for n in lengths.tolist()], np.int64)
        self.spans = sorted(set(spans.tolist()))
        keys, owners, anchors = [], [], []
        for span, _, found, read in walk_keys(hashes, offsets, self.spans, search):
            good = np.flatnonzero((spans[item] == span) & (read != 0))  # the sampled steps stay in the item
            keys.append(found[good])
            owners.append(item[good])
            anchors.append(good - offsets[item[good]])
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.owners = np.concatenate(owners)[order] if owners else np.zeros(0, np.int64)
        self.anchors = np.concatenate(anchors)[order] if anchors else np.zeros(0, np.int64)
        self.taken = np.zeros(1 << 20, bool)
        self.taken[self.keys >> _BUCKET_BITS] = True

    def candidates(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Rows (item, word where its window would begin, word that was hit); the window may begin before the text."""
        found = [np.zeros((0, 3), np.int64)]
        for _, _, keys, _ in walk_keys(hashes, first, self.spans, self.search):
            at = np.flatnonzero(self.taken[keys >> _BUCKET_BITS])
            low = np.searchsorted(self.keys, keys[at], "left")
            many = np.searchsorted(self.keys, keys[at], "right") - low
            at, low, many = at[many > 0], low[many > 0], many[many > 0]
            entry = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            hit = np.repeat(at, many)
            found.append(np.stack([self.owners[entry], hit - self.anchors[entry], hit], 1))
        return np.concatenate(found)


def edit_distance_within(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edits between the item and any stretch of the text, and the end of the first such stretch."""
    places = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(new - places) + places
    end = int(row.argmin())
    return int(row[end]), end


def _matches(tables: Tables, hashes: np.ndarray, first: np.ndarray):
    """(text, item, edits, words of the item, first word looked at): the best stretch of each text and item."""
    hits = tables.candidates(hashes, first)
    if not len(hits):
        return
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    owner, start, at = hits.T
    where = text[at]
    order = np.lexsort((start, owner, where))
    rows = np.unique(np.stack([where[order], owner[order], start[order]], 1), axis=0)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    done: dict[tuple[int, int], int] = {}
    for t, o, s in rows.tolist():
        item = tables.items[o][1]
        slack = tables.search.edits(len(item))
        if s <= done.get((t, o), -(1 << 60)) or best.get((t, o), (1,))[0] == 0:
            continue
        low, high = max(int(first[t]), s - slack), min(int(first[t + 1]), s + len(item) + 2 * slack)
        done[t, o] = s + slack  # starts up to there lie in the same stretch
        part = hashes[low:high]
        if np.isin(item, part).sum() < len(item) - slack:
            continue
        if len(item) < tables.search.least_words and first[t + 1] - first[t] != len(item):
            continue
        edits, end = edit_distance_within(item, part)
        if edits <= slack and edits < best.get((t, o), (1 << 60,))[0]:
            best[t, o] = (edits, low + end - int(first[t]))
    for (t, o), (edits, end) in best.items():
        yield t, o, edits, end


_FOUND = "doc_id long, item_id long, edits int, item_words int, similarity double, end_word long"


def unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where code points of scripts without blanks between words begin (Thai, Lao, Burmese, Khmer, kana, Han), and of their punctuation.

    In UTF-8 the first two bytes tell: U+0E00-0EFF, U+1000-10BF, U+1780-17FF, U+3040-9FFF, U+20000-2FFFF, and U+3000-303F.
    """
    at = np.flatnonzero(data >= 0xE0)
    lead, second = data[at], data[np.minimum(at + 1, len(data) - 1)]
    marks = (lead == 0xE3) & (second == 0x80)
    alone = (lead >= 0xE3) & (lead <= 0xE9) & ~marks
    alone |= (lead == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    alone |= (lead == 0xE1) & np.isin(second, (0x80, 0x81, 0x82, 0x9E, 0x9F))
    alone |= (lead == 0xF0) & (second >= 0xA0) & (second <= 0xAF)
    return at[alone], at[marks]


def unit_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the words of each text and the number of words before it; a code point of an unspaced script is a word."""
    alone, marks = unspaced(data)
    if not len(alone) and not len(marks):
        return words.word_hashes(data, starts, words.PUNCTUATION)
    inside = ~words.PUNCTUATION[data]
    for k in range(3):
        inside[marks + k] = False
    opens = np.zeros(len(data) + 1, bool)  # a word ends here, or one begins
    opens[starts] = True
    opens[alone] = True
    opens[alone + np.where(data[alone] >= 0xF0, 4, 3)] = True
    before = np.concatenate(([False], inside[:-1]))
    begin = np.flatnonzero(inside & (~before | opens[:-1]))
    end = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | opens[1:])) + 1
    return words.hash_spans(words.lowered(data), begin, end), np.searchsorted(begin, starts)


def text_words(column: pa.Array):
    """Chunks of texts: first row, word hashes, number of words before each text; punctuation separates words."""
    for a, _, data, starts in words.chunks(column):
        yield a, *unit_hashes(data, starts)


def _search_batches(batches, tables: Tables):
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        ids = batch.column(0).to_pylist()
        for a, hashes, first in text_words(batch.column(1)):
            for t, o, edits, end in _matches(tables, hashes, first):
                item_id, item = tables.items[o]
                values = (ids[a + t], item_id, edits, len(item), 1 - edits / len(item), end)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], [c.split()[0] for c in _FOUND.split(", ")])


def _count_batches(batches):
    for batch in batches:
        n = [np.diff(first) for _, _, first in text_words(batch.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(n) if n else np.zeros(0, np.int64))], ["n"])


def find_leaks(docs: DataFrame, benchmark: DataFrame, search: Search = Search(), id_column="doc_id", text_column="text", item_column="item_id", item_text="text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, edits, item_words, similarity, end_word.

    Words are runs of letters, digits and other characters above ASCII, with A-Z lower-cased; in scripts without blanks
    between words each character is a word. Of the stretches
    of a text that are within the edits the best counts, and its first end. Items are taken in blocks of about
    `block_words` words, so what is broadcast is bounded; each block is one pass over the documents, and no document is moved.

    Null or empty texts and items match nothing, nor do those without a word; an item with a null id is sought, one below the
    least number of words is found only in a text that has no other word; repeated rows are listed each; empty
    tables give no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    items = benchmark.select(F.col(item_column).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    total = items.select("text").mapInArrow(_count_batches, "n long").agg(F.sum("n")).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))
    found = None
    for block in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct().collect()
        mine.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"] or ""))
        hashed = []
        column = pa.array([r["text"] for r in mine], pa.string())
        for a, hashes, first in text_words(column):
            for k in range(len(first) - 1):
                if first[k + 1] > first[k]:
                    hashed.append((mine[a + k]["item_id"], hashes[first[k] : first[k + 1]]))
        part = rows.mapInArrow(partial(_search_batches, tables=Tables(hashed, search)), _FOUND)
        found = part if found is None else found.unionByName(part)
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, search: Search = Search(), id_column="doc_id", text_column="text") -> DataFrame:
    """The documents in which no item is found, with all their columns; a null id counts as one more id."""
    leaks = find_leaks(docs, benchmark, search, id_column, text_column)
    gone = written(leaks.select(F.col("doc_id").alias("__gone")).distinct(), "leaks")
    return docs.join(gone, docs[id_column].eqNullSafe(gone["__gone"]), "left_anti")
