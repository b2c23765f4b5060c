"""Best-fit packing of token sequences: patterns by non-negative least squares, residuals by best fit.

The plan is made from the histogram of piece lengths, whose size is bounded by the sequence length, not by the
documents. Pieces find their place by their rank among pieces of the same length, so nothing else is ordered.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidymart.session import written

#: Words whose ids a Python worker keeps, of about 200 bytes each.
CACHED_WORDS = 800_000
_WORDS_AT_ONCE = 1 << 20
_TEXTS_AT_ONCE = 1_000
#: Kinds of characters that the byte-level rule parts in the same way wherever they stand: Latin letters, digits,
#: punctuation but the apostrophe, and a line feed alone.
_PARTS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+|[0-9]+|[!-&(-/:-@\\[-`{-~]+|\n")
_PLAIN = re.compile("(?:[A-Za-zÀ-ÖØ-öø-ɏ0-9!-&(-/:-@\\[-`{-~]|\n(?!\n))+")


def byte_letters() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is printable, else the next from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


_LETTERS = byte_letters()


class WordEncoder:
    """Token ids of texts as little-endian 32-bit bytes; a word is encoded once while it stays in a bounded cache.

    In byte-level BPE a blank before a word belongs to the word, so a text whose blanks stand alone between words
    can be cut before each blank without changing its ids. Other texts, and those that hold an added token of the
    tokenizer, are encoded whole. With `added_as_text` added tokens have no ids of their own; the operator doesn't use it.
    """

    def __init__(self, path: str, limit: int = CACHED_WORDS, added_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = added_as_text
        added = [] if added_as_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.limit = limit
        settings = json.loads(self.tokenizer.to_str())
        cut = settings["pre_tokenizer"] or {}
        by_rule = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        self.by_rule = bool(by_rule) and not settings["normalizer"]
        self.tokenizer_model = self.tokenizer.model
        self.parts: dict[str, bytes] = {}
        self.later: dict[str, bytes | None] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _word(self, text: str) -> bytes:
        """Ids of a short text, without the offsets and masks of a full encoding."""
        model, cut = self.tokenizer.model, self.tokenizer.pre_tokenizer.pre_tokenize_str
        return array("I", [token.id for part, _ in cut(text) for token in model.tokenize(part)]).tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        start, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= _WORDS_AT_ONCE or i + 1 == len(texts):
                yield from self._run(texts[start : i + 1])
                start, size = i + 1, 0

    def _run(self, texts: list[str]) -> Iterator[bytes]:
        whole = [self.added is not None and self.added.search(t) is not None for t in texts]
        # Nothing of a text that is encoded whole enters the cache.
        words = [[""] if w else t.split(" ") for t, w in zip(texts, whole, strict=True)]
        known = self.later
        if len(known) > self.limit:
            known.clear()
        self._learn(set().union(*[ws[1:] for ws in words]) - known.keys())
        first = [self._word(ws[0]) for ws in words]
        get = known.__getitem__
        for text, head, ws, as_one in zip(texts, first, words, whole, strict=True):
            if as_one or len(ws) > 1 and ws[0] and ws[0][-1].isspace():
                yield self._whole([text])[0]
                continue
            try:
                yield head + b"".join(map(get, ws[1:]))
            except TypeError:  # an uneven word has no ids of its own
                yield self._whole([text])[0]

    def _learn(self, missing: set[str]) -> None:
        """Encode words that follow a blank; None where it stands next to other white space, or ends the text."""
        uneven = [w for w in missing if not w or w[0].isspace() or w[-1].isspace()]
        self.later.update(dict.fromkeys(uneven))
        missing.difference_update(uneven)
        if len(self.parts) > self.limit // 2:
            self.parts.clear()
        plain = _PLAIN.fullmatch if self.by_rule else lambda w: None
        self.later.update((w, self._by_parts(" " + w) if plain(w) else self._word(" " + w)) for w in missing)

    def _by_parts(self, text: str) -> bytes:
        """Ids of a blank and a word whose parts can be told without the library; each part is encoded once."""
        found = _PARTS.findall(text)
        found[0] = " " + found[0]
        known = self.parts
        for part in found:
            if part not in known:
                letters = part.encode().decode("latin-1").translate(_LETTERS)
                known[part] = array("I", [t.id for t in self.tokenizer_model.tokenize(letters)]).tobytes()
        return known[found[0]] if len(found) == 1 else b"".join([known[p] for p in found])


@lru_cache(1)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path, added_as_text=False)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, chunk long, rank long"


def cut(total: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a sequence: all full but the first."""
    head = total % most or most
    return [(0, head)] + [(at, most) for at in range(head, total, most)]


def _encode_batches(batches, path: str, most: int, end_id: int):
    tokenize = encoder(path)
    end = np.array([end_id], "<u4").tobytes()
    chunk = TaskContext.get().partitionId()
    ranks = [0] * (most + 1)
    # Few texts at once, so that a worker holds little besides its cache.
    for batch in (b.slice(at, _TEXTS_AT_ONCE) for b in batches for at in range(0, len(b), _TEXTS_AT_ONCE)):
        columns: list[list] = [[] for _ in range(6)]
        texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
        for doc_id, ids in zip(batch.column(0).to_pylist(), tokenize.encode(texts), strict=True):
            ids += end
            for piece, (start, length) in enumerate(cut(len(ids) // 4, most)):
                crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                for column, value in zip(columns, (doc_id, piece, start, length, crc, ranks[length]), strict=True):
                    column.append(value)
                ranks[length] += 1
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        arrays.insert(5, pa.array([chunk] * len(columns[0]), pa.int64()))
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "chunk", "rank"])


def enumerate_patterns(counts: np.ndarray, most: int, common: int = 40) -> list[tuple[int, ...]]:
    """Few-document patterns that fill a sequence as far as the lengths at hand allow.

    Pairs for every length, and triples for every pair of the `common` most frequent short lengths; the last
    place goes to the largest length that fits.
    """
    present = np.flatnonzero(counts)
    if not len(present):
        return []
    fits = np.zeros(most + 1, int)
    fits[present] = present
    fits = np.maximum.accumulate(fits)
    found = {(int(n),) for n in present if n > most - present[0]}
    found |= {tuple(sorted((int(n), int(fits[most - n])))) for n in present if n < most and fits[most - n]}
    short = [int(n) for n in present[np.argsort(-counts[present], kind="stable")] if 2 * n < most][:common]
    for pair in combinations_with_replacement(sorted(short), 2):
        rest = most - sum(pair)
        if rest > 0 and fits[rest]:
            found.add(tuple(sorted((*pair, int(fits[rest])))))
    return sorted(found)


def fit_patterns(counts: np.ndarray, patterns: list[tuple[int, ...]], sweeps: int = 60) -> np.ndarray:
    """Non-negative repeats x that minimise |A x - counts|^2, by coordinate descent; A counts lengths in patterns."""
    columns = [np.unique(p, return_counts=True) for p in patterns]
    norms = [float((k * k).sum()) for _, k in columns]
    left = counts.astype(float)
    x = np.zeros(len(patterns))
    for _ in range(sweeps):
        moved = 0.0
        for j, (lengths, times) in enumerate(columns):
            step = max(float(left[lengths] @ times) / norms[j], -x[j])
            if step:
                x[j] += step
                left[lengths] -= step * times
                moved = max(moved, abs(step))
        if moved < 0.01:
            break
    return x


def best_fit(counts: np.ndarray, most: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: (contents of a sequence, how often). Equal sequences are filled together."""
    open_bins: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(most + 1)]
    done = []
    for length in range(most, 0, -1):
        left = int(counts[length])
        room = length
        while left and room <= most:
            if not open_bins[room]:
                room += 1
                continue
            contents, times = open_bins[room].pop()
            used = min(times, left)
            left -= used
            if times > used:
                open_bins[room].append((contents, times - used))
            open_bins[room - length].append(((*contents, length), used))
            if room - length >= length:
                room = length
        fits = most // length
        if left >= fits:
            open_bins[most - fits * length].append(((length,) * fits, left // fits))
        if left % fits:
            open_bins[most - (left % fits) * length].append(((length,) * (left % fits), 1))
        done += open_bins[0]
        open_bins[0] = []
    return done + [group for groups in open_bins for group in groups]


def plan_sequences(counts: np.ndarray, most: int) -> list[tuple[tuple[int, ...], int]]:
    """How often each content of a sequence is used; all pieces of the histogram are placed, none twice."""
    left = counts.copy()
    plan = []
    patterns = enumerate_patterns(counts, most)
    repeats = fit_patterns(counts, patterns)
    for j in np.argsort(-repeats, kind="stable"):
        lengths, times = np.unique(patterns[j], return_counts=True)
        n = min(int(repeats[j]), int((left[lengths] // times).min()))
        if n > 0:
            left[lengths] -= n * times
            plan.append((patterns[j], n))
    return plan + best_fit(left, most)


def places(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first ranks of runs, the sequence of the run's first rank, and the offset in it."""
    taken: dict[int, int] = {}
    runs: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for contents, times in plan:
        offset = 0
        for length in contents:
            runs.setdefault(length, []).append((taken.get(length, 0), sequence, offset))
            taken[length] = taken.get(length, 0) + times
            offset += length
        sequence += times
    return {n: tuple(np.array(c, np.int64) for c in zip(*r, strict=True)) for n, r in runs.items()}


def _place_batches(batches, lookup):
    for batch in batches:
        length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for n in np.unique(length):
            at = np.flatnonzero(length == n)
            first, base, place = lookup[int(n)]
            run = np.searchsorted(first, rank[at], "right") - 1
            sequence[at] = base[run] + rank[at] - first[run]
            offset[at] = place[run]
        arrays = [*batch.columns[:5], pa.array(sequence), pa.array(offset)]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    most: int = 1024,
    end_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    plan: Callable[[np.ndarray, int], list] = plan_sequences,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids followed by `end_id`; only longer ones than `most` are cut, and only the first piece of
    those may be short. A null or empty text is the end id alone; an empty table gives no rows; repeated rows are
    packed each; a null id is kept; other columns are ignored. Sequences hold at most `most` ids without gaps.

    The pieces are written together with the task that made them and their rank of their length in it, so ranks
    hold whatever executor is lost. Only the counts per length reach the driver.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    encode = partial(_encode_batches, path=tokenizer, most=most, end_id=end_id)
    pieces = written(rows.mapInArrow(encode, PIECES), "packing-pieces")
    counted = pieces.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    bases = counted.select("length", "chunk", F.coalesce(before, F.lit(0)).alias("base"))
    counts = np.zeros(most + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most `most` rows
        counts[length] = n
    lookup = places(plan(counts, most))
    ranked = pieces.join(bases, ["length", "chunk"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank")
    )
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(partial(_place_batches, lookup=lookup), schema)
