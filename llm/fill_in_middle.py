"""Fill-in-middle texts by secondary-sort assembly: pieces keyed by document and output position, put together as a stream.

A text becomes prefix, middle and suffix; the output is a new order of them behind sentinels. The output is cut
into pieces of bounded length. One shuffle deals the pieces by document, and a sort within the partitions brings
them into output order (the two steps that an RDD has as repartitionAndSortWithinPartitions), so a task holds one
piece at a time, whatever the length of a document. The restoring pass reads nothing but that stream and the form:
it finds the sentinels, gives each part its place in the text, and the pieces are sorted anew within the same partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Code points in a piece.
UNIT = 4_096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: The sentinels of each form in output order, and the place of the part behind each of them in the text.
ORDERS = {PLAIN: (), PSM: ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), SPM: ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}
_LAST = 9  # sorts behind all parts of a text

_KEY = ("doc_id", "tag", "part")
_KEY_DDL = "doc_id long, tag long, part int"
_ABOUT_DDL = "n long, form string, prefix_chars long, middle_chars long"
_PIECES_DDL = f"{_KEY_DDL}, at long, piece string, {_ABOUT_DDL}"
_RESTORED_DDL = f"{_KEY_DDL}, place int, at long, piece string, {_ABOUT_DDL}, output_sha256 string, copies long"
_RESULT_DDL = f"doc_id long, {_ABOUT_DDL}, output_sha256 string, restored_sha256 string"


@dataclass(frozen=True)
class Spec:
    """Seed of the hashes, percent of the texts that are transformed, and percent of those in suffix-first form."""

    seed: int = 1
    transformed: int = 90
    suffix_first: int = 20


def cuts(doc_id: int | None, text: str, spec: Spec) -> tuple[str, int, int]:
    """Form, end of the prefix, end of the middle; they depend on id, length and sentinels in the text alone."""
    digest = hashlib.sha256(f"{spec.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or h3 % 100 >= spec.transformed or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return PLAIN, 0, 0
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    return (SPM if h4 % 100 < spec.suffix_first else PSM), a, b


def arranged(text: str, form: str, a: int, b: int) -> str:
    parts = (text[:a], text[a:b], text[b:])
    return "".join(mark + parts[place] for mark, place in ORDERS[form]) or text


class Splitter:
    """Finds the sentinels of a form in a stream of pieces: (place, offset in the part, text), holding back two code points."""

    def __init__(self, form: str):
        self.marks = list(ORDERS[form])
        self.place, self.at, self.held = 0, 0, ""

    def _emit(self, text: str) -> Iterator[tuple[int, int, str]]:
        if text:
            yield self.place, self.at, text
            self.at += len(text)

    def feed(self, piece: str) -> Iterator[tuple[int, int, str]]:
        rest = self.held + piece
        while self.marks and (found := rest.find(self.marks[0][0])) >= 0:
            yield from self._emit(rest[:found])
            mark, self.place = self.marks.pop(0)
            rest, self.at = rest[found + len(mark) :], 0
        hold = len(rest) - 2 if self.marks else len(rest)
        yield from self._emit(rest[: max(hold, 0)])
        self.held = rest[max(hold, 0) :]

    def end(self) -> Iterator[tuple[int, int, str]]:
        yield from self._emit(self.held)
        self.held = ""


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [field.split() for field in ddl.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    arrays = [pa.array(c, types[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _batched(rows: Iterator[tuple], ddl: str, text_at: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about `most` code points of text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + len(row[text_at] or "")
        if size >= most:
            yield _batch(held, ddl)
            held, size = [], 0
    yield _batch(held, ddl)


def _rows(batches) -> Iterator[tuple]:
    """The rows of all batches, a slice at a time, so that no more than a slice is held as Python objects."""
    for batch in batches:
        for k in range(0, len(batch), 256):
            yield from zip(*(c.to_pylist() for c in batch.slice(k, 256).columns), strict=True)


def _cut_batches(batches, spec: Spec, unit: int):
    def pieces():
        for doc_id, part, text in _rows(batches):
            text = text or ""
            form, a, b = cuts(doc_id, text, spec)
            output = arranged(text, form, a, b)
            tag = int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)
            about = (len(text), form, *((None, None) if form == PLAIN else (a, b - a)))
            for at in range(0, len(output) or 1, unit):
                yield doc_id, tag, part, at, output[at : at + unit], *(about if at == 0 else (None,) * 4)

    yield from _batched(pieces(), _PIECES_DDL, 4)


def fim_pieces(docs: DataFrame, spec: Spec = Spec(), unit: int = UNIT, id_column="doc_id", text_column="text") -> DataFrame:
    """The output as pieces of at most `unit` code points: key, place in the output, piece; the first has the facts of its text.

    The key is id, text hash and input partition, so documents that share an id stay apart. Rows that repeat id and text
    have equal pieces, which count as copies. A null text is empty and has one empty piece; a null id is hashed as no digits.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.spark_partition_id().alias("part"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(partial(_cut_batches, spec=spec, unit=unit), _PIECES_DDL)


def in_output_order(pieces: DataFrame) -> DataFrame:
    """The secondary sort: pieces of a document meet in one partition, in output order."""
    return pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "at")


def _digest_batches(batches):
    """The digest of each output, and its parts with their place in the text."""

    def rows():
        key, digest, splitter, about, last, copies = None, None, None, None, 0, 0

        def finish():
            for place, at, text in splitter.end():
                yield *key, place, at, text, *(None,) * 6
            yield *key, _LAST, 0, None, *about, digest.hexdigest(), copies

        for doc_id, tag, part, at, piece, *facts in _rows(batches):
            if (doc_id, tag, part) != key:
                if key is not None:
                    yield from finish()
                key, about, last, copies = (doc_id, tag, part), facts, -1, 0
                digest, splitter = hashlib.sha256(), Splitter(facts[1])
            copies += at == 0
            if at == last:
                continue
            last = at
            digest.update(piece.encode())
            for place, start, text in splitter.feed(piece):
                yield *key, place, start, text, *(None,) * 6
        if key is not None:
            yield from finish()

    yield from _batched(rows(), _RESTORED_DDL, 5)


def _restore_batches(batches):
    def rows():
        digest = hashlib.sha256()
        for doc_id, _, _, place, _, piece, *about, output, copies in _rows(batches):
            if place != _LAST:
                digest.update(piece.encode())
                continue
            for _ in range(copies):
                yield doc_id, *about, output, digest.hexdigest()
            digest = hashlib.sha256()

    yield from _batched(rows(), _RESULT_DDL, 5)


def fim_digests(docs: DataFrame, spec: Spec = Spec(), unit: int = UNIT, id_column="doc_id", text_column="text") -> DataFrame:
    """One row per document: id, length, form, sizes of the parts, SHA-256 of the output and of the text rebuilt from it.

    A null text counts as empty; empty texts and texts that hold a sentinel stay plain, with null sizes. Repeated rows
    have a row each. An empty table gives no rows, other columns are ignored, and a text of any length passes piece by piece.
    """
    ordered = in_output_order(fim_pieces(docs, spec, unit, id_column, text_column))
    parts = ordered.mapInArrow(_digest_batches, _RESTORED_DDL)
    return parts.sortWithinPartitions(*_KEY, "place", "at").mapInArrow(_restore_batches, _RESULT_DDL)


def _text_batches(batches):
    def rows():
        key, held, last, copies, about = None, [], -1, 0, None
        for doc_id, tag, part, at, piece, *facts in _rows(batches):
            if (doc_id, tag, part) != key:
                if key is not None:
                    yield from ((key[0], "".join(held), about[1]) for _ in range(copies))
                key, held, last, copies, about = (doc_id, tag, part), [], -1, 0, facts
            copies += at == 0
            if at != last:
                held.append(piece)
                last = at
        if key is not None:
            yield from ((key[0], "".join(held), about[1]) for _ in range(copies))

    yield from _batched(rows(), "doc_id long, text string, form string", 1)


def fim_texts(docs: DataFrame, spec: Spec = Spec(), unit: int = UNIT, id_column="doc_id", text_column="text") -> DataFrame:
    """(doc_id, text, form): the outputs themselves. Here a task holds one output at a time, because a row does."""
    ordered = in_output_order(fim_pieces(docs, spec, unit, id_column, text_column))
    return ordered.mapInArrow(_text_batches, "doc_id long, text string, form string")
