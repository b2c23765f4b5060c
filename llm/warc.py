"""WARC archives written and read by Spark; records are told from look-alikes by boundary-chain verification."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidymart.session import written

MAGIC = "WARC/1.0\r\n"
_HEAD_END = b"\r\n\r\n"
_DATE = "2000-01-01T00:00:00Z"  # the time of capture is not part of the table


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: forty bits are ten hexadecimal digits and eight of base 32."""
    hexes = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexes, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def decide_records(pages: DataFrame, least: int = 0, id_column="page_id", text_column="html") -> DataFrame:
    """Per page: id, payload_bytes, payload_digest, record_type, refers_to.

    Of equal payloads of `least` bytes or more the one with the smallest id is the response and the others revisit
    it. The digests are counted before anything is joined, so a third of all pages may hold the same payload.
    """
    payload = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    keys = pages.select(
        F.col(id_column).alias("page_id"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        base32_sha1(payload).alias("payload_digest"),
    )
    keys = written(keys, "warc-keys")
    first = keys.groupBy("payload_digest").agg(F.min("page_id").alias("first"))
    found = keys.join(first, "payload_digest")
    again = (F.col("payload_bytes") >= least) & (F.col("page_id") != F.col("first"))
    return found.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, path: str, least: int = 0, id_column="page_id", url_column="url", text_column="html") -> None:
    """One record per page in the WARC files at `path`, through Spark's text writer.

    The line separator of the writer is what ends a record. Revisits have no payload. Line ends in a URL are
    escaped. Only the revisits, which are few, are joined to the pages; a null id is written as a response.
    """
    decided = decide_records(pages, least, id_column, text_column).filter("record_type = 'revisit'")
    revisits = written(decided.select(F.col("page_id").alias("__id"), "refers_to").distinct(), "warc-revisits")
    rows = pages.select(F.col(id_column).alias("page"), F.col(url_column).alias("url"), F.coalesce(F.col(text_column), F.lit("")).alias("html"))
    rows = rows.join(revisits, rows["page"] == revisits["__id"], "left")
    text = F.col("html")
    revisit = F.col("refers_to").isNotNull()
    payload = F.when(revisit, F.lit("")).otherwise(text)
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    url = F.regexp_replace(F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "\r", "%0D"), "\n", "%0A")
    lines = [
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page"))),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.lit(f"WARC-Date: {_DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_sha1(text.cast("binary"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("refers_to")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(payload).cast("string")),
    ]
    record = F.concat(F.lit(MAGIC), F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), payload)
    rows.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").text(path)


_SEGMENTS = (
    "file string, block long, at long, length long, succ long, leave long, page_id long, kind string, "
    "refers_to long, payload_bytes long, digest string, whole boolean"
)
_NAMES = [c.split()[0] for c in _SEGMENTS.split(",")]


def _field(head: bytes, name: bytes) -> bytes:
    """Value of a header field, empty if it is not there; field names ignore case."""
    for line in head.split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name:
            return value.strip()
    return b""


def _number(text: bytes) -> int | None:
    text = text.removeprefix(b"<urn:page:").removesuffix(b">")
    return int(text) if text.isdigit() or text[:1] == b"-" and text[1:].isdigit() else None


def _segment(value: bytes) -> tuple:
    """(bytes to the next record or None, page, type, refers_to, payload length, digest or None, complete)."""
    head_end = value.find(_HEAD_END)
    length = _field(value[:head_end], b"content-length") if head_end >= 0 else b""
    if not length.isdigit():
        return None, None, None, None, None, None, False
    head, size = value[:head_end], int(length)
    whole = len(value) == head_end + 4 + size + 4
    kind = _field(head, b"warc-type").decode("utf-8", "replace")
    stated = _field(head, b"warc-payload-digest").decode("utf-8", "replace").removeprefix("sha1:")
    payload = value[head_end + 4 : head_end + 4 + size]
    digest = stated if kind == "revisit" else base64.b32encode(hashlib.sha1(payload).digest()).decode() if whole else None
    page, refers = _number(_field(head, b"warc-record-id")), _number(_field(head, b"warc-refers-to"))
    return len(MAGIC) + head_end + 4 + size + 4, page, kind, refers, size, digest, whole


def _leave(at: list[int], succ: list[int | None], end: int) -> list[int | None]:
    """Where the chain from each segment leaves this block: the first place that is no record start in it."""
    index = {a: i for i, a in enumerate(at)}
    leave: list[int | None] = [None] * len(at)
    for i in range(len(at) - 1, -1, -1):
        j = index.get(succ[i]) if succ[i] is not None else None
        leave[i] = succ[i] if j is None or leave[j] is None else leave[j]
    return leave


def _segment_batches(batches):
    """Segments between magics of each block of a file; places are relative to the block's first segment."""
    now, rows, at = None, [], 0

    def flush():
        places = [r[0] for r in rows]
        exits = _leave(places, [r[2] for r in rows], at)
        columns = [[now[0]] * len(rows), [now[1]] * len(rows), *map(list, zip(*rows, strict=True))]
        columns.insert(5, exits)
        kinds = (pa.string(), *[pa.int64()] * 6, pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _NAMES)

    for batch in batches:
        files, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for k, value in enumerate(batch.column(2)):
            value = value.as_py()
            if (files[k], blocks[k]) != now:
                if rows:
                    yield flush()
                now, rows, at = (files[k], blocks[k]), [], 0
            step, *rest = _segment(value)
            # The magic before this segment is its first bytes; the file's first segment has none and is empty.
            rows.append((at - len(MAGIC), len(value) + len(MAGIC), None if step is None else at - len(MAGIC) + step, *rest))
            at += len(value) + len(MAGIC)
    if rows:
        yield flush()


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select("_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary").alias("value"))


def _walk(group: pd.DataFrame) -> pd.DataFrame:
    """Segments of a block in order, each with the place of the record that owns it, following the chain.

    `entry` is where the chain enters the block; what comes before belongs to a record of an earlier block.
    """
    group = group.sort_values("at", kind="stable")
    entry = group["entry"].iloc[0]
    owner, wanted = np.full(len(group), -1, np.int64), int(entry) if pd.notna(entry) else None
    current = -1
    for i, (at, succ) in enumerate(zip(group["at"], group["succ"], strict=True)):
        if wanted is not None and at == wanted:
            current, wanted = at, int(succ) if pd.notna(succ) else None
        owner[i] = current
    return group.assign(owner=owner)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives at `path`: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Every task splits its block at the magic and emits, for each candidate, the place of its successor. Chains are
    followed inside a block first, then across blocks by pointer jumping from the start of each file; what no
    chain reaches is payload. Payloads in several segments are put together again and digested; a chain that
    leads to no record start ends there, so what follows damage is left out.

    Files are read in blocks; only headers and digests are shuffled, and the payloads that hold the magic.
    """
    schema = _SEGMENTS
    found = written(_lines(spark, path).mapInArrow(_segment_batches, schema), "warc-segments")
    # A block's place in its file is the bytes of the blocks before it: one row per block.
    sizes = found.groupBy("file", "block").agg(F.sum("length").alias("bytes"))
    earlier = F.sum("bytes").over(_by_file().rowsBetween(-(2**31), -1))
    first = F.row_number().over(_by_file())
    bases = sizes.select("file", "block", F.coalesce(earlier, F.lit(0)).alias("base"), first.alias("number"), "bytes")
    bases = written(bases, "warc-blocks")
    moved = [(F.col(c) + F.col("base")).alias(c) for c in ("at", "succ", "leave")]
    rest = [c for c in _NAMES if c not in ("at", "succ", "leave")]
    segments = written(found.join(bases, ["file", "block"]).select(*rest, *moved), "warc-candidates")

    # Pointer jumping: the places reached from a file's start, doubling the jump each round.
    most = bases.agg(F.max("number")).first()[0] or 0
    jumps = segments.filter("succ is not null").select("file", F.col("at").alias("here"), F.col("leave").alias("there"))
    starts = jumps.filter("here = 0").select("file", "here")
    reached = starts
    reach, span = jumps, 1
    while span < most:
        step = reached.join(reach, ["file", "here"]).select("file", F.col("there").alias("here"))
        reached = written(reached.union(step).distinct(), "warc-reached")
        after = reach.select("file", F.col("here").alias("there"), F.col("there").alias("beyond"))
        reach = written(reach.join(after, ["file", "there"]).select("file", "here", F.col("beyond").alias("there")), "warc-jumps")
        span *= 2
    # The place where the chain enters each block it passes.
    marks = reached.select("file", F.col("here").alias("at")).distinct()
    entries = segments.select("file", "block", "at").join(marks, ["file", "at"]).groupBy("file", "block").agg(F.min("at").alias("entry"))
    walked = segments.join(written(entries, "warc-entries"), ["file", "block"], "left").select(*_NAMES, "entry")
    walked = written(walked.groupBy("file", "block").applyInPandas(_walk, f"{_SEGMENTS}, entry long, owner long"), "warc-owners")
    records = walked.filter("owner = at")
    broken = records.filter("not whole and kind <> 'revisit'")
    if not broken.isEmpty():
        records = records.join(_digest_again(spark, path, bases, walked, broken), ["file", "at"], "left")
        records = records.withColumn("digest", F.coalesce("again", "digest"))
    records = records.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")
    responses = records.filter("record_type = 'response'").groupBy(F.col("page_id").alias("__id")).agg(F.max("payload_bytes").alias("__bytes"))
    revisits = records.filter("record_type = 'revisit'").join(responses, F.col("refers_to") == F.col("__id"), "left")
    revisits = revisits.select("page_id", F.col("__bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    return records.filter("record_type <> 'revisit'").unionByName(revisits)


def _by_file():
    return Window.partitionBy("file").orderBy("block")


def _digest_again(spark: SparkSession, path: str, bases: DataFrame, walked: DataFrame, broken: DataFrame) -> DataFrame:
    """Digest of the payloads that hold the magic: (file, at, again)."""
    # Segments before a block's entry belong to the last record of an earlier block.
    last = F.last(F.when(F.col("owner") >= 0, F.col("owner")), ignorenulls=True).over(_by_file_at())
    parts = walked.select("file", F.col("at").alias("part"), last.alias("owner"))
    wanted = broken.select("file", F.col("at").alias("owner"), "payload_bytes")
    parts = written(parts.join(wanted, ["file", "owner"]), "warc-parts")
    numbered = _lines(spark, path).mapInArrow(_place_lines, "file string, block long, at long, value binary")
    placed = numbered.join(bases, ["file", "block"]).select("file", (F.col("at") + F.col("base")).alias("part"), "value")
    texts = placed.join(parts, ["file", "part"])
    return texts.groupBy("file", "owner").applyInPandas(_digest_parts, "file string, at long, again string")


def _by_file_at():
    return Window.partitionBy("file").orderBy("at")


def _place_lines(batches):
    now, at = None, 0
    for batch in batches:
        files, blocks, places = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
        for k, value in enumerate(batch.column(2)):
            if (files[k], blocks[k]) != now:
                now, at = (files[k], blocks[k]), 0
            places.append(at - len(MAGIC))
            at += len(value.as_py()) + len(MAGIC)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(places, pa.int64()), batch.column(2)], ["file", "block", "at", "value"]
        )


def _digest_parts(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("part", kind="stable")
    record = MAGIC.encode().join(group["value"])
    begin = record.find(_HEAD_END) + 4
    payload = record[begin : begin + int(group["payload_bytes"].iloc[0])]
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return pd.DataFrame({"file": [group["file"].iloc[0]], "at": [group["owner"].iloc[0]], "again": [digest]})
