"""Consume the JSON feed: parse, keep the wanted life stages, store, and set rejects aside."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from tidymart.contracts import FEED_SCHEMA, STREAM_STAGES

log = logging.getLogger(__name__)

STORED, FILTERED, MISSING_FIELD, REJECTED = "stored", "filtered", "missing_field", "rejected"


def read_feed(spark: SparkSession, fmt: str, options: dict[str, str], path: str | None = None) -> DataFrame:
    """Text records of a stream as one column ``value`` (Kafka options such as startingOffsets pass)."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader.load(path) if path else reader.load()).select(F.col("value").cast("string"))


def route(
    feed: DataFrame,
    schema: T.StructType = FEED_SCHEMA,
    field: str = "ciclo_vida",
    wanted: Sequence[str] = STREAM_STAGES,
) -> DataFrame:
    """Add the parsed ``record``, its ``outcome`` and the ``reason`` of a reject.

    An absent field, a field that is null and a text that is not a JSON object are three outcomes.
    A value of the wrong type matters only for records that would be stored.
    """
    corrupt = "_corrupt"
    parsed = F.from_json(
        "value",
        T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt},
    )
    keys = F.json_object_keys("value")
    routed = feed.withColumn("keys", keys).withColumn("record", parsed)
    reason = (
        F.when(F.col("keys").isNull(), "not a JSON object")
        .when(~F.array_contains("keys", field), f"no field {field}")
        .when(F.coalesce(F.col(f"record.{field}").isin(*wanted), F.lit(False)) & F.col(f"record.{corrupt}").isNotNull(), "wrong type")
    )
    outcome = (
        F.when(F.col("reason") == f"no field {field}", MISSING_FIELD)
        .when(F.col("reason").isNotNull(), REJECTED)
        .when(F.col(f"record.{field}").isin(*wanted), STORED)
        .otherwise(FILTERED)
    )
    record = F.struct(*(F.col(f"record.{f.name}") for f in schema.fields))
    return (
        routed.withColumn("reason", reason)
        .withColumn("outcome", outcome)
        .select("value", record.alias("record"), "outcome", "reason")
    )


def stored(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("outcome") == STORED).select("record.*")


def set_aside(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("outcome").isin(MISSING_FIELD, REJECTED)).select("value", "outcome", "reason")


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that a checkpoint belongs to."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def _not_stored(good: DataFrame, table: str, own: str, key: list[str]) -> DataFrame:
    """The records whose key no other batch has stored; what an earlier attempt of this batch stored doesn't count."""
    spark = good.sparkSession
    try:
        before = spark.read.option("mergeSchema", False).schema(good.schema).parquet(table)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return good
    known = before.where(~F.col("_metadata.file_path").contains(f"/{own}/")).select(*key).distinct()
    return good.join(known, key, "left_anti")


def consume(
    feed: DataFrame,
    table: str,
    rejects: str,
    checkpoint: str,
    schema: T.StructType = FEED_SCHEMA,
    field: str = "ciclo_vida",
    wanted: Sequence[str] = STREAM_STAGES,
    unique_by: Sequence[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the job. Each micro-batch overwrites its own folder, so a repeated batch adds nothing.

    The folder is named after the query, whose id lives in the checkpoint, and the batch: a job with a new
    checkpoint counts its batches from 0 again, but adds to what other jobs have stored.

    ``unique_by`` drops records whose key is stored already, by this job or another on the same table. Each
    batch reads the key columns of the stored table for it; there is no state besides the table, so this is for tables
    that stay small: :func:`settle` keeps the keys as state. Records with a null in the key are repeated only
    if they come again in another batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        own = f"query={_query_id(batch.sparkSession, checkpoint)}/batch={number}"
        batch = batch.persist()
        try:
            good = stored(batch)
            if unique_by:
                good = _not_stored(good.dropDuplicates(list(unique_by)), table, own, list(unique_by))
            good.write.mode("overwrite").parquet(f"{table}/{own}")
            set_aside(batch).write.mode("overwrite").parquet(f"{rejects}/{own}")
        finally:
            batch.unpersist()
        log.info("batch %d written", number)

    return (
        route(feed, schema, field, wanted)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


#: Keys live on the executors' disks and in the checkpoint, not in their heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE_SETTING = "spark.sql.streaming.stateStore.providerClass"


def settle(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    unique_by: Sequence[str],
    schema: T.StructType = FEED_SCHEMA,
    event_time: str | None = None,
    horizon: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Move records from where :func:`consume` lands them to `table`, each key once; the keys are state of this query.

    Any number of feeding jobs, each with its own checkpoint, land in ``landing``. A batch reads the files that have
    come since the last one and looks its own keys up in the state store, which is split by key; stored records are
    not read again. Of records that share a key the one that comes first is stored, of several in one batch
    any one. Records with a null in the key are stored as often as they are landed.

    Without a ``horizon`` a key is kept for good and the state grows with the number of keys. With ``event_time`` (a
    timestamp column) and ``horizon`` (such as "7 days") keys are forgotten that long after the latest event, and
    what comes later than that may be stored anew.
    """
    names = [f"__k{i}" for i in range(len(unique_by))]
    landed = spark.readStream.schema(schema).parquet(landing)
    whole = F.lit(True)
    for c in unique_by:
        whole = whole & F.col(c).isNotNull()
    # A record without a whole key is its own key: its place in the landing folder.
    place = F.concat_ws("#", "_metadata.file_path", F.col("_metadata.row_index").cast("string"))
    keyed = landed.select("*", F.when(~whole, place).alias("__alone"), *(F.col(c).alias(n) for c, n in zip(unique_by, names, strict=True)))
    if horizon:
        unique = keyed.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark([*names, "__alone"])
    else:
        unique = keyed.dropDuplicates([*names, "__alone"])

    def write(batch: DataFrame, number: int) -> None:
        own = f"query={_query_id(batch.sparkSession, checkpoint)}/batch={number}"
        batch.write.mode("overwrite").parquet(f"{table}/{own}")

    before = spark.conf.get(_STATE_SETTING)
    spark.conf.set(_STATE_SETTING, STATE_STORE)
    try:
        return (
            unique.select(*schema.fieldNames())
            .writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        spark.conf.set(_STATE_SETTING, before)


def stored_table(spark: SparkSession, path: str, schema: T.StructType = FEED_SCHEMA) -> DataFrame:
    """What the stream has stored so far."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


REJECT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("value", "outcome", "reason")]
)


def reject_table(spark: SparkSession, path: str) -> DataFrame:
    return stored_table(spark, path, REJECT_SCHEMA)
