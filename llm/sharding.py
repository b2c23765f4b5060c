"""Sharding by longest processing time: groups that stay together go, largest first, to the least-loaded shard."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidymart.session import written

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def longest_first(units: list[tuple[str, int]], shards: int) -> list[tuple[str, int]]:
    """The shard of each unit: by falling size (ties by name) to the least-loaded shard (ties by number)."""
    loads = [(0, s) for s in range(shards)]
    placed = []
    for name, size in sorted(units, key=lambda u: (-u[1], u[0])):
        load, shard = heapq.heappop(loads)
        placed.append((name, shard))
        heapq.heappush(loads, (load + size, shard))
    return placed


def shard_groups(docs: DataFrame, group: str, size: str, shards: int = 16, fine: int = 64, bundles: int = 256) -> DataFrame:
    """`docs` (written, with a group key and a size) with a ``shard`` column from 0.

    A group is scheduled by itself if it has at least 1 / (`shards` * `fine`) of all bytes, so there are
    `shards` * `fine` such groups at most. The smaller ones are bundled by the power of two of their size and a
    hash of their key, `bundles` for each power: the schedule holds a bounded number of units however many
    groups there are, and the bundles of tiny groups, placed last, level the loads.

    Rows with a null group key form one group; a null size counts as 0; an empty table gives no rows.
    """
    groups = docs.groupBy(group).agg(F.sum(F.coalesce(F.col(size), F.lit(0))).alias("__size"))
    total = groups.agg(F.sum("__size")).first()[0] or 0
    digest = F.xxhash64(group)
    power = F.length(F.bin(F.col("__size")))
    alone = F.col("__size") * (shards * fine) >= F.lit(max(total, 1))
    small = F.concat_ws(":", F.lit("bundle"), F.lpad(power.cast("string"), 2, "0"), F.pmod(digest, F.lit(bundles)).cast("string"))
    named = groups.withColumn("__unit", F.when(alone, F.concat(F.lit("group:"), F.hex(F.col(group).cast("binary")))).otherwise(small))
    units = named.groupBy("__unit").agg(F.sum("__size").alias("__size")).collect()  # bounded, see above
    plan = docs.sparkSession.createDataFrame(longest_first([(u[0], u[1]) for u in units], shards), "__unit string, shard int")
    lookup = named.join(F.broadcast(plan), "__unit").select(F.col(group).alias("__group"), "shard")
    return docs.join(lookup, docs[group].eqNullSafe(lookup["__group"])).drop("__group")


def number_slots(rows: DataFrame, shard: str, order: str, target: str = "slot") -> DataFrame:
    """Gapless numbers from 0 within each shard, in the order of a column; no shard is held by one task.

    The sorted rows are written with their place, so that counts and numbers see the same partitions.
    """
    ranged = rows.repartitionByRange(F.col(shard), F.col(order)).sortWithinPartitions(shard, order)
    at = ranged.withColumn("__at", F.monotonically_increasing_id())
    part, place = F.shiftright("__at", _ROW_BITS), F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    at = written(at.select(*rows.columns, part.alias("__part"), place.alias("__place")), "slots")
    # One row per sorted partition and shard in it: partitions plus shards at most.
    sizes = at.groupBy("__part", shard).agg(F.min("__place").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.withColumn("__before", F.coalesce(before, F.lit(0)))
    numbered = at.join(F.broadcast(sizes.drop("__n")), ["__part", shard])
    return numbered.select(*rows.columns, (F.col("__place") - F.col("__first") + F.col("__before")).cast("bigint").alias(target))


def shard_documents(docs: DataFrame, shards: int = 16, id_column="doc_id", text_column="text") -> DataFrame:
    """Documents with equal texts kept together: id, size, text_crc32, shard and slot.

    The size is the UTF-8 length of the text (null: none) plus 1. A null text and an empty one are equal.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    sized = docs.select(
        F.col(id_column).alias(id_column),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("__text"),
    )
    placed = shard_groups(written(sized, "sharding-sizes"), "__text", "size", shards)
    return number_slots(written(placed.drop("__text"), "sharding-placed"), "shard", id_column)
