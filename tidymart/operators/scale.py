"""Dense numbering that does not need all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidymart.session import written

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def number_rows(df: DataFrame, order: Sequence[Column], target: str, start: int = 0) -> DataFrame:
    """Dense numbers ``start + 1, start + 2 ...`` in the given order.

    The sorted rows are written together with the number of their partition and their place in
    it, so that counting the partitions and numbering the rows see the same partitions even if
    executors are lost in between.
    """
    at = F.monotonically_increasing_id()
    part, place = F.shiftright("__at", _ROW_BITS), F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    ranged = written(
        df.orderBy(*order).withColumn("__at", at).select(*df.columns, part.alias("__part"), place.alias("__place")),
        "numbered",
    )
    # One row per sorted partition: bounded by the number of shuffle partitions.
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("n")).orderBy("__part").collect()
    offsets, before = [], start + 1
    for row in sizes:
        offsets.append((row["__part"], before))
        before += row["n"]
    if len(offsets) <= 1:
        return ranged.select(*df.columns, (F.col("__place") + start + 1).alias(target))
    table = df.sparkSession.createDataFrame(offsets, "__part bigint, __before bigint")
    numbered = ranged.join(F.broadcast(table), "__part")
    return numbered.select(*df.columns, (F.col("__place") + F.col("__before")).alias(target))
