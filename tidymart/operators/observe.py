"""Reports that come with a write: what each row adds to them is summed while the rows are written.

The numbers come from the last step of the write, so a stage is not read again for them, and they belong to the very rows
that were written: a task that is repeated counts once. What needs equal rows to meet (repeated keys, distinct rows) can't
be observed; it is known beforehand for tables that were grouped by their key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidymart.contracts import MISSING
from tidymart.operators.profile import text_columns
from tidymart.operators.quality import QualitySpec, metrics_of


def write_observed(df: DataFrame, path: str, sums: Mapping[str, Column]) -> tuple[DataFrame, dict[str, int | None]]:
    """Write the rows to `path` and return the table with the observed sums, which are null where there are no rows."""
    seen = Observation()
    df.observe(seen, *(column.alias(name) for name, column in sums.items())).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), dict(seen.get)


def key_sums(df: DataFrame, key: Sequence[str]) -> dict[str, Column]:
    """Rows, and for each key column the nulls and missing labels, as aggregates to be observed."""
    sums = {"rows": F.count(F.lit(1))}
    sums |= {f"nulls_{c}": F.count_if(F.col(c).isNull()) for c in key}
    return sums | {f"missing_{c}": F.count_if(F.col(c) == MISSING) for c in text_columns(df, key)}


def key_report(spark: SparkSession, seen: Mapping[str, int], key: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """The report of :func:`tidymart.operators.profile.qc_report` for a table that was grouped by its key: no key repeats."""
    counts = T.LongType()
    schema = T.StructType(
        [
            T.StructField("rows", counts),
            T.StructField("nulls_by_col", T.StructType([T.StructField(c, counts) for c in key])),
            T.StructField("sin_dato_by_col", T.StructType([T.StructField(c, counts) for c in texts])),
            T.StructField("duplicates_by_key", counts),
        ]
    )
    row = (seen["rows"], tuple(seen[f"nulls_{c}"] for c in key), tuple(seen[f"missing_{c}"] for c in texts), 0)
    return spark.createDataFrame([row], schema)


def observed_metrics(
    spark: SparkSession, seen: Mapping[str, int | None], targets: Mapping, spec: QualitySpec = QualitySpec()
) -> DataFrame:
    """The six metrics as one row, from the observed parts of a table whose rows are all distinct.

    ``seen`` holds the sums of :func:`tidymart.operators.quality.metric_parts`; a table with a key has no equal rows.
    """
    parts = {name: None if value is None else int(value) for name, value in seen.items()}
    parts["kinds"] = parts["rows"] or 0
    row = spark.createDataFrame([tuple(parts.values())], ", ".join(f"{name} bigint" for name in parts))
    metrics = metrics_of({name: F.col(name) for name in parts}, spec)
    return row.select(*(metrics[m].alias(m) for m in targets))
