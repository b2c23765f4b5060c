"""Scan and append of database tables, and Parquet tables of the mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidymart.contracts import DIMENSIONS, LOAD_BATCH_ROWS

FACT_TABLE = "fact_casos"


def scan_options(url: str, table: str, split: tuple[str, int, int, int] | None = None) -> dict:
    """JDBC read options; ``split`` = (numeric column, low, high, parts) reads in parallel."""
    options = {"url": url, "dbtable": table}
    if split:
        column, low, high, parts = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(parts),
        }
    return options


def append_options(url: str, table: str, batch_rows: int = LOAD_BATCH_ROWS) -> dict:
    return {"url": url, "dbtable": table, "batchsize": str(batch_rows)}


def scan_table(spark: SparkSession, url: str, table: str, split=None, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**scan_options(url, table, split), **options).load()


def append_table(df: DataFrame, url: str, table: str, batch_rows: int = LOAD_BATCH_ROWS, **options) -> None:
    """Batched inserts; a task that fails rolls its own partition back."""
    settings = append_options(url, table, batch_rows)
    df.write.format("jdbc").options(**settings, **options).mode("append").save()


def database_types(df: DataFrame) -> DataFrame:
    """Measures in the column types of the database: 32-bit integers and floats."""
    kinds = {"bigint": "int", "double": "float"}
    return df.select(
        *(
            F.col(f.name).cast(kinds[f.dataType.simpleString()]).alias(f.name)
            if f.dataType.simpleString() in kinds
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def write_bucketed(df: DataFrame, table: str, path: str, key: Sequence[str], buckets: int) -> DataFrame:
    """Write rows to a new path as a table in buckets of a key: equal keys are in the bucket of the same number.

    Tables with the same key columns, types and number of buckets join and group on the key, or on more columns, without
    moving rows. Rows are dealt as the buckets are, so each bucket is one file. Choose the number so that a bucket fits a
    task. A key that holds most rows makes its bucket large; tidy tables hold each key once, or once per class.
    """
    dealt = df.repartition(buckets, *key)
    dealt.write.format("parquet").bucketBy(buckets, *key).sortBy(*key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, table: str, path: str, schema: T.StructType, key: Sequence[str], buckets: int) -> DataFrame:
    """Make a table that another session wrote in buckets known to this one; no row is read."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{c}`" for c in key)
    place = path.replace("'", "\\'")
    spark.sql(
        f"create table `{table}` ({columns}) using parquet clustered by ({keys}) sorted by ({keys}) "
        f"into {buckets} buckets location '{place}'"
    )
    return spark.table(table)


def write_star(fact: DataFrame, dimensions: dict[str, DataFrame], folder: str, load: str) -> None:
    """One folder per load for each table: repeating a load replaces only what it wrote."""
    for table, dimension in dimensions.items():
        dimension.write.mode("overwrite").parquet(f"{folder}/{table}/load={load}")
    fact.write.mode("overwrite").parquet(f"{folder}/{FACT_TABLE}/load={load}")


def loaded_before(spark: SparkSession, folder: str, load: str) -> tuple[DataFrame | None, dict[str, DataFrame]]:
    """The facts and dimension members of all other loads; None and no dimension when there is none."""
    try:
        fact = spark.read.parquet(f"{folder}/{FACT_TABLE}").where(F.col("load") != load).drop("load")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None, {}
    members = {t: spark.read.parquet(f"{folder}/{t}").where(F.col("load") != load).drop("load").distinct() for t in DIMENSIONS}
    return fact, members


def read_star(spark: SparkSession, folder: str, load: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The facts of all loads, and the dimensions as of one load (they keep earlier members)."""
    fact = spark.read.parquet(f"{folder}/{FACT_TABLE}").drop("load")
    return fact, {t: spark.read.parquet(f"{folder}/{t}/load={load}") for t in DIMENSIONS}
