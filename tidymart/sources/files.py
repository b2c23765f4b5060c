"""CSV, JSON and Parquet at the edges of a job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidymart.contracts import NA_TOKENS, all_string
from tidymart.operators.schema import require_columns
from tidymart.session import written

# Doubled quotes inside quoted text, and no trimming of what is inside the cells.
_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def null_tokens(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Text cells that hold a not-available token become null."""
    return df.select(
        *(
            F.when(~F.col(f.name).isin(*tokens), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def read_csv(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, multiline: bool = False
) -> DataFrame:
    """CSV with a header, every column as text, not-available tokens as null; columns by their names.

    ``columns`` are wanted in this order, whatever the order in the files; one that is missing fails.
    All files must have the same header. A record with more or fewer cells than the header fails the job, so a
    quoted line break is an error and not two rows; ``multiline`` allows it, at the price of one
    task per file (a table of one column needs it whenever its texts can hold line breaks).
    """
    strict = {"mode": "FAILFAST", "enforceSchema": False, "columnPruning": False}
    rows = spark.read.options(**_CSV, **strict, multiLine=multiline).csv(path)
    if columns is not None:
        require_columns(rows, columns)
        rows = rows.select(*columns)
    return null_tokens(rows)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**_CSV).csv(path)


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One report row per line as JSON, null fields included."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def envelope_schema(columns: Sequence[str]) -> T.StructType:
    """Answer of a paged API: success flag, total and the records, every cell as text."""
    result = T.StructType(
        [
            T.StructField("records", T.ArrayType(all_string(columns))),
            T.StructField("total", T.LongType()),
        ]
    )
    return T.StructType([T.StructField("success", T.BooleanType()), T.StructField("result", result)])


def read_envelopes(
    spark: SparkSession, path: str, columns: Sequence[str], multiline: bool = False
) -> DataFrame:
    return spark.read.schema(envelope_schema(columns)).option("multiLine", multiline).json(path)


def explode_records(envelopes: DataFrame) -> DataFrame:
    """One row per record; an answer without success fails the read."""
    failed = F.raise_error(F.lit("the API returned an error")).cast(
        envelopes.schema["result"].dataType["records"].dataType
    )
    checked = F.when(F.coalesce("success", F.lit(False)), F.col("result.records")).otherwise(failed)
    return envelopes.select(F.inline(checked))


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """Append pages by column name; columns that a page lacks are null."""
    out = pages[0]
    for page in pages[1:]:
        out = out.unionByName(page, allowMissingColumns=True)
    return out


def land(df: DataFrame, path: str, columns: Sequence[str] | None = None, fmt: str = "parquet") -> bool:
    """Write the records with a fixed column list; nothing is written when there are none.

    The records are taken from their source once, into the shared folder, as what they come from may be slow or changing.
    """
    out = written(df.select(*(columns or df.columns)), "landing")
    if out.isEmpty():
        return False
    if fmt == "csv":
        write_csv(out, path)
    else:
        out.write.mode("overwrite").format(fmt).save(path)
    return True


def to_json_feed(df: DataFrame, columns: Sequence[str | Column] = ("*",)) -> DataFrame:
    """One JSON text per row in ``value``; null fields are kept, so a field is never absent."""
    return df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))


def publish(df: DataFrame, fmt: str, options: dict[str, str], path: str | None = None) -> None:
    """Send the JSON feed of a table to a batch sink such as Kafka or text files."""
    writer = to_json_feed(df).write.format(fmt).options(**options).mode("append")
    writer.save(path) if path else writer.save()
