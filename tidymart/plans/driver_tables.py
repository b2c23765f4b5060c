"""The two raw sources over the test tables, with the parameters that fit them.

The tables hold clean values, so the views add what the operators exist for: accents, missing
tokens, nulls, text in number columns and mixed spellings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidymart.contracts import SourceSpec
from tidymart.operators.quality import QualitySpec

SITE_PREFIX_HERE = "SITIO_"
RISKS_HERE = ("maltrato_sexual", "conflicto_pareja")

SPEC_A = SourceSpec(
    rename={
        "ANO": "anio",
        "NOMBREUPZ": "upz",
        "SEXO": "sexo",
        "CURSO_DE_VIDA": "ciclo_vida",
        "NIVELEDUCATIVO": "nivel_educativo",
    },
    required=("ANO", "NOMBREUPZ", "SEXO", "CURSO_DE_VIDA", "NIVELEDUCATIVO", "CASOS"),
    case_column="CASOS",
    flag_prefix=SITE_PREFIX_HERE,
    class_candidates=("CLASE",),
)

SPEC_B = SourceSpec(
    rename={
        "ano_notificacion": "anio",
        "nombre_upz": "upz",
        "sexo": "sexo",
        "ciclovital": "ciclo_vida",
        "niveleducativo": "nivel_educativo",
    },
    required=("ano_notificacion", "nombre_upz", "sexo", "ciclovital", "niveleducativo"),
    flag_columns=RISKS_HERE,
)

QUALITY_HERE = QualitySpec(
    rules=(("casos_spa", ("SITIO_VIVIENDA", "SITIO_PARQUE")), ("casos_sui", RISKS_HERE)),
    level_separator="-",
    stage_limits={"household": 3, "machinery": 4, "automobile": None, "building": None, "furniture": None},
    years=(1996, 2000),
)

#: The zones of source A as columns of a pivot, and the numbers of the line items.
PIVOT_ZONES = ("UPZ SIN ASIGNAR", "UPZ SIN ASIGNAR\t", *(f"Nación_{i}" for i in range(25)))
NUMERIC_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
)

STAGES_HERE = ("household", "machinery")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _located_orders(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, folder, "nation")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", *columns)
    customer = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))


def raw_a(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order."""
    rows = _located_orders(
        spark, folder, "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    key, customer, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    zone = F.replace("n_name", F.lit("NATION"), F.lit("Nación"))
    return rows.select(
        F.year("o_orderdate").cast("string").alias("ANO"),
        F.when(key % 22 == 0, "UPZ SIN ASIGNAR\t").when(key % 11 == 0, "UPZ SIN ASIGNAR").when(key % 13 != 0, zone).alias("NOMBREUPZ"),
        F.concat(F.lit("Región "), F.col("n_regionkey").cast("string")).alias("LOCALIDAD"),
        F.when((status == "F") & (key % 3 == 0), "Femenino\r\n").when(status == "F", "Femenino").when(status == "O", "H").otherwise("P").alias("SEXO"),
        F.col("c_mktsegment").alias("CURSO_DE_VIDA"),
        F.col("o_orderpriority").alias("NIVELEDUCATIVO"),
        F.when(key % 17 == 0, "abc")
        .when(key % 19 == 0, "1234567890e1")
        .when(key % 23 == 0, "1e400")
        .when(key % 29 == 0, F.concat(F.lit(" "), F.repeat(F.lit("0"), 320), F.lit("2.5e0\n")))
        .otherwise((key % 4).cast("string"))
        .alias("CASOS"),
        F.when((F.col("o_totalprice") > 100000) & (key % 3 == 0), "Sí\n").when(F.col("o_totalprice") > 100000, "Sí").otherwise("No").alias("SITIO_VIVIENDA"),
        F.when(customer % 3 == 0, "X").otherwise("no").alias("SITIO_PARQUE"),
    )


def raw_a_with_class(spark: SparkSession, folder: str) -> DataFrame:
    """Source A as an outside table that has a class too."""
    number = F.col("CASOS")
    label = F.when(number == "1", "Intento suicida").when(number == "2", "Ideación").otherwise("N")
    return raw_a(spark, folder).withColumn("CLASE", label)


def raw_b(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_returnflag", "l_discount", "l_tax"
    )
    orders = _located_orders(spark, folder, "o_orderstatus", "o_orderpriority")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    status, flag = F.col("o_orderstatus"), F.col("l_returnflag")
    return rows.select(
        F.year("l_shipdate").cast("string").alias("ano_notificacion"),
        F.concat(F.replace("n_name", F.lit("NATION"), F.lit("NACION")), F.when(F.col("l_orderkey") % 5 == 0, "\n").otherwise("")).alias("nombre_upz"),
        F.when(status == "F", "m").when(status == "O", "masculino").otherwise("P").alias("sexo"),
        F.col("c_mktsegment").alias("ciclovital"),
        F.col("o_orderpriority").alias("niveleducativo"),
        F.when(flag == "R", "Intento suicida").when(flag == "A", "Ideación").otherwise(flag).alias("clasificacion"),
        F.col("l_discount").cast("string").alias("maltrato_sexual"),
        F.col("l_tax").cast("string").alias("conflicto_pareja"),
    )
