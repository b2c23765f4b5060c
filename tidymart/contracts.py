"""Fixed values, table schemas and the declarative description of a raw source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Fixed values -------------------------------------------------------------

MISSING = "sin dato"

# Folded spellings that mean "missing" in a key column.
BAD_TOKENS = ("", "nan", "sin dato", "upz sin asignar", "s/d", "n.a.", "n.a", "na")

# Text that a CSV read turns into null.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

SEX_MAP = {
    "h": "hombre",
    "m": "mujer",
    "masculino": "hombre",
    "femenino": "mujer",
    "male": "hombre",
    "female": "mujer",
}
SEX_VALUES = ("hombre", "mujer", "sin dato")
SEX_OTHER = "otro"

# The two blanks are what is left when folding removes an en dash.
STAGE_MAP = {
    "0  5 primera infancia": "primera infancia",
    "6  11 infancia": "infancia",
    "12  17 adolescencia": "adolescencia",
    "18  28 juventud": "juventud",
    "29  59 adultez": "adultez",
    ">60 vejez": "vejez",
}

# Applied in this order.
LEVEL_REPLACEMENTS = (
    ("tecnico pos secundaria", "tecnico post-secundaria"),
    ("tecnico post secundaria", "tecnico post-secundaria"),
    (" completo", " completa"),
    (" incompleto", " incompleta"),
)

CLASS_MAP = {
    "ideacion": "ideacion",
    "ideacion suicida": "ideacion",
    "intento": "intento",
    "intento suicida": "intento",
}
CLASS_OTHER = "otra"
CLASS_CANDIDATES = ("clasificaciondelaconducta", "clasificacion_conducta", "clasificacion")

YES_TOKENS = ("si", "si.", "true", "1", "x")

ZONE_MISSING_RE = r"^(sin dato|upz sin asignar|n\.?a\.?|n/?a|s/?d|na)$"
PLACE_MISSING_RE = r"^(sin dato|n\.?a\.?|n/?a|s/?d|na)$"

KEY = ("anio", "upz", "sexo", "ciclo_vida", "nivel_educativo")
TEXT_KEY = KEY[1:]
CLASS_COLUMN = "clasificacion"
CASES = "casos"
CASES_A = "casos_spa"
CASES_B = "casos_sui"

SITE_PREFIX = "SITIOHABITUALCONSUMO_"
SITE_NAMES = ("vivienda", "parque", "est_educativo", "bares_tabernas", "via_publica", "casa_amigos")

RISK_COLUMNS = (
    "enfermedades_dolorosas",
    "maltrato_sexual",
    "muerte_familiar",
    "conflicto_pareja",
    "problemas_economicos",
    "esc_educ",
    "problemas_juridicos",
    "problemas_laborales",
    "suicidio_amigo",
)

# Highest education number that is valid for a life stage; None = always valid.
STAGE_LEVEL_LIMITS = {
    "infancia": 5,
    "adolescencia": 7,
    "juventud": None,
    "adultez": None,
    "vejez": None,
}
YEAR_RANGE = (2015, 2025)

# metric -> (target, must the value be equal to the target?)
QUALITY_TARGETS = {
    "completitud": (95, False),
    "exactitud": (99, False),
    "consistencia": (95, False),
    "unicidad": (100, True),
    "validez": (98, False),
    "actualidad": (100, True),
}
# metric -> (text when the value is 100, text otherwise)
QUALITY_NOTES = {
    "completitud": ("No existen valores faltantes", "Algunas columnas con valores nulos"),
    "exactitud": ("Todos los valores correctos", "Algunos valores ligeramente fuera de rango"),
    "consistencia": ("Perfectamente consistentes", "Leves diferencias en la suma de porcentajes"),
    "unicidad": ("No hay duplicados", "Existen filas duplicadas"),
    "validez": (
        "Datos válidos en todos los casos",
        "Algunos infantes/adolescentes con niveles educativos altos",
    ),
    "actualidad": ("Todos los registros dentro del rango esperado", "Algunos años fuera del rango"),
}

# Lines of a column profile, and what they say about a value.
PROFILE_TEXTS = {
    "type": "Tipo de dato",
    "type_ok": "Correcto",
    "type_text": "Verificar formato de texto",
    "nulls": "Valores nulos",
    "nulls_none": "No presenta datos faltantes",
    "nulls_some": "Presenta %d nulos",
    "unique": "Valores únicos",
    "unique_all": "Cumple unicidad total",
    "unique_some": "%d valores únicos",
    "dups": "Duplicados",
    "dups_none": "Sin duplicados",
    "dups_some": "%d duplicados encontrados",
    "examples": "Ejemplos de problemas",
    "examples_none": "Ninguno",
    "reliable": "Columna confiable",
    "review": "Revisar valores",
}

STREAM_STAGES = ("adolescencia", "juventud")

PAGE_SIZE = 32000
LOAD_BATCH_ROWS = 1000


# Sources ------------------------------------------------------------------


@dataclass(frozen=True)
class SourceSpec:
    """How one raw source maps onto the shared key and its measures.

    ``rename`` maps raw columns to the five key columns. ``case_column`` is the raw
    count column; None means one case per row. Flags come either from every column
    with ``flag_prefix`` (yes/no text, weighted by the cases) or from the listed
    ``flag_columns`` that exist (positive numbers, one per row).
    """

    rename: Mapping[str, str]
    required: tuple[str, ...]
    case_column: str | None = None
    flag_prefix: str | None = None
    flag_columns: tuple[str, ...] = ()
    class_candidates: tuple[str, ...] = CLASS_CANDIDATES
    bad_tokens: tuple[str, ...] = BAD_TOKENS
    sex_map: Mapping[str, str] = field(default_factory=lambda: dict(SEX_MAP))
    stage_map: Mapping[str, str] = field(default_factory=lambda: dict(STAGE_MAP))
    level_replacements: tuple[tuple[str, str], ...] = LEVEL_REPLACEMENTS
    class_map: Mapping[str, str] = field(default_factory=lambda: dict(CLASS_MAP))


CONSUMPTION = SourceSpec(
    rename={
        "ANO": "anio",
        "NOMBREUPZ": "upz",
        "SEXO": "sexo",
        "CURSO_DE_VIDA": "ciclo_vida",
        "NIVELEDUCATIVO": "nivel_educativo",
    },
    required=("ANO", "NOMBREUPZ", "SEXO", "CURSO_DE_VIDA", "NIVELEDUCATIVO", "CASOS"),
    case_column="CASOS",
    flag_prefix=SITE_PREFIX,
)

NOTIFICATIONS = SourceSpec(
    rename={
        "ano_notificacion": "anio",
        "nombre_upz": "upz",
        "sexo": "sexo",
        "ciclovital": "ciclo_vida",
        "niveleducativo": "nivel_educativo",
    },
    required=("ano_notificacion", "nombre_upz", "sexo", "ciclovital", "niveleducativo"),
    flag_columns=RISK_COLUMNS,
)


# Table schemas --------------------------------------------------------------


def _struct(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in columns])


def all_string(columns) -> T.StructType:
    return _struct(*((c, T.StringType(), True) for c in columns))


DIMENSIONS = {
    "dim_tiempo": ("id_tiempo", ("anio",)),
    "dim_ubicacion": ("id_ubicacion", ("upz",)),
    "dim_perfil_demografico": ("id_perfil", ("sexo", "ciclo_vida", "nivel_educativo")),
    "dim_clasificacion": ("id_clasificacion", ("clasificacion",)),
}


def _key_type(column: str) -> T.DataType:
    return T.IntegerType() if column == "anio" else T.StringType()


DIMENSION_SCHEMAS = {
    table: _struct(
        (key, T.IntegerType(), False),
        *((c, _key_type(c), table == "dim_perfil_demografico") for c in natural),
    )
    for table, (key, natural) in DIMENSIONS.items()
}

SITE_MEASURES = tuple(f"sitio_{s}" for s in SITE_NAMES)
SITE_RATIOS = tuple(f"pct_sitio_{s}" for s in SITE_NAMES)
RISK_RATIOS = tuple(f"pct_{r}" for r in RISK_COLUMNS)
FACT_COUNTS = (CASES_A, CASES_B)
FACT_MEASURES = FACT_COUNTS + SITE_MEASURES + SITE_RATIOS + RISK_COLUMNS + RISK_RATIOS
FACT_KEYS = tuple(key for key, _ in DIMENSIONS.values())


def measure_type(column: str) -> T.DataType:
    return T.DoubleType() if column.startswith("pct_") else T.LongType()


FACT_SCHEMA = _struct(
    *((k, T.IntegerType(), False) for k in FACT_KEYS),
    *((m, measure_type(m), True) for m in FACT_MEASURES),
)

# The wide table that the stream fills: ids, natural keys and measures side by side.
FEED_SCHEMA = _struct(
    ("id_fact", T.LongType(), True),
    ("id_tiempo", T.IntegerType(), True),
    ("anio", T.IntegerType(), True),
    ("id_ubicacion", T.IntegerType(), True),
    ("upz", T.StringType(), True),
    ("id_perfil", T.IntegerType(), True),
    ("sexo", T.StringType(), True),
    ("ciclo_vida", T.StringType(), True),
    ("nivel_educativo", T.StringType(), True),
    ("id_clasificacion", T.IntegerType(), True),
    ("clasificacion", T.StringType(), True),
    *((m, measure_type(m), True) for m in FACT_MEASURES),
)
