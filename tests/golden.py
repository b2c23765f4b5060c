"""Small inputs with known results, made for this repository."""


from tidymart.contracts import CONSUMPTION, NOTIFICATIONS
from tidymart.operators.merge import merge_sources
from tidymart.operators.quality import QualitySpec
from tidymart.operators.tidy import tidy
from tidymart.sources.files import read_csv

RAW_A = """ANO,NOMBREUPZ,SEXO,CURSO_DE_VIDA,NIVELEDUCATIVO,CASOS,SITIOHABITUALCONSUMO_VIVIENDA,SITIOHABITUALCONSUMO_PARQUE
2020,Engativá,M,12 – 17 Adolescencia,5. Secundaria Incompleto,3,Sí,No
2020," engativa ",Femenino,Adolescencia,5. secundaria incompleta,2,no,X
2020,Suba,H,18 – 28 Juventud,7. Tecnico Pos Secundaria Completo,4,si.,1
2021,UPZ SIN ASIGNAR,H,Juventud,5. Secundaria Completa,1,No,No
2021,Suba,,Vejez,1. Preescolar,abc,TRUE,No
x2021,Suba,H,Juventud,5. Secundaria Completa,2,No,No
2021,Suba,H,,5. Secundaria Completa,2,No,No
2021,Bosa,Hombre,0 - 5 Primera Infancia,1. Preescolar,1,No,No
"""

RAW_B = """ano_notificacion,nombre_upz,sexo,ciclovital,niveleducativo,clasificaciondelaconducta,maltrato_sexual,conflicto_pareja
2020,ENGATIVA,Mujer,Adolescencia,5. Secundaria Incompleta,Ideación Suicida,1,0
2020,Engativá,female,adolescencia,5. secundaria incompleto,ideacion,0,2
2020,Engativá,m,Adolescencia,5. secundaria incompleta,Intento suicida,,1
2020,Suba,Masculino,Juventud,7. tecnico post secundaria completa,Amenaza suicida,0,0
2021,Suba,Otro,Vejez,1. Preescolar,,x,1
2021,N.A.,H,Vejez,1. Preescolar,Intento,1,1
2022,Usme,H,Adultez,9. Universitario Completo,intento,0,1
"""

SECONDARY, TECHNICAL = "5. secundaria incompleta", "7. tecnico post-secundaria completa"

TIDY_A = [
    (2020, "engativa", "mujer", "adolescencia", SECONDARY, 5, 3, 2),
    (2020, "suba", "hombre", "juventud", TECHNICAL, 4, 4, 4),
    (2021, "bosa", "hombre", "0 - 5 primera infancia", "1. preescolar", 1, 0, 0),
    (2021, "suba", "otro", "vejez", "1. preescolar", 0, 0, 0),
]

TIDY_B = [
    (2020, "engativa", "mujer", "adolescencia", SECONDARY, "ideacion", 2, 1, 1),
    (2020, "engativa", "mujer", "adolescencia", SECONDARY, "intento", 1, 0, 1),
    (2020, "suba", "hombre", "juventud", TECHNICAL, "otra", 1, 0, 0),
    (2021, "suba", "otro", "vejez", "1. preescolar", "sin dato", 1, 0, 1),
    (2022, "usme", "hombre", "adultez", "9. universitario completa", "intento", 1, 0, 1),
]

# upz, clasificacion, casos_spa, casos_sui, then the four ratios
MERGED = [
    ("engativa", "ideacion", 5, 2, 0.5, 0.5, 0.6, 0.4),
    ("engativa", "intento", 5, 1, 0.0, 1.0, 0.6, 0.4),
    ("suba", "otra", 4, 1, 0.0, 0.0, 1.0, 1.0),
    ("suba", "sin dato", 0, 1, 0.0, 1.0, None, None),
]

RULES = QualitySpec(
    rules=(
        ("casos_spa", ("SITIOHABITUALCONSUMO_VIVIENDA", "SITIOHABITUALCONSUMO_PARQUE")),
        ("casos_sui", ("maltrato_sexual", "conflicto_pareja")),
    )
)


def _raw(spark, folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8-sig")
    return read_csv(spark, str(path))


def raw_a(spark, folder):
    return _raw(spark, folder, "a.csv", RAW_A)


def raw_b(spark, folder):
    return _raw(spark, folder, "b.csv", RAW_B)


_PATHS = {}


def _once(spark, folder, name, make):
    """The tidy tables are computed once per test run and read from files after that."""
    if name not in _PATHS:
        path = str(folder / f"{name}.parquet")
        make().write.parquet(path)
        _PATHS[name] = path
    return spark.read.parquet(_PATHS[name])


def tidy_a(spark, folder):
    return _once(spark, folder, "tidy_a", lambda: tidy(raw_a(spark, folder), CONSUMPTION))


def tidy_b(spark, folder):
    return _once(
        spark, folder, "tidy_b", lambda: tidy(raw_b(spark, folder), NOTIFICATIONS, split_class=True)
    )


def merged(spark, folder, **options):
    """The golden merge; the plain one is computed once, too."""
    a, b = tidy_a(spark, folder), tidy_b(spark, folder)
    if options:
        return merge_sources(a, b, **options)
    return _once(spark, folder, "merged", lambda: merge_sources(a, b))
