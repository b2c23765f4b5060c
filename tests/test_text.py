import sys
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidymart.contracts import PLACE_MISSING_RE, ZONE_MISSING_RE
from tidymart.functions import text


def expected_fold(value):
    plain = value.strip().lower()
    return unicodedata.normalize("NFKD", plain).encode("ascii", "ignore").decode("ascii")


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = df.select("i", function(F.col("v")).alias("out")).collect()
    return [r.out for r in sorted(out, key=lambda r: r.i)]


def test_fold_equals_compatibility_decomposition_for_every_code_point(spark):
    points = [
        f"a{chr(p)}b"
        for p in range(32, sys.maxunicode + 1)
        if unicodedata.decomposition(chr(p)) and not 0xD800 <= p <= 0xDFFF
        and not 0xAC00 <= p <= 0xD7A3
    ]
    wrong = [
        (p, f) for p, f in zip(points, apply(spark, text.fold, points)) if f != expected_fold(p)
    ]
    assert wrong == []


def test_fold_strips_all_white_space_and_only_at_the_ends(spark):
    blanks = [chr(p) for p in range(0x3001) if chr(p).isspace()]
    values = [f"{b}A{b}b{b}" for b in blanks] + ["", "   ", "\t\n", "– x", "é", "…"]
    assert apply(spark, text.fold, values) == [expected_fold(v) for v in values]


def test_line_ends_at_the_end_alone_are_stripped(spark):
    ends = ["\n", "\r\n", "\r", "\u2028", "\x85", "\n\n"]
    assert apply(spark, text.fold, [f"Femenino{e}" for e in ends]) == ["femenino"] * len(ends)
    assert apply(spark, text.standardize_sex, [f"Femenino{e}" for e in ends]) == ["mujer"] * len(ends)
    assert apply(spark, text.unify_missing, [f"sin dato{e}" for e in ends]) == ["sin dato"] * len(ends)
    assert apply(spark, text.yes_flag, [f"Si{e}" for e in ends]) == [1] * len(ends)
    assert apply(spark, lambda c: text.regex_missing(c, ZONE_MISSING_RE), [f"Suba{e}" for e in ends]) == ["suba"] * len(ends)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00")), max_size=300))
def test_fold_of_any_text(spark, values):
    out = apply(spark, text.fold, values)
    # Case tables of Java and Python differ for a few new letters, which fold to nothing anyway.
    assert out == [expected_fold(v) for v in values]


def test_null_handling_differs_per_function(spark):
    """A null sex becomes the "other" label, a null class, stage, level or zone the missing one."""
    assert apply(spark, text.fold, [None]) == [None]
    assert apply(spark, text.standardize_sex, [None, "sin dato", "M", "H", "Male", "x"]) == [
        "otro", "sin dato", "mujer", "hombre", "hombre", "otro",
    ]
    assert apply(spark, text.classify, [None, "Ideación suicida", "INTENTO", "amenaza", "sin dato"]) == [
        "sin dato", "ideacion", "intento", "otra", "sin dato",
    ]
    assert apply(spark, text.standardize_stage, [None]) == ["sin dato"]
    assert apply(spark, text.standardize_level, [None]) == ["sin dato"]
    assert apply(spark, text.unify_missing, [None, "", "nan", "S/D", "N.A.", "n.a", "NA", "Suba", "n/a"]) == [
        "sin dato", "sin dato", "sin dato", "sin dato", "sin dato", "sin dato", "sin dato", "suba", "n/a",
    ]


def test_stage_labels(spark):
    """The en dash folds away and leaves two blanks; a hyphen stays, and that label passes through."""
    assert apply(spark, text.standardize_stage, ["12 – 17 Adolescencia", "12 - 17 Adolescencia", ">60 Vejez", "Juventud"]) == [
        "adolescencia", "12 - 17 adolescencia", "vejez", "juventud",
    ]


def test_level_replacements_in_order(spark):
    assert apply(
        spark,
        text.standardize_level,
        ["7. Técnico pos secundaria completo", "tecnico post secundaria incompleto", "5. secundaria"],
    ) == ["7. tecnico post-secundaria completa", "tecnico post-secundaria incompleta", "5. secundaria"]


def test_yes_flag(spark):
    values = ["Sí", "SI", "si.", "sí.", "TRUE", "1", "x", "X ", "1.0", "no", "", None]
    assert apply(spark, text.yes_flag, values) == [1, 1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0]


def test_regex_missing(spark):
    values = ["N/A", "na", "S/D", "sd", "n.a.", "Upz sin asignar", "nan", "", None, " Suba ", "nada"]
    zone = apply(spark, lambda c: text.regex_missing(c, ZONE_MISSING_RE), values)
    assert zone == ["sin dato"] * 6 + ["nan", "", "sin dato", "suba", "nada"]
    place = apply(spark, lambda c: text.regex_missing(c, PLACE_MISSING_RE), values)
    assert place[5] == "upz sin asignar"
