"""Text standardisation as Catalyst expressions (no Python runs per row).

``label_*`` work on text that is folded already, so a job can fold a column once and label it in
the next projection; ``standardize_*`` and friends do both.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Mapping
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidymart.contracts import (
    BAD_TOKENS,
    CLASS_MAP,
    CLASS_OTHER,
    LEVEL_REPLACEMENTS,
    MISSING,
    SEX_MAP,
    SEX_OTHER,
    SEX_VALUES,
    STAGE_MAP,
    YES_TOKENS,
)


@cache
def whitespace() -> str:
    """Every character Unicode counts as white space; Spark's plain trim knows only the blank."""
    return "".join(c for c in map(chr, range(0x3001)) if c.isspace())


@cache
def _ascii_forms() -> tuple[str, str, dict[str, str]]:
    """ASCII part of the compatibility decomposition, per code point.

    Decomposing a string and dropping what is not ASCII is a per-character mapping: reordering
    only moves combining marks, which are dropped. Returns the one-to-one part as two aligned
    strings, and the one-to-many part (ligatures, fractions ...) as a dictionary.
    """
    single, many = {}, {}
    for point in range(128, sys.maxunicode + 1):
        char = chr(point)
        if not unicodedata.decomposition(char):
            continue
        plain = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode("ascii")
        if len(plain) == 1:
            single[char] = plain
        elif plain:
            many[char] = plain
    return "".join(single), "".join(single.values()), many


def strip(c: Column) -> Column:
    """Remove white space at both ends; text that starts and ends visibly is left alone at once."""
    return F.when(c.rlike(r"(?s)^[!-~](.*[!-~])?\z"), c).otherwise(F.btrim(c, F.lit(whitespace())))


def lowered(c: Column) -> Column:
    return F.lower(strip(c))


def _is_ascii(c: Column) -> Column:
    """As many bytes as characters."""
    return F.octet_length(c) == F.char_length(c)


def _char_class(chars: Iterable[str]) -> str:
    """Regex class of the characters, neighbours joined to ranges."""
    points = sorted(map(ord, chars))
    starts = [p for p in points if p - 1 not in points]
    ends = [p for p in points if p + 1 not in points]
    return "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends)) + "]"


def _expand_ligatures(c: Column) -> Column:
    many = _ascii_forms()[2]
    # A constant: the optimizer turns it into one map literal.
    pairs = "\x02".join(f"{char}\x01{plain}" for char, plain in many.items())
    table = F.str_to_map(F.lit(pairs), F.lit("\x02"), F.lit("\x01"))
    spelled = F.array_join(
        F.transform(F.split(c, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), ""
    )
    rest = F.regexp_replace(c, r"[\x00-\x7F]+", "")
    return F.when(rest.rlike(_char_class(many)), spelled).otherwise(c)


def map_letters(plain: Column) -> Column:
    """Every letter that stands for one ASCII character becomes that character."""
    accents, letters, _ = _ascii_forms()
    return F.when(_is_ascii(plain), plain).otherwise(F.translate(plain, accents, letters))


def drop_other(mapped: Column) -> Column:
    """Spell out ligatures and the like, then drop what has no ASCII form."""
    rest = F.regexp_replace(_expand_ligatures(mapped), r"[^\x00-\x7F]+", "")
    return F.when(_is_ascii(mapped), mapped).otherwise(rest)


def unaccent(plain: Column) -> Column:
    return drop_other(map_letters(plain))


def fold(c: Column) -> Column:
    """Strip, lower-case, remove accents and drop what has no ASCII form; null stays null."""
    return unaccent(lowered(c))


def label_missing(folded: Column, bad: Iterable[str] = BAD_TOKENS) -> Column:
    """Null and every spelling of "missing" become the one missing label."""
    return F.coalesce(F.when(~folded.isin(*bad), folded), F.lit(MISSING))


def lookup(c: Column, table: Mapping[str, str]) -> Column:
    """Value of a small dictionary, null where the key is absent."""
    if not table:
        return F.lit(None).cast("string")
    cases = None
    targets: dict[str, list[str]] = {}
    for key, value in table.items():
        targets.setdefault(value, []).append(key)
    for value, keys in targets.items():
        hit = c.isin(*keys)
        cases = F.when(hit, value) if cases is None else cases.when(hit, value)
    return cases


def label_sex(folded: Column, table: Mapping[str, str] = SEX_MAP) -> Column:
    """Known spellings to their label, everything else (null too) to the "other" label."""
    kept = F.when(folded.isin(*SEX_VALUES), folded)
    return F.coalesce(lookup(folded, table), kept, F.lit(SEX_OTHER))


def label_stage(folded: Column, table: Mapping[str, str] = STAGE_MAP) -> Column:
    """Age-range labels to stage names; unknown labels pass through, null becomes missing."""
    return F.coalesce(lookup(folded, table), folded, F.lit(MISSING))


def label_level(folded: Column, replacements=LEVEL_REPLACEMENTS) -> Column:
    for old, new in replacements:
        folded = F.replace(folded, F.lit(old), F.lit(new))
    return F.coalesce(folded, F.lit(MISSING))


def label_class(folded: Column, table: Mapping[str, str] = CLASS_MAP) -> Column:
    """Known classes, null as missing, anything else as the "other" class."""
    missing = folded.isNull() | (folded == MISSING)
    return F.when(missing, MISSING).otherwise(
        F.coalesce(lookup(folded, table), F.lit(CLASS_OTHER))
    )


def unify_missing(c: Column, bad: Iterable[str] = BAD_TOKENS) -> Column:
    return label_missing(fold(c), bad)


def standardize_sex(c: Column, table: Mapping[str, str] = SEX_MAP) -> Column:
    return label_sex(fold(c), table)


def standardize_stage(c: Column, table: Mapping[str, str] = STAGE_MAP) -> Column:
    return label_stage(fold(c), table)


def standardize_level(c: Column, replacements=LEVEL_REPLACEMENTS) -> Column:
    return label_level(fold(c), replacements)


def classify(c: Column, table: Mapping[str, str] = CLASS_MAP) -> Column:
    return label_class(fold(c), table)


def label_yes(folded: Column) -> Column:
    return F.coalesce(folded.isin(*YES_TOKENS), F.lit(False)).cast("int")


def yes_flag(c: Column) -> Column:
    return label_yes(fold(c))


def regex_missing(c: Column, pattern: str) -> Column:
    """Stripped lower-case text with null and everything that matches as missing."""
    text = lowered(c)
    return F.when(text.isNull() | text.rlike(pattern), MISSING).otherwise(text)


def bad_text(c: Column, bad: Iterable[str] = BAD_TOKENS) -> Column:
    """True where stripped lower-case text is a missing token; null is not text."""
    return F.coalesce(lowered(c).isin(*bad), F.lit(False))
