"""Raw records to a tidy table on the shared key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidymart.contracts import (
    BAD_TOKENS,
    CASES,
    CLASS_COLUMN,
    KEY,
    MISSING,
    TEXT_KEY,
    SourceSpec,
)
from tidymart.functions import numeric, text
from tidymart.operators.schema import (
    columns_with_prefix,
    present_columns,
    require_columns,
)


def complete_key(key: Sequence[str] = KEY, bad: Iterable[str] = BAD_TOKENS) -> Column:
    """No key column is null and no (folded) text key column holds a missing token."""
    whole = F.lit(True)
    for c in key:
        whole = whole & F.col(c).isNotNull()
        if c in (*TEXT_KEY, CLASS_COLUMN):
            whole = whole & ~F.lower(F.trim(c)).isin(*bad)
    return whole


def strict_key_filter(
    df: DataFrame, key: Sequence[str] = KEY, bad: Iterable[str] = BAD_TOKENS
) -> DataFrame:
    """Drop rows with a null key column or a missing token in a text key column."""
    return df.where(complete_key(key, bad))


def pinned(df: DataFrame, columns: dict[str, Column], carried: Sequence[str | Column] = ()) -> DataFrame:
    """Columns that are computed once per row, and filters on them stay above.

    A projection would let the optimizer move a filter below it and fold every text once for each use in the
    filter; it does not move one below a generator.
    """
    one = F.array(F.struct(*(c.alias(n) for n, c in columns.items())))
    inlined = df.select(*carried, F.inline(one))
    names = [c for c in inlined.columns if c not in columns]
    return inlined.select(*columns, *names)


def drop_missing_zone(df: DataFrame, zone: str = "upz") -> DataFrame:
    return df.where(F.col(zone) != MISSING)


def class_column(df: DataFrame, spec: SourceSpec) -> str | None:
    """The first of the possible class columns that exists."""
    return next(iter(present_columns(df, spec.class_candidates)), None)


def class_label(df: DataFrame, spec: SourceSpec) -> Column:
    """Standardised class, the missing label when there is no class column."""
    found = class_column(df, spec)
    return F.lit(MISSING) if found is None else text.classify(F.col(found), spec.class_map)


def key_columns(spec: SourceSpec, folded: bool = False) -> dict[str, Column]:
    """The five key columns; ``folded`` says that the raw text columns are folded already."""
    raw = {new: F.col(old) for old, new in spec.rename.items()}
    fold = {c: raw[c] if folded else text.fold(raw[c]) for c in TEXT_KEY}
    return {
        "anio": numeric.to_year(raw["anio"]),
        "upz": text.label_missing(fold["upz"], spec.bad_tokens),
        "sexo": text.label_sex(fold["sexo"], spec.sex_map),
        "ciclo_vida": text.label_stage(fold["ciclo_vida"], spec.stage_map),
        "nivel_educativo": text.label_level(fold["nivel_educativo"], spec.level_replacements),
    }


def fold_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns folded in projections of their own, so that each step runs once per value."""
    for step in (text.lowered, text.map_letters, text.drop_other):
        df = df.withColumns({c: step(F.col(c)) for c in columns})
    return df


def label_keys(
    df: DataFrame,
    spec: SourceSpec,
    carried: Sequence[str] = (),
    split_class: bool = False,
    pin: bool = False,
) -> DataFrame:
    """Raw key columns to the shared key, next to the ``carried`` columns (``pin``: see :func:`pinned`).

    Text is stripped, folded and labelled in projections of their own, so that each step runs
    once per value although the next one uses its result several times.
    """
    label = class_column(df, spec) if split_class else None
    texts = [raw for raw, new in spec.rename.items() if new in TEXT_KEY] + ([label] if label else [])
    folded = fold_columns(df, texts)
    columns = key_columns(spec, folded=True)
    if split_class:
        columns[CLASS_COLUMN] = text.label_class(F.col(label), spec.class_map) if label else F.lit(MISSING)
    if pin:
        return pinned(folded, columns, carried)
    return folded.select(*(c.alias(n) for n, c in columns.items()), *carried)


def with_flags(df: DataFrame, spec: SourceSpec) -> tuple[DataFrame, dict[str, Column]]:
    """The rows with the texts of their flags folded, and the 0/1 flags from them."""
    if spec.flag_prefix:
        sites = columns_with_prefix(df, spec.flag_prefix, ignore_case=True)
        return fold_columns(df, sites), {c: text.label_yes(F.col(c)) for c in sites}
    return df, {c: numeric.positive_flag(F.col(c)) for c in present_columns(df, spec.flag_columns)}


def _cases(spec: SourceSpec) -> Column:
    return numeric.to_count(F.col(spec.case_column)) if spec.case_column else F.lit(1).cast("bigint")


def _raw_key(df: DataFrame, spec: SourceSpec, split_class: bool) -> list[str]:
    label = class_column(df, spec) if split_class else None
    return [*spec.rename, label] if label else [*spec.rename]


def tidy_rows(
    df: DataFrame, spec: SourceSpec, split_class: bool = False, drop_missing: bool = False
) -> DataFrame:
    """One clean row per raw record: key, cases, 0/1 flags and (optionally) the class."""
    require_columns(df, spec.required)
    flagged, flags = with_flags(df, spec)
    measures = {CASES: _cases(spec), **flags}
    rows = flagged.select(
        *_raw_key(df, spec, split_class), *(c.alias(f"__{n}") for n, c in measures.items())
    )
    labelled = label_keys(rows, spec, [F.col(f"__{n}").alias(n) for n in measures], split_class, pin=True)
    clean = strict_key_filter(labelled, bad=spec.bad_tokens)
    return drop_missing_zone(clean) if drop_missing else clean


def tidy(
    df: DataFrame, spec: SourceSpec, split_class: bool = False, drop_missing: bool = False
) -> DataFrame:
    """Sums of cases and of flags per key (flags weigh as many as the row has cases).

    The sums are taken per combination of *raw* key texts first, and only the combinations are
    folded, labelled and summed again: the text work follows the number of spellings, not the
    number of rows. Both aggregations sum inside the map tasks, so a key that holds a large share
    of the rows arrives as one row per task. Incomplete keys go last, together with their row
    count, because a filter on the key alone would be moved down and fold every raw row.
    """
    require_columns(df, spec.required)
    flagged, flags = with_flags(df, spec)
    names = [CASES, *flags]
    measured = flagged.select(
        *_raw_key(df, spec, split_class),
        _cases(spec).alias(f"__{CASES}"),
        *(c.alias(f"__{n}") for n, c in flags.items()),
    )
    cases = F.col(f"__{CASES}")
    spelled = measured.groupBy(*_raw_key(df, spec, split_class)).agg(
        F.sum(cases).alias(f"__{CASES}"),
        *(F.sum(F.col(f"__{n}") * cases).alias(f"__{n}") for n in flags),
        F.count("*").alias("__rows"),
    )
    carried = [f"__{n}" for n in names] + ["__rows"]
    labelled = label_keys(spelled, spec, carried, split_class)
    group = [*KEY, CLASS_COLUMN] if split_class else list(KEY)
    sums = labelled.groupBy(*group).agg(
        *(F.sum(f"__{n}").alias(n) for n in names), F.sum("__rows").alias("__rows")
    )
    whole = complete_key(KEY, spec.bad_tokens)
    if drop_missing:
        whole = whole & (F.col("upz") != MISSING)
    clean = sums.where(F.when(whole, F.col("__rows")) > 0).drop("__rows")
    # No year is null any more; saying so keeps a join from testing the year of every raw row.
    return clean.withColumn("anio", F.coalesce("anio", F.lit(0).cast("bigint")))
