"""The registered queries again, as ANSI SQL over the same tables."""

from __future__ import annotations

from tidymart.contracts import (
    BAD_TOKENS,
    CLASS_MAP,
    DIMENSIONS,
    FACT_KEYS,
    FACT_MEASURES,
    KEY,
    LEVEL_REPLACEMENTS,
    MISSING,
    NA_TOKENS,
    PLACE_MISSING_RE,
    PROFILE_TEXTS,
    QUALITY_NOTES,
    QUALITY_TARGETS,
    SEX_MAP,
    YES_TOKENS,
    ZONE_MISSING_RE,
)
from tidymart.functions.text import whitespace
from tidymart.plans.driver_tables import NUMERIC_COLUMNS, PIVOT_ZONES

KEYS = ", ".join(KEY)
SITES = ("SITIO_VIVIENDA", "SITIO_PARQUE")
RISKS = ("maltrato_sexual", "conflicto_pareja")
ORDER6 = f"{KEYS}, clasificacion"


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


#: Every white-space character of Unicode, as SQL.
_WHITE = " || ".join(f"chr({ord(w)})" for w in whitespace())


def _trim(c: str) -> str:
    return f"trim({c}, {_WHITE})"


def _fold(c: str) -> str:
    return f"regexp_replace(strip_accents(lower({_trim(c)})), '[^\\x00-\\x7F]', '', 'g')"


def _missing(c: str) -> str:
    f = _fold(c)
    return f"case when {f} is null or {f} in {_in(BAD_TOKENS)} then '{MISSING}' else {f} end"


def _sex(c: str) -> str:
    f = _fold(c)
    men = [k for k, v in SEX_MAP.items() if v == "hombre"] + ["hombre"]
    women = [k for k, v in SEX_MAP.items() if v == "mujer"] + ["mujer"]
    return (
        f"case when {f} in {_in(men)} then 'hombre' when {f} in {_in(women)} then 'mujer' "
        f"when {f} = '{MISSING}' then '{MISSING}' else 'otro' end"
    )


def _stage(c: str, labels=()) -> str:
    f = _fold(c)
    whens = " ".join(f"when {f} = '{k}' then '{v}'" for k, v in dict(labels).items())
    return f"coalesce(case {whens} else {f} end, '{MISSING}')" if whens else f"coalesce({f}, '{MISSING}')"


def _level(c: str, replacements=()) -> str:
    out = _fold(c)
    for old, new in replacements:
        out = f"replace({out}, '{old}', '{new}')"
    return f"coalesce({out}, '{MISSING}')"


LEVELS = LEVEL_REPLACEMENTS


def _class(c: str) -> str:
    f = _fold(c)
    whens = " ".join(f"when {f} = '{k}' then '{v}'" for k, v in CLASS_MAP.items())
    return f"case when {f} is null or {f} = '{MISSING}' then '{MISSING}' {whens} else 'otra' end"


def _yes(c: str) -> str:
    return f"case when {_fold(c)} in {_in(YES_TOKENS)} then 1 else 0 end"


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _number(c: str) -> str:
    value = f"try_cast({_trim(c)} as double)"
    return f"case when regexp_matches({_trim(c)}, '{NUMBER}') and isfinite({value}) then {value} end"


def _count(c: str) -> str:
    return f"coalesce(cast(trunc({_number(c)}) as bigint), 0)"


def _year(c: str) -> str:
    return f"cast(case when {_number(c)} = floor({_number(c)}) then {_number(c)} end as bigint)"


def _ratio(n: str, d: str, digits: int = 4) -> str:
    scale = f"{10**digits}.0::double"
    return f"round_even(cast({n} as double) / nullif(cast({d} as double), 0) * {scale}, 0) / {scale}"


def _percent(n: str, d: str) -> str:
    return (
        f"round_even(cast({n} as double) / nullif(cast({d} as double), 0) * 100 * 100.0::double, 0)"
        " / 100.0::double"
    )


RAW_A = """raw_a as (
select cast(year(o_orderdate) as varchar) as ANO,
  case when o_orderkey % 22 = 0 then 'UPZ SIN ASIGNAR' || chr(9) when o_orderkey % 11 = 0 then 'UPZ SIN ASIGNAR' when o_orderkey % 13 = 0 then null
       else replace(n_name, 'NATION', 'Nación') end as NOMBREUPZ,
  concat('Región ', cast(n_regionkey as varchar)) as LOCALIDAD,
  case when o_orderstatus = 'F' and o_orderkey % 3 = 0 then 'Femenino' || chr(13) || chr(10)
    when o_orderstatus = 'F' then 'Femenino' when o_orderstatus = 'O' then 'H' else 'P' end as SEXO,
  c_mktsegment as CURSO_DE_VIDA, o_orderpriority as NIVELEDUCATIVO,
  case when o_orderkey % 17 = 0 then 'abc' when o_orderkey % 19 = 0 then '1234567890e1' when o_orderkey % 23 = 0 then '1e400'
    when o_orderkey % 29 = 0 then ' ' || repeat('0', 320) || '2.5e0' || chr(10) else cast(o_orderkey % 4 as varchar) end as CASOS,
  case when o_totalprice > 100000 and o_orderkey % 3 = 0 then 'Sí' || chr(10) when o_totalprice > 100000 then 'Sí' else 'No' end as SITIO_VIVIENDA,
  case when o_custkey % 3 = 0 then 'X' else 'no' end as SITIO_PARQUE
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""

RAW_B = """raw_b as (
select cast(year(l_shipdate) as varchar) as ano_notificacion,
  replace(n_name, 'NATION', 'NACION') || case when l_orderkey % 5 = 0 then chr(10) else '' end as nombre_upz,
  case o_orderstatus when 'F' then 'm' when 'O' then 'masculino' else 'P' end as sexo,
  c_mktsegment as ciclovital, o_orderpriority as niveleducativo,
  case l_returnflag when 'R' then 'Intento suicida' when 'A' then 'Ideación' else l_returnflag end as clasificacion,
  cast(l_discount as varchar) as maltrato_sexual, cast(l_tax as varchar) as conflicto_pareja
from lineitem join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""

NORM_A = f"""norm_a as (
select {_year('ANO')} as anio, {_missing('NOMBREUPZ')} as upz, {_sex('SEXO')} as sexo,
  {_stage('CURSO_DE_VIDA')} as ciclo_vida, {_level('NIVELEDUCATIVO', LEVELS)} as nivel_educativo,
  {_count('CASOS')} as casos, {_yes('SITIO_VIVIENDA')} as SITIO_VIVIENDA,
  {_yes('SITIO_PARQUE')} as SITIO_PARQUE,
  case CASOS when '1' then 'intento' when '2' then 'ideacion' else 'otra' end as clasificacion
from raw_a)"""


def _positive(c: str) -> str:
    return f"case when {_number(c)} > 0 then 1 else 0 end"


NORM_B = f"""norm_b as (
select {_year('ano_notificacion')} as anio, {_missing('nombre_upz')} as upz, {_sex('sexo')} as sexo,
  {_stage('ciclovital')} as ciclo_vida, {_level('niveleducativo', LEVELS)} as nivel_educativo,
  {_class('clasificacion')} as clasificacion,
  {_positive('maltrato_sexual')} as maltrato_sexual, {_positive('conflicto_pareja')} as conflicto_pareja
from raw_b)"""

CLEAN = "anio is not null and " + " and ".join(
    f"lower(trim({c})) not in {_in(BAD_TOKENS)}" for c in KEY[1:]
)


def _tidy_a(name: str, group: str) -> str:
    return f"""{name} as (
select {group}, cast(sum(casos) as bigint) as casos,
  cast(sum(SITIO_VIVIENDA * casos) as bigint) as SITIO_VIVIENDA,
  cast(sum(SITIO_PARQUE * casos) as bigint) as SITIO_PARQUE
from norm_a where {CLEAN} group by {group})"""


def _tidy_b(name: str, group: str) -> str:
    return f"""{name} as (
select {group}, count(*) as casos, cast(sum(maltrato_sexual) as bigint) as maltrato_sexual,
  cast(sum(conflicto_pareja) as bigint) as conflicto_pareja
from norm_b where {CLEAN} group by {group})"""


TIDY_A, TIDY_B = _tidy_a("tidy_a", KEYS), _tidy_b("tidy_b", ORDER6)
A = f"{RAW_A}, {NORM_A}, {TIDY_A}"
B = f"{RAW_B}, {NORM_B}, {TIDY_B}"
AB = f"{A}, {B}"

RATIO_COLUMNS = ", ".join(
    [f"{_ratio(c, 'casos_sui')} as pct_{c}" for c in RISKS]
    + [f"{_ratio(c, 'casos_spa')} as pct_{c.lower()}" for c in SITES]
)


def _merged(join: str, key: str = KEYS, a: str = "tidy_a", b: str = "tidy_b") -> str:
    columns = [c.strip() for c in key.split(",")]
    on = " and ".join(f"a.{c} = b.{c}" for c in columns)
    keys = ", ".join(f"coalesce(a.{c}, b.{c}) as {c}" for c in columns)
    measures = ", ".join(
        [f"coalesce(a.{c}, 0) as {c}" for c in SITES]
        + [f"coalesce(b.{c}, 0) as {c}" for c in RISKS]
        + ["coalesce(a.casos, 0) as casos_spa", "coalesce(b.casos, 0) as casos_sui"]
    )
    label = "" if "clasificacion" in columns else ", b.clasificacion"
    return f"""joined as (select {keys}{label}, {measures} from {a} a {join} join {b} b on {on}),
merged as (select *, {RATIO_COLUMNS} from joined)"""


M = f"{AB}, {_merged('inner')}"

MERGED_COLUMNS = {
    "anio": "bigint",
    **{c: "string" for c in KEY[1:]},
    "casos_spa": "bigint",
    **{c: "bigint" for c in SITES},
    "clasificacion": "string",
    "casos_sui": "bigint",
    **{c: "bigint" for c in RISKS},
    **{f"pct_{c}": "double" for c in RISKS},
    **{f"pct_{c.lower()}": "double" for c in SITES},
}

DIMS = f"""seen as (select *, row_number() over (order by {ORDER6}) as rn from merged), """ + ", ".join(
    f"""{table} as (select cast(row_number() over (order by min(rn)) as int) as {key},
{', '.join('cast(anio as int) as anio' if c == 'anio' else c for c in natural)}
from seen group by {', '.join(natural)})"""
    for table, (key, natural) in DIMENSIONS.items()
)


def _fact_measure(m: str) -> str:
    if m in ("casos_spa", "casos_sui") or m in RISKS or m in [f"pct_{r}" for r in RISKS]:
        return m
    for site in SITES:
        bare = site.removeprefix("SITIO_").lower()
        if m == f"sitio_{bare}":
            return f"{site} as {m}"
        if m == f"pct_sitio_{bare}":
            return m
    return f"cast(0 as {'double' if m.startswith('pct_') else 'bigint'}) as {m}"


FACT = f"""fact as (
select row_number() over (order by {ORDER6}) as id_fact, {', '.join(FACT_KEYS)}, {', '.join(_fact_measure(m) for m in FACT_MEASURES)}, {ORDER6}
from merged join dim_tiempo using (anio) join dim_ubicacion using (upz)
  join dim_perfil_demografico using (sexo, ciclo_vida, nivel_educativo)
  join dim_clasificacion using (clasificacion))"""
STAR = f"{M}, {DIMS}, {FACT}"
FACT_COLUMNS = ", ".join((*FACT_KEYS, *FACT_MEASURES))
WIDE = f"{FACT_COLUMNS}, cast(anio as int) as anio, {', '.join(KEY[1:])}, clasificacion"

LEVEL_NUMBER = "try_cast(trim(split_part(nivel_educativo, '-', 1)) as bigint)"


def _rule(cases: str, parts) -> str:
    total = " + ".join(parts)
    return (
        f"case when count(*) filter ({cases} = 0) = 0 then 1.0::double else 1 - "
        f"cast(count(*) filter ({cases} = 0 and {total} <> 0) as double) / "
        f"cast(count(*) filter ({cases} = 0) as double) end"
    )


_PCT = [c for c in MERGED_COLUMNS if "pct_" in c]
METRICS = {
    "completitud": _percent(
        " + ".join(f"count({c})" for c in MERGED_COLUMNS), f"(count(*) * {len(MERGED_COLUMNS)})"
    ),
    "exactitud": _percent(
        " + ".join(f"count(*) filter ({c} between 0 and 1)" for c in _PCT), f"(count(*) * {len(_PCT)})"
    ),
    "consistencia": (
        f"round_even((0.0::double + {_rule('casos_spa', SITES)} + {_rule('casos_sui', RISKS)})"
        " / 2 * 100 * 100.0::double, 0) / 100.0::double"
    ),
    "unicidad": _percent("(select count(*) from (select distinct * from merged))", "count(*)"),
    "validez": _percent(
        f"count(*) filter ((ciclo_vida = 'household' and {LEVEL_NUMBER} <= 3)"
        f" or (ciclo_vida = 'machinery' and {LEVEL_NUMBER} <= 4)"
        " or ciclo_vida in ('automobile', 'building', 'furniture'))",
        f"count({LEVEL_NUMBER})",
    ),
    "actualidad": _percent("count(*) filter (anio between 1996 and 2000)", "count(anio)"),
}


def _metric(name: str) -> str:
    return f"with {M} select {METRICS[name]} as {name} from merged"


_CARD_LINES = " union all ".join(
    f"select '{m}' as metrica, {m} as valor, cast({target} as double) as meta, "
    f"coalesce({m} {'=' if exact else '>='} {target}, false) as cumple, "
    f"case when {m} = 100 then '{QUALITY_NOTES[m][0]}' else '{QUALITY_NOTES[m][1]}' end as observaciones from metrics"
    for m, (target, exact) in QUALITY_TARGETS.items()
)
CARD = (
    f"{M}, metrics as (select {', '.join(f'{e} as {m}' for m, e in METRICS.items())} from merged), "
    f"card as ({_CARD_LINES})"
)


def _tally(cte: str, source: str, result: str) -> str:
    return (
        f"with {cte} select {source} as source, {result} as result, count(*) as n "
        f"from {cte.split(' ', 1)[0]} group by all"
    )


RAW_A_COLUMNS = (
    "ANO", "NOMBREUPZ", "LOCALIDAD", "SEXO", "CURSO_DE_VIDA", "NIVELEDUCATIVO", "CASOS",
    "SITIO_VIVIENDA", "SITIO_PARQUE",
)
RAW_B_COLUMNS = (
    "ano_notificacion", "nombre_upz", "sexo", "ciclovital", "niveleducativo", "clasificacion",
    "maltrato_sexual", "conflicto_pareja",
)
RAW_KEY = "ANO, NOMBREUPZ, SEXO, CURSO_DE_VIDA, NIVELEDUCATIVO"


def _each(columns, line) -> str:
    return " union all ".join(line(c) for c in columns)


def _zone(c: str, pattern: str = ZONE_MISSING_RE) -> str:
    t = f"lower({_trim(c)})"
    return f"case when {t} is null or regexp_matches({t}, '{pattern}') then '{MISSING}' else {t} end"


def _bad(c: str) -> str:
    return f"coalesce(lower({_trim(c)}) in {_in(BAD_TOKENS)}, false)"


IMPUTED = f"""{RAW_A}, base as (
  select LOCALIDAD, {_trim('NOMBREUPZ')} as zona_antes, {_trim('LOCALIDAD')} as place from raw_a),
pairs as (select place, zona_antes as z, count(*) as n from base
  where not ({_bad('zona_antes')} or zona_antes is null or {_bad('place')} or place is null) group by all),
modes as (select place, z as mode from (select *, row_number() over (partition by place order by n desc, z) as r
  from pairs) where r = 1),
imputed as (select b.LOCALIDAD, b.zona_antes,
  case when {_bad('zona_antes')} or zona_antes is null then m.mode else zona_antes end as zona
  from base b left join modes m on b.place = m.place)"""


def _top(column: str, label: str) -> str:
    return (
        f"select {_zone(column)} as value, count(*) as {label} from imputed group by 1 "
        f"order by {label} desc, value limit 10"
    )


def _pivot() -> str:
    cells = ", ".join(
        f"case when count(*) filter (NOMBREUPZ = '{z}') > 0 then "
        f"coalesce(sum({_number('CASOS')}) filter (NOMBREUPZ = '{z}'), 0.0::double) end as \"{z}\""
        for z in PIVOT_ZONES
    )
    return f"with {RAW_A} select ANO, {cells} from raw_a where NOMBREUPZ is not null group by ANO"


def _profile() -> str:
    said = PROFILE_TEXTS

    def some(text, number):
        head, tail = text.split("%d")
        return f"'{head}' || {number} || '{tail}'"

    def line(metric, value, note):
        return f"{{'metric': '{said[metric]}', 'value': {value}, 'observation': {note}}}"

    def lines(c, kind):
        type_note = said["type_text"] if kind == "string" else said["type_ok"]
        five = ", ".join(
            [
                line("type", f"'{kind}'", f"'{type_note}'"),
                line("nulls", "cast(nulls as varchar)", f"case when nulls = 0 then '{said['nulls_none']}' else {some(said['nulls_some'], 'nulls')} end"),
                line("unique", "cast(uniques as varchar)", f"case when uniques = total then '{said['unique_all']}' else {some(said['unique_some'], 'uniques')} end"),
                line("dups", "cast(dups as varchar)", f"case when dups = 0 then '{said['dups_none']}' else {some(said['dups_some'], 'dups')} end"),
                line("examples", "examples", f"case when examples = '{said['examples_none']}' then '{said['reliable']}' else '{said['review']}' end"),
            ]
        )
        return f"""select '{c}' as "column", unnest([{five}]) as line
from (select *, case when nulls > 0 then '[' || array_to_string(list_transform(range(least(nulls, 3)), lambda x: 'null'), ', ') || ']'
  when repeats is not null then '[' || repeats || ']' else '{said['examples_none']}' end as examples
  from (select count(*) as total, count(*) - count({c}) as nulls, count(distinct {c}) as uniques,
    count(*) - count(distinct {c}) - cast(count(*) > count({c}) as int) as dups,
    (select string_agg(v, ', ' order by v) from (select v from (
      select cast({c} as varchar) as v, row_number() over (partition by {c}) as r from merged where {c} is not null)
      where r > 1 order by v limit 3)) as repeats
  from merged))"""

    body = " union all ".join(lines(c, kind) for c, kind in MERGED_COLUMNS.items())
    return (
        f"with {M} select \"column\", line.metric as metric, line.value as value, "
        f"line.observation as observation from ({body})"
    )


def _describe_text() -> str:
    return f"with {RAW_A} " + _each(
        RAW_A_COLUMNS,
        lambda c: f"select '{c}' as column, count({c}) as count, count(distinct {c}) as \"unique\", "
        f"(select v from (select {c} as v, count(*) as n from raw_a where {c} is not null group by 1) order by n desc, v limit 1) as top, "
        f"(select max(n) from (select count(*) as n from raw_a where {c} is not null group by {c})) as freq from raw_a",
    )


def _incremental() -> str:
    parts = []
    for table, (_, natural) in DIMENSIONS.items():
        names = ", ".join(natural)
        member = " || '|' || ".join(f"cast({c} as varchar)" for c in natural)
        parts.append(
            f"select '{table}' as \"table\", cast(row_number() over (order by late is null, late, every) as int) as id, "
            f"{member} as member from (select {names}, min(rn) as every, "
            f"min(case when anio >= 1998 then rn end) as late from seen group by {names})"
        )
    return (
        f"with {M}, seen as (select *, row_number() over (order by {ORDER6}) as rn from merged) "
        + " union all ".join(parts)
    )


EVENT_LINES = """lines as (
select event_id as n, case when event_id % 7 = 0 then 'not json ' || event_id else
  '{"event_id":' || event_id ||
  case when event_id % 5 = 0 then '' when event_id % 9 = 0 then ',"event_type":null'
    else ',"event_type":"' || event_type || '"' end ||
  case when event_id % 11 = 0 then ',"amount":"x"}' else ',"amount":' || (event_id % 100) || '}' end end as value,
  event_type
from events)"""
_WANTED = "n % 7 <> 0 and n % 5 <> 0 and n % 9 <> 0 and event_type in ('click', 'view')"

_MATCH = f"""joined_rows as (select count(*) as n from tidy_a join tidy_b using ({KEYS})),
match as (select (select count(*) from tidy_a) as rows_spa, (select count(*) from tidy_b) as rows_sui,
  (select n from joined_rows) as rows_merged,
  (select count(*) from tidy_a a where not exists (select 1 from tidy_b b where
    {' and '.join(f'a.{c} = b.{c}' for c in KEY)})) as spa_without_match,
  (select count(*) from tidy_b b where not exists (select 1 from tidy_a a where
    {' and '.join(f'a.{c} = b.{c}' for c in KEY)})) as sui_without_match)"""

_STATS = """select count(*) as registros_procesados, count(distinct id_tiempo) as dimensiones_tiempo,
count(distinct id_ubicacion) as dimensiones_ubicacion, count(distinct id_perfil) as dimensiones_perfil,
count(distinct id_clasificacion) as dimensiones_clasificacion from fact"""


def _mart() -> str:
    match = _each(
        ("rows_spa", "rows_sui", "rows_merged", "spa_without_match", "sui_without_match"),
        lambda c: f"select 'merge' as stage, '{c}' as metric, cast({c} as double) as value from match",
    )
    stats = _each(
        ("registros_procesados", *(f"dimensiones_{d}" for d in ("tiempo", "ubicacion", "perfil", "clasificacion"))),
        lambda c: f"select 'load', '{c}', cast({c} as double) from stats",
    )
    return (
        f"with {CARD}, {_MATCH}, {DIMS}, {FACT}, stats as ({_STATS}) "
        f"{match} union all select 'quality', metrica, valor from card union all {stats}"
    )


ORACLE: dict[str, str] = {
    "text_fold": f"select doc_id, {_fold('text')} as folded from documents",
    "unify_missing": _tally(RAW_A, "NOMBREUPZ", _missing("NOMBREUPZ")),
    "dict_map_default": _tally(RAW_A, "SEXO", _sex("SEXO")),
    "dict_map_passthrough": _tally(
        RAW_A, "CURSO_DE_VIDA", _stage("CURSO_DE_VIDA", {"automobile": "auto", "building": "obra"})
    ),
    "substring_replace": _tally(
        RAW_A,
        "NIVELEDUCATIVO",
        _level("NIVELEDUCATIVO", (("urgent", "alta"), ("not specified", "sin especificar"))),
    ),
    "classify": _tally(RAW_B, "clasificacion", _class("clasificacion")),
    "yes_flag": (
        f"with {RAW_A}, answers as (select SITIO_VIVIENDA as answer from raw_a union all "
        f"select SITIO_PARQUE from raw_a) select answer as source, {_yes('answer')} as result, "
        "count(*) as n from answers group by all"
    ),
    "positive_flag": (
        f"with {RAW_B}, answers as (select maltrato_sexual as answer from raw_b union all "
        f"select conflicto_pareja from raw_b) select answer as source, {_positive('answer')} as result, "
        "count(*) as n from answers group by all"
    ),
    "numeric_coerce": (
        f"with {RAW_A} select CASOS as source, {_number('CASOS')} as number, "
        f"{_count('CASOS')} as cases, count(*) as n from raw_a group by all"
    ),
    "safe_ratio": f"select l_orderkey, l_linenumber, {_ratio('l_tax', 'l_discount')} as ratio from lineitem",
    "leading_int": _tally(
        RAW_A, "NIVELEDUCATIVO", "try_cast(trim(split_part(NIVELEDUCATIVO, '-', 1)) as bigint)"
    ),
    "regex_missing": (
        f"with {RAW_A} select {_zone('NOMBREUPZ')} as zone, {_zone('LOCALIDAD', PLACE_MISSING_RE)} as place, "
        "count(*) as n from raw_a group by all"
    ),
    "select_rename": (
        f"with {RAW_A} select ANO as anio, NOMBREUPZ as upz, SEXO as sexo, CURSO_DE_VIDA as ciclo_vida, "
        "NIVELEDUCATIVO as nivel_educativo from raw_a"
    ),
    "first_existing_column": (
        f"with {RAW_B} select clasificacion as label, '{MISSING}' as fallback, count(*) as n "
        "from raw_b group by all"
    ),
    "not_null_violations": f"with {RAW_A} "
    + _each(RAW_A_COLUMNS, lambda c: f"select '{c}' as column, count(*) - count({c}) as violations from raw_a"),
    "unique_violations": (
        f"with {M}, {DIMS} select sexo, count(*) as rows from dim_perfil_demografico "
        "group by sexo having count(*) > 1"
    ),
    "fk_orphans": (
        f"with {M}, {DIMS} select upz, count(*) as rows from norm_a "
        "where upz not in (select upz from dim_ubicacion) group by upz"
    ),
    "strict_key_filter": f"with {RAW_A}, {NORM_A} select {KEYS} from norm_a where {CLEAN}",
    "tidy_weighted": f"with {A} select * from tidy_a",
    "tidy_counts": f"with {B} select * from tidy_b",
    "tidy_counts_5key": f"with {RAW_B}, {NORM_B}, {_tidy_b('tidy_b5', KEYS)} select * from tidy_b5",
    "tidy_rows": (
        f"with {RAW_A}, {NORM_A} select {KEYS}, casos, SITIO_VIVIENDA, SITIO_PARQUE "
        f"from norm_a where {CLEAN}"
    ),
    **{
        f"merge_{how}": f"with {AB}, {_merged(join)} select * from merged"
        for how, join in {"inner": "inner", "left": "left", "right": "right", "outer": "full outer"}.items()
    },
    "merge_files": f"with {AB}, {_merged('full outer')} select * from merged",
    "merge_with_class": (
        f"with {RAW_A}, {NORM_A}, {_tidy_a('tidy_a6', ORDER6)}, {B}, "
        f"{_merged('inner', ORDER6, 'tidy_a6')} select * from merged"
    ),
    "merge_qc": f"with {AB}, {_MATCH} select *, '{','.join(KEY)}' as key_used from match",
    "null_counts": "with j as (select d.doc_id, text, lang, source, n_chars, quality, toxic from documents d "
    "left join labels l on d.doc_id = l.doc_id) "
    + _each(
        ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"),
        lambda c: f"select '{c}' as column, count(*) - count({c}) as nulls from j",
    ),
    "sentinel_counts": f"with {RAW_A}, {NORM_A} "
    + _each(KEY[1:], lambda c: f"select '{c}' as column, count(*) filter ({c} = '{MISSING}') as sentinels from norm_a"),
    "duplicate_key_rows": (
        f"with {RAW_A} select cast(coalesce(sum(n), 0) as bigint) as duplicates_by_key from "
        f"(select count(*) as n from raw_a group by {RAW_KEY} having count(*) > 1)"
    ),
    "distinct_counts": f"with {RAW_B} "
    + _each(RAW_B_COLUMNS, lambda c: f"select '{c}' as column, count(distinct {c}) as distinct_values from raw_b"),
    "frequency_share": (
        f"with {RAW_A} select NOMBREUPZ as value, count(*) as n, "
        f"{_ratio('count(*)', '(select count(*) from raw_a)')} as share from raw_a group by NOMBREUPZ"
    ),
    "frequency_table": f"with {RAW_A} select {_zone('NOMBREUPZ')} as value, count(*) as n from raw_a group by 1",
    "topk_frequency": (
        f"with {RAW_A} select {_zone('NOMBREUPZ')} as value, count(*) as n from raw_a group by 1 "
        "order by n desc, value limit 10"
    ),
    "topk_sum": (
        f"with {RAW_A} select NOMBREUPZ as value, coalesce(sum({_number('CASOS')}), 0.0::double) as total "
        "from raw_a where NOMBREUPZ is not null group by 1 order by total desc, value limit 10"
    ),
    "mode_by_group": (
        f"with {RAW_A} select LOCALIDAD, z as mode, n from (select *, row_number() over "
        "(partition by LOCALIDAD order by n desc, z) as r from (select LOCALIDAD, NOMBREUPZ as z, "
        "count(*) as n from raw_a where NOMBREUPZ is not null group by all)) where r = 1"
    ),
    "describe_numeric": _each(
        NUMERIC_COLUMNS,
        lambda c: f"select '{c}' as column, count({c}) as count, round(avg({c}), 4) as mean, "
        f"round(stddev_samp({c}), 4) as std, round(min({c}), 4) as min, "
        + ", ".join(f"round(quantile_cont({c}, {q / 100}), 4) as q{q}" for q in (25, 50, 75))
        + f", round(max({c}), 4) as max from lineitem",
    ),
    "describe_text": _describe_text(),
    "duplicate_sample": (
        f"with {RAW_A} select {RAW_KEY}, CASOS from (select *, count(*) over (partition by {RAW_KEY}) as n "
        f"from raw_a) where n > 1 order by ANO nulls first, NOMBREUPZ nulls first, SEXO, CURSO_DE_VIDA, "
        "NIVELEDUCATIVO, CASOS limit 10"
    ),
    "pivot_sum": _pivot(),
    "qc_report": (
        f"with {B}, sized as (select *, count(*) over (partition by {ORDER6}) as dup from tidy_b) select "
        + ", ".join(
            ["count(*) as rows"]
            + [f"count(*) - count({c}) as nulls_{c}" for c in (*KEY, "clasificacion")]
            + [f"count(*) filter ({c} = '{MISSING}') as sin_dato_{c}" for c in (*KEY[1:], "clasificacion")]
            + ["count(*) filter (dup > 1) as duplicates_by_key"]
        )
        + " from sized"
    ),
    "topk_heavy": f"with {RAW_A} "
    + _each(
        (("NOMBREUPZ", "raw_a"), ("user_id", "events"), ("l_partkey", "lineitem")),
        lambda c: f"(select '{c[0]}' as column, cast({c[0]} as varchar) as value, count(*) as n from {c[1]} "
        f"where {c[0]} is not null group by {c[0]} order by n desc, {c[0]} limit 10)",
    ),
    "column_profile": _profile(),
    "distinct_rows": f"with {RAW_B} select distinct * from raw_b",
    **dict.fromkeys(
        ("distinct_counts_approx", "distinct_counts_merged"),
        f"with {RAW_B} "
        + _each(RAW_B_COLUMNS, lambda c: f"select '{c}' as column, count(distinct {c}) as distinct_values, true as close from raw_b"),
    ),
    "quartiles_merged": _each(
        NUMERIC_COLUMNS,
        lambda c: f"select '{c}' as column, p::double as probability, count({c}) as n, true as close "
        "from lineitem, (values (0.25), (0.5), (0.75)) as q(p) group by p",
    ),
    "optional_zone_filter": (
        f"with {RAW_B}, {NORM_B} select {KEYS}, clasificacion, 1::bigint as casos, maltrato_sexual, conflicto_pareja "
        f"from norm_b where {CLEAN} and upz <> '{MISSING}'"
    ),
    "land_records": "select cast(s_suppkey as varchar) as s_suppkey, s_name, cast(s_nationkey as varchar) as s_nationkey, "
    "cast(s_acctbal as varchar) as s_acctbal from supplier",
    "impute_mode": f"with {IMPUTED} select LOCALIDAD, zona_antes, zona, count(*) as n from imputed group by all",
    "impute_metrics": (
        f"with {IMPUTED} select count(*) filter ({_bad('zona_antes')}) as antes_sin_dato, "
        f"count(*) filter ({_bad('zona_antes')}) - count(*) filter ({_bad('zona')}) as imputadas, "
        f"count(*) filter ({_bad('zona')}) as aun_sin_dato, "
        f"count(*) filter ({_bad('zona')} or zona is null) as aun_sin_dato_o_nulo, "
        f"count(*) filter (({_bad('zona_antes')} or zona_antes is null) and not ({_bad('zona')} or zona is null)) "
        "as resueltas from imputed"
    ),
    "before_after_topk": (
        f"with {IMPUTED}, b as ({_top('zona_antes', 'antes')}), a as ({_top('zona', 'despues')}) "
        "select value, antes, despues from b full outer join a using (value)"
    ),
    "q_completeness": _metric("completitud"),
    "q_accuracy": _metric("exactitud"),
    "q_consistency": _metric("consistencia"),
    "q_uniqueness": _metric("unicidad"),
    "q_validity": _metric("validez"),
    "q_timeliness": _metric("actualidad"),
    "quality_scorecard": f"with {CARD} select * from card",
    "quality_gate": (
        f"with {CARD} select bool_and(cumple) as aprobado, case when bool_and(cumple) then 'APROBADO' "
        "else 'ADVERTENCIAS' end as estado, coalesce(string_agg(metrica, ',' order by metrica) "
        "filter (not cumple), '') as no_cumplen from card"
    ),
    "dim_time": f"with {M}, {DIMS} select * from dim_tiempo",
    "dim_location": f"with {M}, {DIMS} select * from dim_ubicacion",
    "dim_profile": f"with {M}, {DIMS} select * from dim_perfil_demografico",
    "dim_class": f"with {M}, {DIMS} select * from dim_clasificacion",
    "dim_incremental": _incremental(),
    "fact_build": f"with {STAR} select {FACT_COLUMNS} from fact",
    "fact_numbered": (
        f"with {STAR} select id_fact, {', '.join(FACT_KEYS)}, "
        "casos_spa, casos_sui from fact"
    ),
    "load_stats": f"with {STAR} {_STATS}",
    "star_denormalize": f"with {STAR} select id_fact, {WIDE} from fact",
    "mart_build": _mart(),
    "refresh_merged": f"with {M} select * from merged",
    "refresh_scorecard": f"with {CARD} select * from card",
    "refresh_star": (
        f"with {M} select cast(anio as int) as anio, {', '.join(KEY[1:])}, clasificacion, casos_spa, casos_sui, "
        "SITIO_VIVIENDA as sitio_vivienda, pct_conflicto_pareja from merged"
    ),
    "observed_reports": (
        f"with {CARD} select 'merged' as stage, metrica as metric, valor as value from card"
        + "".join(
            f" union all select '{name}', '{metric}', cast({value} as double) from {name}"
            for name, key in (("tidy_a", KEY), ("tidy_b", (*KEY, "clasificacion")))
            for metric, value in (
                ("rows", "count(*)"),
                *((f"nulls_{c}", f"count(*) - count({c})") for c in key),
                *((f"sin_dato_{c}", f"count(*) filter ({c} = '{MISSING}')") for c in key[1:]),
                ("duplicates_by_key", f"case when count(*) = count(distinct ({', '.join(key)})) then 0 end"),
            )
        )
    ),
    "merge_bucketed": f"with {M} select * from merged",
    "dim_collated": (
        f"with {M}, spelled as (select * replace (case anio % 3 when 1 then upper(upz) when 2 then replace(upz, 'nacion', 'Nación') "
        "else upz end as upz) from merged), "
        "same as (select *, strip_accents(lower(upz)) as k from spelled), "
        f"named as (select k, upz, min(anio) over (partition by k) as since, row_number() over (partition by k order by {ORDER6}) as r from same), "
        "used as (select k, count(*) as n from same group by k) "
        "select cast(row_number() over (order by since, upz) as int) as id_ubicacion, upz, n from named join used using (k) where r = 1"
    ),
    "load_set_aside": (
        f"with {M}, counts as (select 'loaded' as reason, count(*) as n from merged where anio <> 1995 "
        "union all select 'null casos_sui', count(*) from merged where anio = 1995 "
        "union all select 'no member of dim_tiempo', count(*) from merged where anio = 1996 "
        "union all select 'repeated key', count(*) from merged where anio = 1997) select * from counts where n > 0"
    ),
    "csv_scan": f"with {RAW_A} select "
    + ", ".join(f"case when {c} not in {_in(NA_TOKENS)} then {c} end as {c}" for c in RAW_A_COLUMNS)
    + " from raw_a",
    "explode_records": (
        "select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey, "
        "cast(c_acctbal as varchar) as c_acctbal, c_mktsegment from customer"
    ),
    "paged_source": (
        "select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey, "
        "cast(c_acctbal as varchar) as c_acctbal, c_mktsegment from customer"
    ),
    "paged_stream": (
        "select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey, "
        "cast(c_acctbal as varchar) as c_acctbal, c_mktsegment from customer"
    ),
    "union_pages": (
        "select c_custkey as id, c_name as name, c_nationkey as nation, c_acctbal as balance, c_mktsegment as segment "
        "from customer union all select s_suppkey, s_name, s_nationkey, s_acctbal, null from supplier"
    ),
    "to_json_feed": f"with {STAR} select id_fact, {WIDE} from fact",
    "stream_filter": f"with {STAR} select id_fact, {WIDE} from fact where ciclo_vida in ('household', 'machinery')",
    **dict.fromkeys(
        ("stream_events", "stream_unique"),
        f"with {EVENT_LINES} select n as event_id, event_type, cast(n % 100 as int) as amount "
        f"from lines where {_WANTED} and n % 11 <> 0",
    ),
    "stream_missing_field": (
        f"with {EVENT_LINES} select value, 'missing_field' as outcome, 'no field event_type' as reason "
        "from lines where n % 7 <> 0 and n % 5 = 0"
    ),
    "stream_rejects": (
        f"with {EVENT_LINES} select value, 'rejected' as outcome, "
        "case when n % 7 = 0 then 'not a JSON object' else 'wrong type' end as reason "
        f"from lines where n % 7 = 0 or ({_WANTED} and n % 11 = 0)"
    ),
}
