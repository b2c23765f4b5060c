"""Secret scan with a ledger of blobs: each text version is scanned once per rule version, in the JVM only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidymart.session import written


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A kind of secret. `value` is the group whose length must reach `least` (code points)."""

    kind: str
    pattern: str
    value: int = 0
    least: int = 1
    version: int = 1


_NAMES = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), either_case("api") + "_?" + either_case("key")])
#: The base rules, in their order. For `access` and `hex` the least length stands in the pattern: the
#: longest run begins at the first match, so nothing shorter could hide a longer one.
BASE_RULES = (
    Rule("assign", f"({_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", value=2, least=12),
    Rule("access", "AKIA[A-Z0-9]{14,}"),
    Rule("hex", "[0-9a-f]{16,}"),
)
#: What the ledger scans for besides the base rules.
MORE_RULES = (
    Rule("hosting", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("pem", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES
#: Matches whose places are summed up together.
BLOCK_MATCHES = 256
LEDGER = "blob binary, kind string, version int, spans array<struct<start:bigint,end:bigint>>"


def find_spans(text: Column, rule: Rule) -> Column:
    """Leftmost non-overlapping matches as (start, end) in code points, end exclusive; a null text has none.

    The texts between the matches come from splitting at them, so places are sums of lengths and the text is
    walked a fixed number of times, however many matches it has. Sums run within blocks of matches, from the
    sums of the blocks before, because appending to an array copies it.
    """
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(rule.value)) if rule.value else whole
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"), whole.alias("found"), value.alias("value")
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    zero = F.lit(0).cast("bigint")

    def length(part: Column) -> Column:
        return F.length(part["gap"]) + F.coalesce(F.length(part["found"]), F.lit(0))

    def block_starts(sums: Column) -> Column:
        first = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("starts"))
        return F.aggregate(
            sums, first, lambda x, n: F.struct((x["at"] + n).alias("at"), F.concat(x["starts"], F.array(x["at"])).alias("starts")), lambda x: x["starts"]
        )

    def step(so_far: Column, part: Column) -> Column:
        start = so_far["at"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["found"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"))
        good = part["found"].isNotNull() & (F.length(part["value"]) >= rule.least)
        return F.struct(end.alias("at"), F.when(good, F.concat(so_far["spans"], F.array(span))).otherwise(so_far["spans"]).alias("spans"))

    def of_block(pair: Column) -> Column:
        first = F.struct(pair["start"].alias("at"), none.alias("spans"))
        return F.aggregate(pair["block"], first, step, lambda x: x["spans"])

    def of_blocks(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda n, part: n + length(part)))
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("block"), block_starts(sums).alias("start")), of_block))

    def cut(all_: Column) -> Column:
        last = F.floor((F.size(all_) - 1) / BLOCK_MATCHES).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(all_, k * BLOCK_MATCHES + 1, BLOCK_MATCHES))

    spans = bound(bound(parts, cut), of_blocks)
    return F.when(text.rlike(rule.pattern), spans).otherwise(none)


def bound(value: Column, use) -> Column:
    """What `use` makes of a value that is computed once, however often `use` names it."""
    return F.transform(F.array(value), use)[0]


def read_ledger(spark, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], LEDGER)


def scan_versions(versions: DataFrame, ledger: str, key="doc_id", text="text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger has not seen, add it there, and return (key, blob, kind, start, end) of all versions.

    `versions` holds one row per version of a path; `key` names the path. A blob is the SHA-256 of a text; the
    ledger at path `ledger` has one row per blob, kind and rule version, found or not. Only pairs that are missing
    there are scanned: a second run over the same texts scans nothing, a raised rule version scans that rule
    alone. A blob is scanned in one place, however many paths hold it; its text is fetched by the smallest key.

    A null text counts as empty, repeated rows repeat their findings, an empty table gives none, a null key is
    kept, and other columns are ignored.
    """
    blob = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    keyed = versions.select(F.col(key).alias("__key"), F.coalesce(F.col(text), F.lit("")).alias("__text"), blob.alias("blob"))
    listed = written(keyed.select("__key", "blob"), "secret-versions")

    seen = read_ledger(versions.sparkSession, ledger)
    wanted = F.explode(F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules]))
    holders = listed.groupBy("blob").agg(F.min("__key").alias("__key")).select("*", wanted.alias("rule"))
    unseen = holders.select("__key", "blob", "rule.kind", "rule.version").join(seen, ["blob", "kind", "version"], "left_anti")
    todo = unseen.groupBy("__key", "blob").agg(F.collect_set("kind").alias("kinds"))
    same = todo["blob"].eqNullSafe(keyed["blob"]) & todo["__key"].eqNullSafe(keyed["__key"])
    texts = keyed.join(todo.hint("shuffle_hash"), same).select(todo["blob"], "__text", "kinds")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    found = F.array(
        *[
            F.when(
                F.array_contains("kinds", r.kind),
                F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), find_spans(F.col("__text"), r).alias("spans")),
            )
            for r in rules
        ]
    )
    news = texts.select("blob", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("f"))
    # A path that repeats a version would list it twice.
    news = news.select("blob", "f.kind", "f.version", F.coalesce("f.spans", none).alias("spans"))
    news.dropDuplicates(["blob", "kind", "version"]).write.mode("append").parquet(ledger)

    now = F.array(*[F.concat_ws(":", F.lit(r.kind), F.lit(r.version)) for r in rules])
    known = read_ledger(versions.sparkSession, ledger)
    known = known.filter(F.array_contains(now, F.concat_ws(":", "kind", "version")) & (F.size("spans") > 0))
    # A second writer may have scanned the same pair.
    known = known.dropDuplicates(["blob", "kind", "version"])
    hits = known.groupBy("blob").agg(F.collect_list(F.struct("kind", "spans")).alias("hits"))
    # Written, so that the join reads both sides anew and can split a blob with very many paths.
    joined = listed.join(written(hits, "secret-hits"), "blob", "left")
    return joined.select(F.col("__key").alias(key), "blob", "hits")


def spans_text(hits: Column, rules: tuple[Rule, ...]) -> Column:
    """``kind:start:end`` of the rules' spans by start, then kind as listed, comma-joined."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    wanted = F.filter(F.coalesce(hits, F.array().cast("array<struct<kind:string,spans:array<struct<start:bigint,end:bigint>>>>")), lambda h: order[h["kind"]].isNotNull())
    flat = F.flatten(
        F.transform(
            wanted,
            lambda h: F.transform(h["spans"], lambda s: F.struct(s["start"].alias("start"), order[h["kind"]].alias("at"), s["end"].alias("end"), h["kind"].alias("kind"))),
        )
    )
    return F.array_join(F.transform(F.array_sort(flat), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_spans(hits: Column, kind: str) -> Column:
    sizes = F.transform(F.filter(hits, lambda h: h["kind"] == kind), lambda h: F.size(h["spans"]).cast("bigint"))
    return F.coalesce(F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, b: a + b), F.lit(0).cast("bigint"))
