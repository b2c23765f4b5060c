import golden
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidymart.contracts import FEED_SCHEMA
from tidymart.operators import star
from tidymart.sources import files
from tidymart.streaming import feed

LINES = [
    '{"id_fact":1,"ciclo_vida":"juventud","casos_spa":3}',
    '{"id_fact":2,"casos_spa":3}',
    "not json",
    '{"id_fact":3,"ciclo_vida":"vejez"}',
    '{"id_fact":4,"ciclo_vida":"adolescencia","casos_spa":"x"}',
    '{"id_fact":5,"ciclo_vida":null}',
    '{"id_fact":6,"ciclo_vida":"vejez","casos_spa":"x"}',
]
SCHEMA = T.StructType(
    [
        T.StructField("id_fact", T.IntegerType()),
        T.StructField("ciclo_vida", T.StringType()),
        T.StructField("casos_spa", T.IntegerType()),
    ]
)


def run(spark, folder, **options):
    source = feed.read_feed(spark, "text", {}, str(folder / "in"))
    paths = [str(folder / n) for n in ("table", "rejects", "state")]
    feed.consume(source, *paths, schema=SCHEMA, **options).awaitTermination()
    return feed.stored_table(spark, paths[0], SCHEMA), feed.reject_table(spark, paths[1])


def add(folder, name, lines):
    (folder / "in").mkdir(exist_ok=True)
    (folder / "in" / name).write_text("\n".join(lines) + "\n")


def test_golden_routes(spark, tmp_path):
    add(tmp_path, "1.txt", LINES)
    stored, rejects = run(spark, tmp_path)
    assert rows(stored) == [(1, "juventud", 3)]
    assert {(r.value, r.outcome, r.reason) for r in rejects.collect()} == {
        (LINES[1], "missing_field", "no field ciclo_vida"),
        ("not json", "rejected", "not a JSON object"),
        (LINES[4], "rejected", "wrong type"),
    }


def test_batch_routing_names_every_outcome(spark):
    df = spark.createDataFrame([(v,) for v in LINES], "value string")
    outcome = {r.value: r.outcome for r in feed.route(df, SCHEMA).collect()}
    assert [outcome[v] for v in LINES] == [
        "stored", "missing_field", "rejected", "filtered", "rejected", "filtered", "filtered",
    ]


def test_restart_adds_only_what_is_new(spark, tmp_path):
    add(tmp_path, "1.txt", LINES)
    run(spark, tmp_path)
    stored, _ = run(spark, tmp_path)
    assert stored.count() == 1
    add(tmp_path, "2.txt", [LINES[0].replace("1", "9"), LINES[0].replace("1", "9")])
    stored, _ = run(spark, tmp_path, unique_by=["id_fact"])
    assert rows(stored, "id_fact") == [(1,), (9,)]


def test_jobs_with_other_checkpoints_keep_each_others_rows(spark, tmp_path):
    add(tmp_path, "1.txt", LINES)
    run(spark, tmp_path)
    for state, unique, expected in (("state2", [], [1, 1]), ("state3", ["id_fact"], [1, 1])):
        source = feed.read_feed(spark, "text", {}, str(tmp_path / "in"))
        paths = [str(tmp_path / n) for n in ("table", "rejects", state)]
        feed.consume(source, *paths, schema=SCHEMA, unique_by=unique).awaitTermination()
        stored = feed.stored_table(spark, paths[0], SCHEMA)
        assert sorted(r.id_fact for r in stored.collect()) == expected


def test_a_feed_that_is_published_again_adds_nothing(spark, tmp_path):
    merged = golden.merged(spark, tmp_path)
    dims = star.build_dimensions(merged)
    wide = star.denormalize(star.number_facts(star.build_fact(merged, dims), dims), dims)
    paths = [str(tmp_path / n) for n in ("table", "rejects", "state")]
    for _ in range(2):
        files.publish(wide, "text", {}, str(tmp_path / "in"))
        source = feed.read_feed(spark, "text", {}, str(tmp_path / "in"))
        feed.consume(source, *paths, unique_by=["id_fact"]).awaitTermination()
    out = feed.stored_table(spark, paths[0])
    assert sorted(r.id_fact for r in out.collect()) == sorted(
        r.id_fact for r in wide.where(F.col("ciclo_vida").isin("adolescencia", "juventud")).collect()
    )


def test_published_star_goes_through_the_stream(spark, tmp_path):
    merged = golden.merged(spark, tmp_path)
    dims = star.build_dimensions(merged)
    wide = star.denormalize(star.number_facts(star.build_fact(merged, dims), dims), dims)
    files.publish(wide, "text", {}, str(tmp_path / "in"))
    source = feed.read_feed(spark, "text", {}, str(tmp_path / "in"))
    paths = [str(tmp_path / n) for n in ("table", "rejects", "state")]
    feed.consume(source, *paths).awaitTermination()
    out = feed.stored_table(spark, paths[0])
    assert out.columns == FEED_SCHEMA.fieldNames() and len(out.columns) == 43
    assert rows(out, "ciclo_vida", "casos_sui") == [("adolescencia", 1), ("adolescencia", 2), ("juventud", 1)]


TIMED = T.StructType([*SCHEMA.fields, T.StructField("at", T.TimestampType())])


def land(spark, folder, job, name, lines):
    """One run of a feeding job with its own folder and checkpoint, all of them landing in one place."""
    (folder / job).mkdir(exist_ok=True)
    (folder / job / name).write_text("\n".join(lines) + "\n")
    source = feed.read_feed(spark, "text", {}, str(folder / job))
    feed.consume(source, str(folder / "landing"), str(folder / "rejects"), str(folder / f"state-{job}"), schema=TIMED).awaitTermination()


def settle(spark, folder, **options):
    paths = [str(folder / n) for n in ("landing", "table", "keys")]
    query = feed.settle(spark, *paths, ["id_fact"], TIMED, **options)
    query.awaitTermination()
    return query, feed.stored_table(spark, paths[1], TIMED)


def line(n, cases=1, at="2024-01-01T00:00:00Z"):
    return '{"id_fact":%s,"ciclo_vida":"juventud","casos_spa":%d,"at":"%s"}' % (n, cases, at)


def test_keys_are_state_across_jobs(spark, tmp_path):
    land(spark, tmp_path, "a", "1.txt", [line(k) for k in range(40)] + [line(3, 9), line("null"), line("null"), LINES[1]])
    _, out = settle(spark, tmp_path)
    assert sorted(str(r.id_fact) for r in out.collect()) == sorted(map(str, [*range(40), None, None]))
    # Another job publishes all of it again, and a little more: only that is stored, what was stored first stays.
    land(spark, tmp_path, "b", "1.txt", [line(k, 7) for k in range(42)])
    query, out = settle(spark, tmp_path)
    assert rows(out.where("id_fact is not null"), "id_fact", "casos_spa") == rows(
        spark.createDataFrame([(k, 1 if k < 40 else 7) for k in range(42) if k != 3], "id_fact int, casos_spa int").union(
            out.where("id_fact = 3").select("id_fact", "casos_spa")
        )
    )
    # The batch read what was landed since, and nothing of the table.
    assert query.lastProgress["numInputRows"] == 42
    assert query.lastProgress["stateOperators"][0]["numRowsUpdated"] == 2
    _, again = settle(spark, tmp_path)
    assert again.count() == 44


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    land(spark, tmp_path, "a", "1.txt", [line(k) for k in range(5)])
    settle(spark, tmp_path)
    # The batch was written, but the driver was lost before it was marked as done.
    for commit in (tmp_path / "keys" / "commits").glob("*"):
        commit.unlink()
    _, out = settle(spark, tmp_path)
    assert rows(out, "id_fact") == [(k,) for k in range(5)]


def test_keys_are_forgotten_behind_the_horizon(spark, tmp_path):
    options = {"event_time": "at", "horizon": "1 day"}
    land(spark, tmp_path, "a", "1.txt", [line(1, 1, "2024-01-01T00:00:00Z"), line(1, 2, "2024-01-01T01:00:00Z")])
    settle(spark, tmp_path, **options)
    land(spark, tmp_path, "a", "2.txt", [line(1, 3, "2024-01-01T20:00:00Z"), line(2, 1, "2024-03-01T00:00:00Z")])
    settle(spark, tmp_path, **options)
    land(spark, tmp_path, "a", "3.txt", [line(3, 1, "2024-03-01T01:00:00Z")])
    query, out = settle(spark, tmp_path, **options)
    assert rows(out, "id_fact") == [(1,), (2,), (3,)]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 2
