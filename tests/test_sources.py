import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidymart.sources import files, paged, tables


def test_csv_reads_text_nulls_tokens_and_skips_the_mark(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b\n1,N/A\n" 2 ",N.A.\nnull,"say ""hi"", you"\n,sin dato\n', encoding="utf-8-sig")
    out = files.read_csv(spark, str(path))
    assert out.columns == ["a", "b"]
    assert rows(out) == [(None, 'say "hi", you'), (None, "sin dato"), (" 2 ", "N.A."), ("1", None)]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(" a ", 'q"x'), ("b,c", None)], "t string, u string")
    files.write_csv(df, str(tmp_path / "out"))
    assert rows(files.read_csv(spark, str(tmp_path / "out"), ["t", "u"])) == rows(df)


def test_csv_with_line_breaks(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b\n"one\ntwo",2\n')
    assert rows(files.read_csv(spark, str(path), multiline=True)) == [("one\ntwo", "2")]


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a\n1,2\n")
    assert rows(files.read_csv(spark, str(tmp_path / "a.csv"), ["a", "b"]), "a", "b") == [("2", "1")]
    with pytest.raises(Exception, match="c"):
        files.read_csv(spark, str(tmp_path / "a.csv"), ["a", "c"])


@pytest.mark.parametrize("text", ['a,b\n"x\ny",2\n', 'a,b\n1,"x\ny"\n', "a,b\n1\n", "a,b\n1,2,3\n"])
def test_a_broken_record_is_never_returned(spark, tmp_path, text):
    (tmp_path / "a.csv").write_text(text)
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "a.csv"), ["a", "b"]).collect()
    if '"' in text:
        assert files.read_csv(spark, str(tmp_path / "a.csv"), ["a", "b"], multiline=True).count() == 1


def test_files_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path), ["a", "b"]).collect()


def test_short_pages_are_completed_and_missing_ones_fail(spark):
    def short(offset, size):
        return {"success": True, "result": {"records": [{"a": i} for i in range(offset, min(25, offset + 4))], "total": 25}}

    def cut(offset, size):
        return {"success": True, "result": {"records": [{"a": i} for i in range(offset, min(7, offset + size))], "total": 25}}

    assert sorted(int(r.a) for r in paged.read_pages(spark, short, 10).collect()) == list(range(25))
    with pytest.raises(Exception, match="no records from offset"):
        paged.read_pages(spark, cut, 10).collect()


def test_one_saved_answer_per_page(tmp_path):
    (tmp_path / "offset=0").mkdir()
    for name in ("part-0", "part-1"):
        (tmp_path / "offset=0" / name).write_text('{"success": true}')
    with pytest.raises(RuntimeError, match="2 saved answers"):
        paged.FolderFetcher(str(tmp_path))(0, 10)


def pages(total, limit, success=True):
    records = [{"_id": i, "zona": None if i % 3 == 0 else f"z{i}"} for i in range(total)]

    def fetch(offset, size):
        assert size == limit
        found = records[offset : offset + size]
        return {"success": success, "result": {"records": found, "total": total, "fields": []}}

    return fetch


def test_paged_source_reads_every_page_in_its_own_partition(spark):
    out = paged.read_pages(spark, pages(25, 10), 10)
    assert out.columns == ["_id", "zona"]
    assert out.rdd.getNumPartitions() == 3
    assert {tuple(r) for r in out.collect()} == {(str(i), None if i % 3 == 0 else f"z{i}") for i in range(25)}
    assert out.count() == 25


def test_paged_source_edges(spark):
    assert paged.read_pages(spark, pages(20, 10), 10).count() == 20
    assert paged.read_pages(spark, pages(0, 10), 10, ["_id"]).count() == 0
    with pytest.raises(Exception, match="the API returned an error"):
        paged.read_pages(spark, pages(5, 10, success=False), 10, ["_id"]).count()


def test_http_fetcher_retries(monkeypatch):
    calls = []

    class Answer:
        def __enter__(self):
            return self

        def __exit__(self, *_):
            return None

        def read(self):
            return json.dumps({"success": True, "result": {}}).encode()

    def urlopen(url, timeout):
        calls.append(url)
        if len(calls) < 3:
            raise OSError("no network")
        return Answer()

    monkeypatch.setattr(paged.urllib.request, "urlopen", urlopen)
    monkeypatch.setattr(paged.time, "sleep", lambda _: None)
    assert paged.HttpFetcher("https://example.org/api", "r1")(20, 10)["success"]
    assert len(calls) == 3 and calls[0].endswith("resource_id=r1&limit=10&offset=20")


def test_envelopes(spark, tmp_path):
    for i, success in enumerate([True, True]):
        answer = {"success": success, "result": {"total": 3, "records": [{"a": 1, "b": f"x{i}"}, {"b": None, "a": "2"}][: 2 - i]}}
        (tmp_path / f"{i}.json").write_text(json.dumps(answer, indent=1))
    out = files.explode_records(files.read_envelopes(spark, str(tmp_path), ["a", "b"], multiline=True))
    assert rows(out) == [("1", "x0"), ("1", "x1"), ("2", None)]
    (tmp_path / "9.json").write_text(json.dumps({"success": False}))
    bad = files.explode_records(files.read_envelopes(spark, str(tmp_path), ["a", "b"], multiline=True))
    with pytest.raises(Exception, match="the API returned an error"):
        bad.collect()


def test_landing_takes_its_records_once(spark, tmp_path):
    taken = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            taken.add(len(batch))
            yield batch

    assert files.land(spark.range(100).mapInPandas(count, "id long"), str(tmp_path / "once"))
    assert taken.value == 100 and spark.read.parquet(str(tmp_path / "once")).count() == 100


def test_landing_writes_nothing_when_there_is_nothing(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert not files.land(df.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    assert files.land(df, str(tmp_path / "some"), ["b"], "csv")
    assert rows(files.read_csv(spark, str(tmp_path / "some"))) == [("x",)]


def test_union_of_pages_with_different_columns(spark):
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    two = spark.createDataFrame([(2,)], "a int")
    assert rows(files.union_pages([one, two, two])) == [(1, "x"), (2, None), (2, None)]


def test_feed_keeps_null_fields(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert files.to_json_feed(df).first().value == '{"a":1,"b":null}'
    files.publish(df, "text", {}, str(tmp_path / "feed"))
    assert spark.read.text(str(tmp_path / "feed")).count() == 1
    files.write_report(df.select(F.struct("a", "b").alias("nested")), str(tmp_path / "report"))
    assert spark.read.text(str(tmp_path / "report")).first().value == '{"nested":{"a":1,"b":null}}'


def test_database_options():
    assert tables.append_options("u", "t") == {"url": "u", "dbtable": "t", "batchsize": "1000"}
    assert tables.scan_options("u", "t", ("id", 1, 9, 3))["numPartitions"] == "3"
    assert "partitionColumn" not in tables.scan_options("u", "t")


def growing(folder, total):
    """A source of numbered records that notes in a folder which offsets it was asked for."""
    path = f"{folder}/calls"

    def fetch(offset, size):
        with open(path, "a") as log:
            log.write(f"{offset}\n")
        records = [{"a": i} for i in range(offset, min(total, offset + size))]
        return {"success": True, "result": {"records": records, "total": total}}

    return fetch


def test_a_restarted_extract_goes_on_where_it_stopped(spark, tmp_path):
    paths = str(tmp_path / "target"), str(tmp_path / "state")
    for total in (0, 13, 13, 20, 47):
        (tmp_path / "calls").write_text("")
        paged.extract_new(spark, growing(tmp_path, total), *paths, ["a"], 10).awaitTermination()
        found = rows(spark.read.schema("a string").parquet(paths[0])) if total else []
        assert found == sorted((str(i),) for i in range(total))
    # The last run asked for the total and read three pages; pages before them were not asked for again.
    asked = {int(x) for x in (tmp_path / "calls").read_text().split()}
    assert asked == {0, 20, 30, 40}
    with pytest.raises(Exception, match="47 were read before"):
        paged.extract_new(spark, growing(tmp_path, 30), *paths, ["a"], 10).awaitTermination()


def test_a_batch_that_failed_is_read_again(spark, tmp_path):
    paths = str(tmp_path / "target"), str(tmp_path / "state")

    whole = growing(tmp_path, 25)

    def broken(offset, size):
        if offset == 10:
            raise OSError("no network")
        return whole(offset, size)

    with pytest.raises(Exception, match="no network"):
        paged.extract_new(spark, broken, *paths, ["a"], 10).awaitTermination()
    paged.extract_new(spark, growing(tmp_path, 25), *paths, ["a"], 10).awaitTermination()
    assert rows(spark.read.parquet(paths[0])) == sorted((str(i),) for i in range(25))


def test_no_record_travels_with_the_source():
    from pyspark import cloudpickle

    def fetch(offset, size):
        return {"success": True, "result": {"records": [{"a": "x" * 1000} for _ in range(size)], "total": 900}}

    source = paged.paged_source(fetch, known=paged.extent(fetch, 300))({"limit": "300"})
    assert len(cloudpickle.dumps(source.reader(source.schema()))) < 5000 and len(cloudpickle.dumps(type(source))) < 20_000
    assert [(p.offset, p.expected) for p in source.reader(source.schema()).partitions()] == [(0, 300), (300, 300), (600, 300)]
