from pyspark.sql import functions as F

from tidymart.functions import numeric

PLAIN = ["0", "7", "007", "0.05", "12e1", "1E-2", "123456789012345678", "2.0", "2.5"]
ODD = ["", " 7", "7\n", "+7", "-7", ".5", "5.", "1e400", "12d", "1f", "NaN", "0x1p3", "0X1P3", "1x2", "1 2", "1_2", "1e", "1-2", "\x007", "7\x1f", "٣", "abc", None]


def test_plain_numbers_need_no_pattern(spark, monkeypatch):
    df = spark.createDataFrame([(t,) for t in PLAIN], "t string")
    monkeypatch.setattr(numeric, "_part", lambda c, pattern, kind: F.raise_error(F.lit("pattern")).cast(kind))
    number, flag = numeric.to_number(F.col("t")), numeric.positive_flag(F.col("t"))
    assert [tuple(r) for r in df.select(number, flag).collect()] == [(float(t), int(float(t) > 0)) for t in PLAIN]
    whole = [t for t in PLAIN if t.isdigit()]
    assert [r[0] for r in df.where(F.col("t").isin(whole)).select(numeric.to_count(F.col("t"))).collect()] == [int(t) for t in whole]


def test_the_short_way_gives_what_the_pattern_gives(spark, monkeypatch):
    df = spark.createDataFrame([(t,) for t in PLAIN + ODD], "t string")
    columns = [numeric.to_number, numeric.to_count, numeric.positive_flag]
    short = df.select(*(f(F.col("t")) for f in columns)).collect()
    monkeypatch.setattr(numeric, "_plain", lambda c: F.lit(False))
    assert short == df.select(*(f(F.col("t")) for f in columns)).collect()
