"""The text hand-off: exact both ways, and loud about anything else."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from campuslens.sources import handoff as H

SCHEMA = ("`latest.cost.in` double, `a``b` float, n long, i int, s string, t timestamp, l timestamp_ntz, d date,"
          " x binary, m decimal(20,4), ok boolean, list array<string>, `deep.er` struct<`a.b`:double,c:int>")
NOW = dt.datetime(2024, 2, 29, 23, 59, 59, 123456)
ROWS = [
    (0.1, 0.5, 2 ** 63 - 1, -1, "line\nbreak \"quoted\"   é", NOW, NOW, dt.date(1, 1, 1), b"\x00\xff", Decimal("1.2000"),
     True, ["a", None, ""], (1e22, 3)),
    (-0.0, -0.0, -2 ** 63, 0, "", NOW, NOW, dt.date(9999, 12, 31), b"", Decimal("-0.0001"), False, [], (None, None)),
    (5e-324, 1.5, 0, 1, "null", None, None, None, None, None, None, None, None),
    (1.7976931348623157e308, 3.25, 1, 1, "{\"a\":1}", NOW, NOW, None, b"x", None, None, None, (0.1 + 0.2, None)),
    (None,) * 13,
]


def _bits(v):
    return (v, math.copysign(1, v)) if isinstance(v, float) else v


def test_every_value_comes_back_exactly(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    back = H.read_text(spark, H.write_text(df, str(tmp_path / "h")))
    assert back.schema.simpleString() == df.schema.simpleString()
    key = lambda r: str(r)
    for want, got in zip(sorted(df.collect(), key=key), sorted(back.collect(), key=key)):
        assert [_bits(v) for v in want] == [_bits(v) for v in got]


def test_numbers_without_a_value(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, float("-inf"))], "k int, v double")
    got = {r.k: r.v for r in H.read_text(spark, H.write_text(df, str(tmp_path / "h"))).collect()}
    assert math.isnan(got[1]) and got[2] == math.inf and got[3] == -math.inf


def test_random_doubles(spark, tmp_path):
    df = spark.range(20_000).select(F.expr("(rand(3) - 0.5) * pow(10, cast(rand(5) * 600 - 300 as int))").alias("v"), "id")
    df.write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    back = H.read_text(spark, H.write_text(df, str(tmp_path / "h")))
    assert back.exceptAll(df).count() == 0 and back.count() == 20_000


@pytest.mark.parametrize("line", [
    '{"a.b":1.0,"c":"x"', '{"a.b":1.0,"c":"x"} more', '[1]', 'null', '', '{"a.b":1.0}', '{"a.b":1.0,"c":"x","d":1}',
    '{"a.b":"one","c":"x"}', '{"a.b":1.0,"c":"x","c":"y"}', '{"c":"x","a.b":1.0}', '{"a.b":1.0,"c":"x"}{"a.b":2.0,"c":"y"}'])
def test_malformed_text_fails_whatever_is_selected(spark, line):
    schema = spark.createDataFrame([], "`a.b` double, c string").schema
    lines = spark.createDataFrame([('{"a.b":1.0,"c":"x"}',), (line,)], "value string")
    spark.sparkContext.setLogLevel("OFF")
    try:
        with pytest.raises(Exception):
            H.decode(lines, schema).select("c").collect()
        with pytest.raises(Exception):
            H.decode(lines, schema).collect()
    finally:
        spark.sparkContext.setLogLevel("ERROR")


def test_a_hand_off_that_broke_off_is_not_read(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    H.encode(df).write.text(str(tmp_path / "h/rows"))
    with pytest.raises(Exception):
        H.read_text(spark, str(tmp_path / "h"))
    with pytest.raises(ValueError):
        H.encode(df.select("a", "a"))


def test_empty_frame_and_variant_fields(spark, tmp_path):
    df = spark.createDataFrame(ROWS[:3], SCHEMA)
    assert H.read_text(spark, H.write_text(df.limit(0), str(tmp_path / "e"))).count() == 0
    H.write_text(df, str(tmp_path / "v"))
    got = H.read_variant(spark, str(tmp_path / "v")).select(
        H.field("record", "latest.cost.in", "double").alias("x"), H.field("record", "n", "long").alias("n"),
        H.field("record", "s", "string").alias("s"), H.field("record", "nowhere", "int").alias("none"))
    assert {(r.x, r.n, r.s, r.none) for r in got.collect()} == {(r[0], r[2], r[4], None) for r in ROWS[:3]}
