"""Records and dates, one literal row per rule."""

import pytest
from pyspark.sql import functions as F

from weir.functions import dates, records


def one(spark, value, *columns):
    df = spark.createDataFrame([(value,)], "value string")
    return df.select("value", records.parse("value").alias("v")).select(*columns).first()


@pytest.mark.parametrize(
    "text, is_object",
    [
        (None, False),
        ("", False),
        ("not json", False),
        ("[1]", False),
        ("5", False),
        ("null", False),
        ('{"k":1,}', False),
        ('{"k":1,"k":2}', False),
        ("{'k':1}", False),
        ("{}", True),
        ('{"k":1} trailing', True),
    ],
)
def test_what_counts_as_a_record(spark, text, is_object):
    assert one(spark, text, records.is_object("v"))[0] is is_object


def test_reading_fields(spark):
    text = '{"s":"x","n":1,"t":"1592140987000","o":{"a":[1]},"z":null,"e":"","j":"junk","b":true}'
    strings = [records.get_string("v", f"$.{k}") for k in "snozejb"]
    assert list(one(spark, text, *strings)) == ["x", "1", '{"a":[1]}', None, "", "junk", "true"]
    longs = [records.get_long("v", f"$.{k}") for k in "ntjo"]
    assert list(one(spark, text, *longs)) == [1, 1592140987000, None, None]
    present = [records.present("v", f"$.{k}") for k in ("e", "o", "z", "absent")]
    assert list(one(spark, text, *present)) == [True, True, False, False]


def test_writing_fields(spark):
    fields = records.get_object("v")
    changed = records.put(records.remove(fields, "b"), "a", records.text("x"))
    assert one(spark, '{"a":1,"b":2,"c":[3]}', records.to_text(changed))[0] == '{"c":[3],"a":"x"}'


def test_drop_nulls_keeps_positions(spark):
    text = '{"a":null,"b":{"c":null,"d":1},"e":[null,{"f":null,"g":2},"null"]}'
    dropped = records.unmarked(records.without_nulls(F.to_json("v")))
    assert one(spark, text, dropped)[0] == '{"b":{"d":1},"e":[null,{"g":2},"null"]}'


ZONES = ("UTC", "America/New_York", "Asia/Shanghai")


@pytest.mark.parametrize("session_zone", ZONES)
def test_dates_do_not_depend_on_the_session(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        # 2024-03-10 02:30 does not exist in New York.
        rows = spark.createDataFrame([(1710037800123,), (-1,), (1592140987000,)], "ms bigint")
        texts = [
            dates.to_date(F.col("ms")),
            dates.to_date_time(F.col("ms")),
            dates.to_ms(dates.to_date_time(F.col("ms")), full=True),
            dates.to_ms(dates.to_date_time(F.col("ms"), "UTC"), full=True, zone="UTC"),
        ]
        assert [tuple(r) for r in rows.select(*texts).collect()] == [
            ("2024-03-10", "2024-03-10 10:30:00", 1710037800000, 1710037800000),
            ("1970-01-01", "1970-01-01 07:59:59", -1000, -1000),
            ("2020-06-14", "2020-06-14 21:23:07", 1592140987000, 1592140987000),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_text_to_ms(spark):
    cases = {
        "2020-06-14": 1592064000000,
        "2023-02-30": 1677513600000,  # the last day of the month
        "2020-6-14": None,
        "2020-13-01": None,
        "junk": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "d string")
    assert {r[0]: r[1] for r in df.select("d", dates.to_ms(F.col("d"))).collect()} == cases
    full = {
        "2020-06-14 21:23:07": 1592140987000,
        "2020-06-14 24:00:00": 1592150400000,
        "2020-06-14 24:00:01": None,
        "2020-06-14": None,
    }
    df = spark.createDataFrame([(k,) for k in full], "d string")
    assert {r[0]: r[1] for r in df.select("d", dates.to_ms(F.col("d"), full=True)).collect()} == full


def test_instants_beyond_spark_have_no_day(spark):
    df = spark.createDataFrame([(2**63 - 1,), (-(2**63),)], "ms bigint")
    rows = df.select(dates.day(F.col("ms")), dates.previous_day(F.col("ms"))).collect()
    assert [tuple(r) for r in rows] == [(None, None), (None, None)]


def test_texts_whose_numbers_need_marks_are_found():
    import re

    texts = ["", "7", "-0", "-1", "1.", "12e", "1E5", "e.1", "a1.b", "1,.", "12345678901234567", "123456789012345678", "x1234567890123456789", "12 3.4"]
    for text in texts:
        assert bool(re.search(records._UNSETTLED, text)) == bool(re.search("[0-9][.eE]|[0-9]{18}|-0", text)), text
