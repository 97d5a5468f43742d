import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tidewell.functions import money, people, text, times

D = dt.date


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_epoch_formats(spark):
    ms = F.lit(1_704_067_207_179)
    assert one(spark, times.ms_to_date(ms)) == "2024-01-01"
    assert one(spark, times.ms_to_datetime(ms)) == "2024-01-01 00:00:07"
    assert one(spark, times.ms_to_compact(ms)) == "20240101"
    assert one(spark, times.ms_to_date(F.lit("1704067207179"))) == "2024-01-01"


def test_text_to_epoch(spark):
    assert one(spark, times.datetime_to_ms(F.lit("2024-01-01 00:00:07"))) == 1_704_067_207_000
    assert one(spark, times.date_to_ms(F.lit("2024-01-01"))) == 1_704_067_200_000
    assert one(spark, times.date_to_ms(F.lit("no date"))) is None


def test_zone_moves_dates(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert one(spark, times.ms_to_datetime(F.lit(1_704_067_207_179))) == "2024-01-01 08:00:07"
        assert one(spark, times.date_to_ms(F.lit("2024-01-01"))) == 1_704_067_200_000 - 8 * 3_600_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_event_time_of_garbage_is_the_epoch(spark):
    for bad in (F.lit("x"), F.lit(None).cast("string")):
        assert one(spark, F.unix_millis(times.event_time(bad))) == 0


def test_today_is_a_number(spark):
    assert one(spark, times.today_compact()) > 20_200_101


def test_epoch_day(spark):
    assert one(spark, times.epoch_day_to_date(F.lit("0"))) == D(1970, 1, 1)
    assert one(spark, times.epoch_day_to_date(F.lit("x"))) is None


@pytest.mark.parametrize(
    "birth, as_of, years",
    [
        (D(2004, 2, 29), D(2023, 2, 28), 18),
        (D(2004, 2, 29), D(2023, 3, 1), 19),
        (D(2000, 6, 30), D(2024, 6, 30), 24),
        (D(2000, 7, 1), D(2024, 6, 30), 23),
        (D(2000, 1, 31), D(2024, 12, 1), 24),
    ],
)
def test_age(spark, birth, as_of, years):
    assert one(spark, people.age(F.lit(birth), F.lit(as_of))) == years


def test_decade(spark):
    assert [one(spark, people.decade(F.lit(D(y, 1, 1)))) for y in (1989, 1990, 2009)] == [1980, 1990, 2000]


# Last day of each sign and the day after it.
BOUNDS = [
    ((1, 19), "摩羯座", (1, 20), "水瓶座"),
    ((2, 18), "水瓶座", (2, 19), "双鱼座"),
    ((3, 20), "双鱼座", (3, 21), "白羊座"),
    ((4, 19), "白羊座", (4, 20), "金牛座"),
    ((5, 20), "金牛座", (5, 21), "双子座"),
    ((6, 21), "双子座", (6, 22), "巨蟹座"),
    ((7, 22), "巨蟹座", (7, 23), "狮子座"),
    ((8, 22), "狮子座", (8, 23), "处女座"),
    ((9, 22), "处女座", (9, 23), "天秤座"),
    ((10, 23), "天秤座", (10, 24), "天蝎座"),
    ((11, 22), "天蝎座", (11, 23), "射手座"),
    ((12, 21), "射手座", (12, 22), "摩羯座"),
]


def test_zodiac_bounds(spark):
    days = [(D(2000, *d), name) for a, x, b, y in BOUNDS for d, name in ((a, x), (b, y))]
    df = spark.createDataFrame(days, "d date, want string")
    assert df.filter(people.zodiac(F.col("d")) != F.col("want")).count() == 0
    assert one(spark, people.zodiac(F.lit(None).cast("date"))) is None


@pytest.mark.parametrize(
    "value, token",
    [("a,b,,", "b"), (",", ""), ("", ""), ("a", "a"), ("a,b", "b"), ("a, ,", " "), (",,a", "a")],
)
def test_last_token(spark, value, token):
    assert one(spark, text.last_token(F.lit(value))) == token


def test_keys(spark):
    assert one(spark, text.md5_key(F.lit("1201"))) == hashlib.md5(b"1201").hexdigest()
    assert one(spark, text.cache_key(F.lit("dim_sku"), F.lit("7"))) == "dim_sku:7"


def test_names():
    assert text.camel("sink_row_key") == "sinkRowKey"
    assert text.snake("category1Id") == "category1_id"


def test_keywords(spark):
    assert one(spark, text.keywords(F.lit("Red 5G-Phone, été!"))) == ["red", "5g", "phone", "été"]
    han = F.lit("小米手机5G")
    assert one(spark, text.keywords(han)) == ["小", "米", "手", "机", "5g"]
    assert one(spark, text.keywords(han, ["小米", "手机", "手"])) == ["小米", "手机", "5g"]
    # A lexicon entry is text, not a pattern.
    assert one(spark, text.keywords(F.lit("a.b axb"), ["a.b"])) == ["a.b", "axb"]


def test_product_text(spark):
    assert one(spark, money.product_text(F.lit("1"), F.lit("11999"))) == "11999.0000"
