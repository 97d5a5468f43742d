"""User label columns: age, birth decade and zodiac sign."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Last month*100+day of each sign, in calendar order. The first and the last
# sign are one sign that spans the turn of the year.
SIGN_ENDS = (
    (119, "摩羯座"),
    (218, "水瓶座"),
    (320, "双鱼座"),
    (419, "白羊座"),
    (520, "金牛座"),
    (621, "双子座"),
    (722, "巨蟹座"),
    (822, "狮子座"),
    (922, "处女座"),
    (1023, "天秤座"),
    (1122, "天蝎座"),
    (1221, "射手座"),
    (1231, "摩羯座"),
)


def month_day(date: Column) -> Column:
    return F.month(date) * 100 + F.dayofmonth(date)


def age(birth: Column, as_of: Column) -> Column:
    """Whole years lived; a year counts once its month and day are reached."""
    early = (month_day(as_of) < month_day(birth)).cast("int")
    return F.year(as_of) - F.year(birth) - early


def decade(birth: Column) -> Column:
    return (F.floor(F.year(birth) / 10) * 10).cast("int")


def zodiac(birth: Column) -> Column:
    day = month_day(birth)
    sign = F.when(day <= SIGN_ENDS[0][0], SIGN_ENDS[0][1])
    for end, name in SIGN_ENDS[1:]:
        sign = sign.when(day <= end, name)
    return sign
