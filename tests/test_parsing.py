import datetime

import pytest
from pyspark.sql import functions as F

from civiclens.contracts import DAY_PART_LABELS_GREEK
from civiclens.functions.buckets import day_part, day_part_udf
from civiclens.functions.parsing import (
    lenient_double,
    lenient_int,
    money_to_int,
    parse_date_any,
    timer_label,
    timer_seconds,
)


def apply(spark, function, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("t"))).collect()]


TIMES = {
    "0000": "night",
    "0459": "night",
    "0500": "morning",
    "1159": "morning",
    "1200": "afternoon",
    "1659": "afternoon",
    "1700": "evening",
    "2059": "evening",
    "2100": "night",
    "2359": "night",
    "2460": "night",
    "-5": "night",
    "+900": "morning",
    " 45 ": "night",
    "12.7": None,
    "abc": None,
    "": None,
    "9 00": None,
    "99999999999": None,
    "2147483648": None,
    None: None,
}


def test_day_part_borders(spark):
    assert apply(spark, day_part, TIMES) == list(TIMES.values())


def test_day_part_udf_is_the_same(spark):
    assert apply(spark, day_part_udf(), TIMES) == list(TIMES.values())
    assert apply(spark, day_part_udf(), [None, None]) == [None, None]


def test_day_part_labels_are_a_parameter(spark):
    labels = DAY_PART_LABELS_GREEK
    texts = ["0600", "1300", "1800", "2300"]
    assert apply(spark, lambda t: day_part(t, labels), texts) == list(labels)
    assert apply(spark, day_part_udf(labels), texts) == list(labels)


def test_lenient_numbers(spark):
    assert apply(spark, lenient_int, ["0045", " 7 ", "12.7", "x", "", None]) == [45, 7] + [None] * 4
    assert apply(spark, lenient_double, ["34.05", "-118", "x", "", None]) == [
        34.05,
        -118.0,
        None,
        None,
        None,
    ]


DATES = {
    "2010 Feb 20 12:00:00 AM": datetime.date(2010, 2, 20),
    "2010 Feb 20": datetime.date(2010, 2, 20),
    "2010 Feb 20 12/00": datetime.date(2010, 2, 20),
    "02/20/2010 12:00:00 AM": datetime.date(2010, 2, 20),
    "12/31/1999": datetime.date(1999, 12, 31),
    "2/3/2010": None,
    "20/02/2010 12:00:00 AM": None,
    "2010 Foo 20": None,
    "n/a": None,
    "": None,
    None: None,
}


def test_dates_in_either_layout(spark):
    assert apply(spark, parse_date_any, DATES) == list(DATES.values())


def test_date_layouts_are_a_parameter(spark):
    iso = [(1, "yyyy-MM-dd"), (1, "dd.MM.yyyy")]
    texts = ["2010-02-20 x", "20.02.2010", "20/02/2010"]
    day = datetime.date(2010, 2, 20)
    assert apply(spark, lambda t: parse_date_any(t, iso), texts) == [day, day, None]


@pytest.mark.parametrize(
    "text, value",
    [
        ("$52,806", 52806),
        ("52806", 52806),
        (" $1,000 ", 1000),
        ("$-5", -5),
        ("-", None),
        ("", None),
        ("$52806.5", None),
        ("n/a", None),
        (None, None),
    ],
)
def test_money(spark, text, value):
    assert apply(spark, money_to_int, [text]) == [value]


def test_timer_lines(spark):
    lines = [
        "[TIMER] CSV read + count: 1.234 s",
        "[TIMER] hint=(default): part 2: 0.5 s",
        "INFO [TIMER] x: 1.0 s",
        "[TIMER] x: soon",
        None,
    ]
    labels = ["CSV read + count", "hint=(default): part 2", None, None, None]
    assert apply(spark, timer_label, lines) == labels
    assert apply(spark, timer_seconds, lines) == [1.234, 0.5, None, None, None]
