"""Column expressions: golden rows, and comparison with plain Python on generated texts."""

import re
from datetime import date, datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keystitch.functions.days import day_span, yesterday
from keystitch.functions.hours import is_bad_hour, is_hour, normalize_hour
from keystitch.functions.numbers import finite, parse_number, whole
from keystitch.functions.stamps import modified_after, parse_stamp
from keystitch.functions.text import SCRIPT_BLANKS, any_has_text, empty_to_null, script_trim, text_differs

SOME = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def apply(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, v {kind}")
    return [r[1] for r in sorted(df.select("i", expression(F.col("v"))).collect())]


HOURS = {
    "09:30": "09:30",
    "09:30:15": "09:30",
    "093015": "09:30",
    " 09:30 ": "09:30",
    " 09:30\t\n": "09:30",
    "5": "00:00",
    "0930": "00:09",
    "93015": "09:30",
    "9:30": None,
    "99:99": "99:99",
    "1234567": "12:34",
    "09:30:1": None,
    "": None,
    "   ": None,
    "ab": None,
    None: None,
}


def test_normalize_hour(spark):
    got = apply(spark, HOURS, lambda c: normalize_hour(script_trim(c)))
    assert got == list(HOURS.values())


@SOME
@given(st.lists(st.text(alphabet="0123456789: \n", max_size=9), min_size=1, max_size=200))
def test_normalize_hour_like_plain_python(spark, texts):
    def plain(text):
        text = text.strip(SCRIPT_BLANKS)
        if re.fullmatch(r"[0-9]{2}:[0-9]{2}(:[0-9]{2})?", text):
            return text[:5]
        if re.fullmatch(r"[0-9]+", text):
            padded = text.rjust(6, "0")
            return f"{padded[:2]}:{padded[2:4]}"
        return None

    assert apply(spark, texts, lambda c: normalize_hour(script_trim(c))) == [plain(t) for t in texts]


def test_hour_shapes(spark):
    values = ["09:30", "09:30\n", "9:30", "09:3:", "09:3:\n", "9:3:", None]
    assert apply(spark, values, is_hour) == [True, False, False, False, False, False, False]
    assert apply(spark, values, is_bad_hour) == [False, False, False, True, False, False, False]


def test_numbers(spark):
    numbers = {
        "12.5": 12.5,
        " 7 ": 7.0,
        " 7﻿": 7.0,
        ".5": 0.5,
        "5.": 5.0,
        "-1e-2": -0.01,
        "": None,
        "1d": None,
        "NaN": None,
        "Infinity": None,
        "1e999": None,
        "x": None,
        "1 2": None,
        None: None,
    }
    assert apply(spark, numbers, lambda c: finite(parse_number(c))) == list(numbers.values())
    wholes = {"3": 3, "3.0": 3, "3e0": 3, "3.5": None, "": None, "99999999999": None, "1e999": None}
    assert apply(spark, wholes, lambda c: whole(parse_number(c))) == list(wholes.values())


def test_text_rules(spark):
    blanks = "\t ﻿ x y　\n\x0b"
    assert apply(spark, [blanks, None, "  ", "a"], script_trim) == ["x y", None, "", "a"]
    assert apply(spark, ["", " ", None, "a"], empty_to_null) == [None, " ", None, "a"]
    pairs = [("a", " a "), (None, ""), (None, " \t"), ("a", None), ("a", "b"), (None, None), ("x ", "x")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i long, a string, b string")
    got = [r[1] for r in sorted(df.select("i", text_differs(F.col("a"), F.col("b"))).collect())]
    assert got == [False, False, False, True, True, False, False]
    some = spark.createDataFrame(
        [(1, None, "  "), (2, "x", None), (3, "", ""), (4, None, None), (5, "\t", None)], "i int, a string, b string"
    )
    # only blanks count as empty at the source, a tab does not
    assert [r.i for r in some.filter(any_has_text([F.col("a"), F.col("b")])).orderBy("i").collect()] == [2, 5]


def test_stamps(spark):
    stamps = {
        "06/01/2025 10:20:30:400": datetime(2025, 6, 1, 10, 20, 30, 400000),
        "02/29/2025 00:00:00:000": None,
        "2025-06-01": None,
        "": None,
        None: None,
    }
    assert apply(spark, stamps, parse_stamp) == list(stamps.values())
    mark = F.lit("2024-01-01 00:00:00").cast("timestamp")
    texts = [
        "01/01/2024 00:00:00:000",
        "01/01/2024 00:00:00:001",
        "12/31/2023 23:59:59:999",
        "12/30/1899 00:00:00:000",
        "bad",
        "",
        None,
    ]
    after = [False, True, False, False, False, False, False]
    assert apply(spark, texts, lambda c: modified_after(c, mark)) == after
    assert not any(apply(spark, texts, lambda c: modified_after(c, F.lit(None).cast("timestamp"))))


@pytest.mark.parametrize("zone", ["UTC", "America/Mexico_City", "Asia/Tokyo"])
def test_yesterday_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        one = spark.range(1)
        late, early = datetime(2024, 2, 3, 5, 59), datetime(2024, 2, 3, 6, 0, tzinfo=timezone.utc)
        got = one.select(yesterday(late).alias("a"), yesterday(early).alias("b")).first()
        assert tuple(got) == (date(2024, 2, 1), date(2024, 2, 2))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_day_span_never_counts_down(spark):
    one = spark.range(1)
    a, b = F.lit(date(2024, 2, 28)), F.lit(date(2024, 3, 1))
    assert len(one.select(day_span(a, b)).first()[0]) == 3
    assert one.select(day_span(b, a)).first()[0] is None
