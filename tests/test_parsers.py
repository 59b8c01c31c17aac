"""Parsers against value tables and against Python's own int/float/isoparse."""

import datetime as dt
import math
import random

import pytest
from dateutil import parser as iso
from pyspark.sql import functions as F

from lakeload.functions import blank_to_null, parse_as, parse_date, parse_double, parse_long, parse_timestamp

BLANKS = [None, "", "  ", "\t", "\n", "\v", "\f", "\r", "\x1c", "\x85", " ", " ", "　"]


def run(spark, values, type_name, strict=False):
    rows = [(i, v) for i, v in enumerate(values)]
    value = parse_as("s", type_name, strict)
    if type_name == "timestamp":
        value = F.unix_micros(value)
    out = spark.createDataFrame(rows, "i int, s string").select("i", value.alias("v")).collect()
    return [r.v for r in sorted(out, key=lambda r: r.i)]


@pytest.mark.parametrize("type_name", ["long", "double", "date", "timestamp"])
def test_blank_text_is_null_even_when_strict(spark, type_name):
    assert run(spark, BLANKS, type_name, strict=True) == [None] * len(BLANKS)


def test_blank_to_null_keeps_other_text(spark):
    rows = spark.createDataFrame([(b,) for b in [*BLANKS, " a ", "0"]], "s string").select(blank_to_null("s").alias("v"))
    assert [r.v for r in rows.collect()] == [None] * len(BLANKS) + [" a ", "0"]


def test_long_values(spark):
    values = ["1", "-9223372036854775808", "9223372036854775807", "+5", " 12 ", "1_000", "007", "١٢", " 12", "\U0001d7d8"]
    assert run(spark, values, "long", strict=True) == [int(v) for v in values]


def test_double_values(spark):
    values = ["123.45", "-123.45", "1.", ".5", "1e3", "-1E-3", "1_0.5", "inf", "-Infinity", "+inf", "1e400", " 2.5\t", "١.5", "0.1"]
    assert run(spark, values, "double", strict=True) == [float(v) for v in values]
    assert all(math.isnan(v) for v in run(spark, ["nan", "-NaN", "+nan"], "double", strict=True))


def test_date_values(spark):
    cases = {
        "2022-01-01": dt.date(2022, 1, 1),
        "20220102": dt.date(2022, 1, 2),
        "2022-01-03 23:34:56": dt.date(2022, 1, 3),
        "2022-01-03 23:34:56-04:00": dt.date(2022, 1, 3),
        "2022-W01-1": dt.date(2022, 1, 3),
        "2022-001": dt.date(2022, 1, 1),
        "2022001": dt.date(2022, 1, 1),
        "2022": dt.date(2022, 1, 1),
        "2022-03": dt.date(2022, 3, 1),
        "2022-01-01T24:00": dt.date(2022, 1, 2),
        "0001-01-01": dt.date(1, 1, 1),
        "9999-12-31": dt.date(9999, 12, 31),
    }
    assert run(spark, list(cases), "date", strict=True) == list(cases.values())


def test_timestamp_values(spark):
    cases = {
        "2022-01-01 12:34:56": dt.datetime(2022, 1, 1, 12, 34, 56),
        "2022-01-01 12:34:56-04:00": dt.datetime(2022, 1, 1, 16, 34, 56),
        "20220102 12:34:56": dt.datetime(2022, 1, 2, 12, 34, 56),
        "2022-01-03": dt.datetime(2022, 1, 3),
        "2022-01-03T23:59:59.1234567Z": dt.datetime(2022, 1, 3, 23, 59, 59, 123456),
        "2022-01-03T235959,5+0530": dt.datetime(2022, 1, 3, 18, 29, 59, 500000),
        "2022-01-03T12+05": dt.datetime(2022, 1, 3, 7),
        "2022-01-03T24:00": dt.datetime(2022, 1, 4),
        "2022-01-03T00:00:00+23:59": dt.datetime(2022, 1, 2, 0, 1),
        "2022-001T01:02": dt.datetime(2022, 1, 1, 1, 2),
    }
    assert run(spark, list(cases), "timestamp", strict=True) == [micros(v) for v in cases.values()]


def test_timestamp_does_not_depend_on_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    values = ["2022-07-01 12:34:56", "2022-07-01", "20220701T123456", "2022-07-01 12:34:56+02:00"]
    expected = run(spark, values, "timestamp")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert run(spark, values, "timestamp") == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    ("parse", "text"),
    [
        (parse_long, "123_error"),
        (parse_long, "9223372036854775808"),
        (parse_long, "12.5"),
        (parse_long, "1e3"),
        (parse_double, "123.45_error"),
        (parse_double, "1.5d"),
        (parse_double, "0x1p3"),
        (parse_date, "2022-01-01_123_error"),
        (parse_date, "202201"),
        (parse_date, "12022-01-01"),
        (parse_date, "2022-1-1"),
        (parse_date, "2022-02-30"),
        (parse_timestamp, "2022-01-01 12:34:56_error"),
        (parse_timestamp, "12:34:56"),
        (parse_timestamp, "2022-01-01 12:34:56 America/New_York"),
        (parse_timestamp, "2022-01-01 25:00:00"),
    ],
)
def test_strict_parsing_fails_with_the_quoted_text(spark, parse, text):
    df = spark.createDataFrame([(text,)], "s string").select(parse("s").alias("v"))
    with pytest.raises(Exception, match="USER_RAISED_EXCEPTION") as failure:
        df.collect()
    assert f"'{text}'" in str(failure.value)
    assert spark.createDataFrame([(text,)], "s string").select(parse("s", strict=False).alias("v")).first().v is None


def micros(value):
    return (value - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def python_timestamp(text):
    try:
        value = iso.isoparse(text)
    except (ValueError, OverflowError):
        return None
    if value.tzinfo:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return micros(value)


def python_date(text):
    try:
        return iso.isoparse(text).date()
    except (ValueError, OverflowError):
        return None


def iso_samples(count, seed=20240101):
    """Valid ISO texts of every form, and near misses made from them."""
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        year = f"{rng.randint(2, 9998):04d}"
        dash = rng.choice(["-", ""])
        day = rng.choice(
            [
                f"{year}{dash}{rng.randint(1, 12):02d}{dash}{rng.randint(1, 31):02d}",
                f"{year}{dash}{rng.randint(0, 367):03d}",
                f"{year}{dash}W{rng.randint(0, 54):02d}{dash}{rng.randint(0, 8)}",
                rng.choice([year, f"{year}-{rng.randint(0, 13):02d}", f"{year}{dash}W{rng.randint(0, 54):02d}"]),
            ]
        )
        text = day
        if rng.random() < 0.7:
            colon = rng.choice([":", ""])
            hour = rng.choice([f"{rng.randint(0, 23):02d}"] * 6 + ["24", "25"])
            minute, second = (f"{rng.choice([rng.randint(0, 59), 0, 60]):02d}" for _ in range(2))
            fraction = rng.choice(["", "", ".5", ",123", ".1234567", ".000000", ".0000001"])
            clock = rng.choice([hour, hour + colon + minute, hour + colon + minute + colon + second + fraction])
            if rng.random() < 0.1:
                clock = f"24{colon}00{colon}00{fraction}"
            zone = rng.choice(["", "", "Z", "z", "-04:00", "+0530", "+05", "-23:59", "+24:00", "+18:30", "+05:60"])
            text = day + rng.choice(["T", " ", "T", " ", "x", "5", "-", "\n"]) + clock + zone
        if rng.random() < 0.25 and text:
            at = rng.randrange(len(text))
            text = rng.choice(
                [text[:at] + text[at + 1 :], text[:at] + rng.choice("0159:-+.WTZ x") + text[at:], text + rng.choice("0Z:x\n")]
            )
        out.append(text)
    return out


def test_iso_grammar_agrees_with_isoparse(spark):
    texts = iso_samples(12000)
    dates, stamps = run(spark, texts, "date"), run(spark, texts, "timestamp")
    wrong, missed, valid = [], [], 0
    for text, got_date, got_stamp in zip(texts, dates, stamps):
        want_date, want_stamp = python_date(text), python_timestamp(text)
        valid += want_stamp is not None
        if want_stamp is not None and got_stamp is None:
            missed.append(text)
        elif got_stamp != want_stamp or got_date != want_date:
            wrong.append((text, got_date, want_date, got_stamp, want_stamp))
    assert not wrong, wrong[:20]
    assert valid > 3000
    assert not missed, missed[:40]


def test_numbers_agree_with_python(spark):
    rng = random.Random(7)
    texts = []
    for _ in range(4000):
        text = "".join(rng.choice("0123456789") for _ in range(rng.randint(1, 21)))
        if rng.random() < 0.5:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(["_", ".", "e", "-", "+", " ", "E5", "٣", "d", "x", "__"]) + text[at:]
        texts.append(rng.choice(["", "", "-", "+", " "]) + text)

    def want(read, text):
        try:
            return read(text)
        except ValueError:
            return None

    for text, got in zip(texts, run(spark, texts, "long")):
        expected = want(int, text)
        if expected is not None and not -(2**63) <= expected < 2**63:
            expected = None
        assert got == expected, text
    for text, got in zip(texts, run(spark, texts, "double")):
        assert got == want(float, text), text
