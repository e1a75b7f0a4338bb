import hashlib
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from txflow.functions import casts, ids, timestamps


def apply(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r[0] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def at(*parts):
    return datetime(*parts, tzinfo=timezone.utc).timestamp()


BATCH_TIMES = {
    "01/15/2020 14:32:05": at(2020, 1, 15, 14, 32, 5),
    "1/5/2020 9:05": at(2020, 1, 5, 9, 5),
    "01/15/2020 02:30:07 PM": at(2020, 1, 15, 14, 30, 7),
    "01/15/2020 12:30 am": at(2020, 1, 15, 0, 30),
    "01/15/2020 12:30 PM": at(2020, 1, 15, 12, 30),
    "2020-01-15 14:32:00": at(2020, 1, 15, 14, 32),
    "2020-01-15T14:32:09": at(2020, 1, 15, 14, 32, 9),
    "2020-1-5 4:3": at(2020, 1, 5, 4, 3),
    "2020-01-15T14:32": at(2020, 1, 15, 14, 32),
    "15-01-2020 14:32:01": at(2020, 1, 15, 14, 32, 1),
    "15-01-2020 14:32": at(2020, 1, 15, 14, 32),
    "2020/01/15 14:32:59": at(2020, 1, 15, 14, 32, 59),
    "2020/01/15 14:32": at(2020, 1, 15, 14, 32),
    "01/15/2020": at(2020, 1, 15),
    "2020-01-15": at(2020, 1, 15),
    "2020/01/15": at(2020, 1, 15),
    "15-01-2020": at(2020, 1, 15),
    "  2020-01-15\t": at(2020, 1, 15),
    "2020-01-15   14:32": at(2020, 1, 15, 14, 32),
    "2020-01-15\t14:32": at(2020, 1, 15, 14, 32),
    "01/ 5/2020": at(2020, 1, 5),
    "02/29/2020": at(2020, 2, 29),
    "1/15/2020": at(2020, 1, 15),
    "1/15/2020 1:02 pm": at(2020, 1, 15, 13, 2),
    "5-11-2020 1:2:3": at(2020, 11, 5, 1, 2, 3),
}
BAD_TIMES = [
    None, "", "   ", "32/01/2020", "15/01/2020", "02/30/2020", "02/29/2019", "2020-01-15T14:32:00Z",
    "2020-01-15 14:32:00.5", "2020-01-15 24:00", "2020-01-15 10:60", "2020-01-15 10:10:60", "01/15/2020 13:30 PM",
    "01/15/2020 00:30 AM", "01/15/20", "20200115", "2020-13-01", "2020-00-10", "not a date", "2020-01-15 10",
    "01/15/2020T10:00", "2020/01/15T10:00", "2020-01-15 10:00 PM", "001/15/2020", "+2020-01-15", "2020-01-15 -1:00",
]


def test_batch_timestamps(spark):
    out = apply(spark, [*BATCH_TIMES, *BAD_TIMES], lambda c: timestamps.epoch_seconds(timestamps.parse_batch(c)))
    assert out[:len(BATCH_TIMES)] == [int(v) for v in BATCH_TIMES.values()]
    assert dict(zip(BAD_TIMES, out[len(BATCH_TIMES):])) == dict.fromkeys(BAD_TIMES)


def test_batch_timestamps_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = apply(spark, list(BATCH_TIMES), lambda c: F.unix_seconds(timestamps.parse_batch(c)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out == [int(v) for v in BATCH_TIMES.values()]


def test_stream_timestamps(spark):
    good = ["2026-02-17T09:05:00.000001Z", "2026-02-17T09:05:00+00:00", "2026-02-17 09:05Z", "2026-02-17T09:05"]
    misshapen = ["not-a-date", "2026-02-17T09:05:00+05:30", "2026-02-17", "2026-2-17T09:05", "", None,
                 "2026-02-17T09:05:00z"]
    outside = ["2026-99-99T99:99Z"]
    values = good + misshapen + outside
    assert apply(spark, values, timestamps.stream_shape_ok) == [True] * 4 + [False] * 7 + [True]
    parsed = apply(spark, values, lambda c: F.unix_micros(timestamps.parse_stream(c)))
    base = int(at(2026, 2, 17, 9, 5)) * 1_000_000
    assert parsed[:4] == [base + 1, base, base, base] and parsed[-1] is None


def test_iso_text(spark):
    out = apply(spark, ["2024-01-01 00:00:11.500000", "2024-01-01 10:00:00"],
                lambda c: timestamps.iso_utc(c.cast("timestamp")))
    assert out == ["2024-01-01T00:00:11.5Z", "2024-01-01T10:00:00Z"]


def test_whole_seconds_are_signed_and_rounded_down(spark):
    df = spark.sql("select timestamp'2024-01-01 00:00:10' a, timestamp'2024-01-01 00:00:11.9' b")
    row = df.select(timestamps.whole_seconds(F.col("a"), F.col("b")).alias("f"),
                    timestamps.whole_seconds(F.col("b"), F.col("a")).alias("r")).first()
    assert (row.f, row.r) == (1, -2)


@pytest.mark.parametrize(("text", "expected"), [
    ("Yes", 1), ("TRUE", 1), ("t", 1), ("1", 1), ("No", 0), ("f", 0), ("0", 0), ("2", 2), ("maybe", None),
    (" yes ", None), ("", None), (None, None)])
def test_fraud_flag(spark, text, expected):
    assert apply(spark, [text], casts.flag) == [expected]


def test_cast_failures_name_fields_in_order(spark):
    columns = "amt lat long latitude longitude city_pop is_fraud".split()
    rows = [("N/A", "x", "1", "", " ", "1.5", "maybe"), ("1e3", "-1", None, "2", "3", "7", "no"), (None,) * 7]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    assert [r[0] for r in df.select(casts.cast_failures()).collect()] == [
        ["amt", "lat", "city_pop", "is_fraud"], [], []]


def test_json_text_keeps_absent_fields(spark):
    df = spark.createDataFrame([("a", None)], "`x y` string, z string")
    assert df.select(casts.as_json("x y", "z")).first()[0] == '{"x y":"a","z":null}'


def test_hash_id_normalises_and_keeps_missing_parts(spark):
    df = spark.createDataFrame([(" Ab\t", None, " C ")], "a string, b string, c string")
    out = df.select(ids.hash_id(F.col("a"), F.col("b"), F.col("c"))).first()[0]
    assert out == hashlib.sha256(b"ab||c").hexdigest()


def test_coordinates_round_and_print_like_shortest_decimals(spark):
    rng = random.Random(7)
    values = [39.123445, 39.123435, -71.0, 0.0, 0.5, 2e-05, 0.000015, -0.000004, 1e-4, 0.00123, 179.999995, 12.3]
    values += [round(rng.uniform(-180, 180), 6) for _ in range(3000)]
    values += [rng.uniform(-1e-3, 1e-3) for _ in range(300)]
    assert apply(spark, values, ids.coordinate_text, "double") == [f"{round(v, 5)}" for v in values]


def test_texts_that_are_not_tried_give_no_number(spark):
    texts = ["1", " 1 ", "\t12\n", "+7", "-3", "1.5", "12abc", "north", " yes ", "", " ", None, "1e3", "1E3", "1d", "0x1p3", "NaN", "Infinity",
             "-inf", "٣", "2147483648", "1,5", ".5", "5.", "e5"]
    assert apply(spark, texts, casts.whole) == apply(spark, texts, lambda c: c.try_cast("int"))
    assert [None if v is None else repr(v) for v in apply(spark, texts, lambda c: casts.lenient(c, "double"))] == [
        None if v is None or v - v != 0 else repr(v) for v in apply(spark, texts, lambda c: c.try_cast("double"))]


def test_dates_that_are_not_tried_are_none(spark):
    import calendar

    for shape in ("{m}/{d}/{y}", "{d}-{m}-{y}", "{y}-{m}-{d}", "{y}/{m}/{d} 1:2"):
        days = [(y, m, d) for y in (2019, 2020) for m in range(0, 14) for d in range(0, 34)]
        out = apply(spark, [shape.format(y=y, m=m, d=d) for y, m, d in days], timestamps.parse_batch)
        good = [1 <= m <= 12 and 1 <= d <= calendar.monthrange(y, m)[1] for y, m, d in days]
        assert [v is not None for v in out] == good
