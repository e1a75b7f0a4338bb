"""Timestamp text in the accepted shapes, epoch arithmetic, lag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: accepted batch timestamp shapes --------------------------
# month/day/year, year-month-day, day-month-year and year/month/day, each with
# nothing, H:M or H:M:S behind; the first also with AM/PM, the second also with T.
_CLOCK = r"\d{1,2}:\d{1,2}(?::\d{1,2})?"
BATCH_SHAPES = [
    rf"\d{{1,2}}/\d{{1,2}}/\d{{4}}(?:\s{_CLOCK}(?:\s[AP]M)?)?",
    rf"\d{{4}}-\d{{1,2}}-\d{{1,2}}(?:[\sT]{_CLOCK})?",
    rf"\d{{1,2}}-\d{{1,2}}-\d{{4}}(?:\s{_CLOCK})?",
    rf"\d{{4}}/\d{{1,2}}/\d{{1,2}}(?:\s{_CLOCK})?",
]
# Stream timestamps after an optional Z or +00:00 is taken off.
STREAM_SHAPE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"
STREAM_SUFFIX = r"(Z|\+00:00)$"
# --- end of fixed values ----------------------------------------------------

#: Dates with a month of 1 to 12 and a day of 1 to 31. Others are not tried: a failed cast raises an error inside, which is dear.
_M, _D = r"(?:0?[1-9]|1[0-2])", r"(?:0?[1-9]|[12]\d|3[01])"
_POSSIBLE = rf"^(?:{_M}/{_D}/\d{{4}}|{_D}-{_M}-\d{{4}}|\d{{4}}[-/]{_M}[-/]{_D})(?!\d)"

#: Characters taken off both ends of a text value.
BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    chr(c) for c in range(0x2000, 0x200B))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def batch_text(text: Column) -> Column:
    """Timestamp text in upper case, trimmed, with single blanks. Keep it as a column before parsing it."""
    return F.regexp_replace(F.upper(strip(text)), r"(?<=[-/]) (?=[1-9])|\s+(?=\s)", "")


def parse_batch_text(clean: Column) -> Column:
    """Timestamp from any accepted batch shape, null for anything else.

    The shape is tested once; the date is then turned around to ISO order and
    cast, which checks the ranges. No pattern is tried and failed per row.
    """
    slashes, year_first = clean.contains("/"), clean.rlike(r"^\d{4}")
    iso = (F.when(year_first, F.replace(clean, F.lit("/"), F.lit("-")))
           .when(slashes, F.regexp_replace(clean, r"^(\d+)/(\d+)/(\d+)", "$3-$1-$2"))
           .otherwise(F.regexp_replace(clean, r"^(\d+)-(\d+)-(\d+)", "$3-$2-$1")))
    colons = F.length(clean) - F.length(F.replace(clean, F.lit(":")))
    rest = F.when(colons == 0, " 0:0:0Z").when(colons == 1, ":0Z").otherwise("Z")
    spaced = F.when(clean.rlike(r"[\t\x0b\f\r\n]"), F.translate(iso, "\t\x0b\x0c\r\n", "     ")).otherwise(iso)
    plain = F.concat(spaced, rest).try_cast("timestamp")
    half_day = F.when(colons == 1, F.regexp_replace(clean, r"\s(?=[AP])", ":0 ")).otherwise(clean)
    spoken = F.try_to_timestamp(F.concat(F.regexp_replace(half_day, r"\s", " "), F.lit("Z")),
                                F.lit("M/d/yyyy h:m:s aX"))
    shaped = clean.rlike("^(?:" + "|".join(BATCH_SHAPES) + ")$")
    return F.when(shaped & clean.rlike(_POSSIBLE), F.when(clean.endswith("M"), spoken).otherwise(plain))


def parse_batch(text: Column) -> Column:
    return parse_batch_text(batch_text(text))


def stream_shape_ok(text: Column) -> Column:
    return F.coalesce(F.regexp_replace(text, STREAM_SUFFIX, "").rlike(STREAM_SHAPE), F.lit(False))


def parse_stream(text: Column) -> Column:
    """Timestamp from an ISO text in UTC, null if its digits are out of range."""
    bare = F.regexp_replace(text, STREAM_SUFFIX, "")
    full = F.when(F.length(bare) == 16, F.concat(bare, F.lit(":00"))).otherwise(bare)
    return F.when(text.rlike("[0-9]"), F.concat(full, F.lit("Z")).try_cast("timestamp"))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts)


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def iso_utc(ts: Column) -> Column:
    """UTC text with as many decimals as needed, e.g. ``2024-01-01T00:00:11.5Z``."""
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"\.?0+$", ""), F.lit("Z"))


def whole_seconds(start: Column, end: Column) -> Column:
    """Signed seconds from ``start`` to ``end``, rounded down."""
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000)).cast("long")
