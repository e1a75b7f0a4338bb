"""Lenient casts and the checks built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txflow.schemas import CAST_CHECKED, FALSE_WORDS, TRUE_WORDS


def flag(text: Column) -> Column:
    """Fraud flag words to 1 or 0; other whole numbers stay, the rest is null."""
    word = F.lower(text)
    return (F.when(word.isin(TRUE_WORDS), F.lit(1))
            .when(word.isin(FALSE_WORDS), F.lit(0))
            .otherwise(whole(text)))


def lenient(text: Column, kind: str) -> Column:
    """Cast that yields null instead of failing; NaN and infinities are no numbers."""
    if kind == "flag":
        return flag(text)
    return finite(number(text)) if kind == "double" else whole(text) if kind == "int" else text.try_cast(kind)


def number(text: Column) -> Column:
    """Cast to double. Words without a digit are not tried: a failed cast raises an error inside, which is dear."""
    return F.when(text.rlike("[0-9]"), text.try_cast("double"))


def whole(text: Column) -> Column:
    """Cast to int, not tried for words either."""
    return F.when(text.rlike("^[^A-Za-z]*[0-9][^A-Za-z]*$"), text.try_cast("int"))


def finite(value: Column) -> Column:
    return F.when(F.abs(value) < float("inf"), value)


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.length(F.trim(text)) == 0)


def lost_in_cast(text: Column, typed: Column) -> Column:
    """True where something was written but nothing came out of the cast."""
    return typed.isNull() & ~is_blank(text)


def names_where(checks: list[tuple[str, Column]]) -> Column:
    """Names of the checks that hold, in order."""
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in checks]))


def cast_failures(typed: dict[str, str] | None = None) -> Column:
    """Array of the canonical fields whose text did not survive its cast.

    ``typed`` names the columns that hold the casts already, by field.
    """
    def result(field: str, kind: str) -> Column:
        return F.col(typed[field]) if typed else lenient(F.col(field), kind)

    return names_where([(c, lost_in_cast(F.col(c), result(c, kind))) for c, kind in CAST_CHECKED])


def as_json(*columns: str) -> Column:
    """The row as JSON text, absent fields included."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})
