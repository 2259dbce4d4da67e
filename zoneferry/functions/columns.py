"""Column expressions shared by the operators. All of them stay in Catalyst."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def name(column: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col(quoted(column))


def quoted(identifier: str) -> str:
    return "`" + identifier.replace("`", "``") + "`"


def as_column(value: Column | str) -> Column:
    """A column as it is, or SQL text parsed as an expression."""
    return F.expr(value) if isinstance(value, str) else value


def audit_time(run_ts: dt.datetime | str) -> Column:
    """A fixed audit time, the same in every time zone and on every rerun."""
    text = run_ts.isoformat(sep=" ") if isinstance(run_ts, dt.datetime) else run_ts
    return F.lit(text).cast("timestamp_ntz")


def row_json(*columns: str) -> Column:
    """The row, or the named columns of it, as JSON text. Null fields are left out."""
    fields = [name(c) for c in columns] or ["*"]
    return F.to_json(F.struct(*fields))


def digit_count(value: Column, scale: int) -> Column:
    """Digits a number takes in a column of the given scale.

    Sign, decimal point and zeros before the first integer digit do not count.
    A number too large for 38 digits, and NaN, count as 39, so they exceed
    every limit.
    """
    fixed = value.try_cast(f"decimal(38,{scale})")
    digits = F.length(F.regexp_replace(fixed.cast("string"), r"^-?0*|[^0-9]", ""))
    return F.when(value.isNotNull(), F.coalesce(digits, F.lit(39)))


def written_digits(text: Column) -> Column:
    """Digits of a number kept as text, as they are written.

    Sign, point, blanks and leading zeros do not count. Text in another form
    counts as the whole number it casts to, or as 39 digits when it is none.
    """
    plain = text.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$")
    significant = F.regexp_replace(text, r"^\s*[+-]?0*", "")
    digits = F.length(F.regexp_replace(significant, "[^0-9]", ""))
    return F.when(plain, digits).otherwise(digit_count(text, 0))


def where_not(predicate: Column | str) -> Column:
    """The rows a DELETE with this predicate would keep: false or unknown."""
    return ~F.coalesce(as_column(predicate), F.lit(False))
