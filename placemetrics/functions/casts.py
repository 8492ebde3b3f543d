"""Casts, flags, rates and times as column functions. Nothing here raises on bad values but ``cast_strict``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TYPES = {"float": "double", "int": "bigint", "string": "string", "timestamp": "timestamp", "date": "date", "bool": "boolean"}
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$|^\s*[+-]?(nan|inf|infinity)\s*$"


def _type(name: str) -> str:
    if name not in TYPES:
        raise ValueError(f"no such logical type: {name}; known are {', '.join(TYPES)}")
    return TYPES[name]


def safe_cast(col: Column, name: str) -> Column:
    """NULL where the text is not of the type; offset timestamps become UTC wall-clock time."""
    done = col.try_cast(_type(name))
    return done.cast("timestamp_ntz") if name == "timestamp" else done


def cast_strict(col: Column, name: str) -> Column:
    return col.cast(_type(name))


def safe_number(col: Column) -> Column:
    """Text to double, refusing the suffixes that Java accepts."""
    return F.when(col.rlike(NUMBER), col.try_cast("double"))


def safe_int(col: Column) -> Column:
    """Decimal-tailed text to bigint, towards zero."""
    return col.try_cast("double").try_cast("bigint")


def flag(col: Column, yes: str = "Y", nullable: bool = False) -> Column:
    return (col == yes) if nullable else F.coalesce(col == yes, F.lit(False))


def safe_divide(n: Column, d: Column) -> Column:
    """NULL where the denominator is 0 or NULL."""
    return n.cast("double") / F.nullif(d.cast("double"), F.lit(0.0))


def rate(n: Column, d: Column, per: float = 1000.0) -> Column:
    return safe_divide(F.lit(per) * n, d)


def percentage(part: Column, whole: Column) -> Column:
    return safe_divide(F.lit(100.0) * part, whole)


def json_scalar(col: Column, path: str) -> Column:
    return F.get_json_object(col, path)


def month(col: Column) -> Column:
    """First day of the month as DATE."""
    return F.trunc(col.try_cast("date"), "MM")


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))).cast("double") / 3600.0


def complete_month(newest: Column) -> Column:
    """The month before the newest one, which is partial."""
    return F.add_months(F.trunc(newest.try_cast("date"), "MM"), -1)


def stable_hash(*cols: Column) -> Column:
    return F.sha2(F.concat_ws("\u0001", *(F.coalesce(c.cast("string"), F.lit("\u0002")) for c in cols)), 256)


def shortened(col: Column, most: int = 120) -> Column:
    return F.when(F.length(col) > most, F.concat(F.substring(col, 1, most - 3), F.lit("..."))).otherwise(col)


def canonical(col: Column, kind: str) -> Column:
    """Text of a value that compares equal across engines: doubles with nine places, NULL and NaN marked."""
    if kind in ("double", "float"):
        text = F.when(F.isnan(col), F.lit("<nan>")).otherwise(F.format_string("%.9f", col.cast("double")))
    elif kind.startswith("timestamp"):
        text = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit("<null>"))
