"""Column expressions of the refinement steps.

All of them are built-in Spark expressions, so they stay inside generated code
and filters on them can be optimised. Each takes and returns a Column. Text that
does not parse yields null; `strict=True` raises instead.
"""

from __future__ import annotations

import re

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

LATE_AFTER = 15  # a delay above this many units is "late"


def _or_raise(value: Column, message: str) -> Column:
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(message)))


def as_int(c: Column) -> Column:
    """Whole number of a number or a text; '1.2' gives 1, other text null."""
    return F.coalesce(c.try_cast("int"), c.try_cast("double").try_cast("int"))


def as_double(c: Column) -> Column:
    return c.try_cast("double")


def date_string(year: Column, month: Column, day: Column, strict: bool = False) -> Column:
    """Zero-padded YYYYMMDD text. No calendar check; null if any part is null."""
    y, m, d = parts = [p.try_cast("int") for p in (year, month, day)]
    known = reduce(and_, [p.isNotNull() for p in parts])
    # Formatting is slow; within the usual ranges one padded number gives the same text.
    usual = y.between(0, 9999) & m.between(0, 99) & d.between(0, 99)
    packed = F.lpad((y * 10000 + m * 100 + d).cast("string"), 8, "0")
    text = F.when(usual, packed).when(known, F.format_string("%04d%02d%02d", *parts))
    if strict:
        return _or_raise(text, "date_string: year, month and day must be whole numbers")
    return text


def hour_base10(hhmm: Column, strict: bool = False) -> Column:
    """'741' or '0741' -> 7.6833…; null for null, other lengths, hour > 23 or minute > 59."""
    text = hhmm.cast("string")
    padded = F.lpad(text, 4, "0")
    hour = F.substring(padded, 1, 2).try_cast("int")
    minute = F.substring(padded, 3, 2).try_cast("int")
    valid = F.length(text).between(1, 4) & hour.between(0, 23) & minute.between(0, 59)
    value = F.when(valid, hour + minute / F.lit(60.0))
    if strict:
        return _or_raise(value, "hour_base10: expected HHMM between 0000 and 2359")
    return value


def delay_label(delay: Column) -> Column:
    """1 when late, 0 when on time or unknown."""
    return F.when(as_int(delay) > LATE_AFTER, 1).otherwise(0)


def or_default(c: Column, default) -> Column:
    return F.coalesce(c, F.lit(default))


def trace_as_zero(c: Column) -> Column:
    """A trace amount, written 'T', counts as zero."""
    return F.when(c == "T", F.lit("0.0")).otherwise(c)


def amount(c: Column) -> Column:
    return as_double(trace_as_zero(c))


def whole_amount(c: Column) -> Column:
    return as_int(trace_as_zero(c))


def trimmed_equals(c: Column, text: str) -> Column:
    return F.trim(c) == text


def joined(*parts: Column) -> Column:
    """Concatenation; null if any part is null."""
    return F.concat(*parts)


def part_of(c: Column, separator: str, position: int) -> Column:
    """Zero-based part of a text separated by a literal string; null when there are fewer parts."""
    return F.get(F.split(c, re.escape(separator)), F.lit(position))


def year_of(c: Column) -> Column:
    return F.year(c)


def month_of(c: Column) -> Column:
    return F.month(c)


def day_of(c: Column) -> Column:
    return F.dayofmonth(c)


def day_key(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def scaled_int(c: Column, factor: float = 100.0) -> Column:
    """Scale and cut toward zero, in double arithmetic: 0.29 -> 28. Null stays null."""
    return (c.cast("double") * F.lit(float(factor))).try_cast("int")


def following_years(year: int, count: int = 3) -> list[int]:
    return [int(year) + i for i in range(count)]
