"""Validity and conversion of text fields as Catalyst expressions: no Python on the row path, and nothing that throws under ANSI mode.

Semantics are those of Python's int(), Decimal() and strict strptime(), within the limits the README names (ASCII digits; offsets up to 18 hours).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftwright.contract import ColumnContract
from siftwright.errors import DECIMAL_PRECISION_EXCEEDED, INVALID_DATE_FORMAT, INVALID_TIMESTAMP_FORMAT, TYPE_MISMATCH

# Strptime directives, the digits they take, and their Java pattern letters.
_DIRECTIVES = {
    "%Y": (r"[0-9]{4}", "yyyy"),
    "%m": (r"(?:1[0-2]|0[1-9]|[1-9])", "M"),
    "%d": (r"(?:3[0-1]|[1-2][0-9]|0[1-9]|[1-9])", "d"),
    "%H": (r"(?:2[0-3]|[0-1][0-9]|[0-9])", "H"),
    "%M": (r"(?:[0-5][0-9]|[0-9])", "m"),
    "%S": (r"(?:[0-5][0-9]|[0-9])", "s"),
    "%z": (r"(?:[+-](?:[0-1][0-9]|2[0-3]):?[0-5][0-9]|Z)", "[XXX][XX]"),
}
_TIME = ("%H", "%M", "%S", "%z")
# White space of Python's strip().
_BLANK = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


@dataclass(frozen=True)
class TimeFormat:
    """A strptime format as a guard (a regular expression over the whole text) and a Java pattern."""

    regex: str
    pattern: str
    has_time: bool


def time_format(fmt: str) -> TimeFormat:
    """Numbers that touch, as in ``%Y%m%d``, need their full width; others may lack a leading zero."""
    tokens = re.findall(r"%.|[^%]+|%$", fmt, re.S)
    numbers = [t in _DIRECTIVES and t != "%z" for t in tokens]
    regex, pattern = "", ""
    for k, token in enumerate(tokens):
        if token in _DIRECTIVES:
            digits, letters = _DIRECTIVES[token]
            touches = numbers[k] and (k > 0 and numbers[k - 1] or k + 1 < len(tokens) and numbers[k + 1])
            if touches and len(letters) == 1:
                digits, letters = re.sub(r"\|\[\d-\d\]\)$", ")", digits), letters * 2
            regex += digits
            pattern += letters
        elif token[0] == "%" and token != "%%":
            raise ValueError(f"directive {token!r} is not supported")
        else:
            text = token.replace("%%", "%")
            regex += re.escape(text)
            pattern += "'" + text.replace("'", "''") + "'"
    return TimeFormat(f"^{regex}$", pattern, any(t in tokens for t in _TIME))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def stripped(c: Column) -> Column:
    """Without surrounding white space of any kind (trim alone takes spaces only)."""
    return F.btrim(c, F.lit(_BLANK))


def parsed_time(c: Column, fmt: str) -> Column:
    """The instant, or null where the text isn't in the format. The guard keeps what Java takes and strptime doesn't apart."""
    f = time_format(fmt)
    year_one = ~c.rlike(r"^0000") if fmt.startswith("%Y") else F.lit(True)
    return F.when(c.rlike(f.regex) & year_one, F.try_to_timestamp(c, F.lit(f.pattern)))


def integer(c: Column) -> Column:
    return let(stripped(c), lambda t: F.when(t.rlike(r"^[+-]?[0-9]+(?:_[0-9]+)*$"), F.regexp_replace(t, "_", "")).try_cast("decimal(38,0)"))


def boolean(c: Column) -> Column:
    return let(F.lower(stripped(c)), lambda t: F.when(t.isin("true", "1"), True).when(t.isin("false", "0"), False))


def _number(c: Column) -> Column:
    """The text without white space around it and ``_``."""
    return F.regexp_replace(stripped(c), "_", "")


_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
def is_number(c: Column) -> Column:
    return _number(c).rlike(_NUMBER)


#: Exponents beyond this are as good as infinite.
_HUGE = 10**15


def decimal_digits(c: Column) -> Column:
    """A struct of ``precision`` and ``scale``: digits of the value in all and after the point, as it is written; null where it isn't a number."""

    def of_parts(p: Column) -> Column:
        e = p.x - p.fraction
        return let(F.struct(p.digits.alias("digits"), e.alias("e")), lambda q: F.struct(F.when(q.e >= 0, q.digits + q.e).otherwise(F.greatest(q.digits, -q.e)).alias("precision"), F.greatest(F.lit(0).cast("long"), -q.e).alias("scale")))

    def of_text(t: Column) -> Column:
        mantissa, exponent = F.regexp_extract(t, r"^[+-]?([0-9.]+)", 1), F.regexp_extract(t, r"[eE]([+-]?[0-9]+)$", 1)
        # an exponent beyond a long counts as a huge one; an absent one as 0
        number = let(exponent, lambda x: F.when(x == "", F.lit(0).cast("long")).otherwise(F.coalesce(x.try_cast("long"), F.when(x.startswith("-"), F.lit(-_HUGE)).otherwise(F.lit(_HUGE)))))
        digits = F.greatest(F.length(F.regexp_replace(F.regexp_replace(mantissa, r"\.", ""), "^0+", "")), F.lit(1)).cast("long")
        fraction = F.length(F.regexp_extract(mantissa, r"\.([0-9]*)$", 1)).cast("long")
        parts = F.struct(digits.alias("digits"), fraction.alias("fraction"), F.greatest(F.lit(-_HUGE), F.least(F.lit(_HUGE), number)).alias("x"))
        return F.when(t.rlike(_NUMBER), let(parts, of_parts))

    return let(_number(c), of_text)


def _decimal_error(c: Column, column: ColumnContract) -> Column:
    counted = let(decimal_digits(c), lambda d: F.when(d.isNull(), TYPE_MISMATCH).when((d.scale > column.scale) | (d.precision > column.precision), DECIMAL_PRECISION_EXCEEDED))
    if column.precision == column.scale:
        return counted
    usual = rf"^-?[0-9]{{1,{column.precision - column.scale}}}(?:\.[0-9]{{1,{column.scale}}})?$"  # needs no counting
    return F.when(~c.rlike(usual), counted)


def error_of(c: Column, column: ColumnContract) -> Column:
    """The type error's code of a field that isn't empty, or null."""
    if column.type == "integer":
        digits = r"^[+-]?[0_]*[0-9](?:_?[0-9]){0,37}$"  # what a column holds; a longer integer would turn into null
        return F.when(~stripped(c).rlike(r"^[+-]?[0-9]+(?:_[0-9]+)*$"), TYPE_MISMATCH).when(~stripped(c).rlike(digits), DECIMAL_PRECISION_EXCEEDED)
    if column.type == "decimal":
        return _decimal_error(c, column)
    if column.type in ("date", "timestamp"):
        return F.when(parsed_time(c, column.format).isNull(), INVALID_DATE_FORMAT if column.type == "date" else INVALID_TIMESTAMP_FORMAT)
    if column.type == "boolean":
        return F.when(boolean(c).isNull(), TYPE_MISMATCH)
    return F.lit(None).cast("string")


def converted(c: Column, column: ColumnContract) -> Column:
    """The typed value of a valid field; an empty field is null."""
    given = F.when(c != "", c)
    if column.type == "integer":
        return integer(given)
    if column.type == "decimal":
        return _number(given).try_cast(column.spark_type)
    if column.type in ("date", "timestamp"):
        return parsed_time(given, column.format).cast(column.spark_type)
    if column.type == "boolean":
        return boolean(given)
    return given
