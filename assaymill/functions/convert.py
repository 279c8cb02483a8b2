"""Type conversion (PRJ9-PRJ13).

Every conversion guards the text by shape first, so bad values become null without an exception
per row, and gives null instead of NaN.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import DOUBLE, LONG, STRING, TIMESTAMP

# Plain numbers only: a cast to double would also read 0.5d, 1f, 0x1p3 and NaN.
_NUMBER = (r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
           r"|^\s*[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?\s*$")
_WHOLE = r"^\s*[+-]?\d+\s*$"
_YEAR_FIRST = r"^\s*[0-9]{4}/"
# A day-first date (5/1/2023, 05-01-2023 10:20, 5.1.2023 ...) at the start of the text.
_DAY_FIRST = r"^\s*(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})"
# The same as the whole text, which no other shape matches.
_PLAIN_DAY_FIRST = r"^\d{1,2}[/.-]\d{1,2}[/.-]\d{4}\z"
# Day-first dates with a year of two digits, dates of eight digits, and month names.
_SHORT_YEAR = r"^\s*(\d{1,2})[/.-](\d{1,2})[/.-](\d{2})(?=\s|$)"
_EIGHT_DIGITS = r"^\s*(\d{4})(\d{2})(\d{2})(?=\s|$)"
_MONTH_NAME = r"^\s*(\d{1,2})[\s-]+([A-Za-z]{3})[A-Za-z]*\.?[\s,-]+(\d{4})(?=\s|$)"
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
# A time of day on the twelve-hour clock at the end of the text.
_HALF_DAY = r"(?i)^(.*\s)(\d{1,2})(:\d{2})(:\d{2})?\s*([ap])\.?m\.?\s*$"


def null_if_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def to_double(c: Column, source_type: str = "string") -> Column:
    """PRJ9: text to double; anything else than a plain number is null."""
    if source_type == "string":
        return F.when(c.rlike(_NUMBER), c.try_cast("double"))
    return null_if_nan(c.try_cast("double"))


def to_long(c: Column, source_type: str = "string") -> Column:
    """PRJ10: text to whole number; ``3.0`` is 3, ``3.5`` is null."""
    number = to_double(c, source_type)
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    if source_type == "string":
        # digits only: straight to bigint, which keeps values above 2**53 exact
        return F.when(c.rlike(_WHOLE), c.try_cast("bigint")).otherwise(whole)
    if source_type in ("double", "float") or source_type.startswith("decimal"):
        return whole
    return c.try_cast("bigint")


def _shape(pattern: str) -> str:
    """The regular expression of the texts a datetime pattern can match."""
    out = []
    for m in re.finditer(r"'([^']*)'|(([A-Za-z])\3*)|(.)", pattern):
        quoted, run, letter, other = m.group(1), m.group(2), m.group(3), m.group(4)
        if run:
            if letter in "ML" and len(run) > 2 or letter in "EaGzZVXxO":
                out.append(r"\S+")
            elif len(run) == 1:
                out.append(r"\d{1,2}" if letter not in "yS" else r"\d+")
            else:
                out.append(rf"\d{{{len(run)}}}")
        else:
            out.append(re.escape(quoted if quoted is not None else other))
    return "^" + "".join(out) + "$"


def _on_full_clock(c: Column) -> Column:
    """``1:05 PM`` as ``13:05``; texts of other shapes as they are."""
    hour = F.regexp_extract(c, _HALF_DAY, 2).try_cast("int")
    afternoon = F.lower(F.regexp_extract(c, _HALF_DAY, 5)) == "p"
    full = F.when(hour.between(1, 12), F.pmod(hour, F.lit(12)) + F.when(afternoon, 12).otherwise(0))
    return F.when(c.rlike(_HALF_DAY), F.concat(
        F.regexp_extract(c, _HALF_DAY, 1), F.lpad(full.cast("string"), 2, "0"),
        F.regexp_extract(c, _HALF_DAY, 3), F.regexp_extract(c, _HALF_DAY, 4))).otherwise(c)


def _in_iso_order(c: Column) -> Column:
    """Dates of the known shapes as year-month-day; years of two digits lie in 1969 to 2068."""
    year = F.regexp_extract(c, _SHORT_YEAR, 3)
    century = F.when(year.try_cast("int") < 69, F.lit("20")).otherwise(F.lit("19"))
    month = F.array_position(F.lit(list(_MONTHS)), F.lower(F.regexp_extract(c, _MONTH_NAME, 2)))
    return (
        F.when(c.like("____-__-__%"), c)
        .when(c.rlike(_YEAR_FIRST), F.translate(c, "/", "-"))
        .when(c.rlike(_EIGHT_DIGITS), F.regexp_replace(c, _EIGHT_DIGITS, "$1-$2-$3"))
        .when(c.rlike(_SHORT_YEAR), F.concat(century, F.regexp_replace(c, _SHORT_YEAR, "$3-$2-$1")))
        .when(c.rlike(_MONTH_NAME) & (month > 0), F.concat_ws(
            "-", F.regexp_extract(c, _MONTH_NAME, 3), month.cast("string"),
            F.concat(F.regexp_extract(c, _MONTH_NAME, 1), F.regexp_replace(c, _MONTH_NAME, ""))))
        .otherwise(F.regexp_replace(c, _DAY_FIRST, "$3-$2-$1"))
    )


def _plain_in_iso_order(c: Column) -> Column:
    """A text of ``_PLAIN_DAY_FIRST`` as year-month-day, cut by places: the year is the last four characters,
    and of two characters at either end of what stands before it one may be the separator."""
    day_month = F.substring(c, F.lit(1), F.length(c) - 5)
    separators = F.lit("/.-")
    return F.concat(
        F.substring(c, -4, 4), F.lit("-"), F.btrim(F.substring(day_month, -2, 2), separators), F.lit("-"),
        F.btrim(F.substring(day_month, 1, 2), separators))


def to_timestamp(c: Column, formats: Sequence[str] | None = None, held: bool = True) -> Column:
    """PRJ11: text to a zone-less timestamp, day first, each value on its own.

    By default ISO dates, day-first dates with ``/ - .`` and years of four or two digits, dates of
    eight digits and dates with an English month name are read, each with an optional time: what is not in ISO order is rewritten to it, and one ``try_cast`` parses the result. With ``formats`` the
    given patterns are tried in order instead; a pattern is only tried on texts of its shape. ``held=False``
    writes the expression out without a lambda, for those who need its SQL text.
    """
    if formats is None:
        # the usual shape needs one rewriting; for the others a lambda holds the text on the full clock, which
        # the shapes mention a dozen times, so that it is computed once and generated code stays small
        clock = _on_full_clock(c)
        other = F.get(F.transform(F.array(clock), _in_iso_order), 0) if held else _in_iso_order(clock)
        iso = F.when(c.rlike(_PLAIN_DAY_FIRST), _plain_in_iso_order(c)).otherwise(other)
        return iso.try_cast("timestamp_ntz")
    text = F.trim(c)
    tries = [
        F.when(text.rlike(_shape(f)), F.try_to_timestamp(text, F.lit(f))).cast("timestamp_ntz")
        for f in formats
    ]
    return F.coalesce(*tries) if tries else F.lit(None).cast("timestamp_ntz")


def convert(
    c: Column, target: str, source_type: str = "string", strict: bool = False,
    formats: Sequence[str] | None = None,
) -> Column:
    """PRJ9-PRJ13: to a spec type; unparseable gives null, or an error when ``strict``."""
    if target == STRING:
        return c.cast("string")
    if target == DOUBLE:
        out = to_double(c, source_type)
    elif target == LONG:
        out = to_long(c, source_type)
    elif target == TIMESTAMP:
        out = to_timestamp(c, formats) if source_type == "string" else c.try_cast("timestamp_ntz")
    else:
        raise ValueError(f"Unsupported type: {target}")
    if not strict:
        return out
    bad = c.isNotNull() & out.isNull()
    message = F.concat(F.lit(f"cannot convert to {target}: "), c.cast("string"))
    return F.when(bad, F.raise_error(message)).otherwise(out)
