"""Ratios, bands and severities (AGG3, AGG15, RPT9, RPT11-RPT13, RPT15)."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fixed


def percentage(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part / whole * 100``, 0.0 for an empty whole; rounds half to even."""
    value = F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")) * 100, F.lit(0.0))
    return value if digits is None else F.bround(value, digits)


def success_rate(ok: Column) -> Column:
    """AGG15, an aggregate: share of rows where ``ok`` holds, in percent."""
    return percentage(F.count_if(ok), F.count(F.lit(1)))


def first_match(c: Column, choices: Sequence[tuple[str, Any]], default: Any) -> Column:
    """The value of the first choice whose text occurs in ``c``."""
    out = None
    for text, value in choices:
        hit = c.contains(text)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out.otherwise(F.lit(default))


def severity(error_type: Column) -> Column:
    """RPT11."""
    return first_match(error_type, fixed.SEVERITIES, "LOW")


def severity_priority(level: Column) -> Column:
    """RPT12."""
    lowest = min(fixed.SEVERITY_PRIORITY.values())
    out = None
    for name, priority in fixed.SEVERITY_PRIORITY.items():
        out = (F if out is None else out).when(level == name, F.lit(priority))
    return out.otherwise(F.lit(lowest))


def band(rate: Column, bands: Sequence[tuple[int, str]] = fixed.OVERVIEW_BANDS) -> Column:
    """RPT9 / RPT15: name of the band a rate falls in."""
    out = None
    for lowest, name in bands:
        out = (F if out is None else out).when(rate >= lowest, F.lit(name))
    return out.otherwise(F.lit(fixed.LOWEST_BAND))


def executive_status(rate: Column) -> Column:
    """RPT15."""
    return (
        F.when(rate >= fixed.PASS_RATE, F.lit("PASSED"))
        .when(rate < fixed.FAIL_RATE, F.lit("FAILED"))
        .otherwise(F.lit("WARNING"))
    )
