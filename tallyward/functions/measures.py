"""Guarded ratios, status bands and distribution helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """Share of two counts in percent. Decimal arithmetic keeps half-way rounding exact."""
    return F.round(
        part.cast("decimal(18,0)") * F.lit(100) / F.nullif(whole.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)")),
        digits,
    )


def mean(total: Column, count: Column, digits: int | None = None) -> Column:
    """Average from an exact sum, so the order of summation cannot change it."""
    if digits is None:
        return total.cast("double") / F.nullif(count.cast("double"), F.lit(0.0))
    return F.round(
        total.cast("decimal(24,4)") / F.nullif(count.cast("decimal(14,0)"), F.lit(0).cast("decimal(14,0)")), digits
    )


def count_when(condition: Column) -> Column:
    """Rows for which the condition is true; 0, never NULL, on empty input."""
    return F.count(F.when(condition, 1))


def sum_when(condition: Column, value: Column) -> Column:
    """Conditional sum: 0 for groups without a match, NULL only for an empty input."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def bands(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose lower bound the value reaches; NULL values fall through."""
    out = None
    for bound, label in steps:
        test = value >= F.lit(bound)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(otherwise)


def under(value: Column, steps: Sequence[tuple[float, str]], otherwise: str | None) -> Column:
    """First label whose upper bound exceeds the value."""
    out = None
    for bound, label in steps:
        test = value < F.lit(bound)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out if otherwise is None else out.otherwise(otherwise)


def tag(tags: Column, name: str) -> Column:
    """Tag array with one more entry; a NULL array counts as empty."""
    return F.array_append(tags_or_empty(tags), F.lit(name))


def tags_or_empty(tags: Column) -> Column:
    return F.coalesce(tags, F.array().cast("array<string>"))


def has_tag(tags: Column, name: str) -> Column:
    return F.array_contains(tags_or_empty(tags), name)


def whole_match(value: Column, pattern: Column | str) -> Column:
    """Regex test over the whole string; ``rlike`` alone accepts a partial match."""
    if isinstance(pattern, str):
        return value.rlike(f"^(?:{pattern})$")
    return F.rlike(value, F.concat(F.lit("^(?:"), pattern, F.lit(")$")))
