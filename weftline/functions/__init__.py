"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(c: Column | str) -> Column:
    return F.trunc(c, "MM")


def months_ago(month: Column | str, end: Column) -> Column:
    month = F.col(month) if isinstance(month, str) else month
    return (F.year(end) - F.year(month)) * 12 + F.month(end) - F.month(month)


def clipped(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bounds that pass nulls on, which greatest() and least() alone do not."""
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(c.isNotNull(), out)


def title(c: Column | str) -> Column:
    """Every letter that follows none goes up, all others go down, so that "t-shirt" gives "T-Shirt"."""
    spaced = F.regexp_replace(F.lower(c), r"(?<!\p{L})(\p{L})", "\u0001$1")  # a mark before each letter that begins a word
    parts = F.split(spaced, "\u0001")
    return F.array_join(F.transform(parts, lambda p, k: F.when(k == 0, p).otherwise(F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p))))), "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(a, b)


def settled(c: Column, digits: int = 4) -> Column:
    """Rounded, with exact ties (up to the noise of doubles) going up, so that equal sums in another order round alike."""
    return F.round(c + 1e-9, digits)


def wmape(actual: Column, predicted: Column) -> Column:
    """100 * sum of absolute errors / sum of absolute actuals, null without actuals."""
    return ratio(F.sum(F.abs(actual - predicted)) * 100.0, F.sum(F.abs(actual)))


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg((actual - predicted) * (actual - predicted)))


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def mape(actual: Column, predicted: Column) -> Column:
    return F.avg(F.when(actual > 0, F.abs(actual - predicted) / actual)) * 100.0


def accuracy_tier(error: Column, strong: float, moderate: float) -> Column:
    return F.when(error.isNull(), "UNKNOWN").when(error < strong, "STRONG").when(error <= moderate, "MODERATE").otherwise("WEAK")


def direction(bias: Column, over: float = 1.05, under: float = 0.95) -> Column:
    return F.when(bias.isNull(), "Unknown").when(bias > over, "Over").when(bias < under, "Under").otherwise("Neutral")
