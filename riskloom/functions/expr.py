"""Scalar expressions.  Everything here is a JVM-side ``Column``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def col(name: str) -> Column:
    """Column by its literal name (spaces, dots and brackets allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def no_nan(c: Column) -> Column:
    """NaN becomes NULL, so that it is missing and not the largest number."""
    return F.when(~F.isnan(c), c)


def number(c: Column) -> Column:
    """Lenient number: text that is no number becomes NULL."""
    return no_nan(c.try_cast("double"))


def whole_number(c: Column) -> Column:
    """Lenient integer: anything but a whole number becomes NULL."""
    exact = c.try_cast("bigint")
    as_double = c.try_cast("double")
    return F.when(F.floor(as_double) == as_double, F.coalesce(exact, as_double.try_cast("bigint")))


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` where ``b`` is positive, else NULL."""
    return F.when(b > 0, a / b)


def flag(condition: Column) -> Column:
    """Condition as 0/1, unknown counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit to [low, high]; NULL stays NULL."""
    out = c
    if low is not None:
        out = F.when(c < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(c > high, F.lit(high)).otherwise(out)
    return out


def binned(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins; the lowest edge belongs to the first bin, outside is NULL."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    out = F.when(c < edges[0], F.lit(None).cast("string"))
    for top, label in zip(edges[1:], labels):
        out = out.when(c <= top, F.lit(label))
    return out


def graded(c: Column, cuts: Sequence[tuple[float, str]], lowest: str, unknown: str | None = None) -> Column:
    """First label whose cut is exceeded (cuts in falling order), else ``lowest``."""
    out = F.when(c.isNull(), F.lit(unknown).cast("string"))
    for cut, label in cuts:
        out = out.when(c > cut, F.lit(label))
    return out.otherwise(F.lit(lowest))


def min_max(c: Column, low: float, high: float, invert: bool = False) -> Column:
    """Scale to [0, 1]; a column without spread has no scaled value."""
    if low is None or high is None or not high > low:
        return F.lit(None).cast("double")
    scaled = (c - F.lit(low)) / F.lit(float(high) - float(low))
    return 1 - scaled if invert else scaled


def mapped(c: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """Small literal lookup; unmapped values take ``default`` (NULL if none)."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), c)
    return found if default is None else F.coalesce(found, default)


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """Does the lower-cased text hold any of the words?"""
    return reduce(lambda a, b: a | b, [F.lower(c).contains(w) for w in words])


def first_match(c: Column, rules: Sequence[tuple[Sequence[str], str]], default: str) -> Column:
    """Text of the first rule one of whose words occurs in ``c``."""
    out = None
    for words, text in rules:
        hit = contains_any(c, words)
        out = F.when(hit, F.lit(text)) if out is None else out.when(hit, F.lit(text))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def label_cut(c: Column, length: int) -> Column:
    """Axis label: text cut to ``length`` characters."""
    return F.substring(c.cast("string"), 1, length)


def fixed(c: Column, places: int) -> Column:
    """Number as text with a fixed count of decimals, without grouping marks."""
    return F.format_string(f"%.{places}f", c.cast("double"))


def pct(part: Column, whole: Column) -> Column:
    """Percentage, 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))
