"""Small expressions shared by the operators that stay on built-in functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

WORD_GAP = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The runs of characters other than ASCII white space; an empty array for null."""

    def inner(parts: Column) -> Column:  # an edge gap leaves an empty part at that end
        n = F.size(parts)
        first = F.when(F.get(parts, F.lit(0)) == "", F.lit(2)).otherwise(F.lit(1))
        last = F.when(F.get(parts, n - 1) == "", n - 1).otherwise(n)
        return F.when((first == 1) & (last == n), parts).otherwise(
            F.slice(parts, first, F.greatest(last - first + 1, F.lit(0)))
        )

    return let(F.split(F.coalesce(text, F.lit("")), WORD_GAP, -1), inner)


def total(values: Column) -> Column:
    """Sum of an array of longs, 0 if it is empty."""
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def parts_for(rows: int, per_part: int) -> int:
    """Partitions for a counted number of rows.

    Given to ``coalesce`` after a shuffle, so that a small table is not worked on in hundreds of empty tasks; a large
    one has at least as many partitions as the shuffle.
    """
    return max(8, -(-rows // per_part))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until no column of ``df`` has them in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """A column of any name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")
