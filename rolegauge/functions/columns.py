"""Small Column helpers shared by the other modules."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``.

    A name bound by a one-element ``transform`` is never inlined, so a costly expression that is used inside
    a lambda is not evaluated again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(values: Iterable[str]) -> Column:
    """A literal array of strings; one folded expression, however long the list is."""
    values = list(values)
    return F.split(F.lit("\x1f".join(values)), "\x1f") if values else F.array().cast("array<string>")


def first(array: Column, n: int) -> Column:
    return F.slice(array, 1, n)


def joined(array: Column, sep: str = ", ") -> Column:
    return F.array_join(array, sep)


def elements(rows: DataFrame, array: str, keep: list[str], names: list[str]) -> DataFrame:
    """A row for each element of an array column: ``keep``, the place from 0, and the element.

    An inner explode makes Spark test the size of the array beforehand, and a computed array is then computed once more, at the source
    and before rows are dealt out. The outer form has no such test; the rows it adds for empty arrays have no place.
    """
    placed = rows.select(*keep, F.posexplode_outer(array).alias(*names))
    return placed.filter(F.col(names[0]).isNotNull())


def nonempty(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) != ""


def clip_percent(value: Column, upper: int) -> Column:
    """Round half to even, then keep within 0..upper."""
    return F.least(F.greatest(F.rint(value), F.lit(0.0)), F.lit(float(upper))).cast("int")


def contained(text: Column, values: Iterable[str]) -> Column:
    """The ``values`` that occur in ``text`` as plain substrings, in list order."""
    return let(text, lambda t: _held(t, values))


def _held(text: Column, values: Iterable[str]) -> Column:
    return F.filter(words(values), lambda v: F.contains(text, v))


def contains_count(text: Column, values: Iterable[str]) -> Column:
    """How many of ``values`` occur in ``text`` as plain substrings."""
    return F.size(contained(text, values))


def contains_any(text: Column, values: Iterable[str]) -> Column:
    return let(text, lambda t: F.exists(words(values), lambda v: F.contains(t, v)))


def occurrences(text: Column, values: Iterable[str]) -> Column:
    """Non-overlapping occurrences of each value, added up. Only values that the text holds are counted; looking for one is far cheaper."""

    def count(t: Column, value: Column) -> Column:
        return (F.length(t) - F.length(F.replace(t, value, F.lit("")))) / F.length(value)

    return let(
        text, lambda t: F.aggregate(_held(t, values), F.when(t.isNotNull(), 0), lambda n, v: n + count(t, v).cast("int"))
    )


def listed_in(values: Iterable[str], held: Column) -> Column:
    """Those of ``values`` that ``held`` has, in list order."""
    return F.filter(words(values), lambda v: F.array_contains(held, v))
