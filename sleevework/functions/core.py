"""Small building blocks shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use the result inside ``body`` as often as needed.

    A fold over nothing hands its start to its last step as it is; a transform of one element would copy each result.
    """
    return F.aggregate(F.array(), value, lambda bound, _none: bound, body)


def sections(items: Column, starts: Column) -> Column:
    """Cut an array at ascending 1-based ``starts``; every section runs to the next start.

    Each element is copied once, so a very long document costs linear time.
    """

    def cut(s: Column) -> Column:
        n = F.size(s["items"])
        stops = F.concat(F.slice(s["starts"], F.lit(2), F.size(s["starts"])), F.array(n + 1))
        cuts = F.zip_with(s["starts"], stops, lambda a, b: F.slice(s["items"], a, b - a))
        return F.when(F.size(s["starts"]) > 0, cuts).otherwise(F.slice(cuts, F.lit(1), F.lit(0)))

    return let(F.struct(items.alias("items"), starts.alias("starts")), cut)


def positions(items: Column, test: Callable[[Column], Column]) -> Column:
    """1-based positions of the elements that satisfy ``test``, ascending."""
    marked = F.transform(items, lambda x, i: F.when(test(x), i + 1))
    return F.filter(marked, lambda p: p.isNotNull())


def blank_to_null(value: Column) -> Column:
    """An empty text as NULL. ``F.nullif`` would work ``value`` out twice inside a lambda."""
    return let(value, lambda v: F.when(v != "", v))


def digits(value: Column, kind: str) -> Column:
    """The number that a group of digits spells, NULL for an empty group.

    ``try_cast`` throws and catches an exception for an empty text, which costs more than the search that found nothing.
    """
    return blank_to_null(value).try_cast(kind)


def group(value: Column, pattern: str, index: int) -> Column:
    """A regex group, NULL when there is no match or the group is empty."""
    return blank_to_null(F.regexp_extract(value, pattern, index))


def deduplicate(items: Column, key: Callable[[Column, Column], Column], *, keep: str = "first") -> Column:
    """One element per key, in document order. ``key`` gets the element and its index.

    Works by sorting the keys, so it does not turn quadratic on long arrays.
    """

    def pick(order: Column) -> Column:
        def is_kept(x: Column, i: Column) -> Column:
            other = F.get(order, i - 1 if keep == "first" else i + 1)
            edge = i == 0 if keep == "first" else i == F.size(order) - 1
            return edge | ~other["key"].eqNullSafe(x["key"])

        return F.array_sort(F.transform(F.filter(order, is_kept), lambda x: x["i"]))

    def select(all_items: Column) -> Column:
        keyed = F.array_sort(F.transform(all_items, lambda x, i: F.struct(key(x, i).alias("key"), i.alias("i"))))
        return F.transform(let(keyed, pick), lambda i: F.get(all_items, i))

    return let(items, select)


def first(items: Column, test: Callable[[Column], Column] | None = None) -> Column:
    """First element (that satisfies ``test``), NULL when there is none."""
    return F.get(items if test is None else F.filter(items, test), F.lit(0))


def last(items: Column, test: Callable[[Column], Column]) -> Column:
    return F.try_element_at(F.filter(items, test), F.lit(-1))


def computed(df: DataFrame, name: str, value: Column, keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """Add (or replace) a column that is worked out exactly once per row.

    Going through a one-element explode keeps the optimizer from copying an expensive expression into
    every place, filters included, that refers to the column. Rows that fail ``keep`` are dropped.
    """
    cell = F.array(value) if keep is None else F.filter(F.array(value), keep)
    return df.select(*[c for c in df.columns if c != name], F.explode(cell).alias(name))
