"""Array helpers that keep every sub-expression evaluated once per row."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    Inside a higher-order function a captured expression is evaluated again for every element,
    which turns linear work into quadratic work. A lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def or_empty(items: Column, element: str) -> Column:
    """Null arrays become empty ones of the given element type."""
    return F.coalesce(items, F.array().cast(f"array<{element}>"))


def keep_edges(items: Column, field: str, last: bool = False) -> Column:
    """From an array of structs sorted by ``field``, the first (or last) one of each run."""
    step = 1 if last else -1

    def at_edge(xs: Column) -> Column:
        return F.filter(xs, lambda x, j: ~F.coalesce(
            F.get(xs, j + F.lit(step))[field] == x[field], F.lit(False)))
    return bind(items, at_edge)


def drop_blank(items: Column) -> Column:
    """The array without null and empty strings; the order stays."""
    return F.filter(items, lambda x: x.isNotNull() & (x != ""))


def exact_sum(values: Column) -> Column:
    """Sum an array of doubles in order with an error term, so long series do not drift."""
    zero = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("lost"))

    def add(acc: Column, x: Column) -> Column:
        t = acc["total"] + x
        lost = F.when(F.abs(acc["total"]) >= F.abs(x), (acc["total"] - t) + x) \
            .otherwise((x - t) + acc["total"])
        return F.struct(t.alias("total"), (acc["lost"] + lost).alias("lost"))
    return F.aggregate(values, zero, add, lambda acc: acc["total"] + acc["lost"])
