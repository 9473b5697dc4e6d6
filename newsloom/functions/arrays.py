"""Array / map / vector column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scale(vec: Column, w: Column) -> Column:
    """F16: scalar x vector."""
    return F.transform(vec, lambda x: x * w)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                              lambda acc, x: acc + x))


def pad_right(arr: Column, n: int, value: float = 0.0) -> Column:
    """F21 + Q9: right-pad a (possibly null or short) array to exactly ``n`` items."""
    a = F.coalesce(arr, F.array().cast("array<double>"))
    a = F.slice(a, 1, n)
    missing = F.greatest(F.lit(n) - F.size(a), F.lit(0))
    return F.concat(a, F.array_repeat(F.lit(float(value)), missing))


def first_sorted(arr: Column, n: int, order: str = "asc") -> Column:
    """The first ``n`` of the sorted values; ``order='asc'`` as coded (smallest first)."""
    s = F.array_sort(arr)
    if order == "desc":
        s = F.reverse(s)
    return F.slice(s, 1, n)


def map_values_with_prefix(m: Column, prefix: Column) -> Column:
    """values of a ``'channel:topic'``-keyed map whose channel part equals ``prefix``."""
    return F.map_values(F.map_filter(m, lambda k, v: F.split_part(k, F.lit(":"), F.lit(1)) == prefix))


def map_values_by_prefix(m: Column) -> Column:
    """F19 for all prefixes at once: map of channel part -> values of a ``'channel:topic'``-keyed map. The entries are
    sorted by channel part and cut where it changes, so a map is read once, not once a channel."""
    e = F.array_sort(F.transform(F.map_entries(m), lambda x: F.struct(
        F.split_part(x["key"], F.lit(":"), F.lit(1)).alias("p"), x["value"].alias("v"))))

    def cut(entries: Column) -> Column:
        n = F.size(entries)
        places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: (i == 0) | (F.get(entries, i)["p"] != F.get(entries, i - 1)["p"]))
        # nested one-element transforms name an intermediate result, so that it is computed once
        return F.transform(F.array(starts), lambda at: F.map_from_entries(F.transform(at, lambda a, k: F.struct(
            F.get(entries, a)["p"], F.transform(F.slice(entries, a + 1, F.coalesce(F.get(at, k + 1), n) - a), lambda x: x["v"])))))[0]

    return F.transform(F.array(e), cut)[0]
