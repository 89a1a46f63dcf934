"""Aggregate functions of other SQL systems as Column builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def string_list(value: Column, separator: str = "", order: Column | None = None, distinct: bool = False) -> Column:
    """Joined texts of a group, in a fixed order: by the value itself or by an order column."""
    value = value.cast("string")
    if distinct:
        return F.array_join(F.sort_array(F.collect_set(value)), separator)
    if order is None:
        return F.array_join(F.sort_array(F.collect_list(value)), separator)
    pair = F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v")))
    return F.array_join(F.transform(F.sort_array(F.collect_list(pair)), lambda p: p["v"]), separator)


def sorted_array(value: Column, descending: bool = False) -> Column:
    """Array of a group's values in their own order."""
    return F.sort_array(F.array_agg(value), asc=not descending)


def ordered_array(value: Column, *orders: tuple[Column, bool]) -> Column:
    """Array of a group's values, ordered by other columns; ``(column, descending)`` per column."""
    names = [f"o{i}" for i in range(len(orders))]
    rows = F.array_agg(F.struct(*[c.alias(n) for n, (c, _) in zip(names, orders)], value.alias("value")))

    def before(left: Column, right: Column) -> Column:
        result = F.lit(0)
        for name, (_, descending) in reversed(list(zip(names, orders))):
            a, b = (right[name], left[name]) if descending else (left[name], right[name])
            result = F.when(a < b, -1).when(a > b, 1).otherwise(result)
        return result

    return F.filter(
        F.transform(F.array_sort(rows, before), lambda r: r["value"]), lambda v: v.isNotNull()
    )


def percentile_accuracy(relative_error: float) -> int:
    """Accuracy argument for a relative error as other systems state it."""
    return int((1 / relative_error) * 100)


def approx_percentile(value: Column, share, relative_error: float | None = None) -> Column:
    accuracy = percentile_accuracy(relative_error) if relative_error else 10000
    return F.percentile_approx(value, share, accuracy)


def checksum_list(value: Column) -> Column:
    """MD5 over the joined values of a small group, sorted so that the result is repeatable."""
    return F.md5(F.array_join(F.sort_array(F.array_agg(value.cast("string"))), ","))


def checksum_agg(value: Column) -> Column:
    """Checksum of a group of any size, free of row order: row checksums are added up, then hashed."""
    part = F.conv(F.substring(F.md5(value.cast("string")), 1, 15), 16, 10).cast("decimal(38,0)")
    return F.md5(F.sum(part).cast("string"))


def first_by(value: Column, order: Column) -> Column:
    return F.min_by(value, order)


def last_by(value: Column, order: Column) -> Column:
    return F.max_by(value, order)


#: How partial aggregates of a kind are folded further.
_FOLDED = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def cube_of(df: DataFrame, columns: list[str], aggregates: dict[str, tuple[str, str]], rollup: bool = False) -> DataFrame:
    """(columns, gid, aggregates): all groupings of a cube (or rollup), with their number.

    ``aggregates`` names a kind (sum, count, min, max, avg) and a column; ``*`` counts rows. Rows are grouped once, as
    finely as possible, and the coarser groupings come from these groups; a plain cube copies every row for each grouping.
    """
    parts = {n: (("sum", c), ("count", c)) if k == "avg" else ((k, c),) for n, (k, c) in aggregates.items()}
    make = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    first = {f"{n}__{k}": make[k](F.lit(1) if c == "*" else F.col(c)) for n, ps in parts.items() for k, c in ps}
    finest = df.groupBy(*columns).agg(*[c.alias(n) for n, c in first.items()])
    groups = finest.rollup(*columns) if rollup else finest.cube(*columns)
    out = groups.agg(F.grouping_id().alias("gid"), *[_FOLDED[k](f"{n}__{k}").alias(f"{n}__{k}") for n, ps in parts.items() for k, _ in ps])
    # The grouping of nothing has a row even where there are none, whose count is 0.
    value = lambda n, k: F.coalesce(F.col(f"{n}__{k}"), F.lit(0)) if k == "count" else F.col(f"{n}__{k}")
    made = [(F.try_divide(f"{n}__sum", f"{n}__count") if len(ps) > 1 else value(n, ps[0][0])).alias(n) for n, ps in parts.items()]
    return out.select(*columns, "gid", *made)
