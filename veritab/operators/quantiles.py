"""Exact percentiles and modes of groups of any size.

The built-in exact percentile keeps every distinct value of a group in one task. Here values are counted
first, and running counts are taken range by range along the value order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.operators.canonical import column
from veritab.operators.ranking import in_ranges


@dataclass(frozen=True)
class Percentile:
    share: float
    kind: str = "cont"


def exact_percentiles(df: DataFrame, group, value: str, wanted: dict, frequency: str | None = None):
    """Group columns plus one column per entry of ``wanted`` (name -> :class:`Percentile`). NULL values are skipped.

    ``frequency`` names a column that says how often a row counts.
    """
    group = list(group)
    rows = df.filter(column(value).isNotNull())
    weight = F.sum(column(frequency).cast("long")) if frequency else F.count(F.lit(1))
    counted = rows.groupBy(*[column(g) for g in group], column(value).alias("__v")).agg(weight.alias("__n"))
    counted = counted.filter("__n > 0")
    named = [f"g{i}" for i in range(len(group))]
    # Only counts are put into ranges and stored, and the table is read once.
    ranged = in_ranges(counted, [*[column(g) for g in group], F.col("__v")], "__range")
    slotted = ranged.withColumn("__slot", F.struct(*[column(g).alias(n) for g, n in zip(group, named)], F.col("__range").alias("b")))
    local = Window.partitionBy("__slot").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = slotted.withColumn("__upto", F.sum("__n").over(local))
    slots = base.groupBy("__slot").agg(F.max("__upto").alias("__rows"))
    whole = Window.partitionBy(*[F.col("__slot")[n] for n in named])
    earlier = whole.orderBy(F.col("__slot")["b"]).rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumns(
        {
            "__off": F.coalesce(F.sum("__rows").over(earlier), F.lit(0)),
            "__total": F.sum("__rows").over(whole),
        }
    )
    placed = base.join(slots, "__slot").withColumn("__end", F.col("__upto") + F.col("__off"))
    start, end, total = F.col("__end") - F.col("__n"), F.col("__end"), F.col("__total")
    aggregates = [F.max("__total").alias("__total")]
    for name, p in wanted.items():
        if p.kind == "disc":
            aggregates.append(F.min(F.when(end >= F.ceil(total * p.share), F.col("__v"))).alias(name))
        else:
            place = (total - 1) * F.lit(float(p.share))
            for mark, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
                aggregates.append(F.max(F.when((start <= at) & (at < end), F.col("__v"))).alias(f"__{mark}_{name}"))
    grouped = placed.groupBy(*[column(g) for g in group]).agg(*aggregates)
    out = []
    for name, p in wanted.items():
        if p.kind == "disc":
            out.append(F.col(name))
        else:
            place = (F.col("__total") - 1) * F.lit(float(p.share))
            low, high = F.col(f"__lo_{name}").cast("double"), F.col(f"__hi_{name}").cast("double")
            out.append((low + (place - F.floor(place)) * (high - low)).alias(name))
    return grouped.select(*[column(g) for g in group], *out)


def modes(df: DataFrame, group, value: str, name: str = "mode") -> DataFrame:
    """Most frequent value per group; the smallest one when several are. Counted before the groups meet."""
    counts = (
        df.filter(column(value).isNotNull())
        .groupBy(*[column(g) for g in group], column(value).alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    # min over (-count, value): highest count first, then the smallest value.
    first = F.min(F.struct((-F.col("__n")).alias("c"), F.col("__v").alias("v")))
    return counts.groupBy(*[column(g) for g in group]).agg(first["v"].alias(name))
