"""Numbering, ranks and neighbours inside groups of any size.

A plain window puts a whole group into one task. Here rows are cut into ranges along group and sort
order; each range is sorted on its own, and a small table with one row per group and range carries
what a range has to know about the ranges before it. The result equals the plain window.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.session import materialise

_TMP = "__rank_"


@dataclass(frozen=True)
class Rank:
    """row_number, rank, dense_rank, percent_rank, cume_dist or ntile (with ``n`` tiles)."""

    kind: str
    n: int = 0


@dataclass(frozen=True)
class Shift:
    """Value ``offset`` rows before (``lag``) or after (``lead``)."""

    column: str
    offset: int = 1
    default: object = None
    lead: bool = False
    ignore_nulls: bool = False


@dataclass(frozen=True)
class Edge:
    """First, last or ``n``-th value of the whole group."""

    column: str
    kind: str = "first"
    n: int = 1
    ignore_nulls: bool = False


@dataclass(frozen=True)
class Order:
    """A sort column with its direction and the place of its NULLs."""

    column: object
    descending: bool = False
    nulls_first: bool = False

    def sort(self) -> Column:
        c = _col(self.column)
        if self.descending:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()

    def reversed(self) -> Order:
        return Order(self.column, not self.descending, not self.nulls_first)


def asc(c) -> Order:
    """Ascending order of systems where NULL is the largest value."""
    return Order(c)


def desc(c) -> Order:
    """Descending order of systems where NULL is the largest value."""
    return Order(c, descending=True, nulls_first=True)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_ranges(df: DataFrame, columns: list[Column], name: str) -> DataFrame:
    """A stored copy of a table in ranges of the sort order, with the number of the range, which grows with the order.

    There are at most as many ranges as the session has shuffle partitions, whatever the data; rows that agree in all
    columns share one. The copy fixes the cuts, which come from a sample and may differ from run to run.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(df.repartitionByRange(parts, *columns).withColumn(name, F.spark_partition_id()), "ranges")


def spread_window(df: DataFrame, partition_by, order_by, columns: dict) -> DataFrame:
    """Add window columns without bringing a whole group into one task.

    ``order_by``  sort columns as :class:`Order`, see :func:`asc` and :func:`desc`
    ``columns``   output name -> :class:`Rank`, :class:`Shift` or :class:`Edge`

    Rows are put into ranges of (group, order), so a large group has many ranges and a range many small groups. The
    rows of a group in a range are a slot. A group has at most as many slots as there are ranges, and all groups
    together have at most as many slots as there are groups and ranges: these few rows are what meets per group.
    Rows that tie in the whole order stay together.
    """
    partition_by = list(partition_by)
    slot, part = f"{_TMP}slot", f"{_TMP}range"
    # One struct holds group and range: it is never NULL itself, so joins on it match NULL parts too.
    part_names = [f"p{i}" for i in range(len(partition_by))]
    ranged = in_ranges(df, [*[_col(p) for p in partition_by], *[o.sort() for o in order_by]], part)
    base = ranged.withColumn(slot, F.struct(*[_col(p).alias(n) for n, p in zip(part_names, partition_by)], F.col(part).alias("b"))).drop(part)
    local = Window.partitionBy(slot).orderBy(*[o.sort() for o in order_by])
    backward = Window.partitionBy(slot).orderBy(*[o.reversed().sort() for o in order_by])
    inside = local.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    peers = local.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    kinds = {spec.kind for spec in columns.values() if isinstance(spec, Rank)}
    shifts = {k: s for k, s in columns.items() if isinstance(s, Shift)}
    edges = {k: s for k, s in columns.items() if isinstance(s, Edge)}

    work = {f"{_TMP}rn": F.row_number().over(local)}
    if kinds & {"rank", "percent_rank"}:
        work[f"{_TMP}rank"] = F.rank().over(local)
    if "dense_rank" in kinds:
        work[f"{_TMP}dense"] = F.dense_rank().over(local)
    if "cume_dist" in kinds:
        work[f"{_TMP}peers"] = F.count(F.lit(1)).over(peers)
    for name, s in shifts.items():
        kept = F.col(s.column).isNotNull() if s.ignore_nulls else F.lit(True)
        value = F.when(kept, F.struct(F.col(s.column).alias("v")))
        upto_here, from_here = F.count(value).over(upto), F.count(value).over(inside) - F.count(value).over(upto)
        from_here = from_here + F.when(kept, 1).otherwise(0)
        work[f"{_TMP}{name}_value"] = value
        work[f"{_TMP}{name}_seen"] = from_here if s.lead else upto_here
        work[f"{_TMP}{name}_left"] = upto_here if s.lead else from_here
        work[f"{_TMP}{name}_local"] = _local_shift(s, value, local, backward)
    base = base.withColumns(work)

    # One row per group and range.
    aggregates = [F.count(F.lit(1)).alias("rows")]
    if "dense_rank" in kinds:
        aggregates.append(F.max(f"{_TMP}dense").alias("dense"))
    for name, s in shifts.items():
        near = (F.col(f"{_TMP}{name}_left") <= s.offset) & F.col(f"{_TMP}{name}_value").isNotNull()
        pair = F.struct(F.col(f"{_TMP}{name}_left").alias("i"), F.col(f"{_TMP}{name}_value").alias("v"))
        # At most ``offset`` rows of the slot, nearest to its end (its start for lead).
        aggregates.append(F.sort_array(F.collect_list(F.when(near, pair)), asc=False).alias(f"tail_{name}"))
    for name, s in edges.items():
        kept = F.col(s.column).isNotNull() if s.ignore_nulls else F.lit(True)
        place = F.when(kept, F.struct(F.col(f"{_TMP}rn").alias("i"), F.col(s.column).alias("v")))
        if s.kind == "first":
            aggregates.append(F.min_by(place, place["i"]).alias(f"edge_{name}"))
        elif s.kind == "last":
            aggregates.append(F.max_by(place, place["i"]).alias(f"edge_{name}"))
        else:
            head = F.when(F.col(f"{_TMP}rn") <= s.n, F.struct(F.col(f"{_TMP}rn").alias("i"), F.col(s.column).alias("v")))
            aggregates.append(F.sort_array(F.collect_list(head)).alias(f"edge_{name}"))
    slots = base.groupBy(slot).agg(*aggregates)

    # Carry over the slots of a group: at most one per range, whatever its rows.
    group_cols = [F.col(slot)[n] for n in part_names]
    whole = Window.partitionBy(*group_cols)
    ordered = whole.orderBy(F.col(slot)["b"])
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    later = ordered.rowsBetween(1, Window.unboundedFollowing)
    full = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = {
        f"{_TMP}off": F.coalesce(F.sum("rows").over(earlier), F.lit(0)),
        f"{_TMP}total": F.sum("rows").over(whole),
    }
    if "dense_rank" in kinds:
        carry[f"{_TMP}dense_off"] = F.coalesce(F.sum("dense").over(earlier), F.lit(0))
    for name, s in shifts.items():
        tail = F.col(f"tail_{name}")
        if s.ignore_nulls:
            filled, frame = F.when(F.size(tail) > 0, tail), later if s.lead else earlier
            carry[f"{_TMP}{name}_tail"] = (F.first if s.lead else F.last)(filled, ignorenulls=True).over(frame)
        else:
            # Every slot has a row, so the nearest ``offset`` slots are enough.
            frame = ordered.rowsBetween(1, s.offset) if s.lead else ordered.rowsBetween(-s.offset, -1)
            tails = F.collect_list(tail).over(frame)
            carry[f"{_TMP}{name}_tail"] = F.flatten(F.reverse(tails) if s.lead else tails)
    for name, s in edges.items():
        if s.kind == "nth":
            # Only one slot of a group holds its n-th row.
            before = F.coalesce(F.sum("rows").over(earlier), F.lit(0))
            slots = slots.withColumn(f"nth_{name}", F.get(f"edge_{name}", (s.n - 1 - before).cast("int")))
            carry[f"{_TMP}{name}_edge"] = F.first(f"nth_{name}", ignorenulls=True).over(full)
        else:
            pick = F.first if s.kind == "first" else F.last
            carry[f"{_TMP}{name}_edge"] = pick(f"edge_{name}", ignorenulls=True).over(full)
    slots = slots.withColumns(carry).select(slot, *carry)

    joined = base.join(slots, slot)
    rn = F.col(f"{_TMP}rn") + F.col(f"{_TMP}off")
    total = F.col(f"{_TMP}total")
    result = {}
    for name, s in columns.items():
        if isinstance(s, Rank):
            result[name] = _rank(s, rn, total)
        elif isinstance(s, Shift):
            # Near the slot's edge the local step finds nothing; then the neighbour slots' rows have the value.
            itself = F.when(F.col(f"{_TMP}{name}_value").isNotNull(), 1).otherwise(0)
            missing = s.offset - (F.col(f"{_TMP}{name}_seen") - itself)
            tail = F.coalesce(F.col(f"{_TMP}{name}_tail"), F.array())
            found = missing <= F.size(tail)
            near = F.get(tail, (F.size(tail) - missing).cast("int"))["v"]["v"]
            value = F.when(missing <= 0, F.col(f"{_TMP}{name}_local")["v"]).when(found, near)
            result[name] = value if s.default is None else F.when(found, value).otherwise(F.lit(s.default))
        else:
            result[name] = F.col(f"{_TMP}{name}_edge")["v"]
    return joined.select(*[F.col(_bt(c)) for c in df.columns], *[v.alias(k) for k, v in result.items()])


def ordered_checksum(df: DataFrame, groups, order_by, value: str) -> DataFrame:
    """(groups, checksum): equal for groups with the same values in the same order, for groups of any size.

    Each row's checksum covers its rank and its value, and these are added up, so a group is never put together and two
    rows that change places change the sum. Rows that tie in the order are put in the order of their values; NULL is a
    value.
    """
    groups, text = list(groups), F.coalesce(F.concat(F.lit("="), _col(value).cast("string")), F.lit("n"))
    ranked = spread_window(df, groups, [*order_by, asc(value)], {"__place": Rank("row_number")})
    part = F.conv(F.substring(F.md5(F.concat(F.col("__place").cast("string"), F.lit(":"), text)), 1, 15), 16, 10).cast("decimal(38,0)")
    return ranked.groupBy(*[_col(g) for g in groups]).agg(F.md5(F.sum(part).cast("string")).alias("checksum"))


def with_group_values(df: DataFrame, keys, columns: dict[str, Column]) -> DataFrame:
    """Aggregates of a row's group beside the row: grouped first, then joined back where NULL equals NULL.

    The grouped side has a key once, so adaptive execution can split the rows of a hot key.
    """
    keys = list(keys)
    names = [f"{_TMP}k{i}" for i in range(len(keys))]
    grouped = df.groupBy(*[_col(k).alias(n) for k, n in zip(keys, names)]).agg(*[v.alias(n) for n, v in columns.items()])
    same = reduce(lambda a, b: a & b, [_col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    return df.join(grouped, same, "left").drop(*names)


def _bt(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _local_shift(s: Shift, value: Column, local, backward) -> Column:
    if not s.ignore_nulls:
        return (F.lead if s.lead else F.lag)(value, s.offset).over(local)
    if s.offset != 1:
        raise ValueError("ignore_nulls is available for an offset of 1")
    # A frame that grows with the row is cheap; looking forward is looking back in the reversed order.
    seen = (backward if s.lead else local).rowsBetween(Window.unboundedPreceding, -1)
    return F.last(value, ignorenulls=True).over(seen)


def _rank(s: Rank, rn: Column, total: Column) -> Column:
    off = F.col(f"{_TMP}off")
    if s.kind == "row_number":
        return rn
    if s.kind == "rank":
        return F.col(f"{_TMP}rank") + off
    if s.kind == "dense_rank":
        return F.col(f"{_TMP}dense") + F.col(f"{_TMP}dense_off")
    if s.kind == "percent_rank":
        return F.when(total == 1, F.lit(0.0)).otherwise((F.col(f"{_TMP}rank") + off - 1) / (total - 1))
    if s.kind == "cume_dist":
        return (F.col(f"{_TMP}peers") + off) / total
    if s.kind == "ntile":
        small = F.floor(total / s.n)
        wide = total % s.n
        border = wide * (small + 1)
        return (
            F.when(rn <= border, F.floor((rn - 1) / (small + 1)) + 1)
            .otherwise(wide + F.floor((rn - 1 - border) / F.greatest(small, F.lit(1))) + 1)
            .cast("long")
        )
    raise ValueError(f"unknown rank: {s.kind}")
