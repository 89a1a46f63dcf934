"""Sums, averages, counts, least and largest values over frames of a window, for groups of any size.

A plain window puts a whole group into one task. Frames that grow from the group's start are taken in ranges, and a
row per group and range carries what came before. Frames of a number of rows are taken in chunks that bring the rows
near their ends along. Frames of a range of values turn into places in the sorted values of a group: sums are
differences of growing sums, least and largest values come from a table of runs whose lengths are powers of two.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.errors import ConfigError
from veritab.operators.canonical import column
from veritab.operators.ranking import Order, Rank, asc, in_ranges, spread_window
from veritab.session import materialise

#: Rows of a chunk for frames of a number of rows.
CHUNK = 20_000
_TMP = "__run_"
_KEY, _VALUE = f"{_TMP}key", f"{_TMP}value"
_FOLD = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Running:
    """sum, avg, count (of values that are not NULL), min or max of a column."""

    column: str
    kind: str

    def __post_init__(self):
        if self.kind not in ("sum", "avg", "count", "min", "max"):
            raise ConfigError(f"no running aggregate: {self.kind}")

    def parts(self) -> dict[str, Column]:
        """Aggregates that fold, from which the value is made."""
        c = column(self.column)
        made = {"sum": F.sum(c), "count": F.count(c), "min": F.min(c), "max": F.max(c)}
        return {k: made[k] for k in (("sum", "count") if self.kind in ("sum", "avg") else (self.kind,))}

    def value(self, parts: dict[str, Column]) -> Column:
        """The sum of no values is NULL."""
        if self.kind not in ("sum", "avg"):
            return parts[self.kind]
        return F.when(parts["count"] > 0, parts["sum"] if self.kind == "sum" else parts["sum"] / parts["count"])


def _joined(kind: str, a: Column, b: Column) -> Column:
    """Two partial aggregates as one; NULL is that of no rows."""
    if kind in ("sum", "count"):
        return F.coalesce(a + b, a, b)
    return F.least(a, b) if kind == "min" else F.greatest(a, b)


def growing(df: DataFrame, groups, order_by: list[Order], columns: dict[str, Running], peers: bool = False) -> DataFrame:
    """Aggregates from the group's start to the row; with ``peers`` to the last row that ties with it."""
    groups = list(groups)
    slot, part = f"{_TMP}slot", f"{_TMP}range"
    names = [f"p{i}" for i in range(len(groups))]
    ranged = in_ranges(df, [*[column(g) for g in groups], *[o.sort() for o in order_by]], part)
    # One struct holds group and range: it is never NULL itself, so joins on it match NULL parts too.
    base = ranged.withColumn(slot, F.struct(*[column(g).alias(n) for n, g in zip(names, groups, strict=True)], F.col(part).alias("b"))).drop(part)
    local = Window.partitionBy(slot).orderBy(*[o.sort() for o in order_by])
    local = local.rangeBetween(Window.unboundedPreceding, Window.currentRow) if peers else local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = {(name, kind): c for name, r in columns.items() for kind, c in r.parts().items()}
    here = {f"{_TMP}{name}_{kind}": c.over(local) for (name, kind), c in parts.items()}
    slots = base.groupBy(slot).agg(*[c.alias(f"{name}_{kind}") for (name, kind), c in parts.items()])
    earlier = Window.partitionBy(*[F.col(slot)[n] for n in names]).orderBy(F.col(slot)["b"]).rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.select(slot, *[_FOLD[kind](f"{name}_{kind}").over(earlier).alias(f"{_TMP}{name}_{kind}_before") for name, kind in parts])
    joined = base.withColumns(here).join(carried, slot)
    whole = {(n, k): _joined(k, F.col(f"{_TMP}{n}_{k}"), F.col(f"{_TMP}{n}_{k}_before")) for n, k in parts}
    out = {n: r.value({k: whole[n, k] for m, k in parts if m == n}) for n, r in columns.items()}
    return joined.select(*[column(c) for c in df.columns], *[c.alias(n) for n, c in out.items()])


def sliding(df: DataFrame, groups, order_by: list[Order], columns: dict[str, Running], before: int, after: int = 0) -> DataFrame:
    """Aggregates over the rows from ``before`` rows before the row to ``after`` rows after it.

    Rows that tie in the order keep the order that the ranks were given in. A chunk has CHUNK rows and those that its
    frames reach beyond, so frames should not be much longer than a chunk.
    """
    place, chunk, own = f"{_TMP}place", f"{_TMP}chunk", f"{_TMP}own"
    ranked = materialise(spread_window(df, list(groups), order_by, {place: Rank("row_number")}), "ranked")
    of = lambda shift: F.floor((F.col(place) + shift) / CHUNK).cast("long")
    # A row is wanted by the chunks of the rows whose frames it is in.
    dealt = ranked.withColumns({chunk: F.explode(F.sequence(of(-after), of(before))), own: of(0)})
    window = Window.partitionBy(*[column(g) for g in groups], chunk).orderBy(place)
    frame = window.rowsBetween(-before, after)
    out = {n: r.value({k: c.over(frame) for k, c in r.parts().items()}) for n, r in columns.items()}
    return dealt.select(*[column(c) for c in df.columns], chunk, own, *[c.alias(n) for n, c in out.items()]).where(F.col(chunk) == F.col(own)).drop(chunk, own)


def by_value(df: DataFrame, groups, order: str, columns: dict[str, Running], below, above) -> DataFrame:
    """Aggregates over the rows whose order value is from ``below`` under the row's own to ``above`` over it.

    ``below`` and ``above`` are numbers, or intervals for dates and times. Rows without an order value are a frame of
    their own. Sums are differences of two sums, so those of floating point numbers are rounded.
    """
    groups = list(groups)
    keys = [f"{_TMP}g{i}" for i in range(len(groups))] + [f"{_TMP}null"]
    x = f"{_TMP}x"
    parts = {f"{n}_{k}": (k, c) for n, r in columns.items() for k, c in r.parts().items()}
    marked = df.select("*", *[column(g).alias(k) for g, k in zip(groups, keys, strict=False)], column(order).isNull().alias(keys[-1]))
    folded = marked.groupBy(*keys, column(order).alias(x)).agg(*[c.alias(n) for n, (_, c) in parts.items()])
    folded = materialise(folded, "values")

    # Values, and before and behind them the ends of the frames: running sums at an end are those of the values up to it.
    at, kind = f"{_TMP}at", f"{_TMP}kind"
    as_end = (lambda c: c.cast(_type(df, column(order) - below)))
    ends = [F.struct(as_end(e).alias("at"), F.lit(i).alias("kind")) for i, e in enumerate((F.col(x) - below, F.col(x), F.col(x) + above))]
    events = folded.select("*", F.explode(F.array(*ends)).alias("e")).select("*", F.col("e.at").alias(at), F.col("e.kind").alias(kind)).drop("e")
    sums = [n for n, (k, _) in parts.items() if k in ("sum", "count")]
    is_value = F.col(kind) == 1
    events = events.withColumns({**{n: F.when(is_value, F.col(n)) for n in sums}, f"{_TMP}one": F.when(is_value, 1)})
    run = {f"{_TMP}upto_{n}": Running(n, "sum") for n in sums} | {f"{_TMP}rank": Running(f"{_TMP}one", "count")}
    grown = growing(events, keys, [asc(at), asc(kind)], run, peers=True)
    # Keys may be NULL, so they travel as structs, which are not.
    pick = lambda name, k: F.max(F.when(F.col(kind) == k, F.col(name)))
    frames = grown.groupBy(F.struct(*[F.col(k) for k in keys]).alias(_KEY), F.struct(F.col(x)).alias(_VALUE)).agg(
        *[(F.coalesce(pick(f"{_TMP}upto_{n}", 2), F.lit(0)) - F.coalesce(pick(f"{_TMP}upto_{n}", 0), F.lit(0))).alias(n) for n in sums],
        *[F.max(F.when(is_value, F.col(n))).alias(n) for n in parts if n not in sums],
        pick(f"{_TMP}rank", 1).alias("place"), (pick(f"{_TMP}rank", 0) + 1).alias("first"), pick(f"{_TMP}rank", 2).alias("last"),
    )
    frames = _extremes(materialise(frames, "frames"), {n: k for n, (k, _) in parts.items() if n not in sums})

    made = [r.value({k: F.col(f"{_TMP}{n}_{k}") for k in r.parts()}).alias(n) for n, r in columns.items()]
    rows = marked.withColumns({_KEY: F.struct(*[F.col(k) for k in keys]), _VALUE: F.struct(column(order).alias(x))})
    frames = frames.select(_KEY, _VALUE, *[F.col(n).alias(f"{_TMP}{n}") for n in parts])
    return rows.join(frames, [_KEY, _VALUE]).select(*[column(c) for c in df.columns], *made)


def _type(df: DataFrame, c: Column) -> str:
    return df.select(c.alias("v")).schema["v"].dataType.simpleString()


def _extremes(frames: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Least and largest values of places ``first`` to ``last`` of each group, in place of those of the single place.

    The runs of 2, 4, 8, ... places are made by joining the runs of half the length; any frame is two of these runs.
    """
    if not kinds:
        return frames
    longest = max(1, frames.agg(F.max(F.col("last") - F.col("first") + 1)).first()[0] or 1)
    others = [c for c in frames.columns if c not in kinds]
    runs = frames.select(_KEY, "place", *kinds)
    level = F.floor(F.log2(F.col("last") - F.col("first") + 1.5)).cast("int")
    out = frames.where("first > last").select(*others, *[F.nullif(F.col(n), F.col(n)).alias(n) for n in kinds])  # of no rows
    for k in range(int(longest).bit_length()):
        length = 1 << k
        a = runs.select(_KEY, F.col("place").alias("first"), *[F.col(n).alias(f"a_{n}") for n in kinds])
        b = runs.select(_KEY, (F.col("place") + length - 1).alias("last"), *[F.col(n).alias(f"b_{n}") for n in kinds])
        asked = frames.select(*others).where((F.col("first") <= F.col("last")) & (level == k)).join(a, [_KEY, "first"]).join(b, [_KEY, "last"])
        found = asked.select(*others, *[_joined(kind, F.col(f"a_{n}"), F.col(f"b_{n}")).alias(n) for n, kind in kinds.items()])
        out = out.unionByName(found)
        if k + 1 < int(longest).bit_length():
            after = runs.select(_KEY, (F.col("place") - length).alias("place"), *[F.col(n).alias(f"b_{n}") for n in kinds])
            doubled = runs.join(after, [_KEY, "place"])  # a run that would pass the end is none
            runs = materialise(doubled.select(_KEY, "place", *[_joined(kind, F.col(n), F.col(f"b_{n}")).alias(n) for n, kind in kinds.items()]), "runs")
    return out
