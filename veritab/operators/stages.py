"""Data-flow stages, each a function from DataFrames to DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.operators.canonical import column
from veritab.operators.changes import one_row_per_key
from veritab.operators.ranking import Order, Rank, asc, spread_window


def aggregate(df: DataFrame, group, **aggregates: Column) -> DataFrame:
    return df.groupBy(*group).agg(*[c.alias(n) for n, c in aggregates.items()])


def change_capture(before: DataFrame, after: DataFrame, keys, values=None) -> DataFrame:
    """Key, ``change`` (insert, update, delete, copy) and the values: the new ones, or the old ones of a delete.

    Both sides are folded per key in one aggregation, so there is no join that a hot key could slow down.
    A key with different rows on one side is an error.
    """
    keys = list(keys)
    values = list(values or [c for c in before.columns if c not in keys])
    row = F.struct(*[column(v) for v in values]).alias("row")
    picked = [d.select(*[column(k) for k in keys], row, F.lit(s).alias("new")) for d, s in ((before, False), (after, True))]
    old, new = F.when(~F.col("new"), F.col("row")), F.when(F.col("new"), F.col("row"))
    folded = (
        picked[0]
        .unionAll(picked[1])
        .groupBy(*[column(k) for k in keys])
        .agg(F.min(old).alias("old"), F.max(old).alias("old2"), F.min(new).alias("new"), F.max(new).alias("new2"))
    )
    clash = ~F.col("old").eqNullSafe(F.col("old2")) | ~F.col("new").eqNullSafe(F.col("new2"))
    change = (
        F.when(clash, F.raise_error(F.lit("a key has different rows on one side")).cast("string"))
        .when(F.col("old").isNull(), "insert")
        .when(F.col("new").isNull(), "delete")
        .when(F.col("old").eqNullSafe(F.col("new")), "copy")
        .otherwise("update")
    )
    shown = F.coalesce(F.col("new"), F.col("old"))
    return folded.select(
        *[column(k) for k in keys], *[shown.getField(v).alias(v) for v in values], change.alias("change")
    )


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` beyond those of ``b``, copies counted."""
    return a.exceptAll(b)


def export_columns(df: DataFrame, columns, into: str, separator: str = ",") -> DataFrame:
    """Several columns as one delimited text column; NULL becomes empty text so that places stay."""
    parts = [F.coalesce(column(c).cast("string"), F.lit("")) for c in columns]
    return df.withColumn(into, F.concat_ws(separator, *parts)).drop(*columns)


def import_columns(df: DataFrame, text: str, columns: dict[str, str], separator: str = ",") -> DataFrame:
    """A delimited text column as typed columns ``{name: type}``; empty text becomes NULL."""
    literal = "".join("\\" + ch if not ch.isalnum() else ch for ch in separator)
    parts = F.split(column(text), literal, -1)
    return df.withColumns(
        {n: F.nullif(F.get(parts, F.lit(i)), F.lit("")).try_cast(t) for i, (n, t) in enumerate(columns.items())}
    ).drop(text)


def import_json(df: DataFrame, text: str, schema: str) -> DataFrame:
    """A JSON text column as typed columns."""
    return df.withColumn("__json", F.from_json(column(text), schema)).select(
        *[column(c) for c in df.columns if c != text], "__json.*"
    )


def copy(df: DataFrame, *selections) -> list[DataFrame]:
    """The same rows to several outputs, each with its own columns (all columns for None)."""
    return [df if s is None else df.select(*s) for s in selections]


def copy_column(df: DataFrame, name: str, new_name: str) -> DataFrame:
    return df.withColumn(new_name, column(name))


def route(df: DataFrame, outputs: list[tuple[str, Column]], default: str, name: str = "output") -> DataFrame:
    """Name of the first output whose condition holds."""
    choice = reduce(
        lambda acc, o: acc.when(o[1], F.lit(o[0])), outputs[1:], F.when(outputs[0][1], F.lit(outputs[0][0]))
    )
    return df.withColumn(name, choice.otherwise(F.lit(default)))


def split_rows(df: DataFrame, outputs: list[tuple[str, Column]], default: str) -> dict[str, DataFrame]:
    """Each row to the first output whose condition holds, otherwise to the default output."""
    routed = route(df, outputs, default, "__output")
    return {
        n: routed.filter(F.col("__output") == n).drop("__output") for n in dict.fromkeys([o[0] for o in outputs] + [default])
    }


def funnel(*frames: DataFrame) -> DataFrame:
    """Rows of many inputs under each other, by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def sorted_merge(order, *frames: DataFrame) -> DataFrame:
    """Rows of many inputs in one order."""
    return funnel(*frames).orderBy(*order)


def join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    return left.join(right, on, how)


def lookup(df: DataFrame, reference: DataFrame, on: dict, columns, found: str | None = None) -> DataFrame:
    """Reference columns beside each row; NULL where the reference has no row.

    No broadcast is forced: Spark broadcasts a reference below its size limit and sorts a larger one, and
    adaptive execution splits keys that many rows look up.
    """
    names = {r: f"__r{i}" for i, r in enumerate(on.values())}
    side = reference.select(
        *[column(r).alias(n) for r, n in names.items()], *[column(c) for c in columns], F.lit(True).alias("__found")
    )
    same = reduce(lambda a, b: a & b, [column(l) == F.col(names[r]) for l, r in on.items()])
    joined = df.join(side, same, "left")
    out = joined.drop(*names.values())
    if found:
        return out.withColumn(found, F.coalesce(F.col("__found"), F.lit(False))).drop("__found")
    return out.drop("__found")


def merge_update(master: DataFrame, update: DataFrame, keys) -> DataFrame:
    """Master rows with the update's values where the update has the key."""
    keys = list(keys)
    shared = [c for c in update.columns if c not in keys]
    new = one_row_per_key(update, keys).toDF(*[f"__u_{c}" for c in keys + shared]).withColumn("__hit", F.lit(True))
    same = reduce(lambda a, b: a & b, [column(k) == column(f"__u_{k}") for k in keys])
    joined = master.join(new, same, "left")
    return joined.select(
        *[
            F.when(F.col("__hit"), column(f"__u_{c}")).otherwise(column(c)).alias(c) if c in shared else column(c)
            for c in master.columns
        ]
    )


def modify(df: DataFrame, rename: dict | None = None, drop=(), cast: dict | None = None, derive: dict | None = None):
    """Derived columns first, then casts, drops and new names."""
    if derive:
        df = df.withColumns(derive)
    if cast:
        df = df.withColumns({c: column(c).cast(t) for c, t in cast.items()})
    return df.drop(*drop).withColumnsRenamed(rename or {})


def character_map(df: DataFrame, upper=(), lower=()) -> DataFrame:
    return df.withColumns({**{c: F.upper(column(c)) for c in upper}, **{c: F.lower(column(c)) for c in lower}})


def peek(df: DataFrame, order, n: int = 10) -> DataFrame:
    return df.orderBy(*order).limit(n)


def pivot_rows(df: DataFrame, keys, order, values, count: int) -> DataFrame:
    """The first ``count`` rows of each key side by side, as ``<value>_1``, ``<value>_2``, ..."""
    numbered = spread_window(df, keys, [asc(o) for o in order], {"__rn": Rank("row_number")})
    cells = [
        F.max(F.when(F.col("__rn") == i, column(v))).alias(f"{v}_{i}") for i in range(1, count + 1) for v in values
    ]
    return numbered.groupBy(*[column(k) for k in keys]).agg(*cells)


def unpivot(df: DataFrame, keys, columns, name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot([column(k) for k in keys], [column(c) for c in columns], name, value)


def remove_duplicates(df: DataFrame, keys, order=None, keep: str = "first") -> DataFrame:
    """One row per key: the first or last by an order. Rows fold before the shuffle, so a hot key costs no more."""
    if order is None:
        return df.dropDuplicates(list(keys))
    rest = [c for c in df.columns if c not in keys]
    # All columns follow the order columns, so that equal order values cannot give two answers.
    place = F.struct(*[column(o).alias(f"o{i}") for i, o in enumerate(order)], *[column(c).alias(f"r{i}") for i, c in enumerate(rest)])
    best = (F.min if keep == "first" else F.max)(place).alias("__best")
    picked = df.groupBy(*[column(k) for k in keys]).agg(best)
    kept = {c: F.col("__best").getField(f"r{i}").alias(c) for i, c in enumerate(rest)}
    return picked.select(*[kept.get(c, column(c)) for c in df.columns])


def generate_rows(df: DataFrame, count: Column, name: str = "n") -> DataFrame:
    """Each row as often as ``count`` says, numbered from 1; no rows for NULL, zero or less."""
    numbers = F.when(count > 0, F.sequence(F.lit(1).cast("long"), count.cast("long")))
    return df.select("*", F.explode(numbers).alias(name))


def surrogate_keys(df: DataFrame, order, name: str = "sk", start: int = 0) -> DataFrame:
    """Keys ``start + 1``, ``start + 2``, ... without gaps, in the given order; no task sees all rows.

    Ranges are cut along the whole order, so a frequent first sort value is split by the columns after it.
    """
    order = [o if isinstance(o, Order) else asc(o) for o in order]
    numbered = spread_window(df, [], order, {name: Rank("row_number")})
    return numbered.withColumn(name, F.col(name) + F.lit(start))


def identity_column(df: DataFrame, name: str = "id") -> DataFrame:
    """Increasing unique numbers with gaps: no shuffle at all."""
    return df.withColumn(name, F.monotonically_increasing_id())


def tail(df: DataFrame, order: list[Order], n: int) -> DataFrame:
    """The last ``n`` rows of an order, in that order."""
    return df.orderBy(*[o.reversed().sort() for o in order]).limit(n).orderBy(*[o.sort() for o in order])


def audit_columns(df: DataFrame, user: str, task: str) -> DataFrame:
    return df.withColumns({"audit_ts": F.current_timestamp(), "audit_user": F.lit(user), "audit_task": F.lit(task)})


def row_count(df: DataFrame, step: str) -> DataFrame:
    """One log row with the number of rows of a step."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(step).alias("step"), "row_count")


def transform(df: DataFrame, columns: dict[str, Column], constraint: Column | None = None) -> DataFrame:
    """Computed columns, then a constraint on them."""
    out = df.select(*[c.alias(n) for n, c in columns.items()])
    return out.filter(constraint) if constraint is not None else out


def scd(
    current: DataFrame, incoming: DataFrame, keys, tracked, kind: int, as_of: Column | None = None
) -> DataFrame:
    """Slowly changing dimension of type 1, 2 or 3.

    1  overwrite tracked columns, add new keys
    2  ``current`` has valid_from, valid_to and is_current; changed rows are closed and a new version is added
    3  ``current`` has ``previous_<c>`` per tracked column, which takes the old value
    """
    keys, tracked, names = list(keys), list(tracked), current.columns
    new = one_row_per_key(incoming.select(*[column(c) for c in keys + tracked]), keys)
    new = new.toDF(*[f"n_{c}" for c in new.columns])
    same = reduce(lambda a, b: a & b, [column(k) == column(f"n_{k}") for k in keys])
    live = F.col("is_current") if kind == 2 else F.lit(True)
    known = current.filter(live).select(*[column(k) for k in keys]).distinct()
    # A left join and an anti join instead of a full one: adaptive execution can split their hot keys.
    fresh = new.join(known, same, "left_anti")
    joined = current.join(new.withColumn("n_present", F.lit(True)), same & F.coalesce(live, F.lit(False)), "left")
    hit = F.coalesce(F.col("n_present"), F.lit(False))

    def row(values: dict) -> list[Column]:
        return [values.get(c, F.lit(None)).cast(current.schema[c].dataType).alias(c) for c in names]

    first = {c: column(f"n_{c}") for c in keys + tracked}
    if kind in (1, 3):
        kept = {c: column(c) for c in names}
        kept |= {t: F.when(hit, column(f"n_{t}")).otherwise(column(t)) for t in tracked}
        if kind == 3:
            for t in tracked:
                moved = hit & ~column(t).eqNullSafe(column(f"n_{t}"))
                kept[f"previous_{t}"] = F.when(moved, column(t)).otherwise(column(f"previous_{t}"))
        return joined.select(*row(kept)).unionByName(fresh.select(*row(first)))
    if kind != 2:
        raise ValueError("type is 1, 2 or 3")
    day = as_of if as_of is not None else F.current_date()
    first |= {"valid_from": day, "is_current": F.lit(True)}
    moved = hit & reduce(lambda a, b: a | b, [~column(t).eqNullSafe(column(f"n_{t}")) for t in tracked])
    closed = {c: column(c) for c in names}
    closed |= {"valid_to": F.when(moved, day).otherwise(F.col("valid_to")), "is_current": F.col("is_current") & ~moved}
    # A changed row gives two rows, its closed version and the new one.
    versions = F.when(moved, F.array(F.struct(*row(closed)), F.struct(*row(first)))).otherwise(
        F.array(F.struct(*row(closed)))
    )
    return joined.select(F.inline(versions)).unionByName(fresh.select(*row(first)))
