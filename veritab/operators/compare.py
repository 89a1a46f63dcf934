"""Comparing two tables by key or by row hash.

A full outer join on the key can neither be split by adaptive execution nor survive a key that holds a
large share of both tables, because it emits every pair. The comparison here is a union and a grouped sum
instead: rows of a key fold together before the shuffle, and for keys with copies the number of pairs the
join would have made is a product of two counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.config import TableConfig
from veritab.errors import ColumnSetError, ConfigError
from veritab.operators.canonical import (
    HASH_COLUMN,
    canonical_column,
    column,
    comparable,
    lower_names,
    side_column,
    side_filter,
)
from veritab.operators.ranking import Order, Rank, asc, spread_window
from veritab.session import materialise

MATCH, MISMATCH = "match", "mismatch"
MISSING_IN_SOURCE, MISSING_IN_TARGET = "missing_in_src", "missing_in_tgt"
PAIRS = "decimal(38,0)"
_SMALL = 1 << 20


def two_sided(source: DataFrame, target: DataFrame, columns) -> DataFrame:
    """Both sides under each other, with one count column per side."""
    pick = [column(c) for c in columns]
    return source.select(*pick, F.lit(1).alias("src_rows"), F.lit(0).alias("tgt_rows")).unionAll(
        target.select(*pick, F.lit(0).alias("src_rows"), F.lit(1).alias("tgt_rows"))
    )


def _fold(df: DataFrame, columns) -> DataFrame:
    return df.groupBy(*[column(c) for c in columns]).agg(
        F.sum("src_rows").alias("src_rows"), F.sum("tgt_rows").alias("tgt_rows")
    )


def key_counts(source: DataFrame, target: DataFrame, keys) -> DataFrame:
    """One row per key of either side with its rows per side; NULL is a key like others.

    All state is two numbers per key, so rows of a hot key fold before they are shuffled.
    """
    return _fold(two_sided(source, target, keys), keys)


_SHARED_COPIES = "src_rows > 0 and tgt_rows > 0 and (src_rows > 1 or tgt_rows > 1)"


def match_keys(source: DataFrame, target: DataFrame, keys, value: str = HASH_COLUMN) -> DataFrame:
    """One row per key of either side: rows per side and the number of matching pairs.

    Rows are counted by key and value, then the counts are added up by key: the pairs of equal rows are products of
    counts. Both tables are read once, and rows of a hot key or value fold before they are shuffled.
    """
    keys = list(keys)
    marked = _compact(value) if value == HASH_COLUMN else column(value)
    sides = [d.select(*[column(k) for k in keys], marked.alias(value)) for d in (source, target)]
    per_value = _fold(two_sided(*sides, keys + [value]), keys + [value])
    src, tgt = F.col("src_rows"), F.col("tgt_rows")
    # Products of small counts stay in a long, whose sum cannot overflow; only huge groups need a decimal.
    small = (src < _SMALL) & (tgt < _SMALL)
    wide = src.cast("decimal(19,0)") * tgt.cast("decimal(19,0)")
    pairs = F.coalesce("__small", F.lit(0)).cast(PAIRS) + F.coalesce("__wide", F.lit(0))
    return (
        per_value.groupBy(*[column(k) for k in keys])
        .agg(
            F.sum("src_rows").alias("src_rows"),
            F.sum("tgt_rows").alias("tgt_rows"),
            F.sum(F.when(small, src * tgt)).alias("__small"),
            F.sum(F.when(~small, wide)).cast(PAIRS).alias("__wide"),
        )
        .select(*[column(k) for k in keys], "src_rows", "tgt_rows", pairs.cast(PAIRS).alias("match_pairs"))
    )


def classify(source: DataFrame, target: DataFrame, keys, value: str = HASH_COLUMN) -> DataFrame:
    """Key columns, class and number of rows (pairs for a key that several rows share).

    A side is missing when it has no row of the key; a NULL hash is a value, never a missing row.
    """
    counts = match_keys(source, target, keys, value)
    src, tgt, match = F.col("src_rows"), F.col("tgt_rows"), F.col("match_pairs")
    pairs = (src.cast("decimal(19,0)") * tgt.cast("decimal(19,0)")).cast(PAIRS)

    def entry(label, n):
        return F.struct(label.alias("class"), n.cast(PAIRS).alias("rows"))

    label = (
        F.when(src == 0, MISSING_IN_SOURCE)
        .when(tgt == 0, MISSING_IN_TARGET)
        .when(match > 0, MATCH)
        .otherwise(MISMATCH)
    )
    single = entry(label, F.when((src > 0) & (tgt > 0), F.lit(1).cast("long")).otherwise(src + tgt))
    both = F.array(entry(F.lit(MATCH), match), entry(F.lit(MISMATCH), pairs - match))
    found = F.when(F.expr(_SHARED_COPIES), both).otherwise(F.array(single))
    return counts.select(*[column(k) for k in keys], F.inline(found)).filter("rows > 0")


def class_counts(classified: DataFrame) -> DataFrame:
    """Rows per class: the counts of a run in one job."""
    return classified.groupBy("class").agg(F.sum("rows").cast(PAIRS).alias("rows"))


def compare_data(source: DataFrame, target: DataFrame, config: TableConfig, system: str = "default") -> DataFrame:
    """Keyed report: match, mismatch, missing_in_src, missing_in_tgt per key."""
    names = lower_names(source).columns
    return classify(
        comparable(source, config, "source", "data", names, system),
        comparable(target, config, "target", "data", names, system),
        config.keys,
    )


def compare_rows(source: DataFrame, target: DataFrame, config: TableConfig, system: str = "default") -> DataFrame:
    """Row report: rows whose hash the other side does not have, with their number. Never a mismatch."""
    names = lower_names(source).columns
    left = comparable(source, config, "source", "row", names, system)
    right = comparable(target, config, "target", "row", names, system)
    if set(left.columns) != set(right.columns):
        raise ColumnSetError(f"hash columns differ: {left.columns} and {right.columns}")
    return rows_of_hashes(left, right, one_sided_hashes(left, right))


def one_sided_hashes(left: DataFrame, right: DataFrame) -> DataFrame:
    """Hashes that one side lacks, with the side. Only hashes are shuffled, as 32 bytes each."""
    return (
        _fold(two_sided(*[d.select(_compact(HASH_COLUMN).alias("h")) for d in (left, right)], ["h"]), ["h"])
        .filter("src_rows = 0 or tgt_rows = 0")
        .select(F.col("h").alias("__h"), (F.col("tgt_rows") == 0).alias("__from_source"))
    )


def rows_of_hashes(left: DataFrame, right: DataFrame, hashes: DataFrame) -> DataFrame:
    """Full rows of one-sided hashes, equal rows folded. Write ``hashes`` first to let Spark see how few they are."""
    columns = [c for c in left.columns if c != HASH_COLUMN]
    # The two sides may differ in type (a mapped column, another system), so rows are shown as text.
    text = [column(c).cast("string").alias(c) for c in columns]
    both = left.select(_compact(HASH_COLUMN).alias("h"), *text, F.lit(True).alias("from_source")).unionAll(
        right.select(_compact(HASH_COLUMN).alias("h"), *text, F.lit(False).alias("from_source"))
    )
    on = F.col("h").eqNullSafe(F.col("__h")) & (F.col("from_source") == F.col("__from_source"))
    label = F.when(F.col("from_source"), MISSING_IN_TARGET).otherwise(MISSING_IN_SOURCE)
    return (
        both.join(hashes, on)
        .groupBy(*[column(c) for c in columns], label.alias("class"))
        .agg(F.count(F.lit(1)).cast(PAIRS).alias("rows"))
    )


def _compact(name: str) -> Column:
    """The hash as bytes: half the size of its text in a shuffle."""
    return F.unhex(column(name))


def duplicate_keys(source: DataFrame, target: DataFrame, keys) -> DataFrame:
    """Keys that a side holds more than once, with their rows per side."""
    return key_counts(source, target, keys).filter("src_rows > 1 or tgt_rows > 1")


def pair_rows(source: DataFrame, target: DataFrame, keys, unique_keys: bool = False) -> DataFrame:
    """Rows of both sides that share a key, as columns ``<keys>, s, t, rows`` with a struct per side.

    A key held once per side gives one pair. Rows of a key held several times are paired one to one:
    equal rows with each other, the rest in a fixed order, so the result grows with the input and not
    with the square of a key's rows; a copy without a partner has a NULL on the other side. ``rows`` is
    the number of equal rows a pair stands for. Pass ``unique_keys`` only where the keys were checked.
    """
    keys = list(keys)
    values = [c for c in source.columns if c not in keys]
    if set(target.columns) != set(source.columns):
        raise ColumnSetError(f"columns differ: {source.columns} and {target.columns}")
    row = F.struct(*[column(v) for v in values])
    left, right = (d.select(*[column(k) for k in keys], row.alias("v")) for d in (source, target))
    names = [f"__k{i}" for i in range(len(keys))]
    if unique_keys:
        right = right.toDF(*names, "t")
        return left.join(right, _same(keys, names)).select(
            *[column(k) for k in keys], F.col("v").alias("s"), "t", F.lit(1).cast("long").alias("rows")
        )

    # Equal rows are folded and stored once; keys with and without copies both start from that.
    folded = materialise(_fold(two_sided(left, right, keys + ["v"]), keys + ["v"]), "pairs")
    per_key = folded.groupBy(*[column(k) for k in keys]).agg(
        F.sum("src_rows").alias("src_rows"),
        F.sum("tgt_rows").alias("tgt_rows"),
        F.first(F.when(F.col("src_rows") > 0, F.col("v")), ignorenulls=True).alias("s"),
        F.first(F.when(F.col("tgt_rows") > 0, F.col("v")), ignorenulls=True).alias("t"),
    )
    single = per_key.filter("src_rows = 1 and tgt_rows = 1").select(*[column(k) for k in keys], "s", "t", F.lit(1).cast("long").alias("rows"))
    shared = materialise(per_key.filter(_SHARED_COPIES).select(*[column(k).alias(n) for k, n in zip(keys, names)]), "copied-keys")
    if shared.isEmpty():
        return single
    return single.unionByName(_pair_copies(folded.join(shared, _same(keys, names), "left_semi"), keys))


def _same(keys, names) -> Column:
    return reduce(lambda a, b: a & b, [column(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])


def _pair_copies(distinct: DataFrame, keys) -> DataFrame:
    key_columns = [column(k) for k in keys]
    equal = distinct.filter("src_rows > 0 and tgt_rows > 0").select(
        *key_columns, F.col("v").alias("s"), F.col("v").alias("t"), F.least("src_rows", "tgt_rows").alias("rows")
    )
    rest = distinct.filter("src_rows <> tgt_rows").select(
        *key_columns,
        "v",
        (F.col("src_rows") > F.col("tgt_rows")).alias("from_source"),
        F.abs(F.col("src_rows") - F.col("tgt_rows")).alias("rows"),
        F.xxhash64("v").alias("mark"),
    )
    numbered = spread_window(
        rest,
        key_columns + [F.col("from_source")],
        [asc("mark"), Order(F.to_json("v"))],
        {"copy": Rank("row_number")},
    ).groupBy(*key_columns, "copy").agg(
        F.max(F.when(F.col("from_source"), F.struct("v", "rows"))).alias("a"),
        F.max(F.when(~F.col("from_source"), F.struct("v", "rows"))).alias("b"),
    )
    return equal.unionByName(
        numbered.select(
            *key_columns,
            F.col("a")["v"].alias("s"),
            F.col("b")["v"].alias("t"),
            F.greatest(F.col("a")["rows"], F.col("b")["rows"]).alias("rows"),
        )
    )


def side_by_side(source: DataFrame, target: DataFrame, keys, unique_keys: bool = False) -> DataFrame:
    """Keys, then ``<c>_base``, ``<c>_compare`` and ``<c>_match`` of every other column, by name."""
    keys = list(keys)
    if source.columns != target.columns:
        raise ColumnSetError(
            "both sides need the same columns; "
            f"missing in source: {[c for c in target.columns if c not in source.columns] or None}; "
            f"missing in target: {[c for c in source.columns if c not in target.columns] or None}"
        )
    paired = pair_rows(source, target, keys, unique_keys)
    out = {}
    for c in source.columns:
        if c not in keys:
            base, other = F.col("s").getField(c), F.col("t").getField(c)
            out[f"{c}_base"], out[f"{c}_compare"], out[f"{c}_match"] = base, other, base == other
    return paired.select(*[column(k) for k in keys], *[out[n].alias(n) for n in sorted(out)])


def mismatching_columns(captured: DataFrame) -> DataFrame:
    """One row per compared column: does any captured row differ in it, and how many do? A NULL comparison counts as different."""
    names = [c[: -len("_match")] for c in captured.columns if c.endswith("_match")]
    counts = captured.agg(*[F.count_if(~F.coalesce(column(f"{n}_match"), F.lit(False))).alias(n) for n in names])
    each = [F.struct(F.lit(n).alias("column_name"), (column(n) > 0).alias("differs"), column(n).alias("rows")) for n in names]
    return counts.select(F.inline(F.array(*each)))


def fetch_by_keys(df: DataFrame, key_rows: DataFrame, keys) -> DataFrame:
    """Full rows of a set of keys of any size. Spark broadcasts the keys where they are few enough; store them to let it know."""
    names = [f"__k{i}" for i in range(len(keys))]
    wanted = key_rows.select(*[column(k).alias(n) for k, n in zip(keys, names)]).distinct()
    return df.join(wanted, _same(keys, names), "left_semi")


def plain_rows(df: DataFrame, config: TableConfig, side: str, source_columns=None) -> DataFrame:
    """Compared columns of one side as text in canonical form, keys raw: the rows shown in a report."""
    df = side_filter(lower_names(df), config.source_filter if side == "source" else config.target_filter)
    names = config.hash_columns(source_columns or df.columns, "data")
    if not config.keys:
        raise ConfigError("join columns are needed to fetch rows by key")
    rest = [n for n in names if n not in config.keys]
    return df.select(
        *[side_column(df, config, side, k) for k in config.keys],
        *[canonical_column(df, config, side, n) for n in rest],
    )
