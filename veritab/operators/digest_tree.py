"""Comparing two tables by a tree of digests: only rows under nodes that differ are compared row by row.

Every row belongs to a leaf, by a hash of its key (or of the row itself). A leaf's digest is the sum of the hashes of
its rows, which no order and no partitioning changes, so it is built where the rows are read; a node's digest is the
sum of its leaves'. Source rows count positive and target rows negative: a node whose sums are all zero holds the same
rows on both sides. What is shuffled is one row per leaf and task at most, however large the tables are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.config import TableConfig
from veritab.errors import ColumnSetError, ConfigError
from veritab.operators.canonical import HASH_COLUMN, column, comparable, lower_names
from veritab.operators.compare import MATCH, PAIRS, classify, one_sided_hashes, rows_of_hashes
from veritab.session import materialise

#: Bits of a leaf's number, and of the step from a level to the next.
LEAF_BITS, LEVEL_BITS = 16, 4
_LOW = (1 << 32) - 1
_SUMS = ("high_a", "low_a", "high_b", "low_b")


def leaf_of(columns: list[Column]) -> Column:
    """Number of the leaf that rows with these values belong to; NULL is a value like others."""
    marked = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("n")) for c in columns]
    return F.shiftrightunsigned(F.xxhash64(*marked), 64 - LEAF_BITS).cast("int").alias("leaf")


def leaf_differences(source: DataFrame, target: DataFrame, leaf: list[str], value: str = HASH_COLUMN) -> DataFrame:
    """(leaf, src_rows, tgt_rows, sums): stored, one row per leaf that has rows. The sums of equal leaves are zero.

    Two hashes of 64 bits a row are added up in halves, which do not overflow below 2^31 rows of a leaf.
    """

    def side(df: DataFrame, sign: int) -> DataFrame:
        a, b = F.xxhash64(F.lit(1), column(value)), F.xxhash64(F.lit(2), column(value))
        parts = [F.shiftrightunsigned(a, 32), a.bitwiseAND(_LOW), F.shiftrightunsigned(b, 32), b.bitwiseAND(_LOW)]
        counts = [F.lit(int(sign > 0)).cast("long").alias("src_rows"), F.lit(int(sign < 0)).cast("long").alias("tgt_rows")]
        return df.select(leaf_of([column(c) for c in leaf]), *counts, *[(p * sign).alias(n) for n, p in zip(_SUMS, parts, strict=True)])

    both = side(source, 1).unionAll(side(target, -1))
    return materialise(both.groupBy("leaf").agg(*[F.sum(c).alias(c) for c in ("src_rows", "tgt_rows", *_SUMS)]), "leaves")


def _differs() -> Column:
    return reduce(lambda a, b: a | b, [F.col("src_rows") != F.col("tgt_rows"), *[F.col(c) != 0 for c in _SUMS]])


def nodes(leaves: DataFrame, level: int) -> DataFrame:
    """The nodes of a level; level 0 is the root. Node numbers are the leading bits of their leaves'."""
    up = LEAF_BITS - LEVEL_BITS * level
    if up < 0:
        raise ConfigError(f"the tree has levels 0 to {LEAF_BITS // LEVEL_BITS}")
    # Of a root over very many rows the sums may leave the range of a long.
    return leaves.groupBy(F.shiftright("leaf", up).alias("node")).agg(*[F.sum(F.col(c).cast("decimal(19,0)")).cast(PAIRS).alias(c) for c in ("src_rows", "tgt_rows", *_SUMS)])


def differing_nodes(leaves: DataFrame) -> DataFrame:
    """(level, node, src_rows, tgt_rows): from the root down, only nodes under one that differs are compared."""
    under, out = leaves, None
    for level in range(LEAF_BITS // LEVEL_BITS + 1):
        found = nodes(under, level).where(_differs()).select(F.lit(level).alias("level"), "node", "src_rows", "tgt_rows")
        out = found if out is None else out.unionAll(found)
        up = LEAF_BITS - LEVEL_BITS * level
        under = under.join(found.select("node"), F.shiftright("leaf", up) == F.col("node"), "left_semi")
    return out


def are_equal(leaves: DataFrame) -> bool:
    return not leaves.where(_differs()).take(1)


def rows_under(df: DataFrame, leaves: DataFrame, leaf: list[str]) -> DataFrame:
    """Rows in leaves that differ, without a shuffle: there are at most 2^16 numbers of leaves to send."""
    differing = leaves.where(_differs()).select(F.col("leaf").alias("__leaf"))
    return df.join(F.broadcast(differing), leaf_of([column(c) for c in leaf]) == F.col("__leaf"), "left_semi")


def differing_rows(source: DataFrame, target: DataFrame, config: TableConfig, system: str = "default") -> DataFrame:
    """The row report: as :func:`compare.compare_rows`, but rows of leaves that agree are neither shuffled nor compared."""
    names = lower_names(source).columns
    left, right = (comparable(d, config, side, "row", names, system) for d, side in ((source, "source"), (target, "target")))
    if set(left.columns) != set(right.columns):
        raise ColumnSetError(f"hash columns differ: {left.columns} and {right.columns}")
    leaves = leaf_differences(left, right, [HASH_COLUMN])
    if are_equal(leaves):
        return rows_of_hashes(left, right, one_sided_hashes(left, right)).limit(0)
    left, right = rows_under(left, leaves, [HASH_COLUMN]), rows_under(right, leaves, [HASH_COLUMN])
    return rows_of_hashes(left, right, materialise(one_sided_hashes(left, right), "one-sided"))


def differing_keys(source: DataFrame, target: DataFrame, config: TableConfig, system: str = "default") -> DataFrame:
    """Keys that do not match, with their class and number of rows.

    Under leaves that differ, classes are those of :func:`compare.classify`. A key that both sides hold several times,
    with the same rows, is no difference where all of its leaf agrees.
    """
    names = lower_names(source).columns
    left, right = (comparable(d, config, side, "data", names, system) for d, side in ((source, "source"), (target, "target")))
    keys = list(config.keys)
    leaves = leaf_differences(left, right, keys)
    if are_equal(leaves):
        return classify(left, right, keys).limit(0)
    return classify(rows_under(left, leaves, keys), rows_under(right, leaves, keys), keys).where(F.col("class") != MATCH)
