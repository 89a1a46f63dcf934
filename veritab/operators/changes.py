"""Changes of a table as a function from the old table to the new one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.operators.canonical import column


def _renamed(df: DataFrame, mark: str) -> DataFrame:
    return df.toDF(*[f"{mark}{c}" for c in df.columns])


def one_row_per_key(updates: DataFrame, keys, strict: bool = True) -> DataFrame:
    """Updates folded to one row per key. Several *different* rows for a key are an error when strict.

    The fold happens before the shuffle, so a key that many rows share costs no more than others.
    """
    rest = [c for c in updates.columns if c not in keys]
    row = F.struct(*[column(c) for c in rest])
    folded = updates.groupBy(*[column(k) for k in keys]).agg(F.min(row).alias("__low"), F.max(row).alias("__high"))
    value = F.col("__low")
    if strict:
        clash = F.raise_error(F.lit("a target row is matched by several different source rows"))
        value = F.when(F.col("__low").eqNullSafe(F.col("__high")), F.col("__low")).otherwise(clash)
    return folded.select(*[column(k) for k in keys], value.alias("__row")).select(
        *[column(k) for k in keys], *[F.col("__row").getField(c).alias(c) for c in rest]
    )


def update_from(table: DataFrame, updates: DataFrame, keys, assign: dict[str, Column], where: Column | None = None):
    """UPDATE ... FROM: rows with a partner get new values; update columns carry the prefix ``u_`` in ``assign``."""
    keys = list(keys)
    new = _renamed(one_row_per_key(updates, keys), "u_").withColumn("__hit", F.lit(True))
    same = reduce(lambda a, b: a & b, [column(k) == column(f"u_{k}") for k in keys])
    joined = table.join(new, same, "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    return joined.select(
        *[
            F.when(hit, assign[c]).otherwise(column(c)).cast(table.schema[c].dataType).alias(c)
            if c in assign
            else column(c)
            for c in table.columns
        ]
    )


def delete_using(table: DataFrame, other: DataFrame, keys, where: Column | None = None) -> DataFrame:
    """DELETE ... USING: rows with a partner go. ``keys`` maps table columns to columns of ``other``."""
    pairs = keys if isinstance(keys, dict) else {k: k for k in keys}
    if where is not None:
        other = other.filter(where)
    gone = other.select(*[column(o).alias(f"__d{i}") for i, o in enumerate(pairs.values())]).distinct()
    same = reduce(lambda a, b: a & b, [column(t) == F.col(f"__d{i}") for i, t in enumerate(pairs)])
    return table.join(gone, same, "left_anti")


def delete_where(table: DataFrame, predicate: Column) -> DataFrame:
    """Rows stay where the predicate is false or NULL."""
    return table.filter(~F.coalesce(predicate, F.lit(False)))


def update_where(table: DataFrame, predicate: Column, assign: dict[str, Column]) -> DataFrame:
    hit = F.coalesce(predicate, F.lit(False))
    return table.withColumns(
        {c: F.when(hit, v).otherwise(column(c)).cast(table.schema[c].dataType) for c, v in assign.items()}
    )


def insert_rows(table: DataFrame, rows: DataFrame, overwrite: bool = False) -> DataFrame:
    """Rows appended by column name (columns they lack become NULL), or the whole table replaced."""
    rows = rows.select(
        *[
            (column(c) if c in rows.columns else F.lit(None)).cast(table.schema[c].dataType).alias(c)
            for c in table.columns
        ]
    )
    return rows if overwrite else table.unionByName(rows)
