"""Drifted copies of the given tables, once for Spark and once as SQL: the two sides of a migration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
SHIFT = 1_000_000_000

# table: key, text column, money column, other columns
_SHAPES = {
    "orders": ("o_orderkey", "o_orderpriority", "o_totalprice", ("o_custkey", "o_orderstatus")),
    "customer": ("c_custkey", "c_mktsegment", "c_acctbal", ("c_name", "c_nationkey")),
    "part": ("p_partkey", "p_name", "p_retailprice", ("p_brand", "p_size")),
}


def keys(table: str) -> tuple[str, ...]:
    return (_SHAPES[table][0],)


def _each(k: Column, n: int) -> Column:
    return (k % n) == 0


def source_side(read, table: str) -> DataFrame:
    """The given table with money as decimal and some NULL texts."""
    key, text, money, rest = _SHAPES[table]
    k = F.col(key)
    return read(table).select(
        k,
        *rest,
        F.col(money).cast(MONEY).alias(money),
        F.when(~_each(k, 41), F.col(text)).alias(text),
    )


def target_side(read, table: str, names: dict | None = None) -> DataFrame:
    """The copy: rows lost and added, money changed, blanks around texts, NULL texts on one side."""
    key, text, money, rest = _SHAPES[table]
    k = F.col(key)
    blank = F.when(_each(k, 31), F.concat(F.lit(" "), F.col(text), F.lit("  "))).otherwise(F.col(text))
    drifted = (
        F.when(_each(k, 53), F.col(money).cast(MONEY) + 1)
        .when(_each(k, 47), F.col(money).cast(MONEY) * F.lit("1.02").cast("decimal(3,2)"))
        .otherwise(F.col(money).cast(MONEY))
    )
    copies = F.when(_each(k, 89), F.array(k, k + SHIFT)).otherwise(F.array(k))
    out = read(table).filter(~_each(k, 97)).select(
        F.explode(copies).alias(key),
        *rest,
        drifted.cast(MONEY).alias(money),
        F.when(~(_each(k, 41) | _each(k, 43)), blank).alias(text),
    )
    return out.withColumnsRenamed(names or {})


def sides_sql(table: str) -> str:
    """``src`` and ``tgt`` as common table expressions."""
    key, text, money, rest = _SHAPES[table]
    others = ", ".join(rest)
    return f"""
src AS (
  SELECT {key}, {others}, CAST({money} AS DECIMAL(18,2)) AS {money},
         CASE WHEN {key} % 41 <> 0 THEN {text} END AS {text}
  FROM {table}),
kept AS (
  SELECT {key}, {others},
         CAST(CASE WHEN {key} % 53 = 0 THEN CAST({money} AS DECIMAL(18,2)) + 1
                   WHEN {key} % 47 = 0 THEN CAST({money} AS DECIMAL(18,2)) * CAST('1.02' AS DECIMAL(3,2))
                   ELSE CAST({money} AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS {money},
         CASE WHEN {key} % 41 <> 0 AND {key} % 43 <> 0
              THEN CASE WHEN {key} % 31 = 0 THEN ' ' || {text} || '  ' ELSE {text} END END AS {text},
         {key} % 89 = 0 AS doubled
  FROM {table} WHERE {key} % 97 <> 0),
tgt AS (
  SELECT {key}, {others}, {money}, {text} FROM kept
  UNION ALL
  SELECT {key} + {SHIFT}, {others}, {money}, {text} FROM kept WHERE doubled)"""


def hash_sql(*texts: str, function: str = "sha256") -> str:
    """The row hash: each text with its length, NULL as a mark."""
    parts = " || ".join(f"COALESCE(CAST(LENGTH({t}) AS VARCHAR) || ':' || {t}, 'n')" for t in texts)
    return f"{function}({parts})"


def same_sql(table: str, a: str = "s", b: str = "t") -> str:
    """Do the compared columns of two rows agree? Written on the columns, not on a hash."""
    _, text, money, rest = _SHAPES[table]
    return " AND ".join(
        [f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in (*rest, money)]
        + [f"TRIM({a}.{text}) IS NOT DISTINCT FROM TRIM({b}.{text})"]
    )
