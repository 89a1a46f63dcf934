"""Numeric and time differences within allowed bounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.config import ColumnThreshold, TableConfig, TableThreshold
from veritab.errors import ConfigError, UnsupportedThresholdType
from veritab.operators.canonical import column, lower_names, side_column, side_filter
from veritab.operators.compare import pair_rows

MATCH, WARNING, FAILED = "Match", "Warning", "Failed"


def threshold_status(source: Column, target: Column, threshold: ColumnThreshold) -> Column:
    """Match for no difference, Warning inside the bounds, Failed outside. NULL counts as 0.

    A percentage is taken of the signed target value, so bounds change sides for a negative target.
    """
    low, high = threshold.bounds
    difference = F.coalesce(source, F.lit(0)) - F.coalesce(target, F.lit(0))
    measure = difference
    if threshold.percentage:
        measure = difference / F.when((target == 0) | target.isNull(), F.lit(1)).otherwise(target) * 100
    return (
        F.when(difference == 0, F.lit(MATCH)).when(measure.between(low, high), F.lit(WARNING)).otherwise(F.lit(FAILED))
    )


def threshold_value(c: Column, data_type: T.DataType) -> Column:
    """Numbers as they are, points in time as seconds."""
    if isinstance(data_type, T.NumericType):
        return c
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_timestamp(c.cast("timestamp"))
    raise UnsupportedThresholdType(f"no threshold for type {data_type.simpleString()}")


def threshold_rows(df: DataFrame, config: TableConfig, side: str) -> DataFrame:
    """Key and threshold columns of one side, after its filter and with the user's expressions."""
    df = side_filter(lower_names(df), config.source_filter if side == "source" else config.target_filter)
    picked = df.select(
        *[side_column(df, config, side, k) for k in config.keys],
        *[side_column(df, config, side, t.column) for t in config.thresholds],
    )
    return picked.select(
        *[column(k) for k in config.keys],
        *[
            threshold_value(column(t.column), picked.schema[t.column].dataType).alias(t.column)
            for t in config.thresholds
        ],
    )


def threshold_compare(source: DataFrame, target: DataFrame, config: TableConfig, unique_keys: bool = False) -> DataFrame:
    """One row per pair of rows that share a key: ``<c>_source``, ``<c>_target`` and ``<c>_match`` per threshold."""
    if not config.keys or not config.thresholds:
        raise ConfigError("thresholds need join columns and threshold columns")
    paired = pair_rows(
        threshold_rows(source, config, "source"), threshold_rows(target, config, "target"), config.keys, unique_keys
    )
    out = []
    for t in config.thresholds:
        s, o = F.col("s").getField(t.column), F.col("t").getField(t.column)
        out += [
            s.alias(f"{t.column}_source"),
            o.alias(f"{t.column}_target"),
            threshold_status(s, o, t).alias(f"{t.column}_match"),
        ]
    return paired.select(*[column(k) for k in config.keys], *out, "rows")


def threshold_failures(compared: DataFrame) -> DataFrame:
    """Rows with at least one value outside its bounds."""
    marks = [column(c) == FAILED for c in compared.columns if c.endswith("_match")]
    return compared.filter(reduce(lambda a, b: a | b, marks))


def within_table_threshold(mismatch: Column, threshold_mismatch: Column, source_count: Column, bounds) -> Column:
    """Is the number of mismatches allowed? None at all is always allowed; the last bound decides."""
    total = mismatch + threshold_mismatch
    allowed = F.lit(False)
    for b in bounds:
        assert isinstance(b, TableThreshold)
        low, high = (F.lit(v) for v in b.bounds)
        if b.percentage:
            low, high = (F.bround(v / 100 * source_count) for v in (low, high))
        allowed = (low <= total) & (total <= high)
    return (total == 0) | allowed
