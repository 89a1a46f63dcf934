"""Query shapes: aliases used beside their definition, and query parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def select_with_aliases(df: DataFrame, columns: dict[str, Column], where: Column | None = None) -> DataFrame:
    """Columns that may use the ones defined before them, also in windows and in ``where``.

    A name that is also an input column keeps meaning the input column while others are computed.
    """
    shadowed = {name: f"__{name}" for name in columns if name in df.columns}
    out = df
    for name, value in columns.items():
        out = out.withColumn(shadowed.get(name, name), value)
    if where is not None:
        out = out.filter(where)
    return out.select(*[F.col(shadowed.get(name, name)).alias(name) for name in columns])


def with_parameters(spark: SparkSession, text: str, **values) -> DataFrame:
    """SQL text with ``:name`` parameters; table names may be given as ``{name}`` DataFrames."""
    frames = {k: v for k, v in values.items() if isinstance(v, DataFrame)}
    args = {k: v for k, v in values.items() if not isinstance(v, DataFrame)}
    return spark.sql(text, args=args or None, **frames)
