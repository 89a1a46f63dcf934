"""Writing results: appends, step loads, extract loads, files, and tables whose columns changed."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.errors import TableWriteError
from veritab.operators.canonical import column

__all__ = ["append", "conform", "ingest_extract", "load_step", "union_all", "write_file"]


def append(df: DataFrame, table: str) -> None:
    try:
        df.write.mode("append").saveAsTable(table)
    except PySparkException as e:
        raise TableWriteError(f"cannot write to {table}: {e}") from e


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Stored rows in a newer layout: absent columns become NULL, types are widened, old columns go."""

    def fit(value, have: T.DataType, want: T.DataType):
        if isinstance(want, T.StructType) and isinstance(have, T.StructType):
            names = {f.name: f for f in have.fields}
            fields = [
                fit(value.getField(f.name), names[f.name].dataType, f.dataType).alias(f.name)
                if f.name in names
                else F.lit(None).cast(f.dataType).alias(f.name)
                for f in want.fields
            ]
            return F.when(value.isNotNull(), F.struct(*fields))
        return value.cast(want)

    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (fit(column(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def load_step(df: DataFrame, table: str, mode: str = "overwrite") -> bool:
    """Write a step's rows; an empty result leaves the stored table alone. True when written."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode: {mode}")
    if df.isEmpty():
        return False
    try:
        df.write.mode(mode).saveAsTable(table)
    except PySparkException as e:
        raise TableWriteError(f"cannot write to {table}: {e}") from e
    return True


def ingest_extract(spark: SparkSession, folder: str, tables: list[str], target_folder: str) -> DataFrame:
    """Load every extract table over its target; outcome per table. A failing table does not stop the others."""
    outcomes = []
    for name in tables:
        try:
            spark.read.parquet(f"{folder}/{name}.parquet").write.mode("overwrite").parquet(f"{target_folder}/{name}")
            outcomes.append((name, True, None))
        except PySparkException as e:
            outcomes.append((name, False, str(e)))
    return spark.createDataFrame(outcomes, "table_name string, loaded boolean, message string")


def write_file(df: DataFrame, path: str, fmt: str = "csv", header: bool = True, mode: str = "error", sep: str = ",") -> None:
    """Rows as delimited text or parquet, one file per partition."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", header).option("sep", sep).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format: {fmt}")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
