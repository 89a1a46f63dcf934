"""Incremental extracts by a high-water mark, from a table or from files as they arrive."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.operators.canonical import column


def high_water_mark(stored: DataFrame, mark: str) -> DataFrame:
    """One row: the largest stored value, NULL for an empty table."""
    return stored.agg(F.max(column(mark)).alias("high_water_mark"))


def new_rows(extract: DataFrame, stored: DataFrame, mark: str) -> DataFrame:
    """Rows beyond what is stored; all rows when nothing is. The mark stays inside the plan."""
    top = high_water_mark(stored, mark).scalar()
    return extract.filter(top.isNull() | (column(mark) > top))


def rows_after(df: DataFrame, mark: str, value) -> DataFrame:
    """Rows beyond a given value, which reaches the file scan as a filter."""
    return df.filter(column(mark) > F.lit(value))


def append_new(extract: DataFrame, path: str, mark: str) -> bool:
    """Append rows beyond the stored mark to a parquet table; nothing is written when there are none."""
    spark = extract.sparkSession
    try:
        top = high_water_mark(spark.read.parquet(path), mark).first()[0]
    except Exception as e:  # the first load finds no table
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        top = None
    rows = extract if top is None else rows_after(extract, mark, top)
    if rows.isEmpty():
        return False
    rows.write.mode("append").parquet(path)
    return True


def rows_not_stored(extract: DataFrame, stored: DataFrame, mark: str) -> DataFrame:
    """Rows beyond what is stored, and rows at the mark that are not stored, as often as they are missing.

    ``col > max`` loses rows that come later with the same mark. Only rows at the mark are compared with each other.
    Rows without a mark are new if they are not stored.
    """
    top = high_water_mark(stored, mark).scalar()
    later = extract.filter(top.isNull() | (column(mark) > top)).filter(column(mark).isNotNull())
    at = lambda df: df.filter((column(mark) == top) | column(mark).isNull()).select(*[column(c) for c in extract.columns])
    return later.unionByName(at(extract).exceptAll(at(stored)))


LOAD = "load_id"


def committed_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of the loads that ended; None before the first. What a failed load left behind is not seen."""
    try:
        loads = spark.read.parquet(f"{path}/loads")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None
    return spark.read.parquet(f"{path}/rows").join(loads.select(LOAD), LOAD, "left_semi").drop(LOAD)


def load_increment(extract: DataFrame, path: str, mark: str) -> int:
    """Append the rows of an extract that are not stored yet, each exactly once; returns their number.

    Rows are written under a load's own name, and the load is recorded when they are: a load that fails midway is as
    if it had not been, and the next one brings its rows again.
    """
    spark = extract.sparkSession
    stored = committed_rows(spark, path)
    fresh = extract if stored is None else rows_not_stored(extract, stored, mark)
    name = f"load-{uuid.uuid4().hex}"
    fresh.withColumn(LOAD, F.lit(name)).write.partitionBy(LOAD).mode("append").parquet(f"{path}/rows")
    written = spark.read.schema(fresh.withColumn(LOAD, F.lit(name)).schema).parquet(f"{path}/rows").where(F.col(LOAD) == name).count()
    if written:
        record = spark.range(1).select(F.lit(name).alias(LOAD), F.lit(written).cast("long").alias("rows"), F.current_timestamp().alias("ended"))
        record.write.mode("append").parquet(f"{path}/loads")
    return written


def follow_files(spark: SparkSession, folder: str, schema, target: str, checkpoint: str):
    """Load files that arrived since the last call, each exactly once, and stop."""
    return (
        spark.readStream.schema(schema)
        .parquet(folder)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
