"""Reading tables and files."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.errors import DataSourceError
from veritab.operators.canonical import lower_names, side_filter


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table with lower-case column names."""
    try:
        return lower_names(spark.table(name))
    except PySparkException as e:
        raise DataSourceError(f"cannot read table {name}: {e}") from e


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    try:
        return lower_names(spark.read.parquet(path))
    except PySparkException as e:
        raise DataSourceError(f"cannot read {path}: {e}") from e


def record_count(source: DataFrame, target: DataFrame, source_filter=None, target_filter=None, report="data") -> DataFrame:
    """One row with the count of each side after its own filter; zeros for a schema report."""
    if report == "schema":
        zero = F.lit(0).cast("long")
        return source.sparkSession.range(1).select(zero.alias("source_count"), zero.alias("target_count"))
    both = side_filter(source, source_filter).select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(
        side_filter(target, target_filter).select(F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    total = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    return total.select(F.coalesce("s", F.lit(0)).alias("source_count"), F.coalesce("t", F.lit(0)).alias("target_count"))


def read_delimited(
    spark: SparkSession, path, columns: dict[str, str], separator: str = ",", header: bool = True
) -> DataFrame:
    """Delimited files whose columns get the given names and types by position. No pass to infer types.

    Text is read as text and cast afterwards; what does not fit its type becomes NULL.
    """
    schema = ", ".join(f"_c{i} string" for i in range(len(columns)))
    raw = spark.read.schema(schema).option("header", header).option("sep", separator).option("enforceSchema", True).csv(path)
    return raw.select(*[F.col(f"_c{i}").try_cast(t).alias(n) for i, (n, t) in enumerate(columns.items())])


def read_many(spark: SparkSession, pattern, columns: dict[str, str], separator: str = ",", header: bool = True) -> DataFrame:
    """All files of a pattern, with the file and the time of reading beside each row."""
    return read_delimited(spark, pattern, columns, separator, header).withColumns(
        {"source_file": F.input_file_name(), "process_date": F.current_timestamp()}
    )


def load_log(rows: DataFrame) -> DataFrame:
    """Rows and last time per file."""
    return rows.groupBy(F.col("source_file").alias("file_path")).agg(
        F.count(F.lit(1)).alias("row_count"), F.max("process_date").alias("process_time")
    )


def read_json_lines(spark: SparkSession, path, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_scripts(spark: SparkSession, path) -> DataFrame:
    """(path, sql): one row per script file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("sql"))
