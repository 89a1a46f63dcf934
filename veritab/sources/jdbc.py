"""Options of remote reads. Nothing here opens a connection before Spark runs the read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from veritab.errors import ConfigError
from veritab.operators.canonical import lower_names


@dataclass(frozen=True)
class JdbcOptions:
    """Range split of a remote read; all four split values are needed together."""

    partition_column: str | None = None
    lower_bound: str | None = None
    upper_bound: str | None = None
    num_partitions: int = 10
    fetch_size: int = 100

    def __post_init__(self):
        given = [self.partition_column, self.lower_bound, self.upper_bound]
        if any(v is not None for v in given) and not all(v is not None for v in given):
            raise ConfigError("a split read needs a partition column and both bounds")

    def as_options(self) -> dict[str, str]:
        options = {"fetchsize": str(self.fetch_size)}
        if self.partition_column is not None:
            options |= {
                "partitionColumn": self.partition_column,
                "lowerBound": str(self.lower_bound),
                "upperBound": str(self.upper_bound),
                "numPartitions": str(self.num_partitions),
            }
        return options


def remote_name(system: str, catalog: str | None, schema: str, table: str) -> str:
    """Table name as its system wants it."""
    if system == "oracle":
        return f"{schema}.{table}"
    if system == "snowflake":
        return f"{catalog}.{schema}.{table}"
    if system == "sqlserver":
        return f"{schema}.[{table}]"
    raise ConfigError(f"unknown system: {system}")


def remote_query(system: str, query: str, catalog: str | None, schema: str, table: str) -> str:
    """Query text with ``:tbl`` replaced by the table name."""
    return query.replace(":tbl", remote_name(system, catalog, schema, table))


def read_options(system: str, query: str, options: JdbcOptions | None = None) -> dict[str, str]:
    """Reader options of a remote query. Snowflake's own reader splits by itself, so it takes no split."""
    if system == "snowflake":
        return {"query": query}
    split = options.as_options() if options else {}
    return {"dbtable": f"({query}) tmp", **split}


def read_remote(spark: SparkSession, system: str, url: str, query: str, options=None, **connection) -> DataFrame:
    """Lazy, range-split read of a remote query."""
    source = "snowflake" if system == "snowflake" else "jdbc"
    reader = spark.read.format(source).options(**read_options(system, query, options), **connection)
    if source == "jdbc":
        reader = reader.option("url", url)
    return lower_names(reader.load())
