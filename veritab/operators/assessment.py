"""Checks on an extract and reports over workload tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.errors import EmptyReportError
from veritab.operators.canonical import column

REPORT_FIELDS = "table string, column string, strategy string, outcome string, severity string, summary string"
# First word of a statement and its class, in the order in which they are tried.
STATEMENT_CLASSES = (
    ("QUERY", ("SELECT", "WITH")),
    ("DML", ("INSERT", "UPDATE", "MERGE", "DELETE", "TRUNCATE", "COPY", "IF", "BEGIN", "DECLARE", "BUILDREPLICATEDTABLECACHE")),
    ("DDL", ("CREATE", "DROP", "ALTER")),
    ("ROUTINE", ("EXEC", "EXECUTE")),
)
TRANSACTION_WORDS = ("TRAN", "TRANSACTION")


def _row(df: DataFrame, table: str, name: str | None, strategy: str, passed: Column, severity: str, summary=None):
    return df.select(
        F.lit(table).alias("table"),
        F.lit(name).cast("string").alias("column"),
        F.lit(strategy).alias("strategy"),
        F.when(passed, "PASS").otherwise("FAIL").alias("outcome"),
        F.lit(severity).alias("severity"),
        (summary if summary is not None else F.lit(None)).cast("string").alias("summary"),
    )


def check_nulls(df: DataFrame, table: str, name: str, severity: str = "WARN") -> DataFrame:
    counted = df.agg(F.count_if(column(name).isNull()).alias("n"))
    return _row(counted, table, name, "NullValidationCheck", F.col("n") == 0, severity)


def check_not_empty(df: DataFrame | None, table: str, severity: str = "WARN", spark=None) -> DataFrame:
    """Looks at one row only. ``None`` stands for a table that is not there."""
    if df is None:
        return spark.createDataFrame(
            [(table, None, "EmptyTableValidationCheck", "FAIL", severity, "Table not found.")], REPORT_FIELDS
        )
    counted = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return _row(counted, table, None, "EmptyTableValidationCheck", F.col("n") > 0, severity)


def check_schema(actual: DataFrame | None, expected: DataFrame, table: str, severity: str = "WARN") -> DataFrame:
    """First expected column that is absent or has another type.

    ``expected`` has position, column_name and data_type; ``actual`` column_name and data_type.
    """
    spark = expected.sparkSession
    name = "ExtractSchemaValidationCheck"
    if actual is None:
        text = "Table not found in the profiler extract"
        return spark.createDataFrame([(table, None, name, "FAIL", severity, text)], REPORT_FIELDS)
    there = actual.select(F.col("column_name").alias("a_name"), F.col("data_type").alias("a_type"))
    problem = (
        F.when(F.col("a_name").isNull(), "Column does not exist")
        .when(F.lower("data_type") != F.lower("a_type"), "Unexpected column data type")
    )
    first = (
        expected.join(there, F.col("column_name") == F.col("a_name"), "left")
        .withColumn("problem", problem)
        .agg(F.min_by(F.struct("column_name", "problem"), F.when(F.col("problem").isNotNull(), F.col("position"))).alias("f"))
    )
    return first.select(
        F.lit(table).alias("table"),
        F.col("f.column_name").alias("column"),
        F.lit(name).alias("strategy"),
        F.when(F.col("f").isNull(), "PASS").otherwise("FAIL").alias("outcome"),
        F.lit(severity).alias("severity"),
        F.coalesce("f.problem", F.lit("All columns match expected schema")).alias("summary"),
    )


def validation_report(checks: list[DataFrame]) -> DataFrame:
    if not checks:
        raise EmptyReportError("no validation check was given")
    return reduce(lambda a, b: a.unionByName(b), checks)


def ingest_gate(report: DataFrame) -> DataFrame:
    """One row: may the extract be loaded? Only a failed check of severity ERROR closes the gate."""
    return report.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if((F.col("outcome") == "FAIL") & (F.upper("severity") == "ERROR")).alias("errors"),
    ).select("checks", "errors", ((F.col("checks") > 0) & (F.col("errors") == 0)).alias("open"))


def first_word(c: Column) -> Column:
    return F.upper(F.regexp_extract(c, r"^\s*([A-Za-z]*)", 1))


def second_word(c: Column) -> Column:
    return F.upper(F.regexp_extract(c, r"^\s*[A-Za-z]*[^A-Za-z]\s*([A-Za-z]*)", 1))


def statement_class(c: Column) -> Column:
    """QUERY, DML, DDL, ROUTINE, TRANSACTION_CONTROL or OTHER by the first words. BEGIN counts as DML."""
    w1, w2 = first_word(c), second_word(c)
    result = None
    for name, words in STATEMENT_CLASSES:
        result = F.when(w1.isin(*words), name) if result is None else result.when(w1.isin(*words), name)
    return (
        result.when(w1.isin("BEGIN", "END") & w2.isin(*TRANSACTION_WORDS), "TRANSACTION_CONTROL")
        .when(w1.isin("COMMIT", "ROLLBACK"), "TRANSACTION_CONTROL")
        .otherwise("OTHER")
    )


def classified_requests(requests: DataFrame, pool: str, redact: bool = True, after: Column | None = None) -> DataFrame:
    """Requests with both words, the class and, by default, no statement text."""
    text = F.col("command")
    kept = requests.filter("start_time is not null and command is not null")
    if after is not None:
        kept = kept.filter(F.col("end_time") > after)
    out = kept.withColumns(
        {"command_w1": first_word(text), "command_w2": second_word(text), "command_type": statement_class(text)}
    ).withColumn("pool_name", F.lit(pool))
    return redacted(out, "command") if redact else out


def redacted(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.lit("[REDACTED]"))


def storage_per_node(stats: DataFrame) -> DataFrame:
    """Reserved and used MB per node, from 8 KB pages, cut to whole MB."""
    def mb(c):
        return F.floor(F.sum(c) * 8 / 1024).cast("long")

    return stats.groupBy("node_id").agg(
        mb("reserved_page_count").alias("reserved_mb"), mb("used_page_count").alias("used_mb")
    )


def table_storage(partitions: DataFrame, indexes: DataFrame, units: DataFrame) -> DataFrame:
    """Size per index partition of user tables (object ids above 255), largest first."""
    return (
        partitions.filter("object_id > 255")
        .join(indexes, ["object_id", "index_id"])
        .join(units, F.col("partition_id") == F.col("container_id"))
        .select(
            "object_id",
            "index_name",
            "index_type",
            "row_count",
            (F.col("total_pages") * 8.0 / 1024).alias("total_size_mb"),
            (F.col("used_pages") * 8.0 / 1024).alias("used_size_mb"),
            "total_pages",
        )
        .orderBy(F.desc("total_pages"))
    )


def statement_statistics(stats: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Statements run in the last days, times in seconds, slowest first."""
    return (
        stats.filter(F.col("last_execution_time") >= now - F.make_dt_interval(days=F.lit(days)))
        .withColumns(
            {
                "total_elapsed_sec": F.col("total_elapsed_time") / 1000000.0,
                "total_worker_sec": F.col("total_worker_time") / 1000000.0,
            }
        )
        .orderBy(F.desc("total_elapsed_time"))
    )


def statement_slice(text: Column, start: Column, end: Column) -> Column:
    """Part of a batch text by byte offsets of two-byte characters; end -1 means the end of the text."""
    stop = F.when(end == -1, F.length(text) * 2).otherwise(end)
    return F.substring(text, (F.floor(start / 2) + 1).cast("int"), (F.floor((stop - start) / 2) + 1).cast("int"))


def flatten_metrics(metrics: DataFrame) -> DataFrame:
    """One row per (name, timestamp) out of ``name, timeseries: array<struct<data: array<struct<...>>>>``."""
    return metrics.select("name", F.explode("timeseries").alias("series")).select(
        "name", F.explode("series.data").alias("d")
    ).select("name", "d.timestamp", "d.average", "d.count", "d.maximum", "d.minimum", "d.total")


def metric_buckets(samples: DataFrame, every: str, names=("name",), ts: str = "timestamp", value: str = "value") -> DataFrame:
    """Mean, count, largest, smallest and total per name and time bucket."""
    return (
        samples.groupBy(*names, F.window(ts, every).alias("w"))
        .agg(
            F.avg(value).alias("average"),
            F.count(value).alias("count"),
            F.max(value).alias("maximum"),
            F.min(value).alias("minimum"),
            F.sum(value).alias("total"),
        )
        .select(*names, F.col("w.start").alias("bucket_start"), "average", "count", "maximum", "minimum", "total")
    )


def project_fields(df: DataFrame, keep=(), remove=()) -> DataFrame:
    """Keep or remove listed fields, whatever their case."""
    keep, remove = {k.lower() for k in keep}, {r.lower() for r in remove}
    return df.select(*[column(c) for c in df.columns if (not keep or c.lower() in keep) and c.lower() not in remove])


def cpu_by_hour(cpu: DataFrame) -> DataFrame:
    return (
        cpu.filter(F.col("system_idle") + F.col("sql_utilization") <= 100)
        .withColumn("hr", F.hour("event_time"))
        .orderBy("event_time")
    )


def database_sizes(sizes: DataFrame) -> DataFrame:
    return sizes.select(F.col("db_name").alias("name"), F.round(F.col("size_mb") / 1024, 2).alias("size_gb"))


def with_creation_parts(df: DataFrame) -> DataFrame:
    return df.withColumns({"creation_date": F.to_date("creation_time"), "creation_hr": F.hour("creation_time")})


def cpu_share(stats: DataFrame) -> DataFrame:
    """Share of the total worker time per command type; the total is the sum over the few types, not over rows."""
    per_type = stats.groupBy("command_type").agg(F.sum("total_worker_time").alias("cpu"))
    total = per_type.agg(F.sum("cpu").alias("total")).scalar()
    return per_type.select(
        F.col("command_type").alias("workload_type"), F.round(F.col("cpu") / total, 1).alias("percent_cpu_time")
    )


def session_flow(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy(
        F.col("program_name").alias("stage1"), F.col("login_name").alias("stage2"), F.col("db_name").alias("stage3")
    ).agg(F.sum("cpu_time").alias("value"))


def system_information(info: DataFrame) -> DataFrame:
    """Name and value rows of a one-row table."""
    gb = F.round(F.col("physical_memory_kb") / 1024 / 1024, 1)
    return info.select(
        F.col("cpu_count").cast("string").alias("cpu_count"),
        F.col("hyperthread_ratio").cast("string").alias("hyperthread_ratio"),
        F.col("max_workers_count").cast("string").alias("max_workers_count"),
        gb.cast("string").alias("physical_memory_gb"),
        F.col("virtual_machine_type_desc").alias("virtual_machine"),
    ).unpivot(
        [], ["cpu_count", "hyperthread_ratio", "max_workers_count", "physical_memory_gb", "virtual_machine"], "name", "value"
    )


def database_inventory(databases: DataFrame) -> DataFrame:
    return databases.select("db_id", "name", F.to_date("create_date").alias("created_on")).orderBy("created_on")
