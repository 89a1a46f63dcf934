"""Layouts of the eight result tables and the rows written to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.operators.canonical import column

_NAME = "struct<catalog:string,schema:string,table_name:string>"
_RUN = "struct<status:boolean,run_by_user:string,exception_message:string>"
MAIN = (
    f"recon_table_id bigint, recon_id string, source_type string, source_table {_NAME}, target_table {_NAME}, "
    "report_type string, operation_name string, start_ts timestamp, end_ts timestamp"
)
METRICS = (
    "recon_table_id bigint, recon_metrics struct<source_record_count:bigint,target_record_count:bigint,"
    "row_comparison:struct<missing_in_source:bigint,missing_in_target:bigint>,"
    "column_comparison:struct<absolute_mismatch:bigint,threshold_mismatch:bigint,mismatch_columns:string>,"
    f"schema_comparison:boolean>, run_metrics {_RUN}, inserted_ts timestamp"
)
DETAILS = (
    "recon_table_id bigint, recon_type string, status boolean, data array<map<string,string>>, inserted_ts timestamp"
)
AGGREGATE_RULES = "rule_id bigint, rule_type string, rule_info map<string,string>, inserted_ts timestamp"
AGGREGATE_METRICS = (
    "recon_table_id bigint, rule_id bigint, recon_metrics struct<missing_in_source:bigint,missing_in_target:bigint,"
    f"mismatch:bigint>, run_metrics {_RUN}, inserted_ts timestamp"
)
AGGREGATE_DETAILS = (
    "recon_table_id bigint, rule_id bigint, recon_type string, data array<map<string,string>>, inserted_ts timestamp"
)
# Whole difference sets, one row per differing row; details show the first of them.
DIFFERENCES = "recon_table_id bigint, recon_type string, data map<string,string>, inserted_ts timestamp"
AGGREGATE_DIFFERENCES = "recon_table_id bigint, rule_id bigint, recon_type string, data map<string,string>, inserted_ts timestamp"
TABLES = {
    "main": MAIN,
    "metrics": METRICS,
    "details": DETAILS,
    "differences": DIFFERENCES,
    "aggregate_rules": AGGREGATE_RULES,
    "aggregate_metrics": AGGREGATE_METRICS,
    "aggregate_details": AGGREGATE_DETAILS,
    "aggregate_differences": AGGREGATE_DIFFERENCES,
}
# How a source system is called in reports.
SOURCE_LABELS = {"snowflake": "Snowflake", "oracle": "Oracle"}


def layout(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def full_name(parts: tuple[str | None, str, str]) -> str:
    return ".".join(p for p in parts if p)


def main_rows(spark: SparkSession, runs: list[dict]) -> DataFrame:
    """Run rows. The id is a hash of run and table names, the same in every process.

    Each entry: recon_id, source_type, source and target (catalog, schema, table), report_type,
    operation_name, start_ts, end_ts.
    """
    given = "recon_id string, source_type string, source_table " + _NAME + ", target_table " + _NAME
    given += ", report_type string, operation_name string, start_ts timestamp, end_ts timestamp"
    rows = [
        (
            r["recon_id"],
            SOURCE_LABELS.get(r["source_type"], r["source_type"]),
            tuple(r["source"]),
            tuple(r["target"]),
            r["report_type"],
            r.get("operation_name", "reconcile"),
            r.get("start_ts"),
            r.get("end_ts"),
        )
        for r in runs
    ]
    df = spark.createDataFrame(rows, given)
    return df.select(table_id(F.col("recon_id"), F.col("source_table"), F.col("target_table")).alias("recon_table_id"), "*")


def table_id(recon_id: Column, source: Column, target: Column) -> Column:
    return F.xxhash64(recon_id, dotted(source), dotted(target))


def rule_id(recon_table_id: Column, rule: Column) -> Column:
    return F.xxhash64(recon_table_id, rule)


def dotted(name: Column) -> Column:
    """catalog.schema.table; an absent catalog is left out."""
    catalog = F.when(name["catalog"] != "", name["catalog"])
    return F.concat_ws(".", catalog, name["schema"], name["table_name"])


def metrics_row(spark: SparkSession, recon_table_id: int, outcome: dict, user: str, inserted) -> DataFrame:
    """One metrics row; parts that the report does not have, or that failed, are NULL.

    ``outcome`` holds the numbers of a table: report, source_count, target_count, missing_in_src,
    missing_in_tgt, mismatch, threshold_mismatch, mismatch_columns, schema_valid, within_threshold, exception.
    """
    report, failed = outcome["report"], bool(outcome.get("exception"))
    row = (outcome["missing_in_src"], outcome["missing_in_tgt"]) if report in ("all", "row", "data") and not failed else None
    cols = None
    if report in ("all", "data") and not failed:
        cols = (outcome["mismatch"], outcome["threshold_mismatch"], ",".join(outcome["mismatch_columns"]))
    schema = outcome["schema_valid"] if report in ("all", "schema") and not failed else None
    status = (
        not failed
        and outcome["within_threshold"]
        and outcome["missing_in_src"] == 0
        and outcome["missing_in_tgt"] == 0
        and outcome["schema_valid"]
    )
    metrics = (outcome["source_count"], outcome["target_count"], row, cols, schema)
    run = (bool(status), user, outcome.get("exception") or "")
    return spark.createDataFrame([(recon_table_id, metrics, run, inserted)], METRICS)


def as_maps(df: DataFrame) -> DataFrame:
    """Every row as a map of texts."""
    pairs = [x for c in df.columns for x in (F.lit(c), column(c).cast("string"))]
    return df.select(F.create_map(*pairs).alias("data"))


def details_row(df: DataFrame, recon_table_id: int, recon_type: str, status: bool, inserted) -> DataFrame:
    """The shown rows of one kind as one result row. Only bounded samples come here, so the cell stays small."""
    return (
        as_maps(df)
        .agg(F.collect_list("data").alias("data"))
        .select(
            F.lit(recon_table_id).cast("long").alias("recon_table_id"),
            F.lit(recon_type).alias("recon_type"),
            F.lit(status).alias("status"),
            "data",
            F.lit(inserted).cast("timestamp").alias("inserted_ts"),
        )
    )


def difference_rows(df: DataFrame, recon_table_id: int, recon_type: str, inserted) -> DataFrame:
    """All rows of one kind of difference, one result row each."""
    return as_maps(df).select(
        F.lit(recon_table_id).cast("long").alias("recon_table_id"),
        F.lit(recon_type).alias("recon_type"),
        "data",
        F.lit(inserted).cast("timestamp").alias("inserted_ts"),
    )


def aggregate_rule_rows(spark: SparkSession, recon_table_id: int, rules, inserted) -> DataFrame:
    rows = [(r.text, "AGGREGATE", r.info, inserted) for r in rules]
    df = spark.createDataFrame(rows, "rule string, rule_type string, rule_info map<string,string>, inserted_ts timestamp")
    return df.select(
        rule_id(F.lit(recon_table_id).cast("long"), F.col("rule")).alias("rule_id"), "rule_type", "rule_info", "inserted_ts"
    )


def aggregate_metrics_rows(counts: DataFrame, recon_table_id: int, user: str, inserted) -> DataFrame:
    """One row per rule out of (rule, mismatch, missing_in_src, missing_in_tgt)."""
    zero = (F.col("mismatch") == 0) & (F.col("missing_in_src") == 0) & (F.col("missing_in_tgt") == 0)
    tid = F.lit(recon_table_id).cast("long")
    return counts.select(
        tid.alias("recon_table_id"),
        rule_id(tid, F.col("rule")).alias("rule_id"),
        F.struct(
            F.col("missing_in_src").cast("long").alias("missing_in_source"),
            F.col("missing_in_tgt").cast("long").alias("missing_in_target"),
            F.col("mismatch").cast("long").alias("mismatch"),
        ).alias("recon_metrics"),
        F.struct(zero.alias("status"), F.lit(user).alias("run_by_user"), F.lit("").alias("exception_message")).alias(
            "run_metrics"
        ),
        F.lit(inserted).cast("timestamp").alias("inserted_ts"),
    )


def failed_rule_rows(spark: SparkSession, recon_table_id: int, rules, message: str, user: str, inserted) -> DataFrame:
    """Every rule of a failed query with the error."""
    rows = [(r.text, message) for r in rules]
    tid = F.lit(recon_table_id).cast("long")
    return spark.createDataFrame(rows, "rule string, message string").select(
        tid.alias("recon_table_id"),
        rule_id(tid, F.col("rule")).alias("rule_id"),
        F.lit(None).cast("struct<missing_in_source:bigint,missing_in_target:bigint,mismatch:bigint>").alias("recon_metrics"),
        F.struct(F.lit(False).alias("status"), F.lit(user).alias("run_by_user"), F.col("message").alias("exception_message")).alias(
            "run_metrics"
        ),
        F.lit(inserted).cast("timestamp").alias("inserted_ts"),
    )
