"""Reports over the result tables. Result tables hold a few rows per compared table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.plans.results import dotted


def _names(side: str) -> list:
    return [
        F.col(f"{side}_table.catalog").alias(f"{side}_catalog"),
        F.col(f"{side}_table.schema").alias(f"{side}_schema"),
        F.col(f"{side}_table.table_name").alias(f"{side}_table_name"),
        dotted(F.col(f"{side}_table")).alias(f"{side}_table"),
    ]


def _latest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("inserted_ts"), "recon_id", F.col("target_table")["table_name"])


def summary(main: DataFrame, metrics: DataFrame) -> DataFrame:
    """One wide row per compared table."""
    rows, cols = "recon_metrics.row_comparison", "recon_metrics.column_comparison"
    return _latest_first(main.join(metrics, "recon_table_id")).select(
        "recon_id",
        "source_type",
        "report_type",
        *_names("source"),
        *_names("target"),
        F.col("run_metrics.status").alias("status"),
        F.col("run_metrics.exception_message").alias("exception"),
        F.col("recon_metrics.source_record_count").alias("source_record_count"),
        F.col("recon_metrics.target_record_count").alias("target_record_count"),
        F.col(f"{rows}.missing_in_source").alias("missing_in_source"),
        F.col(f"{rows}.missing_in_target").alias("missing_in_target"),
        F.col(f"{cols}.absolute_mismatch").alias("absolute_mismatch"),
        F.col(f"{cols}.threshold_mismatch").alias("threshold_mismatch"),
        F.col(f"{cols}.mismatch_columns").alias("mismatch_columns"),
        F.col("recon_metrics.schema_comparison").alias("schema_comparison"),
        F.col("run_metrics.run_by_user").alias("executed_by"),
        "start_ts",
        "end_ts",
    )


def schema_details(main: DataFrame, details: DataFrame) -> DataFrame:
    """One row per column of a schema comparison."""
    lines = details.filter("recon_type = 'schema'").select("recon_table_id", "inserted_ts", F.explode("data").alias("d"))
    fields = ("source_column", "source_datatype", "target_column", "target_datatype", "is_valid")
    return main.join(lines, "recon_table_id").orderBy(F.desc("inserted_ts"), "recon_id", "target_table").select(
        "recon_id", *_names("source"), *_names("target"), *[F.col("d").getItem(f).alias(f) for f in fields]
    )


def drill_down(main: DataFrame, details: DataFrame) -> DataFrame:
    """Key and value rows of every stored difference, numbered inside table and kind.

    The number follows the content, so it is the same in every run. A group holds at most one sample.
    """
    text = F.to_json("d")
    place = Window.partitionBy("recon_table_id", "recon_type").orderBy(text)
    lines = (
        details.filter("recon_type <> 'schema'")
        .select("recon_table_id", "recon_type", F.explode("data").alias("d"))
        .withColumn("rn", F.row_number().over(place))
        .select("recon_table_id", "recon_type", "rn", F.explode("d").alias("key", "value"))
    )
    return main.join(lines, "recon_table_id").select(
        "recon_id", *_names("source"), *_names("target"), "recon_type", "key", "value", "rn"
    )


def failed_runs_per_table(main: DataFrame, metrics: DataFrame) -> DataFrame:
    return _latest_first(main.join(metrics, "recon_table_id").filter("not run_metrics.status")).select(
        "recon_id", dotted(F.col("target_table")).alias("target_table"), F.to_date("start_ts").alias("start_date")
    )


def failed_runs(main: DataFrame, metrics: DataFrame) -> DataFrame:
    return (
        main.join(metrics, "recon_table_id")
        .filter("not run_metrics.status")
        .select("recon_id", F.to_date("start_ts").alias("start_date"))
    )


def targets(main: DataFrame, metrics: DataFrame, successful: bool) -> DataFrame:
    """Target tables whose run failed, or succeeded, with the day."""
    return (
        main.join(metrics, "recon_table_id")
        .filter(F.col("run_metrics.status") == F.lit(successful))
        .select(dotted(F.col("target_table")).alias("target_table"), F.to_date("start_ts").alias("start_date"))
    )


def series(main: DataFrame, metrics: DataFrame, measure: str) -> DataFrame:
    """One number per run and target table over time.

    ``measure``: absolute_mismatch, threshold_mismatch, missing_in_target or missing_in_source.
    """
    part = "column_comparison" if measure.endswith("mismatch") else "row_comparison"
    return _latest_first(main.join(metrics, "recon_table_id")).select(
        "recon_id",
        dotted(F.col("target_table")).alias("target_table"),
        F.col(f"recon_metrics.{part}.{measure}").alias(measure),
        "start_ts",
    )


def _rule_text() -> Column:
    info = F.col("rule_info")
    return F.concat(F.upper(info["agg_type"]), F.lit("("), info["agg_column"], F.lit(")"))


def aggregate_summary(main: DataFrame, metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per compared rule."""
    joined = main.join(metrics, "recon_table_id").join(rules.select("rule_id", "rule_info"), "rule_id")
    return _latest_first(joined).select(
        "recon_id",
        "source_type",
        *_names("source"),
        *_names("target"),
        _rule_text().alias("aggregate_column"),
        F.col("rule_info")["group_by_columns"].alias("group_by_columns"),
        F.col("run_metrics.status").alias("status"),
        F.col("run_metrics.exception_message").alias("exception"),
        F.col("recon_metrics.missing_in_source").alias("missing_in_source"),
        F.col("recon_metrics.missing_in_target").alias("missing_in_target"),
        F.col("recon_metrics.mismatch").alias("mismatch"),
        F.col("run_metrics.run_by_user").alias("executed_by"),
        "start_ts",
        "end_ts",
    )


def aggregate_details(main: DataFrame, rules: DataFrame, details: DataFrame) -> DataFrame:
    """Both values of every stored group, with the group as a list of ``column:value``."""
    info, d = F.col("rule_info"), F.col("d")
    name = F.concat_ws("_", info["agg_type"], info["agg_column"])
    columns = F.transform(F.split(info["group_by_columns"], ","), lambda c: F.trim(c))

    def value(prefix, key):
        return F.try_element_at(d, F.concat(F.lit(prefix), key))

    groups = F.transform(
        columns,
        lambda c: F.concat_ws(":", c, F.coalesce(value("source_group_by_", c), value("target_group_by_", c))),
    )
    lines = details.select("recon_table_id", "rule_id", "recon_type", F.explode("data").alias("d"))
    return (
        main.join(lines, "recon_table_id")
        .join(rules.select("rule_id", "rule_info"), "rule_id")
        .select(
            "recon_id",
            dotted(F.col("source_table")).alias("source_table"),
            dotted(F.col("target_table")).alias("target_table"),
            "recon_type",
            info["agg_type"].alias("aggregate_type"),
            _rule_text().alias("aggregate_column"),
            value("source_", name).alias("source_value"),
            value("target_", name).alias("target_value"),
            groups.alias("group_by_columns"),
            F.coalesce(value("match_", name), F.lit("false")).alias("status"),
        )
    )


def aggregate_series(main: DataFrame, metrics: DataFrame, measure: str) -> DataFrame:
    """mismatch, missing_in_target or missing_in_source per run, target table and rule over time."""
    return _latest_first(main.join(metrics, "recon_table_id")).select(
        "recon_id",
        dotted(F.col("target_table")).alias("target_table"),
        "start_ts",
        F.col(f"recon_metrics.{measure}").alias(measure),
    )
