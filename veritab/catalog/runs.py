"""Result tables of whole runs, the verdict on them, and the reports over them.

A run compares several table pairs and stores its rows in the session's shared folder; the queries below
read what was stored, as a report does.
"""

from functools import reduce

from pyspark.sql import functions as F

from veritab.catalog.data import MONEY, same_sql, sides_sql, source_side, target_side
from veritab.catalog.registry import query
from veritab.config import Aggregate, ColumnThreshold, TableConfig, TableThreshold
from veritab.errors import ReconcileFailed
from veritab.plans import reports, results
from veritab.plans.reconcile import (
    Place,
    final_aggregate_status,
    final_status,
    reconcile_aggregates,
    reconcile_all,
    run_summary,
    verify,
)
from veritab.session import shared_path

_PLACE = Place(None, "legacy", "lake", "gold", "snowflake")
_CONFIGS = [
    # Mismatches beyond the column threshold, rows missing on both sides.
    TableConfig("customer", "customer_t", keys=("c_custkey",), thresholds=(ColumnThreshold("c_acctbal", "-5", "0"),)),
    # Mismatches that the table threshold allows; nothing is missing.
    TableConfig("part", "part_t", keys=("p_partkey",), table_thresholds=(TableThreshold("0%", "50%"),)),
    # Equal.
    TableConfig("nation", "nation_t", keys=("n_nationkey",)),
    # Fails: there is no such key.
    TableConfig("region", "region_t", keys=("no_such_key",)),
]
_STORED: dict = {}


def _read_pair(read):
    def pair(config):
        if config.source == "customer":
            return source_side(read, "customer"), target_side(read, "customer")
        if config.source == "part":
            s = source_side(read, "part")
            wrong = F.when(F.col("p_partkey") % 53 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice"))
            return s, s.withColumn("p_retailprice", wrong.cast(MONEY))
        if config.source == "orders":
            return source_side(read, "orders"), target_side(read, "orders")
        return read(config.source), read(config.source)

    return pair


def stored(read, kind: str = "all") -> dict:
    """Result tables of one run per session, kind and data folder."""
    probe = read("orders")
    spark = probe.sparkSession
    mark = (spark.sparkContext.applicationId, probe.inputFiles()[0], kind)
    if mark not in _STORED:
        folder = shared_path(spark, "run")
        written = set()

        def store(table, rows):
            rows.write.mode("append").parquet(f"{folder}/{table}")
            written.add(table)

        if kind == "aggregate":
            reconcile_aggregates(spark, _AGGREGATES, _read_pair(read), store, _PLACE, f"run-{kind}", "tester")
        else:
            configs = _CONFIGS if kind == "all" else _CONFIGS[:1] + _CONFIGS[2:3]
            reconcile_all(spark, configs, _read_pair(read), store, _PLACE, kind, f"run-{kind}", "tester")
        _STORED[mark] = {t: f"{folder}/{t}" for t in written}
    return {t: spark.read.schema(results.layout(t)).parquet(p) for t, p in _STORED[mark].items()}


_AGGREGATES = [
    TableConfig(
        "orders",
        "orders_t",
        aggregates=(
            Aggregate("sum", ("o_totalprice",), ("o_orderstatus",)),
            Aggregate("min", ("o_totalprice",)),
            Aggregate("count", ("o_orderkey",), ("o_custkey",)),
        ),
    ),
    TableConfig("nation", "nation_t", aggregates=(Aggregate("max", ("n_name",), ("n_regionkey",)),)),
]

# The same numbers, counted on columns instead of hashes. The threshold column is not part of the customer comparison.
_COUNTS = f"""
WITH {sides_sql('customer')},
cj AS (SELECT s.c_custkey AS sk, t.c_custkey AS tk,
         s.c_name IS NOT DISTINCT FROM t.c_name AND s.c_nationkey IS NOT DISTINCT FROM t.c_nationkey AND TRIM(s.c_mktsegment) IS NOT DISTINCT FROM TRIM(t.c_mktsegment) AS same,
         s.c_acctbal - t.c_acctbal BETWEEN -5 AND 0 AS inside FROM src s FULL JOIN tgt t ON s.c_custkey = t.c_custkey),
n AS (
  SELECT 'customer' AS name, (SELECT COUNT(*) FROM src) AS source_count, (SELECT COUNT(*) FROM tgt) AS target_count,
    COUNT(*) FILTER (sk IS NULL) AS missing_src, COUNT(*) FILTER (tk IS NULL) AS missing_tgt,
    COUNT(*) FILTER (sk IS NOT NULL AND tk IS NOT NULL AND NOT same) AS mismatch,
    COUNT(*) FILTER (sk IS NOT NULL AND tk IS NOT NULL AND NOT inside) AS threshold,
    'c_mktsegment' AS columns, false AS status, true AS schema_ok, '' AS error FROM cj
  UNION ALL
  SELECT 'part', COUNT(*), COUNT(*), 0, 0, COUNT(*) FILTER (p_partkey % 53 = 0), 0, 'p_retailprice', true, true, '' FROM part
  UNION ALL SELECT 'nation', COUNT(*), COUNT(*), 0, 0, 0, 0, '', true, true, '' FROM nation
  UNION ALL SELECT 'region', 0, 0, NULL, NULL, NULL, NULL, NULL, false, NULL, 'x')"""


def _short(df, *names):
    """Error texts are shortened to a mark, as their wording is Spark's."""
    return df.withColumns({n: F.when(F.length(n) > 0, "x").otherwise(F.col(n)) for n in names})


@query(
    "R18_run_rows",
    """SELECT 'run-all' AS recon_id, 'Snowflake' AS source_type, 'legacy.' || t AS source_table, 'lake.gold.' || t || '_t' AS target_table, 'all' AS report_type,
         'reconcile' AS operation_name, true AS timed FROM (VALUES ('customer'), ('part'), ('nation'), ('region')) v(t)""",
)
def run_rows(read):
    main = stored(read)["main"]
    return main.select(
        "recon_id",
        "source_type",
        results.dotted(F.col("source_table")).alias("source_table"),
        results.dotted(F.col("target_table")).alias("target_table"),
        "report_type",
        "operation_name",
        (F.col("start_ts") <= F.col("end_ts")).alias("timed"),
    )


@query(
    "R19_metrics_rows",
    f"""{_COUNTS} SELECT name, source_count, target_count, missing_src, missing_tgt, mismatch, threshold, columns, schema_ok, status, error FROM n""",
)
def metrics_rows(read):
    run = stored(read)
    m, rows, cols = "recon_metrics", "recon_metrics.row_comparison", "recon_metrics.column_comparison"
    out = run["main"].join(run["metrics"], "recon_table_id").select(
        F.col("source_table.table_name").alias("name"),
        F.col(f"{m}.source_record_count").alias("source_count"),
        F.col(f"{m}.target_record_count").alias("target_count"),
        F.col(f"{rows}.missing_in_source").alias("missing_src"),
        F.col(f"{rows}.missing_in_target").alias("missing_tgt"),
        F.col(f"{cols}.absolute_mismatch").alias("mismatch"),
        F.col(f"{cols}.threshold_mismatch").alias("threshold"),
        F.col(f"{cols}.mismatch_columns").alias("columns"),
        F.col(f"{m}.schema_comparison").alias("schema_ok"),
        F.col("run_metrics.status").alias("status"),
        F.col("run_metrics.exception_message").alias("error"),
    )
    return _short(out, "error")


@query(
    "R20_details_rows",
    f"""{_COUNTS} SELECT name, 'missing_in_source' AS kind, CAST(LEAST(missing_src, 50) AS INTEGER) AS shown FROM n WHERE missing_src > 0
    UNION ALL SELECT name, 'missing_in_target', LEAST(missing_tgt, 50) FROM n WHERE missing_tgt > 0
    UNION ALL SELECT name, 'threshold_mismatch', LEAST(threshold, 50) FROM n WHERE threshold > 0
    UNION ALL SELECT name, 'mismatch', 1 FROM n WHERE mismatch > 0
    UNION ALL SELECT name, 'schema', CASE name WHEN 'customer' THEN 5 WHEN 'part' THEN 5 ELSE 3 END FROM n WHERE schema_ok""",
)
def details_rows(read):
    """Rows shown per kind; the size of a random sample is not fixed, so it counts as one."""
    run = stored(read)
    size = F.when(F.col("recon_type") == "mismatch", F.least(F.size("data"), F.lit(1))).otherwise(F.size("data"))
    return run["main"].join(run["details"], "recon_table_id").select(
        F.col("source_table.table_name").alias("name"), F.col("recon_type").alias("kind"), size.alias("shown")
    )


_RULES = f"""
WITH {sides_sql('orders')},
g AS (SELECT s.k AS sk, t.k AS tk, s.v IS DISTINCT FROM t.v AS bad FROM (SELECT o_orderstatus AS k, SUM(o_totalprice) AS v FROM src GROUP BY 1) s
      FULL JOIN (SELECT o_orderstatus AS k, SUM(o_totalprice) AS v FROM tgt GROUP BY 1) t ON s.k = t.k),
c AS (SELECT s.k AS sk, t.k AS tk, s.v IS DISTINCT FROM t.v AS bad FROM (SELECT o_custkey AS k, COUNT(*) AS v FROM src GROUP BY 1) s
      FULL JOIN (SELECT o_custkey AS k, COUNT(*) AS v FROM tgt GROUP BY 1) t ON s.k = t.k),
r AS (
  SELECT 'orders' AS name, 'sum' AS type, 'SUM(o_totalprice)' AS rule, 'o_orderstatus' AS groups, COUNT(*) FILTER (sk IS NULL) AS missing_src, COUNT(*) FILTER (tk IS NULL) AS missing_tgt,
    COUNT(*) FILTER (sk IS NOT NULL AND tk IS NOT NULL AND bad) AS mismatch FROM g
  UNION ALL SELECT 'orders', 'count', 'COUNT(o_orderkey)', 'o_custkey', COUNT(*) FILTER (sk IS NULL), COUNT(*) FILTER (tk IS NULL), COUNT(*) FILTER (sk IS NOT NULL AND tk IS NOT NULL AND bad) FROM c
  UNION ALL SELECT 'orders', 'min', 'MIN(o_totalprice)', NULL, 0, 0, CASE WHEN (SELECT MIN(o_totalprice) FROM src) = (SELECT MIN(o_totalprice) FROM tgt) THEN 0 ELSE 1 END
  UNION ALL SELECT 'nation', 'max', 'MAX(n_name)', 'n_regionkey', 0, 0, 0)"""


@query(
    "R21_aggregate_rows",
    f"""{_RULES} SELECT name, rule, groups, missing_src, missing_tgt, mismatch, missing_src + missing_tgt + mismatch = 0 AS status,
      CAST(LEAST(missing_src, 50) + LEAST(missing_tgt, 50) + LEAST(mismatch, 50) AS BIGINT) AS shown FROM r""",
)
def aggregate_rows(read):
    run = stored(read, "aggregate")
    shown = run["aggregate_details"].groupBy("rule_id").agg(F.sum(F.size("data")).alias("shown"))
    joined = run["main"].join(run["aggregate_metrics"], "recon_table_id").join(run["aggregate_rules"], "rule_id")
    info, m = F.col("rule_info"), F.col("recon_metrics")
    return joined.join(shown, "rule_id", "left").select(
        F.col("source_table.table_name").alias("name"),
        F.concat(F.upper(info["agg_type"]), F.lit("("), info["agg_column"], F.lit(")")).alias("rule"),
        info["group_by_columns"].alias("groups"),
        m["missing_in_source"].alias("missing_src"),
        m["missing_in_target"].alias("missing_tgt"),
        m["mismatch"].alias("mismatch"),
        F.col("run_metrics.status").alias("status"),
        F.coalesce("shown", F.lit(0)).alias("shown"),
    )


_STATUS_SQL = """SELECT 'run-all' AS recon_id, 'legacy.' || name AS source_table, 'lake.gold.' || name || '_t' AS target_table,
  CASE WHEN error = '' THEN missing_src = 0 AND missing_tgt = 0 END AS "row",
  CASE WHEN error = '' THEN status OR (mismatch = 0 AND threshold = 0 AND columns = '') END AS "column", schema_ok AS schema, error AS exception_message FROM n"""


@query("R22_final_status", f"{_COUNTS} {_STATUS_SQL}")
def status(read):
    run = stored(read)
    return _short(final_status(run["main"], run["metrics"], "run-all"), "exception_message")


@query(
    "R23_final_aggregate_status",
    f"""{_RULES} SELECT 'run-aggregate' AS recon_id, 'legacy.' || name AS source_table, 'lake.gold.' || name || '_t' AS target_table,
      BOOL_AND(missing_src + missing_tgt + mismatch = 0) AS status, '' AS exception_message FROM r GROUP BY name""",
)
def aggregate_status(read):
    run = stored(read, "aggregate")
    return final_aggregate_status(run["main"], run["aggregate_metrics"])


@query(
    "R24_run_summary",
    f"""{_COUNTS}, s AS ({_STATUS_SQL}) SELECT COUNT(*) AS tables, COUNT(*) FILTER (exception_message <> '') AS exceptions,
      COUNT(*) FILTER (exception_message = '' AND NOT ("row" AND "column" AND schema)) AS mismatched,
      COUNT(*) FILTER (exception_message = '' AND "row" AND "column" AND schema) AS succeeded FROM s""",
)
def summary(read):
    """The run holds a failed table, so asking for the verdict raises, with the status attached."""
    run = stored(read)
    try:
        verify(final_status(run["main"], run["metrics"]))
    except ReconcileFailed as e:
        return run_summary(e.result)
    raise AssertionError("the failed table went unnoticed")


@query(
    "R25_many_table_run",
    f"""WITH {sides_sql('customer')} SELECT 'customer' AS name, (SELECT COUNT(*) FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.c_custkey = t.c_custkey AND {same_sql('customer')})) AS missing_src,
      (SELECT COUNT(*) FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE s.c_custkey = t.c_custkey AND {same_sql('customer')})) AS missing_tgt, false AS status
    UNION ALL SELECT 'nation', 0, 0, true""",
)
def many_table_run(read):
    """The row report over several tables."""
    run = stored(read, "row")
    rows = F.col("recon_metrics.row_comparison")
    return run["main"].join(run["metrics"], "recon_table_id").select(
        F.col("source_table.table_name").alias("name"),
        rows["missing_in_source"].alias("missing_src"),
        rows["missing_in_target"].alias("missing_tgt"),
        F.col("run_metrics.status").alias("status"),
    )


@query("R26_many_table_aggregates", f"{_RULES} SELECT name, COUNT(*) AS rules, CAST(SUM(mismatch) AS BIGINT) AS mismatch FROM r GROUP BY 1")
def many_table_aggregates(read):
    run = stored(read, "aggregate")
    joined = run["main"].join(run["aggregate_metrics"], "recon_table_id")
    return joined.groupBy(F.col("source_table.table_name").alias("name")).agg(
        F.count("*").alias("rules"), F.sum("recon_metrics.mismatch").alias("mismatch")
    )


@query(
    "B1_summary",
    f"""{_COUNTS} SELECT 'run-all' AS recon_id, 'Snowflake' AS source_type, 'all' AS report_type, 'legacy.' || name AS source_table, 'lake.gold.' || name || '_t' AS target_table, status,
      error AS exception, source_count AS source_record_count, target_count AS target_record_count, missing_src AS missing_in_source, missing_tgt AS missing_in_target,
      mismatch AS absolute_mismatch, threshold AS threshold_mismatch, columns AS mismatch_columns, schema_ok AS schema_comparison, 'tester' AS executed_by FROM n""",
)
def b_summary(read):
    run = stored(read)
    out = reports.summary(run["main"], run["metrics"])
    drop = [f"{s}_{p}" for s in ("source", "target") for p in ("catalog", "schema", "table_name")]
    return _short(out.drop(*drop, "start_ts", "end_ts"), "exception")


@query(
    "B2_schema_details",
    """SELECT 'legacy.nation' AS source_table, column_name AS source_column, CASE column_type WHEN 'INTEGER' THEN 'int' ELSE 'string' END AS source_datatype, column_name AS target_column,
         CASE column_type WHEN 'INTEGER' THEN 'int' ELSE 'string' END AS target_datatype, 'true' AS is_valid FROM (DESCRIBE SELECT * FROM nation)
       UNION ALL SELECT 'legacy.customer', c, t, c, t, 'true' FROM (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_nationkey', 'int'), ('c_acctbal', 'decimal(18,2)'), ('c_mktsegment', 'string')) v(c, t)
       UNION ALL SELECT 'legacy.part', c, t, c, t, 'true' FROM (VALUES ('p_partkey', 'bigint'), ('p_name', 'string'), ('p_brand', 'string'), ('p_retailprice', 'decimal(18,2)'), ('p_size', 'int')) v(c, t)""",
)
def b_schema_details(read):
    run = stored(read)
    out = reports.schema_details(run["main"], run["details"])
    # The failed table never got as far as its schema rows.
    return out.select("source_table", "source_column", "source_datatype", "target_column", "target_datatype", "is_valid")


@query(
    "B3_drill_down",
    f"""WITH {sides_sql('customer')}, m AS (SELECT * FROM src WHERE c_custkey NOT IN (SELECT c_custkey FROM tgt) ORDER BY c_custkey LIMIT 50),
    k AS (SELECT UNNEST([{{'key': 'c_custkey', 'value': CAST(c_custkey AS VARCHAR)}}, {{'key': 'c_name', 'value': c_name}},
            {{'key': 'c_nationkey', 'value': CAST(c_nationkey AS VARCHAR)}}, {{'key': 'c_mktsegment', 'value': COALESCE(c_mktsegment, '_null_recon_')}}]) AS p FROM m)
    SELECT p.key AS key, p.value AS value FROM k""",
)
def b_drill_down(read):
    run = stored(read)
    out = reports.drill_down(run["main"], run["details"]).filter("recon_type = 'missing_in_target'")
    return out.select("key", "value")


@query(
    "B3_drill_down_numbers",
    f"{_COUNTS} SELECT CAST(UNNEST(range(LEAST(missing_tgt, 50))) + 1 AS INTEGER) AS rn, 4 AS pairs FROM n WHERE name = 'customer'",
)
def b_drill_down_numbers(read):
    run = stored(read)
    out = reports.drill_down(run["main"], run["details"]).filter("recon_type = 'missing_in_target'")
    return out.groupBy("rn").agg(F.count("*").cast("int").alias("pairs"))


def _dated(df):
    return df.withColumn("start_date", F.col("start_date").isNotNull())


@query("B4_failed_runs_per_table", f"{_COUNTS} SELECT 'run-all' AS recon_id, 'lake.gold.' || name || '_t' AS target_table, true AS start_date FROM n WHERE NOT status")
def b_failed_runs_per_table(read):
    run = stored(read)
    return _dated(reports.failed_runs_per_table(run["main"], run["metrics"]))


@query("B5_failed_runs", f"{_COUNTS} SELECT 'run-all' AS recon_id, true AS start_date FROM n WHERE NOT status")
def b_failed_runs(read):
    run = stored(read)
    return _dated(reports.failed_runs(run["main"], run["metrics"]))


@query("B6_failed_and_successful_targets", f"{_COUNTS} SELECT 'lake.gold.' || name || '_t' AS target_table, true AS start_date, status FROM n")
def b_targets(read):
    run = stored(read)
    both = [reports.targets(run["main"], run["metrics"], ok).withColumn("status", F.lit(ok)) for ok in (False, True)]
    return _dated(both[0].unionByName(both[1]))


def _series(read, names, tables=("main", "metrics"), kind="all", fn=reports.series):
    run = stored(read, kind)
    parts = [
        fn(run[tables[0]], run[tables[1]], n).select("target_table", F.lit(n).alias("measure"), F.col(n).alias("n"))
        for n in names
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "B7_mismatch_series",
    f"""{_COUNTS} SELECT 'lake.gold.' || name || '_t' AS target_table, 'absolute_mismatch' AS measure, mismatch AS n FROM n
    UNION ALL SELECT 'lake.gold.' || name || '_t', 'threshold_mismatch', threshold FROM n""",
)
def b_mismatch_series(read):
    return _series(read, ("absolute_mismatch", "threshold_mismatch"))


@query(
    "B8_missing_series",
    f"""{_COUNTS} SELECT 'lake.gold.' || name || '_t' AS target_table, 'missing_in_target' AS measure, missing_tgt AS n FROM n
    UNION ALL SELECT 'lake.gold.' || name || '_t', 'missing_in_source', missing_src FROM n""",
)
def b_missing_series(read):
    return _series(read, ("missing_in_target", "missing_in_source"))


@query(
    "B9_aggregate_summary",
    f"""{_RULES} SELECT 'run-aggregate' AS recon_id, 'legacy.' || name AS source_table, 'lake.gold.' || name || '_t' AS target_table, rule AS aggregate_column, groups AS group_by_columns,
      missing_src + missing_tgt + mismatch = 0 AS status, '' AS exception, missing_src AS missing_in_source, missing_tgt AS missing_in_target, mismatch, 'tester' AS executed_by FROM r""",
)
def b_aggregate_summary(read):
    run = stored(read, "aggregate")
    out = reports.aggregate_summary(run["main"], run["aggregate_metrics"], run["aggregate_rules"])
    drop = [f"{s}_{p}" for s in ("source", "target") for p in ("catalog", "schema", "table_name")]
    return out.drop(*drop, "start_ts", "end_ts", "source_type")


@query(
    "B10_aggregate_details",
    f"""WITH {sides_sql('orders')}, a AS (SELECT o_orderstatus AS k, CAST(SUM(o_totalprice) AS DECIMAL(28,2)) AS v FROM src GROUP BY 1),
    b AS (SELECT o_orderstatus AS k, CAST(SUM(o_totalprice) AS DECIMAL(28,2)) AS v FROM tgt GROUP BY 1)
    SELECT 'mismatch' AS recon_type, 'sum' AS aggregate_type, 'SUM(o_totalprice)' AS aggregate_column, CAST(a.v AS VARCHAR) AS source_value, CAST(b.v AS VARCHAR) AS target_value,
      'o_orderstatus:' || k AS group_by_columns, 'false' AS status FROM a JOIN b USING (k) WHERE a.v <> b.v""",
)
def b_aggregate_details(read):
    run = stored(read, "aggregate")
    out = reports.aggregate_details(run["main"], run["aggregate_rules"], run["aggregate_details"])
    return out.filter("aggregate_type = 'sum'").select(
        "recon_type", "aggregate_type", "aggregate_column", "source_value", "target_value",
        F.array_join("group_by_columns", ",").alias("group_by_columns"), "status",
    )


@query(
    "B11_aggregate_series",
    f"""{_RULES} SELECT 'lake.gold.' || name || '_t' AS target_table, 'mismatch' AS measure, mismatch AS n FROM r
    UNION ALL SELECT 'lake.gold.' || name || '_t', 'missing_in_target', missing_tgt FROM r UNION ALL SELECT 'lake.gold.' || name || '_t', 'missing_in_source', missing_src FROM r""",
)
def b_aggregate_series(read):
    names = ("mismatch", "missing_in_target", "missing_in_source")
    return _series(read, names, ("main", "aggregate_metrics"), "aggregate", reports.aggregate_series)
