"""Sources, sinks and loads. Files go to the session's shared folder."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.catalog.data import MONEY
from veritab.catalog.registry import query
from veritab.operators.canonical import lower_names
from veritab.operators.schemas import table_schema
from veritab.plans.results import METRICS, TABLES, layout
from veritab.session import materialise, shared_path
from veritab.sources import jdbc, scans, sinks
from veritab.streaming import incremental


def _folder(df, name):
    return shared_path(df.sparkSession, name)


@query("S1_table_scan", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def table_scan(read):
    shouting = read("customer").toDF(*[c.upper() for c in read("customer").columns])
    name = f"veritab_scan_{uuid.uuid4().hex}"
    shouting.createOrReplaceTempView(name)
    return scans.read_table(shouting.sparkSession, name).select("c_custkey", "c_name", "c_mktsegment")


@query(
    "S3_remote_names",
    """SELECT p_partkey, 'tpch.t' || p_partkey AS oracle, 'db.tpch.t' || p_partkey AS snowflake, 'tpch.[t' || p_partkey || ']' AS sqlserver FROM part""",
)
def remote_names(read):
    """Names of as many tables as there are parts."""
    key = F.col("p_partkey").cast("string")

    def named(system):
        before, after = jdbc.remote_name(system, "db", "tpch", "t\0").split("\0")
        return F.concat(F.lit(before), key, F.lit(after)).alias(system)

    return read("part").select("p_partkey", named("oracle"), named("snowflake"), named("sqlserver"))


@query(
    "S4_schema_read",
    """SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' ELSE 'string' END AS data_type
       FROM (DESCRIBE SELECT * FROM part)""",
)
def schema_read(read):
    return table_schema(read("part"))


@query(
    "S6_record_count",
    """SELECT (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'F') AS source_count,
              (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 97 <> 0) AS target_count""",
)
def record_count(read):
    return scans.record_count(read("orders"), read("orders"), "o_orderstatus = 'F'", "o_orderstatus = 'F' and o_orderkey % 97 <> 0")


@query(
    "S7_materialise",
    "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def materialised(read):
    joined = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return materialise(joined.select("o_orderkey", "c_name"), "joined")


@query("S8_append", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey + 100, n_name FROM nation")
def appended(read):
    n = read("nation").select("n_nationkey", "n_name")
    name, path = f"veritab_append_{uuid.uuid4().hex}", _folder(n, "append")
    spark = n.sparkSession
    spark.sql(f"create table {name} (n_nationkey int, n_name string) using parquet location '{path}'")
    sinks.append(n, name)
    sinks.append(n.withColumn("n_nationkey", F.col("n_nationkey") + 100), name)
    rows = spark.read.parquet(path)
    spark.sql(f"drop table {name}")
    return rows


@query(
    "S9_result_tables",
    """SELECT t AS table_name, n AS columns, CASE WHEN t = 'aggregate_rules' THEN 0 ELSE (SELECT COUNT(*) FROM orders) END AS rows
       FROM (VALUES ('main', 9), ('metrics', 4), ('details', 5), ('aggregate_rules', 4), ('aggregate_metrics', 5), ('aggregate_details', 5), ('differences', 4), ('aggregate_differences', 5)) v(t, n)""",
)
def result_tables(read):
    """One row per order in the layout of every result table; rules have no table id."""
    runs = read("orders").select(F.col("o_orderkey").alias("recon_table_id"), F.lit("r").alias("recon_id"))
    parts = []
    for name in TABLES:
        wanted = layout(name)
        kept = sinks.conform(runs, wanted)
        held = F.count("recon_table_id") if "recon_table_id" in kept.columns else F.lit(0).cast("long")
        parts.append(
            kept.agg(held.alias("rows")).select(F.lit(name).alias("table_name"), F.lit(len(wanted)).alias("columns"), "rows")
        )
    return sinks.union_all(parts)


@query(
    "S10_conform",
    """SELECT c_custkey AS recon_table_id, c_custkey % 5 AS source_count, CAST(NULL AS BIGINT) AS threshold_mismatch, c_name AS run_by_user FROM customer""",
)
def conformed(read):
    """Rows of an older layout, with int counts and without some fields, in the present layout."""
    old = read("customer").select(
        F.col("c_custkey").alias("recon_table_id"),
        F.struct((F.col("c_custkey") % 5).cast("int").alias("source_record_count")).alias("recon_metrics"),
        F.struct(F.lit(True).alias("status"), F.col("c_name").alias("run_by_user")).alias("run_metrics"),
        F.lit("gone").alias("retired"),
    )
    new = sinks.conform(old, T.StructType.fromDDL(METRICS))
    return new.select(
        "recon_table_id",
        F.col("recon_metrics.source_record_count").alias("source_count"),
        F.col("recon_metrics.column_comparison.threshold_mismatch").alias("threshold_mismatch"),
        F.col("run_metrics.run_by_user").alias("run_by_user"),
    )


@query("S11_step_load", "SELECT s_suppkey, s_name FROM supplier")
def step_load(read):
    """An empty step leaves the stored rows alone."""
    s = read("supplier").select("s_suppkey", "s_name")
    spark, name, path = s.sparkSession, f"veritab_step_{uuid.uuid4().hex}", _folder(s, "step")
    spark.sql(f"create table {name} (s_suppkey bigint, s_name string) using parquet location '{path}'")
    assert sinks.load_step(s, name, "append")
    assert not sinks.load_step(s.filter("s_suppkey < 0"), name)
    rows = spark.read.parquet(path)
    spark.sql(f"drop table {name}")
    return rows


@query(
    "S12_ingest_extract",
    """SELECT 'nation' AS table_name, true AS loaded, (SELECT COUNT(*) FROM nation) AS rows UNION ALL
       SELECT 'orders', true, (SELECT COUNT(*) FROM orders) UNION ALL SELECT 'absent', false, 0""",
)
def ingest(read):
    o = read("orders")
    folder = _folder(o, "extract")
    for t in ("nation", "orders"):
        read(t).write.parquet(f"{folder}/{t}.parquet")
    target = _folder(o, "ingested")
    outcome = sinks.ingest_extract(o.sparkSession, folder, ["nation", "orders", "absent"], target)
    stored = None
    for t in ("nation", "orders"):
        n = o.sparkSession.read.parquet(f"{target}/{t}").agg(F.count("*").alias("rows")).withColumn("table_name", F.lit(t))
        stored = n if stored is None else stored.unionByName(n)
    return outcome.join(stored, "table_name", "left").select("table_name", "loaded", F.coalesce("rows", F.lit(0)).alias("rows"))


def _csv(read):
    c = read("customer").select("c_custkey", "c_name", F.col("c_acctbal").cast(MONEY).alias("c_acctbal"))
    path = _folder(c, "csv")
    sinks.write_file(c.repartition(3, "c_custkey"), path, "csv", header=True, sep="|")
    return c.sparkSession, path


_LAYOUT = {"id": "bigint", "full_name": "string", "balance": MONEY}


@query("S13_delimited_scan", "SELECT c_custkey AS id, c_name AS full_name, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer")
def delimited_scan(read):
    spark, path = _csv(read)
    return scans.read_delimited(spark, path, _LAYOUT, "|")


@query(
    "S14_many_files",
    "SELECT CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS balance, COUNT(*) AS rows, 3 AS files FROM customer",
)
def many_files(read):
    """Rows of three files with their file beside each; the log has one line per file."""
    spark, path = _csv(read)
    rows = scans.read_many(spark, f"{path}/*.csv", _LAYOUT, "|")
    log = scans.load_log(rows)
    files = log.agg(F.count("*").cast("int").alias("files"), F.sum("row_count").alias("rows"))
    total = rows.agg(F.sum("balance").cast("decimal(38,2)").alias("balance"))
    return files.withColumn("balance", total.scalar())


@query(
    "S15_json_lines",
    "SELECT event_type AS project, COUNT(*) AS total, COUNT(*) FILTER (value > 20) AS parsed FROM events GROUP BY 1",
)
def json_lines(read):
    e = read("events").select(F.col("event_type").alias("project"), (F.col("value") > 20).alias("parsed"))
    path = _folder(e, "json")
    e.write.json(path)
    back = scans.read_json_lines(e.sparkSession, path, "project string, parsed boolean")
    return back.groupBy("project").agg(F.count("*").alias("total"), F.count_if("parsed").alias("parsed"))


@query("S16_file_sink", "SELECT p_partkey, p_name, p_size FROM part")
def file_sink(read):
    p = read("part").select("p_partkey", "p_name", "p_size")
    path = _folder(p, "sink")
    sinks.write_file(p, path, "parquet", mode="overwrite")
    return lower_names(p.sparkSession.read.parquet(path))


@query("C6_incremental_load", "SELECT event_id, user_id FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'")
def incremental_load(read):
    """The stored extract ends on the 20th; the next one brings what came later."""
    e = read("events").select("event_id", "user_id", "ts")
    edge = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    stored = e.filter(F.col("ts") < edge).unionByName(
        e.limit(0).sparkSession.range(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("user_id"), edge.alias("ts"))
    )
    return incremental.new_rows(e, stored, "ts").select("event_id", "user_id")


@query(
    "C6_rows_that_share_the_mark",
    "SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-20' OR (CAST(ts AS DATE) = DATE '2024-01-20' AND event_id % 3 <> 0)",
)
def rows_that_share_the_mark(read):
    """The mark is a day; a third of the rows of the last day stored are stored already."""
    e = read("events").select("event_id", F.col("ts").cast("date").alias("day"))
    edge = F.lit("2024-01-20").cast("date")
    stored = e.filter((F.col("day") < edge) | ((F.col("day") == edge) & (F.col("event_id") % 3 == 0)))
    return incremental.rows_not_stored(e, stored, "day")


@query("C6_high_water_mark", "SELECT strftime(MAX(ts), '%Y-%m-%d %H:%M:%S.%f') AS high_water_mark FROM events")
def high_water_mark(read):
    return incremental.high_water_mark(read("events"), "ts").select(
        F.date_format("high_water_mark", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("high_water_mark")
    )
