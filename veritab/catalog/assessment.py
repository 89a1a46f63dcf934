"""Checks and workload reports; workload tables are derived from the given ones, row for row."""

from pyspark.sql import functions as F

from veritab.catalog.data import MONEY
from veritab.catalog.registry import query
from veritab.operators import assessment as A
from veritab.operators.schemas import table_schema

_NULLED = "NULLIF(p_size % 7, 0)"


def _part(read):
    return read("part").withColumn("p_group", F.nullif(F.col("p_size") % 7, F.lit(0)))


@query(
    "C1_null_check",
    f"""SELECT 'part' AS "table", 'p_group' AS "column", 'NullValidationCheck' AS strategy, CASE WHEN COUNT(*) FILTER ({_NULLED} IS NULL) > 0 THEN 'FAIL' ELSE 'PASS' END AS outcome,
         'WARN' AS severity, CAST(NULL AS VARCHAR) AS summary FROM part
       UNION ALL SELECT 'part', 'p_name', 'NullValidationCheck', CASE WHEN COUNT(*) FILTER (p_name IS NULL) > 0 THEN 'FAIL' ELSE 'PASS' END, 'ERROR', NULL FROM part""",
)
def null_check(read):
    p = _part(read)
    return A.check_nulls(p, "part", "p_group").unionByName(A.check_nulls(p, "part", "p_name", "ERROR"))


@query(
    "C2_empty_check",
    """SELECT 'events' AS "table", (SELECT CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END FROM events) AS outcome, CAST(NULL AS VARCHAR) AS summary
       UNION ALL SELECT 'no events', (SELECT CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END FROM events WHERE value < -1), NULL
       UNION ALL SELECT 'absent', 'FAIL', 'Table not found.'""",
)
def empty_check(read):
    e = read("events")
    report = A.validation_report(
        [
            A.check_not_empty(e, "events"),
            A.check_not_empty(e.filter("value < -1"), "no events"),
            A.check_not_empty(None, "absent", spark=e.sparkSession),
        ]
    )
    return report.select("table", "outcome", "summary")


def _expected(read, changes):
    rows = [(i, f.name, changes.get(f.name, f.dataType.simpleString())) for i, f in enumerate(read("customer").schema)]
    rows += [(len(rows), "c_phone", "string")] if "c_phone" in changes else []
    return read("customer").sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def _schema_checks(read):
    actual = table_schema(read("customer"))
    return A.validation_report(
        [
            A.check_schema(actual, _expected(read, {}), "good", "ERROR"),
            A.check_schema(actual, _expected(read, {"c_nationkey": "string", "c_phone": ""}), "types"),
            A.check_schema(actual, _expected(read, {"c_phone": ""}), "columns"),
            A.check_schema(None, _expected(read, {}), "absent"),
        ]
    )


@query(
    "C3_schema_check",
    """WITH c AS (SELECT COUNT(*) AS n FROM (DESCRIBE SELECT * FROM customer) WHERE column_name = 'c_nationkey' AND column_type = 'INTEGER')
       SELECT 'good' AS "table", CAST(NULL AS VARCHAR) AS "column", 'PASS' AS outcome, 'ERROR' AS severity, 'All columns match expected schema' AS summary FROM c WHERE n = 1
       UNION ALL SELECT 'types', 'c_nationkey', 'FAIL', 'WARN', 'Unexpected column data type' FROM c WHERE n = 1
       UNION ALL SELECT 'columns', 'c_phone', 'FAIL', 'WARN', 'Column does not exist' UNION ALL SELECT 'absent', NULL, 'FAIL', 'WARN', 'Table not found in the profiler extract'""",
)
def schema_check(read):
    return _schema_checks(read).select("table", "column", "outcome", "severity", "summary")


@query(
    "C4_validation_report",
    f"""SELECT strategy, outcome, COUNT(*) AS n FROM (
         SELECT 'NullValidationCheck' AS strategy, CASE WHEN (SELECT COUNT(*) FROM part WHERE {_NULLED} IS NULL) > 0 THEN 'FAIL' ELSE 'PASS' END AS outcome
         UNION ALL SELECT 'EmptyTableValidationCheck', CASE WHEN (SELECT COUNT(*) FROM part) > 0 THEN 'PASS' ELSE 'FAIL' END
         UNION ALL SELECT 'ExtractSchemaValidationCheck', v FROM (VALUES ('PASS'), ('FAIL'), ('FAIL'), ('FAIL')) t(v)) GROUP BY ALL""",
)
def validation_report(read):
    p = _part(read)
    report = A.validation_report([A.check_nulls(p, "part", "p_group"), A.check_not_empty(p, "part"), _schema_checks(read)])
    return report.groupBy("strategy", "outcome").agg(F.count("*").alias("n"))


@query(
    "C5_ingest_gate",
    f"""WITH n AS (SELECT CASE WHEN COUNT(*) FILTER ({_NULLED} IS NULL) > 0 THEN 1 ELSE 0 END AS f FROM part)
       SELECT 'warnings only' AS gate, 2 AS checks, 0 AS errors, true AS open FROM n UNION ALL SELECT 'with error', 2, f, f = 0 FROM n""",
)
def ingest_gate(read):
    p = _part(read)
    soft = A.validation_report([A.check_nulls(p, "part", "p_group"), A.check_not_empty(p, "part", "ERROR")])
    hard = A.validation_report([A.check_nulls(p, "part", "p_group", "ERROR"), A.check_not_empty(p, "part", "ERROR")])
    gates = [A.ingest_gate(r).withColumn("gate", F.lit(n)) for n, r in (("warnings only", soft), ("with error", hard))]
    return gates[0].unionByName(gates[1]).select(
        "gate", F.col("checks").cast("int").alias("checks"), F.col("errors").cast("int").alias("errors"), "open"
    )


# One statement per order; the number of the pattern is the key modulo their count.
_PATTERNS = (
    ("SELECT * FROM t", "QUERY"),
    ("  with x as (select 1) select", "QUERY"),
    ("insert into t values", "DML"),
    ("BEGIN TRAN work", "DML"),
    ("declare @x int", "DML"),
    ("CREATE TABLE t", "DDL"),
    ("drop view v", "DDL"),
    ("EXEC proc", "ROUTINE"),
    ("END TRANSACTION", "TRANSACTION_CONTROL"),
    ("COMMIT", "TRANSACTION_CONTROL"),
    ("rollback tran", "TRANSACTION_CONTROL"),
    ("GRANT SELECT ON t", "OTHER"),
    ("END", "OTHER"),
    ("(select 1)", "OTHER"),
)


def _requests(read):
    texts = F.array(*[F.lit(t) for t, _ in _PATTERNS])
    key = F.col("o_orderkey")
    return read("orders").select(
        key.alias("request_id"),
        F.concat(F.get(texts, (key % len(_PATTERNS)).cast("int")), F.lit(" "), key.cast("string")).alias("command"),
        F.col("o_orderdate").alias("start_time"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=F.lit(1))).alias("end_time"),
    )


_PATTERN_SQL = ", ".join(f"({i}, '{t}', '{c}')" for i, (t, c) in enumerate(_PATTERNS))


@query(
    "C7_statement_class",
    f"""SELECT o_orderkey AS request_id, c AS command_type FROM orders JOIN (VALUES {_PATTERN_SQL}) v(i, t, c) ON o_orderkey % {len(_PATTERNS)} = i
        WHERE o_orderdate + INTERVAL 1 HOUR > TIMESTAMP '1996-01-01'""",
)
def statement_class(read):
    edge = F.lit("1996-01-01").cast("timestamp_ntz")
    return A.classified_requests(_requests(read), "pool", after=edge).select("request_id", "command_type")


@query("C8_redaction", "SELECT o_orderkey AS request_id, '[REDACTED]' AS command, 'pool' AS pool_name FROM orders")
def redaction(read):
    return A.classified_requests(_requests(read), "pool").select("request_id", "command", "pool_name")


@query(
    "C9_storage_per_node",
    """SELECT l_suppkey % 60 AS node_id, CAST(SUM(l_orderkey) * 8 // 1024 AS BIGINT) AS reserved_mb, CAST(SUM(l_partkey) * 8 // 1024 AS BIGINT) AS used_mb FROM lineitem GROUP BY 1""",
)
def storage_per_node(read):
    stats = read("lineitem").select(
        (F.col("l_suppkey") % 60).alias("node_id"),
        F.col("l_orderkey").alias("reserved_page_count"),
        F.col("l_partkey").alias("used_page_count"),
    )
    return A.storage_per_node(stats)


@query(
    "C10_table_storage",
    """SELECT o_custkey AS object_id, 'ix_' || c_custkey || '_' || (o_orderkey % 2) AS index_name, CASE WHEN o_orderkey % 2 = 0 THEN 'HEAP' ELSE 'CLUSTERED' END AS index_type,
         o_orderkey * 10 AS row_count, o_orderkey * 8.0 / 1024 AS total_size_mb, (o_orderkey % 100) * 8.0 / 1024 AS used_size_mb, o_orderkey AS total_pages
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_custkey > 255""",
)
def table_storage(read):
    key = F.col("o_orderkey")
    partitions = read("orders").select(
        key.alias("partition_id"), F.col("o_custkey").alias("object_id"), (key % 2).alias("index_id"), (key * 10).alias("row_count")
    )
    index = F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long")))
    indexes = read("customer").select(F.col("c_custkey").alias("object_id"), index.alias("index_id")).select(
        "object_id",
        "index_id",
        F.concat_ws("_", F.lit("ix"), F.col("object_id").cast("string"), F.col("index_id").cast("string")).alias("index_name"),
        F.when(F.col("index_id") == 0, "HEAP").otherwise("CLUSTERED").alias("index_type"),
    )
    units = read("orders").select(key.alias("container_id"), key.alias("total_pages"), (key % 100).alias("used_pages"))
    out = A.table_storage(partitions, indexes, units)
    return out.withColumns({c: F.col(c).cast("double") for c in ("total_size_mb", "used_size_mb")})


def _statements(read):
    micros = (F.col("value").cast(MONEY) * 1000000).cast("long")
    return read("events").select(
        F.col("event_id").alias("statement_id"),
        F.col("event_type").alias("command_type"),
        F.col("ts").alias("last_execution_time"),
        F.col("ts").alias("creation_time"),
        micros.alias("total_elapsed_time"),
        (micros / 2).cast("long").alias("total_worker_time"),
    )


@query(
    "C11_statement_statistics",
    """SELECT event_id AS statement_id, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS total_elapsed_sec FROM events
       WHERE ts >= (SELECT MAX(ts) FROM events) - INTERVAL 7 DAY""",
)
def statement_statistics(read):
    stats = _statements(read)
    now = stats.agg(F.max("last_execution_time")).scalar()
    return A.statement_statistics(stats, now, 7).select(
        "statement_id", F.col("total_elapsed_sec").cast("double").alias("total_elapsed_sec")
    )


@query(
    "C12_statement_slice",
    """SELECT doc_id, substring(text, CAST(doc_id % 40 + 1 AS BIGINT), CASE WHEN doc_id % 3 = 0 THEN length(text) ELSE 31 END) AS statement FROM documents""",
)
def statement_slice(read):
    start = (F.col("doc_id") % 40) * 2
    end = F.when(F.col("doc_id") % 3 == 0, F.lit(-1).cast("long")).otherwise(start + 60)
    return read("documents").select("doc_id", A.statement_slice(F.col("text"), start, end).alias("statement"))


@query(
    "C13_metric_flattening",
    """SELECT event_type AS name, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, value AS average, user_id AS count, value * 2 AS maximum, value / 2 AS minimum, value * user_id AS total FROM events
       UNION ALL SELECT event_type, strftime(ts + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S'), value + 1, user_id, value * 2, value / 2, value * user_id FROM events""",
)
def metric_flattening(read):
    """Two series with one point each per event, nested as a metrics service answers."""

    def point(at, average):
        return F.array(
            F.struct(
                at.alias("timestamp"),
                average.alias("average"),
                F.col("user_id").alias("count"),
                (F.col("value") * 2).alias("maximum"),
                (F.col("value") / 2).alias("minimum"),
                (F.col("value") * F.col("user_id")).alias("total"),
            )
        ).alias("data")

    later = F.col("ts") + F.make_dt_interval(mins=F.lit(1))
    series = F.array(F.struct(point(F.col("ts"), F.col("value"))), F.struct(point(later, F.col("value") + 1)))
    nested = read("events").select(F.col("event_type").alias("name"), series.alias("timeseries"))
    return A.flatten_metrics(nested).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


@query("C14_field_projection", "SELECT c_custkey, c_name FROM customer")
def field_projection(read):
    kept = A.project_fields(read("customer"), keep=("C_CUSTKEY", "c_Name", "c_acctbal"))
    return A.project_fields(kept, remove=("C_ACCTBAL",))


@query(
    "C15_cpu_by_hour",
    """SELECT event_id, user_id AS system_idle, CAST(hour(ts) AS INTEGER) AS hr FROM events WHERE user_id + CAST(floor(value) AS BIGINT) <= 100""",
)
def cpu_by_hour(read):
    cpu = read("events").select(
        "event_id", F.col("ts").alias("event_time"), F.col("user_id").alias("system_idle"), F.floor("value").alias("sql_utilization")
    )
    return A.cpu_by_hour(cpu).select("event_id", "system_idle", "hr")


@query("C16_database_sizes", "SELECT p_name AS name, ROUND(CAST(CAST(p_retailprice AS DECIMAL(18,2)) / 1024 AS DECIMAL(28,10)), 2)::DOUBLE AS size_gb FROM part")
def database_sizes(read):
    sizes = read("part").select(F.col("p_name").alias("db_name"), F.col("p_retailprice").cast(MONEY).alias("size_mb"))
    return A.database_sizes(sizes).withColumn("size_gb", F.col("size_gb").cast("double"))


@query(
    "C17_creation_parts",
    "SELECT event_id AS statement_id, strftime(ts, '%Y-%m-%d') AS creation_date, CAST(hour(ts) AS INTEGER) AS creation_hr FROM events",
)
def creation_parts(read):
    out = A.with_creation_parts(_statements(read))
    return out.select("statement_id", F.col("creation_date").cast("string").alias("creation_date"), "creation_hr")


@query(
    "C18_cpu_share",
    """WITH s AS (SELECT event_type, SUM(CAST(CAST(value AS DECIMAL(18,2)) * 1000000 / 2 AS BIGINT)) AS w FROM events GROUP BY 1)
       SELECT event_type AS workload_type, ROUND(w::DOUBLE / (SELECT SUM(w) FROM s), 1) AS percent_cpu_time FROM s""",
)
def cpu_share(read):
    return A.cpu_share(_statements(read))


@query(
    "C18_session_flow",
    """SELECT c_mktsegment AS stage1, c_name AS stage2, o_orderstatus AS stage3, SUM(o_orderkey % 1000) AS value
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def session_flow(read):
    sessions = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("program_name"),
        F.col("c_name").alias("login_name"),
        F.col("o_orderstatus").alias("db_name"),
        (F.col("o_orderkey") % 1000).alias("cpu_time"),
    )
    return A.session_flow(sessions)


@query(
    "C19_system_information",
    """WITH i AS (SELECT COUNT(*) AS n, MAX(l_linenumber) AS r, COUNT(DISTINCT l_suppkey) AS w FROM lineitem)
       SELECT 'cpu_count' AS name, CAST(n AS VARCHAR) AS value FROM i UNION ALL SELECT 'hyperthread_ratio', CAST(r AS VARCHAR) FROM i
       UNION ALL SELECT 'max_workers_count', CAST(w AS VARCHAR) FROM i UNION ALL SELECT 'physical_memory_gb', CAST(ROUND(n * 1000.0 / 1024 / 1024, 1) AS VARCHAR) FROM i
       UNION ALL SELECT 'virtual_machine', 'HYPERVISOR'""",
)
def system_information(read):
    info = read("lineitem").agg(
        F.count("*").alias("cpu_count"),
        F.max("l_linenumber").alias("hyperthread_ratio"),
        F.count_distinct("l_suppkey").alias("max_workers_count"),
        (F.count("*") * 1000).alias("physical_memory_kb"),
        F.lit("HYPERVISOR").alias("virtual_machine_type_desc"),
    )
    return A.system_information(info)


@query("C20_database_inventory", "SELECT o_orderkey AS db_id, o_orderpriority AS name, strftime(o_orderdate, '%Y-%m-%d') AS created_on FROM orders")
def database_inventory(read):
    databases = read("orders").select(
        F.col("o_orderkey").alias("db_id"), F.col("o_orderpriority").alias("name"), F.col("o_orderdate").alias("create_date")
    )
    return A.database_inventory(databases).withColumn("created_on", F.col("created_on").cast("string"))
