"""Data-flow stages and table changes."""

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from veritab.catalog.data import MONEY, sides_sql, source_side, target_side
from veritab.catalog.registry import query
from veritab.operators import changes as D
from veritab.operators import stages as E
from veritab.operators.ranking import asc, desc
from veritab.session import shared_path
from veritab.streaming.incremental import rows_after

_CHANGED = "(s.c_acctbal IS DISTINCT FROM t.c_acctbal OR s.c_mktsegment IS DISTINCT FROM t.c_mktsegment)"


def _both(read):
    pick = ["c_custkey", "c_acctbal", "c_mktsegment"]
    s, t = source_side(read, "customer").select(*pick), target_side(read, "customer").select(*pick)
    return s, t.withColumn("c_mktsegment", F.trim("c_mktsegment"))


_BOTH_SQL = f"""WITH {sides_sql('customer')}, s AS (SELECT c_custkey, c_acctbal, c_mktsegment FROM src),
  t AS (SELECT c_custkey, c_acctbal, TRIM(c_mktsegment) AS c_mktsegment FROM tgt)"""


@query(
    "E1_aggregate",
    """SELECT o_orderstatus, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, COUNT(*) AS n, ROUND(AVG(CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE), 4) AS mean,
         MIN(o_totalprice) AS low, MAX(o_totalprice) AS high FROM orders GROUP BY 1""",
)
def aggregate(read):
    price = F.col("o_totalprice").cast(MONEY)
    return E.aggregate(
        read("orders"),
        ["o_orderstatus"],
        total=F.sum(price).cast("double"),
        n=F.count("*"),
        mean=F.round(F.avg(price).cast("double"), 4),
        low=F.min("o_totalprice"),
        high=F.max("o_totalprice"),
    )


@query(
    "E2_change_capture",
    f"""{_BOTH_SQL} SELECT COALESCE(t.c_custkey, s.c_custkey) AS c_custkey,
      CASE WHEN t.c_custkey IS NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
      CASE WHEN t.c_custkey IS NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment,
      CASE WHEN s.c_custkey IS NULL THEN 'insert' WHEN t.c_custkey IS NULL THEN 'delete' WHEN {_CHANGED} THEN 'update' ELSE 'copy' END AS change
    FROM s FULL JOIN t USING (c_custkey)""",
)
def change_capture(read):
    return E.change_capture(*_both(read), ["c_custkey"])


@query("E3_difference", f"{_BOTH_SQL} SELECT * FROM s EXCEPT ALL SELECT * FROM t")
def difference(read):
    return E.difference(*_both(read))


@query(
    "E4_column_export_import",
    """SELECT p_partkey, p_name || '|' || COALESCE(CAST(NULLIF(p_size % 7, 0) AS VARCHAR), '') || '|' || p_brand AS line, p_name AS name, NULLIF(p_size % 7, 0) AS size, p_brand AS brand FROM part""",
)
def column_export_import(read):
    p = read("part").select("p_partkey", "p_name", F.nullif(F.col("p_size") % 7, F.lit(0)).alias("n"), "p_brand")
    line = E.export_columns(p, ["p_name", "n", "p_brand"], "line", "|").withColumn("text", F.col("line"))
    return E.import_columns(line, "text", {"name": "string", "size": "int", "brand": "string"}, "|")


@query("E4_json_import", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_import(read):
    return E.import_json(read("events").select("event_id", "props"), "props", "k int")


@query("E5_copy", "SELECT 'a' AS output, COUNT(*) AS n, COUNT(DISTINCT c_name) AS names FROM customer UNION ALL SELECT 'b', COUNT(*), 0 FROM customer")
def copy(read):
    a, b = E.copy(E.copy_column(read("customer"), "c_name", "name_copy"), None, ["c_custkey"])
    left = a.agg(F.lit("a").alias("output"), F.count("*").alias("n"), F.count_distinct("name_copy").alias("names"))
    return left.unionByName(b.agg(F.lit("b").alias("output"), F.count("*").alias("n"), F.lit(0).cast("long").alias("names")))


@query("E6_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 1000 AND 50000")
def filter_(read):
    return read("orders").filter(F.col("o_totalprice").between(1000, 50000)).select("o_orderkey", "o_totalprice")


def _outputs():
    return [("high", F.col("o_totalprice") > 300000), ("middle", F.col("o_totalprice") > 100000)]


@query(
    "E7_conditional_split",
    """SELECT CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'middle' ELSE 'low' END AS output, o_orderkey FROM orders""",
)
def conditional_split(read):
    parts = E.split_rows(read("orders").select("o_orderkey", "o_totalprice"), _outputs(), "low")
    return E.funnel(*[d.select(F.lit(n).alias("output"), "o_orderkey") for n, d in parts.items()])


@query("E8_funnel", "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def funnel(read):
    a = read("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return E.funnel(a, read("supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")))


@query("E9_sorted_merge", "SELECT c_custkey AS id, c_acctbal AS v FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier ORDER BY 2, 1")
def sorted_merge(read):
    a = read("customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("v"))
    return E.sorted_merge(["v", "id"], a, read("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("v")))


@query(
    "E10_join_kinds",
    """WITH c AS (SELECT c_custkey AS k, c_name FROM customer WHERE c_acctbal > 0), o AS (SELECT o_custkey AS k, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
       SELECT 'inner' AS kind, k, c_name, n FROM c JOIN o USING (k) UNION ALL SELECT 'left', k, c_name, n FROM c LEFT JOIN o USING (k)
       UNION ALL SELECT 'right', k, c_name, n FROM c RIGHT JOIN o USING (k) UNION ALL SELECT 'full', k, c_name, n FROM c FULL JOIN o USING (k)""",
)
def join_kinds(read):
    c = read("customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("k"), "c_name")
    o = read("orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    return E.funnel(*[E.join(c, o, "k", h).select(F.lit(h).alias("kind"), "k", "c_name", "n") for h in ("inner", "left", "right", "full")])


@query(
    "E11_lookup",
    """SELECT o_orderkey, c_name, c_mktsegment, c_custkey IS NOT NULL AS found FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 10 <> 0) ON o_custkey = c_custkey""",
)
def lookup(read):
    reference = read("customer").filter("c_custkey % 10 <> 0")
    rows = read("orders").select("o_orderkey", "o_custkey")
    return E.lookup(rows, reference, {"o_custkey": "c_custkey"}, ["c_name", "c_mktsegment"], "found").drop("o_custkey")


@query(
    "E12_merge_update",
    f"""{_BOTH_SQL} SELECT s.c_custkey, CASE WHEN t.c_custkey IS NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal, s.c_mktsegment
    FROM s LEFT JOIN t USING (c_custkey)""",
)
def merge_update(read):
    s, t = _both(read)
    return E.merge_update(s, t.select("c_custkey", "c_acctbal"), ["c_custkey"])


@query(
    "E13_modify",
    """SELECT p_partkey AS id, UPPER(p_name) AS p_name, LOWER(p_brand) AS p_brand, CAST(p_size AS VARCHAR) AS p_size, p_name || ' ' || p_brand AS full_name,
         CASE WHEN p_size < 15 THEN 'small' WHEN p_size < 35 THEN 'middle' ELSE 'large' END AS class FROM part""",
)
def modify(read):
    size = F.col("p_size")
    derived = {
        "full_name": F.concat("p_name", F.lit(" "), "p_brand"),
        "class": F.when(size < 15, "small").when(size < 35, "middle").otherwise("large"),
    }
    out = E.modify(read("part"), {"p_partkey": "id"}, ["p_type", "p_retailprice"], {"p_size": "string"}, derived)
    return E.character_map(out, upper=["p_name"], lower=["p_brand"])


@query("E14_peek", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10")
def peek(read):
    return E.peek(read("orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])


@query(
    "E15_pivot_rows",
    """WITH n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
       SELECT o_custkey, MAX(CASE WHEN rn = 1 THEN o_orderkey END) AS o_orderkey_1, MAX(CASE WHEN rn = 1 THEN o_totalprice END) AS o_totalprice_1,
         MAX(CASE WHEN rn = 2 THEN o_orderkey END) AS o_orderkey_2, MAX(CASE WHEN rn = 2 THEN o_totalprice END) AS o_totalprice_2 FROM n GROUP BY 1""",
)
def pivot_rows(read):
    return E.pivot_rows(read("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"], 2)


@query(
    "E16_unpivot",
    """SELECT c_custkey, 'acctbal' AS name, CAST(c_acctbal AS DOUBLE) AS value FROM customer UNION ALL SELECT c_custkey, 'nation', c_nationkey FROM customer""",
)
def unpivot(read):
    c = read("customer").select(
        "c_custkey", F.col("c_acctbal").alias("acctbal"), F.col("c_nationkey").cast("double").alias("nation")
    )
    return E.unpivot(c, ["c_custkey"], ["acctbal", "nation"])


@query(
    "E17_remove_duplicates",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey
       ORDER BY l_quantity, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""",
)
def remove_duplicates(read):
    pick = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return E.remove_duplicates(read("lineitem").select(*pick), ["l_orderkey"], ["l_quantity"])


@query("E17_distinct_keys", "SELECT l_suppkey, 1 AS one FROM lineitem GROUP BY 1")
def distinct_keys(read):
    return E.remove_duplicates(read("lineitem").select("l_suppkey", F.lit(1).alias("one")), ["l_suppkey"])


@query(
    "E18_row_generator",
    """SELECT p_partkey, n, p_name || ' ' || n AS label FROM (SELECT p_partkey, p_name, UNNEST(range(1, p_size % 9 + 1)) AS n FROM part)""",
)
def row_generator(read):
    """As many rows of each part as its size asks for; some ask for none."""
    made = E.generate_rows(read("part").select("p_partkey", "p_name", "p_size"), F.col("p_size") % 9, "n")
    return made.select("p_partkey", "n", F.concat("p_name", F.lit(" "), F.col("n").cast("string")).alias("label"))


@query(
    "E19_surrogate_keys",
    "SELECT o_orderkey, 1000 + ROW_NUMBER() OVER (ORDER BY o_orderkey DESC) AS sk FROM orders",
)
def surrogate_keys(read):
    """Dense keys after a stored maximum, in an order, without one task that sees all rows."""
    return E.surrogate_keys(read("orders").select("o_orderkey"), [desc("o_orderkey")], start=1000)


@query(
    "E20_sort_tail",
    "SELECT * FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 25)",
)
def sort_tail(read):
    return E.tail(read("orders").select("o_orderkey", "o_totalprice"), [asc("o_totalprice"), asc("o_orderkey")], 25)


@query("E21_audit_columns", "SELECT n_nationkey, 'loader' AS audit_user, 'nightly' AS audit_task, true AS stamped FROM nation")
def audit_columns(read):
    out = E.audit_columns(read("nation").select("n_nationkey"), "loader", "nightly")
    return out.select("n_nationkey", "audit_user", "audit_task", F.col("audit_ts").isNotNull().alias("stamped"))


@query(
    "E22_row_count_log",
    "SELECT 'orders' AS step, COUNT(*) AS row_count FROM orders UNION ALL SELECT 'open orders', COUNT(*) FROM orders WHERE o_orderstatus = 'O'",
)
def row_count_log(read):
    o = read("orders")
    return E.funnel(E.row_count(o, "orders"), E.row_count(o.filter("o_orderstatus = 'O'"), "open orders"))


@query(
    "E23_scd_type_1",
    f"""{_BOTH_SQL} SELECT COALESCE(s.c_custkey, t.c_custkey) AS c_custkey, CASE WHEN t.c_custkey IS NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
      CASE WHEN t.c_custkey IS NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment FROM s FULL JOIN t USING (c_custkey)""",
)
def scd_type_1(read):
    s, t = _both(read)
    return E.scd(s, t, ["c_custkey"], ["c_acctbal", "c_mktsegment"], 1)


@query(
    "E23_scd_type_2",
    f"""{_BOTH_SQL}, c AS (
        SELECT c_custkey, c_acctbal, c_mktsegment, '2020-01-01' AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, true AS is_current FROM s
        UNION ALL SELECT c_custkey, CAST(c_acctbal - 1 AS DECIMAL(18,2)), c_mktsegment, '2019-01-01', '2020-01-01', false FROM s WHERE c_custkey % 10 = 0),
      j AS (SELECT c.*, t.c_acctbal AS na, t.c_mktsegment AS nm, t.c_custkey IS NOT NULL AND (c.c_acctbal IS DISTINCT FROM t.c_acctbal OR c.c_mktsegment IS DISTINCT FROM t.c_mktsegment) AS moved
            FROM c LEFT JOIN t ON c.c_custkey = t.c_custkey AND c.is_current)
    SELECT c_custkey, c_acctbal, c_mktsegment, valid_from, CASE WHEN moved THEN '2024-06-01' ELSE valid_to END AS valid_to, is_current AND NOT moved AS is_current FROM j
    UNION ALL SELECT c_custkey, na, nm, '2024-06-01', NULL, true FROM j WHERE moved
    UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment, '2024-06-01', NULL, true FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM s)""",
)
def scd_type_2(read):
    s, t = _both(read)
    day = F.lit("2020-01-01").cast("date")
    live = s.withColumns({"valid_from": day, "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)})
    old = s.filter("c_custkey % 10 = 0").withColumns(
        {
            "c_acctbal": (F.col("c_acctbal") - 1).cast(MONEY),
            "valid_from": F.lit("2019-01-01").cast("date"),
            "valid_to": day,
            "is_current": F.lit(False),
        }
    )
    out = E.scd(
        live.unionByName(old), t, ["c_custkey"], ["c_acctbal", "c_mktsegment"], 2, F.lit("2024-06-01").cast("date")
    )
    return out.withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


@query(
    "E23_scd_type_3",
    f"""{_BOTH_SQL} SELECT COALESCE(s.c_custkey, t.c_custkey) AS c_custkey, CASE WHEN t.c_custkey IS NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
      CASE WHEN s.c_custkey IS NOT NULL AND t.c_custkey IS NOT NULL AND s.c_acctbal IS DISTINCT FROM t.c_acctbal THEN s.c_acctbal END AS previous_c_acctbal FROM s FULL JOIN t USING (c_custkey)""",
)
def scd_type_3(read):
    s, t = _both(read)
    current = s.select("c_custkey", "c_acctbal").withColumn("previous_c_acctbal", F.lit(None).cast(MONEY))
    return E.scd(current, t, ["c_custkey"], ["c_acctbal"], 3)


@query(
    "E24_transformer",
    "SELECT o_orderkey AS id, o_totalprice * 0.9 AS net FROM orders WHERE o_totalprice * 0.9 > 200000",
)
def transformer(read):
    return E.transform(read("orders"), {"id": F.col("o_orderkey"), "net": F.col("o_totalprice") * 0.9}, F.col("net") > 200000)


@query("E25_extract_by_variable", "SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'")
def extract_by_variable(read):
    return rows_after(read("orders"), "o_orderdate", datetime(2000, 1, 1)).select("o_orderkey")


@query(
    "E26_stage_functions",
    """SELECT p_partkey, lower(p_name) AS a, upper(p_name) AS b, trim(p_name) AS c, left(p_name, 3) AS d, right(p_name, 2) AS e, CAST(length(p_name) AS INTEGER) AS f, substring(p_name, 2, 4) AS g,
         CASE WHEN p_size > 20 THEN 'y' ELSE 'n' END AS h, NULLIF(p_size % 3, 0) IS NULL AS i, COALESCE(NULLIF(p_size % 3, 0), -1) AS j FROM part""",
)
def stage_functions(read):
    name, n = F.col("p_name"), F.nullif(F.col("p_size") % 3, F.lit(0))
    return read("part").select(
        "p_partkey",
        F.lower(name).alias("a"),
        F.upper(name).alias("b"),
        F.trim(name).alias("c"),
        F.left(name, F.lit(3)).alias("d"),
        F.right(name, F.lit(2)).alias("e"),
        F.length(name).alias("f"),
        F.substring(name, 2, 4).alias("g"),
        F.when(F.col("p_size") > 20, "y").otherwise("n").alias("h"),
        n.isNull().alias("i"),
        F.nvl(n, F.lit(-1)).alias("j"),
    )


@query(
    "D1_update_from",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN c_custkey IS NOT NULL AND o_orderstatus = 'O' THEN c_mktsegment ELSE o_orderpriority END AS o_orderpriority
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""",
)
def update_from(read):
    updates = read("customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    out = D.update_from(
        read("orders"), updates, ["o_custkey"], {"o_orderpriority": F.col("u_c_mktsegment")}, F.col("o_orderstatus") == "O"
    )
    return out.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("D2_delete_using", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def delete_using(read):
    return D.delete_using(
        read("orders"), read("customer"), {"o_custkey": "c_custkey"}, F.col("c_acctbal") < 0
    ).select("o_orderkey")


@query(
    "D3_filtered_delete_update",
    """SELECT p_partkey, CASE WHEN n > 3 THEN 0 ELSE n END AS n FROM (SELECT p_partkey, NULLIF(p_size % 7, 0) AS n FROM part) WHERE n IS NULL OR n <> 2""",
)
def filtered(read):
    """Rows where the predicate is NULL are neither deleted nor updated."""
    p = read("part").select("p_partkey", F.nullif(F.col("p_size") % 7, F.lit(0)).alias("n"))
    return D.update_where(D.delete_where(p, F.col("n") == 2), F.col("n") > 3, {"n": F.lit(0)})


@query("D4_insert", "SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT CAST(s_suppkey AS INTEGER), s_name, NULL FROM supplier")
def insert(read):
    rows = read("supplier").select(F.col("s_name").alias("n_name"), F.col("s_suppkey").alias("n_nationkey"))
    return D.insert_rows(read("nation"), rows)


@query("D4_insert_overwrite", "SELECT CAST(s_suppkey AS INTEGER) AS n_nationkey, s_name AS n_name, CAST(NULL AS INTEGER) AS n_regionkey FROM supplier")
def insert_overwrite(read):
    rows = read("supplier").select(F.col("s_name").alias("n_name"), F.col("s_suppkey").alias("n_nationkey"))
    return D.insert_rows(read("nation"), rows, overwrite=True)


@query(
    "D5_create_as_select",
    """SELECT c_mktsegment, n_name, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, COUNT(DISTINCT o_orderkey) AS orders
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
)
def create_as_select(read):
    joined = (
        read("orders")
        .join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    out = joined.groupBy("c_mktsegment", "n_name").agg(
        F.sum(F.col("o_totalprice").cast(MONEY)).cast("double").alias("revenue"),
        F.count_distinct("o_orderkey").alias("orders"),
    )
    spark = out.sparkSession
    path = shared_path(spark, "ctas")
    name = f"veritab_ctas_{uuid.uuid4().hex}"
    out.write.option("path", path).saveAsTable(name)
    rows = spark.read.parquet(path)
    spark.sql(f"drop table {name}")
    return rows


@query("D6_identity_column", "SELECT COUNT(*) AS rows, COUNT(*) AS ids, true AS increasing FROM lineitem")
def identity_column(read):
    """Unique and increasing inside each task; gaps are allowed, so no row has to move."""
    out = E.identity_column(read("lineitem").select("l_orderkey"))
    return out.agg(
        F.count("*").alias("rows"), F.count_distinct("id").alias("ids"), (F.min("id") >= 0).alias("increasing")
    )

