"""The reports of a table pair: rows, keys, schema, thresholds, aggregates."""

import functools

from pyspark.sql import functions as F

from veritab.catalog.data import MONEY, same_sql, sides_sql, source_side, target_side
from veritab.catalog.joins import hot
from veritab.catalog.registry import query
from veritab.config import Aggregate, ColumnThreshold, TableConfig, TableThreshold, Transformation
from veritab.operators import compare as X
from veritab.operators import digest_tree
from veritab.operators.aggregates import aggregate_rules, aggregate_side, compare_rule, join_aggregates, rule_counts
from veritab.operators.canonical import HASH_COLUMN, comparable
from veritab.operators.schemas import compare_schema, render_type, table_schema
from veritab.operators.thresholds import threshold_compare, threshold_failures, within_table_threshold
from veritab.plans.reconcile import key_totals

ORDERS = TableConfig("orders", "orders", keys=("o_orderkey",))


def _classes_sql(table, key):
    return f"""WITH {sides_sql(table)}, j AS (
      SELECT CASE WHEN s.{key} IS NULL THEN 'missing_in_src' WHEN t.{key} IS NULL THEN 'missing_in_tgt'
                  WHEN {same_sql(table)} THEN 'match' ELSE 'mismatch' END AS class
      FROM src s FULL JOIN tgt t ON s.{key} IS NOT DISTINCT FROM t.{key})
    SELECT class, CAST(COUNT(*) AS DECIMAL(38,0)) AS rows FROM j GROUP BY 1"""


@query("R1_classify", _classes_sql("orders", "o_orderkey"))
def classify(read):
    return X.class_counts(X.compare_data(source_side(read, "orders"), target_side(read, "orders"), ORDERS))


@query(
    "R1_classify_keys",
    f"""WITH {sides_sql('customer')}
    SELECT COALESCE(s.c_custkey, t.c_custkey) AS c_custkey,
           CASE WHEN s.c_custkey IS NULL THEN 'missing_in_src' WHEN t.c_custkey IS NULL THEN 'missing_in_tgt'
                WHEN {same_sql('customer')} THEN 'match' ELSE 'mismatch' END AS class, CAST(1 AS DECIMAL(38,0)) AS rows
    FROM src s FULL JOIN tgt t ON s.c_custkey IS NOT DISTINCT FROM t.c_custkey""",
)
def classify_keys(read):
    config = TableConfig("customer", "customer", keys=("c_custkey",))
    return X.compare_data(source_side(read, "customer"), target_side(read, "customer"), config)


@query(
    "R1_duplicate_keys",
    """WITH s AS (SELECT l_orderkey AS k, l_linenumber AS l, CAST(l_quantity AS DECIMAL(18,2)) AS q FROM lineitem),
    t AS (SELECT k, l, CASE WHEN k % 53 = 0 THEN q + 1 ELSE q END AS q FROM s WHERE k % 97 <> 0),
    j AS (SELECT CASE WHEN s.k IS NULL THEN 'missing_in_src' WHEN t.k IS NULL THEN 'missing_in_tgt'
                      WHEN s.q = t.q THEN 'match' ELSE 'mismatch' END AS class
          FROM s FULL JOIN t ON s.k = t.k AND s.l = t.l)
    SELECT class, CAST(COUNT(*) AS DECIMAL(38,0)) AS rows FROM j GROUP BY 1""",
)
def duplicate_keys(read):
    """Keys held several times count every pair, as a join would, without making the pairs."""
    s = read("lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast(MONEY).alias("l_quantity"))
    wrong = F.when(F.col("l_orderkey") % 53 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    t = s.filter("l_orderkey % 97 <> 0").withColumn("l_quantity", wrong.cast(MONEY))
    config = TableConfig("l", "l", keys=("l_orderkey", "l_linenumber"))
    return X.class_counts(X.compare_data(s, t, config))


@query(
    "R2_row_report",
    f"""WITH {sides_sql('orders')}, a AS (SELECT *, 1 AS one FROM src), b AS (SELECT *, 1 AS one FROM tgt)
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice, 'missing_in_tgt' AS class,
           CAST(1 AS DECIMAL(38,0)) AS rows
    FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE s.o_orderkey = t.o_orderkey AND {same_sql('orders')})
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), CAST(o_totalprice AS VARCHAR), 'missing_in_src', 1
    FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.o_orderkey = t.o_orderkey AND {same_sql('orders')})""",
)
def row_report(read):
    rows = X.compare_rows(source_side(read, "orders"), target_side(read, "orders"), ORDERS)
    return rows.select("o_orderkey", "o_totalprice", "class", "rows")


@query(
    "R2_row_report_by_tree",
    f"""WITH {sides_sql('orders')}
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice, 'missing_in_tgt' AS class,
           CAST(1 AS DECIMAL(38,0)) AS rows
    FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE s.o_orderkey = t.o_orderkey AND {same_sql('orders')})
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), CAST(o_totalprice AS VARCHAR), 'missing_in_src', 1
    FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.o_orderkey = t.o_orderkey AND {same_sql('orders')})""",
)
def row_report_by_tree(read):
    rows = digest_tree.differing_rows(source_side(read, "orders"), target_side(read, "orders"), ORDERS)
    return rows.select("o_orderkey", "o_totalprice", "class", "rows")


@query(
    "R3_differences_by_tree",
    f"""WITH {sides_sql('orders')}
    SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey,
           CASE WHEN s.o_orderkey IS NULL THEN 'missing_in_src' WHEN t.o_orderkey IS NULL THEN 'missing_in_tgt' ELSE 'mismatch' END AS class,
           CAST(1 AS DECIMAL(38,0)) AS rows
    FROM src s FULL JOIN tgt t ON s.o_orderkey = t.o_orderkey
    WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL OR NOT ({same_sql('orders')})""",
)
def differences_by_tree(read):
    return digest_tree.differing_keys(source_side(read, "orders"), target_side(read, "orders"), ORDERS)


@query(
    "P17_digest_tree",
    """SELECT pair, CAST(src_rows AS DECIMAL(38,0)) AS src_rows, CAST(tgt_rows AS DECIMAL(38,0)) AS tgt_rows FROM (
         SELECT 'one row changed' AS pair, COUNT(*) AS src_rows, COUNT(*) AS tgt_rows FROM orders
         UNION ALL SELECT 'one row twice', COUNT(*), COUNT(*) + 1 FROM orders)""",
)
def digest_tree_roots(read):
    """Roots that differ; the root of a copy in another order does not."""
    orders = read("orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast(MONEY).alias("o_totalprice"))
    first = F.col("o_orderkey") == orders.agg(F.min("o_orderkey")).first()[0]
    copies = {
        "other order": orders.orderBy(F.desc("o_custkey")),
        "one row changed": orders.withColumn("o_custkey", F.when(first, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))),
        "one row twice": orders.unionAll(orders.where(first)),
    }
    out = None
    for name, copy in copies.items():
        left, right = (comparable(d, ORDERS, side, "row", orders.columns) for d, side in ((orders, "source"), (copy, "target")))
        found = digest_tree.differing_nodes(digest_tree.leaf_differences(left, right, [HASH_COLUMN])).where("level = 0")
        found = found.select(F.lit(name).alias("pair"), "src_rows", "tgt_rows")
        out = found if out is None else out.unionAll(found)
    return out


@query(
    "R2_row_report_thresholds",
    """SELECT 'missing_in_src' AS class, CAST(COUNT(*) AS DECIMAL(38,0)) AS rows FROM customer WHERE c_custkey % 47 = 0
       UNION ALL SELECT 'missing_in_tgt', COUNT(*) FROM customer WHERE c_custkey % 47 = 0""",
)
def row_report_thresholds(read):
    """The row report has no threshold step, so threshold columns stay in its hash."""
    money = F.col("c_acctbal").cast(MONEY)
    s = read("customer").withColumn("c_acctbal", money)
    t = read("customer").withColumn("c_acctbal", F.when(F.col("c_custkey") % 47 == 0, money + 1).otherwise(money).cast(MONEY))
    config = TableConfig("c", "c", keys=("c_custkey",), thresholds=(ColumnThreshold("c_acctbal", "0", "100"),))
    return X.class_counts(X.compare_rows(s, t, config))


@query(
    "R3_data_report",
    f"""WITH {sides_sql('part')}, j AS (
      SELECT CASE WHEN s.p_partkey IS NULL THEN 'a' WHEN t.p_partkey IS NULL THEN 'b' WHEN {same_sql('part')} THEN 'c' ELSE 'd' END AS k
      FROM src s FULL JOIN tgt t ON s.p_partkey = t.p_partkey)
    SELECT (SELECT COUNT(*) FROM src) AS source_count, (SELECT COUNT(*) FROM tgt) AS target_count,
           CAST(COUNT(*) FILTER (k = 'c') AS DECIMAL(38,0)) AS "match", CAST(COUNT(*) FILTER (k = 'd') AS DECIMAL(38,0)) AS mismatch,
           COUNT(*) FILTER (k = 'a') AS missing_in_src, COUNT(*) FILTER (k = 'b') AS missing_in_tgt,
           CAST(0 AS BIGINT) AS duplicate_keys, COUNT(*) FILTER (k = 'd') AS mismatched_keys FROM j""",
)
def data_report(read):
    """All counts of the keyed report from one pass over both tables."""
    config = TableConfig("part", "part", keys=("p_partkey",))
    s, t = source_side(read, "part"), target_side(read, "part")
    matched = X.match_keys(
        comparable(s, config, "source", "data", s.columns), comparable(t, config, "target", "data", s.columns), config.keys
    )
    return key_totals(matched)


@query(
    "R3_data_report_hot_key",
    f"""WITH {sides_sql('orders')},
    k AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END AS g, o_totalprice AS p, 1 AS s, 0 AS t FROM src
          UNION ALL SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END, o_totalprice, 0, 1 FROM tgt),
    d AS (SELECT g, p, SUM(s) AS s, SUM(t) AS t FROM k GROUP BY 1, 2),
    e AS (SELECT g, SUM(s) AS s, SUM(t) AS t, SUM(s * t) AS m FROM d GROUP BY 1)
    SELECT 'match' AS class, CAST(SUM(m) AS DECIMAL(38,0)) AS rows FROM e WHERE s > 0 AND t > 0
    UNION ALL SELECT 'mismatch', SUM(s * t - m) FROM e WHERE s > 0 AND t > 0 AND s * t > m
    UNION ALL SELECT 'missing_in_tgt', SUM(s) FROM e WHERE t = 0 HAVING COUNT(*) > 0
    UNION ALL SELECT 'missing_in_src', SUM(t) FROM e WHERE s = 0 HAVING COUNT(*) > 0""",
)
def data_report_hot_key(read):
    config = TableConfig("o", "o", keys=("o_custkey",), select=("o_custkey", "o_totalprice"))
    return X.class_counts(X.compare_data(hot(source_side(read, "orders")), hot(target_side(read, "orders")), config))


@query(
    "R3_null_expressions_and_borders",
    """WITH s AS (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS a, c_name || 'x' AS b, 'y' AS c FROM customer),
    t AS (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS a, c_name || CASE WHEN c_custkey % 5 = 0 THEN 'z' ELSE 'x' END AS b, 'y' AS c
          FROM customer WHERE c_custkey % 7 <> 0
          UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END, c_name, 'xy' FROM customer WHERE c_custkey % 7 = 0)
    SELECT CASE WHEN UPPER(s.a) IS NOT DISTINCT FROM UPPER(t.a) AND s.b = t.b AND s.c = t.c THEN 'match' ELSE 'mismatch' END AS class,
           CAST(COUNT(*) AS DECIMAL(38,0)) AS rows
    FROM s JOIN t USING (c_custkey) GROUP BY 1""",
)
def null_expressions_and_borders(read):
    """A NULL from a user expression does not hide other differences, nor does text that moves to the next column."""
    k = F.col("c_custkey")
    base = read("customer").select(k, F.when(k % 3 != 0, F.col("c_mktsegment")).alias("a"), "c_name")
    s = base.select(k, "a", F.concat("c_name", F.lit("x")).alias("b"), F.lit("y").alias("c"))
    last = F.when(k % 7 == 0, "").when(k % 5 == 0, "z").otherwise("x")
    t = base.select(k, "a", F.concat("c_name", last).alias("b"), F.when(k % 7 == 0, "xy").otherwise("y").alias("c"))
    config = TableConfig("c", "c", keys=("c_custkey",), transformations=(Transformation("a", "upper(a)", "upper(a)"),))
    return X.class_counts(X.compare_data(s, t, config))


@query(
    "R2_null_expressions",
    """SELECT 'missing_in_src' AS class, CAST(COUNT(*) AS DECIMAL(38,0)) AS rows FROM customer WHERE c_custkey % 5 = 0
       UNION ALL SELECT 'missing_in_tgt', COUNT(*) FROM customer WHERE c_custkey % 5 = 0""",
)
def row_report_null_expressions(read):
    k = F.col("c_custkey")
    s = read("customer").select(k, F.when(k % 2 != 0, F.col("c_mktsegment")).alias("a"), F.lit("x").alias("b"))
    t = s.withColumn("b", F.when(k % 5 == 0, "y").otherwise("x"))
    config = TableConfig("c", "c", keys=("c_custkey",), transformations=(Transformation("a", "upper(a)", "upper(a)"),))
    return X.class_counts(X.compare_rows(s, t, config))


@query(
    "R4_all_report",
    f"""WITH {sides_sql('customer')}, j AS (
      SELECT CASE WHEN s.c_custkey IS NULL THEN 'missing_in_src' WHEN t.c_custkey IS NULL THEN 'missing_in_tgt'
                  WHEN {same_sql('customer')} THEN 'match' ELSE 'mismatch' END AS k
      FROM src s FULL JOIN tgt t ON s.c_custkey = t.c_custkey)
    SELECT k AS item, CAST(COUNT(*) AS DECIMAL(38,0)) AS rows FROM j GROUP BY 1
    UNION ALL SELECT 'invalid_columns', 0""",
)
def all_report(read):
    """Schema and data of one pair."""
    config = TableConfig("customer", "customer", keys=("c_custkey",))
    s, t = source_side(read, "customer"), target_side(read, "customer")
    schema = compare_schema(table_schema(s), table_schema(t), config)
    wrong = schema.agg(F.count_if(~F.col("is_valid")).cast("decimal(38,0)").alias("rows"))
    return X.class_counts(X.compare_data(s, t, config)).withColumnRenamed("class", "item").unionByName(
        wrong.select(F.lit("invalid_columns").alias("item"), "rows")
    )


@query(
    "R5_schema_compare",
    """SELECT column_name AS source_column, CASE column_name WHEN 'c_acctbal' THEN 'decimal(18,2)' ELSE t END AS source_datatype,
         CASE column_name WHEN 'c_name' THEN 'c_name_t' ELSE column_name END AS target_column,
         CASE column_name WHEN 'c_mktsegment' THEN 'Unknown' WHEN 'c_nationkey' THEN 'bigint' WHEN 'c_acctbal' THEN 'decimal(18,2)' ELSE t END
           AS target_datatype, column_name NOT IN ('c_mktsegment', 'c_nationkey') AS is_valid
       FROM (SELECT column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' END AS t
             FROM (DESCRIBE SELECT * FROM customer))""",
)
def schema_compare(read):
    s = read("customer").withColumn("c_acctbal", F.col("c_acctbal").cast(MONEY))
    t = s.withColumnRenamed("c_name", "c_name_t").withColumn("c_nationkey", F.col("c_nationkey").cast("long")).drop("c_mktsegment")
    config = TableConfig("c", "c", keys=("c_custkey",), mapping={"c_name": "c_name_t"})
    return compare_schema(table_schema(s), table_schema(t), config)


@query(
    "R5_schema_compare_systems",
    """SELECT p_name || '_' || p_partkey AS source_column, kind AS source_datatype, p_name || '_' || p_partkey AS target_column,
              want AS target_datatype, valid AS is_valid
       FROM part JOIN (VALUES (0, 'NUMBER(10,2)', 'decimal(10,2)', true), (1, 'VARCHAR(20)', 'string', true),
         (2, 'TIMESTAMP_LTZ', 'timestamp', true), (3, 'NUMBER(10)', 'decimal(10,0)', true), (4, 'VARIANT', 'string', false),
         (5, 'FLOAT', 'double', true), (6, 'BOOLEAN', 'int', false), (7, 'INT', 'decimal(38,0)', true)) v(i, kind, want, valid)
         ON p_partkey % 8 = i""",
)
def schema_compare_systems(read):
    """Column metadata of another system, as many columns as the table has parts."""
    kinds = ["NUMBER(10,2)", "VARCHAR(20)", "TIMESTAMP_LTZ", "NUMBER(10)", "VARIANT", "FLOAT", "BOOLEAN", "INT"]
    wants = ["decimal(10,2)", "string", "timestamp", "decimal(10,0)", "string", "double", "int", "decimal(38,0)"]
    name = F.concat_ws("_", "p_name", F.col("p_partkey").cast("string"))
    at = (F.col("p_partkey") % 8).cast("int")

    def meta(texts):
        return read("part").select(name.alias("column_name"), F.get(F.array(*[F.lit(x) for x in texts]), at).alias("data_type"))

    return compare_schema(meta(kinds), meta(wants), TableConfig("p", "p"), "snowflake")


_CAPTURE = f"""WITH {sides_sql('customer')}, w AS (
      SELECT s.c_custkey FROM src s JOIN tgt t USING (c_custkey) WHERE NOT ({same_sql('customer')}))
    SELECT s.c_custkey, s.c_acctbal AS c_acctbal_base, t.c_acctbal AS c_acctbal_compare, s.c_acctbal = t.c_acctbal AS c_acctbal_match,
           s.c_mktsegment AS c_mktsegment_base, TRIM(t.c_mktsegment) AS c_mktsegment_compare,
           s.c_mktsegment = TRIM(t.c_mktsegment) AS c_mktsegment_match
    FROM w JOIN src s USING (c_custkey) JOIN tgt t USING (c_custkey)"""


def _captured(read):
    config = TableConfig("customer", "customer", keys=("c_custkey",))
    s, t = source_side(read, "customer"), target_side(read, "customer")
    wrong = X.compare_data(s, t, config).filter(F.col("class") == X.MISMATCH).select("c_custkey")

    def rows(df):
        picked = df.select("c_custkey", "c_acctbal", F.trim("c_mktsegment").alias("c_mktsegment"))
        return picked.join(wrong, "c_custkey", "left_semi")

    return X.side_by_side(rows(s), rows(t), ["c_custkey"])


@query("R6_side_by_side", _CAPTURE)
def side_by_side(read):
    return _captured(read)


@query(
    "R7_mismatching_columns",
    f"""WITH c AS ({_CAPTURE})
    SELECT 'c_acctbal' AS column_name, BOOL_OR(NOT COALESCE(c_acctbal_match, false)) AS differs, COUNT(*) FILTER (NOT COALESCE(c_acctbal_match, false)) AS rows FROM c
    UNION ALL SELECT 'c_mktsegment', BOOL_OR(NOT COALESCE(c_mktsegment_match, false)), COUNT(*) FILTER (NOT COALESCE(c_mktsegment_match, false)) FROM c""",
)
def mismatching_columns(read):
    return X.mismatching_columns(_captured(read))


@query(
    "R8_missing_rows",
    f"""WITH {sides_sql('orders')}
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
           COALESCE(TRIM(o_orderpriority), '_null_recon_') AS o_orderpriority, o_orderstatus
    FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)""",
)
def missing_rows(read):
    """Full rows, in canonical text, of all keys that the source lacks."""
    s, t = source_side(read, "orders"), target_side(read, "orders")
    missing = X.compare_data(s, t, ORDERS).filter(F.col("class") == X.MISSING_IN_SOURCE).select("o_orderkey")
    return X.fetch_by_keys(X.plain_rows(t, ORDERS, "target", s.columns), missing, ORDERS.keys)


_STATUS = """CASE WHEN COALESCE(s, 0) - COALESCE(t, 0) = 0 THEN 'Match' WHEN {m} BETWEEN {lo} AND {hi} THEN 'Warning' ELSE 'Failed' END"""


def _threshold_sql(table, key, money, status, keep=""):
    return f"""WITH {sides_sql(table)}, j AS (SELECT src.{key}, src.{money} AS s, tgt.{money} AS t FROM src JOIN tgt USING ({key}))
    SELECT {key}, s AS {money}_source, t AS {money}_target, {status} AS {money}_match, CAST(1 AS BIGINT) AS rows FROM j {keep}"""


@query(
    "R9_threshold_absolute",
    _threshold_sql("orders", "o_orderkey", "o_totalprice", _STATUS.format(m="s - t", lo=-5000, hi=0)),
)
def threshold_absolute(read):
    config = TableConfig("o", "o", keys=("o_orderkey",), thresholds=(ColumnThreshold("o_totalprice", "-5000", "0"),))
    return threshold_compare(source_side(read, "orders"), target_side(read, "orders"), config)


@query(
    "R10_threshold_percentage",
    _threshold_sql(
        "customer",
        "c_custkey",
        "c_acctbal",
        _STATUS.format(m="(s - t)::DOUBLE / CASE WHEN t = 0 THEN 1 ELSE t END * 100", lo=-3, hi=0.5),
    ),
)
def threshold_percentage(read):
    """Negative balances turn the bounds around, as the target value keeps its sign."""
    config = TableConfig("c", "c", keys=("c_custkey",), thresholds=(ColumnThreshold("c_acctbal", "-3%", "0.5%"),))
    return threshold_compare(source_side(read, "customer"), target_side(read, "customer"), config)


@query(
    "R11_threshold_time",
    """SELECT event_id, CASE WHEN event_id % 47 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 'Warning' ELSE 'Failed' END ELSE 'Match' END AS ts_match FROM events""",
)
def threshold_time(read):
    shift = F.when(F.col("event_id") % 47 != 0, 0).when(F.col("event_id") % 2 == 0, 60).otherwise(7200)
    s = read("events").select("event_id", "ts")
    t = s.withColumn("ts", F.col("ts") + F.make_dt_interval(secs=shift))
    config = TableConfig("e", "e", keys=("event_id",), thresholds=(ColumnThreshold("ts", "-3600", "3600"),))
    return threshold_compare(s, t, config).select("event_id", "ts_match")


@query(
    "R12_threshold_projection",
    """SELECT l_orderkey % 100 AS bucket, COUNT(*) AS n FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 10) GROUP BY 1""",
)
def threshold_projection(read):
    """Side filter and expressions first, then keys and threshold columns only."""
    folded = read("lineitem").filter("l_quantity > 10").groupBy("l_orderkey").agg(F.sum(F.col("l_tax").cast(MONEY)).alias("l_tax"))
    config = TableConfig("l", "l", keys=("l_orderkey",), thresholds=(ColumnThreshold("l_tax", "0", "1"),), source_filter="l_tax >= 0")
    compared = threshold_compare(folded, folded, config)
    return compared.groupBy((F.col("l_orderkey") % 100).alias("bucket")).agg(F.count("*").alias("n"))


@query(
    "R13_threshold_failures",
    _threshold_sql("orders", "o_orderkey", "o_totalprice", _STATUS.format(m="s - t", lo=-5000, hi=0), "WHERE NOT (s - t BETWEEN -5000 AND 0)"),
)
def threshold_failed(read):
    return threshold_failures(threshold_absolute(read))


@query(
    "R14_table_threshold",
    """SELECT c_nationkey, COUNT(*) FILTER (c_custkey % 53 = 0) AS wrong, COUNT(*) AS total,
         COUNT(*) FILTER (c_custkey % 53 = 0) <= 1 AS absolute_ok,
         COUNT(*) FILTER (c_custkey % 53 = 0) = 0 OR COUNT(*) FILTER (c_custkey % 53 = 0) <= round_even(COUNT(*) * 0.02, 0) AS share_ok,
         COUNT(*) FILTER (c_custkey % 53 = 0) = 0 AS none_ok
       FROM customer GROUP BY 1""",
)
def table_threshold(read):
    wrong, total = F.col("wrong"), F.col("total")
    zero = F.lit(0)
    return (
        read("customer")
        .groupBy("c_nationkey")
        .agg(F.count_if(F.col("c_custkey") % 53 == 0).alias("wrong"), F.count("*").alias("total"))
        .withColumns(
            {
                "absolute_ok": within_table_threshold(wrong, zero, total, [TableThreshold("0", "1")]),
                "share_ok": within_table_threshold(wrong, zero, total, [TableThreshold("0", "5"), TableThreshold("0%", "2%")]),
                "none_ok": within_table_threshold(wrong, zero, total, []),
            }
        )
    )


def _rule_source(read):
    return source_side(read, "orders"), target_side(read, "orders")


@query(
    "R15_aggregate_rules",
    f"""WITH {sides_sql('orders')}
    SELECT o_orderstatus AS source_group_by_o_orderstatus, MIN(o_totalprice) AS source_min_o_totalprice,
      MAX(o_totalprice) AS source_max_o_totalprice, COUNT(o_custkey) AS source_count_o_custkey FROM src GROUP BY 1""",
)
def rules_in_one_pass(read):
    """Requested aggregates with the same groups share one pass; doubles of a rule go."""
    wanted = (
        Aggregate("MIN", ("o_totalprice",), ("o_orderstatus",)),
        Aggregate("max", ("o_totalprice",), ("o_orderstatus",)),
        Aggregate("min", ("o_totalprice",), ("O_ORDERSTATUS",)),
        Aggregate("count", ("o_custkey",), ("o_orderstatus",)),
    )
    sets = aggregate_rules(list(wanted))
    assert len(sets) == 1 and len(sets[("o_orderstatus",)]) == 3
    return aggregate_side(source_side(read, "orders"), TableConfig("o", "o"), "source", sets[("o_orderstatus",)])


def _aggregate_sql(columns):
    return f"""WITH {sides_sql('orders')},
    s AS (SELECT o_custkey AS g, SUM(o_totalprice) AS v, COUNT(*) AS n FROM src GROUP BY 1),
    t AS (SELECT o_custkey AS g, SUM(o_totalprice) AS v, COUNT(*) AS n FROM tgt GROUP BY 1),
    j AS (SELECT s.g AS sg, t.g AS tg, s.v AS sv, t.v AS tv, s.n AS sn, t.n AS tn FROM s FULL JOIN t ON s.g IS NOT DISTINCT FROM t.g)
    {columns}"""


_BY_CUSTOMER = TableConfig(
    "o", "o", aggregates=(Aggregate("sum", ("o_totalprice",), ("o_custkey",)), Aggregate("count", ("o_orderkey",), ("o_custkey",)))
)


@query(
    "R16_aggregate_join",
    _aggregate_sql(
        """SELECT sg AS source_group_by_o_custkey, tg AS target_group_by_o_custkey, CAST(sv AS DECIMAL(28,2)) AS source_sum_o_totalprice,
           CAST(tv AS DECIMAL(28,2)) AS target_sum_o_totalprice, sn AS source_count_o_orderkey, tn AS target_count_o_orderkey FROM j"""
    ),
)
def aggregate_join(read):
    rules = aggregate_rules(list(_BY_CUSTOMER.aggregates))[("o_custkey",)]
    return join_aggregates(*_rule_source(read), _BY_CUSTOMER, rules).drop("in_source", "in_target")


@query(
    "R17_aggregate_compare",
    _aggregate_sql(
        """SELECT sg AS source_group_by_o_custkey, tg AS target_group_by_o_custkey, CAST(sv AS DECIMAL(28,2)) AS source_sum_o_totalprice,
           CAST(tv AS DECIMAL(28,2)) AS target_sum_o_totalprice,
           CASE WHEN sn IS NOT NULL AND tn IS NOT NULL THEN sv IS NOT DISTINCT FROM tv END AS match_sum_o_totalprice,
           CASE WHEN sn IS NOT NULL AND tn IS NOT NULL THEN sv IS NOT DISTINCT FROM tv END AS agg_data_match,
           CASE WHEN sn IS NULL THEN 'missing_in_src' WHEN tn IS NULL THEN 'missing_in_tgt' WHEN sv IS DISTINCT FROM tv THEN 'mismatch' ELSE 'match' END AS class
           FROM j"""
    ),
)
def aggregate_compare(read):
    rules = aggregate_rules(list(_BY_CUSTOMER.aggregates))[("o_custkey",)]
    return compare_rule(join_aggregates(*_rule_source(read), _BY_CUSTOMER, rules), rules[0])


@query(
    "R17_rule_counts",
    _aggregate_sql(
        """SELECT 'sum_o_totalprice_o_custkey' AS rule, COUNT(*) FILTER (sn > 0 AND tn > 0 AND sv IS DISTINCT FROM tv) AS mismatch,
             COUNT(*) FILTER (sn IS NULL) AS missing_in_src, COUNT(*) FILTER (tn IS NULL) AS missing_in_tgt FROM j
           UNION ALL SELECT 'count_o_orderkey_o_custkey', COUNT(*) FILTER (sn > 0 AND tn > 0 AND sn <> tn),
             COUNT(*) FILTER (sn IS NULL), COUNT(*) FILTER (tn IS NULL) FROM j"""
    ),
)
def counts_per_rule(read):
    rules = aggregate_rules(list(_BY_CUSTOMER.aggregates))[("o_custkey",)]
    return rule_counts(join_aggregates(*_rule_source(read), _BY_CUSTOMER, rules), rules)


@query(
    "S5_render_type",
    """SELECT 'o_' || p_partkey AS column_name, CASE p_partkey % 5 WHEN 0 THEN 'number(' || p_size || ',2)' WHEN 1 THEN 'number(' || p_size || ')'
         WHEN 2 THEN 'date' WHEN 3 THEN 'varchar2(' || p_size || ')' ELSE 'clob' END AS oracle,
         CASE p_partkey % 5 WHEN 0 THEN 'number(' || p_size || ',2)' WHEN 1 THEN 'number(' || p_size || ',0)' WHEN 2 THEN 'date'
         WHEN 3 THEN 'varchar2' ELSE 'clob' END AS snowflake,
         CASE p_partkey % 5 WHEN 0 THEN 'number' WHEN 1 THEN 'number' WHEN 2 THEN 'date' WHEN 3 THEN 'varchar2' ELSE 'clob' END AS sqlserver
       FROM part""",
)
def rendered_types(read):
    """Information-schema rows, one per part."""
    i = F.col("p_partkey") % 5
    meta = read("part").select(
        F.concat(F.lit("O_"), F.col("p_partkey").cast("string")).alias("column_name"),
        F.get(F.array(*[F.lit(x) for x in ("NUMBER", "NUMBER", "DATE", "VARCHAR2", "CLOB")]), i.cast("int")).alias("data_type"),
        F.when(i < 2, F.col("p_size")).alias("numeric_precision"),
        F.when(i == 0, 2).when(i == 1, 0).alias("numeric_scale"),
        F.when(i == 3, F.col("p_size")).otherwise(0).alias("char_length"),
    )
    systems = ("oracle", "snowflake", "sqlserver")
    frames = [render_type(meta, s).withColumnRenamed("data_type", s) for s in systems]
    return functools.reduce(lambda a, b: a.join(b, "column_name"), frames)
