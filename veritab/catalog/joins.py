"""Joins on keys where NULL equals NULL, and the joins that reports and samples need."""

from pyspark.sql import functions as F

from veritab.catalog.data import MONEY, hash_sql, same_sql, sides_sql, source_side, target_side
from veritab.catalog.registry import query
from veritab.config import Aggregate, ColumnThreshold, TableConfig
from veritab.operators import compare as X
from veritab.operators.aggregates import aggregate_rules, join_aggregates
from veritab.operators.canonical import HASH_COLUMN, comparable
from veritab.operators.stages import lookup
from veritab.operators.thresholds import threshold_compare

# A key with NULLs, held by many rows, and one customer with a third of all rows.
_HOT_KEY = "CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END"


def hot(df):
    key = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("long")).when(F.col("o_custkey") % 7 != 0, F.col("o_custkey"))
    return df.withColumn("o_custkey", key)


def _hashed(read, report="data", key=("o_orderkey",), prepare=lambda d: d):
    config = TableConfig("orders", "orders", keys=key)
    left, right = prepare(source_side(read, "orders")), prepare(target_side(read, "orders"))
    names = left.columns
    return (
        comparable(left, config, "source", report, names),
        comparable(right, config, "target", report, names),
        config,
    )


@query(
    "J1_full_join_null_safe",
    f"""WITH {sides_sql('orders')},
    hs AS (SELECT * REPLACE ({_HOT_KEY} AS o_custkey) FROM src), ht AS (SELECT * REPLACE ({_HOT_KEY} AS o_custkey) FROM tgt),
    s AS (SELECT o_custkey, COUNT(*) AS n FROM hs GROUP BY 1), t AS (SELECT o_custkey, COUNT(*) AS n FROM ht GROUP BY 1)
    SELECT COALESCE(s.o_custkey, t.o_custkey) AS o_custkey, COALESCE(s.n, 0) AS src_rows, COALESCE(t.n, 0) AS tgt_rows
    FROM s FULL JOIN t ON s.o_custkey IS NOT DISTINCT FROM t.o_custkey""",
)
def full_join_null_safe(read):
    """Key is NULL for many rows and one value for a third of them: the join folds both sides first."""
    left, right, config = _hashed(read, key=("o_custkey",), prepare=hot)
    return X.key_counts(left, right, config.keys)


@query(
    "J2_full_join_on_hash",
    f"""WITH {sides_sql('orders')},
    text AS (
      SELECT CAST(o_custkey AS VARCHAR) AS a, CAST(o_orderkey AS VARCHAR) AS b, COALESCE(TRIM(o_orderpriority), '_null_recon_') AS c,
             o_orderstatus AS d, CAST(o_totalprice AS VARCHAR) AS e, s, t
      FROM (SELECT *, 1 AS s, 0 AS t FROM src UNION ALL BY NAME SELECT *, 0 AS s, 1 AS t FROM tgt))
    SELECT {hash_sql(*"abcde")} AS hash_value_recon, CAST(SUM(s) AS BIGINT) AS src_rows, CAST(SUM(t) AS BIGINT) AS tgt_rows
    FROM text GROUP BY 1""",
)
def full_join_on_hash(read):
    left, right, _ = _hashed(read, "row")
    return X.key_counts(left, right, [HASH_COLUMN])


_GROUPED = TableConfig(
    "orders", "orders", keys=("o_orderkey",), aggregates=(Aggregate("sum", ("o_totalprice",), ("o_orderpriority",)),)
)


@query(
    "J3_full_join_on_groups",
    f"""WITH {sides_sql('orders')},
    s AS (SELECT TRIM(o_orderpriority) AS g, SUM(o_totalprice) AS v FROM src GROUP BY 1),
    t AS (SELECT TRIM(o_orderpriority) AS g, SUM(o_totalprice) AS v FROM tgt GROUP BY 1)
    SELECT s.g AS source_group_by_o_orderpriority, t.g AS target_group_by_o_orderpriority,
           CAST(s.v AS DECIMAL(28,2)) AS source_sum_o_totalprice, CAST(t.v AS DECIMAL(28,2)) AS target_sum_o_totalprice
    FROM s FULL JOIN t ON s.g IS NOT DISTINCT FROM t.g""",
)
def full_join_on_groups(read):
    def trimmed(df):
        return df.withColumn("o_orderpriority", F.trim("o_orderpriority"))

    rules = next(iter(aggregate_rules(list(_GROUPED.aggregates)).values()))
    joined = join_aggregates(
        trimmed(source_side(read, "orders")), trimmed(target_side(read, "orders")), _GROUPED, rules
    )
    return joined.drop("in_source", "in_target")


@query(
    "J4_join_of_single_rows",
    f"""WITH {sides_sql('orders')}
    SELECT (SELECT MIN(o_totalprice) FROM src) AS source_min_o_totalprice, (SELECT MIN(o_totalprice) FROM tgt) AS target_min_o_totalprice""",
)
def join_of_single_rows(read):
    config = TableConfig("o", "o", keys=("o_orderkey",), aggregates=(Aggregate("min", ("o_totalprice",)),))
    rules = aggregate_rules(list(config.aggregates))[()]
    return join_aggregates(source_side(read, "orders"), target_side(read, "orders"), config, rules).drop(
        "in_source", "in_target"
    )


@query(
    "J5_pair_by_key",
    f"""WITH {sides_sql('orders')}
    SELECT s.o_orderkey, s.o_totalprice AS base, t.o_totalprice AS compare FROM src s JOIN tgt t ON s.o_orderkey = t.o_orderkey""",
)
def pair_by_key(read):
    pick = ["o_orderkey", "o_totalprice"]
    paired = X.pair_rows(source_side(read, "orders").select(*pick), target_side(read, "orders").select(*pick), ["o_orderkey"])
    return paired.select(
        "o_orderkey", F.col("s.o_totalprice").alias("base"), F.col("t.o_totalprice").alias("compare")
    )


@query(
    "J6_threshold_join",
    f"""WITH {sides_sql('customer')}
    SELECT s.c_custkey, s.c_acctbal AS source_value, t.c_acctbal AS target_value
    FROM src s JOIN tgt t ON s.c_custkey IS NOT DISTINCT FROM t.c_custkey""",
)
def threshold_join(read):
    config = TableConfig(
        "customer", "customer", keys=("c_custkey",), thresholds=(ColumnThreshold("c_acctbal", "0", "100"),)
    )
    compared = threshold_compare(source_side(read, "customer"), target_side(read, "customer"), config)
    return compared.select(
        "c_custkey", F.col("c_acctbal_source").alias("source_value"), F.col("c_acctbal_target").alias("target_value")
    )


@query(
    "J7_rows_of_sampled_keys",
    f"""WITH {sides_sql('orders')}, k AS (
      SELECT s.o_orderkey FROM src s JOIN tgt t USING (o_orderkey) WHERE NOT ({same_sql('orders')}))
    SELECT t.* FROM tgt t JOIN k USING (o_orderkey)""",
)
def rows_of_sampled_keys(read):
    """Rows of a key set of any size; here all differing keys, far more than a sample has."""
    left, right, config = _hashed(read)
    wrong = X.classify(left, right, config.keys).filter(F.col("class") == X.MISMATCH)
    return X.fetch_by_keys(target_side(read, "orders"), wrong.select("o_orderkey"), config.keys)


@query(
    "J8_mismatch_with_target",
    f"""WITH {sides_sql('orders')}
    SELECT DISTINCT s.o_orderkey, t.o_orderstatus FROM src s JOIN tgt t USING (o_orderkey) WHERE NOT ({same_sql('orders')})""",
)
def mismatch_with_target(read):
    left, right, config = _hashed(read)
    wrong = X.classify(left, right, config.keys).filter(F.col("class") == X.MISMATCH).select("o_orderkey")
    return wrong.join(target_side(read, "orders").select("o_orderkey", "o_orderstatus").distinct(), "o_orderkey")


@query(
    "J9_using_and_comma_join",
    """SELECT n_name, r_name, COUNT(*) AS customers FROM customer, nation, region
       WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey GROUP BY ALL""",
)
def using_and_comma_join(read):
    n = read("nation").withColumnRenamed("n_regionkey", "r_regionkey").join(read("region"), ["r_regionkey"])
    joined = read("customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name", "r_name").agg(F.count("*").alias("customers"))


@query(
    "J10_null_safe_spelled_out",
    f"""WITH {sides_sql('customer')}
    SELECT s.c_custkey, s.c_mktsegment FROM src s JOIN tgt t ON s.c_custkey = t.c_custkey
      AND (s.c_mktsegment = t.c_mktsegment OR (s.c_mktsegment IS NULL AND t.c_mktsegment IS NULL))""",
)
def null_safe_spelled_out(read):
    s, t = source_side(read, "customer").alias("s"), target_side(read, "customer").alias("t")
    on = (F.col("s.c_custkey") == F.col("t.c_custkey")) & F.col("s.c_mktsegment").eqNullSafe(F.col("t.c_mktsegment"))
    return s.join(t, on).select("s.c_custkey", "s.c_mktsegment")


@query(
    "J11_fact_with_dimension",
    """SELECT s_name, n_name, CAST(s_acctbal AS DECIMAL(18,2)) AS s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def fact_with_dimension(read):
    joined = read("supplier").join(read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select("s_name", "n_name", F.col("s_acctbal").cast(MONEY).alias("s_acctbal"))


@query(
    "J12_left_lookup",
    """SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""",
)
def left_lookup(read):
    reference = read("customer").filter("c_acctbal > 0")
    return lookup(read("orders").select("o_orderkey", "o_custkey"), reference, {"o_custkey": "c_custkey"}, ["c_name", "c_mktsegment"]).drop(
        "o_custkey"
    )


@query(
    "J13_pairs_of_a_hot_key",
    f"""WITH {sides_sql('orders')},
    hs AS (SELECT * REPLACE ({_HOT_KEY} AS o_custkey) FROM src), ht AS (SELECT * REPLACE ({_HOT_KEY} AS o_custkey) FROM tgt),
    d AS (SELECT k, p, SUM(s) AS s, SUM(t) AS t FROM (
            SELECT o_custkey AS k, o_totalprice AS p, 1 AS s, 0 AS t FROM hs
            UNION ALL SELECT o_custkey, o_totalprice, 0, 1 FROM ht) GROUP BY 1, 2),
    r AS (SELECT k, SUM(s) AS s, SUM(t) AS t, SUM(LEAST(s, t)) AS equal_rows,
                 COUNT(*) FILTER (s > t) AS left_over_s, COUNT(*) FILTER (t > s) AS left_over_t,
                 COUNT(*) FILTER (s > 0 AND t > 0) AS equal_pairs FROM d GROUP BY 1)
    SELECT k AS o_custkey, CAST(equal_rows AS BIGINT) AS equal_rows,
           CASE WHEN s = 1 AND t = 1 THEN 1 ELSE equal_pairs + GREATEST(left_over_s, left_over_t) END AS pairs
    FROM r WHERE s > 0 AND t > 0""",
)
def pairs_of_a_hot_key(read):
    """Rows of a key that a third of both tables share are paired one to one, never all with all."""

    def side(df):
        return hot(df).select("o_custkey", "o_totalprice")

    paired = X.pair_rows(side(source_side(read, "orders")), side(target_side(read, "orders")), ["o_custkey"])
    same = F.col("s.o_totalprice") == F.col("t.o_totalprice")
    return paired.groupBy("o_custkey").agg(
        F.coalesce(F.sum(F.when(same, F.col("rows"))), F.lit(0)).alias("equal_rows"), F.count("*").alias("pairs")
    )


