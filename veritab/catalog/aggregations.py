"""Aggregates and samples."""

from pyspark.sql import functions as F

from veritab.catalog.data import MONEY, same_sql, sides_sql, source_side, target_side
from veritab.catalog.registry import query
from veritab.config import Sampling, TableConfig
from veritab.functions import aggregates as A
from veritab.functions import collections as C
from veritab.operators import sampling as M
from veritab.operators.aggregates import grouped_values
from veritab.operators.assessment import metric_buckets
from veritab.operators.compare import MISMATCH, compare_data
from veritab.operators.quantiles import Percentile, exact_percentiles, modes
from veritab.operators.ranking import asc, ordered_checksum
from veritab.plans.reconcile import stratum_rows
from veritab.session import materialise

_ALL = ("min", "max", "count", "sum", "avg", "mean", "mode", "stddev", "variance", "median")
_ROUNDED = {"avg": 4, "mean": 4, "stddev": 4, "variance": 2}


def _priced(read):
    return read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", F.col("l_quantity").cast(MONEY).alias("q"),
        F.col("l_extendedprice").cast(MONEY).alias("p"), "l_partkey", "l_suppkey",
    )


def _rounded(df, group):
    cells = []
    for t in _ALL:
        c = F.col(t)
        c = F.round(c.cast("double"), _ROUNDED[t]) if t in _ROUNDED else c.cast("double") if t != "count" else c
        cells.append(c.alias(f"v_{t}"))
    return df.select(*group, *cells)


_SQL_ALL = """CAST(MIN(q) AS DOUBLE) AS v_min, CAST(MAX(q) AS DOUBLE) AS v_max, COUNT(q) AS v_count, CAST(SUM(q) AS DOUBLE) AS v_sum,
  ROUND(AVG(CAST(q AS DOUBLE)), 4) AS v_avg, ROUND(AVG(CAST(q AS DOUBLE)), 4) AS v_mean, ROUND(STDDEV_SAMP(CAST(q AS DOUBLE)), 4) AS v_stddev,
  ROUND(VAR_SAMP(CAST(q AS DOUBLE)), 2) AS v_variance, MEDIAN(CAST(q AS DOUBLE)) AS v_median"""
_LINES = "l AS (SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)) AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS p FROM lineitem)"


@query(
    "A1_reconcile_set",
    f"""WITH {_LINES}, m AS (SELECT l_returnflag, l_linestatus, q, ROW_NUMBER() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY n DESC, q) AS rn
      FROM (SELECT l_returnflag, l_linestatus, q, COUNT(*) AS n FROM l GROUP BY ALL))
    SELECT a.*, CAST(m.q AS DOUBLE) AS v_mode FROM (SELECT l_returnflag, l_linestatus, {_SQL_ALL} FROM l GROUP BY 1, 2) a
    JOIN m USING (l_returnflag, l_linestatus) WHERE m.rn = 1""",
)
def reconcile_set(read):
    """The ten functions per group; median and mode count values first, so no group has to fit a task."""
    group = ["l_returnflag", "l_linestatus"]
    return _rounded(grouped_values(_priced(read), group, [(t, "q", t) for t in _ALL]), group)


@query(
    "A1_reconcile_set_global",
    f"""WITH {_LINES} SELECT {_SQL_ALL}, (SELECT CAST(q AS DOUBLE) FROM l GROUP BY q ORDER BY COUNT(*) DESC, q LIMIT 1) AS v_mode FROM l""",
)
def reconcile_set_global(read):
    return _rounded(grouped_values(_priced(read), [], [(t, "q", t) for t in _ALL]), [])


@query(
    "A2_several_in_one_pass",
    """SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price, COUNT(*) AS n, MAX(l_partkey) AS top_part
       FROM lineitem GROUP BY 1, 2""",
)
def several_in_one_pass(read):
    return _priced(read).groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("q").cast("double").alias("sum_qty"),
        F.sum("p").cast("double").alias("sum_price"),
        F.count("*").alias("n"),
        F.max("l_partkey").alias("top_part"),
    )


@query(
    "A3_distinct",
    f"""WITH {_LINES} SELECT l_returnflag, COUNT(DISTINCT q) AS n, ROUND(AVG(DISTINCT CAST(q AS DOUBLE)), 6) AS mean,
      CAST(SUM(DISTINCT q) AS DOUBLE) AS total, CAST(MAX(DISTINCT q) AS DOUBLE) AS top, ROUND(STDDEV_SAMP(DISTINCT CAST(q AS DOUBLE)), 6) AS dev,
      ROUND(VAR_SAMP(DISTINCT CAST(q AS DOUBLE)), 6) AS var FROM l GROUP BY 1""",
)
def distinct(read):
    d = F.col("q").cast("double")
    lines = _priced(read).withColumn("d", d)
    return lines.groupBy("l_returnflag").agg(
        F.count_distinct("q").alias("n"),
        F.round(F.expr("avg(distinct d)"), 6).alias("mean"),
        F.sum_distinct("q").cast("double").alias("total"),
        F.expr("max(distinct q)").cast("double").alias("top"),
        F.round(F.expr("stddev_samp(distinct d)"), 6).alias("dev"),
        F.round(F.expr("var_samp(distinct d)"), 6).alias("var"),
    )


@query("A4_count_if", "SELECT o_orderstatus, COUNT(*) FILTER (o_totalprice > 200000) AS n FROM orders GROUP BY 1")
def count_if(read):
    return read("orders").groupBy("o_orderstatus").agg(F.count_if(F.col("o_totalprice") > 200000).alias("n"))


@query(
    "A5_booland",
    "SELECT o_custkey, BOOL_AND(o_totalprice > 50000) AS every_large, (SELECT BOOL_AND(o_totalprice > 0) FROM orders) AS all_paid FROM orders GROUP BY 1",
)
def booland(read):
    o = read("orders")
    whole = o.agg(F.bool_and(F.col("o_totalprice") > 0).alias("x")).scalar()
    return o.groupBy("o_custkey").agg(F.every(F.col("o_totalprice") > 50000).alias("every_large")).withColumn("all_paid", whole)


@query("A6_bitor", "SELECT l_returnflag, BIT_OR(l_linenumber) AS bits, BIT_OR(l_orderkey) AS keys FROM lineitem GROUP BY 1")
def bitor(read):
    return read("lineitem").groupBy("l_returnflag").agg(F.bit_or("l_linenumber").alias("bits"), F.bit_or("l_orderkey").alias("keys"))


@query("A7_any_value", "SELECT c_nationkey, MIN(n_name) AS name FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def any_value(read):
    joined = read("customer").join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("c_nationkey").agg(F.any_value("n_name").alias("name"))


@query(
    "A8_listagg",
    """SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), '' ORDER BY CAST(l_linenumber AS VARCHAR)) AS joined,
       string_agg(l_returnflag, ',' ORDER BY l_linenumber, l_returnflag) AS by_line,
       string_agg(DISTINCT l_returnflag, '|' ORDER BY l_returnflag) AS once FROM lineitem GROUP BY 1""",
)
def listagg(read):
    flag = F.col("l_returnflag")
    return read("lineitem").groupBy("l_orderkey").agg(
        A.string_list(F.col("l_linenumber")).alias("joined"),
        A.string_list(flag, ",", F.col("l_linenumber")).alias("by_line"),
        A.string_list(flag, "|", distinct=True).alias("once"),
    )


@query(
    "A9_arrayagg",
    """SELECT l_orderkey, n AS place, v AS part FROM (
         SELECT l_orderkey, UNNEST(list_sort(array_agg(l_partkey))) AS v, UNNEST(range(COUNT(*))) AS n FROM lineitem GROUP BY 1)""",
)
def arrayagg(read):
    """The array of each order; it has no order of its own, so its elements are compared sorted."""
    arrays = read("lineitem").groupBy("l_orderkey").agg(F.array_agg("l_partkey").alias("parts"))
    return arrays.select("l_orderkey", F.posexplode(F.sort_array("parts")).alias("place", "part")).withColumn("place", F.col("place").cast("long"))


@query(
    "A10_arrayagg_sorted",
    """SELECT l_orderkey, array_to_string(list_sort(array_agg(l_partkey)), ',') AS up, array_to_string(list_reverse_sort(array_agg(l_partkey)), ',') AS down
       FROM lineitem GROUP BY 1""",
)
def arrayagg_sorted(read):
    part = F.col("l_partkey")
    return read("lineitem").groupBy("l_orderkey").agg(
        F.array_join(A.sorted_array(part), ",").alias("up"), F.array_join(A.sorted_array(part, descending=True), ",").alias("down")
    )


@query(
    "A11_arrayagg_mixed_order",
    """SELECT l_orderkey, array_to_string(array_agg(l_partkey ORDER BY l_returnflag DESC, l_linenumber ASC, l_partkey DESC), ',') AS parts
       FROM lineitem GROUP BY 1""",
)
def arrayagg_mixed_order(read):
    parts = A.ordered_array(
        F.col("l_partkey"), (F.col("l_returnflag"), True), (F.col("l_linenumber"), False), (F.col("l_partkey"), True)
    )
    return read("lineitem").groupBy("l_orderkey").agg(F.array_join(parts, ",").alias("parts"))


@query("A12_approx_percentile", "SELECT DISTINCT o_orderstatus, true AS mid, true AS quartiles, 3 AS n FROM orders")
def approx_percentile(read):
    """Approximate percentiles lie within the error that was asked for: the share of smaller values says so."""
    o = read("orders").select("o_orderstatus", "o_totalprice")
    found = o.groupBy("o_orderstatus").agg(
        A.approx_percentile(F.col("o_totalprice"), 0.5).alias("m"), A.approx_percentile(F.col("o_totalprice"), [0.25, 0.5, 0.75], 0.05).alias("q")
    )
    joined = o.join(found, "o_orderstatus")

    def near(value, share, error):
        below, upto = F.avg((F.col("o_totalprice") < value).cast("int")), F.avg((F.col("o_totalprice") <= value).cast("int"))
        return (below <= share + error) & (upto >= share - error)

    quartiles = [near(F.col("q")[i], s, 0.05) for i, s in enumerate((0.25, 0.5, 0.75))]
    return joined.groupBy("o_orderstatus").agg(
        near(F.col("m"), 0.5, 0.001).alias("mid"), (quartiles[0] & quartiles[1] & quartiles[2]).alias("quartiles"), F.max(F.size("q")).alias("n")
    )


@query(
    "A12_weighted_percentile",
    """SELECT l_returnflag, QUANTILE_CONT(q, 0.25) AS low, QUANTILE_CONT(q, 0.9) AS high
       FROM (SELECT l_returnflag, UNNEST(list_transform(range(l_linenumber), lambda x: l_quantity)) AS q FROM lineitem) GROUP BY 1""",
)
def weighted_percentile(read):
    """Each row counts as often as its frequency says; exact."""
    return exact_percentiles(
        read("lineitem"), ["l_returnflag"], "l_quantity", {"low": Percentile(0.25), "high": Percentile(0.9)}, "l_linenumber"
    )


@query("A13_approx_top_k", "SELECT DISTINCT o_orderstatus, CAST(3 AS BIGINT) AS items, true AS counted, true AS largest FROM orders")
def approx_top_k(read):
    """With more counters than values the counts are exact, and no value left out is more frequent."""
    o = read("orders").select("o_orderstatus", "o_orderpriority")
    top = o.groupBy("o_orderstatus").agg(F.expr("approx_top_k(o_orderpriority, 3, 100)").alias("top"))
    top = top.select("o_orderstatus", F.explode("top").alias("t")).select(F.col("o_orderstatus").alias("s"), F.col("t.item").alias("item"), F.col("t.count").alias("n"))
    exact = o.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("exact"))
    joined = exact.join(top, (F.col("o_orderstatus") == F.col("s")) & (F.col("o_orderpriority") == F.col("item")), "left")
    least, left_out = F.min("n"), F.max(F.when(F.col("n").isNull(), F.col("exact")))
    return joined.groupBy("o_orderstatus").agg(
        F.count("n").alias("items"), F.every(F.coalesce(F.col("n") == F.col("exact"), F.lit(True))).alias("counted"), F.coalesce(left_out <= least, F.lit(True)).alias("largest")
    )


@query("A14_approx_count_distinct", "SELECT DISTINCT l_returnflag, true AS near FROM lineitem")
def approx_count_distinct(read):
    """Within three times the standard error that was asked for."""
    counts = read("lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("a"), F.count_distinct("l_partkey").alias("n"))
    return counts.select("l_returnflag", (F.abs(F.col("a") - F.col("n")) <= 0.06 * F.col("n")).alias("near"))


@query(
    "A15_percentiles",
    f"""WITH {_LINES}, m AS (SELECT l_returnflag, q, ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY n DESC, q) AS rn
      FROM (SELECT l_returnflag, q, COUNT(*) AS n FROM l GROUP BY ALL))
    SELECT a.*, CAST(m.q AS DOUBLE) AS top FROM (
      SELECT l_returnflag, ROUND(QUANTILE_CONT(CAST(p AS DOUBLE), 0.3), 4) AS cont, CAST(QUANTILE_DISC(p, 0.3) AS DOUBLE) AS disc,
        ROUND(MEDIAN(CAST(p AS DOUBLE)), 4) AS mid FROM l GROUP BY 1) a JOIN m USING (l_returnflag) WHERE rn = 1""",
)
def percentiles(read):
    lines = _priced(read)
    wanted = {"cont": Percentile(0.3), "disc": Percentile(0.3, "disc"), "mid": Percentile(0.5)}
    exact = exact_percentiles(lines, ["l_returnflag"], "p", wanted)
    return exact.join(modes(lines, ["l_returnflag"], "q", "top"), "l_returnflag").select(
        "l_returnflag",
        F.round("cont", 4).alias("cont"),
        F.col("disc").cast("double").alias("disc"),
        F.round("mid", 4).alias("mid"),
        F.col("top").cast("double").alias("top"),
    )


@query(
    "A16_spread",
    f"""WITH {_LINES} SELECT l_returnflag, ROUND(STDDEV_SAMP(q::DOUBLE), 4) AS ss, ROUND(STDDEV_POP(q::DOUBLE), 4) AS sp,
      ROUND(VAR_SAMP(q::DOUBLE), 3) AS vs, ROUND(VAR_POP(q::DOUBLE), 3) AS vp FROM l GROUP BY 1""",
)
def spread(read):
    d = F.col("q").cast("double")
    return _priced(read).groupBy("l_returnflag").agg(
        F.round(F.stddev_samp(d), 4).alias("ss"),
        F.round(F.stddev_pop(d), 4).alias("sp"),
        F.round(F.var_samp(d), 3).alias("vs"),
        F.round(F.var_pop(d), 3).alias("vp"),
    )


@query(
    "A17_regression",
    f"""WITH {_LINES} SELECT l_returnflag, ROUND(CORR(p::DOUBLE, q::DOUBLE), 6) AS c, ROUND(REGR_SLOPE(p::DOUBLE, q::DOUBLE), 3) AS slope,
      ROUND(REGR_INTERCEPT(p::DOUBLE, q::DOUBLE), 3) AS cut, ROUND(REGR_R2(p::DOUBLE, q::DOUBLE), 6) AS r2 FROM l GROUP BY 1""",
)
def regression(read):
    y, x = F.col("p").cast("double"), F.col("q").cast("double")
    return _priced(read).groupBy("l_returnflag").agg(
        F.round(F.corr(y, x), 6).alias("c"),
        F.round(F.regr_slope(y, x), 3).alias("slope"),
        F.round(F.regr_intercept(y, x), 3).alias("cut"),
        F.round(F.regr_r2(y, x), 6).alias("r2"),
    )


@query(
    "A18_cube",
    """SELECT l_returnflag, l_linestatus, GROUPING_ID(l_returnflag, l_linestatus) AS gid, COUNT(*) AS n FROM lineitem
       GROUP BY CUBE (l_returnflag, l_linestatus)""",
)
def cube(read):
    return read("lineitem").cube("l_returnflag", "l_linestatus").agg(F.grouping_id().alias("gid"), F.count("*").alias("n"))


@query(
    "A18_cube_of_groups",
    """SELECT l_returnflag, l_linestatus, l_linenumber, GROUPING_ID(l_returnflag, l_linestatus, l_linenumber) AS gid, COUNT(*) AS n,
              AVG(l_partkey) AS part, MIN(l_shipdate) AS first_day, CAST(SUM(l_suppkey) AS BIGINT) AS suppliers FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus, l_linenumber)""",
)
def cube_of_groups(read):
    wanted = {"n": ("count", "*"), "part": ("avg", "l_partkey"), "first_day": ("min", "l_shipdate"), "suppliers": ("sum", "l_suppkey")}
    return A.cube_of(read("lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"], wanted)


@query(
    "A18_rollup",
    """SELECT l_returnflag, l_linestatus, CAST(GROUPING(l_linestatus) AS INTEGER) AS g, COUNT(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
)
def rollup(read):
    return read("lineitem").rollup("l_returnflag", "l_linestatus").agg(
        F.grouping("l_linestatus").cast("int").alias("g"), F.count("*").alias("n")
    )


@query(
    "A19_checksum",
    """SELECT l_orderkey, md5(array_to_string(list_sort(array_agg(CAST(l_partkey AS VARCHAR))), ',')) AS sum FROM lineitem GROUP BY 1""",
)
def checksum(read):
    return read("lineitem").groupBy("l_orderkey").agg(A.checksum_list(F.col("l_partkey")).alias("sum"))


@query(
    "A19_checksum_large_group",
    """SELECT l_returnflag, md5(CAST(SUM(CAST(('0x' || substr(md5(CAST(l_partkey AS VARCHAR)), 1, 15)) AS UBIGINT)::HUGEINT) AS VARCHAR)) AS sum
       FROM lineitem GROUP BY 1""",
)
def checksum_large_group(read):
    return read("lineitem").groupBy("l_returnflag").agg(A.checksum_agg(F.col("l_partkey")).alias("sum"))


@query(
    "A19_checksum_in_order",
    """SELECT l_returnflag, md5(CAST(SUM(CAST(('0x' || substr(md5(place || ':' || text), 1, 15)) AS UBIGINT)::HUGEINT) AS VARCHAR)) AS checksum
       FROM (SELECT l_returnflag, CASE WHEN l_partkey % 7 = 0 THEN 'n' ELSE '=' || l_partkey END AS text,
                    ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 <> 0 THEN l_partkey END NULLS LAST) AS place
             FROM lineitem) GROUP BY 1""",
)
def checksum_in_order(read):
    part = F.when(F.col("l_partkey") % 7 != 0, F.col("l_partkey"))
    lines = read("lineitem").withColumn("l_partkey", part)
    return ordered_checksum(lines, ["l_returnflag"], [asc("l_shipdate"), asc("l_orderkey"), asc("l_linenumber")], "l_partkey")


@query(
    "A20_first_last",
    """SELECT o_custkey, arg_min(o_totalprice, struct_pack(d := o_orderdate, k := o_orderkey)) AS first, arg_max(o_totalprice, struct_pack(d := o_orderdate, k := o_orderkey)) AS last
       FROM orders GROUP BY 1""",
)
def first_last(read):
    order = F.struct("o_orderdate", "o_orderkey")
    price = F.col("o_totalprice")
    return read("orders").groupBy("o_custkey").agg(A.first_by(price, order).alias("first"), A.last_by(price, order).alias("last"))


@query(
    "A21_array_average",
    """SELECT vec_id, ROUND(list_avg(list_filter(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN CAST(x AS DOUBLE) END), lambda x: x IS NOT NULL)), 9) AS mean FROM embeddings""",
)
def array_average(read):
    positive = F.transform("embedding", lambda x: F.when(x > 0, x))
    return read("embeddings").select("vec_id", F.round(C.array_average(positive), 9).alias("mean"))


@query(
    "A22_metric_buckets",
    """SELECT event_type, strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS bucket_start, ROUND(AVG(CAST(value AS DECIMAL(18,2))::DOUBLE), 6) AS average,
         COUNT(value) AS count, MAX(value) AS maximum, MIN(value) AS minimum, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM events GROUP BY 1, 2""",
)
def buckets(read):
    e = read("events").withColumn("value", F.col("value").cast(MONEY))
    return metric_buckets(e, "15 minutes", ("event_type",), "ts", "value").select(
        "event_type",
        F.date_format("bucket_start", "yyyy-MM-dd HH:mm:ss").alias("bucket_start"),
        F.round(F.col("average").cast("double"), 6).alias("average"),
        "count",
        F.col("maximum").cast("double").alias("maximum"),
        F.col("minimum").cast("double").alias("minimum"),
        F.col("total").cast("double").alias("total"),
    )


@query(
    "A22_metric_buckets_hourly",
    """SELECT event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket_start, COUNT(value) AS count FROM events GROUP BY 1, 2""",
)
def hourly_buckets(read):
    return metric_buckets(read("events"), "1 hour", ("event_type",), "ts", "value").select(
        "event_type", F.date_format("bucket_start", "yyyy-MM-dd HH:mm:ss").alias("bucket_start"), "count"
    )


def _mismatch(read):
    config = TableConfig("orders", "orders", keys=("o_orderkey",))
    s, t = source_side(read, "orders"), target_side(read, "orders")
    return compare_data(s, t, config).filter(F.col("class") == MISMATCH).select("o_orderkey"), t


def _judged(whole, sample, again, key, low, high):
    """One row: are all sampled rows in the table and none twice as often, is the size in bounds, does a rerun agree?"""
    def counts(df, name):
        return df.groupBy(*[F.col(k).alias(f"{name}_{k}") for k in key]).agg(F.count("*").alias(name))

    joined = counts(whole, "of_all")
    for name, df in (("first", sample), ("second", again)):
        same = F.lit(True)
        for k in key:
            same = same & F.col(f"of_all_{k}").eqNullSafe(F.col(f"{name}_{k}"))
        joined = joined.join(counts(df, name), same, "full")
    n = F.coalesce(F.sum("first"), F.lit(0))
    return joined.agg(
        F.every(F.coalesce(F.col("first"), F.lit(0)) <= F.coalesce(F.col("of_all"), F.lit(0))).alias("subset"),
        n.between(F.lit(low) if not callable(low) else low(F.sum("of_all")), F.lit(high) if not callable(high) else high(F.sum("of_all"))).alias("size_in_bounds"),
        F.every(F.col("first").eqNullSafe(F.col("second"))).alias("rerun_agrees"),
    )


_JUDGED = "SELECT true AS subset, true AS size_in_bounds, true AS rerun_agrees"


@query("M1_random_sample", f"{_JUDGED} FROM orders LIMIT 1")
def random_sample(read):
    """At most 100 differing keys; a fixed table and seed give the same ones."""
    wrong, _ = _mismatch(read)
    wrong = materialise(wrong, "wrong")
    n = wrong.count()
    return _judged(wrong, M.sample_random(wrong, 100, n), M.sample_random(wrong, 100, n), ["o_orderkey"], 1, 100)


@query("M2_stratified_sample", f"{_JUDGED}, true AS all_strata FROM orders LIMIT 1")
def stratified_sample(read):
    """Every bucket is present, for a key that is NULL in some rows and has another name in the target."""
    key = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey"))
    wrong, target = _mismatch(read)
    wrong = wrong.select(key.alias("k"), F.col("o_orderkey").alias("second"))
    mapped = target.select(key.alias("k_t"), F.col("o_orderkey").alias("second_t"), "o_orderstatus", "o_orderpriority")
    config = TableConfig(
        "o", "o", keys=("k", "second"), mapping={"k": "k_t", "second": "second_t"}, sampling=Sampling("stratified", 100, ("o_orderstatus", "o_orderpriority"), 4)
    )
    strata = stratum_rows(mapped, config)
    one, two = (materialise(M.sample_stratified(wrong, strata, config.keys, config.sampling), "picked") for _ in range(2))
    buckets = strata.withColumn("bucket", M.stratum(config.sampling.columns, 4))

    def held(keys):
        return buckets.join(keys.select(F.col("second").alias("s2")), F.col("second") == F.col("s2"), "left_semi").select("bucket").distinct()

    missing = held(wrong).join(held(one), "bucket", "left_anti").agg((F.count("*") == 0).alias("all_strata"))
    return _judged(wrong, one, two, ["k", "second"], 1, 100).join(missing)


@query("M3_table_sample", f"{_JUDGED} FROM orders LIMIT 1")
def table_sample(read):
    """A share of a joined result; the same seed over the same rows gives the same sample."""
    joined = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")
    joined = materialise(joined, "joined")
    return _judged(joined, M.sample_share(joined, 8, 99), M.sample_share(joined, 8, 99), ["o_orderkey", "c_name"], lambda n: n * 0.04, lambda n: n * 0.12)


@query("M4_percentage_sample", f"{_JUDGED} FROM lineitem LIMIT 1")
def percentage_sample(read):
    one, two = (M.sample_share(read("lineitem"), 10, 7) for _ in range(2))
    return _judged(read("lineitem"), one, two, ["l_orderkey", "l_linenumber"], lambda n: n * 0.07, lambda n: n * 0.13)


@query(
    "M5_shown_rows",
    f"""WITH {sides_sql('orders')} SELECT s.o_orderkey FROM src s JOIN tgt t USING (o_orderkey) WHERE NOT ({same_sql('orders')}) ORDER BY 1 LIMIT 50""",
)
def shown(read):
    return M.shown_rows(_mismatch(read)[0], ["o_orderkey"])
