"""Window functions, sorting, set operations and query shapes."""

from pyspark.sql import functions as F

from veritab.catalog.data import MONEY
from veritab.catalog.registry import query
from veritab.functions.relational import select_with_aliases, with_parameters
from veritab.operators import running
from veritab.operators.ranking import Edge, Rank, Shift, asc, desc, spread_window, with_group_values
from veritab.operators.running import Running



_BY_DATE = [asc("o_orderdate"), asc("o_orderkey")]


def _numbered(df, partition, columns):
    return spread_window(df, partition, _BY_DATE, columns)


def _ranked(read, columns, partition=("o_custkey",), order=None, df=None):
    df = read("orders") if df is None else df
    out = spread_window(df, partition, order or _BY_DATE, columns)
    return out.select("o_orderkey", *columns)


_OVER = "OVER (PARTITION BY {p} ORDER BY o_orderdate, o_orderkey)"


@query(
    "W1_row_number",
    f"""SELECT o_orderkey, ROW_NUMBER() {_OVER.format(p='o_custkey')} AS rn, ROW_NUMBER() {_OVER.format(p='o_orderstatus')} AS big FROM orders""",
)
def row_number(read):
    """Numbers in small groups, and in groups that hold a third of all rows."""
    first = _numbered(read("orders"), ["o_custkey"], {"rn": Rank("row_number")})
    return _numbered(first, ["o_orderstatus"], {"big": Rank("row_number")}).select("o_orderkey", "rn", "big")


@query(
    "W2_rank",
    """SELECT o_orderkey, RANK() OVER w AS r, DENSE_RANK() OVER w AS d FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate)""",
)
def rank(read):
    return _ranked(read, {"r": Rank("rank"), "d": Rank("dense_rank")}, ["o_orderpriority"], [asc("o_orderdate")])


@query(
    "W3_percent_rank",
    """SELECT o_orderkey, ROUND(PERCENT_RANK() OVER w, 9) AS p, ROUND(CUME_DIST() OVER w, 9) AS c FROM orders
       WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderdate)""",
)
def percent_rank(read):
    out = _ranked(read, {"p": Rank("percent_rank"), "c": Rank("cume_dist")}, ["o_orderstatus"], [asc("o_orderdate")])
    return out.select("o_orderkey", F.round("p", 9).alias("p"), F.round("c", 9).alias("c"))


@query("W4_ntile", f"SELECT o_orderkey, NTILE(4) {_OVER.format(p='o_custkey')} AS small, NTILE(100) {_OVER.format(p='o_orderstatus')} AS big FROM orders")
def ntile(read):
    first = _numbered(read("orders"), ["o_custkey"], {"small": Rank("ntile", 4)})
    return _numbered(first, ["o_orderstatus"], {"big": Rank("ntile", 100)}).select("o_orderkey", "small", "big")


_SPARSE = "CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END"


@query(
    "W5_lag_lead",
    f"""SELECT o_orderkey, LAG(o_totalprice) OVER w AS before, LAG(o_totalprice, 3, -1.0) OVER w AS three, LEAD(o_totalprice, 2) OVER w AS after,
         LAG({_SPARSE} IGNORE NULLS) OVER w AS known, LEAD({_SPARSE} IGNORE NULLS) OVER w AS next_known
       FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey)""",
)
def lag_lead(read):
    o = read("orders").withColumn("sparse", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")))
    columns = {
        "before": Shift("o_totalprice"),
        "three": Shift("o_totalprice", 3, -1.0),
        "after": Shift("o_totalprice", 2, lead=True),
        "known": Shift("sparse", ignore_nulls=True),
        "next_known": Shift("sparse", lead=True, ignore_nulls=True),
    }
    return _ranked(read, columns, ["o_orderstatus"], df=o)


@query(
    "W6_first_last_value",
    f"""SELECT o_orderkey, FIRST_VALUE(o_totalprice) OVER w AS first, LAST_VALUE(o_totalprice) OVER w AS last,
         FIRST_VALUE({_SPARSE} IGNORE NULLS) OVER w AS first_known, LAST_VALUE({_SPARSE} IGNORE NULLS) OVER w AS last_known
       FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def first_last_value(read):
    o = read("orders").withColumn("sparse", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")))
    columns = {
        "first": Edge("o_totalprice"),
        "last": Edge("o_totalprice", "last"),
        "first_known": Edge("sparse", ignore_nulls=True),
        "last_known": Edge("sparse", "last", ignore_nulls=True),
    }
    return _ranked(read, columns, ["o_orderpriority"], df=o)


@query(
    "W7_nth_value",
    """SELECT o_orderkey, NTH_VALUE(o_totalprice, 3) OVER w AS third FROM orders
       WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def nth_value(read):
    return _ranked(read, {"third": Edge("o_totalprice", "nth", 3)})


@query(
    "W8_full_frame",
    """SELECT o_orderkey, LAST_VALUE(o_orderstatus) OVER w AS last_status, NTH_VALUE(o_orderkey, 2) OVER w AS second_key FROM orders
       WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def full_frame(read):
    """A value function without a frame looks at the whole group, as in the systems tables come from."""
    return _ranked(read, {"last_status": Edge("o_orderstatus", "last"), "second_key": Edge("o_orderkey", "nth", 2)}, ["o_orderpriority"])


@query(
    "W8_running_rows",
    """SELECT l_orderkey, l_linenumber, SUM(l_quantity) OVER w AS quantity, MIN(l_extendedprice) OVER w AS least, COUNT(*) OVER w AS n,
              CAST(SUM(l_linenumber) OVER (PARTITION BY l_returnflag ORDER BY l_shipdate) AS BIGINT) AS lines_upto_day
       FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING)""",
)
def running_rows(read):
    """Growing frames over three groups that hold all rows: by rows, and with rows of the same day."""
    lines = read("lineitem").withColumn("l_quantity", F.col("l_quantity").cast("decimal(18,2)"))
    order = [asc(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    by_rows = running.growing(
        lines, ["l_returnflag"], order, {"quantity": Running("l_quantity", "sum"), "least": Running("l_extendedprice", "min"), "n": Running("l_orderkey", "count")}
    )
    out = running.growing(by_rows, ["l_returnflag"], [asc("l_shipdate")], {"lines_upto_day": Running("l_linenumber", "sum")}, peers=True)
    return out.select("l_orderkey", "l_linenumber", F.col("quantity").cast("double").alias("quantity"), "least", "n", "lines_upto_day")


@query(
    "W8_frame_of_rows",
    """SELECT o_orderkey, MAX(o_totalprice) OVER w AS most, AVG(o_custkey) OVER w AS customer FROM orders
       WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 30 PRECEDING AND 5 FOLLOWING)""",
)
def frame_of_rows(read):
    out = running.sliding(
        read("orders"), ["o_orderstatus"], [asc("o_orderdate"), asc("o_orderkey")], {"most": Running("o_totalprice", "max"), "customer": Running("o_custkey", "avg")}, 30, 5
    )
    return out.select("o_orderkey", "most", "customer")


@query(
    "W8_frame_of_values",
    """SELECT o_orderkey, MAX(o_totalprice) OVER w AS most, CAST(SUM(o_custkey) OVER w AS BIGINT) AS customers, COUNT(o_custkey) OVER w AS n FROM orders
       WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_custkey RANGE BETWEEN 100 PRECEDING AND 50 FOLLOWING)""",
)
def frame_of_values(read):
    out = running.by_value(
        read("orders"), ["o_orderstatus"], "o_custkey", {"most": Running("o_totalprice", "max"), "customers": Running("o_custkey", "sum"), "n": Running("o_custkey", "count")}, 100, 50
    )
    return out.select("o_orderkey", "most", "customers", "n")


@query(
    "W9_null_order",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, k, ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY k ASC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS up,
         ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY k DESC NULLS FIRST, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS down
       FROM (SELECT *, NULLIF(l_suppkey % 7, 0) AS k FROM lineitem)""",
)
def null_order(read):
    """NULL is the largest value: last when ascending, first when descending. Few values of the first sort column."""
    lines = read("lineitem").withColumn("k", F.nullif(F.col("l_suppkey") % 7, F.lit(0)))
    rest = [asc(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    up = spread_window(lines, ["l_returnflag"], [asc("k"), *rest], {"up": Rank("row_number")})
    both = spread_window(up, ["l_returnflag"], [desc("k"), *rest], {"down": Rank("row_number")})
    return both.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "k", "up", "down")


@query(
    "W10_number_in_exploded_groups",
    """SELECT event_type, event_id, key, value, rn FROM (
         SELECT event_type, event_id, 'k' AS key, json_extract_string(props, '$.k') AS value,
                ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events)""",
)
def number_in_exploded_groups(read):
    """The number follows the content; the groups of exploded details may be of any size."""
    e = read("events").select("event_type", "event_id", F.from_json("props", "map<string,string>").alias("m"))
    numbered = spread_window(e, ["event_type"], [asc("event_id")], {"rn": Rank("row_number")})
    return numbered.select("event_type", "event_id", "rn", F.explode("m").alias("key", "value"))


@query(
    "W11_lateral_alias",
    """WITH a AS (SELECT o_orderkey, o_custkey, o_totalprice * 2 AS twice FROM orders),
       b AS (SELECT *, twice + 1 AS more FROM a)
       SELECT o_orderkey, twice, more, SUM(CAST(more AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey)::DOUBLE AS total FROM b WHERE twice > 100000""",
)
def lateral_alias(read):
    """Aliases used in later columns, a filter and a window; the total is grouped first and joined back."""
    filtered = select_with_aliases(
        read("orders"),
        {
            "o_orderkey": F.col("o_orderkey"),
            "o_custkey": F.col("o_custkey"),
            "twice": F.col("o_totalprice") * 2,
            "more": F.col("twice") + 1,
        },
        where=F.col("twice") > 100000,
    )
    total = F.sum(F.col("more").cast(MONEY)).cast("double")
    return with_group_values(filtered, ["o_custkey"], {"total": total}).select("o_orderkey", "twice", "more", "total")


@query(
    "W11_lateral_alias_window",
    """SELECT o_orderkey, o_orderdate_month, SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey, o_orderdate_month)::DOUBLE AS month_total
       FROM (SELECT *, year(o_orderdate) * 12 + month(o_orderdate) AS o_orderdate_month FROM orders)""",
)
def lateral_alias_window(read):
    named = select_with_aliases(
        read("orders"),
        {
            "o_orderkey": F.col("o_orderkey"),
            "o_custkey": F.col("o_custkey"),
            "price": F.col("o_totalprice").cast(MONEY),
            "o_orderdate_month": F.year("o_orderdate").cast("long") * 12 + F.month("o_orderdate"),
        },
    )
    total = F.sum("price").cast("double")
    out = with_group_values(named, ["o_custkey", "o_orderdate_month"], {"month_total": total})
    return out.select("o_orderkey", "o_orderdate_month", "month_total")


@query("L1_order_by", "SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, -o_totalprice FROM orders ORDER BY 2 DESC, 1")
def order_by(read):
    o = read("orders").select("o_orderkey", "o_totalprice")
    both = o.unionAll(o.withColumn("o_totalprice", -F.col("o_totalprice")))
    return both.orderBy(desc("o_totalprice").sort(), asc("o_orderkey").sort())


@query("L2_limit_offset", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 10")
def limit_offset(read):
    return read("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(10).limit(20)


_NATIONS = "SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 0", "SELECT s_nationkey FROM supplier"


@query("L3_union", f"({_NATIONS[0]}) UNION ({_NATIONS[1]})")
def union(read):
    a, b = _two(read)
    return a.union(b).distinct()


@query("L3_union_all", f"SELECT k, COUNT(*) AS n FROM (({_NATIONS[0]}) UNION ALL ({_NATIONS[1]})) GROUP BY 1")
def union_all(read):
    a, b = _two(read)
    return a.unionAll(b).groupBy("k").agg(F.count("*").alias("n"))


def _two(read):
    a = read("customer").filter("c_acctbal > 0").select(F.col("c_nationkey").alias("k"))
    return a, read("supplier").select(F.col("s_nationkey").alias("k"))


@query("L4_except", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def except_(read):
    return read("customer").select("c_custkey").subtract(read("orders").filter("o_orderstatus = 'F'").select("o_custkey"))


@query("L5_intersect", "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def intersect(read):
    o = read("orders")
    return o.filter("o_orderstatus = 'F'").select("o_custkey").intersect(o.filter("o_orderstatus = 'P'").select("o_custkey"))


@query(
    "L6_precedence",
    """SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
       INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' UNION SELECT s_suppkey FROM supplier""",
)
def precedence(read):
    """INTERSECT first, the others from left to right."""
    o = read("orders")
    inner = o.filter("o_orderstatus = 'F'").select("o_custkey").intersect(o.filter("o_orderstatus = 'O'").select("o_custkey"))
    rest = read("customer").select(F.col("c_custkey").alias("k")).subtract(inner)
    return rest.union(read("supplier").select("s_suppkey")).distinct()


@query(
    "L7_common_tables",
    """WITH spent(custkey, total) AS (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders GROUP BY 1),
       both_sides AS (SELECT custkey FROM spent WHERE total > 1000000 UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0)
       SELECT c_custkey, CAST(total AS DOUBLE) AS total FROM both_sides JOIN customer ON c_custkey = custkey LEFT JOIN spent USING (custkey)""",
)
def common_tables(read):
    spent = read("orders").groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("total")).toDF("custkey", "total")
    either = spent.filter("total > 1000000").select("custkey").union(
        read("customer").filter("c_acctbal < 0").select("c_custkey")
    ).distinct()
    joined = either.join(read("customer"), F.col("custkey") == F.col("c_custkey")).join(spent, "custkey", "left")
    return joined.select("c_custkey", F.col("total").cast("double").alias("total"))


@query(
    "L8_sub_queries",
    """SELECT o_orderkey, o_totalprice FROM (SELECT * FROM orders WHERE o_orderstatus <> 'P') WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
       AND o_totalprice > (SELECT AVG(CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE) FROM orders)""",
)
def sub_queries(read):
    o = read("orders")
    mean = o.agg(F.avg("o_totalprice")).scalar()
    chosen = read("customer").filter("c_mktsegment = 'MACHINERY'").select("c_custkey")
    kept = o.filter("o_orderstatus <> 'P'").filter(F.col("o_totalprice") > mean)
    return kept.join(chosen, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_totalprice")


@query("L9_parameters", "SELECT c_custkey, 'x' AS tag FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 1000")
def parameters(read):
    c = read("customer")
    text = "select c_custkey, :tag as tag from {t} where c_mktsegment = :segment and c_acctbal > :least"
    return with_parameters(c.sparkSession, text, t=c, tag="x", segment="BUILDING", least=1000)
