"""Projection, canonical forms and hashes."""

from pyspark.sql import functions as F

from veritab.catalog.data import hash_sql, sides_sql, target_side
from veritab.catalog.registry import query
from veritab.config import Aggregate, ColumnThreshold, TableConfig, Transformation, plain_name
from veritab.operators import canonical as C


@query("P1_select_columns", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def select_columns(read):
    config = TableConfig("customer", "customer", keys=("c_custkey",), select=("c_custkey", "c_name", "c_acctbal"))
    return C.select_columns(read("customer"), config)


@query("P2_drop_columns", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def drop_columns(read):
    return C.drop_columns(read("customer"), ("c_acctbal", "c_mktsegment"))


@query("P3_map_columns", "SELECT o_orderkey, o_custkey AS buyer, o_totalprice AS total FROM orders")
def map_columns(read):
    target = read("orders").withColumnsRenamed({"o_orderkey": "id_t", "o_custkey": "buyer_t", "o_totalprice": "total_t"})
    mapped = C.map_columns(target, {"o_orderkey": "id_t", "buyer": "buyer_t", "total": "total_t"})
    return mapped.select("o_orderkey", "buyer", "total")


@query(
    "P4_user_transformation",
    f"""SELECT s_suppkey, {hash_sql("UPPER(REPLACE(s_name, '#', '-'))", "CAST(s_suppkey AS VARCHAR)")} AS hash_value_recon
       FROM supplier""",
)
def user_transformation(read):
    config = TableConfig(
        "supplier",
        "supplier",
        keys=("s_suppkey",),
        select=("s_suppkey", "s_name"),
        transformations=(Transformation("s_name", source="upper(replace(s_name, '#', '-'))"),),
    )
    return C.comparable(read("supplier"), config, "source")


@query("P5_side_filter", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def side_filter(read):
    return C.side_filter(read("orders"), "o_orderstatus = 'F' and o_totalprice > 100000").select("o_orderkey", "o_orderstatus")


@query(
    "P6_canonical_text",
    f"""WITH {sides_sql('orders')}
    SELECT o_orderkey, COALESCE(TRIM(o_orderpriority), '_null_recon_') AS priority_text,
           COALESCE(CAST(o_totalprice AS VARCHAR), '_null_recon_') AS price_text FROM tgt""",
)
def canonical_text(read):
    t = target_side(read, "orders")
    return t.select(
        "o_orderkey",
        C.text_form(F.col("o_orderpriority")).alias("priority_text"),
        C.text_form(F.col("o_totalprice")).alias("price_text"),
    )


@query(
    "P7_canonical_array",
    """SELECT p_partkey, array_to_string(list_sort(CASE WHEN p_size % 5 = 0 THEN CAST([] AS VARCHAR[])
              ELSE string_split(p_name, ' ') END), ',') AS words FROM part""",
)
def canonical_array(read):
    words = F.when(F.col("p_size") % 5 != 0, F.split("p_name", " "))
    return read("part").select("p_partkey", C.array_form(words).alias("words"))


@query(
    "P8_canonical_char",
    "SELECT c_custkey, COALESCE(TRIM(RPAD(c_mktsegment, 20, ' ')), '_null_recon_') AS segment FROM customer",
)
def canonical_char(read):
    padded = F.rpad("c_mktsegment", 20, " ")
    return read("customer").select("c_custkey", C.text_form(padded).alias("segment"))


@query(
    "P9_canonical_time",
    """SELECT event_id,
         COALESCE(strftime(CASE WHEN event_id % 7 <> 0 THEN CAST(ts AS DATE) END, '%m/%d/%Y'), '1900-01-01') AS day_text,
         strftime(ts, '%H:%M:%S') AS time_text,
         COALESCE(strftime(CASE WHEN event_id % 7 <> 0 THEN ts END, '%Y-%m-%d %H:%M:%S'), '1900-01-01 00:00:00') AS ts_text
       FROM events""",
)
def canonical_time(read):
    kept = F.when(F.col("event_id") % 7 != 0, F.col("ts"))
    e = read("events").select("event_id", "ts", kept.cast("date").alias("d"), kept.alias("t"))
    return e.select(
        "event_id",
        C.canonical(F.col("d"), e.schema["d"].dataType, "sqlserver").alias("day_text"),
        C.time_form(F.col("ts"), "time").alias("time_text"),
        C.canonical(F.col("t"), e.schema["t"].dataType, "sqlserver").alias("ts_text"),
    )


@query(
    "P10_rule_per_column",
    """SELECT o_orderkey, LOWER(o_orderstatus) AS o_orderstatus, TRIM(o_orderpriority) AS o_orderpriority,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders""",
)
def rule_per_column(read):
    o = read("orders")
    config = TableConfig("orders", "orders", keys=("o_orderkey",), transformations=(Transformation("o_orderstatus", "lower(o_orderstatus)"),))
    names = ("o_orderstatus", "o_orderpriority", "o_orderdate", "o_custkey")
    return o.select("o_orderkey", *[C.canonical_column(o, config, "source", n, "sqlserver") for n in names])


_HASHED = TableConfig(
    "orders",
    "orders",
    keys=("o_orderkey",),
    select=("o_totalprice", "O_ORDERPRIORITY", "o_custkey", "o_orderstatus"),
    drop=("o_orderstatus",),
    thresholds=(ColumnThreshold("o_totalprice", "0", "100"),),
)


@query(
    "P11_hash_column_set",
    f"""SELECT o_orderkey, {hash_sql("CAST(o_custkey AS VARCHAR)", "CAST(o_orderkey AS VARCHAR)", "TRIM(o_orderpriority)")}
       AS hash_value_recon FROM orders""",
)
def hash_column_set(read):
    return C.comparable(read("orders"), _HASHED, "source")


@query(
    "P12_hash_column_order",
    f"""SELECT o_orderkey, {hash_sql("CAST(o_custkey AS VARCHAR)", "CAST(o_orderkey AS VARCHAR)", "TRIM(o_orderpriority)")}
       AS hash_value_recon FROM orders""",
)
def hash_column_order(read):
    """The target's names sort differently; the source's names give the order."""
    target = read("orders").select(
        F.col("o_orderkey").alias("a_key"), F.col("o_custkey").alias("z_cust"), F.col("o_orderpriority").alias("b_prio")
    )
    config = TableConfig(
        "orders",
        "orders_t",
        keys=("o_orderkey",),
        mapping={"o_orderkey": "a_key", "o_custkey": "z_cust", "o_orderpriority": "b_prio"},
    )
    return C.comparable(target, config, "target")


@query(
    "P13_row_hash",
    f"""WITH {sides_sql('orders')}, text AS (
      SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS a, CAST(o_orderkey AS VARCHAR) AS b, COALESCE(TRIM(o_orderpriority), '_null_recon_') AS c,
             o_orderstatus AS d, CAST(o_totalprice AS VARCHAR) AS e FROM tgt)
    SELECT o_orderkey, {hash_sql(*"abcde")} AS sha, {hash_sql(*"abcde", function="md5")} AS md5 FROM text""",
)
def row_hash(read):
    t = target_side(read, "orders")
    names = TableConfig("o", "o", keys=("o_orderkey",)).hash_columns(t.columns, "data")
    sha = TableConfig("o", "o", keys=("o_orderkey",))
    md5 = TableConfig("o", "o", keys=("o_orderkey",), hash_algorithm="md5")
    return t.select(
        "o_orderkey",
        C.row_hash(t, sha, "target", names).alias("sha"),
        C.row_hash(t, md5, "target", names).alias("md5"),
    )


@query(
    "P14_key_projection",
    f"""SELECT o_orderkey, o_custkey, {hash_sql("CAST(o_orderkey AS VARCHAR)", "o_orderstatus")} AS hash_value_recon FROM orders""",
)
def key_projection(read):
    config = TableConfig("orders", "orders", keys=("o_orderkey",), select=("o_orderstatus",), partition_column="o_custkey")
    return C.comparable(read("orders"), config, "source")


@query(
    "P15_special_names",
    f"""SELECT {hash_sql("TRIM(c_name)", "CAST(c_custkey AS VARCHAR)")} AS hash_value_recon, c_custkey AS "cust `key`" FROM customer""",
)
def special_names(read):
    odd = read("customer").select(F.col("c_custkey").alias("cust `key`"), F.col("c_name").alias("a name"))
    config = TableConfig("c", "c", keys=('"Cust `Key`"',), select=("[A Name]",))
    return C.comparable(odd, config, "source")


@query(
    "P16_normalised_config",
    f"""SELECT c_custkey, {hash_sql("CAST(c_custkey AS VARCHAR)", "TRIM(c_mktsegment)")} AS hash_value_recon FROM customer""",
)
def normalised_config(read):
    """Names in any case and quoting give one configuration."""
    config = TableConfig(
        "CUSTOMER",
        "Customer",
        keys=("`C_CUSTKEY`",),
        select=("[C_MktSegment]",),
        aggregates=(Aggregate("MIN", ('"C_ACCTBAL"',)),),
    )
    assert config.aggregates[0].columns == (plain_name("C_AcctBal"),)
    return C.comparable(read("customer"), config, "source")


@query(
    "P17_row_checksum",
    """SELECT p_partkey, md5(concat_ws('|', p_name, p_brand, CASE WHEN p_size % 10 <> 0 THEN CAST(p_size AS VARCHAR) END)) AS checksum
       FROM part""",
)
def row_checksum(read):
    size = F.when(F.col("p_size") % 10 != 0, F.col("p_size"))
    return read("part").select("p_partkey", C.checksum([F.col("p_name"), F.col("p_brand"), size]).alias("checksum"))


@query(
    "P18_separator_option",
    """SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR) || '|' || TRIM(c_name)) AS hash_value_recon FROM customer""",
)
def separator_option(read):
    """The layout of other systems: texts joined by a separator."""
    config = TableConfig("c", "c", keys=("c_custkey",), select=("c_name",), separator="|")
    return C.comparable(read("customer"), config, "source")


