"""Script corpora: one script per part, written from its row."""

from pyspark.sql import functions as F

from veritab.catalog.registry import query
from veritab.operators import lineage as G
from veritab.session import spread


def _key():
    return F.col("p_partkey").cast("string")


def _size():
    return F.col("p_size").cast("string")



def _parts(read):
    """Parts are a small file, and each makes a script."""
    return spread(read("part").select("p_partkey", "p_size"))


def scripts(read):
    """Script k creates t_k out of t_(k/2) and raw tables, then fills a log from it.

    There are texts between dollar tags and with escapes, nested comments, lists of tables, table functions, FROM inside functions and comparisons, a common table expression that
    has the name of the table it reads, and quoted names.
    """
    up = F.floor(F.col("p_partkey") / 2).cast("string")
    parts = [
        F.lit("-- build; from nowhere\nCREATE TABLE stage.T_"), _key(),
        F.lit(" AS WITH recent AS (SELECT extract(year from load_date) AS y, trim(both ' ' from s.a) FROM raw.Src_"), _size(),
        F.lit(" s, generate_series(1, 2) g, \"Odd;Names\" o WHERE s.a IS NOT DISTINCT FROM o.a),\nshadow AS (SELECT * FROM raw.shadow WHERE k IN (SELECT k FROM (SELECT k FROM `deep`) d))"),
        F.lit("\nSELECT r.*, 'from x; join y' AS note, $q$ from dollar; $q$ AS d, e'it\\'s; from zz' AS e /* a /* ; from nested */ b; */ FROM recent r, shadow JOIN unnest(r.a) u ON true"),
        F.when(F.col("p_partkey") > 0, F.concat(F.lit(" LEFT JOIN \"stage\".\"T_"), up, F.lit("\" p ON p.id = r.id"))).otherwise(F.lit("")),
        F.lit(";\n/* join comment_table */ insert into log_"), _size(), F.lit(" select id from stage.t_"), _key(),
    ]
    return _parts(read).select(F.concat(F.lit("part_"), _key(), F.lit(".sql")).alias("path"), F.concat(*parts).alias("sql"))


_EDGES = """e AS (SELECT 'src_' || p_size AS parent, 't_' || p_partkey AS child FROM part
  UNION SELECT UNNEST(['odd;names', 'shadow', 'deep']), 't_' || p_partkey FROM part
  UNION SELECT 't_' || (p_partkey // 2), 't_' || p_partkey FROM part WHERE p_partkey > 0
  UNION SELECT 't_' || p_partkey, 'log_' || p_size FROM part)"""


def edges(read):
    return G.table_edges(scripts(read))


def object_scripts(read):
    """Three objects per script; the view's name is shared by all parts of a size."""
    text = F.concat(
        F.lit("create or replace view V_"), _size(), F.lit(" as select 1;\n-- create table hidden\nCREATE PROCEDURE dbo.P_"), _key(),
        F.lit(" AS BEGIN SELECT 'create table quoted' END;\ncreate table if not exists T_"), _key(), F.lit(" (id int)"),
    )
    return _parts(read).select(F.concat(F.lit("part_"), _key()).alias("path"), text.alias("sql"))


@query(
    "G1_split_objects",
    """SELECT 'part_' || p_partkey AS path, 'VIEW' AS object_type, 'v_' || p_size AS object_name FROM part
       UNION ALL SELECT 'part_' || p_partkey, 'PROCEDURE', 'dbo.p_' || p_partkey FROM part UNION ALL SELECT 'part_' || p_partkey, 'TABLE', 't_' || p_partkey FROM part""",
)
def split_objects(read):
    return G.split_objects(object_scripts(read)).select("path", "object_type", "object_name")


@query(
    "G1_duplicate_objects",
    "SELECT 'VIEW' AS object_type, 'v_' || p_size AS object_name, COUNT(*) AS copies FROM part GROUP BY p_size HAVING COUNT(*) > 1",
)
def duplicate_objects(read):
    return G.duplicate_objects(G.split_objects(object_scripts(read)))


@query(
    "G2_split_statements",
    """SELECT 'part_' || p_partkey || '.sql' AS path, 'insert into log_' || p_size || ' select id from stage.t_' || p_partkey AS statement, 1 AS position FROM part
       UNION ALL SELECT 'part_' || p_partkey || '.sql', 'CREATE TABLE stage.T_' || p_partkey ||
         ' AS WITH recent AS (SELECT extract(year from load_date) AS y, trim(both '' '' from s.a) FROM raw.Src_' || p_size ||
         ' s, generate_series(1, 2) g, "Odd;Names" o WHERE s.a IS NOT DISTINCT FROM o.a), shadow AS (SELECT * FROM raw.shadow WHERE k IN (SELECT k FROM (SELECT k FROM `deep`) d))' ||
         ' SELECT r.*, ''from x; join y'' AS note, $q$ from dollar; $q$ AS d, e''it\\''s; from zz'' AS e FROM recent r, shadow JOIN unnest(r.a) u ON true' || CASE WHEN p_partkey > 0 THEN ' LEFT JOIN "stage"."T_' || (p_partkey // 2) || '" p ON p.id = r.id' ELSE '' END, 0 FROM part""",
)
def split_statements(read):
    return G.split_statements(scripts(read))


@query("G3_table_edges", f"WITH {_EDGES} SELECT * FROM e")
def table_edges(read):
    return edges(read)


@query(
    "G4_neighbours",
    f"WITH {_EDGES} SELECT 'parent' AS kind, parent AS name FROM e WHERE child = 't_7' UNION ALL SELECT 'child', child FROM e WHERE parent = 't_7'",
)
def neighbours(read):
    e = edges(read)
    up = G.parents(e, "T_7").select(F.lit("parent").alias("kind"), F.col("parent").alias("name"))
    return up.unionByName(G.children(e, "T_7").select(F.lit("child").alias("kind"), F.col("child").alias("name")))


@query("G5_root_tables", f"WITH {_EDGES} SELECT DISTINCT parent AS node FROM e WHERE parent NOT IN (SELECT child FROM e)")
def root_tables(read):
    return G.root_tables(edges(read))


def _level_sql(n):
    steps = "".join(f", l{i} AS (SELECT DISTINCT child AS node FROM e JOIN l{i - 1} ON parent = node)" for i in range(1, n + 1))
    return f"WITH {_EDGES}, l0 AS (SELECT DISTINCT parent AS node FROM e WHERE parent NOT IN (SELECT child FROM e)){steps} SELECT node FROM l{n}"


@query("G6_tables_at_level", _level_sql(2))
def tables_at_level(read):
    return G.tables_at_level(edges(read), 2)


@query("G6_tables_at_deep_level", _level_sql(6))
def tables_at_deep_level(read):
    return G.tables_at_level(edges(read), 6)


_KNOTS_SQL = """k AS (SELECT * FROM e UNION SELECT 'c' || p_partkey, 'c' || (p_partkey + 1) FROM part WHERE p_partkey < 200
  UNION SELECT 'c5', 'r0' FROM part UNION SELECT 'r' || p_partkey % 3, 'r' || (p_partkey + 1) % 3 FROM part
  UNION SELECT 'z' || p_partkey % 2, 'z' || (p_partkey + 1) % 2 FROM part)"""


def knotted(read):
    """The lineage of the scripts, a chain of 200 tables, a cycle that hangs on it, and a cycle that nothing leads to."""
    n = F.col("p_partkey")
    name = lambda letter, c: F.concat(F.lit(letter), c.cast("string"))
    part = read("part")
    more = [
        part.where(n < 200).select(name("c", n).alias("parent"), name("c", n + 1).alias("child")),
        part.select(F.lit("c5").alias("parent"), F.lit("r0").alias("child")),
        part.select(name("r", n % 3).alias("parent"), name("r", (n + 1) % 3).alias("child")),
        part.select(name("z", n % 2).alias("parent"), name("z", (n + 1) % 2).alias("child")),
    ]
    out = edges(read)
    for m in more:
        out = out.unionByName(m)
    return out.distinct()


@query(
    "G6_levels_of_all_tables",
    f"""WITH RECURSIVE {_EDGES}, {_KNOTS_SQL},
    w(node, level) AS (SELECT DISTINCT parent, 0 FROM k WHERE parent NOT IN (SELECT child FROM k)
                       UNION SELECT k.child, level + 1 FROM w JOIN k ON k.parent = w.node WHERE level < 230),
    least AS (SELECT node, MIN(level) AS level FROM w GROUP BY node)
    SELECT node, CAST(level AS BIGINT) AS level, node IN ('r0', 'r1', 'r2', 'z0', 'z1') AS on_cycle
    FROM (SELECT parent AS node FROM k UNION SELECT child FROM k) LEFT JOIN least USING (node)""",
)
def levels_of_all_tables(read):
    return G.node_levels(knotted(read))


@query(
    "G7_flow_chart",
    f"""WITH {_EDGES} SELECT '    ' || upper(child[1]) || child[2:] || ' --> ' || upper(parent[1]) || parent[2:] AS line FROM e
       UNION ALL SELECT DISTINCT '    ' || upper(parent[1]) || parent[2:] FROM e WHERE parent NOT IN (SELECT child FROM e)""",
)
def flow_chart(read):
    return G.flow_chart(edges(read))


@query(
    "G8_coverage_report",
    """SELECT o_orderpriority AS project, o_orderstatus AS source_dialect, COUNT(*) AS total, COUNT(*) FILTER (o_orderkey % 10 <> 0) AS parsed, COUNT(*) FILTER (o_orderkey % 4 <> 0) AS transpiled,
         ROUND(COUNT(*) FILTER (o_orderkey % 10 <> 0) / COUNT(*), 9) AS parse_ratio, ROUND(COUNT(*) FILTER (o_orderkey % 4 <> 0) / COUNT(*), 9) AS transpile_ratio FROM orders GROUP BY 1, 2""",
)
def coverage_report(read):
    entries = read("orders").select(
        F.col("o_orderpriority").alias("project"),
        F.col("o_orderstatus").alias("source_dialect"),
        (F.col("o_orderkey") % 10 != 0).cast("int").alias("parsed"),
        (F.col("o_orderkey") % 4 != 0).cast("int").alias("transpiled"),
    )
    out = G.coverage_report(entries)
    return out.withColumns({c: F.round(c, 9) for c in ("parse_ratio", "transpile_ratio")})


@query(
    "G9_sql_complexity",
    """SELECT 'p' || p_partkey AS path, p_size % 11 AS loops, p_size + p_size % 11 + p_size % 7 + CASE WHEN p_partkey % 50 = 0 THEN 1 ELSE 0 END AS statements, 3 AS simple_statements, p_size % 7 AS pivots,
         CASE WHEN p_partkey % 50 = 0 THEN 1 ELSE 0 END AS xml,
         CASE WHEN p_size % 11 > 8 OR p_size + p_size % 11 + p_size % 7 + (p_partkey % 50 = 0)::INT > 50 OR p_size % 7 > 5 THEN 'VERY COMPLEX'
              WHEN p_size % 11 > 5 OR p_size + p_size % 11 + p_size % 7 + (p_partkey % 50 = 0)::INT > 30 OR p_size % 7 > 3 THEN 'COMPLEX'
              WHEN p_size % 11 > 0 OR p_size + p_size % 11 + p_size % 7 + (p_partkey % 50 = 0)::INT > 10 OR p_size % 7 > 0 OR p_partkey % 50 = 0 THEN 'MEDIUM' ELSE 'LOW' END AS complexity FROM part""",
)
def sql_complexity(read):
    text = F.concat(
        F.lit("SET a = 1; use db; go; -- while hidden\n"),
        F.repeat(F.lit("insert into t select 'pivot (x); it''s'; "), F.col("p_size")),
        F.repeat(F.lit("WHILE @i < 3 BEGIN SELECT 1 END; "), F.col("p_size") % 11),
        F.repeat(F.lit("select * from t pivot (sum(x) for y in (1)); "), F.col("p_size") % 7),
        F.when(F.col("p_partkey") % 50 == 0, "select * from t for xml path;").otherwise(""),
    )
    return G.sql_complexity(_parts(read).select(F.concat(F.lit("p"), _key()).alias("path"), text.alias("sql")))


_TOOLS = ("datastage", "talend", "ssis", "alteryx", "bods", "pentaho")


@query(
    "G10_job_complexity",
    """WITH j AS (SELECT o_orderkey AS id, ['datastage','talend','ssis','alteryx','bods','pentaho'][1 + o_orderkey % 6] AS tool, o_custkey % 10 AS e, o_orderkey % 4 AS s, o_orderkey % 3 AS jn, o_custkey % 18 AS l,
           o_custkey % 5 AS t, o_orderkey % 27 AS f, o_custkey % 60 AS c, CASE WHEN o_orderkey % 40 = 0 THEN 1 ELSE 0 END AS u FROM orders),
       b AS (SELECT *, tool IN ('datastage', 'talend', 'pentaho') AS big, tool IN ('datastage', 'pentaho') AS looks, tool = 'ssis' AS ss, tool IN ('alteryx', 'bods') AS small FROM j),
       m AS (SELECT *, (e BETWEEN 2 AND 4)::INT + (NOT small AND s > 1)::INT + (big AND jn >= 1)::INT + (looks AND l BETWEEN 4 AND 6)::INT + (NOT small AND t > 1)::INT + (f >= 10)::INT
              + (tool <> 'datastage' AND c >= 10)::INT AS mb FROM b),
       x AS (SELECT *, (mb >= 3)::INT + (e BETWEEN 5 AND 7)::INT + (c >= 20)::INT + (f >= 20)::INT + (big AND u >= 1)::INT + (looks AND l BETWEEN 7 AND 14)::INT AS cb FROM m)
       SELECT id, tool, CASE WHEN cb >= 3 OR (tool <> 'talend' AND e > 7) OR (looks AND l > 15) OR c >= 50 THEN 'VERY COMPLEX' WHEN cb > 0 THEN 'COMPLEX' WHEN mb > 0 THEN 'MEDIUM' ELSE 'LOW' END AS complexity FROM x""",
)
def job_complexity(read):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    inventory = read("orders").select(
        key.alias("id"),
        F.get(F.array(*[F.lit(t) for t in _TOOLS]), (key % 6).cast("int")).alias("tool"),
        (cust % 10).alias("expressions"),
        (key % 4).alias("sources"),
        (key % 3).alias("joins"),
        (cust % 18).alias("lookups"),
        (cust % 5).alias("targets"),
        (key % 27).alias("functions"),
        (cust % 60).alias("components"),
        F.when(key % 40 == 0, 1).otherwise(0).alias("unusual"),
    )
    return G.job_complexity(inventory).select("id", "tool", "complexity")


@query(
    "G11_sas_complexity",
    """WITH f AS (SELECT 's' || p_partkey AS path, p_size % 17 AS macros, p_size % 27 AS data_blocks, (p_size % 17) + 2 * (p_size % 27) + p_size % 27 AS statements, (p_size % 27) AS conditions,
           p_size % 5 AS loops, p_size % 3 AS sql, CASE WHEN p_size > 10 AND p_size <= 30 THEN p_size % 3 ELSE 0 END AS ms, CASE WHEN p_size > 30 AND p_size <= 50 THEN p_size % 3 ELSE 0 END AS cs FROM part)
       SELECT path, macros, data_blocks, conditions, loops, sql, ms AS medium_sql, cs AS complex_sql,
         CASE WHEN macros > 15 OR data_blocks > 25 OR conditions > 50 OR loops > 20 OR sql > 40 OR statements > 150 THEN 'VERY COMPLEX'
              WHEN macros > 7 OR data_blocks > 15 OR conditions > 20 OR loops > 10 OR cs > 0 OR sql > 20 OR statements > 100 THEN 'COMPLEX'
              WHEN macros > 3 OR data_blocks > 5 OR conditions > 10 OR loops > 3 OR ms > 0 OR sql > 10 OR statements > 50 THEN 'MEDIUM' ELSE 'LOW' END AS complexity FROM f""",
)
def sas_complexity(read):
    text = F.concat(
        F.expr("repeat('%macro m; %mend;\\n', p_size % 17)"),
        F.expr("repeat('data work.a; set b; if x then y = 1; run;\\n', p_size % 27)"),
        F.expr("repeat('proc print; do i = 1 to 3; end;\\n', p_size % 5)"),
        F.expr("repeat(concat('proc sql; ', repeat('select 1; ', p_size - 1), 'quit;\\n'), p_size % 3)"),
    )
    out = G.sas_complexity(_parts(read).select(F.concat(F.lit("s"), _key()).alias("path"), text.alias("sql")))
    return out.drop("statements", "very_complex_sql")
