"""Facts about SQL scripts kept as rows ``(path, sql)``: statements, objects, table edges, levels, complexity.

Statements and brackets come from a lexer, names in them from patterns. A table name inside dynamic SQL, or in the
body of a function that is a text, is not seen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.operators import lexer
from veritab.session import materialise

# One part of a name, quoted or not, and a name of parts. Possessive: a name is taken whole or not at all.
_PART = r"(?:\"(?:[^\"]++|\"\")*+\"|`[^`]*+`|\[[^\[\]]*+\]|[A-Za-z_][\w$#]*+)"
_NAME = rf"{_PART}(?:\s*+\.\s*+{_PART})*+"
_OBJECT = r"(?i)\bcreate\s+(?:or\s+replace\s+)?(?:global\s+|temporary\s+|temp\s+|materialized\s+)*"
_KINDS = "table|view|procedure|function|sequence|package"
# Quoted text or comment. A doubled quote reads as two texts side by side, which changes nothing here. Repeats are
# possessive, so that the pattern engine walks through a text of any length without a deep stack.
_TEXT = r"'[^']*+'"
_QUOTED = rf"{_TEXT}|\"[^\"]*+\"|`[^`]*+`"
_COMMENT = rf"({_QUOTED})|--[^\n]*+|/\*(?s:.*?)\*/"


def without_comments(sql: Column) -> Column:
    """Comments become a blank; texts and names in quotes stay as they are."""
    marked = F.regexp_replace(sql, _COMMENT, "$1\u0001")
    return F.translate(F.regexp_replace(marked, f"({_QUOTED})\u0001", "$1"), "\u0001", " ")


def _without_texts(sql: Column) -> Column:
    return F.regexp_replace(sql, _TEXT, "''")


def _plain_table(c: Column) -> Column:
    """Last part of a table name, without quotes, in lower case."""
    return F.lower(F.regexp_replace(F.element_at(F.regexp_extract_all(c, F.lit(f"({_PART})"), F.lit(1)), -1), r"^[`\"\[]|[`\"\]]$", ""))


def _is_qualified(c: Column) -> Column:
    return F.size(F.regexp_extract_all(c, F.lit(f"({_PART})"), F.lit(1))) > 1


def split_statements(scripts: DataFrame, backslash: bool = False) -> DataFrame:
    """(path, position, statement): cut at semicolons of the code; the last piece may lack one. See :mod:`lexer`."""
    return lexer.statements(scripts, backslash).drop("code")


def split_objects(scripts: DataFrame) -> DataFrame:
    """(path, position, object_type, object_name, body): one row per created object."""
    code = without_comments(F.col("sql"))
    start = f"{_OBJECT}(?:{_KINDS})\\b"
    # A text in quotes is skipped; an object runs to the start of the next one.
    piece = f"{_TEXT}|({start}(?:{_TEXT}|[^'cC]++|(?!{start})[cC])*+)"
    pieces = F.filter(F.regexp_extract_all(code, F.lit(piece), F.lit(1)), lambda p: p != "")
    body = F.trim("body")
    return (
        scripts.select("path", F.posexplode(pieces).alias("position", "body"))
        .select(
            "path",
            "position",
            F.upper(F.regexp_extract("body", f"{_OBJECT}({_KINDS})\\b", 1)).alias("object_type"),
            F.lower(
                F.regexp_extract(
                    "body", f"{_OBJECT}(?:{_KINDS})\\s+(?:body\\s+)?(?:if\\s+not\\s+exists\\s+)?({_NAME})", 1
                )
            ).alias("object_name"),
            body.alias("body"),
        )
    )


def duplicate_objects(objects: DataFrame) -> DataFrame:
    """Objects that are created more than once."""
    return objects.groupBy("object_type", "object_name").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def table_edges(scripts: DataFrame, backslash: bool = False) -> DataFrame:
    """(parent, child): every table a statement reads, and the table it creates, fills or merges into.

    The child is the script itself when nothing is written. Read are the names of FROM lists, joins and USING; names
    that are called are functions. An unqualified name of a common table expression of the statement is no table.
    """
    code = F.regexp_replace("code", r"(?i)\bis\s+(?:not\s+)?distinct\s+from\b", "=")
    writes = (
        r"(?i)\b(?:create\s+(?:or\s+replace\s+)?(?:global\s+|temporary\s+|temp\s+|materialized\s+)*(?:table|view)"
        r"\s+(?:if\s+not\s+exists\s+)?|insert\s+(?:into|overwrite)\s+(?:table\s+)?|merge\s+into\s+)(" + _NAME + ")"
    )
    found = lexer.statements(scripts, backslash).select("path", F.regexp_extract("code", writes, 1).alias("written"), code.alias("code"))
    found = lexer.with_levels(found).drop("code")
    ctes = F.flatten(F.transform("levels", lambda t: F.regexp_extract_all(t, F.lit(_CTE), F.lit(1))))
    reads = F.flatten(F.transform("levels", _read_names))
    found = found.select("path", "written", reads.alias("read"), F.transform(ctes, _plain_table).alias("ctes"))
    tables = F.filter("read", lambda n: _is_qualified(n) | ~F.array_contains("ctes", _plain_table(n)))
    child = F.when(F.col("written") != "", _plain_table(F.col("written"))).otherwise(F.lower("path"))
    return found.select(F.explode(F.transform(tables, _plain_table)).alias("parent"), child.alias("child")).distinct()


# A FROM clause runs to the next clause of its level.
_FROM = (
    r"(?is)\bfrom\s+(.*?)(?=\b(?:where|group\s+by|order\s+by|having|union|except|intersect|minus|limit|offset|fetch|window|qualify|connect\s+by"
    r"|start\s+with|set|values|select|when|returning)\b|$)"
)
_CTE = rf"(?i)(?:\bwith\s+(?:recursive\s+)?|,\s*)({_NAME})\s*(?:\(\)\s*)?as\s*(?:(?:not\s+)?materialized\s*)?\(\)"


def _read_names(level: Column) -> Column:
    """Names that one level of a statement reads."""
    clauses = F.regexp_extract_all(level, F.lit(_FROM), F.lit(1))
    items = F.flatten(F.transform(clauses, lambda c: F.split(c, r"(?i),|\bjoin\b|\busing\b")))
    first = F.transform(items, lambda i: F.regexp_extract(i, rf"(?i)^\s*(?:(?:lateral|only|table)\s+)?({_NAME})(?!\s*\()", 1))
    other = F.regexp_extract_all(level, F.lit(rf"(?i)\b(?:join|using)\s+(?:lateral\s+)?({_NAME})(?!\s*\()"), F.lit(1))
    return F.filter(F.concat(first, other), lambda n: (n != "") & ~F.lower(n).isin("lateral", "only", "table"))


def parents(edges: DataFrame, table: str) -> DataFrame:
    return edges.filter(F.col("child") == table.lower()).select("parent")


def children(edges: DataFrame, table: str) -> DataFrame:
    return edges.filter(F.col("parent") == table.lower()).select("child")


def root_tables(edges: DataFrame) -> DataFrame:
    """Nodes that no edge leads to. The edges are read once."""
    ends = F.array(F.struct(F.col("parent").alias("node"), F.lit(False).alias("led")), F.struct(F.col("child").alias("node"), F.lit(True).alias("led")))
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.bool_or("led").alias("led"), F.bool_and("led").alias("last"))
    return nodes.where("NOT last AND (NOT led OR node IS NULL)").select("node")


def tables_at_level(edges: DataFrame, level: int, cut_every: int = 4) -> DataFrame:
    """Nodes reached from a root by exactly ``level`` steps. A cycle ends with the level.

    The edges are written to the shared folder, so scripts are read once; the set is written every few steps,
    so that the plan stays short.
    """
    if level:
        edges = materialise(edges, "edges")
    step = edges.select(F.col("parent").alias("node"), F.col("child").alias("next"))
    reached = root_tables(edges)
    for i in range(level):
        reached = reached.join(step, "node").select(F.col("next").alias("node")).distinct()
        if (i + 1) % cut_every == 0 and i + 1 < level:
            reached = materialise(reached, "level")
    return reached


def closure(edges: DataFrame) -> DataFrame:
    """(ancestor, node, steps): every table that a table is made from, directly or not, with the least number of steps.

    Each round joins the paths found so far with each other, so their length doubles and the number of rounds grows with
    the logarithm of the depth. On a cycle a table is its own ancestor. Rounds are written to the shared folder.
    """
    paths = edges.where("parent <> child").select(F.col("parent").alias("ancestor"), F.col("child").alias("node"), F.lit(1).cast("long").alias("steps"))
    paths = materialise(paths.distinct(), "paths")
    before = None
    while (state := tuple(paths.agg(F.count(F.lit(1)), F.sum("steps")).first())) != before:
        before = state
        on = paths.select(F.col("ancestor").alias("node"), F.col("node").alias("next"), F.col("steps").alias("more"))
        longer = paths.join(on, "node").select("ancestor", F.col("next").alias("node"), (F.col("steps") + F.col("more")).alias("steps"))
        paths = materialise(paths.unionByName(longer).groupBy("ancestor", "node").agg(F.min("steps").alias("steps")), "paths")
    return paths


def node_levels(edges: DataFrame) -> DataFrame:
    """(node, level, on_cycle): the least number of steps from a root, 0 for roots, NULL where no root leads to.

    No table here is larger than the edges. Chains and trees of nodes with one parent are walked by jumps of doubling
    length, so rounds grow with the logarithm of their depth. The other nodes take one round per step between them.
    """
    edges = materialise(edges, "edges")
    steps = materialise(edges.where("parent <> child").distinct(), "steps")
    roots = materialise(root_tables(edges), "roots")
    levels = _least_levels(steps, roots)
    cyclic = _on_cycles(steps).unionByName(edges.where("parent = child").select(F.col("parent").alias("node")))
    cyclic = cyclic.distinct().withColumn("on_cycle", F.lit(True))
    nodes = edges.select(F.explode(F.array("parent", "child")).alias("node")).distinct()
    return nodes.join(levels, "node", "left").join(cyclic, "node", "left").withColumn("on_cycle", F.coalesce("on_cycle", F.lit(False)))


def _single(edges: DataFrame, up: str = "parent", down: str = "child") -> DataFrame:
    """(node, parent): nodes that one edge leads to, of distinct edges from ``up`` to ``down``."""
    counts = edges.groupBy(F.col(down).alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min(up).alias("parent"))
    return counts.where("n = 1").select("node", "parent")


def _anchors(single: DataFrame) -> DataFrame:
    """(node, anchor, steps): the nearest forebear that has no parent in ``single`` itself. Nodes that come from a ring have none.

    Each round doubles the jumps. Fewer nodes are on their way after each, but for those that come from a ring.
    """
    jumps = single.select("node", F.col("parent").alias("anchor"), F.lit(1).cast("long").alias("steps"))
    before = None
    while True:
        on = jumps.select(F.col("node").alias("via"), F.col("anchor").alias("next"), F.col("steps").alias("more"))
        further = jumps.join(on, F.col("anchor") == F.col("via"), "left")
        further = further.select("node", F.coalesce("next", "anchor").alias("anchor"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("via").isNotNull().alias("open"))
        further = materialise(further, "jumps")
        under_way = further.where("open").count()
        jumps = further.drop("open")
        if under_way in (0, before):
            return further.where("not open").drop("open")
        before = under_way


def _least_levels(steps: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, level) of the nodes that a root leads to. A node with one parent takes its level from its anchor.

    The others are reached in rounds, from the nodes whose level fell in the round before.
    """
    single = materialise(_single(steps), "single")
    anchors = _anchors(single)
    to = steps.join(single.select(F.col("node").alias("child")), "child", "left_anti")
    to = to.join(anchors.withColumnRenamed("node", "parent"), "parent", "left")
    to = to.select(F.coalesce("anchor", "parent").alias("start"), "child", (F.coalesce("steps", F.lit(0)) + 1).alias("more"))
    to = materialise(to.groupBy("start", "child").agg(F.min("more").alias("more")), "to")
    levels = fell = roots.select("node", F.lit(0).cast("long").alias("level"))
    while True:
        new = fell.join(to, F.col("node") == F.col("start")).groupBy("child").agg(F.min(F.col("level") + F.col("more")).alias("new"))
        new = new.join(levels, F.col("child") == F.col("node"), "left").where("level IS NULL OR new < level")
        fell = materialise(new.select(F.col("child").alias("node"), F.col("new").alias("level")), "fell")
        if fell.isEmpty():
            break
        levels = materialise(levels.unionByName(fell).groupBy("node").agg(F.min("level").alias("level")), "levels")
    of_anchor = levels.withColumnRenamed("node", "anchor")
    return levels.unionByName(anchors.join(of_anchor, "anchor").select("node", (F.col("level") + F.col("steps")).alias("level")))


def _trimmed(edges: DataFrame) -> DataFrame:
    """The edges between nodes that edges lead to and from, until that holds for all. No cycle loses an edge.

    A node goes with the whole chain or tree that hangs on it by single edges.
    """
    n = edges.count()
    while n:
        for up, down in (("parent", "child"), ("child", "parent")):
            ends = edges.select(F.col(up).alias("node")).distinct().join(edges.select(F.col(down).alias("node")), "node", "left_anti")
            ends = materialise(ends, "ends")
            hanging = _anchors(_single(edges, up, down)).join(ends.withColumnRenamed("node", "anchor"), "anchor", "left_semi").select("node")
            gone = ends.unionByName(hanging).withColumnRenamed("node", up)
            edges = materialise(edges.join(gone, up, "left_anti").select("parent", "child"), "trimmed")
        before, n = n, edges.count()
        if n == before:
            break
    return edges


def _on_cycles(edges: DataFrame) -> DataFrame:
    """(node): nodes that lead to themselves, of distinct edges between different nodes.

    What is left after trimming is coloured: a node has the largest name that leads to it. Nodes that lead back to the one
    that gave the colour are on a cycle with it; they go, and so do edges between colours. Rings that nothing leads to
    or from need no colour. Colours take one round per step.
    """
    found = edges.select(F.col("parent").alias("node")).limit(0)
    while not (edges := _trimmed(edges)).isEmpty():
        plain = _single(edges).join(_single(edges, "child", "parent").select("node"), "node", "left_semi")
        plain = materialise(plain, "plain")
        rings = materialise(plain.select("node").join(_anchors(plain).select("node"), "node", "left_anti"), "rings")
        edges = materialise(edges.join(rings.withColumnRenamed("node", "parent"), "parent", "left_anti").select("parent", "child"), "knots")
        found = found.unionByName(rings)
        if edges.isEmpty():
            break
        colours = _spread_colours(edges)
        of = lambda end: colours.select(F.col("node").alias(end), F.col("colour").alias(f"{end}_colour"))
        within = edges.join(of("parent"), "parent").join(of("child"), "child").where("parent_colour = child_colour")
        within = materialise(within.select("parent", "child", F.col("parent_colour").alias("colour")), "within")
        back = last = colours.where("node = colour").select("node")
        while not last.isEmpty():
            last = within.join(last.withColumnRenamed("node", "child"), "child", "left_semi").select(F.col("parent").alias("node")).distinct()
            last = materialise(last.join(back, "node", "left_anti"), "last")
            back = materialise(back.unionByName(last), "back")
        # Alone in its colour, the giver of the colour is on no cycle.
        ends = lambda end: within.join(back.withColumnRenamed("node", end), end, "left_semi")
        inner = ends("parent").join(back.withColumnRenamed("node", "child"), "child", "left_semi")
        found = found.unionByName(inner.select(F.col("parent").alias("node")).distinct())
        for end in ("parent", "child"):
            within = within.join(back.withColumnRenamed("node", end), end, "left_anti")
        edges = materialise(within.select("parent", "child"), "rest")
    return found


def _spread_colours(edges: DataFrame) -> DataFrame:
    """(node, colour): the largest name among a node and those that lead to it."""
    colours = last = materialise(edges.select(F.explode(F.array("parent", "child")).alias("node")).distinct().withColumn("colour", F.col("node")), "colours")
    while True:
        new = last.join(edges, F.col("node") == F.col("parent")).groupBy("child").agg(F.max("colour").alias("new"))
        new = new.join(colours, F.col("child") == F.col("node")).where("new > colour")
        last = materialise(new.select("node", F.col("new").alias("colour")), "recoloured")
        if last.isEmpty():
            return colours
        colours = materialise(colours.unionByName(last).groupBy("node").agg(F.max("colour").alias("colour")), "colours")


def flow_chart(edges: DataFrame) -> DataFrame:
    """(line): ``Child --> Parent`` per edge, and a node without parents alone. One row per line, no single text.

    The edges are written to the shared folder, so scripts are read once.
    """
    edges = materialise(edges, "edges")
    arrows = edges.distinct().select(
        F.concat(F.lit("    "), _capital("child"), F.lit(" --> "), _capital("parent")).alias("line")
    )
    return arrows.unionByName(root_tables(edges).select(F.concat(F.lit("    "), _capital("node")).alias("line")))


def _capital(name: str) -> Column:
    return F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.expr(f"substring({name}, 2)")))


def coverage_report(entries: DataFrame) -> DataFrame:
    """Per project and dialect: scripts, parsed, transpiled and the two ratios."""
    return (
        entries.groupBy("project", "source_dialect")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.sum(F.col("parsed").cast("long")).alias("parsed"),
            F.sum(F.col("transpiled").cast("long")).alias("transpiled"),
        )
        .withColumns(
            {"parse_ratio": F.col("parsed") / F.col("total"), "transpile_ratio": F.col("transpiled") / F.col("total")}
        )
    )


# Complexity classes and their limits.
LOW, MEDIUM, COMPLEX, VERY_COMPLEX = "LOW", "MEDIUM", "COMPLEX", "VERY COMPLEX"
SQL_LIMITS = {  # feature: a value above the limit gives the class
    MEDIUM: {"loops": 0, "statements": 10, "simple_statements": 1000, "pivots": 0, "xml": 0},
    COMPLEX: {"loops": 5, "statements": 30, "simple_statements": 2000, "pivots": 3, "xml": 3},
    VERY_COMPLEX: {"loops": 8, "statements": 50, "simple_statements": 5000, "pivots": 5, "xml": 5},
}
SAS_LIMITS = {
    MEDIUM: {"macros": 3, "data_blocks": 5, "statements": 50, "conditions": 10, "loops": 3, "medium_sql": 0, "sql": 10},
    COMPLEX: {"macros": 7, "data_blocks": 15, "statements": 100, "conditions": 20, "loops": 10, "complex_sql": 0, "sql": 20},
    VERY_COMPLEX: {
        "macros": 15, "data_blocks": 25, "statements": 150, "conditions": 50, "loops": 20, "very_complex_sql": 0, "sql": 40,
    },
}
# Which rules an ETL tool knows: per class the names below. "three" counts the breaks of the class before.
JOB_RULES = {
    "datastage": (
        ("expressions", "sources", "joins", "lookups", "targets", "functions"),
        ("expressions", "components", "functions", "unusual", "lookups"),
        ("expressions", "lookups", "components"),
    ),
    "talend": (("expressions", "sources", "joins", "components", "targets", "functions"), ("expressions", "components", "functions", "unusual"), ("components",)),
    "ssis": (("expressions", "sources", "targets", "functions", "components"), ("expressions", "components", "functions"), ("expressions", "components")),
    "alteryx": (("expressions", "functions", "components"), ("expressions", "components", "functions"), ("expressions", "components")),
    "bods": (("expressions", "functions", "components"), ("expressions", "components", "functions"), ("expressions", "components")),
    "pentaho": (
        ("expressions", "sources", "joins", "lookups", "targets", "functions", "components"),
        ("expressions", "components", "functions", "unusual", "lookups"),
        ("expressions", "lookups", "components"),
    ),
}


def _job_rule(level: int, name: str) -> Column:
    c = F.col(name)
    rules = (
        {
            "expressions": c.between(2, 4), "sources": c > 1, "joins": c >= 1, "lookups": c.between(4, 6),
            "targets": c > 1, "functions": c >= 10, "components": c >= 10,
        },
        {
            "expressions": c.between(5, 7), "components": c >= 20, "functions": c >= 20, "unusual": c >= 1,
            "lookups": c.between(7, 14),
        },
        {"expressions": c > 7, "lookups": c > 15, "components": c >= 50},
    )
    return F.coalesce(rules[level][name], F.lit(False))


def job_complexity(inventory: DataFrame, tool: str = "tool") -> DataFrame:
    """Class of each ETL job from its counts.

    Columns: tool, expressions (with 5 or more calls), sources, joins, lookups, targets, functions, components,
    unusual (nodes). Three breaks of one class give the next.
    """
    known = F.lower(F.col(tool))
    broken = []
    for level in range(3):
        per_tool = None
        for name, rules in JOB_RULES.items():
            count = reduce(lambda a, b: a + b, [_job_rule(level, r).cast("int") for r in rules[level]])
            per_tool = F.when(known == name, count) if per_tool is None else per_tool.when(known == name, count)
        broken.append(per_tool)
    medium, more, most = broken
    complex_breaks = more + (medium >= 3).cast("int")
    return inventory.withColumn(
        "complexity",
        F.when((most > 0) | (complex_breaks >= 3), VERY_COMPLEX)
        .when(complex_breaks > 0, COMPLEX)
        .when(medium > 0, MEDIUM)
        .otherwise(LOW),
    )




def _above(limits: dict) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(n) > v, F.lit(False)) for n, v in limits.items()])


def script_class(limits: dict) -> Column:
    """Highest class with a feature above its limit."""
    return (
        F.when(_above(limits[VERY_COMPLEX]), VERY_COMPLEX)
        .when(_above(limits[COMPLEX]), COMPLEX)
        .when(_above(limits[MEDIUM]), MEDIUM)
        .otherwise(LOW)
    )


def sql_features(scripts: DataFrame, simple: str = r"(?i)^(set|use|print|go|declare)\b") -> DataFrame:
    """Counts per script: loops, statements (without simple ones), simple statements, pivots, XML calls."""
    code = scripts.select("path", _without_texts(without_comments(F.col("sql"))).alias("code"))
    pieces = F.filter(F.transform(F.split("code", ";"), lambda s: F.trim(s)), lambda s: F.length(F.regexp_replace(s, r"\s", "")) > 0)
    # Each step is taken once a script, as Spark repeats no expression that is dear across selects.
    cut = code.select("path", "code", F.transform(pieces, lambda s: s.rlike(simple)).alias("is_simple"))
    return cut.select(
        "path",
        # FOR ... LOOP and WHILE ... LOOP count once, by their LOOP; FOR inside PIVOT is none.
        F.regexp_count("code", F.lit(r"(?i)(?<!\bend\s)\bloop\b|\bwhile\b(?![^;]*?\bloop\b)")).alias("loops"),
        F.size(F.filter("is_simple", lambda s: ~s)).alias("statements"),
        F.size(F.filter("is_simple", lambda s: s)).alias("simple_statements"),
        F.regexp_count("code", F.lit(r"(?i)\b(un)?pivot\s*\(")).alias("pivots"),
        F.regexp_count("code", F.lit(r"(?i)\b(for\s+xml|openxml|xmltable|xmlelement|xmlagg)\b")).alias("xml"),
    )


def sql_complexity(scripts: DataFrame) -> DataFrame:
    return sql_features(scripts).withColumn("complexity", script_class(SQL_LIMITS))


def sas_features(scripts: DataFrame) -> DataFrame:
    """Counts per SAS script: macros, data blocks, statements, conditions, loops, SQL procs and their classes.

    A SQL proc is classed by its own statements with the SQL limits.
    """
    code = F.regexp_replace(_without_texts(F.col("sql")), r"(?s)/\*.*?\*/", " ")
    procs = F.regexp_extract_all(code, F.lit(r"(?is)\bproc\s+sql\b(.*?)\bquit\s*;"), F.lit(1))
    sizes = F.transform(procs, lambda p: F.regexp_count(p, F.lit(";")))

    def of_class(low: int, high: int | None) -> Column:
        return F.size(F.filter(sizes, lambda n: (n > low) & (n <= high) if high else n > low))

    return scripts.select(
        "path",
        F.regexp_count(code, F.lit(r"(?i)%macro\b")).alias("macros"),
        F.regexp_count(code, F.lit(r"(?im)^\s*data\s+\w")).alias("data_blocks"),
        F.regexp_count(
            F.array_join(F.regexp_extract_all(code, F.lit(r"(?is)(%macro\b.*?%mend|\bdata\s+\w.*?\brun\s*;)"), F.lit(1)), " "),
            F.lit(";"),
        ).alias("statements"),
        F.regexp_count(code, F.lit(r"(?i)%?\bif\b")).alias("conditions"),
        F.regexp_count(code, F.lit(r"(?i)%?\bdo\b\s+(while|until|\w+\s*=)")).alias("loops"),
        F.size(procs).alias("sql"),
        of_class(SQL_LIMITS[MEDIUM]["statements"], SQL_LIMITS[COMPLEX]["statements"]).alias("medium_sql"),
        of_class(SQL_LIMITS[COMPLEX]["statements"], SQL_LIMITS[VERY_COMPLEX]["statements"]).alias("complex_sql"),
        of_class(SQL_LIMITS[VERY_COMPLEX]["statements"], None).alias("very_complex_sql"),
    )


def sas_complexity(scripts: DataFrame) -> DataFrame:
    return sas_features(scripts).withColumn("complexity", script_class(SAS_LIMITS))
