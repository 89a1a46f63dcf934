"""Merkle manifest of a table, with a proof for every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import running_rank, stored

#: Children of a node; levels that are built in one window, whose partitions hold at most ARITY ** LEVELS nodes.
ARITY, LEVELS = 3, 6
#: Columns that a leaf covers, in this order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def hexed(digests: Column) -> Column:
    """Lowercase hex text of digests, which may be several in a row."""
    return F.lower(F.hex(digests))


def encoded(value: Column) -> Column:
    """Null as ``-``, others as UTF-8 length, colon, value; so no two lists of values share a text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _levels(nodes: DataFrame, group: list[str]) -> DataFrame:
    """Nodes (group, at, hash, counted from 0 without gaps) with ``chunk``, ``path`` and ``top``: LEVELS levels up.

    ``path`` lists, for each level that exists, the siblings left and right of the node that is above the row;
    ``top`` is the node LEVELS levels above, on the first row of each chunk only.

    A chunk holds the ARITY ** LEVELS rows below one top. On level k the nodes sit on the rows whose place in the chunk
    is a multiple of ARITY ** k: lead and lag by that step, and by twice that step, give the siblings. What lies outside
    a run is masked by the node's slot in its run and the run's length; slot 0 then hashes the run to its parent.
    A group that is one chunk stops at the level where one node is left.
    """
    size = ARITY**LEVELS
    keys = ", ".join([*group, "chunk"])
    order = f"OVER (PARTITION BY {keys} ORDER BY place)"
    out = nodes.selectExpr("*", f"at div {size} AS chunk", f"at % {size} AS place", "hash AS node")
    out = out.selectExpr("*", f"count(1) OVER (PARTITION BY {keys} ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS rows_of_chunk")
    lives = [f"(chunk > 0 OR rows_of_chunk > {ARITY**k})" for k in range(LEVELS)]
    for k in range(LEVELS):
        step = ARITY**k
        slot = f"(place div {step}) % {ARITY}"
        run = f"least({ARITY}, ceil(rows_of_chunk / {step}) - (place div {step}) + {slot})"
        before = [f"CASE WHEN {slot} >= {n} THEN lag(node, {n * step}) {order} ELSE X'' END" for n in range(ARITY - 1, 0, -1)]
        after = [f"CASE WHEN {slot} + {n} < {run} THEN lead(node, {n * step}) {order} ELSE X'' END" for n in range(1, ARITY)]
        siblings = f"named_struct('left', concat({', '.join(before)}), 'right', concat({', '.join(after)}))"
        out = out.selectExpr("*", f"CASE WHEN {lives[k]} AND place % {step} = 0 THEN {siblings} END AS run{k}")
        parent = f"CASE WHEN {slot} = 0 THEN unhex(sha2(CAST(lower(hex(concat(node, run{k}.right))) AS BINARY), 256)) END"
        out = out.selectExpr(*[c for c in out.columns if c != "node"], f"CASE WHEN place % {step} = 0 THEN CASE WHEN {lives[k]} THEN {parent} ELSE node END END AS node")
    # The row of a node is the last one before its rows.
    paths = [f"CASE WHEN {x} THEN last(run{k}, true) OVER (PARTITION BY {keys} ORDER BY place ROWS UNBOUNDED PRECEDING) END" for k, x in enumerate(lives)]
    return out.selectExpr(*nodes.columns, "chunk", f"array_compact(array({', '.join(paths)})) AS path", "CASE WHEN place = 0 THEN node END AS top")


def _tree(leaves: DataFrame, group: list[str]) -> tuple[DataFrame, list[DataFrame]]:
    """The single node of each group, and stored tables of nodes with their paths, LEVELS levels from one to the next."""
    tables, now = [], leaves
    while True:
        tables.append(stored(_levels(now, group), "nodes"))
        now = tables[-1].where(F.col("top").isNotNull()).select(*group, F.col("chunk").alias("at"), F.col("top").alias("hash"))
        if not now.where("at > 0").take(1):
            return now.select(*group, "hash"), tables


def _chunk_paths(tables: list[DataFrame], group: list[str], above: DataFrame) -> DataFrame:
    """Paths above the chunks of the first table, from the top down.

    above: (group, path, ...) of each group's own top; its other columns are handed down. Returns them with ``chunk``.
    """
    out = above.withColumn("chunk", F.lit(0).cast("long"))
    for table in reversed(tables[1:]):
        rows = table.select(*group, "chunk", "at", F.col("path").alias("low")).join(out, [*group, "chunk"])
        out = stored(rows.select(*above.drop("path").columns, F.concat("low", "path").alias("path"), F.col("at").alias("chunk")), "paths")
    return out


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: digest(hexed(F.concat(s["left"], h, s["right"]))))


def merkle_manifest(
    rows: DataFrame, columns: Sequence[str] = COLUMNS, group_column: str = "source", order_column: str = "doc_id", tampered: dict[str, Column] | None = None
) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and the root that the row with the columns of ``tampered`` leads to.

    Columns: the order column, leaf, subroot, root, path (siblings left and right, level by level, as bytes),
    proof_sha256, folded_root, verified.

    A leaf is the digest of a row's columns. Leaves of a group ascend by the order column (nulls first, then by leaf),
    and three nodes in a row become one until one is left; the nodes that are left are leaves of the same kind of
    tree over all groups, null first, others by bytes.

    Each level takes siblings from lag and lead over chunks of 729 rows, so a group may have any part of all rows.
    Texts are hashed in the scan; only digests are shuffled. A row of a group that stands alone has an empty path in it.
    Rows that repeat are leaves of their own. An empty table gives an empty result. Other columns are ignored.
    """
    changed = {c: x for c, x in (tampered or {}).items() if c in columns}
    leaf_of = lambda new: digest(F.concat(*[encoded(new.get(c, F.col(c))) for c in columns]))
    same = F.lit(True)
    for c, x in changed.items():
        same &= F.col(c).eqNullSafe(x)
    key = F.coalesce(F.concat(F.lit("="), F.col(group_column).cast("string")), F.lit(""))
    # Stored, as cutting ranges reads its input twice.
    base = rows.select(F.col(order_column).alias("order_value"), key.alias("tree"), leaf_of({}).alias("hash"), F.when(~same, leaf_of(changed)).alias("changed"))
    ranked = running_rank(stored(base, "digests"), ["tree"], ["order_value", "hash", "changed"], "at")
    leaves = ranked.withColumn("at", F.col("at") - 1)

    subroots, tables = _tree(leaves, ["tree"])
    tops = running_rank(stored(subroots, "subroots"), [], ["tree"], "at").select(F.lit(0).alias("forest"), "tree", "hash", (F.col("at") - 1).alias("at"))
    root, upper = _tree(tops, ["forest"])
    whole = root.first()  # one row; none for an empty table
    empty = F.array().cast("array<struct<left:binary,right:binary>>")
    over = _chunk_paths(upper, ["forest"], root.select("forest", empty.alias("path")))
    groups = upper[0].select("forest", "chunk", "tree", F.col("hash").alias("subroot"), F.col("path").alias("low")).join(over, ["forest", "chunk"])
    groups = stored(groups.select("tree", "subroot", F.concat("low", "path").alias("path")), "groups")
    chunks = _chunk_paths(tables, ["tree"], groups).withColumnRenamed("path", "high")

    proofs = tables[0].select("tree", "chunk", "order_value", F.col("hash").alias("leaf"), F.coalesce("changed", "hash").alias("changed"), "path")
    proofs = proofs.join(chunks, ["tree", "chunk"]).withColumn("path", F.concat("path", "high"))
    siblings = F.aggregate("path", F.lit(b""), lambda before, s: F.concat(before, s["left"], s["right"]))
    out = proofs.select(
        F.col("order_value").alias(order_column),
        hexed("leaf").alias("leaf"),
        hexed("subroot").alias("subroot"),
        F.lit(whole["hash"].hex() if whole else None).cast("string").alias("root"),
        "path",
        F.sha2(hexed(siblings).cast("binary"), 256).alias("proof_sha256"),
        hexed(fold(F.col("changed"), F.col("path"))).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def line_breaks_removed(text_column: str = "text", id_column: str = "doc_id") -> dict[str, Column]:
    """The text without line feeds where 2 divides the CRC-32 of the id in decimal digits; rows without an id stay."""
    even = F.crc32(F.col(id_column).cast("string").cast("binary")) % 2 == 0
    return {text_column: F.when(even, F.replace(F.col(text_column), F.lit("\n"), F.lit(""))).otherwise(F.col(text_column))}
