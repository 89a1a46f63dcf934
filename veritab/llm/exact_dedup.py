"""Exact duplicates by block naming: blocks get integer names, then neighbouring names are named in pairs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.common import byte_column, free_name, identified, releasing, step, stored

#: Bytes of a block; a longer text has more blocks and more rounds of pairing (their logarithm).
BLOCK_BYTES = 2048


def _blocks(text: str, block_bytes: int):
    """Rows of two kinds: each block that is new in this partition, and each document with the references of its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        following = TaskContext.get().partitionId() << 40
        known: dict[bytes, int] = {}
        for batch in batches:
            refs, blocks, owners, lists, shas, rows = [], [], [], [], [], []
            for i, raw in enumerate(byte_column(batch, text)):
                low = raw.lower()  # of bytes: A-Z only
                own = following
                names = []
                for at in range(0, max(len(low), 1), block_bytes):
                    block = low[at : at + block_bytes]
                    first = known.setdefault(block, following)
                    if first == following:
                        refs.append(first), blocks.append(block), owners.append(None), lists.append(None), shas.append(None), rows.append(None)
                    names.append(first)
                    following += 1
                refs.append(own), blocks.append(None), owners.append(own), lists.append(names), shas.append(hashlib.sha256(low).hexdigest()), rows.append(i)
            rest = batch.drop_columns([text]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(refs, pa.int64()), pa.array(blocks, pa.binary()), pa.array(owners, pa.int64()), pa.array(lists, pa.list_(pa.int64())), pa.array(shas, pa.string()), *rest.columns],
                names=["ref", "block", "owner", "refs", "text_sha256", *rest.schema.names],
            )

    return run


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Groups of texts that are identical after lower-casing A-Z, one row per document.

    Columns: the id, keep_id, group_size, kept, text_sha256, and ``owner``, a number of the row in this run.

    Each partition keeps one copy of each of its blocks, so a block of very many copies is shuffled at most once
    per partition. Blocks are sorted, and the first reference of a run of equal ones is its name. Then pairs of
    neighbouring names get a name in the same way (the least number of a place that holds the pair), round by
    round, until each text has one. Names come from equality of contents, not from hashes, so texts never collide.

    A null text counts as empty; empty texts are one group. Null ids are less than all others. Of rows that agree
    in text and id, one is kept. Further columns are ignored. An empty table gives an empty result.
    """
    item = free_name(docs.select(text_column), "id_value") if id_column == text_column else "id_value"
    narrow = docs.select(F.col(id_column).alias(item), F.col(text_column).cast("string").alias("text_value"))
    kind = narrow.schema[item].dataType.simpleString()
    rows = narrow.mapInArrow(
        releasing(_blocks("text_value", block_bytes)),
        f"ref long, block binary, owner long, refs array<long>, text_sha256 string, `{item}` {kind}",
    )
    # A row of a document is a run of its own here, as owners differ.
    alike = Window.partitionBy("block", "owner").orderBy("ref").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = stored(rows.withColumn("name", F.first("ref").over(alike)).drop("block"), "blocks")
    documents = named.where("owner is not null").select(item, "owner", "refs", "text_sha256")
    names = named.where("owner is null").select("ref", "name")

    places = documents.select("owner", F.size("refs").cast("long").alias("n"), F.posexplode("refs").alias("pos", "ref"))
    level = stored(places.join(names, "ref").select("owner", F.col("pos").cast("long").alias("pos"), "n", "name"), "level")
    found, depth = [], 0
    while True:
        found.append(level.where("n = 1").select("owner", F.lit(depth).alias("depth"), "name"))
        if level.where("n > 1").isEmpty():
            break
        depth += 1
        pairs = (
            level.where("n > 1")
            .groupBy("owner", "n", F.floor(F.col("pos") / 2).alias("pos"))
            .agg(F.max(F.expr("if(pos % 2 = 0, name, null)")).alias("left_name"), F.coalesce(F.max(F.expr("if(pos % 2 = 1, name, null)")), F.lit(-1)).alias("right_name"))
        )
        chosen = pairs.groupBy("left_name", "right_name").agg(F.min(F.col("owner") + F.col("pos")).alias("name"))
        level = stored(
            pairs.join(chosen, ["left_name", "right_name"]).select("owner", "pos", F.ceil(F.col("n") / 2).alias("n"), "name"), "level"
        )
    identity = found[0]
    for part in found[1:]:
        identity = identity.unionByName(part)
    members = stored(documents.select(item, "owner", "text_sha256").join(identity, "owner"), "identity")
    # Stored, so that the join deals out the members by itself and can split a large group.
    groups = stored(members.groupBy("depth", "name").agg(F.max(F.struct(item, "owner")).alias("best"), F.count(F.lit(1)).alias("group_size")), "groups")
    return members.join(groups, ["depth", "name"]).select(
        F.col(item).alias(id_column),
        F.col(f"best.{item}").alias("keep_id"),
        "group_size",
        (F.col("owner") == F.col("best.owner")).alias("kept"),
        "text_sha256",
        "owner",
    )


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", in_files: bool = False) -> DataFrame:
    """The documents without the copies that :func:`exact_duplicates` finds; all columns stay as they are."""
    rows, row = identified(docs, in_files)
    # Ids decide first, numbers of rows between equal ids.
    key = rows.select(F.struct(F.col(id_column).alias("id"), F.col(row).alias("row")).alias("key"), F.col(text_column).alias("text_value"))
    dropped = step(docs.sparkSession, lambda: exact_duplicates(key, "key", "text_value").where("not kept").select(F.col("key.row").alias(row)), "dropped")
    return rows.join(dropped, row, "left_anti").select(*docs.columns)
