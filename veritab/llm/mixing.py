"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.common import free_name, numbered, running_rank, stored, word_count

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = "mix"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Targets of sources. In: source, source_size, one row each. Out: these, weight and target.

    Sources in code point order, null last, weigh 1, 2, 3 and again. They share the sum of sizes by weight; a target
    ends at ``most`` times its source's size, and what is over goes to the others by weight, until none is above. In
    order of size by weight, the sources that end there come first, so running sums find all of them at once.
    The table has one row per source; only such rows meet in a task here.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (((nth - 1) % len(weights)) + 1).cast("int"))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    upto, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    step = (
        sizes.withColumn("weight", weight)
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("left_size", F.col("total") - most * F.coalesce(F.sum("source_size").over(upto), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0)))
        .withColumn("full", most * F.col("source_size") * F.col("left_weight") <= F.col("weight") * F.col("left_size"))
    )
    spare = F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), most * F.col("source_size"))).over(whole), F.lit(0))
    shared = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    target = F.when(F.col("full"), (most * F.col("source_size")).cast("double")).otherwise((F.col("weight") * spare).cast("double") / shared)
    return step.select("source", "source_size", "weight", target.alias("target"))


def copies(rank: Column, rate: Column, offset: Column) -> Column:
    """Whole numbers passed when the running sum of expected copies goes on by one document."""
    return (F.floor(rate * rank + offset) - F.floor(rate * (rank - 1) + offset)).cast("long")


def mix(docs: DataFrame, source: str, size: str, ties: list[Column], weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """How often the mix takes each row. Adds source_size, target and copies to the rows.

    All documents of a source have the same expected copies, target / source_size, at most ``most``. They are summed
    in order of size (so that each stretch of sizes is met in proportion, and the words taken come near the target),
    then by ``ties``; a random offset of the source is added, and a document is emitted for each whole number passed.
    The offset comes from a hash of seed and source, so that reruns agree. Sums run over ranges of rows, so a source
    may hold any part of them. Rows that tie throughout are interchangeable. A source of size 0 has target 0 and no
    copies. Null sources are a source.
    """
    names = [free_name(docs, f"tie{i}") for i in range(len(ties))]
    rows = docs.withColumns(dict(zip(names, ties, strict=True)))
    rank = free_name(rows, "rank_in_source")
    ranked = stored(running_rank(rows, [source], [size, *names], rank), "ranked")
    sizes = ranked.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    targets = stored(source_targets(sizes, weights, most), "targets")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))), 1, 5), 16, 10).cast("double") / F.lit(1048576.0)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.select(F.col("source").alias("of_source"), "source_size", "target", rate.alias("rate"), offset.alias("offset"))
    joined = ranked.join(targets, ranked[source].eqNullSafe(targets["of_source"]))
    return joined.select(*docs.columns, "source_size", "target", copies(F.col(rank), F.col("rate"), F.col("offset")).alias("copies"))


def tie_breaks(id_column: str, text_column: str, seed: str = SEED) -> list[Column]:
    """A fixed shuffle by id, then by text."""
    return [
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))),
        F.coalesce(F.md5(F.col(text_column)), F.lit("")),
    ]


def mix_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Number of words, size and target of its source, and words taken, for each document. Null texts have no words."""
    rows = docs.select(
        F.col(id_column).alias("id_value"),
        F.col(source_column).alias("source_value"),
        word_count(text_column).alias("size_value"),
        *[t.alias(f"t{i}") for i, t in enumerate(tie_breaks(id_column, text_column))],
    )
    out = mix(rows, "source_value", "size_value", [F.col("t0"), F.col("t1")])
    return out.select(
        F.col("id_value").alias(id_column),
        F.col("size_value").alias("size"),
        "source_size",
        "target",
        (F.col("copies") * F.col("size_value")).alias("taken"),
        "copies",
    )


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The mix itself: each document as often as it is taken, with its columns as they are."""
    rows, row = numbered(docs)
    sized = rows.select(
        F.col(row).alias("row_value"),
        F.col(source_column).alias("source_value"),
        word_count(text_column).alias("size_value"),
        *[t.alias(f"t{i}") for i, t in enumerate(tie_breaks(id_column, text_column))],
    )
    times = mix(sized, "source_value", "size_value", [F.col("t0"), F.col("t1"), F.col("row_value")]).select(F.col("row_value").alias(row), "copies")
    n = free_name(rows, "copies")
    taken = rows.join(stored(times.where("copies > 0").withColumnRenamed("copies", n), "taken"), row)
    return taken.withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))).select(*docs.columns)
