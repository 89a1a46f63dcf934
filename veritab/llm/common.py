"""Helpers of the operators: stored intermediates, row numbers, words, and running counts of groups of any size."""

from __future__ import annotations

import contextlib
import ctypes
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritab.session import intermediate_files, materialise, shared_path

#: Words are runs of other characters than blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


#: Spark's setting for the bytes of rows that go to Python at once, and what holds while tables are stored here.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows go to Python in batches of a few MB, also where texts are long: 10,000 rows at once are held twice, by the
    executor and by its worker, whose memory they keep."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: later jobs start from files, whatever executors are lost."""
    with small_batches(df.sparkSession):
        return materialise(df, f"llm-{name}")


def step(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``build`` returns, stored; whatever else it stored is removed."""
    path = shared_path(spark, f"llm-{name}")
    with intermediate_files(spark):
        out = build()
        with small_batches(spark):
            out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def release() -> None:
    """Gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # systems with another C library
        ctypes.CDLL(None).malloc_trim(0)


def releasing(run: Callable) -> Callable:
    """A function for ``mapInArrow`` whose memory goes back to the system at its end: workers are used again by later tasks."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in itertools.chain([name], (f"{name}_{i}" for i in itertools.count())) if n.lower() not in taken)


def numbered(docs: DataFrame, name: str = "numbered") -> tuple[DataFrame, str]:
    """A stored copy of a table with a number for each row, and the number's column: rows may repeat, ids may be null."""
    row = free_name(docs, "row_number")
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def identified(docs: DataFrame, in_files: bool = False) -> tuple[DataFrame, str]:
    """A table with something that tells its rows apart, and its column.

    Rows as they lie in Parquet files (``in_files``, perhaps filtered) are known by file and place; other tables get a
    stored copy with numbers.
    """
    if in_files:
        row = free_name(docs, "row_number")
        place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
        with contextlib.suppress(AnalysisException):  # no rows of files after all
            return docs.select("*", place.alias(row)), row
    return numbered(docs)


def byte_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column in UTF-8; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit integers; every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_count(text: str | Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def running_rank(df: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """Rank from 1 in each group by a total order, for groups of any size.

    Rows are cut into ranges of (group, order), ranked inside a range, and shifted by the row counts of the
    ranges before. Ranges and their counts come from a stored table, so a retry sees the same cuts.
    """
    part = free_name(df, "range_id")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = stored(df.repartitionByRange(n, *group, *order).withColumn(part, F.spark_partition_id()), "ranges")
    counts = cut.groupBy(*group, part).agg(F.count(F.lit(1)).alias("rows_of_range"))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*group, part, F.coalesce(F.sum("rows_of_range").over(before), F.lit(0)).alias("rows_before"))
    inside = cut.withColumn(out, F.row_number().over(Window.partitionBy(*group, part).orderBy(*order)))
    on = [inside[c].eqNullSafe(shift[c]) for c in group] + [inside[part] == shift[part]]
    joined = inside.join(shift, on)
    return joined.select(*[inside[c] for c in df.columns], (inside[out] + shift["rows_before"]).alias(out))
