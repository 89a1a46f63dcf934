"""Samples that explain a difference; every one has a seed or an order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.config import MAX_SAMPLE, MIN_SAMPLE, Sampling
from veritab.errors import ConfigError
from veritab.operators.canonical import column
from veritab.session import materialise

SHOWN_ROWS = 50


def checked(n: int | None) -> int:
    """The size of a sample; a size outside the range is an error, none at all is the least."""
    n = MIN_SAMPLE if n is None else int(n)
    if not MIN_SAMPLE <= n <= MAX_SAMPLE:
        raise ConfigError(f"a sample has from {MIN_SAMPLE} to {MAX_SAMPLE} rows, not {n}")
    return n


def sample_random(df: DataFrame, n: int | None, total: int, seed: int = 100) -> DataFrame:
    """About ``n`` of ``total`` rows, never more than ``n`` (50 to 400); may give fewer."""
    n = checked(n)
    fraction = min(1.0, n / total) if total else 1.0
    return df.sample(fraction=fraction, seed=seed).limit(n)


def stratum(columns, buckets: int):
    """Bucket of a row by the hash of its columns."""
    return F.pmod(F.abs(F.hash(*[column(c) for c in columns]).cast("long")), F.lit(int(buckets)))


def sample_stratified(keys_df: DataFrame, target: DataFrame, keys, sampling: Sampling) -> DataFrame:
    """Key rows, the same share of every bucket of the stratified columns, at most ``sampling.count`` rows.

    Keys are matched as they are compared, so NULL equals NULL. ``target`` has the source's names. Every bucket that
    holds keys gives one at least. Bucket sizes (at most 50 rows) are the only data that reach the driver. Target
    rows of a key fold to their distinct bucket columns before the join.
    """
    keys = list(keys)
    extra = [c for c in sampling.columns if c not in keys]
    known = target.select(*[column(c) for c in keys + extra]).distinct()
    names = [f"__k{i}" for i in range(len(keys))]
    known = known.toDF(*names, *extra)
    wanted = keys_df.select(*[column(k) for k in keys]).distinct()
    condition = reduce(lambda a, b: a & b, [column(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    joined = wanted.join(known, condition, "inner").withColumn("bucket", stratum(sampling.columns, sampling.buckets))
    # A key whose target rows lie in several buckets counts in the first.
    joined = joined.groupBy(*[column(k) for k in keys]).agg(F.min("bucket").alias("bucket"))
    # The rows of least hash of each bucket: the same ones for the same seed, whatever the partitions. Each task keeps
    # as many of a bucket as the whole sample may have, so what meets per bucket does not grow with its rows.
    mark = F.xxhash64(F.lit(sampling.seed), *[column(k) for k in keys])
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(mark, *[column(k) for k in keys]))
    first = materialise(joined.withColumn("place", place).where(F.col("place") <= sampling.count), "strata")
    sizes = {r["bucket"]: r["n"] for r in first.groupBy("bucket").agg(F.max("place").alias("n")).collect()}
    left, limit = sampling.count, F.lit(0)
    for i, (b, n) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        share = min(n, max(1, left // (len(sizes) - i)))
        limit = F.when(F.col("bucket") == b, share).otherwise(limit)
        left -= share
    return first.where(F.col("place") <= limit).select(*[column(k) for k in keys])


def sample_keys(mismatch: DataFrame, total: int, keys, sampling: Sampling, target: DataFrame | None = None) -> DataFrame:
    """Sample by configuration; random is the default."""
    if sampling.method == "stratified" and target is not None:
        return sample_stratified(mismatch, target, keys, sampling)
    return sample_random(mismatch.select(*[column(k) for k in keys]), sampling.count, total, sampling.seed)


def sample_share(df: DataFrame, percent: float, seed: int) -> DataFrame:
    """Table sample: a percentage of rows with a fixed seed."""
    return df.sample(fraction=percent / 100.0, seed=seed)


def shown_rows(df: DataFrame, order, n: int = SHOWN_ROWS) -> DataFrame:
    """The first rows of a difference set in key order: what a report shows."""
    return df.orderBy(*[column(c) for c in order]).limit(n)
