"""Session helpers: settings for local runs, and the shared folder where lineage may be cut."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, name: str = "veritab", **settings) -> SparkSession:
    """A session for tests and benchmarks on one machine. On a cluster, use the session that is there."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.catalogImplementation", "in-memory")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# Settings a cluster run should have; partition counts follow the data through adaptive execution.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.session.timeZone": "UTC",
}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names; there is no other, as a folder of the driver is not seen by executors."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")


# The open scope of intermediate files; each thread and run has its own.
_SCOPE: ContextVar[list[str] | None] = ContextVar("veritab_scope", default=None)
# Files outside any scope, which go when the program ends.
_KEPT: dict[str, list[str]] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder. Its files go at the end of the open scope, or when the program ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    else:
        _keep(spark, path)
    return path


def materialise(df: DataFrame, name: str = "step") -> DataFrame:
    """Write a result to the shared folder and read it back.

    Later actions then start from files, so they neither repeat the work before it nor depend on
    the executors that did it.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, tasks: int = 64) -> DataFrame:
    """The rows dealt over so many tasks, or four a core if that is more, where files give fewer.

    A small file is one task, however much work its rows make.
    """
    tasks = max(tasks, 4 * df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def _remove(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def _keep(spark: SparkSession, path: str) -> None:
    """Results may still be read after the caller returns, so their files stay until the program ends."""
    app = spark.sparkContext.applicationId
    if app not in _KEPT:
        _KEPT[app] = []
        atexit.register(_end, spark, app)
    _KEPT[app].append(path)


def _end(spark: SparkSession, app: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone
        if spark.sparkContext.applicationId == app:
            _remove(spark, _KEPT.pop(app, []))


@contextmanager
def intermediate_files(spark: SparkSession):
    """Files that :func:`materialise` writes inside the block are removed at its end."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        _remove(spark, paths)
