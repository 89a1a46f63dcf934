"""Reconciling tables end to end: compare, explain, store, and give a verdict."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.config import MAX_SAMPLE, TableConfig, check_report
from veritab.errors import ConfigError, ReconcileFailed
from veritab.operators.aggregates import aggregate_rules, compare_rule, join_aggregates, rule_counts
from veritab.operators.canonical import column, comparable, lower_names, side_column, side_filter
from veritab.operators.compare import (
    class_counts,
    fetch_by_keys,
    match_keys,
    mismatching_columns,
    one_sided_hashes,
    plain_rows,
    rows_of_hashes,
    side_by_side,
)
from veritab.operators.sampling import SHOWN_ROWS, sample_keys, shown_rows
from veritab.operators.schemas import compare_schema, schema_is_valid, table_schema
from veritab.operators.thresholds import threshold_compare, threshold_failures, within_table_threshold
from veritab.plans import results
from veritab.session import intermediate_files, materialise
from veritab.sources.scans import record_count


@dataclass
class TableOutcome:
    """Numbers of one table pair, its whole difference sets, and the bounded rows that show them."""

    config: TableConfig
    report: str
    source_count: int = 0
    target_count: int = 0
    match: int = 0
    mismatch: int = 0
    missing_in_src: int = 0
    missing_in_tgt: int = 0
    threshold_mismatch: int = 0
    duplicate_keys: int = 0
    mismatched_keys: int = 0
    mismatch_columns: dict[str, int] = field(default_factory=dict)  # with the rows that differ in each
    schema_valid: bool = True
    exception: str | None = None
    samples: dict[str, DataFrame] = field(default_factory=dict)
    differences: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def numbers(self) -> dict:
        within = self.mismatch + self.threshold_mismatch == 0
        if not within and self.config.table_thresholds:
            within = self._within()
        return {
            "report": self.report,
            "source_count": self.source_count,
            "target_count": self.target_count,
            "missing_in_src": self.missing_in_src,
            "missing_in_tgt": self.missing_in_tgt,
            "mismatch": self.mismatch,
            "threshold_mismatch": self.threshold_mismatch,
            "mismatch_columns": list(self.mismatch_columns),
            "schema_valid": self.schema_valid,
            "within_threshold": within,
            "exception": self.exception,
        }

    def _within(self) -> bool:
        spark = SparkSession.active()
        allowed = within_table_threshold(
            F.lit(self.mismatch), F.lit(self.threshold_mismatch), F.lit(self.source_count), self.config.table_thresholds
        )
        return spark.range(1).select(allowed).first()[0]


def key_totals(matched: DataFrame) -> DataFrame:
    """All counts of a keyed report in one pass over the matched keys."""
    src, tgt = (F.col(c).cast("decimal(19,0)") for c in ("src_rows", "tgt_rows"))
    return matched.agg(
        F.sum("src_rows").alias("source_count"),
        F.sum("tgt_rows").alias("target_count"),
        F.sum("match_pairs").alias("match"),
        F.sum((src * tgt).cast("decimal(38,0)") - F.col("match_pairs")).alias("mismatch"),
        F.sum(F.when(src == 0, F.col("tgt_rows"))).alias("missing_in_src"),
        F.sum(F.when(tgt == 0, F.col("src_rows"))).alias("missing_in_tgt"),
        F.count_if((src > 1) | (tgt > 1)).alias("duplicate_keys"),
        F.count_if(_differs()).alias("mismatched_keys"),
    )


def _differs():
    return (F.col("src_rows") > 0) & (F.col("tgt_rows") > 0) & (
        F.col("match_pairs") < F.col("src_rows").cast("decimal(19,0)") * F.col("tgt_rows").cast("decimal(19,0)")
    )


def reconcile_table(
    source: DataFrame, target: DataFrame, config: TableConfig, report: str = "data", system: str = "default"
) -> TableOutcome:
    """Compare one table pair.

    The keyed report reads both tables once for the counts; the matched keys go to the shared folder because
    several difference sets start from them. Differences are whole tables in that folder, samples are views of them.
    """
    report = check_report(report)
    if report == "aggregate":
        raise ConfigError("aggregates are compared by reconcile_aggregates")
    out = TableOutcome(config, report)
    source, target = lower_names(source), lower_names(target)
    if report in ("schema", "all"):
        compared = compare_schema(
            table_schema(source), table_schema(target), config, None if system == "default" else system
        )
        out.schema_valid = schema_is_valid(compared).first()[0]
        out.samples["schema"] = compared
    if report in ("data", "all"):
        _keyed(out, source, target, config, system)
    elif report == "row":
        _by_row(out, source, target, config, system)
    return out


def _keyed(out: TableOutcome, source: DataFrame, target: DataFrame, config: TableConfig, system: str) -> None:
    names = source.columns
    matched = match_keys(
        comparable(source, config, "source", "data", names, system),
        comparable(target, config, "target", "data", names, system),
        config.keys,
    )
    matched = materialise(matched, "matched")
    totals = key_totals(matched).first().asDict()
    for name, value in totals.items():
        setattr(out, name, int(value or 0))
    keys = [column(k) for k in config.keys]
    unique = out.duplicate_keys == 0
    if out.mismatch:
        differing = materialise(matched.filter(_differs()).select(*keys), "differing")
        captured = materialise(
            side_by_side(
                fetch_by_keys(plain_rows(source, config, "source", names), differing, config.keys),
                fetch_by_keys(plain_rows(target, config, "target", names), differing, config.keys),
                config.keys,
                unique,
            ),
            "captured",
        )
        out.mismatch_columns = {
            r["column_name"]: r["rows"] for r in mismatching_columns(captured).filter("differs").collect()
        }
        out.differences["mismatch"] = captured
        strata = stratum_rows(target, config) if config.sampling.method == "stratified" else None
        picked = materialise(sample_keys(differing, out.mismatched_keys, config.keys, config.sampling, strata), "sample")
        out.samples["mismatch"] = shown_rows(fetch_by_keys(captured, picked, config.keys), config.keys, MAX_SAMPLE)
    for kind, side, table, empty in (
        ("missing_in_source", "target", target, "src_rows"),
        ("missing_in_target", "source", source, "tgt_rows"),
    ):
        if out.missing_in_src if kind == "missing_in_source" else out.missing_in_tgt:
            wanted = materialise(matched.filter(f"{empty} = 0").select(*keys), "missing")
            rows = materialise(fetch_by_keys(plain_rows(table, config, side, names), wanted, config.keys), "missing-rows")
            out.differences[kind] = rows
            out.samples[kind] = shown_rows(rows, config.keys)
    if config.thresholds:
        failing = materialise(threshold_failures(threshold_compare(source, target, config, unique)), "threshold")
        out.threshold_mismatch = int(failing.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])
        if out.threshold_mismatch:
            out.differences["threshold_mismatch"] = failing.drop("rows")
            out.samples["threshold_mismatch"] = shown_rows(failing.drop("rows"), config.keys)


def stratum_rows(target: DataFrame, config: TableConfig) -> DataFrame:
    """Target rows under their source names, with the keys as they are compared: what stratified samples are drawn by."""
    filtered = side_filter(target, config.target_filter)
    extra = [c for c in config.sampling.columns if c not in config.keys]
    return filtered.select(*[side_column(filtered, config, "target", c) for c in (*config.keys, *extra)])


def _by_row(out: TableOutcome, source: DataFrame, target: DataFrame, config: TableConfig, system: str) -> None:
    names = source.columns
    left = comparable(source, config, "source", "row", names, system)
    right = comparable(target, config, "target", "row", names, system)
    hashes = materialise(one_sided_hashes(left, right), "hashes")
    rows = materialise(rows_of_hashes(left, right, hashes), "rows")
    found = {r["class"]: int(r["rows"]) for r in class_counts(rows).collect()}
    out.missing_in_src, out.missing_in_tgt = found.get("missing_in_src", 0), found.get("missing_in_tgt", 0)
    sizes = record_count(source, target, config.source_filter, config.target_filter).first()
    out.source_count, out.target_count = sizes["source_count"], sizes["target_count"]
    shown = [c for c in rows.columns if c not in ("class", "rows")]
    for kind, label in (("missing_in_source", "missing_in_src"), ("missing_in_target", "missing_in_tgt")):
        if found.get(label):
            picked = rows.filter(F.col("class") == label).select(*[column(c) for c in shown])
            out.differences[kind] = picked
            out.samples[kind] = shown_rows(picked, shown, SHOWN_ROWS)


@dataclass(frozen=True)
class Place:
    """Where tables live: the names that go into result rows."""

    source_catalog: str | None
    source_schema: str
    target_catalog: str
    target_schema: str
    source_type: str = "spark"

    def of(self, config: TableConfig):
        return (
            (self.source_catalog, self.source_schema, config.source),
            (self.target_catalog, self.target_schema, config.target),
        )


def _now():
    return datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)


def _main_row(spark, recon_id, place, config, report, operation, started, ended) -> DataFrame:
    source, target = place.of(config)
    run = {
        "recon_id": recon_id,
        "source_type": place.source_type,
        "source": source,
        "target": target,
        "report_type": report,
        "operation_name": operation,
        "start_ts": started,
        "end_ts": ended,
    }
    return results.main_rows(spark, [run])


def outcome_rows(
    spark: SparkSession, outcome: TableOutcome, recon_id: str, place: Place, user: str, started, ended
) -> dict[str, DataFrame]:
    """Result rows of one table, per result table."""
    main = _main_row(spark, recon_id, place, outcome.config, outcome.report, "reconcile", started, ended)
    tid = main.first()["recon_table_id"]
    rows = {"main": main, "metrics": results.metrics_row(spark, tid, outcome.numbers, user, ended)}
    kinds = ("mismatch", "missing_in_source", "missing_in_target", "threshold_mismatch", "schema")
    details = [
        results.details_row(
            outcome.samples[k], tid, k, outcome.schema_valid if k == "schema" else False, ended
        )
        for k in kinds
        if k in outcome.samples
    ]
    if details:
        rows["details"] = details[0]
        for d in details[1:]:
            rows["details"] = rows["details"].unionByName(d)
    whole = [results.difference_rows(df, tid, k, ended) for k, df in outcome.differences.items()]
    if whole:
        rows["differences"] = reduce(DataFrame.unionByName, whole)
    return rows


Read = Callable[[TableConfig], tuple[DataFrame, DataFrame]]
Store = Callable[[str, DataFrame], None]


def reconcile_all(
    spark: SparkSession,
    configs: list[TableConfig],
    read: Read,
    store: Store,
    place: Place,
    report: str = "data",
    recon_id: str | None = None,
    user: str = "unknown",
    system: str = "default",
    at_once: int = 4,
) -> str:
    """Compare every table pair and store its rows; a table that fails is stored with its error, the others go on.

    ``read`` gives the two DataFrames of a table, ``store`` takes a result-table name and writes its rows. ``at_once``
    table pairs are compared at a time; ``store`` is called for one at a time, as appends of files must not meet.
    Whatever fails for a pair, also while its rows are stored, is recorded in its run and metrics rows, which come
    last. The intermediate files of a table are removed once its rows are stored.
    """
    report = check_report(report)
    recon_id = recon_id or str(uuid.uuid4())
    store = _one_at_a_time(store)

    def pair(config: TableConfig) -> None:
        started = _now()
        with intermediate_files(spark):
            try:
                outcome = reconcile_table(*read(config), config, report, system)
                rows = outcome_rows(spark, outcome, recon_id, place, user, started, _now())
                for table in ("differences", "details"):
                    if table in rows:
                        store(table, rows[table])
            except Exception as e:
                outcome = TableOutcome(config, report, exception=str(e) or type(e).__name__)
            rows = outcome_rows(spark, outcome, recon_id, place, user, started, _now())
            for table in ("metrics", "main"):
                store(table, rows[table])

    _each_at_once(spark, pair, configs, at_once)
    return recon_id


def _one_at_a_time(store: Store) -> Store:
    lock = Lock()

    def locked(table: str, rows: DataFrame) -> None:
        with lock:
            store(table, rows)

    return locked


def _each_at_once(spark: SparkSession, work: Callable[[TableConfig], None], configs: list[TableConfig], at_once: int) -> None:
    """Run table pairs in a few threads of the driver, which only wait for Spark; the first error is raised when all are done."""
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(partial(work, config))) for config in configs]
    for r in running:
        r.result()


def reconcile_aggregates(
    spark: SparkSession,
    configs: list[TableConfig],
    read: Read,
    store: Store,
    place: Place,
    recon_id: str | None = None,
    user: str = "unknown",
    at_once: int = 4,
) -> str:
    """Compare the configured aggregates of every table pair; one aggregation per side and set of group columns."""
    recon_id = recon_id or str(uuid.uuid4())
    for config in configs:
        if not config.aggregates:
            raise ConfigError(f"no aggregates are configured for {config.source}")
    store = _one_at_a_time(store)

    def pair(config: TableConfig) -> None:
        with intermediate_files(spark):
            _aggregate_table(spark, config, read, store, place, recon_id, user)

    _each_at_once(spark, pair, configs, at_once)
    return recon_id


def _aggregate_table(spark, config: TableConfig, read: Read, store: Store, place: Place, recon_id: str, user: str) -> None:
    sets = aggregate_rules(list(config.aggregates))
    started = _now()

    def main():
        return _main_row(spark, recon_id, place, config, "aggregate", "aggregates-reconcile", started, _now())

    tid = main().first()["recon_table_id"]
    for rules in sets.values():
        now = _now()
        store("aggregate_rules", results.aggregate_rule_rows(spark, tid, rules, now))
        try:
            joined = materialise(join_aggregates(*read(config), config, rules), "aggregates")
            counts = materialise(rule_counts(joined, rules), "rules")
            found = {r["rule"]: r for r in counts.collect()}
            for rule in rules:
                details, differences = aggregate_details(joined, rule, found[rule.text], tid, now)
                if details is not None:
                    store("aggregate_differences", differences)
                    store("aggregate_details", details)
        except Exception as e:
            message = str(e) or type(e).__name__
            store("aggregate_metrics", results.failed_rule_rows(spark, tid, rules, message, user, now))
            continue
        store("aggregate_metrics", results.aggregate_metrics_rows(counts, tid, user, now))
    store("main", main())


def aggregate_details(joined: DataFrame, rule, found, recon_table_id: int, inserted) -> tuple[DataFrame | None, DataFrame | None]:
    """Groups of a rule that differ, or that one side lacks: up to three rows that show the first of them, and all of them."""
    compared = compare_rule(joined, rule)
    parts, whole = [], []
    kinds = (
        ("mismatch", "mismatch", lambda c: True),
        ("missing_in_src", "missing_in_source", lambda c: c.startswith("target_")),
        ("missing_in_tgt", "missing_in_target", lambda c: c.startswith("source_")),
    )
    for label, kind, wanted in kinds:
        if not found[label]:
            continue
        shown = [c for c in compared.columns if c != "class" and wanted(c)]
        order = [c for c in shown if "_group_by_" in c] or shown[:1]
        rows = compared.filter(F.col("class") == label).select(*[column(c) for c in shown])
        parts.append(results.details_row(shown_rows(rows, order), recon_table_id, kind, False, inserted))
        whole.append(results.difference_rows(rows, recon_table_id, kind, inserted))
    if not parts:
        return None, None
    rid = results.rule_id(F.col("recon_table_id"), F.lit(rule.text))
    details, differences = (
        reduce(DataFrame.unionByName, p).select("recon_table_id", rid.alias("rule_id"), "recon_type", "data", "inserted_ts")
        for p in (parts, whole)
    )
    return details, differences


def final_status(main: DataFrame, metrics: DataFrame, recon_id: str | None = None) -> DataFrame:
    """Per table: is the row, column and schema comparison fine? NULL where it is not part of the report or failed."""
    joined = main.join(metrics, "recon_table_id")
    if recon_id:
        joined = joined.filter(F.col("recon_id") == recon_id)
    rows, cols = F.col("recon_metrics.row_comparison"), F.col("recon_metrics.column_comparison")
    kind = F.lower("report_type")
    message = F.col("run_metrics.exception_message")
    fine = F.coalesce(message, F.lit("")) == ""

    def part(kinds, good):
        return F.when(fine & kind.isin(*kinds), F.coalesce(good, F.lit(False)))

    return joined.select(
        "recon_id",
        results.dotted(F.col("source_table")).alias("source_table"),
        results.dotted(F.col("target_table")).alias("target_table"),
        part(("all", "row", "data"), (rows["missing_in_source"] == 0) & (rows["missing_in_target"] == 0)).alias("row"),
        part(
            ("all", "data"),
            F.col("run_metrics.status")
            | (
                (cols["absolute_mismatch"] == 0)
                & (cols["threshold_mismatch"] == 0)
                & (cols["mismatch_columns"] == "")
            ),
        ).alias("column"),
        part(("all", "schema"), F.col("recon_metrics.schema_comparison")).alias("schema"),
        message.alias("exception_message"),
    )


def final_aggregate_status(main: DataFrame, metrics: DataFrame, recon_id: str | None = None) -> DataFrame:
    """Per table: do all rules hold? With the distinct error texts."""
    joined = main.filter("operation_name = 'aggregates-reconcile'").join(metrics, "recon_table_id")
    if recon_id:
        joined = joined.filter(F.col("recon_id") == recon_id)
    message = F.nullif(F.col("run_metrics.exception_message"), F.lit(""))
    return joined.groupBy(
        "recon_id",
        results.dotted(F.col("source_table")).alias("source_table"),
        results.dotted(F.col("target_table")).alias("target_table"),
    ).agg(
        F.every(F.coalesce(F.col("run_metrics.status"), F.lit(False))).alias("status"),
        F.array_join(F.sort_array(F.collect_set(message)), "\n").alias("exception_message"),
    )


def run_summary(status: DataFrame) -> DataFrame:
    """Tables, errors, tables with differences, and successes."""
    failed = F.coalesce(F.col("exception_message"), F.lit("")) != ""
    verdicts = [c for c in ("row", "column", "schema", "status") if c in status.columns]
    differs = F.lit(False)
    for v in verdicts:
        differs = differs | ~F.coalesce(F.col(v), F.lit(True))
    totals = status.agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if(failed).alias("exceptions"),
        F.count_if(~failed & differs).alias("mismatched"),
    )
    return totals.withColumn("succeeded", F.col("tables") - F.col("exceptions") - F.col("mismatched"))


def verify(status: DataFrame) -> DataFrame:
    """The status, or an error that carries it when a table failed."""
    summary = run_summary(status).first()
    if summary["exceptions"]:
        raise ReconcileFailed(f"{summary['exceptions']} of {summary['tables']} tables ended with an error", status)
    return status


