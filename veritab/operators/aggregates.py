"""Comparing grouped aggregates of two tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.config import Aggregate, TableConfig
from veritab.errors import ConfigError
from veritab.operators.canonical import column, lower_names, side_column, side_filter
from veritab.operators.quantiles import Percentile, exact_percentiles, modes

_ONE_PASS = {
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "sum": F.sum,
    "avg": F.avg,
    "mean": F.avg,
    "stddev": F.stddev_samp,
    "variance": F.var_samp,
}


@dataclass(frozen=True)
class Rule:
    """One aggregate of one column over one set of group columns."""

    type: str
    column: str
    group_by: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{self.type}_{self.column}"

    @property
    def text(self) -> str:
        return f"{self.name}_{'+__+'.join(self.group_by) if self.group_by else 'NA'}"

    @property
    def info(self) -> dict:
        return {
            "agg_type": self.type,
            "agg_column": self.column,
            "group_by_columns": ", ".join(sorted(self.group_by)) if self.group_by else None,
        }


def aggregate_rules(aggregates: list[Aggregate]) -> dict[tuple[str, ...], list[Rule]]:
    """Rules per set of group columns, without duplicates: each set needs one pass over the table."""
    sets: dict[tuple[str, ...], list[Rule]] = {}
    for aggregate in aggregates:
        group = tuple(sorted(aggregate.group_by))
        rules = sets.setdefault(group, [])
        for name in aggregate.columns:
            rule = Rule(aggregate.type, name, group)
            if rule not in rules:
                rules.append(rule)
    return dict(sorted(sets.items()))


def grouped_values(df: DataFrame, group, wanted: list[tuple[str, str, str]]) -> DataFrame:
    """Group columns plus one column per ``(type, column, output name)``. Works for groups of any size."""
    group = list(group)
    simple = [(t, c, n) for t, c, n in wanted if t in _ONE_PASS]
    heavy = [(t, c, n) for t, c, n in wanted if t not in _ONE_PASS]
    keys = [column(g) for g in group]
    result = df.groupBy(*keys).agg(
        *[_ONE_PASS[t](column(c)).alias(n) for t, c, n in simple], F.count(F.lit(1)).alias("__rows")
    )
    for kind, c, name in heavy:
        if kind == "median":
            part = exact_percentiles(df, group, c, {name: Percentile(0.5)})
        elif kind == "mode":
            part = modes(df, group, c, name)
        else:
            raise ConfigError(f"unknown aggregate: {kind}")
        if group:
            on = [f"__g{i}" for i in range(len(group))]
            part = part.toDF(*on, name)
            same = reduce(lambda a, b: a & b, [column(g).eqNullSafe(F.col(o)) for g, o in zip(group, on)])
            result = result.join(part, same, "left").drop(*on)
        else:
            # One row each: the scalar of the one becomes a column of the other.
            result = result.withColumn(name, part.select(name).scalar())
    return result.select(*keys, *[column(n) for _, _, n in wanted])


def aggregate_side(df: DataFrame, config: TableConfig, side: str, rules: list[Rule], source_columns=None) -> DataFrame:
    """``<side>_<type>_<column>`` per rule and ``<side>_group_by_<column>`` per group column."""
    df = side_filter(lower_names(df), config.source_filter if side == "source" else config.target_filter)
    group = list(rules[0].group_by)
    needed = sorted(set(group) | {r.column for r in rules})
    picked = df.select(*[side_column(df, config, side, c) for c in needed])
    values = grouped_values(picked, group, [(r.type, r.column, f"{side}_{r.name}") for r in rules])
    return values.withColumnsRenamed({g: f"{side}_group_by_{g}" for g in group})


def join_aggregates(source: DataFrame, target: DataFrame, config: TableConfig, rules: list[Rule]) -> DataFrame:
    """Both sides' aggregates next to each other, with ``in_source`` / ``in_target`` markers.

    Each side has one row per group, so the null-safe full join stays as large as the groups; without
    groups each side is a single row.
    """
    left = aggregate_side(source, config, "source", rules).withColumn("in_source", F.lit(True))
    right = aggregate_side(target, config, "target", rules).withColumn("in_target", F.lit(True))
    group = rules[0].group_by
    if not group:
        return left.join(right, F.col("in_source") == F.col("in_target"), "full")
    same = reduce(
        lambda a, b: a & b,
        [column(f"source_group_by_{g}").eqNullSafe(column(f"target_group_by_{g}")) for g in group],
    )
    return left.join(right, same, "full")


def compare_rule(joined: DataFrame, rule: Rule) -> DataFrame:
    """One row per group with its class for this rule; values that differ by NULL are a mismatch as well."""
    s, t = column(f"source_{rule.name}"), column(f"target_{rule.name}")
    group = list(rule.group_by)
    same = s.eqNullSafe(t)
    label = (
        F.when(F.col("in_source").isNull(), "missing_in_src")
        .when(F.col("in_target").isNull(), "missing_in_tgt")
        .when(~same, "mismatch")
        .otherwise("match")
    )
    both = F.col("in_source").isNotNull() & F.col("in_target").isNotNull()
    return joined.select(
        *[column(f"{side}_group_by_{g}") for g in group for side in ("source", "target")],
        s,
        t,
        F.when(both, same).alias(f"match_{rule.name}"),
        F.when(both, same).alias("agg_data_match"),
        label.alias("class"),
    )


def compare_aggregates(source: DataFrame, target: DataFrame, config: TableConfig):
    """``[(rule, compared DataFrame), ...]``; rules with the same groups share one aggregation and one join."""
    if not config.aggregates:
        raise ConfigError("no aggregates are configured")
    out = []
    for rules in aggregate_rules(list(config.aggregates)).values():
        joined = join_aggregates(source, target, config, rules)
        out += [(rule, compare_rule(joined, rule)) for rule in rules]
    return out


def rule_counts(joined: DataFrame, rules: list[Rule]) -> DataFrame:
    """Mismatch and missing counts of all rules of one join in a single pass: one row per rule."""
    entries = []
    for r in rules:
        s, t = column(f"source_{r.name}"), column(f"target_{r.name}")
        both = F.col("in_source").isNotNull() & F.col("in_target").isNotNull()
        entries.append((r.text, both & ~s.eqNullSafe(t)))
    counted = joined.agg(
        F.count_if(F.col("in_source").isNull()).alias("missing_in_src"),
        F.count_if(F.col("in_target").isNull()).alias("missing_in_tgt"),
        *[F.count_if(wrong).alias(f"m{i}") for i, (_, wrong) in enumerate(entries)],
    )
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(text).alias("rule"),
                        F.col(f"m{i}").alias("mismatch"),
                        F.col("missing_in_src"),
                        F.col("missing_in_tgt"),
                    )
                    for i, (text, _) in enumerate(entries)
                ]
            )
        )
    )


