"""Table configuration: what to compare, how, and within which limits."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from veritab.errors import ConfigError

# Fixed values.
AGGREGATE_TYPES = ("min", "max", "count", "sum", "avg", "mean", "mode", "stddev", "variance", "median")
REPORT_TYPES = ("schema", "data", "row", "all", "aggregate")
MIN_SAMPLE, MAX_SAMPLE = 50, 400
MIN_BUCKETS, MAX_BUCKETS = 2, 50

_OPENING, _CLOSING = '"[`', '"]`'


def plain_name(name: str) -> str:
    """Column name without the quotes of its system, in lower case."""
    name = name.strip()
    if len(name) > 1 and name[0] in _OPENING and name[-1] == _CLOSING[_OPENING.index(name[0])]:
        quote = name[-1]
        name = name[1:-1].replace(quote * 2, quote)
    return name.lower()


def quoted(name: str) -> str:
    """Column name as Spark SQL text."""
    return "`" + name.replace("`", "``") + "`"


def _names(values) -> tuple[str, ...]:
    return tuple(plain_name(v) for v in values or ())


@dataclass(frozen=True)
class Transformation:
    """SQL text per side that replaces a column; a side without text keeps the raw column."""

    column: str
    source: str | None = None
    target: str | None = None


@dataclass(frozen=True)
class ColumnThreshold:
    """Allowed difference source minus target. Bounds are numbers or, with a ``%`` sign, shares of the target."""

    column: str
    lower: str
    upper: str

    @property
    def percentage(self) -> bool:
        return "%" in str(self.lower) or "%" in str(self.upper)

    @property
    def bounds(self) -> tuple[float, float]:
        return tuple(float(str(b).replace("%", "")) for b in (self.lower, self.upper))


@dataclass(frozen=True)
class TableThreshold:
    """Allowed number of mismatching rows, or share of the source rows with a ``%`` sign."""

    lower: str
    upper: str
    model: str = "mismatch"

    def __post_init__(self):
        low, high = self.bounds
        if low < 0 or high < 0:
            raise ConfigError("table threshold bounds must not be negative")
        if low > high:
            raise ConfigError("lower table threshold is above the upper one")
        if self.model != "mismatch":
            raise ConfigError(f"unknown table threshold model: {self.model}")

    @property
    def percentage(self) -> bool:
        return "%" in str(self.lower) or "%" in str(self.upper)

    @property
    def bounds(self) -> tuple[int, int]:
        return tuple(int(str(b).replace("%", "")) for b in (self.lower, self.upper))


@dataclass(frozen=True)
class Sampling:
    """How the rows that explain a difference are picked."""

    method: str = "random"
    count: int = MIN_SAMPLE
    columns: tuple[str, ...] = ()
    buckets: int = MIN_BUCKETS
    seed: int = 100
    kind: str = "count"

    def __post_init__(self):
        if self.kind != "count":
            raise ConfigError("only sampling by row count is available")
        if self.method not in ("random", "stratified"):
            raise ConfigError(f"unknown sampling method: {self.method}")
        if self.method == "stratified" and (not self.columns or not self.buckets):
            raise ConfigError("stratified sampling needs columns and buckets")
        object.__setattr__(self, "columns", _names(self.columns))
        for name, low, high in (("count", MIN_SAMPLE, MAX_SAMPLE), ("buckets", MIN_BUCKETS, MAX_BUCKETS)):
            if not low <= int(getattr(self, name)) <= high:
                raise ConfigError(f"sampling {name} must be from {low} to {high}, not {getattr(self, name)}")
            object.__setattr__(self, name, int(getattr(self, name)))


@dataclass(frozen=True)
class Aggregate:
    """One aggregate function over some columns, for the whole table or per group."""

    type: str
    columns: tuple[str, ...]
    group_by: tuple[str, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "type", self.type.lower())
        if self.type not in AGGREGATE_TYPES:
            raise ConfigError(f"aggregate type {self.type!r} is not one of {', '.join(AGGREGATE_TYPES)}")
        object.__setattr__(self, "columns", _names(self.columns))
        object.__setattr__(self, "group_by", _names(self.group_by))


@dataclass(frozen=True)
class TableConfig:
    """A source table, a target table and how to compare them. Column names are *source* names."""

    source: str
    target: str
    keys: tuple[str, ...] = ()
    select: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    mapping: dict = field(default_factory=dict)
    transformations: tuple[Transformation, ...] = ()
    source_filter: str | None = None
    target_filter: str | None = None
    thresholds: tuple[ColumnThreshold, ...] = ()
    table_thresholds: tuple[TableThreshold, ...] = ()
    aggregates: tuple[Aggregate, ...] = ()
    sampling: Sampling = field(default_factory=Sampling)
    partition_column: str | None = None
    separator: str | None = None
    hash_algorithm: str = "sha256"

    def __post_init__(self):
        put = object.__setattr__
        put(self, "source", self.source.lower())
        put(self, "target", self.target.lower())
        for name in ("keys", "select", "drop"):
            put(self, name, _names(getattr(self, name)))
        put(self, "mapping", {plain_name(s): plain_name(t) for s, t in dict(self.mapping).items()})
        put(self, "transformations", tuple(replace(t, column=plain_name(t.column)) for t in self.transformations))
        put(self, "thresholds", tuple(replace(t, column=plain_name(t.column)) for t in self.thresholds))
        if self.partition_column:
            put(self, "partition_column", plain_name(self.partition_column))
        if self.hash_algorithm not in ("sha256", "md5"):
            raise ConfigError(f"unknown hash algorithm: {self.hash_algorithm}")

    def target_name(self, column: str) -> str:
        return self.mapping.get(column, column)

    def compared(self, columns) -> list[str]:
        """Compared columns out of the source's columns: the selected ones (all by default) without the dropped ones."""
        chosen = self.select or tuple(columns)
        return [c for c in chosen if c not in self.drop]

    def hash_columns(self, columns, report: str) -> list[str]:
        """Columns of the row hash, in an order that does not depend on the side.

        Threshold columns are left out of keyed reports, where they are compared on their own. The
        row report has no threshold step, so there they stay part of the hash.
        """
        aside = {t.column for t in self.thresholds} if report != "row" else set()
        chosen = (set(self.keys) | set(self.compared(columns))) - aside - set(self.drop)
        return sorted(chosen, key=str.lower)

    def transformation(self, column: str, side: str) -> str | None:
        for t in self.transformations:
            if t.column == column:
                return t.source if side == "source" else t.target
        return None


def check_report(report: str) -> str:
    report = report.lower()
    if report not in REPORT_TYPES:
        raise ConfigError(f"report type {report!r} is not one of {', '.join(REPORT_TYPES)}")
    return report
