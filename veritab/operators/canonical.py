"""Projection to comparable columns, canonical text forms and the row hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.config import TableConfig, quoted
from veritab.errors import ConfigError

# Fixed values.
NULL_MARK = "_null_recon_"
HASH_COLUMN = "hash_value_recon"
SQLSERVER_FORMS = {
    "date": ("MM/dd/yyyy", "1900-01-01"),
    "time": ("HH:mm:ss", "00:00:00"),
    "datetime": ("yyyy-MM-dd HH:mm:ss", "1900-01-01 00:00:00"),
}


def column(name: str) -> Column:
    """Column by its literal name, whatever characters it holds."""
    return F.col(quoted(name))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def select_columns(df: DataFrame, config: TableConfig, side: str = "source", source_columns=None) -> DataFrame:
    """Compared columns under their source names."""
    names = config.compared(source_columns or df.columns)
    pick = config.target_name if side == "target" else (lambda c: c)
    return df.select(*[column(pick(c)).alias(c) for c in names])


def drop_columns(df: DataFrame, names) -> DataFrame:
    return df.drop(*[c for c in df.columns if c in set(names)])


def map_columns(df: DataFrame, mapping: dict) -> DataFrame:
    """Target columns under their source names; names without a mapping pass through."""
    return df.withColumnsRenamed({target: source for source, target in mapping.items()})


def side_filter(df: DataFrame, predicate: str | None) -> DataFrame:
    return df.filter(F.expr(predicate)) if predicate else df


def text_form(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")), F.lit(NULL_MARK))


def _marked(text: Column) -> Column:
    """A text as a part of a list: commas and backslashes get a backslash, an empty text is ``\\e``."""
    escaped = F.regexp_replace(text, r"([,\\])", r"\\$1")
    return F.when(text == "", "\\e").otherwise(escaped)


def nested_form(c: Column, data_type: T.DataType) -> Column:
    """Text of a value of any type, which tells all values of the type apart, but for the order of an array.

    Parts of arrays, maps and structs are separated by commas, with those inside a part marked, on every level.
    NULL parts of arrays are left out, as are maps' NULL values; a NULL field of a struct is ``\\n``.
    """
    if isinstance(data_type, T.ArrayType):
        parts = F.transform(c, lambda x: _marked(nested_form(x, data_type.elementType)))
        return F.concat_ws(",", F.sort_array(parts))
    if isinstance(data_type, T.MapType):
        entry = T.StructType([T.StructField("key", data_type.keyType), T.StructField("value", data_type.valueType)])
        return nested_form(F.map_entries(c), T.ArrayType(entry))
    if isinstance(data_type, T.StructType):
        # A field of a NULL struct is NULL, so it has to be asked for first.
        parts = [F.coalesce(_marked(nested_form(c.getField(f.name), f.dataType)), F.lit("\\n")) for f in data_type.fields]
        return F.when(c.isNotNull(), F.concat_ws(",", *parts))
    return c.cast("string")


def array_form(c: Column, data_type: T.ArrayType | None = None) -> Column:
    """Sorted, comma-separated, borders kept. A NULL array reads like an empty one."""
    element = data_type.elementType if data_type is not None else T.StringType()
    return nested_form(c if data_type is not None else c.cast("array<string>"), T.ArrayType(element))


def time_form(c: Column, kind: str) -> Column:
    fmt, empty = SQLSERVER_FORMS[kind]
    return F.coalesce(F.date_format(c, fmt), F.lit(empty))


def canonical(c: Column, data_type: T.DataType, system: str = "default") -> Column:
    """Text form of a column, chosen by its type.

    The form is chosen once per table pair and used on both sides, so that a source system's own
    date layout can never make equal values differ.
    """
    if isinstance(data_type, T.ArrayType):
        return array_form(c, data_type)
    if isinstance(data_type, (T.MapType, T.StructType)):
        return F.coalesce(nested_form(c, data_type), F.lit(NULL_MARK))
    if system == "sqlserver":
        if isinstance(data_type, T.DateType):
            return time_form(c, "date")
        if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
            return time_form(c, "datetime")
    return text_form(c)


def side_column(df: DataFrame, config: TableConfig, side: str, name: str) -> Column:
    """A column of one side under its source name, with the user's expression when there is one."""
    text = config.transformation(name, side)
    if text:
        return F.expr(text).alias(name)
    return column(config.target_name(name) if side == "target" else name).alias(name)


def canonical_column(df: DataFrame, config: TableConfig, side: str, name: str, system: str = "default") -> Column:
    """User expression first; then the form of the column's type. User expressions get no further rule."""
    if any(t.column == name for t in config.transformations):
        return side_column(df, config, side, name).cast("string").alias(name)
    physical = config.target_name(name) if side == "target" else name
    if physical not in df.columns:
        raise ConfigError(f"column {physical!r} is not part of the {side} table")
    return canonical(column(physical), df.schema[physical].dataType, system).alias(name)


def digest(columns: list[Column], algorithm: str = "sha256", separator: str | None = None) -> Column:
    """Hash of texts; never NULL.

    Each text comes with its length, and a NULL as a mark of its own, so two rows hash alike only if all their texts
    agree. With a separator (it may be empty) the texts are joined as other systems lay them out, and a NULL reads
    like ``NULL_MARK``; then borders may move, 'ab' + 'c' and 'a' + 'bc' hash alike without a separator.
    """
    if separator is None:
        text = F.concat(*[F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("n")) for c in columns])
    else:
        text = F.array_join(F.array(*columns), separator, NULL_MARK)
    return F.md5(text) if algorithm == "md5" else F.sha2(text, 256)


def row_hash(df: DataFrame, config: TableConfig, side: str, names: list[str], system: str = "default") -> Column:
    columns = [canonical_column(df, config, side, n, system) for n in names]
    return digest(columns, config.hash_algorithm, config.separator).alias(HASH_COLUMN)


def comparable(
    df: DataFrame, config: TableConfig, side: str, report: str = "data", source_columns=None, system: str = "default"
) -> DataFrame:
    """Filter, then hash and key columns only: this is all that a comparison has to shuffle."""
    df = side_filter(lower_names(df), config.source_filter if side == "source" else config.target_filter)
    source_columns = source_columns or (
        df.columns if side == "source" else [_source_name(config, c) for c in df.columns]
    )
    names = config.hash_columns(source_columns, report)
    if report == "row":
        shown = names
    else:
        if not config.keys:
            raise ConfigError(f"join columns are needed for the {report} report")
        extra = {config.partition_column} if config.partition_column and side == "source" else set()
        shown = sorted(set(config.keys) | extra)
    return df.select(
        row_hash(df, config, side, names, system), *[side_column(df, config, side, n) for n in shown]
    )


def _source_name(config: TableConfig, target_column: str) -> str:
    for source, target in config.mapping.items():
        if target == target_column:
            return source
    return target_column


def checksum(columns, separator: str = "|") -> Column:
    """Row checksum column: MD5 of the separated texts; NULLs are skipped."""
    return F.md5(F.concat_ws(separator, *[c.cast("string") for c in columns]))
