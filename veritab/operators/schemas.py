"""Column metadata as tables: reading schemas, rendering type text, comparing two schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.config import TableConfig

SCHEMA_FIELDS = "column_name string, data_type string"

# Plain type names of each system and the type they become.
TYPE_EQUIVALENTS = {
    "snowflake": {
        "varchar": "string", "char": "string", "character": "string", "string": "string", "text": "string",
        "nvarchar": "string", "nchar": "string", "binary": "binary", "varbinary": "binary",
        "number": "decimal(38,0)", "numeric": "decimal(38,0)", "decimal": "decimal(38,0)",
        "int": "decimal(38,0)", "integer": "decimal(38,0)", "bigint": "decimal(38,0)",
        "smallint": "decimal(38,0)", "tinyint": "decimal(38,0)", "byteint": "decimal(38,0)",
        "float": "double", "float4": "double", "float8": "double", "double": "double", "real": "double",
        "boolean": "boolean", "date": "date", "time": "timestamp", "datetime": "timestamp",
        "timestamp": "timestamp", "timestamp_ntz": "timestamp_ntz", "timestamp_ltz": "timestamp",
        "timestamp_tz": "timestamp", "variant": "variant", "object": "string", "array": "array",
        "geography": "string",
    },
    "oracle": {
        "varchar2": "string", "nvarchar2": "string", "char": "string", "nchar": "string", "clob": "string",
        "nclob": "string", "long": "string", "rowid": "string", "urowid": "string", "xmltype": "string",
        "anytype": "string", "anydata": "string", "anydataset": "string", "sdo_geometry": "string",
        "number": "decimal(38,0)", "float": "double", "binary_float": "double", "binary_double": "double",
        "date": "date", "timestamp": "timestamp", "raw": "binary", "blob": "binary",
    },
    "sqlserver": {
        "varchar": "string", "nvarchar": "string", "char": "string", "nchar": "string", "text": "string",
        "ntext": "string", "uniqueidentifier": "string", "xml": "string", "int": "int", "bigint": "bigint",
        "smallint": "smallint", "tinyint": "smallint", "bit": "boolean", "float": "double", "real": "float",
        "money": "decimal(15,4)", "smallmoney": "decimal(6,4)", "date": "date", "time": "timestamp",
        "datetime": "timestamp", "datetime2": "timestamp", "smalldatetime": "timestamp",
        "datetimeoffset": "timestamp", "timestamp": "binary", "binary": "binary", "varbinary": "binary",
        "image": "binary", "double": "double", "boolean": "boolean",
    },
    "redshift": {
        "smallint": "int", "int2": "int", "integer": "int", "int": "int", "int4": "int", "bigint": "bigint",
        "int8": "bigint", "real": "float", "float4": "float", "float": "float", "float8": "float",
        "doubleprecision": "float", "boolean": "boolean", "bool": "boolean", "char": "string",
        "character": "string", "varchar": "string", "charactervarying": "string", "nchar": "string",
        "nvarchar": "string", "text": "string", "date": "date", "timestamp": "timestamp",
        "timestamptz": "timestamp", "timetz": "timestamp", "varbyte": "binary", "varbinary": "binary",
    },
}
# Types whose text also exists here but means something else: an unsigned byte, a row version.
FALSE_FRIENDS = {"sqlserver": ("tinyint", "timestamp")}


def table_schema(df: DataFrame) -> DataFrame:
    """(column_name, data_type) in lower case. The schema is metadata, so nothing is read."""
    rows = sorted({(f.name.lower(), f.dataType.simpleString()) for f in df.schema if not f.name.startswith("#")})
    return df.sparkSession.createDataFrame(rows, SCHEMA_FIELDS)


def catalog_schema(spark: SparkSession, table: str) -> DataFrame:
    """(column_name, data_type) of a catalog table."""
    described = spark.sql(f"describe table {table}")
    return (
        described.filter(~F.col("col_name").startswith("#") & (F.col("col_name") != ""))
        .select(F.lower("col_name").alias("column_name"), F.lower("data_type").alias("data_type"))
        .distinct()
    )


def render_type(meta: DataFrame, system: str) -> DataFrame:
    """Type text out of information-schema rows.

    ``meta`` has column_name, data_type, numeric_precision, numeric_scale, char_length.
    """
    kind, p, s, n = (F.col(c) for c in ("data_type", "numeric_precision", "numeric_scale", "char_length"))
    low = F.lower(kind)
    text: Column
    if system == "oracle":
        text = (
            F.when(p.isNotNull() & (s != 0), F.concat(kind, F.lit("("), p, F.lit(","), s, F.lit(")")))
            .when(p.isNotNull() & (s == 0), F.concat(kind, F.lit("("), p, F.lit(")")))
            .when(p.isNull() & ((low == "date") | low.startswith("timestamp")), kind)
            .when(n == 0, kind)
            .otherwise(F.concat(kind, F.lit("("), n, F.lit(")")))
        )
    elif system == "snowflake":
        text = (
            F.when(p.isNotNull() & s.isNotNull(), F.concat(kind, F.lit("("), p, F.lit(","), s, F.lit(")")))
            .when(low == "text", F.concat(F.lit("varchar("), n, F.lit(")")))
            .otherwise(kind)
        )
    elif system == "sqlserver":
        text = (
            F.when(low.isin("smallint", "tinyint"), F.lit("smallint"))
            .when(low.isin("decimal", "numeric"), F.concat(F.lit("decimal("), p, F.lit(","), s, F.lit(")")))
            .when(low.isin("float", "real"), F.lit("double"))
            .when(low == "bit", F.lit("boolean"))
            .when(low.isin("binary", "varbinary"), F.lit("binary"))
            .otherwise(kind)
        )
    else:
        raise ValueError(f"unknown system: {system}")
    return meta.select(F.lower("column_name").alias("column_name"), F.lower(text).alias("data_type"))


def equivalent_type(data_type: Column, system: str) -> Column:
    """Type that a source system's type text becomes; unknown types keep their text."""
    text = F.lower(F.regexp_replace(data_type, r"\s+", ""))
    name = F.regexp_extract(text, r"^([a-z0-9_]+)", 1)
    scale = F.regexp_extract(text, r"\(([0-9]+(?:,[0-9]+)?)\)", 1)
    table = TYPE_EQUIVALENTS.get(system, {})
    known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair]) if table else None
    mapped = F.try_element_at(known, name) if table else F.lit(None).cast("string")
    exact = (scale != "") & name.isin("number", "numeric", "decimal")
    full = F.when(scale.contains(","), scale).otherwise(F.concat(scale, F.lit(",0")))
    return F.when(exact, F.concat(F.lit("decimal("), full, F.lit(")"))).otherwise(F.coalesce(mapped, text))


def _plain(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"\s+", ""))


def compare_schema(source: DataFrame, target: DataFrame, config: TableConfig, system: str | None = None) -> DataFrame:
    """One row per compared source column: both names, both types and ``is_valid``.

    Columns that only the target has are not reported. ``system`` is the source's system; without it
    both sides speak the same one and the type texts have to be equal.
    """
    spark = source.sparkSession
    kept = source
    if config.select:
        kept = kept.filter(F.lower("column_name").isin(*config.select))
    if config.drop:
        kept = kept.filter(~F.lower("column_name").isin(*config.drop))
    pairs = [(s, t) for s, t in config.mapping.items()]
    renamed = spark.createDataFrame(pairs, "m_source string, m_target string") if pairs else None
    kept = kept.select(F.lower("column_name").alias("source_column"), F.col("data_type").alias("source_datatype"))
    if renamed is None:
        kept = kept.withColumn("target_column", F.col("source_column"))
    else:
        kept = kept.join(renamed, F.col("source_column") == F.col("m_source"), "left").select(
            "source_column", "source_datatype", F.coalesce("m_target", "source_column").alias("target_column")
        )
    there = target.select(F.lower("column_name").alias("t_name"), F.col("data_type").alias("t_type"))
    joined = kept.join(there, F.col("target_column") == F.col("t_name"), "left").select(
        "source_column",
        "source_datatype",
        "target_column",
        F.coalesce("t_type", F.lit("Unknown")).alias("target_datatype"),
    )
    have, want = _plain(F.col("source_datatype")), _plain(F.col("target_datatype"))
    same = have == want
    if system:
        became = equivalent_type(F.col("source_datatype"), system)
        # The element type of an array is not known to the source.
        arrays = (became == "array") & want.startswith("array<")
        same = (same & ~have.isin(*FALSE_FRIENDS.get(system, ("",)))) | (became == want) | arrays
    return joined.withColumn("is_valid", F.coalesce(same, F.lit(False)))


def schema_is_valid(report: DataFrame) -> DataFrame:
    return report.agg(F.coalesce(F.bool_and("is_valid"), F.lit(True)).alias("is_valid"))


