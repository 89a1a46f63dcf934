"""Division, bits and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def div0(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(F.try_divide(a, b))


def div0null(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0 or NULL."""
    return F.when((b == 0) | b.isNull(), F.lit(0.0)).otherwise(F.try_divide(a, b))


def square(c: Column) -> Column:
    return F.pow(c, F.lit(2))


def set_bit(c: Column, position: int) -> Column:
    return c.bitwiseOR(F.shiftleft(F.lit(1).cast("long"), position))


def sha2(c: Column, bits: int = 256) -> Column:
    return F.sha2(c, bits)


def uuid_from_name(namespace_hex: str, name: Column) -> Column:
    """Version-5 UUID: SHA-1 of namespace and name with the version and variant bits set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace_hex.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.lower(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8).cast("string"))
    variant = F.lower(F.conv(variant, 10, 16))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
