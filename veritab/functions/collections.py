"""Arrays, maps and JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_construct_compact(*columns: Column) -> Column:
    """Array without its NULLs; duplicates stay."""
    return F.array_compact(F.array(*columns))


def array_slice(c: Column, start: int, end: int) -> Column:
    """Elements from ``start`` up to but without ``end``, counted from 0."""
    if start < 0 or end < 0:
        raise ValueError("positions count from the start of the array")
    return F.slice(c, start + 1, max(end - start, 0))


def array_contains(value, c: Column) -> Column:
    """Value first, array second."""
    return F.array_contains(c, value)


def array_average(c: Column) -> Column:
    """Mean of the elements that are not NULL; NULL when there are none."""
    kept = F.filter(c, lambda x: x.isNotNull())
    total = F.aggregate(kept, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.try_divide(total, F.size(kept))


def any_keys_match(c: Column, predicate) -> Column:
    return F.exists(F.map_keys(c), predicate)


def json_size(c: Column, path: str) -> Column:
    """Elements of an object or array, 0 for another value, NULL when the path leads nowhere."""
    value = F.get_json_object(c, path)
    return (
        F.when(value.startswith("{"), F.size(F.from_json(value, "map<string,string>")))
        .when(value.startswith("["), F.size(F.from_json(value, "array<string>")))
        .when(value.isNotNull(), F.lit(0))
    )


def json_extract_path_text(c: Column, *path) -> Column:
    """Value at a path of keys; numbers are array positions, columns are read per row."""
    parts = [F.lit("$")]
    for p in path:
        if isinstance(p, Column):
            parts += [F.lit("."), p]
        elif isinstance(p, int):
            parts.append(F.lit(f"[{p}]"))
        else:
            parts.append(F.lit(f".{p}"))
    return F.call_function("get_json_object", c, F.concat(*parts))


def is_valid_json(c: Column) -> Column:
    """Is the whole text one JSON value? NULL is none.

    The parser stops after the first value, so the text is read as the only element of an array.
    """
    wrapped = F.concat(F.lit("["), c, F.lit("]"))
    single = F.try_parse_json(wrapped).isNotNull() & (F.json_array_length(wrapped) == 1)
    return F.coalesce(single, F.lit(False))
