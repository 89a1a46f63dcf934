"""Text functions with argument rules of other SQL systems."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def charindex(part: Column, text: Column, start: int = 1) -> Column:
    """Position of the first occurrence at or after ``start``; 0 when there is none."""
    return F.call_function("locate", part, text, F.lit(start))


def strpos(text: Column, part: Column, nth: int = 1) -> Column:
    """Position of the n-th occurrence (overlapping ones count); 0 when there is none."""
    position = F.call_function("locate", part, text, F.lit(1))
    for _ in range(nth - 1):
        position = F.when(position > 0, F.call_function("locate", part, text, position + 1)).otherwise(F.lit(0))
    return position


def split_part(text: Column, delimiter: Column, part: Column) -> Column:
    """Part number 0 counts as 1."""
    return F.split_part(text, delimiter, F.when(part == 0, F.lit(1)).otherwise(part))


def strtok(text: Column, delimiter: str = " ", part: int = 1) -> Column:
    return F.split_part(text, F.lit(delimiter), F.lit(part))


def strtok_to_array(text: Column, delimiters: str = " ") -> Column:
    """Split at every character of a set."""
    return F.split(text, "[" + "".join(re.escape(d) for d in delimiters) + "]")


def regexp_substr(
    text: Column, pattern: str, position: int = 1, occurrence: int = 1, flags: str = "c", group: int = 0
) -> Column:
    """n-th match from a position on; NULL when there is none. Flag ``i`` ignores case, ``e`` gives group 1."""
    if "e" in flags and group == 0:
        group = 1
    pattern = ("(?i)" if "i" in flags else "") + pattern
    found = F.regexp_extract_all(F.substring(text, position, 2147483647), F.lit(pattern), F.lit(group))
    return F.get(found, F.lit(occurrence - 1))


def quote_literal(text: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))


def base64_encode(text: Column) -> Column:
    """Base64 of the UTF-8 text in one line; Spark may break it into lines."""
    return F.regexp_replace(F.base64(F.encode(text, "UTF-8")), "[\\r\\n]", "")


def base64_decode(text: Column) -> Column:
    return F.decode(F.unbase64(text), "UTF-8")
