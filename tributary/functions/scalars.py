"""Small column functions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Size units and their factors in bytes.
SIZE_UNITS = {
    "B": 1,
    "KiB": 1024,
    "MiB": 1024**2,
    "GiB": 1024**3,
    "kB": 1000,
    "MB": 1000**2,
    "GB": 1000**3,
    "TB": 1000**4,
}


def size_in_bytes(text: Column) -> Column:
    """``"1.2GiB"`` → bytes as double; text without a leading number and unit gives 0."""
    units = F.create_map(*[F.lit(v) for unit, factor in SIZE_UNITS.items() for v in (unit, float(factor))])
    pattern = r"^\s*([0-9.]+)\s*([A-Za-z]+)"
    number = F.regexp_extract(text, pattern, 1).try_cast("double")
    return F.coalesce(number * F.try_element_at(units, F.regexp_extract(text, pattern, 2)), F.lit(0.0))


def base64_length(text: Column) -> Column:
    """Decoded byte length estimated from the text alone; counts the padding too."""
    return (F.length(text) / 4 * 3).cast("bigint")


def json_map(text: Column) -> Column:
    """A flat JSON object as a map of text values."""
    return F.from_json(text, "map<string,string>")


def hash_bucket(*columns: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")
