"""Scalar conversions. Malformed input gives NULL; ANSI mode stays on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

YEAR_AT_END = r"\((\d{4})\)$"


def to_int(col: Column) -> Column:
    return col.try_cast("int")


def extract_year(title: Column) -> Column:
    return F.regexp_extract(F.trim(title), YEAR_AT_END, 1).try_cast("int")


def strip_year(title: Column) -> Column:
    return F.regexp_replace(F.trim(title), r"\s*\(\d{4}\)$", "")


def split_list(col: Column, sep: str) -> Column:
    """Delimited text to array. ``sep`` is taken literally."""
    return F.split(col, r"\Q" + sep + r"\E")


def prefix_id(col: Column, prefix: str) -> Column:
    """Keeps leading zeros and NULLs, since ids stay text."""
    return F.concat(F.lit(prefix), col.cast("string"))


def epoch_to_ts(col: Column) -> Column:
    """Seconds since 1970 to a timestamp; NULL outside the years 1 to 9999."""
    seconds = col.try_cast("bigint")
    return F.when(seconds.between(-62_135_596_800, 253_402_300_799), F.timestamp_seconds(seconds))


def int_to_bool(col: Column) -> Column:
    return col == F.lit(1)


def decode(col: Column, mapping: Mapping) -> Column:
    """Code to label; a code outside ``mapping`` gives NULL."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.create_map(*pairs)[col]


def flatten(df: DataFrame, struct: str) -> DataFrame:
    """Replace a struct column by its fields."""
    field = df.schema[struct]
    if not isinstance(field.dataType, StructType):
        raise TypeError(f"{struct} is not a struct")
    inner = [F.col(f"`{struct}`.`{n}`").alias(n) for n in field.dataType.names]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != struct], *inner)


def unnest(df: DataFrame, array: str, alias: str | None = None, keep_empty: bool = False) -> DataFrame:
    """One row per element. Rows without elements go, unless ``keep_empty``."""
    spread = F.explode_outer if keep_empty else F.explode
    rest = [F.col(f"`{c}`") for c in df.columns if c != array]
    return df.select(*rest, spread(F.col(f"`{array}`")).alias(alias or array))


def resolve_id(primary: Column, fallback: Column) -> Column:
    return F.coalesce(primary.cast("string"), fallback.cast("string"))


def drop_if_exists(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def canonical_ts(col: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.try_to_timestamp(col.cast("string")), pattern)


def clean_array(col: Column) -> Column:
    return F.filter(col, lambda x: x.isNotNull() & (x != ""))


def decade(year: Column) -> Column:
    return F.floor(year / 10) * 10


def iri_part(col: Column) -> Column:
    """Percent-encode everything but RFC 3986 unreserved characters."""
    form = F.url_encode(col)
    blanks = F.replace(form, F.lit("+"), F.lit("%20"))
    encoded = F.replace(F.replace(blanks, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    return F.when(col.rlike(r"^[A-Za-z0-9._~-]*$"), col).otherwise(encoded)
