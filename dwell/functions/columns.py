"""Finding columns by name and reading them leniently."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

#: Names under which inputs carry their columns, in order of preference.
CANDIDATES: dict[str, list[str]] = {
    "uuid": ["uuid", "user", "uid"],
    "poi_id": ["poi_id", "poi"],
    "start_time": ["start_time", "start", "start_ms", "stime"],
    "end_time": ["end_time", "end", "end_ms", "etime"],
    "stay_minutes": ["stay_minutes", "duration_min", "stay_min", "minutes"],
    "lon": ["lon", "lng", "longitude"],
    "lat": ["lat", "latitude"],
    "x": ["x", "coord_x", "easting"],
    "y": ["y", "coord_y", "northing"],
    "location": ["location", "loc"],
    "source": ["source", "src"],
    "city_code": ["c_code", "city_code", "adcode", "city", "city_id", "cityid"],
    "category": ["poi_category", "poi_type", "category", "type"],
    "home_lon": ["home_lon", "home_lng", "home_longitude"],
    "home_lat": ["home_lat", "home_latitude"],
    "home_x": ["home_x", "home_easting"],
    "home_y": ["home_y", "home_northing"],
    "work_lon": ["work_lon", "work_lng", "work_longitude"],
    "work_lat": ["work_lat", "work_latitude"],
    "work_x": ["work_x", "work_easting"],
    "work_y": ["work_y", "work_northing"],
}


def find(columns: list[str], logical: str, given: dict | None = None) -> str | None:
    """The column that given names; else one equal to a candidate but for case; else the first that contains one."""
    if given and given.get(logical):
        return given[logical]
    names = CANDIDATES[logical]
    by_lower: dict[str, str] = {}
    for c in columns:
        by_lower.setdefault(c.lower(), c)
    for n in names:
        if n in by_lower:
            return by_lower[n]
    for n in names:
        for c in columns:
            if n in c.lower():
                log.info("column %s is read as %s", c, logical)
                return c
    return None


def need(columns: list[str], logical: str, given: dict | None = None) -> str:
    found = find(columns, logical, given)
    if not found:
        raise ValueError(f"no column for {logical}; name it in schema_map")
    return found


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def kind(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def as_long(df: DataFrame, name: str, null: int | None = None) -> Column:
    """A whole number; timestamps as epoch milliseconds, cut off below; text trimmed, and null where it is no number."""
    t, c = kind(df, name), col(name)
    if isinstance(t, T.TimestampNTZType):
        c = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    elif isinstance(t, T.TimestampType):
        c = F.unix_millis(c)
    elif isinstance(t, T.DateType):
        c = F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000
    elif isinstance(t, T.StringType):
        c = F.trim(c).try_cast("long")
    else:
        c = c.try_cast("long")
    return c if null is None else F.coalesce(c, F.lit(null).cast("long"))


def as_double(df: DataFrame, name: str) -> Column:
    """A double; NaN is null."""
    c = F.trim(col(name)) if isinstance(kind(df, name), T.StringType) else col(name)
    c = c.try_cast("double")
    return F.when(~F.isnan(c), c)


def as_text(df: DataFrame, name: str) -> Column:
    """Text; null is empty, and whole doubles have no decimals."""
    c = col(name)
    if isinstance(kind(df, name), (T.DoubleType, T.FloatType)):
        whole = c.cast("long")
        c = F.when(whole.cast("double") == c, whole.cast("string")).otherwise(c.cast("string"))
    return F.coalesce(c.cast("string"), F.lit(""))


def equals(df: DataFrame, name: str, value: str) -> Column:
    """A column's text equals value. Whole-number columns are compared as numbers, so that scans can skip by statistics."""
    t = kind(df, name)
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        plain = value.lstrip("-").isdigit() and str(int(value)) == value
        return col(name) == F.lit(int(value)) if plain else F.lit(False)
    return as_text(df, name) == F.lit(value) if not isinstance(t, T.StringType) else col(name) == F.lit(value)


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def lon_lat(location: Column) -> tuple[Column, Column]:
    """From texts such as "[113.9, 22.5]"; null where they do not hold two numbers."""
    parts = F.split(F.regexp_replace(location, r"[\[\]\(\)\s]", ""), ",")
    return tuple(F.get(parts, F.lit(i)).try_cast("double") for i in (0, 1))
