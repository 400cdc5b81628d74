"""Stay points brought into one form, before any pipeline: key, local start and end, coordinates or cell."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwell.functions import columns as C
from dwell.functions.projection import project

HOUR = 3_600_000


@dataclass(frozen=True)
class Clock:
    """How input times become a local clock. null_time 'compat' reads a null as -1 before the shift, as older tools did."""

    epoch_unit: str = "ms"
    timestamps_are_utc: bool = True
    tz_offset_hours: int = 8
    null_time: str = "invalid"

    def local(self, df: DataFrame, name: str) -> Column:
        if self.epoch_unit not in ("ms", "s"):
            raise ValueError("epoch_unit is ms or s")
        raw = C.as_long(df, name, -1 if self.null_time == "compat" else None)
        stamped = isinstance(C.kind(df, name), (T.TimestampType, T.TimestampNTZType, T.DateType))
        ms = raw * 1000 if self.epoch_unit == "s" and not stamped else raw
        ms = ms + self.tz_offset_hours * HOUR if self.timestamps_are_utc else ms
        return F.coalesce(ms, F.lit(-1).cast("long"))


def coordinate_mode(columns: list[str], given: dict | None = None, hexes: bool = False) -> str:
    """xy before lonlat before location; hexes never take xy."""
    for mode, names in (("xy", ("x", "y")), ("lonlat", ("lon", "lat")), ("location", ("location",))):
        if not (hexes and mode == "xy") and all(C.find(columns, n, given) for n in names):
            return mode
    raise ValueError("no coordinates: x and y, lon and lat, or location")


def coordinates(df: DataFrame, mode: str, given: dict | None, source_crs: str, target_crs: str | None, already_projected: bool = False) -> tuple[Column, Column]:
    """x and y in target_crs, or lon and lat where that is None."""
    names = df.columns
    if mode == "xy":
        return C.as_double(df, C.need(names, "x", given)), C.as_double(df, C.need(names, "y", given))
    if already_projected:
        raise ValueError("coords_already_projected needs columns x and y")
    if mode == "lonlat":
        lon, lat = C.as_double(df, C.need(names, "lon", given)), C.as_double(df, C.need(names, "lat", given))
    else:
        lon, lat = C.lon_lat(C.col(C.need(names, "location", given)).cast("string"))
    return (lon, lat) if target_crs is None else project(lon, lat, source_crs, target_crs)


def city_rows(df: DataFrame, value: str, column: str | None = None, given: dict | None = None) -> DataFrame:
    """Rows of one city. What this drops counts nowhere."""
    return df.where(C.equals(df, column or C.need(df.columns, "city_code", given), value))


def city_value(given: str | None, uid_code: str | None, meta_code: str | None) -> str:
    for v in (given, uid_code, meta_code):
        if v is not None and str(v).strip():
            return str(v).strip()
    raise ValueError("a city filter needs city_code_value, a uid code, or a code in the meta file")
