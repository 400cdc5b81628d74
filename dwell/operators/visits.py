"""Visit profiles: one row for each user and place, from visit records.

One scan, one aggregation whose partial results combine before its only shuffle, one projection. The latest date of all
records, from which recency counts, comes from a second scan of three columns and is broadcast as a single row.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwell.functions import histograms as H
from dwell.functions.columns import col

log = logging.getLogger(__name__)

HOURS, WEEKDAYS, DAYS = range(24), range(1, 8), range(1, 32)
PROFILE_COLUMNS = [
    "uuid", "poi_id", "visit_count", "total_stay_minutes", "avg_stay_minutes", "max_stay_minutes", "std_stay_minutes",
    "first_visit_date", "last_visit_date", "last_visit_recency_days", "weekday_visit_ratio", "weekend_visit_ratio",
    "daytime_ratio", "night_ratio", "enter_hour_dist", "leave_hour_dist", "visit_weekday_dist", "visit_day_of_month_dist",
    "top_enter_hours", "top_leave_hours", "top_weekdays", "enter_period_stats", "leave_period_stats", "weekday_group_stats",
    "date_group_stats",
]


def _clamped_hours(start: int, end: int) -> list[int]:
    """Hours from start to end, over midnight if need be; none if they are equal."""
    start, end = max(0, min(23, start)), max(0, min(24, end))
    if start == end:
        return []
    return list(range(start, end)) if start < end else [*range(start, 24), *range(0, end)]


def _whole(value) -> int | None:
    try:
        return int(value)
    except (TypeError, ValueError):
        return None


def _month_day(value) -> int | None:
    """The day of month that the end of a range names: a date, or a number."""
    if isinstance(value, (date, datetime)):
        return value.day
    if isinstance(value, str):
        for form in ("%Y-%m-%d", "%Y/%m/%d", "%Y%m%d", "%Y-%m-%d %H:%M:%S"):
            try:
                return datetime.strptime(value.strip(), form).day
            except ValueError:
                pass
    return _whole(value)


def period_hours(spec: dict) -> list[int]:
    hours = spec.get("hours")
    if isinstance(hours, (list, tuple)):
        return [h for h in map(int, hours) if 0 <= h <= 23]
    return _clamped_hours(int(spec.get("start_hour", 0)), int(spec.get("end_hour", 0)))


def group_weekdays(spec: dict) -> list[int]:
    return [d for d in map(_whole, spec["days"]) if d is not None and 1 <= d <= 7]


def group_dates(spec: dict) -> list[int]:
    """Days of month, each once. A range whose days stand in reverse order is turned round."""
    days = {d for d in map(_whole, spec.get("days_of_month") or ()) if d is not None}
    for pair in spec.get("ranges") or ():
        if isinstance(pair, (list, tuple)) and len(pair) == 2:
            a, b = map(_month_day, pair)
            if a is not None and b is not None:
                if a > b:
                    log.warning("the range %s to %s is read as days %d to %d", *pair, b, a)
                days.update(range(min(a, b), max(a, b) + 1))
    return sorted(d for d in days if 1 <= d <= 31)


@dataclass(frozen=True)
class Rhythm:
    """Named sets of bins whose visits are counted, and the hours of day. A name given twice keeps its first place and its last bins."""

    day_hours: tuple[int, ...] = tuple(range(7, 19))
    enter: dict[str, list[int]] = field(default_factory=dict)
    leave: dict[str, list[int]] = field(default_factory=dict)
    weekdays: dict[str, list[int]] = field(default_factory=dict)
    dates: dict[str, list[int]] = field(default_factory=dict)

    @classmethod
    def of(cls, specs: dict | None) -> Rhythm:
        specs = specs if isinstance(specs, dict) else {}

        def named(key: str, bins, ok=lambda s: True) -> dict[str, list[int]]:
            rows = specs.get(key)
            return {str(s["name"]): bins(s) for s in (rows if isinstance(rows, (list, tuple)) else ()) if isinstance(s, dict) and s.get("name") and ok(s)}

        day = specs.get("daytime")
        day = day if isinstance(day, dict) else {}
        return cls(
            tuple(_clamped_hours(int(day.get("start_hour", 7)), int(day.get("end_hour", 19)))),
            named("enter_periods", period_hours), named("leave_periods", period_hours),
            named("weekday_groups", group_weekdays, lambda s: isinstance(s.get("days"), (list, tuple))), named("date_groups", group_dates),
        )


def parsed_date(df: DataFrame, name: str) -> Column:
    """Dates, timestamps, texts of dates, and whole numbers of the form yyyyMMdd."""
    t = df.schema[name].dataType
    if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col(name).cast("date")
    text = F.trim(col(name).cast("string"))
    return F.coalesce(F.when(F.length(text) == 8, F.try_to_timestamp(text, F.lit("yyyyMMdd"))).cast("date"), F.when(F.length(text) >= 8, text.try_cast("date")))


def visits(df: DataFrame) -> DataFrame:
    """uuid, poi_id, start_hour, end_hour, minutes, date: typed, without records that lack a user or a place or have place 0."""
    poi = df.schema["poi_id"].dataType
    numeric = isinstance(poi, T.NumericType)
    minutes = col("stay_minutes").try_cast("double")
    out = df.select("uuid", "poi_id", col("start_hour").try_cast("int").alias("start_hour"), col("end_hour").try_cast("int").alias("end_hour"), F.when(~F.isnan(minutes), minutes).alias("minutes"), parsed_date(df, "date_str").alias("date"))
    return out.where(F.col("uuid").isNotNull() & F.col("poi_id").isNotNull() & (F.col("poi_id") != (F.lit(0) if numeric else F.lit("0"))))


def grouped(records: DataFrame) -> DataFrame:
    """Moments and histograms by user and place."""
    m = F.col("minutes")
    return records.groupBy("uuid", "poi_id").agg(
        F.count(F.lit(1)).alias("visit_count"),
        F.coalesce(F.sum(m), F.lit(0.0)).alias("total_stay_minutes"),
        F.coalesce(F.max(m), F.lit(0.0)).alias("max_stay_minutes"),
        F.coalesce(F.sum(m * m), F.lit(0.0)).alias("squares"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        H.counts(F.col("start_hour"), HOURS).alias("enter"),
        H.counts(F.col("end_hour"), HOURS).alias("leave"),
        H.counts(F.weekday("date") + 1, WEEKDAYS).alias("weekdays"),
        H.counts(F.dayofmonth("date"), DAYS).alias("days"),
    )


def period_stats(hist: Column, named: dict[str, list[int]], first: int) -> Column:
    """{"name": {"visits": 3, "ratio": 0.75}, ...} as text."""
    import json

    whole, parts = H.total(hist), [F.lit("{")]
    for i, (name, bins) in enumerate(named.items()):
        n = H.total(hist, bins, first)
        parts += [F.lit((", " if i else "") + json.dumps(name, ensure_ascii=False) + ': {"visits": '), n.cast("string"), F.lit(', "ratio": '), H.float_text(H.ratio(n, whole)), F.lit("}")]
    return F.concat(*parts, F.lit("}"))


def described(groups: DataFrame, latest: DataFrame, rhythm: Rhythm) -> DataFrame:
    """The 25 columns of a profile. latest: one row with the latest date."""
    n, total = F.col("visit_count"), F.col("total_stay_minutes")
    mean = total / n
    spread = F.sqrt(F.greatest(F.lit(0.0), F.col("squares") / n - mean * mean))
    enter, leave, weekdays, days = (F.col(c) for c in ("enter", "leave", "weekdays", "days"))
    at_work = H.ratio(H.total(weekdays, list(range(1, 6)), 1), H.total(weekdays))
    by_day = H.ratio(H.total(enter, list(rhythm.day_hours)), H.total(enter))
    out = groups.crossJoin(F.broadcast(latest)).withColumns({
        "avg_stay_minutes": mean,
        "std_stay_minutes": F.when(n <= 1, F.lit(0.0)).otherwise(spread),
        "first_visit_date": F.date_format("first_date", "yyyy-MM-dd"),
        "last_visit_date": F.date_format("last_date", "yyyy-MM-dd"),
        "last_visit_recency_days": F.datediff("latest", "last_date"),
        "weekday_visit_ratio": at_work,
        "weekend_visit_ratio": 1 - at_work,
        "daytime_ratio": by_day,
        "night_ratio": 1 - by_day,
        "enter_hour_dist": H.json_counts(enter, 0),
        "leave_hour_dist": H.json_counts(leave, 0),
        "visit_weekday_dist": H.json_counts(weekdays, 1),
        "visit_day_of_month_dist": H.json_counts(days, 1),
        "top_enter_hours": H.json_list(H.top_bins(enter, 0)),
        "top_leave_hours": H.json_list(H.top_bins(leave, 0)),
        "top_weekdays": H.json_list(H.top_bins(weekdays, 1)),
        "enter_period_stats": period_stats(enter, rhythm.enter, 0),
        "leave_period_stats": period_stats(leave, rhythm.leave, 0),
        "weekday_group_stats": period_stats(weekdays, rhythm.weekdays, 1),
        "date_group_stats": period_stats(days, rhythm.dates, 1),
    })
    return out.select(*PROFILE_COLUMNS)


def profile(df: DataFrame, rhythm_specs: dict | None = None, max_rows: int | None = None) -> DataFrame:
    """df: uuid, poi_id, start_hour, end_hour, stay_minutes, date_str. max_rows: only the first rows, before any filter."""
    records = visits(df if max_rows is None else df.limit(max_rows))
    return described(grouped(records), records.agg(F.max("date").alias("latest")), Rhythm.of(rhythm_specs))


COUNTS, BINS, STATS = "map<string,bigint>", "array<int>", "map<string,struct<visits:bigint,ratio:double>>"


def decoded(profiles: DataFrame) -> DataFrame:
    """The text columns of a profile as maps and arrays."""
    kinds = {c: COUNTS for c in PROFILE_COLUMNS if c.endswith("_dist")} | {c: BINS for c in PROFILE_COLUMNS if c.startswith("top_")} | {c: STATS for c in PROFILE_COLUMNS if c.endswith("_stats")}
    return profiles.withColumns({c: F.from_json(c, k) for c, k in kinds.items()})


def first_locations(df: DataFrame) -> DataFrame:
    """poi_id and the location of its first record in input order (null, if that has none); place 0 is left out."""
    numeric = isinstance(df.schema["poi_id"].dataType, T.NumericType)
    rows = df.where(F.col("poi_id").isNotNull() & (F.col("poi_id") != (F.lit(0) if numeric else F.lit("0"))))
    order = F.monotonically_increasing_id() if "_order" not in df.columns else F.col("_order")
    return rows.withColumn("_at", order).groupBy("poi_id").agg(F.min_by(F.struct("location"), "_at").alias("first")).select("poi_id", "first.location")
