"""Strict, filled and total minutes of users in spatial units, by band and kind of day.

Intervals give strict minutes, day by day. Points split their band at the midpoints between them, and what strict
minutes leave of the band is filled in proportion. Units are grid cells or hexagons: the arithmetic is the same, they
differ in where rows without a valid unit leave (cells after the factors, hexagons before).

Rows are shuffled by user and day: the neighbours of a point, the sums by unit and the factors of a user's day and band
fall within that partitioning, and no user's rows are one task. What is left, a row for each user, day, band and unit, is
shuffled once more, by user. Without Options.spread the rows are dealt by user alone and the second shuffle falls away.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwell.functions import bands as B
from dwell.functions import columns as C
from dwell.functions.hashing import METHODS, uid_key, unsigned
from dwell.functions.hexcells import cell_of, cell_text, cell_uid
from dwell.functions.space import Grid, placed
from dwell.operators.stays import Clock, city_rows, coordinate_mode, coordinates

ID_MODES = ("uuid", "uid64", "both")


@dataclass(frozen=True)
class Options:
    windows: str | list[str] = "lunch,dinner"
    min_interval_minutes: int = 5
    point_source_filter: bool = True
    point_source_value: str = "cell_appearance"
    clock: Clock = Clock()
    coords_already_projected: bool = False
    uid64_hash_method: str = "sha256_64"
    id_mode: str = "uuid"
    overlap_rounding: str = "floor"
    oob_mode: str = "drop"
    drop_uuid_not_in_table: bool = False
    city_code_col: str | None = None
    city_code_value: str | None = None
    spread: bool = True

    def __post_init__(self):
        if self.id_mode.lower() not in ID_MODES:
            raise ValueError(f"id_mode is one of {', '.join(ID_MODES)}")
        if self.overlap_rounding not in B.ROUNDING:
            raise ValueError("overlap_rounding is floor, round or ceil")
        if self.oob_mode.lower() not in ("drop", "null", "keep"):
            raise ValueError("oob_mode is drop, null or keep")
        if self.uid64_hash_method not in METHODS:
            raise ValueError(f"uid64_hash_method is one of {', '.join(METHODS)}")


@dataclass(frozen=True)
class Cells:
    """Grid cells as units."""

    grid: Grid
    prefix: str = "grid"
    code: str = ""
    order: str = "col_row"
    output_uid: bool = True
    output_id: bool = False
    name: str = "grid"
    early: bool = False  # rows without a unit still take part in the factors

    def __post_init__(self):
        if not (self.output_uid or self.output_id):
            raise ValueError("output_grid_uid or output_grid_id must be true")

    def place(self, stays: DataFrame, given: dict, options: Options) -> tuple[Column, Column]:
        x, y = coordinates(stays, coordinate_mode(stays.columns, given), given, self.grid.coord_crs, self.grid.grid_crs, options.coords_already_projected)
        cell, inside = self.grid.cell(x, y)
        return cell, inside

    def unit(self, options: Options) -> Column:
        return placed(F.col("raw_unit"), F.col("ok_unit"), options.oob_mode)

    def shown(self, unit: Column) -> Column:
        return unit >= 0

    def columns(self, unit: Column) -> list[Column]:
        out = [self.grid.uid(unit, self.prefix, self.code, self.order).alias("grid_uid")] if self.output_uid else []
        return out + ([unit.cast("int").alias("grid_id")] if self.output_id else [])


@dataclass(frozen=True)
class Hexes:
    """Hexagons as units; allowed: a table with the column h3_int (signed) of a city's cells."""

    allowed: DataFrame
    resolution: int = 9
    bbox: tuple[float, float, float, float] | None = None
    prefix: str = "hex"
    code: str = ""
    output_uid: bool = True
    output_h3_id: bool = True
    output_h3_int: bool = False
    cell_column: str | None = None  # precomputed cells, in place of coordinates
    name: str = "hex"
    early: bool = True

    def place(self, stays: DataFrame, given: dict, options: Options) -> tuple[Column, Column]:
        if self.cell_column:
            return C.as_long(stays, self.cell_column), C.col(self.cell_column).isNotNull()
        lon, lat = coordinates(stays, coordinate_mode(stays.columns, given, hexes=True), given, "EPSG:4326", None)
        ok = C.finite(lon) & C.finite(lat) & (F.abs(lat) <= 90) & (F.abs(lon) <= 180)
        if self.bbox:
            x0, y0, x1, y1 = self.bbox
            ok = ok & (lon >= x0) & (lon <= x1) & (lat >= y0) & (lat <= y1)
        ok = F.coalesce(ok, F.lit(False))
        return cell_of(F.when(ok, lat), F.when(ok, lon), self.resolution), ok

    def unit(self, options: Options) -> Column:
        raw = F.col("raw_unit")
        return {"drop": F.when(F.col("ok_unit"), raw), "null": F.when(F.col("ok_unit"), raw).otherwise(F.lit(0).cast("long")), "keep": raw}[options.oob_mode.lower()]

    def shown(self, unit: Column) -> Column:
        return unit != 0

    def columns(self, unit: Column) -> list[Column]:
        out = [cell_uid(unit, self.prefix, self.code).alias("hex_uid")] if self.output_uid else []
        out += [cell_text(unit).alias("h3_id")] if self.output_h3_id else []
        return out + ([unsigned(unit).alias("h3_int")] if self.output_h3_int else [])


def allow_list(users: DataFrame, method: str = "sha256_64", given: dict | None = None) -> DataFrame:
    """Distinct keys of a user table; null names are left out."""
    name = C.need(users.columns, "uuid", given)
    return users.where(C.col(name).isNotNull()).select(uid_key(C.as_text(users, name), method).alias("key")).distinct()


def marked(stays: DataFrame, units: Cells | Hexes, options: Options, users: DataFrame | None = None, schema_map: dict | None = None) -> DataFrame:
    """Rows with key, uuid, local times, unit and what each filter says of them."""
    given = (schema_map or {}).get("staypoints") or {}
    if options.city_code_value is not None:
        stays = city_rows(stays, options.city_code_value, options.city_code_col, given)
    names = stays.columns
    source = C.find(names, "source", given)
    raw, ok = units.place(stays, given, options)
    rows = stays.select(
        C.as_text(stays, C.need(names, "uuid", given)).alias("uuid"),
        options.clock.local(stays, C.need(names, "start_time", given)).alias("start"),
        options.clock.local(stays, C.need(names, "end_time", given)).alias("end"),
        raw.alias("raw_unit"), ok.alias("ok_place"),
        (C.as_text(stays, source) if source else F.lit(None).cast("string")).alias("source"),
    )
    rows = rows.withColumn("key", uid_key(F.col("uuid"), options.uid64_hash_method))
    if options.drop_uuid_not_in_table:
        if users is None:
            raise ValueError("drop_uuid_not_in_table needs a table of users")
        known = allow_list(users, options.uid64_hash_method, (schema_map or {}).get("uuid_table")).withColumn("ok_user", F.lit(True))
        rows = rows.join(known, "key", "left").withColumn("ok_user", F.coalesce("ok_user", F.lit(False)))
    else:
        rows = rows.withColumn("ok_user", F.lit(True))
    if isinstance(units, Hexes):
        city = units.allowed.select(F.col("h3_int").cast("long").alias("raw_unit")).distinct().withColumn("ok_unit", F.lit(True))
        rows = rows.join(city, "raw_unit", "left").withColumn("ok_unit", F.coalesce("ok_unit", F.lit(False)) & F.col("ok_place"))
    else:
        rows = rows.withColumn("ok_unit", F.col("ok_place")).withColumn("ok_place", F.lit(True))
    long_enough = (F.col("end") > F.col("start")) & (F.col("end") - F.col("start") >= options.min_interval_minutes * B.MINUTE)
    used = F.lower("source") == options.point_source_value.strip().lower() if options.point_source_filter and source else F.lit(True)
    return rows.withColumns({"unit": units.unit(options), "ok_time": (F.col("start") >= 0) & (F.col("end") >= F.col("start")), "ok_name": F.col("uuid") != "", "is_interval": long_enough, "used": used})


def _kept(options: Options) -> Column:
    base = F.col("ok_time") & F.col("ok_name") & F.col("ok_user") & F.col("ok_place")
    return base & F.col("ok_unit") if options.oob_mode.lower() == "drop" else base


def observations(rows: DataFrame, options: Options) -> DataFrame:
    """key, uuid, unit, day, is_weekend, window and either strict minutes (of a piece of an interval) or t (of a point)."""
    own = B.bands(options.windows)
    kept = rows.where(_kept(options)).select("key", "uuid", "unit", "start", "end", "is_interval", "used")
    pieces = B.day_pieces(F.col("start"), F.col("end"))
    middle = B.floor_div(F.col("start") + F.col("end"), 2)
    point = F.array(F.struct(B.day_of(middle).alias("day"), F.pmod(middle, F.lit(B.DAY).cast("long")).alias("begin"), F.lit(None).cast("long").alias("stop")))
    none = F.array().cast("array<struct<day:long,begin:long,stop:long>>")
    parts = F.when(F.col("is_interval"), pieces).otherwise(F.when(F.col("used"), point).otherwise(none))
    one = kept.select("key", "uuid", "unit", "is_interval", F.explode(parts).alias("p")).select("key", "uuid", "unit", "is_interval", "p.*")
    strict = lambda b: B.rounded_minutes(b.within_day(F.col("begin"), F.col("stop")), options.overlap_rounding)
    entry = lambda b: F.struct(F.lit(b.name).alias("window"), F.lit(b.parts[0][0]).cast("long").alias("win_start"), F.lit(b.parts[-1][1]).cast("long").alias("win_end"), F.lit(b.length / B.MINUTE).alias("win_len"), F.when(F.col("is_interval"), strict(b)).alias("strict"), F.when(~F.col("is_interval") & b.contains(F.col("begin")), F.col("day") * B.DAY + F.col("begin")).alias("t"))
    found = F.filter(F.array(*[entry(b) for b in own]), lambda e: (e["strict"] > 0) | e["t"].isNotNull())
    return one.select("key", "uuid", "unit", "day", B.is_weekend(F.col("day")).alias("is_weekend"), F.explode(found).alias("e")).select("key", "uuid", "unit", "day", "is_weekend", "e.*")


DAY_KEYS = ["key", "day", "window"]


def shares(seen: DataFrame, units: Cells | Hexes, options: Options) -> DataFrame:
    """By user, day, band and unit: strict and point minutes, and over the user's day and band their sums, what is missing and the factor."""
    if units.early:
        seen = seen.where(F.col("unit").isNotNull() & units.shown(F.col("unit")))
    seen = seen.repartition("key", "day") if options.spread else seen.repartition("key")
    # points stand before intervals and in order; ties in time go by unit
    order = Window.partitionBy(*DAY_KEYS).orderBy(F.col("t").asc_nulls_last(), "unit", "uuid")
    start, end = F.col("day") * B.DAY + F.col("win_start"), F.col("day") * B.DAY + F.col("win_end")
    before, after = F.lag("t").over(order), F.lead("t").over(order)
    upper = F.least(end.cast("double"), F.coalesce((F.col("t") + after) / 2, end.cast("double")))
    lower = F.greatest(start.cast("double"), F.coalesce((before + F.col("t")) / 2, start.cast("double")))
    point = F.when(F.col("t").isNotNull(), F.greatest(F.lit(0.0), upper - lower) / B.MINUTE)
    gap = F.when(F.col("t").isNotNull(), F.greatest(F.coalesce(F.col("t") - before, F.col("t") - start), F.when(after.isNull(), end - F.col("t")).otherwise(F.lit(0).cast("long"))))
    split = seen.withColumn("point", point).withColumn("gap", gap)
    by_unit = split.groupBy(*DAY_KEYS, "is_weekend", "unit").agg(F.coalesce(F.sum("strict"), F.lit(0).cast("long")).cast("double").alias("tau_strict_min"), F.coalesce(F.sum("point"), F.lit(0.0)).alias("tau_point_min"), F.max("gap").alias("gap"), F.min("uuid").alias("uuid"), F.max("uuid").alias("uuid_max"), F.first("win_len").alias("win_len"))
    whole = Window.partitionBy(*DAY_KEYS)
    out = by_unit.withColumn("strict_sum_min", F.sum("tau_strict_min").over(whole)).withColumn("point_sum_min", F.sum("tau_point_min").over(whole)).withColumn("max_gap", F.max("gap").over(whole))
    out = out.withColumn("missing_min", F.greatest(F.lit(0.0), F.col("win_len") - F.col("strict_sum_min")))
    return out.withColumn("fill_factor", F.when(F.col("point_sum_min") > 0, F.col("missing_min") / F.col("point_sum_min")).otherwise(F.lit(0.0)))


def filled(shared: DataFrame, units: Cells | Hexes, options: Options) -> DataFrame:
    """The result: unit columns, window, is_weekend, id columns, tau_strict_min, tau_fill_min, tau_filled_min."""
    fill = F.col("tau_point_min") * F.col("fill_factor")
    shown = shared.where(F.col("unit").isNotNull() & units.shown(F.col("unit")))
    mode = options.id_mode.lower()
    # the least name of a key over all its rows, also those that are not shown
    names = Window.partitionBy("key")
    if mode != "uid64":
        shown = shared.withColumn("name", F.min("uuid").over(names)).where(F.col("unit").isNotNull() & units.shown(F.col("unit")))
    keys = {"uuid": ["name"], "uid64": ["key"], "both": ["key", "name"]}[mode]
    sums = [F.sum("tau_strict_min").cast("int").alias("tau_strict_min"), F.sum(fill).alias("tau_fill_min"), F.sum(F.col("tau_strict_min") + fill).alias("tau_filled_min")]
    # a name has one key, so grouping by key and name is grouping by name, and the rows stay where they are
    out = shown.groupBy(*dict.fromkeys(["key", *keys]), "unit", "window", "is_weekend").agg(*sums)
    ids = ([unsigned(F.col("key")).alias("uid64")] if mode != "uuid" else []) + ([F.col("name").alias("uuid")] if mode != "uid64" else [])
    return out.select(*units.columns(F.col("unit")), "window", "is_weekend", *ids, "tau_strict_min", "tau_fill_min", "tau_filled_min")


def strict_filled(stays: DataFrame, units: Cells | Hexes, options: Options, users: DataFrame | None = None, schema_map: dict | None = None) -> DataFrame:
    seen = observations(marked(stays, units, options, users, schema_map), options)
    return filled(shares(seen, units, options), units, options)


# ---- quality figures -----------------------------------------------------------------------------------------------


def row_counts(rows: DataFrame, units: Cells | Hexes, options: Options) -> DataFrame:
    """One row of counters over marked rows; each filter counts among the rows that those before it let through."""
    own = B.bands(options.windows)
    named = F.col("ok_time") & F.col("ok_name")
    known = named & F.col("ok_user")
    placed_ = known & F.col("ok_place")
    kept = _kept(options)
    interval, point = kept & F.col("is_interval"), kept & ~F.col("is_interval")
    span = B.day_of(F.col("end") - 1) - B.day_of(F.col("start"))
    middle = F.pmod(B.floor_div(F.col("start") + F.col("end"), 2), F.lit(B.DAY).cast("long"))
    inside = F.lit(False)
    for b in own:
        inside = inside | b.contains(middle)
    n = F.count_if
    invalid = [n(known & ~F.col("ok_place")).alias("invalid_coord_rows")] if units.early else []
    return rows.agg(
        F.count(F.lit(1)).alias("input_rows"), n(kept).alias("kept_rows"), n(~F.col("ok_time")).alias("invalid_time_rows"), n(named & ~F.col("ok_user")).alias("filtered_uuid_not_in_table"),
        *invalid, n(placed_ & ~F.col("ok_unit")).alias(f"filtered_oob_{units.name}"), n(interval).alias("interval_rows"), n(point).alias("point_rows"), n(point & F.col("used")).alias("point_rows_used"),
        n(point & F.col("used") & ~inside).alias("point_rows_outside_windows"), n(interval & (span == 1)).alias("interval_cross_day_rows"), n(interval & (span > 1)).alias("interval_multi_day_rows_dropped"),
    )


def day_windows(shared: DataFrame) -> DataFrame:
    """One row for each user, day and band: the factors, and the longest time without a point (the band's length without any)."""
    keys = [*DAY_KEYS, "is_weekend", "strict_sum_min", "point_sum_min", "missing_min", "fill_factor", "win_len"]
    gap = F.coalesce(F.col("max_gap") / B.MINUTE, F.col("win_len"))
    return shared.select(*keys, gap.alias("point_max_gap_min")).dropDuplicates(DAY_KEYS)


def user_counts(days: DataFrame) -> DataFrame:
    return days.agg(F.countDistinct("key").alias("n_users_uid64"), F.count(F.lit(1)).alias("n_user_day_windows"), F.count_if(F.col("point_sum_min") == 0).alias("n_user_day_windows_no_points"), F.count_if(F.col("strict_sum_min") == 0).alias("n_user_day_windows_no_strict"))


def window_figures(days: DataFrame) -> DataFrame:
    """Totals, means and exact quantiles by band."""
    points = F.array(F.lit(0.5), F.lit(0.9), F.lit(0.99))
    q = {k: F.percentile(c, points) for k, c in (("fill_factor", "fill_factor"), ("missing", "missing_min"), ("point_max_gap", "point_max_gap_min"))}
    out = days.groupBy("window").agg(F.count(F.lit(1)).alias("n_user_day_windows"), F.sum("strict_sum_min").alias("strict_sum_total_min"), F.sum("point_sum_min").alias("point_sum_total_min"), F.sum("missing_min").alias("missing_total_min"), F.avg("fill_factor").alias("fill_factor_mean"), *[v.alias(k) for k, v in q.items()])
    return out.select("window", "n_user_day_windows", "strict_sum_total_min", "point_sum_total_min", "missing_total_min", "fill_factor_mean", *[F.col(k)[i].alias(f"{k}_{p}") for k in q for i, p in enumerate(("p50", "p90", "p99"))])


def names_of(seen: DataFrame) -> DataFrame:
    """uid64, its least name, and how many names it has."""
    out = seen.groupBy("key").agg(F.min("uuid").alias("uuid"), F.countDistinct("uuid").alias("n_uuid"))
    return out.select(unsigned(F.col("key")).alias("uid64"), "uuid", "n_uuid")
