"""Minutes of users in grid cells within time bands, whole records (multi-day stays included), one wide row for each
user and cell. One scan, one aggregation with partial results, one shuffle. Quality figures are one more aggregation
over the same marked rows: each filter counts among the rows that the filters before it let through."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwell.functions import bands as B
from dwell.functions import columns as C
from dwell.functions.hashing import METHODS, uid_key, unsigned
from dwell.functions.space import Grid, placed
from dwell.operators.stays import Clock, city_rows, coordinate_mode, coordinates

#: Patterns (regular expressions) that mark a category as food.
FOOD_KEYWORDS = ["餐", "餐饮", "餐厅", "饭", "美食", "小吃", "奶茶", "咖啡", "茶饮", "restaurant", "food", "cafe", "coffee", "tea"]
POI_MODES = ("all_stops", "exclude_food_poi", "only_food_poi")
BROADCAST_PLACES = 1_000_000


@dataclass(frozen=True)
class Options:
    windows: str | list[str] = "lunch"
    min_stay_minutes: int = 5
    exclude_poi_id_zero: bool = True
    poi_filter_mode: str = "all_stops"
    food_category_keywords: list[str] = field(default_factory=lambda: list(FOOD_KEYWORDS))
    clock: Clock = Clock()
    coords_already_projected: bool = False
    uuid_hash_method: str = "sha256_64"
    overlap_rounding: str = "floor"
    oob_mode: str = "drop"
    output_grid_uid: bool = True
    output_grid_id: bool = False
    grid_uid_prefix: str = "grid"
    grid_uid_code: str = ""
    grid_uid_order: str = "col_row"
    city_code_col: str | None = None
    city_code_value: str | None = None

    def __post_init__(self):
        if not (self.output_grid_uid or self.output_grid_id):
            raise ValueError("output_grid_uid or output_grid_id must be true")
        if self.poi_filter_mode.lower() not in POI_MODES:
            raise ValueError(f"poi_filter_mode is one of {', '.join(POI_MODES)}")
        if self.overlap_rounding not in B.ROUNDING:
            raise ValueError("overlap_rounding is floor, round or ceil")
        if self.uuid_hash_method not in METHODS:
            raise ValueError(f"uuid_hash_method is one of {', '.join(METHODS)}")


def food_places(poi: DataFrame, keywords: list[str], given: dict | None = None) -> DataFrame:
    """Distinct ids, as text, of places whose category matches a keyword in any case."""
    own, kind = C.need(poi.columns, "poi_id", given), C.need(poi.columns, "category", given)
    words = [k.lower() for k in keywords if k.strip()]
    hit = F.lit(False)
    for k in words:
        hit = hit | F.lower(C.as_text(poi, kind)).rlike(k)
    return poi.where(hit).select(C.as_text(poi, own).alias("poi")).where("poi <> ''").distinct()


def marked(stays: DataFrame, grid: Grid, options: Options, poi: DataFrame | None = None, schema_map: dict | None = None) -> DataFrame:
    """Each row with what every filter says of it (ok_*), minutes by band, the cell, and the difference of stay minutes."""
    given = (schema_map or {}).get("staypoints") or {}
    names = stays.columns
    if options.city_code_value is not None:
        stays = city_rows(stays, options.city_code_value, options.city_code_col, given)
    start = options.clock.local(stays, C.need(names, "start_time", given))
    end = options.clock.local(stays, C.need(names, "end_time", given))
    place = C.need(names, "poi_id", given)
    numeric = C.kind(stays, place).typeName() != "string"
    stay = C.find(names, "stay_minutes", given)
    x, y = coordinates(stays, coordinate_mode(names, given), given, grid.coord_crs, grid.grid_crs, options.coords_already_projected)
    rows = stays.select(
        C.as_text(stays, C.need(names, "uuid", given)).alias("uuid"),
        (C.as_long(stays, place) if numeric else F.trim(C.as_text(stays, place))).alias("place"),
        start.alias("start"), end.alias("end"), x.alias("x"), y.alias("y"),
        (C.as_double(stays, stay) if stay else F.lit(None).cast("double")).alias("given_minutes"),
    )
    computed = (F.col("end") - F.col("start")) / B.MINUTE
    minutes = F.col("given_minutes") if stay else computed
    if options.poi_filter_mode.lower() == "all_stops":
        rows = rows.withColumn("is_food", F.lit(False))
    else:
        if poi is None:
            raise ValueError("a table of places is needed to filter by category")
        food = food_places(poi, options.food_category_keywords, (schema_map or {}).get("poi_meta"))
        food = food.withColumn("is_food", F.lit(True))
        few = food.limit(BROADCAST_PLACES + 1).count() <= BROADCAST_PLACES
        rows = rows.join(F.broadcast(food) if few else food, F.col("place").cast("string") == F.col("poi"), "left").withColumn("is_food", F.coalesce("is_food", F.lit(False)))
    own = {b.name: b for b in B.bands(options.windows)}
    valid = (F.col("start") >= 0) & (F.col("end") > F.col("start"))
    poi_ok = F.col("place") >= 0 if numeric else F.col("place") != ""
    zero = F.col("place") == (F.lit(0) if numeric else F.lit("0"))
    wanted = {"all_stops": F.lit(True), "exclude_food_poi": ~F.col("is_food"), "only_food_poi": F.col("is_food")}[options.poi_filter_mode.lower()]
    cell, inside = grid.cell(F.col("x"), F.col("y"))
    out = rows.withColumns({
        "ok_time": valid,
        "ok_keys": F.coalesce((F.col("uuid") != "") & poi_ok, F.lit(False)),
        "ok_zero": ~zero if options.exclude_poi_id_zero else F.lit(True),
        "ok_stay": F.coalesce(minutes >= float(options.min_stay_minutes), F.lit(False)) if options.min_stay_minutes > 0 else F.lit(True),
        "ok_category": wanted,
        "lunch": B.record_minutes(F.col("start"), F.col("end"), own["lunch"], options.overlap_rounding) if "lunch" in own else F.lit(0).cast("long"),
        "dinner": B.record_minutes(F.col("start"), F.col("end"), own["dinner"], options.overlap_rounding) if "dinner" in own else F.lit(0).cast("long"),
        "crosses": B.crosses_midnight(F.col("start"), F.col("end")),
        "ok_grid": inside,
        "grid_id": placed(cell, inside, options.oob_mode),
        "error": F.col("given_minutes") - computed,
    })
    return out


def _sieve(options: Options) -> dict[str, Column]:
    """Which rows each filter sees, in order."""
    seen, out = F.col("ok_time") & F.col("ok_keys"), {}
    for name, ok in (("poi_id_zero", F.col("ok_zero")), ("min_stay", F.col("ok_stay")), ("poi_category", F.col("ok_category"))):
        out[name] = seen & ~ok
        seen = seen & ok
    out["timed"] = seen
    in_band = (F.col("lunch") > 0) | (F.col("dinner") > 0)
    out["not_in_windows"] = seen & ~in_band
    seen = seen & in_band
    out["oob_grid"] = seen & ~F.col("ok_grid")
    out["kept"] = seen & F.col("ok_grid") if options.oob_mode.lower() == "drop" else seen
    return out


def grid_minutes(rows: DataFrame, grid: Grid, options: Options) -> DataFrame:
    """From marked rows: uuid_hash, [grid_id], [grid_uid], minutes and stops by band."""
    kept = rows.where(_sieve(options)["kept"]).where(F.col("grid_id").isNotNull() & (F.col("grid_id") >= 0))
    kept = kept.select(uid_key(F.col("uuid"), options.uuid_hash_method).alias("key"), "grid_id", "lunch", "dinner")
    sums = kept.groupBy("key", "grid_id").agg(
        F.sum("lunch").cast("int").alias("tau_lunch_min"), F.sum("dinner").cast("int").alias("tau_dinner_min"),
        F.sum(F.col("lunch") + F.col("dinner")).cast("int").alias("tau_total_min"),
        F.sum((F.col("lunch") > 0).cast("int")).cast("int").alias("n_stops_lunch"), F.sum((F.col("dinner") > 0).cast("int")).cast("int").alias("n_stops_dinner"),
    )
    spatial = [F.col("grid_id").cast("int").alias("grid_id")] if options.output_grid_id else []
    if options.output_grid_uid:
        spatial.append(grid.uid(F.col("grid_id"), options.grid_uid_prefix, options.grid_uid_code, options.grid_uid_order).alias("grid_uid"))
    return sums.select(unsigned(F.col("key")).alias("uuid_hash"), *spatial, "tau_lunch_min", "tau_dinner_min", "tau_total_min", "n_stops_lunch", "n_stops_dinner")


def grid_minutes_qa(rows: DataFrame, options: Options) -> DataFrame:
    """One row of counters and ratios, in one pass over marked rows."""
    s = _sieve(options)
    n = lambda c: F.count_if(c)
    total = lambda c: F.coalesce(F.sum(F.when(s["kept"], c)), F.lit(0).cast("long"))
    errors = F.percentile("error", F.array(F.lit(0.5), F.lit(0.9), F.lit(0.99)))
    one = rows.agg(
        F.count(F.lit(1)).alias("input_rows"), n(s["kept"]).alias("kept_rows"), *[n(s[k]).alias(f"filtered_{k}") for k in ("poi_id_zero", "min_stay", "poi_category", "not_in_windows", "oob_grid")],
        n(~F.col("ok_time")).alias("invalid_time_rows"), n(s["timed"] & F.col("crosses")).alias("cross_midnight_rows"),
        total(F.col("lunch")).alias("tau_lunch_total_min"), total(F.col("dinner")).alias("tau_dinner_total_min"), total(F.col("lunch") + F.col("dinner")).alias("tau_total_min"),
        errors.alias("e"),
    )
    part = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return one.select(
        *[c for c in one.columns if c != "e"], part("cross_midnight_rows", "input_rows").alias("pct_cross_midnight"), part("kept_rows", "input_rows").alias("kept_row_ratio"),
        part("tau_lunch_total_min", "tau_total_min").alias("tau_lunch_ratio"), part("tau_dinner_total_min", "tau_total_min").alias("tau_dinner_ratio"),
        *[F.col("e")[i].alias(f"stay_minutes_error_{p}") for i, p in enumerate(("p50", "p90", "p99"))],
    )


def unique_cells(minutes: DataFrame) -> DataFrame:
    """The mean number of cells that a user has minutes in, by band."""
    cells = minutes.groupBy("uuid_hash").agg(F.count_if(F.col("tau_lunch_min") > 0).alias("l"), F.count_if(F.col("tau_dinner_min") > 0).alias("d"))
    mean = lambda c: F.coalesce(F.avg(F.when(F.col(c) > 0, F.col(c))), F.lit(0.0))
    return cells.agg(mean("l").alias("avg_unique_grids_per_user_lunch"), mean("d").alias("avg_unique_grids_per_user_dinner"))
