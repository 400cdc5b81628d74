"""Hand-computed cases, invariants and odd inputs of the stay and visit operators."""

import hashlib
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from dwell.functions import bands as B
from dwell.functions import histograms as H
from dwell.functions import projection
from dwell.functions.columns import as_text, equals, find, lon_lat, need
from dwell.functions.hashing import uid64
from dwell.functions.hexcells import cell_number, cell_text, cell_uid
from dwell.functions.space import Grid, placed
from dwell.operators import fill, minutes, visits
from dwell.operators.covariates import covariates
from dwell.operators.stays import Clock, city_value, coordinate_mode
from dwell.plans import catalogue
from dwell.plans import inputs as I
from tests.conftest import SF

DAY0 = 19_723 * B.DAY  # 2024-01-01, a Monday
LOCAL = Clock(timestamps_are_utc=False)
GRID = Grid("EPSG:32650", 0.0, 0.0, 10, 500.0, 10, (0.0, 0.0, 5000.0, 5000.0))


def reference_uid64(name, method):
    """In plain Python: the first eight bytes of the digest, last byte first."""
    digest = (hashlib.sha256 if method == "sha256_64" else hashlib.md5)(name.encode()).digest()
    return int.from_bytes(digest[:8], "little") if name else 0


def at(text, day=0):
    h, m, *s = map(int, text.split(":"))
    return DAY0 + day * B.DAY + ((h * 60 + m) * 60 + (s[0] if s else 0)) * 1000


RECORDS = [
    (at("12:00"), at("13:00"), 60, 0), (at("11:00"), at("14:30"), 150, 0), (at("16:00"), at("23:00"), 0, 240), (at("20:00"), at("12:00", 1), 30, 60),
    (at("13:00"), at("13:00", 2), 300, 480), (at("20:00"), at("00:00", 1), 0, 60), (at("12:30"), at("12:30"), 0, 0), (at("13:59:30"), at("14:10"), 0, 0), (-5, at("12:00"), 0, 0), (at("13:00"), at("12:00"), 0, 0),
]


def test_record_minutes(spark):
    df = spark.createDataFrame(RECORDS, "a long, b long, lunch long, dinner long")
    lunch, dinner = B.bands("Lunch, dinner")
    got = df.select("lunch", "dinner", B.record_minutes(F.col("a"), F.col("b"), lunch).alias("x"), B.record_minutes(F.col("a"), F.col("b"), dinner).alias("y")).collect()
    assert [(r.x, r.y) for r in got] == [(r.lunch, r.dinner) for r in got]
    half = spark.createDataFrame([(at("13:59:30"), at("14:10"))], "a long, b long")
    assert [half.select(B.record_minutes(F.col("a"), F.col("b"), lunch, r)).first()[0] for r in ("floor", "round", "ceil")] == [0, 1, 1]
    with pytest.raises(ValueError):
        B.bands("breakfast")


def test_a_band_over_midnight_against_brute_force(spark):
    night = B.TimeBand.of("night", "22:00", "02:00")
    rng = random.Random(2)
    rows = [(a := at("00:00") + rng.randrange(0, 3 * 1440) * B.MINUTE, a + rng.randrange(1, 4000) * B.MINUTE) for _ in range(200)]
    got = spark.createDataFrame(rows, "a long, b long").select("a", "b", B.record_minutes(F.col("a"), F.col("b"), night).alias("n")).collect()
    for r in got:
        assert r.n == sum((t % B.DAY) >= night.start or (t % B.DAY) < night.end for t in range(r.a, r.b, B.MINUTE))


def stays(spark, rows):
    return spark.createDataFrame(rows, "uuid string, poi_id long, start_time long, end_time long, x double, y double, source string")


def result(spark, rows, **more):
    args = (stays(spark, rows), fill.Cells(GRID, code="C", output_id=True), fill.Options(clock=LOCAL, id_mode="both", **more))
    return {(r.uuid, r.grid_id, r.window, r.is_weekend): (r.tau_strict_min, round(r.tau_fill_min, 9), round(r.tau_filled_min, 9)) for r in fill.strict_filled(*args).collect()}


A, BB, C = (250.0, 250.0), (750.0, 250.0), (1250.0, 250.0)


def point(u, t, cell, day=0):
    return (u, 1, at(t, day), at(t, day), *cell, "CELL_appearance")


def stay(u, a, b, cell, day=0, end_day=None):
    return (u, 1, at(a, day), at(b, day if end_day is None else end_day), *cell, "stay")


def test_midpoints_and_fill(spark):
    rows = [point("one", "12:10", A), point("two", "12:00", A), point("two", "13:00", BB), point("mix", "12:00", A), point("mix", "13:00", BB), stay("mix", "11:30", "12:00", C), stay("only", "12:00", "12:30", C)]
    rows += [stay("over", "11:30", "14:00", A), stay("over", "11:30", "12:20", BB), point("over", "12:00", C), stay("late", "20:00", "12:00", A, 4, 5), stay("long", "13:00", "13:00", A, 0, 2), ("short", 1, at("12:00"), at("12:04"), *A, "cell_appearance"), ("other", 1, at("12:00"), at("12:00"), *A, "wifi")]
    got = result(spark, rows)
    assert got == {
        ("one", 0, "lunch", False): (0, 150.0, 150.0), ("two", 0, "lunch", False): (0, 60.0, 60.0), ("two", 1, "lunch", False): (0, 90.0, 90.0),
        ("mix", 0, "lunch", False): (0, 48.0, 48.0), ("mix", 1, "lunch", False): (0, 72.0, 72.0), ("mix", 2, "lunch", False): (30, 0.0, 30.0), ("only", 2, "lunch", False): (30, 0.0, 30.0),
        ("over", 0, "lunch", False): (150, 0.0, 150.0), ("over", 1, "lunch", False): (50, 0.0, 50.0), ("over", 2, "lunch", False): (0, 0.0, 0.0),
        ("late", 0, "dinner", False): (60, 0.0, 60.0), ("late", 0, "lunch", True): (30, 0.0, 30.0), ("short", 0, "lunch", False): (0, 150.0, 150.0),
    }
    assert ("other", 0, "lunch", False) in result(spark, rows, point_source_filter=False)


def test_golden_totals(spark):
    args = catalogue._p3(spark, SF)
    units, options = args[1], args[2]
    rows = fill.marked(*args)
    qa = fill.row_counts(rows, units, options).first()
    assert (qa.input_rows, qa.filtered_oob_grid, qa.kept_rows) == (10_000, 3_029, 6_971)
    assert (qa.interval_rows, qa.interval_cross_day_rows, qa.interval_multi_day_rows_dropped) == (3_822, 158, 0)
    assert (qa.point_rows, qa.point_rows_used, qa.point_rows_outside_windows) == (3_149, 1_356, 965)
    shared = fill.shares(fill.observations(rows, options), units, options)
    days = fill.day_windows(shared)
    r = fill.user_counts(days).first()
    assert (r.n_user_day_windows, r.n_user_day_windows_no_points, r.n_user_day_windows_no_strict) == (1_549, 1_170, 332)
    out = fill.filled(shared, units, options)
    s = out.agg(F.count(F.lit(1)).alias("n"), F.sum("tau_strict_min").alias("s"), F.sum("tau_fill_min").alias("f")).first()
    assert (s.n, s.s, round(s.f, 4)) == (1_668, 56_340, 73_217.0)
    # shares of a user's day and band sum to its length; filled minutes to the length, or to what is strict
    for d in shared.groupBy("key", "day", "window").agg(F.sum("tau_point_min").alias("p"), F.sum(F.col("tau_strict_min") + F.col("tau_point_min") * F.col("fill_factor")).alias("f"), F.first("win_len").alias("w"), F.first("strict_sum_min").alias("s")).collect():
        assert abs(d.p - (d.w if d.p else 0)) < 1e-6 and abs(d.f - (max(d.w, d.s) if d.p else d.s)) < 1e-6


def test_rows_are_dealt_by_user_and_day(spark):
    plan = lambda **more: fill.strict_filled(*catalogue._p3(spark, SF, **more))._jdf.queryExecution().executedPlan().toString()
    by_day, by_user = plan(), plan(spread=False)
    assert by_day.count("Exchange hashpartitioning") == 2 and "Exchange hashpartitioning(key#" in by_day and ", day#" in by_day.split("Exchange hashpartitioning")[2].split(")")[0] and "Python" not in by_day
    assert by_user.count("Exchange hashpartitioning") == 1


def test_pushed_city_filter(spark):
    df = spark.read.parquet(f"{SF}/customer.parquet").where(equals(spark.read.parquet(f"{SF}/customer.parquet"), "c_nationkey", "7"))
    assert "EqualTo(c_nationkey,7)" in df._jdf.queryExecution().executedPlan().toString()
    floats = spark.createDataFrame([(440300.0,), (1.5,), (None,)], "c double")
    assert [r[0] for r in floats.select(as_text(floats, "c")).collect()] == ["440300", "1.5", ""]
    assert city_value(None, " ", "44") == "44"
    with pytest.raises(ValueError):
        city_value(None, None, None)


def test_grid(spark):
    df = spark.createDataFrame([(250.0, 250.0), (750.0, 1250.0), (5000.0, 0.0), (-1.0, 0.0), (float("nan"), 1.0), (None, 1.0), (5000.0, 5001.0)], "x double, y double")
    cell, inside = GRID.cell(F.col("x"), F.col("y"))
    got = df.select(cell.alias("c"), inside.alias("i"), *[placed(cell, inside, m).alias(m) for m in ("drop", "null", "keep")], GRID.uid(cell, "grid", "C").alias("u"), GRID.uid(cell, "grid", "C", "row_col").alias("v")).collect()
    assert [(r.c, r.i) for r in got] == [(0, True), (21, True), (10, False), (-1, False), (None, False), (None, False), (110, False)]
    assert [(r["drop"], r["null"], r["keep"]) for r in got][2:5] == [(None, -1, 10), (None, -1, -1), (None, -1, -1)]
    assert (got[0].u, got[1].u, got[1].v) == ("grid_C_0_0", "grid_C_1_2", "grid_C_2_1")
    with pytest.raises(ValueError):
        GRID.uid(F.col("x"), "g", "c", "other")


def test_hashes(spark):
    df = spark.createDataFrame([("abc",), ("",), (None,), ("é",)], "u string")
    got = {m: [int(r[0]) for r in df.select(uid64(F.col("u"), m)).collect()] for m in ("sha256_64", "md5_64", "xxh64")}
    assert [got[m][0] for m in got] == [16919744041952114874, 12704604231530709392, 4952883123889572249]
    assert all(v[1:3] == [0, 0] for v in got.values())
    assert [got[m][3] for m in ("sha256_64", "md5_64")] == [reference_uid64("é", m) for m in ("sha256_64", "md5_64")]
    import pandas as pd

    assert [int(r[0]) for r in df.where("u <> ''").select(uid64(F.col("u"), "pandas_64")).collect()] == pd.util.hash_pandas_object(pd.Series(["abc", "é"]), index=False).tolist()
    with pytest.raises(ValueError):
        uid64(F.col("u"), "crc")


def test_hex_cells(spark):
    r = spark.createDataFrame([("8928308280fffff",)], "h string").select(cell_number(F.col("h")).alias("n"), cell_text(cell_number(F.col("h"))).alias("t"), cell_uid(cell_number(F.col("h")), "hex", "440300").alias("u")).first()
    assert tuple(r) == (617700169958293503, "8928308280fffff", "hex_440300__8928308280fffff")


def test_float_text(spark):
    values = [0.0, 1.0, 0.5, 1 / 3, 2 / 3, 1 / 128, 1e-6, 2.5e-5, 9.9e-5, 1e-4, 4e-5, 0.123456, 0.1234565, 1.25, 2.0, 1e-7, 0.999999, 0.9999999] + [random.Random(3).random() for _ in range(200)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", H.float_text(F.col("v")).alias("t")).collect()
    assert [r.t for r in got] == [repr(round(r.v, 6)) for r in got]


def visit_rows(spark, rows):
    return spark.createDataFrame(rows, "uuid string, poi_id long, start_hour int, end_hour int, stay_minutes double, date_str string")


def test_profile_by_hand(spark):
    rows = [("a", 1, 8, 9, 10.0, "2024-12-02"), ("a", 1, 8, 10, 20.0, "2024-12-07"), ("a", 1, 9, 30, 30.0, "2024-12-31"), ("b", 1, -1, None, None, "2024-12-30"), ("b", 2, 8, 8, 5.0, None), ("c", 0, 1, 1, 1.0, "2025-01-30"), (None, 3, 1, 1, 1.0, "2025-01-30"), ("d", None, 1, 1, 1.0, "2025-01-30"), ("e", 5, 23, 0, float("nan"), "20241229")]
    spec = {"daytime": {"start_hour": 22, "end_hour": 6}, "enter_periods": [{"name": "早", "hours": [8, 8, 99]}, {"name": "none"}, {"hours": [1]}, "bad", {"name": "late", "start_hour": 22, "end_hour": 2}], "weekday_groups": [{"name": "x", "days": ["1", 6, 9, "q"]}, {"name": "y"}], "date_groups": [{"name": "r", "ranges": [["2024-11-28", "2024-12-03"], [30, 31], ["bad", 1]], "days_of_month": [2, 40, "7"]}]}
    got = {(r.uuid, r.poi_id): r for r in visits.profile(visit_rows(spark, rows), spec).collect()}
    assert set(got) == {("a", 1), ("b", 1), ("b", 2), ("e", 5)}
    a, b, n, e = got["a", 1], got["b", 1], got["b", 2], got["e", 5]
    assert (a.visit_count, a.total_stay_minutes, a.avg_stay_minutes, a.max_stay_minutes) == (3, 60.0, 20.0, 30.0) and abs(a.std_stay_minutes - 8.16496580927726) < 1e-9
    assert (a.first_visit_date, a.last_visit_date, a.last_visit_recency_days) == ("2024-12-02", "2024-12-31", 0)
    assert (a.enter_hour_dist, a.top_enter_hours, a.leave_hour_dist) == ('{"8": 2, "9": 1}', "[8, 9, 0]", '{"9": 1, "10": 1}')
    assert (a.weekday_visit_ratio, a.daytime_ratio, a.night_ratio) == (2 / 3, 0.0, 1.0)
    assert json.loads(a.enter_period_stats) == {"早": {"visits": 4, "ratio": round(4 / 3, 6)}, "none": {"visits": 0, "ratio": 0.0}, "late": {"visits": 0, "ratio": 0.0}} and "早" in a.enter_period_stats
    assert json.loads(a.weekday_group_stats) == {"x": {"visits": 2, "ratio": round(2 / 3, 6)}} and a.leave_period_stats == "{}"
    assert json.loads(a.date_group_stats) == {"r": {"visits": 3, "ratio": 1.0}}
    assert (b.total_stay_minutes, b.max_stay_minutes, b.std_stay_minutes, b.daytime_ratio, b.night_ratio, b.top_enter_hours) == (0.0, 0.0, 0.0, 0.0, 1.0, "[0, 1, 2]")
    assert (n.last_visit_date, n.weekday_visit_ratio, n.weekend_visit_ratio, n.visit_weekday_dist) == (None, 0.0, 1.0, "{}")
    assert (e.last_visit_date, e.daytime_ratio, e.total_stay_minutes) == ("2024-12-29", 1.0, 0.0)
    assert visits.profile(visit_rows(spark, [])).columns == visits.PROFILE_COLUMNS and visits.profile(visit_rows(spark, [])).count() == 0
    assert visits.profile(visit_rows(spark, rows), max_rows=0).count() == 0
    assert visits.group_dates({"ranges": [["2024-11-28", "2024-12-03"]]}) == list(range(3, 29))


def test_text_places(spark):
    df = spark.createDataFrame([("a", "0", 1, 1, 1.0, "2024-01-01", "[1, 2]"), ("a", "00", 1, 1, 1.0, "2024-01-01", None), ("b", "00", 1, 1, 1.0, "2024-01-01", "[3, 4]")], "uuid string, poi_id string, start_hour int, end_hour int, stay_minutes double, date_str string, location string")
    assert {r.poi_id for r in visits.profile(df).collect()} == {"00"}
    assert [tuple(r) for r in visits.first_locations(df.coalesce(1)).collect()] == [("00", None)]


def test_null_times(spark):
    rows = [("u", 1, None, at("13:00"), *A, "stay"), ("u", 1, None, None, *A, "cell_appearance"), ("v", 1, at("12:00"), at("13:00"), *A, "stay")]
    o = lambda c: minutes.Options(windows="lunch", clock=c, output_grid_id=True, grid_uid_code="C")
    of = lambda c: minutes.grid_minutes_qa(minutes.marked(stays(spark, rows), GRID, o(c)), o(c)).first()
    assert (of(Clock()).invalid_time_rows, of(Clock(null_time="compat")).invalid_time_rows, of(Clock(null_time="compat")).kept_rows > of(Clock()).kept_rows) == (2, 1, True)


def test_clock_and_columns(spark):
    df = spark.createDataFrame([(1704067200, "1704067200", "x", None)], "a long, b string, c string, d string")
    c = Clock("s", True, 8)
    r = df.select(*[c.local(df, n).alias(n) for n in "abcd"]).first()
    assert tuple(r) == (DAY0 + 8 * 3_600_000, DAY0 + 8 * 3_600_000, -1, -1)
    stamp = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00.0019' AS t")
    assert stamp.select(Clock(timestamps_are_utc=False).local(stamp, "t")).first()[0] == DAY0 + 1
    assert find(["User_ID", "UUID"], "uuid") == "UUID" and find(["my_user"], "uuid") == "my_user" and find(["a"], "uuid", {"uuid": "a"}) == "a"
    with pytest.raises(ValueError):
        need(["a"], "poi_id")
    assert coordinate_mode(["lon", "lat", "x", "y"]) == "xy" and coordinate_mode(["lon", "lat", "x", "y"], hexes=True) == "lonlat" and coordinate_mode(["location"]) == "location"
    with pytest.raises(ValueError):
        coordinate_mode(["a"])
    t = spark.createDataFrame([("[113.9, 22.5]",), ("(1,2)",), ("1",), ("",), (None,), ("a,b",)], "l string")
    lon, lat = lon_lat(F.col("l"))
    assert [tuple(r) for r in t.select(lon, lat).collect()] == [(113.9, 22.5), (1.0, 2.0), (1.0, None), (None, None), (None, None), (None, None)]


def test_projection(spark):
    df = spark.createDataFrame([(117.0, 0.0), (117.0, 45.0), (180.0, 0.0), (None, 1.0), (1.0, 95.0)], "lon double, lat double")
    utm = [tuple(r) for r in df.select(*projection.project(F.col("lon"), F.col("lat"), "EPSG:4326", "EPSG:32650")).collect()]
    assert abs(utm[0][0] - 500_000) < 1e-6 and abs(utm[0][1]) < 1e-6
    assert abs(utm[1][1] - 0.9996 * 4_984_944.378) < 0.01 and utm[3] == utm[4] == (None, None)
    web = df.select(*projection.project(F.col("lon"), F.col("lat"), "EPSG:4326", "EPSG:3857")).collect()
    assert abs(web[2][0] - math.pi * 6378137.0) < 1e-6 and abs(web[2][1]) < 1e-6
    # along the equator a quarter of a degree off the meridian, by integrating the scale
    off = spark.createDataFrame([(117.25, 22.5), (116.75, 22.5)], "lon double, lat double").select(*projection.project(F.col("lon"), F.col("lat"), "EPSG:4326", "EPSG:32650")).collect()
    assert abs(off[0][0] + off[1][0] - 1_000_000) < 1e-6 and off[0][1] == pytest.approx(off[1][1], abs=1e-6)
    radius = 6378137.0 / math.sqrt(1 - 0.0066943799901413165 * math.sin(math.radians(22.5)) ** 2)
    assert abs((off[0][0] - 500_000) / 0.9996 - radius * math.cos(math.radians(22.5)) * math.radians(0.25)) < 0.5
    with pytest.raises(ValueError):
        projection.project(F.col("lon"), F.col("lat"), "EPSG:4326", "EPSG:2326")


def test_food_and_options(spark):
    poi = spark.createDataFrame([(1, "Fast FOOD"), (2, "shop"), (3, None), (None, "food"), (1, "cafe")], "poi_id long, category string")
    assert [r.poi for r in minutes.food_places(poi, minutes.FOOD_KEYWORDS).collect()] == ["1"]
    for bad in ({"output_grid_uid": False}, {"poi_filter_mode": "x"}, {"overlap_rounding": "x"}, {"uuid_hash_method": "x"}):
        with pytest.raises(ValueError):
            minutes.Options(**bad)
    for bad in ({"id_mode": "x"}, {"oob_mode": "x"}):
        with pytest.raises(ValueError):
            fill.Options(**bad)
    rows = [("u", 1, at("12:00"), at("13:00"), *A, "stay"), ("u", 2, at("12:00"), at("13:00"), *A, "stay"), ("u", 0, at("12:00"), at("13:00"), *A, "stay"), ("", 1, at("12:00"), at("13:00"), *A, "stay"), ("u", -4, at("12:00"), at("13:00"), *A, "stay")]
    for mode, n in (("all_stops", 2), ("only_food_poi", 1), ("exclude_food_poi", 1)):
        o = minutes.Options(clock=LOCAL, poi_filter_mode=mode, grid_uid_code="C")
        got = minutes.grid_minutes(minutes.marked(stays(spark, rows), GRID, o, poi), GRID, o).collect()
        assert [(r.grid_uid, r.tau_lunch_min, r.n_stops_lunch) for r in got] == [("grid_C_0_0", 60 * n, n)]
    with pytest.raises(ValueError):
        minutes.marked(stays(spark, rows), GRID, minutes.Options(poi_filter_mode="only_food_poi"))


def test_allow_list_and_empty(spark):
    rows = [stay("u", "12:00", "13:00", A), stay("v", "12:00", "13:00", A)]
    users = spark.createDataFrame([("u",), (None,), ("u",)], "uuid string")
    o = fill.Options(clock=LOCAL, drop_uuid_not_in_table=True, id_mode="uuid")
    cells = fill.Cells(GRID, code="C")
    assert [r.uuid for r in fill.strict_filled(stays(spark, rows), cells, o, users).collect()] == ["u"]
    with pytest.raises(ValueError):
        fill.strict_filled(stays(spark, rows), cells, o)
    empty = fill.strict_filled(stays(spark, []), cells, fill.Options(clock=LOCAL))
    assert empty.count() == 0 and empty.columns == ["grid_uid", "window", "is_weekend", "uuid", "tau_strict_min", "tau_fill_min", "tau_filled_min"]


def test_covariates(spark):
    df = spark.createDataFrame([("a", 1.0, "s", 250.0, 250.0, 117.0, 0.0), ("a", 2.0, "t", -5.0, 1.0, None, None)], "uuid string, ses_a double, SES_b string, home_x double, home_y double, work_lon double, work_lat double")
    grid = Grid("EPSG:32650", 499_900.0, -100.0, 10)
    out = covariates(df, grid, output_grid_id=True, code="C")
    assert out.columns == ["uuid_hash", "ses_a", "SES_b", "home_grid_id", "work_grid_id", "home_grid_uid", "work_grid_uid"]
    got = out.collect()
    assert got[0].work_grid_uid == "grid_C_0_0" and got[1].work_grid_uid is None and got[0].home_grid_id is None
    assert covariates(df, grid, {"uuid_table": {"ses_cols": "SES_b, nothing"}}).columns == ["uuid_hash", "SES_b", "home_grid_uid", "work_grid_uid"]


def test_day_sums_on_a_stream(spark, tmp_path):
    from dwell.streaming.minutes import daily_strict, observation_stream

    source = I.stays(spark, SF).drop("event_id")
    source.write.parquet(f"{tmp_path}/in")
    units, o = fill.Cells(GRID, code="C"), fill.Options(clock=LOCAL)
    names = {"staypoints": {"start_time": "start_ms", "end_time": "end_ms"}}
    stream = daily_strict(observation_stream(spark.readStream.schema(source.schema).parquet(f"{tmp_path}/in"), units, o, names))
    run = stream.writeStream.format("memory").queryName("day_sums").outputMode("complete").trigger(availableNow=True).start()
    run.awaitTermination(120)
    want = fill.observations(fill.marked(source, units, o, schema_map=names), o).where("strict > 0").groupBy("key", "day", "unit", "window").agg(F.sum("strict").alias("s"))
    assert sorted(r.tau_strict_min for r in spark.table("day_sums").collect()) == sorted(r.s for r in want.collect())
