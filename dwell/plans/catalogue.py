"""Every operator as a query over whole tables, with SQL that says the same.

Doubles go out as whole millionths, so that the order of summation does not show; unsigned numbers go out as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwell.functions import bands as B
from dwell.functions import histograms as H
from dwell.functions.columns import equals, lon_lat
from dwell.functions.hashing import uid64
from dwell.functions.hexcells import cell_uid
from dwell.operators import explore, fill, minutes, visits
from dwell.operators.covariates import covariates
from dwell.operators.stays import Clock
from dwell.plans import inputs as I
from dwell.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
LOCAL = Clock(timestamps_are_utc=False)


def micro(name: str) -> F.Column:
    return F.floor(F.col(name) * 1e6 + 0.5).cast("long").alias(name)


def out(df: DataFrame) -> DataFrame:
    """Doubles as millionths, decimals as text, whole numbers as long."""
    cols = []
    for f in df.schema:
        c = F.col(f.name)
        cols.append(micro(f.name) if isinstance(f.dataType, T.DoubleType) else c.cast("string").alias(f.name) if isinstance(f.dataType, T.DecimalType) else c.cast("long").alias(f.name) if isinstance(f.dataType, T.IntegerType) else c)
    return df.select(*cols)


def u(sql: str, name: str | None = None) -> str:
    return f"CAST(floor(({sql}) * 1e6 + 0.5) AS BIGINT)" + (f" AS {name}" if name else "")


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: out(f(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return add


# ---- visits --------------------------------------------------------------------------------------------------------


def _hist_sql(value: str, bins: range) -> str:
    return "list_value(" + ", ".join(f"count(*) FILTER (WHERE {value} = {b})" for b in bins) + ")"


def _json_sql(hist: str, first: int) -> str:
    return f"""'{{' || array_to_string(list_filter(list_transform({hist}, lambda n, i: CASE WHEN n > 0 THEN '"' || CAST(i - 1 + {first} AS VARCHAR) || '": ' || CAST(n AS VARCHAR) END), lambda t: t IS NOT NULL), ', ') || '}}'"""


def _top_sql(hist: str, first: int) -> str:
    return f"""'[' || array_to_string(list_transform(list_sort(list_transform({hist}, lambda n, i: {{'a': -n, 'b': i - 1 + {first}}}))[1:3], lambda s: CAST(s.b AS VARCHAR)), ', ') || ']'"""


def _float_sql(x: str) -> str:
    """As Python writes a float that was rounded to six places."""
    m = f"CAST(round_even({x}, 6) * 1000000 + 0.1 AS BIGINT)"
    return f"""CASE WHEN {m} % 1000000 = 0 THEN CAST({m} // 1000000 AS VARCHAR) || '.0'
      WHEN {m} < 10 THEN CAST({m} AS VARCHAR) || 'e-06' WHEN {m} < 100 AND {m} % 10 = 0 THEN CAST({m} // 10 AS VARCHAR) || 'e-05'
      WHEN {m} < 100 THEN CAST({m} // 10 AS VARCHAR) || '.' || CAST({m} % 10 AS VARCHAR) || 'e-05'
      ELSE CAST({m} // 1000000 AS VARCHAR) || '.' || rtrim(lpad(CAST({m} % 1000000 AS VARCHAR), 6, '0'), '0') END"""


def _stats_sql(hist: str, named: dict[str, list[int]], first: int) -> str:
    parts = []
    for name, bins in named.items():
        n = " + ".join(f"{hist}[{b - first + 1}]" for b in bins) or "0"
        r = f"CASE WHEN list_sum({hist}) > 0 THEN ({n}) / list_sum({hist}) ELSE 0.0 END"
        parts.append(f"""'"{name}": {{"visits": ' || CAST({n} AS VARCHAR) || ', "ratio": ' || ({_float_sql(r)}) || '}}'""")
    return "'{' || " + " || ', ' || ".join(parts) + " || '}'"


GROUPED_SQL = f"""WITH {I.VISITS_SQL}, g AS (
  SELECT uuid, poi_id, count(*) AS n, coalesce(sum(stay_minutes), 0.0) AS total, coalesce(max(stay_minutes), 0.0) AS most, coalesce(sum(stay_minutes * stay_minutes), 0.0) AS sq,
    min(d) AS first_d, max(d) AS last_d, {_hist_sql('start_hour', range(24))} AS e, {_hist_sql('end_hour', range(24))} AS l, {_hist_sql('isodow(d)', range(1, 8))} AS w, {_hist_sql('day(d)', range(1, 32))} AS m
  FROM rec GROUP BY uuid, poi_id), latest AS (SELECT max(d) AS d FROM rec)
"""
_STD_SQL = "CASE WHEN n <= 1 THEN 0.0 ELSE sqrt(greatest(0.0, sq / n - (total / n) * (total / n))) END"
RHYTHM = visits.Rhythm.of(I.RHYTHM)


def _grouped(spark, sf_dir):
    return visits.grouped(visits.visits(I.visit_records(spark, sf_dir)))


def _profile(spark, sf_dir):
    return visits.profile(I.visit_records(spark, sf_dir), I.RHYTHM)


# squares of hundredths cancel: standard deviations are compared to four places
def _std(df: DataFrame) -> DataFrame:
    return df.withColumn("std_stay_minutes", F.round("std_stay_minutes", 4))


@query("visit_base_stats", GROUPED_SQL + f"SELECT uuid, poi_id, n AS visit_count, {u('total', 'total_stay_minutes')}, {u('total / n', 'avg_stay_minutes')}, {u('most', 'max_stay_minutes')}, {u(f'round({_STD_SQL}, 4)', 'std_stay_minutes')} FROM g")
def visit_base_stats(spark, sf_dir):
    return _std(_profile(spark, sf_dir).select("uuid", "poi_id", "visit_count", "total_stay_minutes", "avg_stay_minutes", "max_stay_minutes", "std_stay_minutes"))


@query("visit_recency", GROUPED_SQL + "SELECT uuid, poi_id, strftime(first_d, '%Y-%m-%d') AS first_visit_date, strftime(last_d, '%Y-%m-%d') AS last_visit_date, CAST(latest.d - last_d AS BIGINT) AS last_visit_recency_days FROM g, latest")
def visit_recency(spark, sf_dir):
    return _profile(spark, sf_dir).select("uuid", "poi_id", "first_visit_date", "last_visit_date", "last_visit_recency_days")


for _name, _col, _hist, _first in (("visit_enter_hist_json", "enter_hour_dist", "e", 0), ("visit_leave_hist_json", "leave_hour_dist", "l", 0), ("visit_weekday_hist_json", "visit_weekday_dist", "w", 1), ("visit_dom_hist_json", "visit_day_of_month_dist", "m", 1)):
    query(_name, GROUPED_SQL + f"SELECT uuid, poi_id, {_json_sql(_hist, _first)} AS {_col} FROM g")(lambda spark, sf_dir, c=_col: _profile(spark, sf_dir).select("uuid", "poi_id", c))


@query("visit_top_bins", GROUPED_SQL + f"SELECT uuid, poi_id, {_top_sql('e', 0)} AS top_enter_hours, {_top_sql('l', 0)} AS top_leave_hours, {_top_sql('w', 1)} AS top_weekdays FROM g")
def visit_top_bins(spark, sf_dir):
    return _profile(spark, sf_dir).select("uuid", "poi_id", "top_enter_hours", "top_leave_hours", "top_weekdays")


_WORK_SQL = "CASE WHEN list_sum(w) > 0 THEN list_sum(w[1:5]) / list_sum(w) ELSE 0.0 END"
_DAY_SQL = "CASE WHEN list_sum(e) > 0 THEN list_sum(e[7:18]) / list_sum(e) ELSE 0.0 END"
_RATIOS_SQL = ", ".join(u(s, n) for s, n in ((_WORK_SQL, "weekday_visit_ratio"), (f"1 - ({_WORK_SQL})", "weekend_visit_ratio"), (_DAY_SQL, "daytime_ratio"), (f"1 - ({_DAY_SQL})", "night_ratio")))
_STATS_SQL = f"{_stats_sql('e', RHYTHM.enter, 0)} AS enter_period_stats, {_stats_sql('l', RHYTHM.leave, 0)} AS leave_period_stats, {_stats_sql('w', RHYTHM.weekdays, 1)} AS weekday_group_stats, {_stats_sql('m', RHYTHM.dates, 1)} AS date_group_stats"


@query("visit_ratios", GROUPED_SQL + f"SELECT uuid, poi_id, {_RATIOS_SQL} FROM g")
def visit_ratios(spark, sf_dir):
    return _profile(spark, sf_dir).select("uuid", "poi_id", "weekday_visit_ratio", "weekend_visit_ratio", "daytime_ratio", "night_ratio")


@query("visit_period_stats", GROUPED_SQL + f"SELECT uuid, poi_id, {_stats_sql('e', RHYTHM.enter, 0)} AS enter_period_stats, {_stats_sql('l', RHYTHM.leave, 0)} AS leave_period_stats FROM g")
def visit_period_stats(spark, sf_dir):
    return _profile(spark, sf_dir).select("uuid", "poi_id", "enter_period_stats", "leave_period_stats")


@query("visit_weekday_groups", GROUPED_SQL + f"SELECT uuid, poi_id, {_stats_sql('w', RHYTHM.weekdays, 1)} AS weekday_group_stats FROM g")
def visit_weekday_groups(spark, sf_dir):
    return _profile(spark, sf_dir).select("uuid", "poi_id", "weekday_group_stats")


@query("visit_date_groups", GROUPED_SQL + f"SELECT uuid, poi_id, {_stats_sql('m', RHYTHM.dates, 1)} AS date_group_stats FROM g")
def visit_date_groups(spark, sf_dir):
    return _profile(spark, sf_dir).select("uuid", "poi_id", "date_group_stats")


@query(
    "visit_profile",
    GROUPED_SQL + f"""SELECT uuid, poi_id, n AS visit_count, {u('total', 'total_stay_minutes')}, {u('total / n', 'avg_stay_minutes')}, {u('most', 'max_stay_minutes')}, {u(f'round({_STD_SQL}, 4)', 'std_stay_minutes')},
  strftime(first_d, '%Y-%m-%d') AS first_visit_date, strftime(last_d, '%Y-%m-%d') AS last_visit_date, CAST(latest.d - last_d AS BIGINT) AS last_visit_recency_days, {_RATIOS_SQL},
  {_json_sql('e', 0)} AS enter_hour_dist, {_json_sql('l', 0)} AS leave_hour_dist, {_json_sql('w', 1)} AS visit_weekday_dist, {_json_sql('m', 1)} AS visit_day_of_month_dist,
  {_top_sql('e', 0)} AS top_enter_hours, {_top_sql('l', 0)} AS top_leave_hours, {_top_sql('w', 1)} AS top_weekdays, {_STATS_SQL} FROM g, latest""",
)
def visit_profile(spark, sf_dir):
    return _std(_profile(spark, sf_dir))


@query("visit_profile_decoded", GROUPED_SQL + "SELECT uuid, poi_id, CAST(list_sum(e) AS BIGINT) AS n_enter, CAST(len(list_filter(m, lambda n: n > 0)) AS BIGINT) AS n_days, CAST(e[13] AS BIGINT) AS at_noon, CAST(w[1] + w[2] + w[3] + w[4] + w[5] AS BIGINT) AS work_visits FROM g")
def visit_profile_decoded(spark, sf_dir):
    d = visits.decoded(_profile(spark, sf_dir))
    return d.select("uuid", "poi_id", F.aggregate(F.map_values("enter_hour_dist"), F.lit(0).cast("long"), lambda a, b: a + b).alias("n_enter"), F.size("visit_day_of_month_dist").alias("n_days"), F.coalesce(F.element_at("enter_hour_dist", "12"), F.lit(0)).cast("long").alias("at_noon"), F.element_at("weekday_group_stats", "work")["visits"].alias("work_visits"))


@query("poi_first_location", f"WITH {I.VISITS_SQL} SELECT poi_id, arg_min_null(location, event_id) AS location FROM rec GROUP BY poi_id")
def poi_first_location(spark, sf_dir):
    return visits.first_locations(I.visit_records(spark, sf_dir).withColumn("_order", F.col("event_id")))


# ---- overlap minutes and grid minutes ------------------------------------------------------------------------------

ALL_BANDS = B.bands("lunch,dinner")
_ROUND_SQL = {k: f"(({{}}) + {v}) // 60000" for k, v in B.ROUNDING.items()}


def _overlap_sql(start: str, end: str, band: B.TimeBand, rounding: str = "floor") -> str:
    """Day by day, unlike the closed form of the query."""
    days = f"coalesce(list_sum(list_transform(range({start} // 86400000, ({end} - 1) // 86400000 + 1), lambda d: greatest(0, least({end}, d * 86400000 + {band.end}) - greatest({start}, d * 86400000 + {band.start})))), 0)"
    return f"CAST(CASE WHEN {start} >= 0 AND {end} > {start} THEN {_ROUND_SQL[rounding].format(days)} ELSE 0 END AS BIGINT)"


for _r in B.ROUNDING:
    query(f"overlap_record_minutes_{_r}", f"WITH {I.STAYS_SQL} SELECT event_id, {_overlap_sql('start_ms', 'end_ms', ALL_BANDS[0], _r)} AS lunch, {_overlap_sql('start_ms', 'end_ms', ALL_BANDS[1], _r)} AS dinner FROM sp")(
        lambda spark, sf_dir, r=_r: I.stays(spark, sf_dir).select("event_id", *[B.record_minutes(F.col("start_ms"), F.col("end_ms"), b, r).alias(b.name) for b in ALL_BANDS])
    )

_SPANS_SQL = "WITH s AS (SELECT l_orderkey, l_linenumber, epoch_us(o_orderdate) // 1000 + (o_orderkey % 86400) * 1000 AS a, epoch_us(l_shipdate) // 1000 + (l_partkey % 86400) * 1000 AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


@query("overlap_multi_day_minutes", _SPANS_SQL + f" SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n, CAST(sum({_overlap_sql('a', 'b', ALL_BANDS[0])}) AS BIGINT) AS lunch, CAST(sum({_overlap_sql('a', 'b', ALL_BANDS[1])}) AS BIGINT) AS dinner FROM s GROUP BY l_orderkey, l_linenumber")
def overlap_multi_day_minutes(spark, sf_dir):
    o, l = I.table(spark, sf_dir, "orders"), I.table(spark, sf_dir, "lineitem")
    a = I.epoch_ms(F.col("o_orderdate")) + (F.col("o_orderkey") % 86400) * 1000
    b = I.epoch_ms(F.col("l_shipdate")) + (F.col("l_partkey") % 86400) * 1000
    spans = l.join(o, l.l_orderkey == o.o_orderkey).select("l_orderkey", "l_linenumber", a.alias("a"), b.alias("b"))
    return spans.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), *[F.sum(B.record_minutes(F.col("a"), F.col("b"), x)).alias(x.name) for x in ALL_BANDS])


_UHASH = "CAST(CAST('0x' || {h}[15:16] || {h}[13:14] || {h}[11:12] || {h}[9:10] || {h}[7:8] || {h}[5:6] || {h}[3:4] || {h}[1:2] AS UBIGINT) AS VARCHAR)"
_UID_SQL = _UHASH.format(h="sha256(uuid)")
_CELL_SQL = """cells AS (SELECT *, x >= 0 AND y >= 0 AND x <= 5000 AND y <= 5000 AND floor(x / 500) < 10 AND floor(y / 500) < 10 AS inside, CAST(floor(y / 500) * 10 + floor(x / 500) AS BIGINT) AS cell FROM sp)"""
_UNIT_SQL = "'grid_4403_' || CAST({c} % 10 AS VARCHAR) || '_' || CAST({c} // 10 AS VARCHAR)"


def _minutes_sql(where: str = "TRUE", oob: str = "inside", group: bool = True) -> str:
    marked = f"""WITH {I.STAYS_SQL}, {_CELL_SQL}, m AS (SELECT *, {_overlap_sql('start_ms', 'end_ms', ALL_BANDS[0])} AS lunch, {_overlap_sql('start_ms', 'end_ms', ALL_BANDS[1])} AS dinner FROM cells WHERE end_ms > start_ms AND poi_id <> 0 AND stay_minutes >= 5 AND {where}),
  kept AS (SELECT *, {_UID_SQL} AS uuid_hash FROM m WHERE (lunch > 0 OR dinner > 0) AND {oob})"""
    return marked + f""", res AS (SELECT uuid_hash, cell AS grid_id, {_UNIT_SQL.format(c='cell')} AS grid_uid, CAST(sum(lunch) AS BIGINT) AS tau_lunch_min, CAST(sum(dinner) AS BIGINT) AS tau_dinner_min, CAST(sum(lunch + dinner) AS BIGINT) AS tau_total_min,
  count(*) FILTER (WHERE lunch > 0) AS n_stops_lunch, count(*) FILTER (WHERE dinner > 0) AS n_stops_dinner FROM kept WHERE cell >= 0 GROUP BY uuid_hash, cell) """


P2 = dict(windows="lunch,dinner", clock=LOCAL, output_grid_id=True, grid_uid_code=I.CODE)
_MAP = {"staypoints": {"start_time": "start_ms", "end_time": "end_ms"}, "poi_meta": {}}


def _p2(spark, sf_dir, **more):
    o = minutes.Options(**{**P2, **more})
    poi = I.place_table(spark, sf_dir) if o.poi_filter_mode != "all_stops" else None
    return minutes.marked(I.stays(spark, sf_dir), I.GRID, o, poi, _MAP), o


def _p2_result(spark, sf_dir, **more):
    rows, o = _p2(spark, sf_dir, **more)
    return minutes.grid_minutes(rows, I.GRID, o)


query("grid_minutes", _minutes_sql() + "SELECT * FROM res")(_p2_result)
query("grid_minutes_oob_keep", _minutes_sql(oob="TRUE") + "SELECT * FROM res")(lambda spark, sf_dir: _p2_result(spark, sf_dir, oob_mode="keep"))
_FOOD_SQL = "poi_id IN (SELECT p_partkey FROM part WHERE regexp_matches(lower(p_type), 'promo|sm.ll'))"
_KEYS = {"food_category_keywords": ["PROMO", "sm.ll"]}
query("grid_minutes_only_category", _minutes_sql(_FOOD_SQL) + "SELECT * FROM res")(lambda spark, sf_dir: _p2_result(spark, sf_dir, poi_filter_mode="only_food_poi", **_KEYS))
query("grid_minutes_exclude_category", _minutes_sql(f"NOT ({_FOOD_SQL})") + "SELECT * FROM res")(lambda spark, sf_dir: _p2_result(spark, sf_dir, poi_filter_mode="exclude_food_poi", **_KEYS))


@query("grid_minutes_qa", f"""WITH {I.STAYS_SQL}, {_CELL_SQL}, m AS (SELECT *, {_overlap_sql('start_ms', 'end_ms', ALL_BANDS[0])} AS lunch, {_overlap_sql('start_ms', 'end_ms', ALL_BANDS[1])} AS dinner, end_ms > start_ms AS t FROM cells),
  k AS (SELECT *, t AND poi_id <> 0 AND stay_minutes >= 5 AS timed, lunch > 0 OR dinner > 0 AS hit FROM m), q AS (SELECT *, timed AND hit AND inside AS kept FROM k),
  a AS (SELECT count(*) AS input_rows, count(*) FILTER (WHERE kept) AS kept_rows, count(*) FILTER (WHERE t AND poi_id = 0) AS filtered_poi_id_zero, count(*) FILTER (WHERE t AND poi_id <> 0 AND stay_minutes < 5) AS filtered_min_stay,
  CAST(0 AS BIGINT) AS filtered_poi_category, count(*) FILTER (WHERE timed AND NOT hit) AS filtered_not_in_windows, count(*) FILTER (WHERE timed AND hit AND NOT inside) AS filtered_oob_grid, count(*) FILTER (WHERE NOT t) AS invalid_time_rows,
  count(*) FILTER (WHERE timed AND start_ms // 86400000 <> (end_ms - 1) // 86400000) AS cross_midnight_rows, CAST(sum(lunch) FILTER (WHERE kept) AS BIGINT) AS tau_lunch_total_min, CAST(sum(dinner) FILTER (WHERE kept) AS BIGINT) AS tau_dinner_total_min, CAST(sum(lunch + dinner) FILTER (WHERE kept) AS BIGINT) AS tau_total_min FROM q)
  SELECT *, {u('cross_midnight_rows / input_rows', 'pct_cross_midnight')}, {u('kept_rows / input_rows', 'kept_row_ratio')}, {u('tau_lunch_total_min / tau_total_min', 'tau_lunch_ratio')}, {u('tau_dinner_total_min / tau_total_min', 'tau_dinner_ratio')} FROM a""")
def grid_minutes_qa(spark, sf_dir):
    rows, o = _p2(spark, sf_dir)
    qa = minutes.grid_minutes_qa(rows, o)
    return qa.select(*[c for c in qa.columns if not c.startswith("stay_minutes_error")])


@query("stay_error_quantiles", f"WITH {I.STAYS_SQL}, e AS (SELECT stay_minutes - (end_ms - start_ms) / 60000 AS x FROM sp) SELECT " + ", ".join(u(f"quantile_cont(x, {p / 100})", f"stay_minutes_error_p{p}") for p in (50, 90, 99)) + " FROM e")
def stay_error_quantiles(spark, sf_dir):
    rows, o = _p2(spark, sf_dir)
    return minutes.grid_minutes_qa(rows, o).select("stay_minutes_error_p50", "stay_minutes_error_p90", "stay_minutes_error_p99")


@query("grid_unique_units_avg", _minutes_sql() + ", c AS (SELECT uuid_hash, count(*) FILTER (WHERE tau_lunch_min > 0) AS l, count(*) FILTER (WHERE tau_dinner_min > 0) AS d FROM res GROUP BY uuid_hash) SELECT " + u("coalesce(avg(l) FILTER (WHERE l > 0), 0)", "avg_unique_grids_per_user_lunch") + ", " + u("coalesce(avg(d) FILTER (WHERE d > 0), 0)", "avg_unique_grids_per_user_dinner") + " FROM c")
def grid_unique_units_avg(spark, sf_dir):
    return minutes.unique_cells(_p2_result(spark, sf_dir))


_HOME = lambda x, y: f"CASE WHEN {x} >= 0 AND {y} >= 0 AND {x} < 5000 AND {y} < 5000 THEN ({y} // 500) * 10 + {x} // 500 END"


@query("covariates", f"""WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS uuid, CAST(round(c_acctbal * 100) AS BIGINT) AS ses_bal, c_mktsegment AS SES_segment, (c_custkey * 7919) % 6000 - 500 AS hx, (c_custkey * 104729) % 6000 - 500 AS hy, (c_custkey * 31) % 6000 - 500 AS wx, CASE WHEN c_custkey % 5 <> 0 THEN (c_custkey * 47) % 6000 - 500 END AS wy FROM customer),
  g AS (SELECT *, {_HOME('hx', 'hy')} AS home_grid_id, {_HOME('wx', 'wy')} AS work_grid_id FROM c)
  SELECT {_UID_SQL} AS uuid_hash, ses_bal, SES_segment, home_grid_id, work_grid_id, {_UNIT_SQL.format(c='home_grid_id')} AS home_grid_uid, {_UNIT_SQL.format(c='work_grid_id')} AS work_grid_uid FROM g""")
def user_covariates(spark, sf_dir):
    return covariates(I.user_table(spark, sf_dir), I.GRID, output_grid_id=True, code=I.CODE)


# ---- strict and filled minutes -------------------------------------------------------------------------------------


def _shares_sql(unit: str, where: str, early: str = "TRUE", extra: str = "") -> str:
    """From rows with a unit to base and factors, step by step."""
    strict = lambda b: f"SELECT uuid, unit, d AS day, '{b.name}' AS win, greatest(0, least(end_ms, d * 86400000 + {b.end}) - greatest(start_ms, d * 86400000 + {b.start})) // 60000 AS strict FROM pieces"
    point = lambda b: f"SELECT uuid, unit, t // 86400000 AS day, '{b.name}' AS win, {b.start} AS a, {b.end} AS b, t FROM pt WHERE t % 86400000 >= {b.start} AND t % 86400000 < {b.end}"
    return f"""WITH {I.STAYS_SQL}, {_CELL_SQL}, own AS (SELECT uuid, start_ms, end_ms, source, {unit} AS unit FROM cells WHERE end_ms >= start_ms AND {where}),
  iv AS (SELECT * FROM own WHERE end_ms - start_ms >= 300000 AND {early}), pt AS (SELECT uuid, unit, (start_ms + end_ms) // 2 AS t FROM own WHERE end_ms - start_ms < 300000 AND lower(source) = 'cell_appearance' AND {early}),
  pieces AS (SELECT *, unnest(range(start_ms // 86400000, (end_ms - 1) // 86400000 + 1)) AS d FROM iv WHERE (end_ms - 1) // 86400000 - start_ms // 86400000 <= 1),
  strict AS (SELECT * FROM ({' UNION ALL '.join(map(strict, ALL_BANDS))}) WHERE strict > 0),
  points AS ({' UNION ALL '.join(map(point, ALL_BANDS))}),
  near AS (SELECT *, lag(t) OVER w AS p, lead(t) OVER w AS n FROM points WINDOW w AS (PARTITION BY uuid, day, win ORDER BY t, unit)),
  split AS (SELECT uuid, unit, day, win, greatest(0, least(day * 86400000 + b, coalesce((t + n) / 2, day * 86400000 + b)) - greatest(day * 86400000 + a, coalesce((p + t) / 2, day * 86400000 + a))) / 60000 AS point,
    greatest(coalesce(t - p, t - day * 86400000 - a), CASE WHEN n IS NULL THEN day * 86400000 + b - t ELSE 0 END) / 60000 AS gap FROM near),
  base AS (SELECT uuid, unit, day, win, sum(strict) AS strict, sum(point) AS point, max(gap) AS gap FROM (SELECT uuid, unit, day, win, CAST(strict AS DOUBLE) AS strict, 0.0 AS point, NULL AS gap FROM strict UNION ALL SELECT uuid, unit, day, win, 0.0, point, gap FROM split) GROUP BY ALL),
  len AS (SELECT 'lunch' AS win, 150.0 AS len UNION ALL SELECT 'dinner', 240.0),
  factors AS (SELECT uuid, day, win, len, sum(strict) AS s, sum(point) AS p, greatest(0, len - sum(strict)) AS missing, CASE WHEN sum(point) > 0 THEN greatest(0, len - sum(strict)) / sum(point) ELSE 0 END AS f, coalesce(max(gap), len) AS gap FROM base JOIN len USING (win) GROUP BY uuid, day, win, len){extra}
"""


_RESULT_SQL = """, res AS (SELECT {units}, win AS "window", (day + 3) % 7 >= 5 AS is_weekend, uuid, CAST(sum(strict) AS BIGINT) AS tau_strict_min, sum(point * f) AS fill, sum(strict + point * f) AS filled FROM base JOIN factors USING (uuid, day, win) WHERE {shown} GROUP BY ALL)"""
_SUMS = f"{u('fill', 'tau_fill_min')}, {u('filled', 'tau_filled_min')}"
_GRID_UNITS = _UNIT_SQL.format(c="unit") + " AS grid_uid, unit AS grid_id"
_GRID_SQL = _shares_sql("cell", "inside")
_NULL_SQL = _shares_sql("CASE WHEN inside THEN cell ELSE -1 END", "TRUE")
_IN_CITY = "h3_int < 617700169958293503 + 30 * 262144"
_HEX_UNITS = "'hex_440300__' || lower(hex(unit)) AS hex_uid, lower(hex(unit)) AS h3_id, CAST(unit AS VARCHAR) AS h3_int"


def _id_sql(mode: str) -> str:
    return {"uuid": "uuid", "uid64": f"{_UID_SQL} AS uid64", "both": f"{_UID_SQL} AS uid64, uuid"}[mode]


def _p3(spark, sf_dir, **more):
    o = fill.Options(**{"clock": LOCAL, **more})
    cells = fill.Cells(I.GRID, code=I.CODE, output_id=True)
    users = I.user_table(spark, sf_dir).where(F.col("uuid").cast("long") % 2 == 0) if o.drop_uuid_not_in_table else None
    return I.stays(spark, sf_dir), cells, o, users, _MAP


def _p3_result(spark, sf_dir, **more):
    return fill.strict_filled(*_p3(spark, sf_dir, **more))


def _p4(spark, sf_dir, **more):
    o = fill.Options(**{"clock": LOCAL, **more})
    city = spark.range(30).select((F.lit(617700169958293503) + F.col("id") * 262144).alias("h3_int"))
    hexes = fill.Hexes(city, code="440300", output_h3_int=True, cell_column="h3_int")
    return fill.strict_filled(I.stays(spark, sf_dir), hexes, o, None, _MAP)


def _shares(spark, sf_dir, **more):
    args = _p3(spark, sf_dir, **more)
    return fill.shares(fill.observations(fill.marked(*args), args[2]), args[1], args[2])


@query("strict_interval_minutes", _GRID_SQL + """ SELECT uuid, day, (day + 3) % 7 >= 5 AS is_weekend, win AS "window", unit AS grid_id, CAST(sum(strict) AS BIGINT) AS tau_strict_min FROM strict GROUP BY ALL""")
def strict_interval_minutes(spark, sf_dir):
    args = _p3(spark, sf_dir)
    seen = fill.observations(fill.marked(*args), args[2])
    return seen.where("strict > 0").groupBy("uuid", "day", "is_weekend", "window", F.col("unit").alias("grid_id")).agg(F.sum("strict").alias("tau_strict_min"))


@query("point_midpoint_minutes", _GRID_SQL + f""" SELECT uuid, day, win AS "window", unit AS grid_id, {u('sum(point)', 'tau_point_min')} FROM split GROUP BY uuid, day, win, unit""")
def point_midpoint_minutes(spark, sf_dir):
    return _shares(spark, sf_dir).where(F.col("gap").isNotNull()).select("uuid", "day", "window", F.col("unit").alias("grid_id"), "tau_point_min")


@query("fill_factors", _GRID_SQL + f""" SELECT {_UID_SQL} AS uid64, day, (day + 3) % 7 >= 5 AS is_weekend, win AS "window", {u('s', 'strict_sum_min')}, {u('p', 'point_sum_min')}, {u('missing', 'missing_min')}, {u('f', 'fill_factor')}, {u('gap', 'point_max_gap_min')} FROM factors""")
def fill_factors(spark, sf_dir):
    from dwell.functions.hashing import unsigned

    return fill.day_windows(_shares(spark, sf_dir)).select(unsigned(F.col("key")).alias("uid64"), "day", "is_weekend", "window", "strict_sum_min", "point_sum_min", "missing_min", "fill_factor", "point_max_gap_min")


def _grid_result_sql(base: str, mode: str = "uuid") -> str:
    return base + _RESULT_SQL.format(units=_GRID_UNITS, shown="unit >= 0") + f"""SELECT grid_uid, grid_id, "window", is_weekend, {_id_sql(mode)}, tau_strict_min, {_SUMS} FROM res"""


query("strict_filled_grid", _grid_result_sql(_GRID_SQL))(_p3_result)
query("strict_filled_grid_spread", _grid_result_sql(_GRID_SQL))(lambda spark, sf_dir: _p3_result(spark, sf_dir, spread=True))
query("strict_filled_grid_oob_null", _grid_result_sql(_NULL_SQL))(lambda spark, sf_dir: _p3_result(spark, sf_dir, oob_mode="null"))
query("strict_filled_grid_oob_keep", _grid_result_sql(_shares_sql("cell", "TRUE")))(lambda spark, sf_dir: _p3_result(spark, sf_dir, oob_mode="keep"))
for _m in fill.ID_MODES:
    query(f"id_mode_{_m}", _grid_result_sql(_GRID_SQL, _m))(lambda spark, sf_dir, m=_m: _p3_result(spark, sf_dir, id_mode=m))
query("allowlist_semi", _grid_result_sql(_shares_sql("cell", "inside AND uuid IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 2 = 0)")))(lambda spark, sf_dir: _p3_result(spark, sf_dir, drop_uuid_not_in_table=True))
query("city_filter", _grid_result_sql(_shares_sql("cell", "inside AND c_code = 440301")))(lambda spark, sf_dir: _p3_result(spark, sf_dir, city_code_value="440301"))


def _hex_sql(unit: str, where: str) -> str:
    return _shares_sql(unit, where, "unit <> 0") + _RESULT_SQL.format(units=_HEX_UNITS, shown="unit <> 0") + f"""SELECT hex_uid, h3_id, h3_int, "window", is_weekend, uuid, tau_strict_min, {_SUMS} FROM res"""


query("strict_filled_hex", _hex_sql("h3_int", _IN_CITY))(_p4)
query("strict_filled_hex_oob_null", _hex_sql(f"CASE WHEN {_IN_CITY} THEN h3_int ELSE 0 END", "TRUE"))(lambda spark, sf_dir: _p4(spark, sf_dir, oob_mode="null"))
query("strict_filled_hex_oob_keep", _hex_sql("h3_int", "TRUE"))(lambda spark, sf_dir: _p4(spark, sf_dir, oob_mode="keep"))


@query("uuid_map", _GRID_SQL + f", s AS (SELECT uuid FROM strict UNION ALL SELECT uuid FROM points) SELECT {_UID_SQL} AS uid64, uuid, CAST(1 AS BIGINT) AS n_uuid FROM s GROUP BY uuid")
def uuid_map(spark, sf_dir):
    args = _p3(spark, sf_dir)
    return fill.names_of(fill.observations(fill.marked(*args), args[2]))


@query("strict_filled_qa", f"""WITH {I.STAYS_SQL}, {_CELL_SQL}, k AS (SELECT *, end_ms >= start_ms AS ok, end_ms - start_ms >= 300000 AS iv, lower(source) = 'cell_appearance' AS used, ((start_ms + end_ms) // 2) % 86400000 AS t, (end_ms - 1) // 86400000 - start_ms // 86400000 AS span FROM cells)
  SELECT count(*) AS input_rows, count(*) FILTER (WHERE ok AND inside) AS kept_rows, count(*) FILTER (WHERE NOT ok) AS invalid_time_rows, CAST(0 AS BIGINT) AS filtered_uuid_not_in_table, count(*) FILTER (WHERE ok AND NOT inside) AS filtered_oob_grid, count(*) FILTER (WHERE ok AND inside AND iv) AS interval_rows, count(*) FILTER (WHERE ok AND inside AND NOT iv) AS point_rows,
  count(*) FILTER (WHERE ok AND inside AND NOT iv AND used) AS point_rows_used, count(*) FILTER (WHERE ok AND inside AND NOT iv AND used AND NOT (t >= 41400000 AND t < 50400000) AND NOT (t >= 61200000 AND t < 75600000)) AS point_rows_outside_windows, count(*) FILTER (WHERE ok AND inside AND iv AND span = 1) AS interval_cross_day_rows, count(*) FILTER (WHERE ok AND inside AND iv AND span > 1) AS interval_multi_day_rows_dropped FROM k""")
def strict_filled_qa(spark, sf_dir):
    args = _p3(spark, sf_dir)
    return fill.row_counts(fill.marked(*args), args[1], args[2])


@query("user_day_counts", _GRID_SQL + " SELECT count(DISTINCT uuid) AS n_users_uid64, count(*) AS n_user_day_windows, count(*) FILTER (WHERE p = 0) AS n_user_day_windows_no_points, count(*) FILTER (WHERE s = 0) AS n_user_day_windows_no_strict FROM factors")
def user_day_counts(spark, sf_dir):
    return fill.user_counts(fill.day_windows(_shares(spark, sf_dir)))


_FIGURES_SQL = ", ".join(u(f"quantile_cont({c}, {p / 100})", f"{n}_p{p}") for n, c in (("fill_factor", "f"), ("missing", "missing"), ("point_max_gap", "gap")) for p in (50, 90, 99))


@query("window_quantiles", _GRID_SQL + f""" SELECT win AS "window", count(*) AS n_user_day_windows, {u('sum(s)', 'strict_sum_total_min')}, {u('sum(p)', 'point_sum_total_min')}, {u('sum(missing)', 'missing_total_min')}, {u('avg(f)', 'fill_factor_mean')}, {_FIGURES_SQL} FROM factors GROUP BY win""")
def window_quantiles(spark, sf_dir):
    return fill.window_figures(fill.day_windows(_shares(spark, sf_dir)))


# ---- single functions ----------------------------------------------------------------------------------------------

for _h, _f in (("sha256_64", "sha256"), ("md5_64", "md5")):
    query(f"hash_{_h}", f"SELECT event_id, {_UHASH.format(h=f'{_f}(CAST(user_id AS VARCHAR))')} AS h FROM events")(lambda spark, sf_dir, m=_h: I.table(spark, sf_dir, "events").select("event_id", uid64(F.col("user_id").cast("string"), m).alias("h")))
#: Names with their 64-bit hashes by the libraries that define them (xxHash with seed 0, pandas.util.hash_pandas_object).
HASHED = (
    ("a", 15154266338359012955, 13950350942979735504),
    ("abc", 4952883123889572249, 8952642330259793944),
    ("user-1", 11633770265628666856, 10727632427313137042),
    ("0", 7148434200721666028, 8872142683093127234),
    ("149", 11878172573203219337, 14987799811665519738),
    ("Zoë", 6304431168280109521, 8751914635655007618),
    ("用户甲", 4548582781377684622, 10112576703379786778),
    ("xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx", 10551747345416853717, 17355273493356824715),
    ("the same name, longer than thirty-two bytes", 9838935690939847261, 12657166241912441115),
)
for _h, _at in (("xxh64", 1), ("pandas_64", 2)):
    query(f"hash_{_h}", "SELECT name, h FROM (VALUES " + ", ".join(f"('{v[0]}', '{v[_at]}')" for v in HASHED) + ") t(name, h)")(lambda spark, sf_dir, m=_h: spark.createDataFrame([(v[0],) for v in HASHED], "name string").select("name", uid64(F.col("name"), m).alias("h")))


@query("grid_uid_orders", "SELECT event_id, 'grid_4403_' || CAST(event_id % 10 AS VARCHAR) || '_' || CAST(event_id // 10 AS VARCHAR) AS col_row, 'grid_4403_' || CAST(event_id // 10 AS VARCHAR) || '_' || CAST(event_id % 10 AS VARCHAR) AS row_col FROM events")
def grid_uid_orders(spark, sf_dir):
    e = I.table(spark, sf_dir, "events")
    return e.select("event_id", *[I.GRID.uid(F.col("event_id"), "grid", I.CODE, o).alias(o) for o in ("col_row", "row_col")])


@query("hex_uid", f"WITH {I.STAYS_SQL} SELECT event_id, 'hex_440300__' || lower(hex(h3_int)) AS hex_uid FROM sp")
def hex_uid(spark, sf_dir):
    return I.stays(spark, sf_dir).select("event_id", cell_uid(F.col("h3_int"), "hex", "440300").alias("hex_uid"))


@query("location_parse", "SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN (event_id % 360 - 180) * 1000000 END AS lon, CASE WHEN event_id % 11 <> 0 THEN (event_id % 180 - 90) * 1000000 END AS lat FROM events")
def location_parse(spark, sf_dir):
    i = F.col("event_id")
    text = F.when(i % 11 == 0, F.lit("no place")).otherwise(F.concat(F.lit("( "), (i % 360 - 180).cast("string"), F.lit(" , "), (i % 180 - 90).cast("string"), F.lit("]")))
    lon, lat = lon_lat(text)
    return I.table(spark, sf_dir, "events").select("event_id", lon.alias("lon"), lat.alias("lat"))


@query("city_rows", f"WITH {I.STAYS_SQL} SELECT event_id, c_code FROM sp WHERE c_code = 440302")
def city_rows(spark, sf_dir):
    s = I.stays(spark, sf_dir)
    return s.where(equals(s, "c_code", "440302")).select("event_id", "c_code")


# ---- first looks ---------------------------------------------------------------------------------------------------

_EXPLORED = _GRID_SQL + _RESULT_SQL.format(units=_GRID_UNITS, shown="unit >= 0")
_EXPLORE_SUMS = f"CAST(sum(tau_strict_min) AS BIGINT) AS tau_strict_min_sum, {u('sum(fill)', 'tau_fill_min_sum')}, {u('sum(filled)', 'tau_filled_min_sum')}"


@query("explore_overall", _EXPLORED + f"SELECT count(*) AS n_rows, count(DISTINCT uuid) AS n_users, count(DISTINCT grid_uid) AS n_units, {_EXPLORE_SUMS}, count(*) FILTER (WHERE fill > 0) AS n_rows_tau_fill_pos FROM res")
def explore_overall(spark, sf_dir):
    return explore.overall(_p3_result(spark, sf_dir))


@query("explore_by_window", _EXPLORED + f"""SELECT "window", is_weekend, count(*) AS n_rows, {_EXPLORE_SUMS}, {u('sum(fill) / sum(filled)', 'fill_share')} FROM res GROUP BY "window", is_weekend""")
def explore_by_window(spark, sf_dir):
    return explore.by_window(_p3_result(spark, sf_dir))


@query("explore_top_units", _EXPLORED + f"SELECT grid_uid AS unit_uid, {u('sum(filled)', 'tau_filled_min_sum')} FROM res GROUP BY grid_uid ORDER BY sum(filled) DESC, grid_uid LIMIT 20")
def explore_top_units(spark, sf_dir):
    return explore.top_units(_p3_result(spark, sf_dir))


# ---- clocks, gaps in the data, files -------------------------------------------------------------------------------


def _marked(spark, stays, **more):
    o = fill.Options(**more)
    return fill.marked(stays, fill.Cells(I.GRID, code=I.CODE, output_id=True), o, None, _MAP), o


@query("epoch_seconds_to_zone", f"WITH {I.STAYS_SQL} SELECT uuid, (start_ms // 1000) * 1000 + 28800000 AS start, (end_ms // 1000) * 1000 + 28800000 AS \"end\" FROM sp")
def epoch_seconds_to_zone(spark, sf_dir):
    s = I.stays(spark, sf_dir).withColumns({c: F.expr(f"{c} div 1000") for c in ("start_ms", "end_ms")})
    return _marked(spark, s, clock=Clock("s", True, 8))[0].select("uuid", "start", "end")


@query("times_as_text_and_null", f"""WITH {I.STAYS_SQL} SELECT event_id % 7 = 0 AS missing, 'compat' AS mode, CASE WHEN event_id % 7 = 0 THEN -1 ELSE start_ms END + 28800000 AS start, end_ms + 28800000 AS "end" FROM sp
  UNION ALL SELECT event_id % 7 = 0, 'invalid', CASE WHEN event_id % 7 = 0 THEN -1 ELSE start_ms + 28800000 END, end_ms + 28800000 FROM sp""")
def times_as_text_and_null(spark, sf_dir):
    """Times as text, of which some are empty or no numbers."""
    i = F.col("event_id")
    s = I.stays(spark, sf_dir).withColumn("missing", i % 7 == 0).withColumn("start_ms", F.when(i % 14 == 0, F.lit("")).when(i % 7 == 0, F.lit(None)).otherwise(F.col("start_ms").cast("string")))
    parts = [s.select("missing", F.lit(m).alias("mode"), Clock(null_time=m).local(s, "start_ms").alias("start"), Clock(null_time=m).local(s, "end_ms").alias("end")) for m in ("compat", "invalid")]
    return parts[0].unionByName(parts[1])


@query("rows_with_faults", f"""WITH {I.STAYS_SQL}, f AS (SELECT *, x + 0.25 AS fx, CAST(floor(y / 500) * 10 + floor((x + 0.25) / 500) AS BIGINT) AS cell FROM sp)
  SELECT uuid, cell AS unit, count(*) AS n, count(*) FILTER (WHERE end_ms - start_ms >= 300000) AS n_intervals FROM f
  WHERE event_id % 9 <> 0 AND event_id % 10 <> 0 AND event_id % 23 <> 0 AND event_id % 25 <> 0 AND end_ms >= start_ms AND fx >= 0 AND y >= 0 AND fx <= 5000 AND y <= 5000 AND floor(fx / 500) < 10 AND floor(y / 500) < 10 GROUP BY uuid, cell""")
def rows_with_faults(spark, sf_dir):
    """Empty and null names, coordinates that are fractions, NaN or null: what the filters leave."""
    i = F.col("event_id")
    s = I.stays(spark, sf_dir).withColumns({"uuid": F.when(i % 9 == 0, F.lit("")).when(i % 10 == 0, F.lit(None)).otherwise(F.col("uuid")), "x": F.when(i % 23 == 0, F.lit(float("nan"))).when(i % 25 == 0, F.lit(None)).otherwise(F.col("x") + 0.25)})
    rows, o = _marked(spark, s, clock=LOCAL)
    return rows.where(fill._kept(o)).groupBy("uuid", "unit").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_interval").alias("n_intervals"))


@query("hex_counters", SQL["strict_filled_qa"].replace(_CELL_SQL, "cells AS (SELECT *, event_id % 40 < 30 AS inside FROM sp)").replace("filtered_oob_grid", "filtered_oob_hex, CAST(0 AS BIGINT) AS invalid_coord_rows"))
def hex_counters(spark, sf_dir):
    o = fill.Options(clock=LOCAL)
    city = spark.range(30).select((F.lit(617700169958293503) + F.col("id") * 262144).alias("h3_int"))
    hexes = fill.Hexes(city, code="440300", cell_column="h3_int")
    return fill.row_counts(fill.marked(I.stays(spark, sf_dir), hexes, o, None, _MAP), hexes, o)


@query("visit_max_rows", GROUPED_SQL + "SELECT uuid, poi_id, n AS visit_count FROM g")
def visit_max_rows(spark, sf_dir):
    """A limit above the number of rows changes nothing."""
    return visits.profile(I.visit_records(spark, sf_dir), I.RHYTHM, max_rows=2_000_000_000).select("uuid", "poi_id", "visit_count")


_FILED = ["event_id", "uuid", "poi_id", "start_ms", "end_ms", "source", "x", "y"]
_FILED_SQL = f"WITH {I.STAYS_SQL} SELECT event_id, uuid, poi_id, start_ms, end_ms, source, {u('x', 'x')}, {u('y', 'y')} FROM sp"


@query("csv_files", _FILED_SQL)
def csv_files(spark, sf_dir):
    """Written as CSV in two folders and read back together; types come from the first file."""
    s, folder = I.stays(spark, sf_dir).select(*_FILED), I.folder(spark, "csv")
    for k in (0, 1):
        sinks.write_csv(s.where(F.col("event_id") % 2 == k), f"{folder}/part{k}.csv", None)
    return readers.read(spark, [f"{folder}/part{k}.csv" for k in (0, 1)]).withColumn("uuid", F.col("uuid").cast("string")).withColumns({c: F.col(c).cast("long") for c in ("event_id", "poi_id")})


@query("parquet_files", _FILED_SQL)
def parquet_files(spark, sf_dir):
    """The same through zstd parquet, as visit records and side tables are read."""
    s, folder = I.stays(spark, sf_dir).select(*_FILED), I.folder(spark, "parquet")
    sinks.write_parquet(s.where("event_id % 3 = 0"), f"{folder}/a.parquet")
    sinks.write_parquet(s.where("event_id % 3 <> 0"), f"{folder}/b.parquet", files=1)
    return readers.read_visits(spark, f"{folder}/a.parquet").unionByName(readers.read_table(spark, f"{folder}/b.parquet"))


@query("empty_output", """SELECT * FROM (VALUES ('grid_uid', 'string', 0), ('grid_id', 'int', 0), ('window', 'string', 0), ('is_weekend', 'boolean', 0), ('uuid', 'string', 0), ('tau_strict_min', 'int', 0), ('tau_fill_min', 'double', 0), ('tau_filled_min', 'double', 0)) t(name, kind, n_rows)""")
def empty_output(spark, sf_dir):
    """No stay at all: the result is written with its columns and types, and no row."""
    path = f"{I.folder(spark, 'empty')}/result.parquet"
    args = _p3(spark, sf_dir)
    sinks.write_parquet(fill.strict_filled(args[0].where("false"), *args[1:]), path)
    back = spark.read.parquet(path)
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), back.count()) for f in back.schema], "name string, kind string, n_rows int")


@query("figures_file", SQL["strict_filled_qa"])
def figures_file(spark, sf_dir):
    """Quality figures through the CSV file with a byte order mark."""
    args = _p3(spark, sf_dir)
    path = f"{I.folder(spark, 'figures')}/qa_summary.csv"
    sinks.write_figures(fill.row_counts(fill.marked(*args), args[1], args[2]).first().asDict(), path)
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
