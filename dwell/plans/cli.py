"""Command lines: python -m dwell visits | grid-minutes | grid-filled | hex-filled ..."""

from __future__ import annotations

import argparse
import json
import logging
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwell.functions.bands import ROUNDING
from dwell.functions.hashing import METHODS
from dwell.operators import fill, minutes, visits
from dwell.operators.covariates import covariates
from dwell.operators.stays import Clock, city_value
from dwell.sources import readers, sinks
from dwell.sources.meta import read_grid, read_hexes, uid_code

log = logging.getLogger("dwell")


def truth(text) -> bool:
    """A lenient reading of yes and no."""
    if isinstance(text, bool):
        return text
    t = str(text).strip().lower()
    if t in ("1", "true", "t", "yes", "y", "on"):
        return True
    if t in ("0", "false", "f", "no", "n", "off", ""):
        return False
    raise argparse.ArgumentTypeError(f"neither yes nor no: {text}")


def json_or_file(text: str | None) -> dict:
    if not text or not text.strip():
        return {}
    return json.loads(text if text.lstrip().startswith("{") else Path(text).read_text(encoding="utf-8-sig"))


def session(threads: int = 8, memory: str = "8g", name: str = "dwell") -> SparkSession:
    """The session that is there (on a cluster, spark-submit's), or a local one with so many threads."""
    if (there := SparkSession.getActiveSession()) is not None:
        return there
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    if not os.environ.get("SPARK_MASTER") and "spark.master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        builder = builder.master(f"local[{threads}]").config("spark.driver.memory", memory.lower().replace("gb", "g").replace("mb", "m"))
    return builder.getOrCreate()


# ---- the pipelines, from files to files ----------------------------------------------------------------------------


def run_visits(spark: SparkSession, path: str, output_dir: str = "./output", max_rows: int | None = None, output_file: str = "user_poi_analysis.parquet", rhythm_specs: dict | None = None, coordinates: bool = True) -> DataFrame:
    """Writes profiles (and, where records have locations, each place's first one as CSV); returns the profiles as written."""
    df = readers.read_visits(spark, path)
    result = f"{output_dir.rstrip('/')}/{output_file}"
    with sinks.step("visit profiles"):
        sinks.write_parquet(visits.profile(df, rhythm_specs, max_rows), result, "snappy")
    if coordinates and "location" in df.columns:
        with sinks.step("place locations"):
            sinks.write_csv(visits.first_locations(df if max_rows is None else df.limit(max_rows)), f"{output_dir.rstrip('/')}/poi_coordination.csv")
    return spark.read.parquet(result)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return visits.decoded(spark.read.parquet(path))


def _clock(a: argparse.Namespace) -> Clock:
    return Clock(a.epoch_unit, a.timestamps_are_utc, a.tz_offset_hours, a.null_time)


def _echo(a: argparse.Namespace) -> dict:
    return {k: v if isinstance(v, (int, float, str, bool)) or v is None else json.dumps(v, ensure_ascii=False) for k, v in vars(a).items() if k not in ("run", "staypoints")}


def run_grid_minutes(spark: SparkSession, a: argparse.Namespace) -> dict:
    grid = read_grid(a.grid_meta)
    code = uid_code(a.grid_uid_code, grid.code, a.city)
    given = json_or_file(a.schema_map)
    value = city_value(a.city_code_value, a.grid_uid_code, grid.code) if a.filter_city_code else None
    options = minutes.Options(a.windows, a.min_stay_minutes, a.exclude_poi_id_zero, a.poi_filter_mode, a.food_category_keywords.split(","), _clock(a), a.coords_already_projected, a.uuid_hash_method, a.overlap_rounding, a.oob_mode, a.output_grid_uid, a.output_grid_id, a.grid_uid_prefix, code, a.grid_uid_order, a.city_code_col, value)
    folder = f"{a.out_dir.rstrip('/')}/{a.city}"
    sinks.log_to(f"{folder}/run_log_{a.city}.txt")
    poi = readers.read_table(spark, a.poi_meta) if a.poi_meta else None
    rows = minutes.marked(readers.read(spark, a.staypoints, a.staypoints_format), grid, options, poi, given)
    path = f"{folder}/user_grid_time_{a.city}.parquet"
    with sinks.step("grid minutes"):
        sinks.write_parquet(minutes.grid_minutes(rows, grid, options), path)
    with sinks.step("quality figures"):
        figures = _echo(a) | minutes.grid_minutes_qa(rows, options).first().asDict()
        result = spark.read.parquet(path)
        figures |= {"output_rows": result.count(), "output_parquet_bytes": sinks.size_of(path)} | minutes.unique_cells(result).first().asDict()
        figures["output_parquet_mb"] = round(figures["output_parquet_bytes"] / 1048576, 3)
        sinks.write_figures(figures, f"{folder}/qa_summary_{a.city}.csv")
    if a.export_covariates and a.uuid_table and figures["kept_rows"]:
        with sinks.step("covariates"):
            users = readers.read_table(spark, a.uuid_table)
            sinks.write_parquet(covariates(users, grid, given, a.uuid_hash_method, a.output_grid_uid, a.output_grid_id, a.grid_uid_prefix, code, a.grid_uid_order), f"{folder}/user_covariates_{a.city}.parquet")
    return figures


def _run_filled(spark: SparkSession, a: argparse.Namespace, units, value: str | None, name: str) -> dict:
    options = fill.Options(a.windows, a.min_interval_minutes, a.point_source_filter, a.point_source_value, _clock(a), getattr(a, "coords_already_projected", False), a.uid64_hash_method, a.id_mode, a.overlap_rounding, a.oob_mode, a.drop_uuid_not_in_table, a.city_code_col, value, a.spread_users)
    given = json_or_file(a.schema_map)
    folder = f"{a.out_dir.rstrip('/')}/{a.city}"
    sinks.log_to(f"{folder}/run_log_{name}_strict_filled_{a.city}.txt")
    users = readers.read_table(spark, a.uuid_table) if a.uuid_table else None
    stages = f"{a.tmp_root.rstrip('/') if a.tmp_root else folder}/tmp_{name}_strict_filled_{a.city}"
    rows = fill.marked(readers.read(spark, a.staypoints, a.staypoints_format), units, options, users, given)
    if not (a.resume_stage2 and sinks.complete(stages)):
        with sinks.step("observations"):
            sinks.write_parquet(fill.observations(rows, options), stages)
    seen = spark.read.parquet(stages)
    shared = fill.shares(seen, units, options).persist()
    path = f"{folder}/user_{name}_time_strict_filled_{a.city}.parquet"
    with sinks.step("strict and filled minutes"):
        sinks.write_parquet(fill.filled(shared, units, options), path)
    with sinks.step("quality figures"):
        days = fill.day_windows(shared)
        figures = _echo(a) | fill.row_counts(rows, units, options).first().asDict()
        figures["uid64_uuid_collision_rows"] = fill.names_of(seen).where("n_uuid > 1").count() if options.id_mode.lower() != "uid64" else 0
        figures |= {"output_rows": spark.read.parquet(path).count(), "output_parquet_bytes": sinks.size_of(path)} | fill.user_counts(days).first().asDict()
        figures["output_parquet_mb"] = round(figures["output_parquet_bytes"] / 1048576, 3)
        for r in fill.window_figures(days).collect():  # one row for each band
            figures |= {f"{r['window']}__{k}": v for k, v in r.asDict().items() if k != "window"}
        sinks.write_figures(figures, f"{folder}/qa_summary_{name}_strict_filled_{a.city}.csv")
    shared.unpersist()
    if not a.keep_intermediate:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stages)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    return figures


def run_grid_filled(spark: SparkSession, a: argparse.Namespace) -> dict:
    grid = read_grid(a.grid_meta)
    value = city_value(a.city_code_value, a.grid_uid_code, grid.code) if a.filter_city_code else None
    cells = fill.Cells(grid, a.grid_uid_prefix, uid_code(a.grid_uid_code, grid.code, a.city), a.grid_uid_order, a.output_grid_uid, a.output_grid_id)
    return _run_filled(spark, a, cells, value, "grid")


def run_hex_filled(spark: SparkSession, a: argparse.Namespace) -> dict:
    meta = read_hexes(a.hex_meta)
    value = city_value(a.city_code_value, a.hex_uid_code, meta.code) if a.filter_city_code else None
    hexes = fill.Hexes(meta.table(spark), meta.resolution, meta.bbox, a.hex_uid_prefix, uid_code(a.hex_uid_code, meta.code, a.city), a.output_hex_uid, a.output_h3_id, a.output_h3_int, a.cell_column)
    return _run_filled(spark, a, hexes, value, "hex")


# ---- arguments -----------------------------------------------------------------------------------------------------


def _yes(p: argparse.ArgumentParser, name: str, default: bool) -> None:
    p.add_argument(f"--{name}", type=truth, default=default, metavar="yes|no")


def _common(p: argparse.ArgumentParser, windows: str) -> None:
    p.add_argument("--city", required=True)
    p.add_argument("--staypoints", required=True, nargs="+", help="files or globs, parquet or CSV")
    p.add_argument("--staypoints_format", default="auto", choices=readers.FORMATS)
    p.add_argument("--out_dir", required=True)
    for name in ("uuid_table", "tmp_root", "schema_map", "city_code_col", "city_code_value"):
        p.add_argument(f"--{name}", default=None)
    _yes(p, "filter_city_code", False)
    p.add_argument("--windows", default=windows, help="lunch, dinner, or both with a comma")
    _yes(p, "timestamps_are_utc", True)
    p.add_argument("--tz_offset_hours", type=int, default=8)
    p.add_argument("--epoch_unit", default="ms", choices=["ms", "s"])
    p.add_argument("--null_time", default="invalid", choices=["invalid", "compat"], help="whether a missing time is invalid, or -1 before the shift to local time")
    p.add_argument("--overlap_rounding", default="floor", choices=list(ROUNDING))
    p.add_argument("--oob_mode", default="drop", choices=["drop", "null", "keep"])
    p.add_argument("--threads", type=int, default=8, help="of a local session")
    p.add_argument("--memory_limit", default="16GB", help="of a local session")
    _yes(p, "keep_intermediate", False)
    for name, default in (("buckets", 256), ("batch_size", 1_000_000), ("log_every_batches", 500)):
        p.add_argument(f"--{name}", type=int, default=default, help="accepted; partitioning is Spark's")


def _grid(p: argparse.ArgumentParser) -> None:
    p.add_argument("--grid_meta", required=True)
    _yes(p, "output_grid_uid", True)
    _yes(p, "output_grid_id", False)
    p.add_argument("--grid_uid_code", default=None)
    p.add_argument("--grid_uid_prefix", default="grid")
    p.add_argument("--grid_uid_order", default="col_row", choices=["col_row", "row_col"])
    _yes(p, "coords_already_projected", False)


def _filled(p: argparse.ArgumentParser) -> None:
    p.add_argument("--min_interval_minutes", type=int, default=5)
    _yes(p, "point_source_filter", True)
    p.add_argument("--point_source_value", default="cell_appearance")
    _yes(p, "drop_uuid_not_in_table", False)
    p.add_argument("--uid64_hash_method", default="sha256_64", choices=METHODS)
    p.add_argument("--id_mode", default="uuid", choices=list(fill.ID_MODES))
    p.add_argument("--duckdb_temp_dir", default=None, help="accepted; spilling is Spark's")
    _yes(p, "resume_stage2", False)
    _yes(p, "spread_users", True)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="dwell", description="Visit profiles and exposure minutes from stay records.")
    sub = top.add_subparsers(dest="command", required=True)
    v = sub.add_parser("visits")
    v.add_argument("--input", required=True)
    v.add_argument("--output_dir", default="./output")
    v.add_argument("--output_file", default="user_poi_analysis.parquet")
    v.add_argument("--max_rows", type=int, default=None)
    v.add_argument("--rhythm_specs", default=None, help="JSON or a file of it")
    v.add_argument("--threads", type=int, default=8)
    v.add_argument("--memory_limit", default="16GB")
    v.set_defaults(run=lambda spark, a: run_visits(spark, a.input, a.output_dir, a.max_rows, a.output_file, json_or_file(a.rhythm_specs)))
    g = sub.add_parser("grid-minutes")
    _common(g, "lunch")
    _grid(g)
    g.add_argument("--poi_meta", default=None)
    g.add_argument("--min_stay_minutes", type=int, default=5)
    _yes(g, "exclude_poi_id_zero", True)
    g.add_argument("--poi_filter_mode", default="all_stops", choices=minutes.POI_MODES)
    g.add_argument("--food_category_keywords", default=",".join(minutes.FOOD_KEYWORDS))
    g.add_argument("--uuid_hash_method", default="sha256_64", choices=METHODS)
    _yes(g, "export_covariates", False)
    g.set_defaults(run=run_grid_minutes)
    f = sub.add_parser("grid-filled")
    _common(f, "lunch,dinner")
    _grid(f)
    _filled(f)
    f.set_defaults(run=run_grid_filled)
    h = sub.add_parser("hex-filled")
    _common(h, "lunch,dinner")
    h.add_argument("--hex_meta", required=True)
    _yes(h, "output_hex_uid", True)
    _yes(h, "output_h3_id", True)
    _yes(h, "output_h3_int", False)
    h.add_argument("--hex_uid_code", default=None)
    h.add_argument("--hex_uid_prefix", default="hex")
    h.add_argument("--cell_column", default=None, help="a column of precomputed cells, in place of coordinates")
    _filled(h)
    h.set_defaults(run=run_hex_filled)
    return top


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    a.run(session(a.threads, a.memory_limit), a)
