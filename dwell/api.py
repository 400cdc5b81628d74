"""The pipelines as functions with keyword arguments, over the session that is there or a local one.

Names and keywords are fixed: they are those of the command lines. What cannot be given has the command line's default;
what tunes another engine (chunks, buckets, batches, temporary folders) is accepted and has no effect on results.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import DataFrame

from dwell.plans import cli


def _plain(value):
    if isinstance(value, dict):
        return json.dumps(value, ensure_ascii=False)
    return os.fspath(value) if isinstance(value, os.PathLike) else value


def _arguments(command: str, meta: str, given: dict) -> argparse.Namespace:
    """The command line's defaults with what is given; an unknown keyword is an error."""
    a = cli.parser().parse_args([command, "--city", "-", "--staypoints", "-", "--out_dir", "-", f"--{meta}", "-"])
    for name in ("city", "staypoints", "out_dir", f"{meta}_path"):
        if name not in given:
            raise TypeError(f"missing keyword argument: {name}")
    for name, value in given.items():
        own = meta if name == f"{meta}_path" else name
        if own not in vars(a) or own in ("run", "command"):
            raise TypeError(f"unexpected keyword argument: {name}")
        if own == "staypoints":
            value = [_plain(v) for v in ([value] if isinstance(value, (str, os.PathLike)) else value)]
        elif own in ("windows", "food_category_keywords") and value is not None and not isinstance(value, str):
            value = ",".join(value)
        if value is not None or own not in ("windows",):
            setattr(a, own, _plain(value))
    return a


def _run(command: str, meta: str, given: dict) -> dict:
    a = _arguments(command, meta, given)
    return a.run(cli.session(a.threads, a.memory_limit), a)


def process_large_poi_data(input_file, output_dir="./output", chunk_size: int = 1_000_000, total_rows: int | None = None, max_rows: int | None = None, output_file: str = "user_poi_analysis.parquet", parts_dir=None, num_buckets: int = 32, clean_buckets: bool = True, notebook: bool = False, clean_parts: bool = True, rhythm_specs: dict | None = None) -> DataFrame:
    """Profiles of visits; the result stays a DataFrame, as it may be larger than the driver."""
    return cli.run_visits(cli.session(), os.fspath(input_file), os.fspath(output_dir), max_rows, output_file, rhythm_specs)


def export_user_grid_time(**given) -> dict:
    """Minutes of users in grid cells; the quality figures."""
    return _run("grid-minutes", "grid_meta", given)


def export_user_grid_time_strict_filled(**given) -> dict:
    """Strict, filled and total minutes of users in grid cells; the quality figures."""
    return _run("grid-filled", "grid_meta", given)


def export_user_hex_time_strict_filled(**given) -> dict:
    """The same in hexagons."""
    return _run("hex-filled", "hex_meta", given)
