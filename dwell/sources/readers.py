"""Files to DataFrames: paths and globs, parquet and CSV."""

from __future__ import annotations

import glob
import os

from pyspark.sql import DataFrame, SparkSession

FORMATS = ("auto", "parquet", "csv")


def expand(paths: list[str] | str) -> list[str]:
    """Paths and globs in order, each file once. Addresses with a scheme go to Spark as they are."""
    out: dict[str, str] = {}
    for p in [paths] if isinstance(paths, str) else paths:
        if "://" in p or p.startswith("file:"):
            out.setdefault(p, p)
            continue
        found = sorted(glob.glob(p, recursive=True)) if glob.has_magic(p) else [p] if os.path.exists(p) else []
        if not found:
            raise FileNotFoundError(f"nothing matches {p}")
        for f in found:
            out.setdefault(os.path.realpath(f), f)
    if not out:
        raise FileNotFoundError("no input given")
    return list(out.values())


def format_of(paths: list[str], wanted: str = "auto") -> str:
    if wanted not in FORMATS:
        raise ValueError(f"a format is one of {', '.join(FORMATS)}")
    if wanted != "auto":
        return wanted
    for kind in ("parquet", "csv"):
        if all(p.rstrip("/").lower().endswith(f".{kind}") for p in paths):
            return kind
    raise ValueError("inputs must be all .parquet or all .csv; name the format otherwise")


def read(spark: SparkSession, paths: list[str] | str, wanted: str = "auto", lenient: bool = False) -> DataFrame:
    """One DataFrame over all files. The types of CSV columns come from the first file and hold for all.

    lenient: lines of CSV that do not fit are skipped.
    """
    files = expand(paths)
    if format_of(files, wanted) == "parquet":
        return spark.read.parquet(*files)
    schema = spark.read.option("header", True).option("inferSchema", True).csv(files[0]).schema
    return spark.read.option("header", True).option("mode", "DROPMALFORMED" if lenient else "PERMISSIVE").schema(schema).csv(files)


def read_visits(spark: SparkSession, path: str) -> DataFrame:
    """Visit records: parquet by its suffix, anything else as CSV."""
    return read(spark, path, "parquet" if path.rstrip("/").lower().endswith(".parquet") else "csv")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A side table: parquet by its suffix, anything else as lenient CSV."""
    return read(spark, path, "parquet" if path.rstrip("/").lower().endswith(".parquet") else "csv", lenient=True)
