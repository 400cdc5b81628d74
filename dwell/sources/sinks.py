"""DataFrames to files."""

from __future__ import annotations

import csv
import io
import logging
import time
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger("dwell")


def write_parquet(df: DataFrame, path: str, compression: str = "zstd", files: int | None = None) -> None:
    """A folder of parquet files; an empty table is written with its columns. files: at most so many."""
    (df if files is None else df.coalesce(files)).write.mode("overwrite").option("compression", compression).parquet(path)


def write_csv(df: DataFrame, path: str, files: int | None = 1) -> None:
    (df if files is None else df.coalesce(files)).write.mode("overwrite").option("header", True).csv(path)


def _hadoop(path: str):
    """(file system, path) through Hadoop, for addresses with a scheme."""
    spark = SparkSession.getActiveSession()
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _remote(path: str) -> bool:
    return "://" in path or path.startswith("file:")


def write_figures(figures: dict, path: str | Path) -> None:
    """One row of quality figures as CSV in UTF-8 with a byte order mark, on the driver; path may have any scheme that Spark writes."""
    text = io.StringIO(newline="")
    out = csv.writer(text)
    out.writerow(figures.keys())
    out.writerow(["" if v is None else v for v in figures.values()])
    data = text.getvalue().encode("utf-8-sig")
    if _remote(str(path)):
        files, where = _hadoop(str(path))
        stream = files.create(where, True)
        stream.write(data)
        stream.close()
        return
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_bytes(data)


def size_of(path: str) -> int:
    """Bytes of the parquet files in a folder, or of a file; 0 where there is none."""
    if _remote(path):
        files, where = _hadoop(path)
        return files.getContentSummary(where).getLength() if files.exists(where) else 0
    p = Path(path)
    return sum(f.stat().st_size for f in p.rglob("*.parquet")) if p.is_dir() else p.stat().st_size if p.exists() else 0


def complete(path: str) -> bool:
    """Whether a folder was written to its end."""
    if _remote(path):
        files, where = _hadoop(f"{path.rstrip('/')}/_SUCCESS")
        return bool(files.exists(where))
    return (Path(path) / "_SUCCESS").exists()


def _memory_mb() -> float:
    import resource

    return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024


@contextmanager
def step(name: str):
    """Logs a step with the time that it took."""
    began = time.time()
    log.info("%s ...", name)
    yield
    log.info("%s: %.1f s, at most %.0f MB on the driver", name, time.time() - began, _memory_mb())


def log_to(path: str | Path) -> None:
    """A run log with time stamps beside the results."""
    if _remote(str(path)) and not str(path).startswith("file:"):
        handler: logging.Handler = logging.StreamHandler()  # a log grows line by line, which object stores do not offer
    else:
        where = Path("/" + str(path).removeprefix("file:").lstrip("/")) if str(path).startswith("file:") else Path(path)
        where.parent.mkdir(parents=True, exist_ok=True)
        handler = logging.FileHandler(where, encoding="utf-8")
    handler.setFormatter(logging.Formatter("%(asctime)s %(message)s", "%Y-%m-%d %H:%M:%S"))
    log.addHandler(handler)
    log.setLevel(logging.INFO)
