"""What the operators of this subpackage share: the shared folder, written tables, files that every executor can reach."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space, as bytes and as a class for Java's and DuckDB's patterns.
SPACE = b" \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Rows in an Arrow batch handed to Python; whole texts may be long, so batches stay small.
BATCH_ROWS = 512


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on a local master a temporary one where that
    is unset. A path without a scheme is one of the default file system."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="dwell-checkpoint-"))
        base = context.getCheckpointDir()
    if "://" not in base and not base.startswith("file:"):
        path = context._jvm.org.apache.hadoop.fs.Path(base)
        base = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return base.rstrip("/")


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/dwell-{what}-{uuid.uuid4().hex}"


_noted: ContextVar[list[str] | None] = ContextVar("noted", default=None)


@contextmanager
def noted() -> Iterator[list[str]]:
    """The folders that written() fills meanwhile, in order."""
    folders: list[str] = []
    token = _noted.set(folders)
    try:
        yield folders
    finally:
        _noted.reset(token)


def written(df: DataFrame, what: str) -> DataFrame:
    """The rows of df, written to the shared folder and read back: this cuts the lineage at files that outlive executors."""
    path = new_folder(df.sparkSession, what)
    df.write.parquet(path)
    if (folders := _noted.get()) is not None:
        folders.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of an Arrow batch, unless the session already asks for smaller ones."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after its task and would hold it beside the stages to come."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
        trim(0)


def giving_back(inner: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """inner, after which its worker gives memory back."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from inner(batches)
        give_back()

    return per_partition


def drop(spark: SparkSession, folder: str) -> None:
    """Delete a table that written() left there. Whatever is still to be read from it must not need it any more."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(df: DataFrame, columns: Iterable[str]) -> Column:
    """The named columns as one struct, so that no name of theirs can clash with a working column."""
    columns = list(columns)
    return F.struct(*[F.col(quoted(c)).alias(c) for c in columns]) if columns else F.struct(F.lit(None).cast("int").alias("_"))


def unpacked(columns: Iterable[str], taken: Iterable[str], field: str = "row") -> list[Column]:
    """Columns out of such a struct; those in taken give way to the operator's own output of that name."""
    taken = set(taken)
    return [F.col(field).getField(c).alias(c) for c in columns if c not in taken]


def schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def put_file(uri: str, data: bytes) -> None:
    """Write a whole file under another name, then move it: a retried task replaces it with equal bytes."""
    files, path = filesystem(uri)
    files.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with files.open_output_stream(part) as out:
        out.write(data)
    files.move(part, path)


def get_file(uri: str) -> bytes:
    files, path = filesystem(uri)
    with files.open_input_file(path) as f:
        return f.read()


def table(schema_: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema_], schema=schema_)
