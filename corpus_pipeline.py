"""A corpus from documents to packed sequences: rules, exact and near duplicates, mixing, packing.

Each stage works on all rows that its predecessor kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwell.llm.common import drop, noted, written
from dwell.llm.exact_dedup import exact_dedup
from dwell.llm.mixing import drawn, mixing
from dwell.llm.ngram_join import BROADCAST_ROWS, ngram_join
from dwell.llm.packing import packing
from dwell.llm.quality_rules import quality_rules
from dwell.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rules or the posterior of the weighed votes reject."""
    return quality_rules(docs, columns=COLUMNS, store=lambda df: written(df, "measured")).where("kept").select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row stays of texts that are equal but for white space."""
    return exact_dedup(docs, columns=COLUMNS).where("kept").select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id stays. Rows without an id stay."""
    gone = written(ngram_join(docs).where("doc_id <> component_id").select("doc_id").distinct(), "near-copies")
    few = gone.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as bring the domains' tokens to their target weights; in all as many tokens as came in."""
    out, _ = mixing(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), columns=COLUMNS, store=lambda df: written(df, "posteriors"))
    return drawn(out, COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens; one row for each piece, with its ids as little-endian uint32."""
    return packing(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [("quality rules", rules), ("exact dedup", exact), ("n-gram join", near), ("mixing", mix), ("packing", pack)]
#: Expectation-maximisation, components, gradient steps and packing are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stage writes on its way is deleted when its table is written, and that table when the next one's is; the last
    stage reads what the one before it left."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with noted() as folders:
            docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        *passing, kept = folders
        for folder in before + passing:
            drop(spark, folder)
        before = [kept]
    return STAGES[-1][1](spark, docs, sf_dir)
