"""The operators of this subpackage as queries over the whole tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwell.llm.common import written
from dwell.llm.cotraining import quality_classifier
from dwell.llm.exact_dedup import exact_dedup
from dwell.llm.license_scan import license_scan
from dwell.llm.line_dedup import line_dedup
from dwell.llm.mixing import mixing
from dwell.llm.ngram_join import ngram_join
from dwell.llm.packing import packing
from dwell.llm.quality_rules import quality_rules
from dwell.llm.substring_dedup import substring_dedup
from dwell.llm.wacz import warc_round_trip


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    out, model = mixing(docs, labels, columns=["doc_id"], store=lambda df: written(df, "posteriors"))
    return out.select("doc_id", "n_tokens", *[F.element_at("posteriors", d).alias(f"p_{d}") for d in model.domains], "rate")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing(_table(spark, sf_dir, "documents"), tokenizer_path())
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op5_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), columns=["doc_id"])


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc_round_trip(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"), columns=["doc_id"])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(_table(spark, sf_dir, "documents"), columns=["doc_id"], store=lambda df: written(df, "votes"))
    return out.drop("votes")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mixing, op2_line_dedup, op3_packing, op4_license_scan, op5_cotraining, op6_warc, op7_ngram_join, op8_exact_dedup, op9_quality_rules, op10_substring_dedup)}


OP2_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT r, doc_id, i, lines[i] AS line FROM (SELECT r, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM split)
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line
), gone AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10
), marked AS (
  SELECT keyed.*, gone.key IS NOT NULL AS drop FROM keyed LEFT JOIN gone ON keyed.key = gone.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE drop) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT drop), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

OP8_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": OP2_SQL, "op8_exact_dedup": OP8_SQL}
