"""Exact duplicates by a sharded minimal perfect hash over distinct digests.

A text's digest is the SHA-256 of the text with each run of ASCII white space replaced by one space. The distinct
digests of the history form the index: they are dealt to shards by hash, and each shard is a minimal perfect hash whose
slots hold the whole digest, the winner's locator (its id) and the number of copies. A row looks its digest up in its
shard; all 32 bytes in the slot must be equal, so a stranger that lands on a slot is no member. Without a history the
table is its own history, so every row is a member. With one, members are repeats of a historical winner, and
nonmembers are grouped among themselves by the same routine.

Scale: only digests and ids move, and digests combine on the map side, so a digest that a third of all rows share is
one row for each map task. For the lookups, a shard's index is a bounded binary row that travels in front of the rows
that ask for it; shards with many rows (hot digests) are split by a hash of the id into parts of about equal size and
the index row is repeated for each part. A task holds one shard's index and one Arrow batch at a time.

Edge cases: a null text counts as empty; the smallest id wins, null ids only where a group has no other; of rows tied
on the winning id exactly one stays; equal rows are copies; input columns named like an output give way to it; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwell.llm import mph
from dwell.llm.common import SPACE_CLASS, giving_back, packed, partitions, quoted, small_batches, unpacked, written

KEYS_IN_SHARD = 50_000
#: Rows of a shard beyond which it is split, as a multiple of the mean rows of a partition.
SPLIT = 0.5
OUTPUTS = ("keep_id", "group_size", "kept", "text_sha256")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE_CLASS + "+", " ")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def _words(digests: pa.Array) -> np.ndarray:
    """Digests as rows of four uint64."""
    flat = b"".join(digests.to_pylist())
    return np.frombuffer(flat, "<u8").reshape(-1, 4)


def _key(words: np.ndarray) -> np.ndarray:
    return mph.key64(words[:, 0], words[:, 1])


INDEX_SCHEMA = "shard long, index binary"


def _index_of(rows: pa.Table) -> pa.Table:
    words = _words(rows.column("digest").combine_chunks())
    index = mph.PerfectHash.build(_key(words))
    at = index.slots(_key(words))
    digests, winners, no_id, copies = np.zeros((len(index), 4), np.uint64), np.zeros(len(index), np.int64), np.zeros(len(index), bool), np.zeros(len(index), np.int64)
    digests[at] = words
    winners[at] = rows.column("winner").fill_null(0).to_numpy()
    no_id[at] = rows.column("winner").is_null().to_numpy()
    copies[at] = rows.column("copies").to_numpy()
    data = mph.to_bytes(index, digests=digests, winners=winners, no_id=no_id, copies=copies)
    return pa.table({"shard": rows.column("shard").slice(0, 1), "index": pa.array([data], pa.binary())})


def _shard(n_shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(n_shards))


def build_index(digests: DataFrame, n_shards: int) -> DataFrame:
    """(shard, index) over the distinct values of column digest, with the smallest id and the number of rows."""
    distinct = digests.groupBy("digest").agg(F.min("id").alias("winner"), F.count(F.lit(1)).alias("copies"))
    return distinct.withColumn("shard", _shard(n_shards)).groupBy("shard").applyInArrow(_index_of, INDEX_SCHEMA)


def _looked_up(names: tuple[str, ...]):
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come ordered by shard and part; the index row of each comes first."""
        at, index, arrays, last = None, None, None, None
        for batch in batches:
            shards, parts = batch.column("shard").to_numpy(), batch.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(shards) != 0) | (np.diff(parts) != 0)) + 1).tolist(), len(shards)]
            for a, b in zip(cuts, cuts[1:]):
                rows = batch.slice(a, b - a)
                if at != (shards[a], parts[a]):
                    at, index, last = (shards[a], parts[a]), None, None
                    if rows.column("kind")[0].as_py() == 0:
                        index, arrays = mph.from_bytes(rows.column("index")[0].as_py())
                        rows = rows.slice(1)
                if not rows.num_rows:
                    continue
                words, n = _words(rows.column("digest")), rows.num_rows
                ids, no_id = rows.column("id").fill_null(0).to_numpy(), rows.column("id").is_null().to_numpy(zero_copy_only=False)
                member, slot = np.zeros(n, bool), np.zeros(n, np.int64)
                if index is not None and len(index):
                    slot = index.slots(_key(words))
                    member = (slot >= 0) & (arrays["digests"][slot] == words).all(axis=1)
                    slot = np.where(member, slot, 0)
                    winner, none, copies = arrays["winners"][slot], arrays["no_id"][slot], arrays["copies"][slot]
                else:
                    winner, none, copies = np.zeros(n, np.int64), np.ones(n, bool), np.zeros(n, np.int64)
                wins = member & (ids == winner) & (no_id == none)
                # equal rows are neighbours, also across batches
                same = np.zeros(n, bool)
                same[1:] = (words[1:] == words[:-1]).all(axis=1) & (ids[1:] == ids[:-1]) & (no_id[1:] == no_id[:-1])
                if last is not None:
                    same[0] = last == (words[0].tobytes(), ids[0], no_id[0])
                last = (words[-1].tobytes(), ids[-1], no_id[-1])
                out = {
                    "row": rows.column("row"), "id": rows.column("id"), "digest": rows.column("digest"), "member": pa.array(member),
                    "keep_id": pa.array(winner, pa.int64(), mask=none | ~member), "group_size": pa.array(copies, pa.int64(), mask=~member), "kept": pa.array(wins & ~same),
                }
                yield pa.RecordBatch.from_arrays([out[k] for k in names], names=list(names))

    return per_batch


def _lookup(rows: DataFrame, index: DataFrame, counts: DataFrame, n_shards: int, n_rows: int) -> DataFrame:
    """rows: digest, id, row. counts: rows of each shard. Adds member, keep_id, group_size, kept."""
    spark = rows.sparkSession
    n = partitions(spark)
    least = max(1.0, SPLIT * n_rows / n)
    # fewer than n / SPLIT shards can have more rows than that, whatever the input's size
    hot = F.broadcast(counts.where(F.col("n") > least).select("shard", F.ceil(F.col("n") / least).cast("int").alias("n_parts")))
    parts = F.coalesce("n_parts", F.lit(1))
    asking = rows.withColumn("shard", _shard(n_shards)).join(hot, "shard", "left")
    asking = asking.select("shard", F.pmod(F.xxhash64(F.lit(17), "id"), parts).cast("int").alias("part"), F.lit(1).alias("kind"), "digest", "id", F.lit(None).cast("binary").alias("index"), "row")
    row = rows.schema["row"].dataType
    first = index.join(hot, "shard", "left").select("shard", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("long").alias("id"), "index", F.lit(None).cast(row).alias("row"))
    stream = asking.unionByName(first).repartition(n, "shard", "part").sortWithinPartitions("shard", "part", "kind", "digest", "id")
    fields = {"row": row, "id": T.LongType(), "digest": T.BinaryType(), "member": T.BooleanType(), "keep_id": T.LongType(), "group_size": T.LongType(), "kept": T.BooleanType()}
    return stream.mapInArrow(giving_back(_looked_up(tuple(fields))), T.StructType([T.StructField(k, v) for k, v in fields.items()]))


def _resolved(rows: DataFrame, slim: DataFrame, history: DataFrame | None) -> DataFrame:
    """rows: digest, id, row; slim: the same rows' digest and id, as cheap to read as can be."""
    of = slim if history is None else history
    n_rows = slim.count()
    n_shards = max(2 * partitions(rows.sparkSession), -(-(n_rows if history is None else of.count()) // KEYS_IN_SHARD))
    index = build_index(of, n_shards)
    counts = slim.groupBy(_shard(n_shards).alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    found = _lookup(rows, index, counts, n_shards, n_rows)
    if history is None:
        return found
    found = written(found, "looked-up")
    strangers = found.where(~F.col("member"))
    fresh = _resolved(strangers.select("digest", "id", "row"), strangers.select("digest", "id"), None)
    members = found.where("member").withColumn("kept", F.lit(False)).withColumn("group_size", F.col("group_size"))
    return members.unionByName(fresh)


def exact_dedup(docs: DataFrame, history: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """The input's columns (or those named in columns) with keep_id, group_size, kept and text_sha256.

    history: rows with the same id and text columns that came earlier. Then a repeat of one has kept false, its
    winner's id in keep_id, and in group_size the number of copies in the history.
    """
    small_batches(docs.sparkSession)
    columns = docs.columns if columns is None else columns
    key = lambda df: [digest(F.col(quoted(text_col))).alias("digest"), F.col(quoted(id_col)).cast("long").alias("id")]
    slim = written(docs.select(*key(docs)), "digests") if columns != [id_col] else None
    if slim is None:
        rows = written(docs.select(*key(docs)), "digests")
        slim, rows = rows, rows.select("digest", "id", F.struct(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col)).alias("row"))
    else:
        rows = docs.select(*key(docs), packed(docs, columns).alias("row"))
    past = None if history is None else written(history.select(*key(history)), "history")
    out = _resolved(rows, slim, past)
    return out.select(*unpacked(columns, OUTPUTS), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
