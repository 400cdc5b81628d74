"""Removal of lines that many documents repeat.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased. Lines whose key stands in at least
min_docs documents (and has min_chars code points) go, in every document. The document frequencies of 128-bit line
hashes are one map-side combined aggregation; no line text is shuffled. The hashes that reach min_docs are dealt to
shards, and each shard becomes a minimal perfect hash with an array of 64-bit fingerprints and an array of counts, one
file in the shared folder. Documents then probe those arrays, shard by shard, without a join and without a shuffle.

Scale: hashes below min_docs never enter the index, so it holds at most (lines / min_docs) entries of 12 bytes and 4
bits each. A Python worker keeps at most CACHE_BYTES of shards; texts are gathered to GATHER_BYTES, which visit every
shard that they need once. Where the index outgrows the cache (some ten million frequent lines), each gathering reads
the shards that it needs anew.

Edge cases: a null or empty text is one empty line; a line of white space has an empty key and always stays; equal rows
and rows of one id count as documents of their own; a document may lose all lines and then has an empty text; input
columns named like an output give way to it; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwell.llm import mph
from dwell.llm.common import SPACE, get_file, new_folder, packed, partitions, put_file, quoted, small_batches, unpacked, written

MIN_DOCS = 10
KEYS_IN_SHARD = 200_000
CACHE_BYTES = 128 << 20
#: Bytes of text that are probed together.
GATHER_BYTES = 8 << 20
OUTPUTS = ("text", "n_lines", "n_dropped")


def line_keys(text: bytes) -> list[bytes]:
    """bytes.lower() and bytes.strip() know ASCII only, which is the rule here."""
    return [line.strip(SPACE) for line in text.lower().split(b"\n")]


def hashes(keys: list[bytes]) -> np.ndarray:
    """128-bit hashes as two uint64 columns."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), dtype=">u8").reshape(-1, 2).astype(np.uint64)


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars)


def _counted(min_chars: int):
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[bytes] = []
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                found += [k for k in set(line_keys(text or b"")) if long_enough(k, min_chars)]
            for i in range(0, len(found), 100_000):
                h = hashes(found[i : i + 100_000]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())], names=["hi", "lo"])

    return per_batch


def _shard_of(hi: np.ndarray, n: int) -> np.ndarray:
    return (mph.mixed(hi, 7) % np.uint64(n)).astype(np.int64)


def _built(folder: str, n_shards: int):
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All rows of a shard reach one task, ordered by shard."""
        held: list[np.ndarray] = []
        shard = -1

        def close():
            rows = np.concatenate(held)
            hi, lo = rows[:, 0].view(np.uint64), rows[:, 1].view(np.uint64)
            index = mph.PerfectHash.build(mph.key64(hi, lo))
            at = index.slots(mph.key64(hi, lo))
            marks, counts = np.zeros(len(index), np.uint64), np.zeros(len(index), np.uint32)
            marks[at], counts[at] = lo, np.minimum(rows[:, 2], 0xFFFFFFFF)
            put_file(f"{folder}/shard-{shard}", mph.to_bytes(index, marks=marks, counts=counts))
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([len(rows)], pa.int64())], names=["shard", "n_keys"])

        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
            cuts = [0, *(np.flatnonzero(np.diff(rows[:, 3])) + 1).tolist(), len(rows)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if held and rows[a, 3] != shard:
                        yield close()
                        held = []
                    shard = int(rows[a, 3])
                    held.append(rows[a:b, :3])
        if held:
            yield close()

    return per_batch


class LineIndex:
    """What a task needs to probe the shards: the folder and their number."""

    def __init__(self, folder: str, n_shards: int, filled: frozenset[int]):
        self.folder, self.n_shards, self.filled = folder, n_shards, filled

    def counts(self, h: np.ndarray) -> np.ndarray:
        """Document frequencies of hashes; 0 for those that the index does not hold."""
        out = np.zeros(len(h), np.int64)
        shard = _shard_of(h[:, 0], self.n_shards)
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order])) + 1
        for rows in np.split(order, cuts):
            if len(rows) and int(shard[rows[0]]) in self.filled:
                index, arrays = _loaded(f"{self.folder}/shard-{int(shard[rows[0]])}")
                at = index.slots(mph.key64(h[rows, 0], h[rows, 1]))
                hit = (at >= 0) & (arrays["marks"][at] == h[rows, 1])
                out[rows[hit]] = arrays["counts"][at[hit]]
        return out


_cache: OrderedDict[str, tuple[int, tuple]] = OrderedDict()


def _loaded(uri: str):
    if uri in _cache:
        _cache.move_to_end(uri)
        return _cache[uri][1]
    data = get_file(uri)
    _cache[uri] = (len(data), mph.from_bytes(data))
    while len(_cache) > 1 and sum(n for n, _ in _cache.values()) > CACHE_BYTES:
        _cache.popitem(last=False)
    return _cache[uri][1]


def build_index(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = 1) -> LineIndex:
    spark = docs.sparkSession
    small_batches(spark)
    found = docs.select(F.col(quoted(text_col)).cast("string").alias("text")).mapInArrow(_counted(min_chars), "hi long, lo long")
    frequent = written(found.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs), "lines")
    n_shards = max(1, -(-frequent.count() // KEYS_IN_SHARD))
    folder = new_folder(spark, "line-index")
    dealt = frequent.mapInArrow(_with_shard(n_shards), "hi long, lo long, n long, shard long")
    built = dealt.repartition(min(n_shards, max(partitions(spark), n_shards // 8)), "shard").sortWithinPartitions("shard").mapInArrow(_built(folder, n_shards), "shard long, n_keys long")
    filled = frozenset(r.shard for r in built.select("shard").collect())  # one small number for KEYS_IN_SHARD keys
    return LineIndex(folder, n_shards, filled)


def _with_shard(n_shards: int):
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hi = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_shard_of(hi, n_shards))], names=["hi", "lo", "n", "shard"])

    return per_batch


def gathered(batches: Iterator[pa.RecordBatch], size: int = GATHER_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches joined until they hold so many bytes: each needed shard is visited once for all of them."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.column(0).nbytes
        if n >= size:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def _probed(index: LineIndex, min_docs: int, min_chars: int):
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            texts = [t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]
            keys = [line_keys(t) for t in texts]
            flat = [k for doc in keys for k in doc]
            use = np.fromiter((long_enough(k, min_chars) for k in flat), bool, len(flat))
            gone = np.zeros(len(flat), bool)
            if use.any():
                gone[use] = index.counts(hashes([k for k, u in zip(flat, use) if u])) >= min_docs
            kept, n_lines, n_dropped, at = [], [], [], 0
            for text, doc in zip(texts, keys):
                out = gone[at : at + len(doc)]
                at += len(doc)
                n = int(out.sum())
                kept.append(b"\n".join([line for line, o in zip(text.split(b"\n"), out.tolist()) if not o]) if n else text)
                n_lines.append(len(doc))
                n_dropped.append(n)
            new = [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(1), *new], names=["row", *OUTPUTS])

    return per_batch


def line_dedup(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = 1) -> DataFrame:
    """The input's columns with the texts that stay, n_lines (before) and n_dropped. See the module for edge cases."""
    index = build_index(docs, text_col, min_docs, min_chars)
    columns = [c for c in docs.columns if c != text_col]
    row = packed(docs, columns)
    whole = docs.select(F.col(quoted(text_col)).cast("string").alias("text"), row.alias("row"))
    out = whole.mapInArrow(_probed(index, min_docs, min_chars), _out_schema(whole))
    return out.select(*unpacked(columns, OUTPUTS), F.col("text").alias(text_col), "n_lines", "n_dropped")


def _out_schema(whole: DataFrame):
    return T.StructType([whole.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
