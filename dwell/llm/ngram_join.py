"""Near duplicates by word n-gram Jaccard, as a blocked sparse matrix product.

A document's set: the distinct hashes of its 5-word shingles (of all its words, where they are fewer). Two documents
link when 100 * overlap >= 80 * union; the result has the connected components of all links.

1. Sets. One pass over the texts; documents with equal sets are one class, named by a 64-bit hash of the set. A task
   gathers bundles of sets, in which copies are one.
2. Incidence, by n-gram blocks. A class needs to show only a prefix of its set: under one global order of n-grams two
   linked classes share an n-gram of their prefixes. The order puts the n-grams with the lowest hashes (SHARE of all)
   first, by frequency, and the others behind, by hash. A task sends the candidates for the prefix, bundled by
   block as arrays; a block counts the sets of each n-gram and returns those that occur in two or more.
3. Prefixes, by class blocks. N-grams of one set alone take the front of the order; what the block sent back follows
   by frequency, as far as the prefix reaches. Nearly all documents end here with nothing left.
4. Clusters. Classes that share a prefix n-gram are tied to that n-gram's smallest class, a number of ties linear in
   the postings; connected components of the ties are clusters. Links never leave a cluster.
5. Product. A cluster of more than BLOCK classes (or BLOCK_GRAMS n-grams) is cut by the size of its sets, each step wide
   enough that linked sets are of one step or of neighbours, and each step into blocks; each pair of blocks of one step or of
   neighbours is a task of its own, others cannot reach the bound and are never made. A task multiplies the incidence matrix of its classes with its transpose, chunk by chunk of n-grams, accumulating
   overlaps; pairs whose sizes or overlaps fall below the bound go. Of the links only a spanning forest is emitted, at
   most one row for each class, so copies are never expanded into pairs. A last run of components joins the forests.

Scale: moved are about 12 bytes for SHARE of all n-grams, once, 18 for those of them that repeat, and the sets of clustered classes, as often as their
step of sizes and its neighbours have blocks. A step of c classes costs (c / BLOCK) ** 2 / 2 tasks. Blocks of n-grams are as
many as the bytes of all texts ask for, so what a task holds does not grow with the input. Nothing is collected but counts. Hashes
have 64 bits: two different sets of one name (chance n ** 2 / 2 ** 65) would be taken for one class.

Edge cases: null and empty texts and texts without words have no set, link with nothing and are their own component;
equal rows and rows of one id are documents of their own; rows without an id are linked too, and a component of such
rows only has no id; very long texts are cut into overlapping pieces only for hashing; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwell.llm.common import give_back, giving_back, partitions, quoted, small_batches, written
from dwell.llm.components import components
from dwell.llm.mph import mixed
from dwell.llm.word_hash import ngram_hashes

WORDS = 5
PERCENT = 80
SHARE = 0.5
FLUSH = 1 << 18  # n-grams that a task bundles before it sends them
BLOCKS_PER_PARTITION = 2
BLOCK_BYTES = 32 << 20  # of text, at most, for each block of n-grams
BLOCK = 512
BLOCK_GRAMS = 1 << 18
CLASSES_TO_TRIM = 64  # of a product, beyond which its memory is given back
CHUNK = 2048  # columns of the incidence matrix in one product
#: Clustered classes up to which their ids are broadcast (8 bytes each); beyond, the texts are joined by shuffle.
BROADCAST_ROWS = 500_000


def prefix_length(n, percent: int = PERCENT):
    """n-grams of a set of n that must hold one shared with any linked set: n - ceil(percent * n / 100) + 1."""
    return n - -(-percent * n // 100) + 1


def set_name(hashes: np.ndarray) -> int:
    return int(np.array(xxhash.xxh3_64_intdigest(hashes.tobytes()), np.uint64).view(np.int64))


def _limit(share: float) -> np.uint64:
    return np.uint64(min(int(share * 2.0**64), 2**64 - 1))


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


SENT = pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("doc_id", pa.int64()), ("node", pa.int64()), ("name", pa.int64()), ("n", pa.int64()), ("n_low", pa.int64()), ("grams", pa.binary()), ("nodes", pa.binary())])
SENT_SQL = "kind int, block int, doc_id long, node long, name long, n long, n_low long, grams binary, nodes binary"


def _blank(n: int, kind: pa.DataType) -> pa.Array:
    return pa.nulls(n, kind)


def _cuts(block: np.ndarray) -> list[tuple[int, int]]:
    """Runs of equal values in sorted blocks."""
    ends = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
    return [(a, b) for a, b in zip(ends, ends[1:]) if b > a]


def _sent(n_words: int, percent: int, share: float, n_blocks: int):
    limit = _limit(share)

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A set is numbered within its bundle, so that an entry of the matrix is a hash and four bytes; copies within a
        bundle are one set. A node is such a number with its bundle's and its task's."""
        base = TaskContext.get().partitionId() << 40
        held: list[np.ndarray] = []
        numbers: dict[int, int] = {}
        size = 0

        def flush():
            grams = np.concatenate(held)
            nodes = np.repeat(np.arange(len(held), dtype=np.uint32), [len(v) for v in held])
            block = (grams % np.uint64(n_blocks)).astype(np.int32)
            order = np.argsort(block, kind="stable")
            grams, nodes, block = grams[order], nodes[order], block[order]
            part = _cuts(block)
            for i in range(0, len(part), 256):
                own = part[i : i + 256]
                n = len(own)
                yield pa.RecordBatch.from_arrays([pa.array([1] * n, pa.int32()), pa.array([int(block[a]) for a, _ in own], pa.int32()), _blank(n, pa.int64()), pa.array([base] * n, pa.int64()), *(_blank(n, pa.int64()) for _ in range(3)), pa.array([grams[a:b].tobytes() for a, b in own], pa.binary()), pa.array([nodes[a:b].tobytes() for a, b in own], pa.binary())], schema=SENT)

        for batch in batches:
            nodes, names, ns, lows = [], [], [], []
            for _, h in ngram_hashes(_texts(batch.column(1)), n_words):
                own = np.unique(h)
                n, n_low = len(own), int(np.searchsorted(own, limit))
                name = set_name(own) if n else 0
                if n and name not in numbers:
                    numbers[name] = len(held)
                    held.append(own[: max(n_low, prefix_length(n, percent))])
                    size += len(held[-1])
                nodes.append(base + numbers[name] if n else None)
                names.append(name)
                ns.append(n)
                lows.append(n_low)
            k = len(nodes)
            yield pa.RecordBatch.from_arrays([pa.array([0] * k, pa.int32()), _blank(k, pa.int32()), batch.column(0), pa.array(nodes, pa.int64()), pa.array(names, pa.int64()), pa.array(ns, pa.int64()), pa.array(lows, pa.int64()), _blank(k, pa.binary()), _blank(k, pa.binary())], schema=SENT)
            if size >= FLUSH:
                yield from flush()
                held, numbers, size = [], {}, 0
                base += 1 << 20  # a bundle has fewer sets than n-grams, and far fewer than this
        if held:
            yield from flush()

    return per_partition


def _by_block(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[int, dict[str, list]]]:
    """Rows ordered by block, as one dict of lists for each block."""
    block, held = None, {}
    for batch in batches:
        cols = {n: batch.column(n).to_pylist() for n in names}
        for i, b in enumerate(batch.column("block").to_pylist()):
            if b != block:
                if block is not None:
                    yield block, held
                block, held = b, {n: [] for n in names}
            for n in names:
                held[n].append(cols[n][i])
    if block is not None:
        yield block, held


def _joined(blobs: list[bytes | None], kind) -> np.ndarray:
    return np.frombuffer(b"".join([b for b in blobs if b]), kind)


SHARED_SQL = "kind int, block int, node long, n long, n_low long, grams binary, nodes binary, df binary"


def _class_block(nodes: np.ndarray, n: int) -> np.ndarray:
    return (mixed(nodes.view(np.uint64), 9) % np.uint64(n)).astype(np.int32)


def _shared(n_class_blocks: int):
    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """N-grams of two sets or more, bundled by class block over all blocks of the task, with the number of sets."""
        kind = pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("node", pa.int64()), ("n", pa.int64()), ("n_low", pa.int64()), ("grams", pa.binary()), ("nodes", pa.binary()), ("df", pa.binary())])
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush():
            grams, nodes, df = (np.concatenate(c) for c in zip(*held))
            block = _class_block(nodes, n_class_blocks)
            order = np.argsort(block, kind="stable")
            grams, nodes, df, block = grams[order], nodes[order], df[order], block[order]
            part = _cuts(block)
            for i in range(0, len(part), 256):
                own = part[i : i + 256]
                n = len(own)
                blobs = [pa.array([x[a:b].tobytes() for a, b in own], pa.binary()) for x in (grams, nodes, df)]
                yield pa.RecordBatch.from_arrays([pa.array([1] * n, pa.int32()), pa.array([int(block[a]) for a, _ in own], pa.int32()), *(_blank(n, pa.int64()) for _ in range(3)), *blobs], schema=kind)

        for _, rows in _by_block(batches, ["node", "grams", "nodes"]):
            grams = _joined(rows["grams"], np.uint64)
            nodes = np.concatenate([base + np.frombuffer(x, np.uint32).astype(np.int64) for base, x in zip(rows["node"], rows["nodes"])])
            order = np.argsort(grams, kind="stable")
            grams, nodes = grams[order], nodes[order]
            start = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            count = np.diff(np.append(start, len(grams)))
            df = np.repeat(count, count)
            many = df > 1
            if many.any():
                held.append((grams[many], nodes[many], np.minimum(df[many], 0xFFFF).astype(np.uint16)))
                size += int(many.sum())
            if size >= FLUSH:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return per_partition


POSTINGS_SQL = "gram long, node long"


def _prefixes(percent: int, share: float):
    limit = _limit(share)

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _by_block(batches, ["kind", "node", "n", "n_low", "grams", "nodes", "df"]):
            known = np.array([(a, b, c) for k, a, b, c in zip(held["kind"], held["node"], held["n"], held["n_low"]) if k == 0], np.int64).reshape(-1, 3)
            known = known[np.argsort(known[:, 0])]
            grams, nodes, df = (_joined(held[c], t) for c, t in (("grams", np.uint64), ("nodes", np.int64), ("df", np.uint16)))
            if not len(grams):
                continue
            # a class's low n-grams by frequency, behind those that it has alone; then the others, which are in the prefix or were not sent
            high = grams >= limit
            order = np.lexsort((grams, df, high, nodes))
            grams, nodes, high = grams[order], nodes[order], high[order]
            own = np.searchsorted(known[:, 0], nodes)
            n, n_low = known[own, 1], known[own, 2]
            start = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]]))
            count = np.diff(np.append(start, len(nodes)))
            low = np.add.reduceat(~high, start).astype(np.int64)
            rank = np.arange(len(nodes)) - np.repeat(start, count)
            keep = high | (n_low - np.repeat(low, count) + rank < prefix_length(n, percent))
            yield pa.RecordBatch.from_arrays([pa.array(grams[keep].view(np.int64)), pa.array(nodes[keep])], names=["gram", "node"])

    return per_partition


CHOSEN = ["node", "cluster", "step", "n_blocks", "n_up", "n_down", "at"]


def _sets(n_words: int):
    """The sets of classes that a cluster holds, from the text of one document each."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, sets = [], []
            for i, ((_, h), name) in enumerate(zip(ngram_hashes(_texts(batch.column("text")), n_words), batch.column("name").to_pylist())):
                own = np.unique(h)
                if len(own) and set_name(own) == name:  # another document may have the same id
                    keep.append(i)
                    sets.append(own.tobytes())
            rows = batch.select(CHOSEN).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(sets, pa.binary())], names=[*CHOSEN, "grams"])

    return per_partition


def overlaps(sets: list[np.ndarray], chunk: int = CHUNK) -> np.ndarray:
    """Sizes of all pairwise intersections: the product of the incidence matrix with its transpose, over column chunks."""
    size = np.array([len(s) for s in sets])
    kind = np.float32 if size.max() < 1 << 24 else np.float64  # in which counts are exact
    out = np.zeros((len(sets), len(sets)), kind)
    grams, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), size)
    use = count[at] > 1  # columns of one class add nothing beside the diagonal
    column = (np.cumsum(count > 1) - 1)[at[use]]
    row = row[use]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    n = int(column[-1]) + 1 if len(column) else 0
    for a in range(0, n, chunk):
        i, j = np.searchsorted(column, [a, a + chunk])
        part = np.zeros((len(sets), min(chunk, n - a)), kind)
        part[row[i:j], column[i:j] - a] = 1
        out += part @ part.T
    np.fill_diagonal(out, size)
    return out


def links(sets: list[np.ndarray], percent: int = PERCENT, rows: int = 64) -> np.ndarray:
    """Pairs (i, j), i < j, with 100 * overlap >= percent * union."""
    size = np.array([len(s) for s in sets], np.int64)
    both, found = overlaps(sets), [np.zeros((0, 2), np.int64)]
    for a in range(0, len(sets), rows):
        own, common = size[a : a + rows, None], both[a : a + rows].astype(np.int64)
        hit = (100 * np.minimum(own, size) >= percent * np.maximum(own, size)) & (100 * common >= percent * (own + size - common))
        pairs = np.argwhere(hit) + [a, 0]
        found.append(pairs[pairs[:, 0] < pairs[:, 1]])
    return np.concatenate(found)


def forest(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that connect what all pairs connect: at most n - 1."""
    parent = list(range(n))
    out = []
    for a, b in pairs.tolist():
        x, y = a, b
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[y] = x
            out.append((a, b))
    return out


def _product(percent: int):
    def of(rows: pa.Table) -> pa.Table:
        """The classes of two blocks of a cluster, or of one."""
        held = dict(zip(rows.column("node").to_pylist(), rows.column("grams").to_pylist()))
        nodes = sorted(held)
        sets = [np.frombuffer(held[v], np.uint64) for v in nodes]
        found = forest(len(nodes), links(sets, percent)) if len(nodes) > 1 else []
        if len(nodes) > CLASSES_TO_TRIM:
            give_back()
        return pa.table({"a": pa.array([nodes[a] for a, _ in found], pa.int64()), "b": pa.array([nodes[b] for _, b in found], pa.int64())})

    return of


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id that links reach) for every row."""
    spark = docs.sparkSession
    small_batches(spark)
    n = partitions(spark)
    texts = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(BLOCKS_PER_PARTITION * n, -(-size // BLOCK_BYTES))
    n_tasks, n_class_blocks = max(n, n_blocks // 8), max(n, n_blocks // 2)

    sent = written(texts.mapInArrow(giving_back(_sent(n_words, percent, SHARE, n_blocks)), SENT_SQL), "sent")
    own = sent.where("kind = 0").select("doc_id", "node", "name", "n", "n_low")
    # sets of one name are one class, whatever bundles they came in; its node is the least of theirs
    nodes = written(own.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.first("name").alias("name"), F.first("n").alias("n"), F.first("n_low").alias("n_low")), "nodes")
    classes = written(nodes.groupBy("name").agg(F.min("node").alias("class"), F.min("least").alias("least"), F.first("n").alias("n")), "classes")
    copies = nodes.join(classes.select("name", "class"), "name").where("node <> class").select("node", "class")

    dealt = sent.where("kind = 1").select("block", "node", "grams", "nodes").repartition(n_tasks, "block").sortWithinPartitions("block")
    shared = dealt.mapInArrow(giving_back(_shared(n_class_blocks)), SHARED_SQL)
    named = nodes.mapInArrow(giving_back(_blocked(n_class_blocks)), SHARED_SQL)
    met = shared.unionByName(named).repartition(n_tasks, "block").sortWithinPartitions("block")
    postings = met.mapInArrow(giving_back(_prefixes(percent, SHARE)), POSTINGS_SQL)
    postings = written(postings.join(copies, "node", "left").select("gram", F.coalesce("class", "node").alias("node")), "postings")

    lists = postings.groupBy("gram").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub <> last").select("gram", "hub")
    ties = postings.join(lists, "gram").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    clusters = components(ties).select(F.col("v").alias("node"), F.col("label").alias("cluster"))

    members = written(clusters.join(classes.select(F.col("class").alias("node"), "name", "least", "n"), "node"), "members")
    n_blocks_of = F.ceil(F.greatest(F.count(F.lit(1)) / block, F.sum("n") / BLOCK_GRAMS)).cast("int")
    totals = members.groupBy("cluster").agg(n_blocks_of.alias("n_blocks"))
    # sizes of linked sets differ by a factor of 100 / percent at most; a little more makes up for rounding
    step = F.floor(F.log("n") / (math.log(100 / percent) * (1 + 1e-9)) if percent < 100 else F.col("n")).cast("int")
    stepped = members.join(totals, "cluster").withColumn("step", F.when(F.col("n_blocks") > 1, step).otherwise(F.lit(0))).drop("n_blocks")
    groups = written(stepped.groupBy("cluster", "step").agg(n_blocks_of.alias("n_blocks")), "steps")
    beside = lambda by, name: groups.select("cluster", (F.col("step") + by).alias("step"), F.col("n_blocks").alias(name))
    wanted = stepped.join(groups.join(beside(-1, "n_up"), ["cluster", "step"], "left").join(beside(1, "n_down"), ["cluster", "step"], "left"), ["cluster", "step"])
    wanted = written(wanted.select("node", "name", "cluster", "step", "n_blocks", "n_up", "n_down", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int").alias("at"), "least"), "wanted")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    chosen = texts.join(wanted, texts.doc_id.eqNullSafe(F.col("least"))).select(*CHOSEN, "name", "text")
    sets = chosen.mapInArrow(giving_back(_sets(n_words)), ", ".join(f"{c} {'long' if c in ('node', 'cluster') else 'int'}" for c in CHOSEN) + ", grams binary")
    c, at = F.col("step"), F.col("at")
    pair = lambda s, i, t, j: F.struct(s.alias("s"), i.alias("i"), t.alias("t"), j.alias("j"))
    each = lambda count, f: F.when(F.col(count) > 0, F.transform(F.sequence(F.lit(0), F.col(count) - 1), f)).otherwise(F.array().cast("array<struct<s:int,i:int,t:int,j:int>>"))
    others = F.concat(each("n_blocks", lambda o: pair(c, F.least(at, o), c, F.greatest(at, o))), each("n_up", lambda o: pair(c, at, c + 1, o)), each("n_down", lambda o: pair(c - 1, o, c, at)))
    pairs = sets.select("node", "grams", "cluster", F.explode(others).alias("p")).select("node", "grams", "cluster", "p.*")
    found = pairs.groupBy("cluster", "s", "i", "t", "j").applyInArrow(_product(percent), "a long, b long")
    joined = components(found)

    named = classes.join(joined, classes["class"] == joined.v, "left").select("name", "least", F.coalesce("label", "class").alias("label"))
    least = named.groupBy("label").agg(F.min("least").alias("component"))
    by_class = named.join(least, "label").select("name", "component")
    out = own.join(by_class, "name", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def _blocked(n_class_blocks: int):
    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each node's sizes, sent to its class block."""
        for b in batches:
            node, n = b.column("node"), b.num_rows
            block = _class_block(node.to_numpy(), n_class_blocks)
            yield pa.RecordBatch.from_arrays([pa.array([0] * n, pa.int32()), pa.array(block), node, b.column("n"), b.column("n_low"), *(_blank(n, pa.binary()) for _ in range(3))], names=["kind", "block", "node", "n", "n_low", "grams", "nodes", "df"])

    return per_partition
