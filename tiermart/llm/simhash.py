"""SimHash near-duplicates linked through BK-trees.

Fingerprint: words are runs of non-white-space (ASCII white space), A-Z
lower-cased; every ``shingle`` words, repeats included, joined by one space
give one XXH64 (seed 42); a bit is set if it is set in over half of them. A
text with fewer words is one shingle; a text without words (or null) has
fingerprint zero.

Links: two fingerprints that differ in at most ``radius`` bits. Distinct
fingerprints are dealt into shards: the 64 bits are cut into ``blocks``
blocks, at most ``radius`` of which can differ, so two linked fingerprints
agree on some ``blocks - radius`` blocks and meet in that choice's shard.
Each shard builds a BK-tree (children keyed by their Hamming distance to the
parent) and every fingerprint of the shard walks it, following only edges
within the radius of its distance to the node.

Sending the trees of all shards through the driver would make a broadcast
that grows with the corpus, so a tree travels only to the queries of its own
shard, by the shuffle. A shard above ``cell`` fingerprints is cut into hashed
chunks, and each pair of chunks becomes a cell of its own: no task holds more
than about two chunks, and no pair is lost. A cell returns a spanning star of
what it linked, never pairs; components are then joined across cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.llm.common import arrow_map, checkpointed, utf8
from tiermart.llm.components import connected_components

SEED = 42
SHINGLE = 3
RADIUS = 3
BLOCKS = 5
CELL = 4096


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a UTF-8 text."""
    words = (text or b"").lower().split()  # bytes: lower-cases A-Z, splits at ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    h = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return h(joined, seed)
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    start = np.concatenate(([0], np.cumsum(length + 1)[:-1]))
    end = (start + length)[shingle - 1:]
    hashes = np.array([h(joined[a:b], seed) for a, b in zip(start.tolist(), end.tolist())], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp): one row per input row; fp holds the 64 bits as a signed long."""

    def rows(batch: pa.RecordBatch) -> dict:
        fps = np.array([fingerprint(t, shingle) for t in utf8(batch.column(1))], dtype=np.uint64)
        return {key: batch.column(0), "fp": pa.array(fps.view(np.int64))}

    kind = docs.schema[key].dataType.simpleString()
    return arrow_map(docs.select(key, text), rows, f"`{key}` {kind}, fp long")


class BKTree:
    """Burkhard-Keller tree over distinct 64-bit values, Hamming distance."""

    def __init__(self, values: np.ndarray):
        self.values = [int(v) for v in values]
        self.children: list[dict[int, int]] = [{} for _ in self.values]
        for i in range(1, len(self.values)):
            node, value = 0, self.values[i]
            while True:
                d = (value ^ self.values[node]).bit_count()
                below = self.children[node].get(d)
                if below is None:
                    self.children[node][d] = i
                    break
                node = below

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, indices of the queries within ``radius`` of it), for all queries in one walk."""
        if not self.values or not len(queries):
            return
        stack = [(0, np.arange(len(queries)))]
        while stack:
            node, at = stack.pop()
            d = np.bitwise_count(queries[at] ^ np.uint64(self.values[node])).astype(np.int64)
            near = at[d <= radius]
            if len(near):
                yield node, near
            for edge, child in self.children[node].items():
                go = at[np.abs(d - edge) <= radius]
                if len(go):
                    stack.append((child, go))


def cell_links(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct uint64 values -> (member, root) of each linked member but the roots."""
    if len(values) == 2:
        if int(values[0] ^ values[1]).bit_count() > radius:
            return values[:0], values[:0]
        return values[1:], values[:1]
    label = np.arange(len(values))
    for node, near in BKTree(values).within(values, radius):
        if len(near) > 1:
            groups = np.unique(label[near])
            if len(groups) > 1:
                label[np.isin(label, groups)] = groups[0]
    other = label != np.arange(len(values))
    return values[other], values[label[other]]


def _cells(fps: DataFrame, radius: int, blocks: int, cell: int) -> DataFrame:
    """Distinct fingerprints -> (shard, x, y, fp), one row per cell that the fingerprint is in."""
    if blocks <= radius:
        raise ValueError("blocks must exceed radius, or a linked pair may share no block")
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    keys = []
    for n, kept in enumerate(combinations(range(blocks), blocks - radius)):
        mask = 0
        for b in kept:
            mask |= ((1 << (edges[b + 1] - edges[b])) - 1) << edges[b]
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(n).alias("part"), F.col("fp").bitwiseAND(F.lit(signed)).alias("bits")))
    shards = fps.select("fp", F.explode(F.array(*keys)).alias("shard")).select("shard.part", "shard.bits", "fp")
    sizes = (shards.groupBy("part", "bits").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
             .select("part", "bits", F.ceil(F.col("n") / cell).cast("int").alias("chunks")))
    dealt = shards.join(sizes, ["part", "bits"])  # a shard of one has no pair
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    return dealt.withColumn("mine", mine).select(
        "part", "bits", "mine", "fp", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"),
    ).select("part", "bits", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "fp")


def links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """Distinct fingerprints (fp) -> (a, b): edges that connect all that are linked, directly or not."""
    cells = _cells(fps, radius, blocks, cell).withColumn("cell", F.xxhash64("part", "bits", "x", "y"))
    cells = cells.select("cell", "fp").repartition("cell").sortWithinPartitions("cell", "fp")

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_c, rest_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            c = np.concatenate((rest_c, batch.column(0).to_numpy()))
            f = np.concatenate((rest_f, batch.column(1).to_numpy().view(np.uint64)))
            cut = np.searchsorted(c, c[-1]) if len(c) else 0  # the last cell may go on in the next batch
            yield from linked(c[:cut], f[:cut])
            rest_c, rest_f = c[cut:], f[cut:]
        yield from linked(rest_c, rest_f)

    def linked(c: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(c):
            return
        bounds = np.flatnonzero(np.diff(c)) + 1
        members, roots = [], []
        for lo, hi in zip([0, *bounds.tolist()], [*bounds.tolist(), len(c)]):
            if hi - lo > 1:
                m, r = cell_links(np.unique(f[lo:hi]), radius)
                if len(m):
                    members.append(m)
                    roots.append(np.broadcast_to(r, m.shape))
        if members:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (members, roots)], names=["a", "b"])

    return cells.mapInArrow(stage, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """(key, fp, component): component is the smallest key reachable over links, the row's own included.

    Null or empty texts have fingerprint zero and link like any other; repeated
    rows link to themselves; rows whose whole component has a null key get a
    null component. An empty table gives no rows.
    """
    own = checkpointed(fingerprints(docs, key, text, shingle))
    distinct = own.groupBy("fp").agg(F.min(key).alias("least"))
    found = connected_components(links(distinct.select("fp"), radius, blocks, cell))
    roots = (distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("root", F.coalesce("root", "fp")))
    ids = roots.groupBy("root").agg(F.min("least").alias("component"))
    by_fp = roots.select("fp", "root").join(ids, "root").select("fp", "component")
    return own.join(by_fp, "fp").select(key, "fp", "component")


def keep_representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                         radius: int = RADIUS) -> DataFrame:
    """Rows of ``docs`` but the later ones of each group.

    The row whose key is the group's component stays; of rows that share that key
    the one with the least text hash, and of wholly equal rows one. Rows without a
    key have no group of their own to stand for and stay as they are.
    """
    found = near_duplicates(docs.where(F.col(key).isNotNull()), key, text, shingle, radius)
    kept = found.where(F.col(key) == F.col("component")).select(key).distinct()
    chosen = docs.join(kept, key, "left_semi")
    rest = [c for c in docs.columns if c != key]
    once = chosen.groupBy(key).agg(F.min(F.struct(F.xxhash64(text).alias("__h"), *rest)).alias("__row"))
    return once.select(*[F.col(key) if c == key else F.col(f"__row.{c}").alias(c) for c in docs.columns]).union(
        docs.where(F.col(key).isNull()))
