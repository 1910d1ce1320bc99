"""Prefix trie of conversations by union-find over sorted neighbours.

A conversation is a sequence of turns; a turn is its role and text, null as empty. Its
key is the turns' 16-byte digests, in order, so that the bytes' order keeps conversations with a
common beginning together and a common prefix of bytes is a common prefix of turns. Rows are range-sorted over the
cluster by key and id, so copies of one conversation, however many, are spread by their ids.

Neighbours in that order have an edge as long as their longest common prefix (LCP). In each range the edges are
taken in descending depth; a union-find joins the neighbours' components, and every join is a branching
node at that depth (of several at one depth, one). Between a node and the next branching node above it lie
nodes with the same members. What is counted of a node is a sum over its rows, of numbers that depend on a row's
LCP with the rows before and after it only: the bytes of the nodes that it is the first member of, and whether it
ends in a leaf. These LCPs are known across the edges of ranges too: the first and last row of each range are compared.

A node is whole in its range unless it is no deeper than the LCP at an edge of the range. The others
lie on the paths of a range's first and last row and are the contracted forest: one partial row for a range, node and
depth. Partial rows are brought together by the prefix's digest and summed as a stream in order of the ranges, since the
ids that the digest of a node's ends is made of must come in order. Nodes whose parent is such a node look its id up by a join.

A range, with 16 bytes and a length for each turn, is what a task holds; its size follows from ``turns_per_range``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermart.llm.common import checkpointed

DIGEST = 16
TURNS_PER_RANGE = 400_000


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that stand for a turn: the role's length keeps role and text apart."""
    role = F.coalesce(role, F.lit("")).cast("binary")
    text = F.coalesce(text, F.lit("")).cast("binary")
    return F.unhex(F.md5(F.concat(F.length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role, text)))


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """(conv_id, parts): a conversation's turns in order, each as its digest and its text's UTF-8 bytes.

    Order is by turn, null first; equal turn numbers by digest, so reruns agree. Rows without a conversation id
    belong to none. No text leaves the scan.
    """
    return turns.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"),
        F.struct(F.col(f"`{turn}`").alias("turn"), turn_digest(F.col(f"`{role}`"), F.col(f"`{text}`")).alias("digest"),
                 F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).alias("size")).alias("part"),
    ).groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts")).select(
        "conv_id", F.transform("parts", lambda p: F.struct(p["digest"].alias("digest"), p["size"].alias("size"))).alias("parts"))


def keyed(found: DataFrame) -> DataFrame:
    """(conv_id, parts) -> (key, conv_id, sizes)."""
    return found.select(F.array_join(F.transform("parts", lambda p: F.hex(p["digest"])), "").alias("key"), "conv_id",
                        F.col("parts.size").alias("sizes")).withColumn("key", F.unhex("key"))


def common_turns(a: bytes, b: bytes) -> int:
    """Turns at the beginning that two keys have in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y)) // DIGEST


def branching(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges between neighbours (their LCP) -> (first row, end, depth) of the branching nodes.

    Edges go in descending depth; joining two components makes a node at the edge's depth, unless one of them
    is already a node of that depth, which then takes the other in.
    """
    n = len(lcp) + 1
    parent = list(range(n))  # of a component, by its first row
    end = list(range(1, n + 1))
    depth = [-1] * n
    lo, hi, at = [], [], []

    def first(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for e in np.argsort(-lcp, kind="stable").tolist():
        a, b, d = first(e), e + 1, int(lcp[e])  # b begins its component: the edge before it is the one just taken
        for c in (a, b):
            if depth[c] > d:  # a node that now hangs below another one: it is complete
                lo.append(c)
                hi.append(end[c])
                at.append(depth[c])
        parent[b] = a
        end[a] = end[b]
        depth[a] = d
    if n and depth[0] >= 0:
        lo.append(0)
        hi.append(end[0])
        at.append(depth[0])
    return np.array(lo, np.int64), np.array(hi, np.int64), np.array(at, np.int64)


class Range:
    """Rows of one range in order, with the LCP at its edges, and the nodes that they make."""

    def __init__(self, ids: np.ndarray, keys: list[bytes], sizes: list[np.ndarray], before: int, after: int):
        self.ids, self.keys = ids, keys
        self.before, self.after = before, after
        self.length = np.array([len(k) // DIGEST for k in keys], np.int64)
        inner = np.fromiter((common_turns(a, b) for a, b in zip(keys, keys[1:])), np.int64, max(0, len(keys) - 1))
        self.inner = inner
        self.lcp = np.concatenate(([before], inner))  # with the row before; -1: there is none
        following = np.concatenate((inner, [after]))
        # Bytes of each row's first 0, 1, 2, ... turns, row after row.
        self.at = np.concatenate(([0], np.cumsum(self.length + 1)))
        self.sums = np.concatenate([np.concatenate(([0], np.cumsum(s))) for s in sizes]).astype(np.int64)
        total = self.sums[self.at[1:] - 1]
        own = total - self.before_depth(np.arange(len(keys)), self.lcp)  # bytes of the nodes that the row is the first of
        equal = np.append((inner == self.length[:-1]) & (inner == self.length[1:]), False)
        last = np.flatnonzero(~equal)
        self.equal_to = last[np.searchsorted(last, np.arange(len(keys)))] + 1  # end of the rows that are equal to it
        self.total, self.own, self.leaf = (np.concatenate(([0], np.cumsum(x))) for x in
                                           (total, own, (following < self.length).astype(np.int64)))

    def before_depth(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Bytes of a row's first ``depth`` turns (none below 0)."""
        return self.sums[self.at[row] + np.maximum(depth, 0)]

    def least_id(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least id in each interval of rows: from two overlapping stretches of a power of two."""
        least = [self.ids]
        while 2 << len(least) <= 2 * len(self.ids):
            step = 1 << (len(least) - 1)
            least.append(np.minimum(least[-1][:-step], least[-1][step:]))
        k = np.floor(np.log2(hi - lo)).astype(np.int64)
        out = np.empty(len(lo), np.int64)
        for n, level in enumerate(least):
            at = np.flatnonzero(k == n)
            out[at] = np.minimum(level[lo[at]], level[hi[at] - (1 << n)])
        return out

    def nodes(self) -> dict[str, np.ndarray]:
        """All nodes that a row of the range is a member of, parents first: rows lo to hi, depth.

        Branching nodes and ends of conversations first; each stands for itself and the nodes above it, down from the
        next one above, that have the same members.
        """
        n = len(self.keys)
        lo, hi, depth = branching(self.inner)
        # A conversation that is no other's beginning (and has no equal) is joined by no edge at its own depth.
        least = np.maximum(self.lcp[:n], np.concatenate((self.inner, [-1])))
        least[0] = max([-1, *self.inner[:1].tolist()])
        alone = np.flatnonzero(self.length > least)
        lo, hi, depth = np.concatenate((lo, alone)), np.concatenate((hi, alone + 1)), np.concatenate((depth, self.length[alone]))
        # The depth of the next node above: the deeper of the LCPs at the interval's sides inside the range.
        left = np.where(lo > 0, np.append(self.inner, -1)[lo - 1], -1)
        right = np.where(hi < n, np.append(self.inner, -1)[np.minimum(hi, n) - 1], -1)
        above = np.maximum(left, right)
        count = depth - above
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        top = np.repeat(np.arange(len(lo)), count)
        out = {"lo": lo[top], "hi": hi[top], "depth": depth[top] - step}
        order = np.lexsort((out["depth"], -out["hi"], out["lo"]))  # a parent comes before its children
        return {k: v[order] for k, v in out.items()}


def _ancestors(node: dict[str, np.ndarray]) -> np.ndarray:
    """Number of each node's parent; the node of depth 0 has -1. Nodes come parents first."""
    path: list[int] = []
    out = np.full(len(node["depth"]), -1, np.int64)
    for i, d in enumerate(node["depth"].tolist()):
        del path[d:]
        if d:
            out[i] = path[d - 1]
        path.append(i)
    return out


def _digests(key: bytes, depth: int) -> list[bytes]:
    """Digest of the first 0, 1, ..., ``depth`` turns of a key."""
    h = hashlib.blake2b(digest_size=DIGEST)
    out = [h.copy().digest()]
    for d in range(depth):
        h.update(key[d * DIGEST:(d + 1) * DIGEST])
        out.append(h.copy().digest())
    return out


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def range_nodes(rows: Range, number: int) -> tuple[dict[str, list], dict[str, list]]:
    """(nodes, partial nodes) of a range, as columns; partial are those that an edge of the range cuts."""
    node = rows.nodes()
    lo, hi, depth = node["lo"], node["hi"], node["depth"]
    n = len(rows.keys)
    parent = _ancestors(node)
    begins = (lo > 0) | (depth > rows.before)  # the node's first member is in this range
    cut = ~begins | (hi == n) & (depth <= rows.after)
    size = hi - lo
    # Bytes up to the node's last text are the same in all of its members.
    upto = rows.before_depth(lo, depth - 1)
    saved = rows.total[hi] - rows.total[lo] - size * upto - (rows.own[hi] - rows.own[lo])
    saved -= np.where(begins, rows.before_depth(lo, rows.lcp[lo]) - upto, 0)
    children = np.zeros(len(lo), np.int64)
    inside = parent >= 0
    np.add.at(children, parent[inside], begins[inside].astype(np.int64))
    leaves = rows.leaf[hi] - rows.leaf[lo]
    # Members that end at the node come first, with ascending ids.
    ends = np.where(rows.length[lo] == depth, rows.equal_to[lo] - lo, 0)
    least = rows.least_id(lo, hi)

    of_first, of_last = _digests(rows.keys[0], rows.before), _digests(rows.keys[-1], rows.after)

    def digest(i: int) -> bytes | None:
        if i < 0:
            return None
        return of_first[depth[i]] if lo[i] == 0 and depth[i] <= rows.before else of_last[depth[i]]

    texts = [_joined(rows.ids[a:a + e]) if e else b"" for a, e in zip(lo.tolist(), ends.tolist())]
    counts = {"conv_id": least, "depth": depth, "n_convs": size, "n_children": children, "n_leaves": leaves,
              "saved_tokens": saved}
    out = []
    for at in (np.flatnonzero(~cut), np.flatnonzero(cut)):
        out.append({k: v[at] for k, v in counts.items()} | {"texts": [texts[i] for i in at.tolist()],
                                                            "range": np.full(len(at), number)})
        out[-1]["node"] = [digest(i) if cut[i] else None for i in at.tolist()]
        up = parent[at]
        unknown = (up >= 0) & cut[up]  # a partial node's id is known when its parts have met
        out[-1]["parent"] = [digest(i) if u else None for i, u in zip(up.tolist(), unknown.tolist())]
        out[-1]["parent_conv_id"] = [int(least[i]) if i >= 0 and not u else None
                                     for i, u in zip(up.tolist(), unknown.tolist())]
    return out[0], out[1]


def _edges(ordered: DataFrame) -> dict[int, tuple[int, int]]:
    """LCP of each range's first row with the row before it, and of its last with the row after it (-1: there is none).

    One row a range, read in order of the ranges; only the numbers come to the driver.
    """
    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = first = last = None
        for batch in batches:
            if batch.num_rows:
                if first is None:
                    number, first = batch.column(0)[0], batch.column(1)[0]
                last = batch.column(1)[batch.num_rows - 1]
        if first is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([number.as_py()], pa.int32()), pa.array([first.as_py()], pa.binary()),
                 pa.array([last.as_py()], pa.binary())], names=["range", "first", "last"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            out = []
            for first, last in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                out.append(-1 if before is None else common_turns(before, first))
                before = last
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int64())], names=["range", "lcp"])

    found = ordered.select("range", "key").mapInArrow(ends, "range int, first binary, last binary").coalesce(1) \
        .sortWithinPartitions("range").mapInArrow(compared, "range int, lcp long").toArrow()
    number, lcp = found.column("range").to_pylist(), found.column("lcp").to_pylist()
    return {r: (a, b) for r, a, b in zip(number, lcp, [*lcp[1:], -1])}


def _merged(partial: DataFrame) -> DataFrame:
    """Partial nodes -> whole ones: a stream in order of node and range, so that ends go into their digest in order."""
    numbers = ("n_convs", "n_children", "n_leaves", "saved_tokens")

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def give() -> pa.RecordBatch:
            columns = {name: [d[name] for d in done] for name in ("conv_id", "depth", *numbers, "node", "parent")}
            columns["ends_sha256"] = [d["ends"].hexdigest() for d in done]
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[name], kind) for name, kind in _MERGED], names=[name for name, _ in _MERGED])

        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["node"] != now["node"]:
                    if now:
                        done.append(now)
                    now = row | {"ends": hashlib.sha256(), "any": False}
                else:
                    now["conv_id"] = min(now["conv_id"], row["conv_id"])
                    for name in numbers:
                        now[name] += row[name]
                if row["texts"]:
                    now["ends"].update(b"," * now["any"] + row["texts"])
                    now["any"] = True
            if len(done) >= 10_000:
                yield give()
        if now:
            done.append(now)
        if done:
            yield give()

    ordered = partial.select("node", "range", "parent", "conv_id", "depth", *numbers, "texts").repartition("node") \
        .sortWithinPartitions("node", "range")
    return ordered.mapInArrow(stage, "conv_id long, depth long, n_convs long, n_children long, n_leaves long, "
                                     "saved_tokens long, node binary, parent binary, ends_sha256 string")


_MERGED = [("conv_id", pa.int64()), ("depth", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
           ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()),
           ("ends_sha256", pa.string())]
_FOUND = [("conv_id", pa.int64()), ("depth", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
          ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("range", pa.int64()), ("node", pa.binary()),
          ("parent", pa.binary()), ("parent_conv_id", pa.int64()), ("ends_sha256", pa.string()), ("texts", pa.binary())]


def trie(found: DataFrame, turns_per_range: int = TURNS_PER_RANGE) -> DataFrame:
    """(conv_id, parts) -> every node of the prefix trie.

    Per distinct sequence of first turns, from the one without turns: conv_id (the smallest member, a conversation that
    begins with it), depth, parent_conv_id (the parent's conv_id, null for the root), n_convs (members), n_children, n_leaves
    (childless nodes below it or itself), saved_tokens (summed over the node and those below it: members but one,
    times the bytes of the last text), ends_sha256 (of the members with no further turn, ascending, comma-joined; none: of
    nothing). A conversation without turns is a member of the root. No conversations make no nodes. A
    conversation's digests, 16 bytes a turn, are one value in its row.
    """
    keys = checkpointed(keyed(found))
    total = keys.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    ordered = checkpointed(
        keys.repartitionByRange(max(1, -(-total // turns_per_range)), "key", "conv_id").sortWithinPartitions("key", "conv_id")
        .select(F.spark_partition_id().alias("range"), "key", "conv_id", "sizes"))
    edges = _edges(ordered)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        number = held[0].column(0)[0].as_py()
        keys = [k for b in held for k in b.column(1).to_pylist()]
        ids = np.concatenate([b.column(2).to_numpy(zero_copy_only=False) for b in held])
        sizes = [np.array(s, np.int64) for b in held for s in b.column(3).to_pylist()]
        for part in range_nodes(Range(ids, keys, sizes, *edges[number]), number):
            whole = not any(part["node"])
            none = hashlib.sha256(b"").hexdigest()
            part["ends_sha256"] = [(hashlib.sha256(t).hexdigest() if t else none) if whole else None for t in part["texts"]]
            if whole:
                part["texts"] = [None] * len(part["texts"])
            made = pa.RecordBatch.from_arrays([pa.array(part[name], kind) for name, kind in _FOUND],
                                              names=[name for name, _ in _FOUND])
            for at in range(0, made.num_rows, 10_000):
                yield made.slice(at, 10_000)

    nodes = checkpointed(ordered.mapInArrow(
        stage, "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, range long, "
               "node binary, parent binary, parent_conv_id long, ends_sha256 string, texts binary"))
    merged = checkpointed(_merged(nodes.where("node is not null")))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = nodes.where("node is null")
    waiting = whole.where("parent is not null").drop("parent_conv_id", "range", "node", "texts").unionByName(
        merged.where("parent is not null").drop("node"))
    ids = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    root = merged.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return whole.where("parent is null").select(columns).union(
        waiting.join(ids, "parent", "left").select(columns)).union(root.select(columns))
