"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal) that no neighbouring word extends keeping that period, of at least
``REPEATS`` periods and ``LEAST_WORDS`` words.

For each power of two L the dictionary names every factor of L words so that equal
factors have equal names: names of length 2L are pairs of names of length L. Only
factors that stand at least twice in their document keep a name, so levels thin out fast in
prose and end where nothing is repeated. Occurrences of a factor whose successor lies within 2L, and that one's
successor as far again, are an arithmetic progression; its step is proposed as a period. A run of q has, at
the least L >= q, such a progression from its first word on: a factor of q words or more of it cannot
recur at less than q, or q were not its smallest period. Where neighbouring positions propose the same step, the first
speaks for all. Proposals are extended both ways along the dictionary (as many steps as it has levels) and
deduplicated; a step is the smallest period of what it extends to, as a smaller one would make an earlier successor.

Documents are handled whole, many short ones at a time: words are numbered by document, so that no factor is
common to two. A document is the unit of work; memory follows the longest one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tiermart.llm.common import arrow_map, utf8

REPEATS = 4
LEAST_WORDS = 6
CHUNK_BYTES = 4_000_000  # texts handled at once, and one more at least

Rewrite = Callable[[int, list[bytes]], list[bytes]]


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of anything but ASCII white space."""
    return (text or b"").split()


def _named(keys: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(name, successor) by position: keys that stand once have name -1; no successor is -1."""
    name, successor = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    same = np.zeros(len(keys) + 1, bool)  # has the key before the same value
    same[1:-1] = keys[1:] == keys[:-1]
    repeated = same[:-1] | same[1:]
    name[at[repeated]] = np.cumsum(~same[:-1])[repeated]
    successor[at[:-1][same[1:-1]]] = at[1:][same[1:-1]]
    return name, successor


def factors(numbers: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Names and successors of the repeated factors of 1, 2, 4, ... words, as long as there are any."""
    n = len(numbers)
    names, successors = [], []
    name, successor = _named(numbers, np.arange(n), n)
    while (name >= 0).any():
        names.append(name)
        successors.append(successor)
        size = 1 << (len(names) - 1)
        if 2 * size > n:
            break
        at = np.flatnonzero((name[:n - size] >= 0) & (name[size:] >= 0))
        name, successor = _named(name[at] * (int(name.max()) + 1) + name[at + size], at, n)
    return names, successors


def proposals(successors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) from progressions of successors within twice the factor's length."""
    where, period = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, successor in enumerate(successors):
        gap = np.where(successor >= 0, successor - np.arange(len(successor)), 0)
        at = np.flatnonzero((gap > 0) & (gap <= 2 << k))
        at = at[gap[at + gap[at]] == gap[at]]
        step = np.zeros(len(gap) + 1, np.int64)
        step[at + 1] = gap[at]
        first = step[at] != gap[at]  # the position before proposes another step or none
        where.append(at[first])
        period.append(gap[at[first]])
    return np.concatenate(where), np.concatenate(period)


def runs_of(numbers: np.ndarray, repeats: int = REPEATS, least_words: int = LEAST_WORDS) -> np.ndarray:
    """Rows (start, length, period), by start and period, of all runs of a sequence of word numbers."""
    if repeats < 4:
        raise ValueError("a run of fewer than four periods need not hold a progression of its factors")
    n = len(numbers)
    names, successors = factors(numbers)
    at, p = proposals(successors)
    ahead, back = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for k in range(len(names) - 1, -1, -1):
        name = np.append(names[k], -1)
        x = np.minimum(at + ahead, n)
        ahead += ((name[x] >= 0) & (name[x] == name[np.minimum(x + p, n)])).astype(np.int64) << k
        x = at - back - (1 << k)
        x = np.where(x < 0, n, x)
        back += ((name[x] >= 0) & (name[x] == name[np.minimum(x + p, n)])).astype(np.int64) << k
    found = np.stack([at - back, p, back + ahead + p], axis=1)
    found = found[found[:, 2] >= np.maximum(least_words, repeats * found[:, 1])]
    return np.unique(found, axis=0)[:, [0, 2, 1]]


def _chunk(documents: list[list[bytes]], repeats: int, least_words: int) -> tuple[list[np.ndarray], list[bytes]]:
    """Runs and collapsed text of each document."""
    numbers, size = [], 0
    for words in documents:
        seen: dict[bytes, int] = {}
        numbers.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)) + size)
        size += len(words)
    start = np.cumsum([0, *map(len, documents)])
    runs = runs_of(np.concatenate(numbers), repeats, least_words)
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    dropped = np.cumsum(edge) > 0
    cut = np.searchsorted(runs[:, 0], start)
    own, collapsed = [], []
    for i, words in enumerate(documents):
        here = runs[cut[i]:cut[i + 1]] - np.array([start[i], 0, 0])
        own.append(here)
        if len(here):
            words = [words[k] for k in np.flatnonzero(~dropped[start[i]:start[i + 1]])]
        collapsed.append(b" ".join(words))
    return own, collapsed


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", repeats: int = REPEATS,
              least_words: int = LEAST_WORDS, rewrite: Rewrite | None = None) -> DataFrame:
    """(key, n_words, runs array<struct<start, length, period>>, collapsed) of every row, in word numbers from 0.

    ``runs`` are in order of start and period. ``collapsed`` are the words, joined by one space, but those that a run
    holds after its first period. ``rewrite`` may replace a row's words, given its key, before they are looked at.
    Null and empty texts have no words and no runs, whatever their length texts are read whole, repeated rows
    get equal results, invalid UTF-8 is taken as bytes, other columns are left out, and no rows give none.
    """

    def rows(batch: pa.RecordBatch) -> dict:
        ids, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
        n_words, runs, collapsed = [], [], []
        part: list[list[bytes]] = []
        held = 0
        for i, t in enumerate(texts):
            words = words_of(t)
            part.append(rewrite(ids[i], words) if rewrite else words)
            held += len(t or b"")
            if held >= CHUNK_BYTES or i == len(texts) - 1:
                found, kept = _chunk(part, repeats, least_words)
                n_words += map(len, part)
                runs += found
                collapsed += kept
                part, held = [], 0
        flat = np.concatenate([np.zeros((0, 3), np.int64), *runs])
        listed = pa.ListArray.from_arrays(
            pa.array(np.cumsum([0, *map(len, runs)]), pa.int32()),
            pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], ["start", "length", "period"]))
        return {key: batch.column(0), "n_words": n_words, "runs": listed.to_pylist(),
                "collapsed": pa.array(collapsed, pa.binary()).view(pa.string())}

    kind = docs.schema[key].dataType.simpleString()
    return arrow_map(docs.select(f"`{key}`", f"`{text}`"), rows,
                     f"`{key}` {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, "
                     "collapsed string")
