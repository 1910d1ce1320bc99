"""Benchmark decontamination: rare seeds join passages to items, then Smith-Waterman alignment scores them.

Texts are words (runs of letters, digits and underscore, lower-cased); of scripts that are written without spaces
between words every character is a unit. The alignment is local: match 2, mismatch -1, gap -1. The score
is the best alignment's share of the item's best possible one; a copy with one
word in five replaced has 0.7, an exact copy 1. Part of a long item is also a copy: an alignment
worth ``LEAST_WORDS`` matched words counts whatever its share. Of short items (under 8 words) nearly all must be there.

Seeds are an item's rare n-grams, several of which must meet, and they lose no copy, whatever was replaced, put in or left
out. An alignment worth p points matches M of the item's m words with at most 2M - p edits, so M is at least p / 2, and at
least M - 1 - (2M - p), that is p - m - 1, pairs of adjacent words are adjacent in both. Where that bound B is three or
more, pairs are the seeds, otherwise single words with the bound p / 2. Of n seeds the n - B + t rarest ones will do, of which the copy has t,
in places of the text that lie no further apart than the alignment is
long, which is m and the edits that the score allows. A document is joined to an item where t of its rare seeds stand so close; rare is
what few items hold. How often a seed occurs in the corpus does not matter: none is dropped as too
common, as an edited copy may itself be repeated any number of times. Items of more than ``PIECE`` words
are seeded by overlapping pieces, of one of which a copy must have ``PIECE_PAIRS`` pairs: evenly edited copies of score 0.6 have
7 of some piece, and 25 adjacent words lie whole in one. Only a copy of a long item whose matches lie thinner than
that everywhere can be missed (recall is measured in the tests).

A place is aligned only if it holds so many of the item's words, in any order, that the score can be reached.

One pass over the corpus finds all copies of ``BLOCK_WORDS`` words of benchmark; the items go out as one broadcast
of so many words at most, and the corpus is never shuffled. A larger benchmark takes a pass for each block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.llm.common import arrow_map, strings

BLOCK_WORDS = 4_000_000
LEAST_SCORE = 0.6
LEAST_WORDS = 25
LEAST_ITEM = 3  # words; shorter items match nothing
SHORT_ITEM = 5  # matched words that any copy has, but for one edit
SEEDS = 5  # t: rare seeds that must meet, at most
PIECE, STEP, PIECE_PAIRS = 40, 10, 4  # pieces of long items, and the pairs that a copy has of one
MATCH, MISMATCH, GAP = 2, -1, -1
_WORD = re.compile(r"\w+")
# Scripts without spaces between words: Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han.
_UNSPACED = ("\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
             "\uf900-\ufaff\U00020000-\U0003ffff")
_ANY_UNSPACED = re.compile(f"[{_UNSPACED}]")
_UNIT = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+")


def words_of(text: str | None) -> list[str]:
    """Words, lower-cased; characters where the script has no spaces."""
    if not text:
        return []
    return (_UNIT if not text.isascii() and _ANY_UNSPACED.search(text) else _WORD).findall(text.lower())


@dataclass
class Index:
    """Which items have a word or pair as a seed: entries ``first[n]`` to ``first[n + 1]`` of ``holder`` for number n."""

    first: np.ndarray
    holder: np.ndarray

    @staticmethod
    def of(seeds: list[tuple[int, np.ndarray]], size: int) -> Index:
        """From (item, its seeds' numbers); numbers are below ``size``."""
        pairs = [np.stack([np.unique(n), np.full(len(np.unique(n)), i)]) for i, n in seeds]
        number, holder = np.concatenate([np.zeros((2, 0), np.int64), *pairs], axis=1)
        order = np.argsort(number, kind="stable")
        return Index(np.searchsorted(number[order], np.arange(size + 1)), holder[order])

    def meetings(self, numbers: np.ndarray, meet: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, first, last): where as many of an item's seeds as must meet stand close enough in a text; 0 is no seed."""
        count = self.first[numbers + 1] - self.first[numbers]
        count[numbers == 0] = 0
        at = np.flatnonzero(count)
        count = count[at]
        skip = np.repeat(self.first[numbers[at]] - np.cumsum(count) + count, count)
        item = self.holder[skip + np.arange(len(skip))]
        order = np.argsort(item, kind="stable")  # by item, then by place
        item, place = item[order], np.repeat(at, count)[order]
        last = np.arange(len(item)) + meet[item] - 1
        begin = np.flatnonzero(last < len(item))
        last = last[begin]
        near = (item[last] == item[begin]) & (place[last] - place[begin] < reach[item[begin]])
        return item[begin][near], place[begin][near], place[last][near]


@dataclass
class Block:
    """A block of items, ready to be looked up. Words are numbers from 1; a text's unknown words are 0."""

    items: list[int]
    words: list[np.ndarray]
    vocabulary: dict[str, int]
    bags: list[tuple[np.ndarray, np.ndarray]]  # an item's distinct words in ascending order, and how often it has each
    least: np.ndarray  # score that counts, by item
    meet: np.ndarray  # how many seeds must meet, by item
    reach: np.ndarray  # how many words of text an alignment may span
    by_word: Index
    by_pair: Index
    pair_keys: np.ndarray  # ascending; a pair's number is its place here, from 1

    def plain(self) -> dict:
        """As built-in types and arrays: executors have no copy of these classes to unpickle."""
        return vars(self) | {"by_word": vars(self.by_word), "by_pair": vars(self.by_pair)}

    @staticmethod
    def of(plain: dict) -> Block:
        return Block(**plain | {"by_word": Index(**plain["by_word"]), "by_pair": Index(**plain["by_pair"])})

    def pairs(self, numbers: np.ndarray) -> np.ndarray:
        """Numbers of the adjacent pairs of a text's word numbers; 0: no pair of any item's."""
        key = numbers[:-1] * (len(self.vocabulary) + 1) + numbers[1:]
        if not len(key) or not len(self.pair_keys):
            return np.zeros(len(key), np.int64)
        n = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[n] == key) & (numbers[:-1] > 0) & (numbers[1:] > 0), n + 1, 0)


def least_share(m: int, least_score: float, least_words: float) -> float:
    """The score from which an item of m words counts as copied."""
    return max(min(least_score, least_words / m), (MATCH * min(m, SHORT_ITEM) - 1) / (MATCH * m))


def _rarest(numbers: np.ndarray, rank: np.ndarray, bound: int) -> tuple[np.ndarray, int]:
    """(seeds, how many must meet) where a copy has at least ``bound`` of ``numbers``."""
    meet = max(1, min(SEEDS, bound))
    return numbers[np.argsort(rank[numbers], kind="stable")[:len(numbers) - bound + meet]], meet


def _ranks(bags: list[np.ndarray], size: np.ndarray) -> np.ndarray:
    """Rank of each number: in few bags first, of those the longer ones."""
    held = np.bincount(np.concatenate([*map(np.unique, bags), np.zeros(0, np.int64)]), minlength=len(size))
    rank = np.empty(len(size), np.int64)
    rank[np.lexsort((-size, held))] = np.arange(len(size))
    return rank


def make_block(items: list[tuple[int, str]], least_score: float = LEAST_SCORE, least_words: float = LEAST_WORDS) -> Block:
    """Index of the items' seeds."""
    vocabulary: dict[str, int] = {}
    words = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(t)], dtype=np.int64)
             for _, t in items]
    keys = np.unique(np.concatenate([w[:-1] * (len(vocabulary) + 1) + w[1:] for w in words] + [np.zeros(0, np.int64)]))
    no_index = Index(np.zeros(1, np.int64), np.zeros(0, np.int64))
    block = Block([i for i, _ in items], words, vocabulary, [np.unique(w, return_counts=True) for w in words],
                  np.ones(len(items)), np.ones(len(items), np.int64), np.zeros(len(items), np.int64), no_index, no_index, keys)
    pairs = [block.pairs(w) for w in words]
    size = np.array([0] + [len(w) for w in vocabulary])
    first, second = np.divmod(np.concatenate(([0], keys)), len(vocabulary) + 1)
    word_rank, pair_rank = _ranks(words, size), _ranks(pairs, size[first] + size[second])
    word_seeds, pair_seeds = [], []
    for i, w in enumerate(words):
        m = len(w)
        if m < LEAST_ITEM:
            continue
        block.least[i] = least_share(m, least_score, least_words)
        points = block.least[i] * MATCH * m
        block.reach[i] = m + np.ceil(MATCH * m - points)
        bound = int(np.ceil(points - m - 1 - 1e-9))
        if m > PIECE:
            block.reach[i] = 2 * PIECE
            for a in [*range(0, m - PIECE, STEP), m - PIECE]:
                seeds, block.meet[i] = _rarest(pairs[i][a:a + PIECE - 1], pair_rank, PIECE_PAIRS)
                pair_seeds.append((i, seeds))
        elif bound >= 3:
            seeds, block.meet[i] = _rarest(pairs[i], pair_rank, bound)
            pair_seeds.append((i, seeds))
        else:
            seeds, block.meet[i] = _rarest(w, word_rank, min(m, int(np.ceil(points / MATCH - 1e-9))))
            word_seeds.append((i, seeds))
    joined: dict[int, list[np.ndarray]] = {}
    for i, seeds in pair_seeds:  # an item's pieces share most of theirs
        joined.setdefault(i, []).append(seeds)
    block.by_word = Index.of(word_seeds, len(size))
    block.by_pair = Index.of([(i, np.concatenate(x)) for i, x in joined.items()], len(keys) + 1)
    return block


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int]:
    """Smith-Waterman: (best local score as a share of the item's best possible, end of it in the text)."""
    if not len(item) or not len(text):
        return 0.0, 0
    ramp = -GAP * np.arange(len(text) + 1)
    above = np.zeros(len(text) + 1)
    best, end = 0.0, 0
    for w in item:
        row = np.maximum(above + GAP, 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(text == w, MATCH, MISMATCH))
        row = np.maximum.accumulate(row + ramp) - ramp  # gaps along the text: each column costs one more
        top = int(row.argmax())
        if row[top] > best:
            best, end = float(row[top]), top
        above = row
    return best / (MATCH * len(item)), end


def shared_words(bag: tuple[np.ndarray, np.ndarray], text: np.ndarray) -> int:
    """How many of an item's words a text holds in any order; no alignment matches more."""
    words, counts = bag
    n = np.minimum(np.searchsorted(words, text), len(words) - 1)
    return int(np.minimum(np.bincount(n[words[n] == text], minlength=len(words)), counts).sum())


def contamination(text: str | None, block: Block) -> dict[int, tuple[float, int]]:
    """Best (score, end word) by item number, over all places of the text where seeds of the item meet.

    Only of items whose best alignment reaches the item's least score.
    """
    get = block.vocabulary.get
    numbers = np.array([get(w, 0) for w in words_of(text)], dtype=np.int64)
    found: dict[int, tuple[float, int]] = {}
    places: list[list[int]] = []  # item, begin, end; those of an item that overlap are one
    for index, seen in ((block.by_word, numbers), (block.by_pair, block.pairs(numbers))):
        for i, begin, last in zip(*(x.tolist() for x in index.meetings(seen, block.meet, block.reach))):
            # The alignment holds both, so it begins and ends no further away than it is long; a piece's, than the item's is.
            reach = int(block.reach[i]) if len(block.words[i]) <= PIECE else MATCH * len(block.words[i])
            a, b = max(0, last + 1 - reach), begin + 1 + reach
            if places and places[-1][0] == i and a <= places[-1][2]:
                places[-1][2] = max(b, places[-1][2])
            else:
                places.append([i, a, b])
    for i, a, b in places:
        place, least = numbers[a:b], block.least[i]
        if shared_words(block.bags[i], place) / len(block.words[i]) < least:
            continue
        score, end = align(block.words[i], place)
        if score >= least - 1e-9 and score > found.get(i, (0.0, 0))[0]:
            found[i] = (score, a + end)
    return found


def blocks(benchmark: DataFrame, docs: DataFrame, item: str = "item_id", item_text: str = "text", text: str = "text",
           block_words: int = BLOCK_WORDS, *, least_score: float = LEAST_SCORE,
           least_words: float = LEAST_WORDS) -> Iterator[Block]:
    """The benchmark's items in blocks."""
    items = benchmark.select(F.col(f"`{item}`").alias("item"), F.col(f"`{item_text}`").alias("text")).where(
        "item is not null and text is not null").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // (5 * block_words)))
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).toArrow()
        rows = sorted(zip(part.column("item").to_pylist(), strings(part.column("text").combine_chunks())))
        if rows:
            yield make_block(rows, least_score, least_words)


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
         item_text: str = "text", least_score: float = LEAST_SCORE, least_words: float = LEAST_WORDS) -> DataFrame:
    """(key, item, score, end_word): every document and item whose best alignment has ``least_score`` or ``least_words``.

    Null and empty texts, and items of fewer than ``LEAST_ITEM`` words, match nothing. Items that repeat
    an id are items of their own, the best counts. Repeated rows each get their rows;
    an empty table on either side gives none.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, `{item}` {benchmark.schema[item].dataType.simpleString()}, score double, end_word long"
    parts = []
    for block in blocks(benchmark, docs, item, item_text, text, least_score=least_score, least_words=least_words):
        shared = docs.sparkSession.sparkContext.broadcast(block.plain())

        def rows(batch: pa.RecordBatch, shared=shared) -> dict:
            block, ids = Block.of(shared.value), batch.column(0).to_pylist()
            out: dict = {key: [], item: [], "score": [], "end_word": []}
            for d, t in zip(ids, strings(batch.column(1))):
                best: dict = {}
                for i, (score, end) in contamination(t, block).items():
                    if score > best.get(block.items[i], (0.0, 0))[0]:
                        best[block.items[i]] = (score, end)
                for i, (score, end) in sorted(best.items()):
                    for c, v in zip(out.values(), (d, i, score, end)):
                        c.append(v)
            return out

        parts.append(arrow_map(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")), rows, schema))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
          least_score: float = LEAST_SCORE, least_words: float = LEAST_WORDS) -> DataFrame:
    """``docs`` without the rows that hold a copy of an item; the rest is as it was. Nothing is shuffled."""
    kept, names = docs, docs.columns
    at = names.index(text)
    for block in blocks(benchmark, docs, item, item_text, text, least_score=least_score, least_words=least_words):
        shared = docs.sparkSession.sparkContext.broadcast(block.plain())

        def rows(batch: pa.RecordBatch, shared=shared) -> dict:
            block = Block.of(shared.value)
            mask = [not contamination(t, block) for t in strings(batch.column(at))]
            left = batch.filter(pa.array(mask, pa.bool_()))
            return dict(zip(names, left.columns))

        kept = arrow_map(kept, rows, docs.schema)
    return kept
