"""Greedy word-piece counts by a linear longest-match automaton.

A word is a run of non-white-space. Its first piece is the longest vocabulary
entry that starts it (``first`` entries), every further piece the longest
``inner`` entry that starts the rest. With byte fallback, a character that no
entry matches is spelled as the pieces of its UTF-8 bytes, and a word that no ``first`` entry
starts has the bare word mark as its first piece, so every word has a segmentation. Without it,
a word with a character that cannot be matched is one unknown piece.

The automaton is a trie of the entries, the inner ones under a root of their
own. Each trie node has a failure link (the node that matching is in after the
node's string gave off as many greedy pieces as it must) and the number of
pieces given off on that way, computed once. A word is then counted in one pass
over its characters without ever building a piece.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from tiermart.llm.common import arrow_map, utf8

NO_LINK = -1
# Distinct words a Python worker remembers; a full memory is emptied, never trusted to be complete.
MEMORY = 200_000


class PieceCounter:
    """Longest-match automaton over two sets of pieces."""

    def __init__(self, first: Iterable[str], inner: Iterable[str], byte_fallback: bool = False):
        self.byte_fallback = byte_fallback
        # node 0: start of a word; node 1: after at least one piece
        self.goto: list[dict[str, int]] = [{}, {}]
        self.cost: list[int] = [0, 0]  # pieces that a node's string is as an entry, 0 if it is none
        for root, entries in ((0, first), (1, inner)):
            for entry in entries:
                node = root
                for ch in entry:
                    node = self.goto[node].setdefault(ch, len(self.goto))
                    if node == len(self.goto):
                        self.goto.append({})
                        self.cost.append(0)
                if entry:
                    self.cost[node] = 1
        if byte_fallback:
            for ch in {ch for edges in self.goto for ch in edges}:
                node = self.goto[1].setdefault(ch, len(self.goto))
                if node == len(self.goto):
                    self.goto.append({})
                    self.cost.append(0)
                self.cost[node] = self.cost[node] or len(ch.encode())
        self.link = [NO_LINK] * len(self.goto)
        self.pops = [0] * len(self.goto)
        if byte_fallback:
            self.link[0], self.pops[0] = 1, 1  # the bare word mark
        queue = deque([0, 1])
        while queue:
            parent = queue.popleft()
            for ch, node in self.goto[parent].items():
                if self.cost[node]:
                    self.link[node], self.pops[node] = 1, self.cost[node]  # the string is an entry; nothing is pending
                else:
                    at, popped = self.link[parent], self.pops[parent]
                    while at != NO_LINK and ch not in self.goto[at]:
                        popped += self.pops[at]
                        at = self.link[at]
                    if at != NO_LINK:
                        self.link[node], self.pops[node] = self.goto[at][ch], popped
                queue.append(node)

    def count(self, word: str) -> int:
        """Pieces of one word; 0 if it is empty, 1 (unknown) if it has no segmentation, which byte fallback rules out."""
        if not word:
            return 0
        goto, link, pops = self.goto, self.link, self.pops
        node = total = 0
        for ch in word:
            after = goto[node].get(ch)
            while after is None:
                total += pops[node]
                node = link[node]
                if node == NO_LINK:
                    if not self.byte_fallback:
                        return 1
                    total += len(ch.encode())  # in no entry at all
                    after = 1
                else:
                    after = goto[node].get(ch)
            node = after
        while node != 1:  # the word is over: what is pending must come out as whole pieces
            total += pops[node]
            node = link[node]
            if node == NO_LINK:
                return 1
        return total


def sentencepiece_entries(path: str) -> tuple[list[str], list[str]]:
    """(first, inner) entries of a SentencePiece model: word-initial pieces without their mark, and the others."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    first, inner = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        if piece.startswith("▁"):
            if piece.strip("▁"):
                first.append(piece[1:])
        else:
            inner.append(piece)
    return first, inner


def has_byte_pieces(path: str) -> bool:
    """Whether a SentencePiece model spells unknown characters by bytes: it has all 256 of them and the bare word mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return (sum(model.is_byte(i) for i in range(model.get_piece_size())) == 256
            and model.piece_to_id("▁") != model.unk_id())


def count_tokens(docs: DataFrame, first: list[str], inner: list[str], key: str = "doc_id",
                 text: str = "text", byte_fallback: bool = False) -> DataFrame:
    """(key, n_words, n_tokens) for every row.

    The vocabulary is broadcast; its size is the tokenizer's, whatever the
    corpus. Null and empty texts have no words and no tokens. Invalid UTF-8 counts as U+FFFD. Words are split at
    ASCII white space; without ``byte_fallback``, an unknown word counts as one token.
    """
    # A worker process keeps a broadcast value between tasks, and with it what is built on it here.
    shared = docs.sparkSession.sparkContext.broadcast((first, inner, {}))

    def rows(batch: pa.RecordBatch) -> dict:
        *entries, built = shared.value
        if not built:
            built["counter"], built["known"] = PieceCounter(*entries, byte_fallback), {}
        counter, known = built["counter"], built["known"]
        words, tokens = [], []
        for t in utf8(batch.column(1)):
            parts = (t or b"").split()
            if len(known) > MEMORY:
                known.clear()
            n = 0
            for w in parts:
                c = known.get(w)
                if c is None:
                    c = known[w] = counter.count(w.decode("utf-8", "replace"))
                n += c
            words.append(len(parts))
            tokens.append(n)
        return {key: batch.column(0), "n_words": words, "n_tokens": tokens}

    kind = docs.schema[key].dataType.simpleString()
    return arrow_map(docs.select(key, text), rows, f"`{key}` {kind}, n_words long, n_tokens long")
