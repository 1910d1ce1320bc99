"""Prefix trie against one built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tiermart.llm import conversations
from tiermart.llm.queries import op13_prefix_trie

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def in_order(rows):
    """conv_id -> turns; order of turn (null first)."""
    out = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            out[c].append((role or "", text or ""))
    return dict(out)


def brute(talks):
    members = defaultdict(list)
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = defaultdict(lambda: [0, 0, 0])  # children, leaves, saved
    for node in members:
        if node:
            below[node[:-1]][0] += 1
    for node, who in members.items():
        saved = (len(who) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            below[node[:d]][1] += not any(len(talks[c]) > len(node) for c in who)
            below[node[:d]][2] += saved
    return sorted((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), *below[node],
                   hashlib.sha256(",".join(map(str, sorted(c for c in who if len(talks[c]) == len(node)))).encode()).hexdigest())
                  for node, who in members.items())


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def talk_rows(seed, convs, most=6):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.randint(1, most)):
            rows.append((c * 3, t, r.choice(["user", "assistant", None]), r.choice(["a", "bé", None, "c c"]) if r.random() < 0.9 else "x"))
    return rows


@pytest.mark.parametrize("per_range", [3, 40, 10_000])
def test_trie_equals_brute_force_whatever_the_ranges(spark, per_range):
    r = random.Random(per_range)
    rows = talk_rows(1, 60)
    rows += [(1000 + k, t, "user", "same") for k in range(40) for t in range(3)]  # one conversation many times
    rows += [(2000 + k, 0, "user", "same") for k in range(15)]  # and its beginning
    rows += [(3000, t, "user", "deep" if t else "same") for t in range(60)]
    rows += [(3001, t, "user", "deep" if t else "same") for t in range(50)]
    rows += [(-7, None, None, None), (-7, 5, "user", "a"), (None, 1, "user", "lost")]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    got = rows_of(conversations.trie(conversations.sequences(df), per_range))
    assert got == brute(in_order(rows))


def test_conversations_without_turns_are_members_of_the_root(spark):
    df = spark.createDataFrame([(5, []), (3, []), (9, [(bytearray(b"1" * 16), 4)])], "conv_id long, parts array<struct<digest: binary, size: int>>")
    got = rows_of(conversations.trie(df))
    ends = hashlib.sha256(b"3,5").hexdigest()
    assert got == [(3, 0, None, 3, 1, 1, 0, ends), (9, 1, 3, 1, 0, 1, 0, hashlib.sha256(b"9").hexdigest())]
    only = rows_of(conversations.trie(df.where("conv_id < 9")))
    assert only == [(3, 0, None, 2, 0, 1, 0, ends)]


def test_no_conversations(spark):
    assert conversations.trie(conversations.sequences(spark.createDataFrame([], TURNS))).count() == 0


def test_role_and_text_are_told_apart_and_long_texts_are_whole(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "a", "b" * 200_000), (4, 0, "a", "b" * 200_000 + "c"), (5, 0, None, None),
            (6, 0, "", "")]
    df = spark.createDataFrame(rows, TURNS).withColumn("parts", conversations.F.lit("x")).withColumn("KEY", conversations.F.lit(1))
    assert rows_of(conversations.trie(conversations.sequences(df))) == brute(in_order(rows))


def test_repeated_rows_and_equal_turns_give_the_same_trie_each_time(spark):
    rows = [(c, 1, "user", t) for c in (1, 2, 3) for t in ("x", "y", "x")]
    df = spark.createDataFrame(rows, TURNS)
    one, two = (rows_of(conversations.trie(conversations.sequences(d))) for d in (df, df.orderBy("text").repartition(3)))
    assert one == two and [r[3] for r in one] == [3] * 4


def test_the_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    own = in_order(rows)
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    assert rows_of(op13_prefix_trie(spark, folder)) == brute(rebuilt)
