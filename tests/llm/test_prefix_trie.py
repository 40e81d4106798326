"""The prefix trie against one built in a dictionary."""

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from weirline.llm import prefix_trie
from weirline.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def key(turn):
    _, number, role, text = turn
    role, text = role or "", text or ""
    return number is not None, number or 0, role, sha(f"{len(role.encode())}:{role}{text}")


def conversations(rows):
    out = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], *key(r))):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def rebuilt(rows):
    whole, out = conversations(rows), {}
    for c, turns in whole.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = whole.get(base, [])[:h] + turns[h:]
    return out


def slow(paths):
    members, below = {}, {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
            if d:
                below.setdefault(tuple(turns[: d - 1]), set()).add(tuple(turns[:d]))

    memo = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        kids = below.get(node, ())
        memo[node] = (saved + sum(memo[k][0] for k in kids), sum(memo[k][1] for k in kids) or 1)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(below.get(node, ())), memo[node][1], memo[node][0], sha(ends)))
    return sorted(out, key=repr)


def got(frame):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, frame.select(*names).collect()), key=repr)


def plain(spark, rows, parts=3):
    return got(prefix_trie.trie(prefix_trie.paths_of(prefix_trie.ordered_turns(spark.createDataFrame(rows, SCHEMA).repartition(parts)))))


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op12_prefix_trie"](spark, sf)) == slow(rebuilt(rows))


def test_rebuilding_short_absent_negative_and_turnless(spark):
    # Bases of every length, also none; ids on both sides of zero; short conversations may end up without a turn.
    rows = [(c, t, "user", f"c{c if t > 1 else c // 7} t{t}") for c in range(-45, 130) for t in range(c % 5) if c not in (20, 60)]
    out = prefix_trie.trie(prefix_trie.rebuilt_paths(prefix_trie.ordered_turns(spark.createDataFrame(rows, SCHEMA)), F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4))
    paths = rebuilt(rows)
    assert any(not p for p in paths.values()) and got(out) == slow(paths)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 0, "a", "tie"), (1, 0, "a", "tie"), (1, 0, "b", "tie"), (2, None, "user", "first"), (2, 0, "", ""),
        (3, 0, "user", "word " * 30_000), (4, 5, "user", "word " * 30_000), (None, 0, "user", "nobody"), (5, None, None, None), (6, 1, "us", "er first"), (-7, 0, "user", "first"),
    ]
    assert plain(spark, rows) == slow(conversations(rows))


def test_equal_conversations_end_together(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(c, t, "user", f"turn {t} of words") for c in range(200) for t in range(3)] + [(c, t, "user", f"turn {t} of words" if t < 2 else f"{c}") for c in range(200, 230) for t in range(4)]
    assert plain(spark, rows, 5) == slow(conversations(rows))


def test_one_long_conversation_over_many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        rows = [(1, t, "user", f"t{t}") for t in range(900)] + [(c, t, "user", f"t{t}") for c in range(2, 8) for t in range(c)]
        assert plain(spark, rows, 6) == slow(conversations(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("names", [["node", "w", "owner", "length", "idx"]])
def test_empty_table_and_clashing_columns(spark, names):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(prefix_trie.rebuilt_paths(prefix_trie.ordered_turns(empty), F.lit(1))).collect() == []
    rows = [(1, 0, "user", "a b"), (2, 0, "user", "a b")]
    clashing = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in names})
    assert got(prefix_trie.trie(prefix_trie.paths_of(prefix_trie.ordered_turns(clashing)))) == slow(conversations(rows))
