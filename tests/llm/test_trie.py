"""The burst trie against a dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from catalogflow.llm import burst_trie

KIND = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuild(turns):
    own = {}
    for c, t, role, text in turns:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(rows, key=lambda x: x[:2])] for c, rows in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def brute_trie(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def below(p):
        found = [p]
        for q in found:
            found += kids.get(q, [])
        return found

    out = []
    for p, members in nodes.items():
        sub = below(p)
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in sub if q)
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids.get(p, [])),
                    sum(q not in kids for q in sub), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, turns, burst):
    df = spark.createDataFrame(turns, KIND).withColumns(
        {"path": F.lit("p"), "entry": F.lit(3), "key": F.lit(None).cast("string"), "depth": F.lit(1), "n": F.lit("n"), "some": F.lit(0)})
    return rows(burst_trie.conversation_trie(df, burst), *NAMES)


def talks(seed, convs, words=3, most=9):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "bot", None]), rng.choice(["", "é", "hello", None, "x" * 30][:words]))
            for c in range(convs) for t in range(rng.randrange(1, most))]


@pytest.mark.parametrize("burst", [1, 20])
def test_random(spark, rows, burst):
    turns = talks(burst, 150)
    assert found(spark, rows, turns, burst) == brute_trie(rebuild(turns))


def test_edges(spark, rows):
    turns = [
        (7, None, None, None), (7, None, "", ""), (7, 3, "a", "b"), (None, 1, "a", "lost"), (10, 5, "user", "x" * 200_000),
        (11, 1, "user", "é" * 9), (13, 1, "user", "short"), (13, 1, "user", "short"), (2**40 + 1, 1, "u", "t"), (9001, 2, "u", "a:b"),
        (9001, 3, "u:", "b"), (9002, 1, "us", "er"), (9003, 1, "use", "r"),
    ]
    assert found(spark, rows, turns, 1) == brute_trie(rebuild(turns))
    assert found(spark, rows, [], 5) == []
    # only turnless conversations: the root is its own leaf
    lone = [(c, 0, "u", "t") for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9]
    assert found(spark, rows, lone, 5) == brute_trie(rebuild(lone))


def test_hot_first_turns_and_long_conversations(spark, rows):
    rng = random.Random(5)
    turns = [(c, t, "user", f"same {t}" if t < 3 or c % 2 else f"own {rng.randrange(40)}") for c in range(0, 1500, 5) for t in range(7)]
    turns += [(c, t, "user", f"deep {t}" if t < 60 - c % 7 else f"end {c}") for c in range(10_000, 10_200, 5) for t in range(70)]
    assert found(spark, rows, turns, 8) == brute_trie(rebuild(turns))


def test_sorts_by_turn(spark, rows):
    turns = [(5, t, "u", f"t{t}") for t in (3, 1, 2)] + [(5, None, "u", "first")]
    assert rows(burst_trie.rebuilt(burst_trie.paths(spark.createDataFrame(turns, KIND))), "conv_id")[0] == (5,)
    assert found(spark, rows, turns, 2) == brute_trie(rebuild(turns))
