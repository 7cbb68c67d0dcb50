"""The cuckoo-filter index against plain dictionaries."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from catalogflow.llm import cuckoo_dedup as cd

BLANK = {ord(c): None for c in " \t\n\x0b\x0c\r"}


def plain(text):
    return (text or "").translate(BLANK)


def brute(pairs):
    groups = {}
    for k, (i, t) in enumerate(pairs):
        groups.setdefault(plain(t), []).append((-len(t or ""), i is None, i or 0, k))
    out = []
    for k, (i, t) in enumerate(pairs):
        mine = groups[plain(t)]
        best = min(mine)
        digest = hashlib.sha256(plain(t).encode()).digest()
        out.append((i, None if best[1] else best[2], len(mine), best[3] == k, digest))
    return sorted(out, key=repr)


PAIRS = [
    (5, "a b"), (3, "ab"), (9, " a\tb\r\n"), (4, " a b "), (None, "a \x0b\x0c b  "), (1, None), (2, ""), (6, " \n"), (None, None),
    (7, "x y"), (8, "xy"), (10, "é" * 3), (11, "é" * 3), (12, "long " * 200_000), (13, "long" * 200_000), (14, "same"),
    (14, "same"), (14, "other"), (None, "n"), (None, "n"),
]


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest)) for r in df.collect()), key=repr)


def test_groups(docs_of):
    docs = docs_of(PAIRS).withColumns({"digest": F.lit("d"), "shard": F.lit(None).cast("int"), "copy": F.lit("c"), "size": F.lit(2)})
    assert got(cd.deduplicate(docs)) == brute(PAIRS)
    # few bits: nearly every probe is a false hit as well; tiny shards
    assert got(cd.deduplicate(docs, shard=4, bits=2)) == brute(PAIRS)


def test_hot_group_and_empty(docs_of, spark):
    pairs = [(i, "copy" if i % 3 == 0 else f"text {i}") for i in range(4000)]
    assert got(cd.deduplicate(docs_of(pairs), shard=256)) == brute(pairs)
    assert got(cd.deduplicate(docs_of([]))) == []


def test_other_columns(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a ")], "k int, body string")
    assert [r.keep_id for r in cd.deduplicate(docs, "k", "body").collect()] == [2, 2]


@pytest.mark.parametrize("bits", [4])
def test_insert_and_delete(spark, docs_of, bits):
    rng = random.Random(1)
    first = [(i, f"text {rng.randrange(150)}") for i in range(200)]
    index = cd.build(docs_of(first), shard=64, bits=bits)
    live = list(first)
    before = {r.shard: r.buckets for r in index.filters.collect()}
    for step in range(2):
        more = [(1000 * (step + 1) + i, f"text {rng.randrange(150 + 200 * step)}") for i in range(120)]
        gone = rng.sample(live, 60) + [(-1, "never there"), (live[0][0], "another text"), (None, None)]
        # large limit: shards grow by overflow instead of being dealt anew
        index = cd.insert(index, docs_of(more), shard=10_000, bits=bits)
        live += more
        index = cd.delete(index, docs_of(gone), bits=bits)
        live = [x for x in live if x not in set(gone)]
        assert index.rows == len(live) == index.keys.count()
        found = {bytes(r.digest): (r.keep_id, r.group_size) for r in cd.stored(index).collect()}
        want = {r[4]: (r[1], r[2]) for r in brute(live)}
        assert found == want
        # the filters hold one fingerprint for each live digest, and no live digest is missed
        held = index.filters.collect()
        assert sum(r.live for r in held) == len(want)
        assert sum(sum(x != 0 for x in memoryview(bytes(r.slots)).cast("H")) for r in held) == len(want)
        asked = docs_of(live[:50] + [(7, "unknown text"), (8, "")])
        rows = cd.signed(asked)
        assert {bytes(r.digest) for r in cd.lookup(index, rows, bits).collect()} == {
            hashlib.sha256(plain(t).encode()).digest() for _, t in live[:50]}
    assert any(r.buckets > before.get(r.shard, 0) for r in held)  # some overflowed


def test_dealt_anew(docs_of):
    index = cd.build(docs_of([(1, "a")]), shard=2)
    index = cd.insert(index, docs_of([(i, f"t{i}") for i in range(40)]), shard=2)
    assert index.shards > 8 and cd.stored(index).count() == 41


def test_false_hits_are_rare():
    rng = random.Random(2)
    keys = [rng.randbytes(32) for _ in range(5000)]
    made = cd.built(keys)
    assert made.holds(keys).all() and made.holds([rng.randbytes(32) for _ in range(20000)]).mean() < 0.002
    made.delete(keys[:2500])
    assert made.holds(keys[2500:]).all() and made.holds(keys[:2500]).mean() < 0.002
    small = cd.Filter(2)
    assert not small.insert(keys[:9])  # more than its slots: overflow
