import random
import re

import numpy as np

from catalogflow.llm import odd_sketch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(pairs, least=85):
    sets = []
    for i, t in pairs:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4))} if w else set())
    big = 2**63 - 1
    ids = [big if i is None else i for i, _ in pairs]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for n, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(n)
    seen = set()
    for n, s in enumerate(sets):
        for m in {m for g in s for m in where[g] if m < n}:
            both = len(s & sets[m])
            if 100 * both >= least * (len(s) + len(sets[m]) - both):
                a, b = sorted((find(ids[n]), find(ids[m])))
                root[b] = a
    shown = lambda x: None if x == big else x
    return sorted(((shown(i), len(s), shown(find(i)), find(i) == i) for i, s in zip(ids, sets)), key=repr)


def test_groups(docs_of, rows):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    base = [rng.choice(words) for _ in range(120)]

    def changed(n, text=base):
        out = list(text)
        for p in rng.sample(range(len(out)), n):
            out[p] = "new" + str(rng.random())
        return " ".join(out)

    pairs = [(i, changed(rng.choice((0, 1, 2, 3)))) for i in range(60)]
    chain = list(base[:100])
    for i in range(100, 130):  # a chain whose ends are far apart
        chain[(i * 3) % 100] = f"c{i}"
        pairs.append((i, " ".join(chain)))
    pairs += [(200, "One two three"), (201, "one TWO three"), (202, "one two"), (203, None), (204, ""), (205, " \n"),
              (206, "a " * 30_000), (207, "A " * 400), (None, " ".join(base)), (5, pairs[5][1]), (5, pairs[5][1]),
              (300, "É x y z w"), (301, "é x y z w")]
    long = [rng.choice(words) for _ in range(3000)]  # bitmaps of these hold a share of the shingles
    pairs += [(i, changed(n, long)) for i, n in zip(range(400, 412), (0, 20, 30, 40, 45, 50, 50, 55, 60, 70, 90, 120))]
    df = docs_of(pairs)
    assert rows(odd_sketch.near_duplicates(df)) == brute(pairs)
    assert rows(odd_sketch.near_duplicates(df.limit(0))) == []


def test_documents(documents, rows):
    pairs = [(r.doc_id, r.text) for r in documents.collect()]
    assert rows(odd_sketch.near_duplicates(documents)) == brute(pairs)


def test_sketch_estimates():
    rng = np.random.default_rng(0)
    sampler = odd_sketch.Sampler()
    for share in (0.6, 0.8, 0.9, 0.97):
        errors = []
        for _ in range(30):
            both = rng.integers(0, 2**63, int(1000 * share), dtype=np.uint64)
            extra = rng.integers(0, 2**63, (2, (1000 - len(both)) // 2), dtype=np.uint64)
            a, b = (sampler(np.concatenate([both, e]))[1].view(np.uint64) for e in extra)
            errors.append(float(odd_sketch.likeness(np.bitwise_count(a ^ b).sum())) - share)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.07


def test_whole_set_bitmaps_lose_nothing():
    rng = np.random.default_rng(1)
    sampler = odd_sketch.Sampler()
    for size in (40, 700, 1024, 1025, 30_000):
        for _ in range(10):
            both = rng.integers(0, 2**63, size, dtype=np.uint64)
            cut = max(1, size // 15)
            a, b = both[cut:], both[:-cut]
            (_, _, x, i), (_, _, y, j) = sampler(a), sampler(b)
            ones, most = int(np.bitwise_count((x ^ y).view(np.uint64)).sum()), 2 * cut
            assert i != j or ones <= (most if i == 0 else most / 2**i + 6 * (most / 2**i) ** 0.5 + 6)
