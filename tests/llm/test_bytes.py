import random

import numpy as np
import pyarrow as pa
import pytest

from catalogflow.llm import bwt_dedup


def brute(pairs, least):
    big, first, out = 2**63 - 1, {}, []
    rows = [(big if i is None else i, (t or "").encode()) for i, t in pairs]
    for i, b in rows:
        for p in range(len(b) - least + 1):
            s = b[p : p + least]
            if first.get(s, big + 1) > i:
                first[s] = i
    for (i, b), (own, _) in zip(rows, pairs):
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - least + 1):
            if first[b[p : p + least]] < i:
                gone[p : p + least] = True
        runs = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        out.append((own, len(b), int(gone.sum()), runs, bytearray(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("heat", [5000, 1])
def test_edges(docs_of, rows, heat):
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    base = text(400)
    pairs = [(5, base), (9, base), (9, base), (2, base[30:120]), (7, text(20) + base[100:300] + text(20)), (None, base), (11, None),
             (12, ""), (13, "a" * 500), (14, "a" * 60), (15, "ab" * 300), (16, "ab" * 40 + "c"), (17, base[:49]), (18, base[:50]),
             (9, text(80)), (20, text(5_000)), (3, "\0" * 70), (4, "\0" * 90), (22, "x" + "\0" * 55 + "y")]
    pairs += [(21, pairs[-4][1][1000:4000]), *[(30 + i, text(30) + base[200:260] + text(30)) for i in range(8)]]
    df = docs_of(pairs)
    for least, gram in ((50, 20), (12, 8)):
        assert rows(bwt_dedup.dedup_bytes(df, least, gram, heat)) == brute(pairs, least)
    assert rows(bwt_dedup.dedup_bytes(df.limit(0))) == []


def test_frequent_keys_meet_across_batches(docs_of, rows):
    """Some batches hold a frequent string once, others several times."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    base = text(120)
    pairs = [(i, text(40) + base[i : i + 90] + text(40)) for i in range(1, 13)]
    for parts in (12, 5, 1):
        for heat in (1, 4, 5000):
            got = rows(bwt_dedup.dedup_bytes(docs_of(pairs).repartitionByRange(parts, "doc_id"), heat=heat))
            assert got == brute(pairs, 50)


def test_documents(documents, rows):
    pairs = [(r.doc_id, r.text) for r in documents.collect()]
    assert rows(bwt_dedup.dedup_bytes(documents)) == brute(pairs, 50)


def test_intervals_are_all_repeats():
    rng = random.Random(4)
    segments = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(9, 60))) for _ in range(40)]
    order, low, high = bwt_dedup.repeated(segments, 9)
    text = b"|".join(segments)
    at = np.cumsum([0] + [len(s) + 1 for s in segments])
    found = {}
    for n, s in enumerate(segments):
        for p in range(len(s) - 8):
            found.setdefault(s[p : p + 9], set()).add(int(at[n]) + p)
    assert len(text) and sorted(sorted(v) for v in found.values() if len(v) > 1) == sorted(
        sorted(order[a:b].tolist()) for a, b in zip(low, high))


def test_segments_travel_in_small_packs():
    """Packs take under 0.75 of the bytes of the plain columns (random letters: prose takes less), and all comes back."""
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randrange(3, 9))) for _ in range(800)]
    ids, texts = [-5, 3, 2**40, 2**63 - 1], [" ".join(rng.choice(words) for _ in range(30_000)).encode() for _ in range(4)]
    doc, first, last, key = bwt_dedup._runs(texts, 50, 16)
    rows = [(k, ids[d], 7 + d, p, texts[d][p : z + 50]) for d, p, z, k in zip(*(x.tolist() for x in (doc, first, last, key)))]
    rows.append((rows[0][0], 2**63 - 1, 9, 11, rows[0][4]))  # the smallest id of the batch holds it too
    dealt = bwt_dedup._dealt(rows)
    packs = bwt_dedup._packed(*dealt)
    assert packs.nbytes < 0.75 * bwt_dedup.arrow(bwt_dedup.SENT_ARROW, *dealt).nbytes
    got = [r for b in bwt_dedup._unpacked([packs]) for r in b.to_pylist()]
    sure = [r for r in got if r["known"]]
    assert [(r["_id"], r["_row"], r["start"], len(r["seg"])) for r in sure] == [(2**63 - 1, 9, 11, 8)]
    assert sorted((r["key"], r["_id"], r["_row"], r["start"], r["seg"]) for r in got if not r["known"]) == sorted(rows[:-1])


def test_keys_are_crowded_as_a_whole():
    """Whatever the batches, the rows of one key are all crowded or none."""
    rng = random.Random(3)
    for _ in range(500):
        keys = sorted(rng.randrange(6) for _ in range(rng.randrange(40)))
        cuts = [0, *sorted(rng.randrange(len(keys) + 1) for _ in range(rng.randrange(6))), len(keys)]
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[a:z], pa.int64()), pa.array(range(a, z), pa.int64())], names=["key", "n"])
                   for a, z in zip(cuts, cuts[1:])]
        heat = rng.choice([1, 3, 8, np.inf])
        got = [(n, crowded) for crowded, b in bwt_dedup._split(batches, heat) for n in b.column("n").to_pylist()]
        assert got == [(n, keys.count(k) > heat) for n, k in enumerate(keys)]


@pytest.mark.parametrize("letters", [b"a", b"ab", bytes(range(256))])
def test_holders_of_any_alphabet(letters):
    """Suffixes are sorted by as many bytes at once as fit; the result does not depend on it."""
    rng = random.Random(5)
    base = bytes(rng.choice(letters) for _ in range(300))
    segments = sorted({base[a : a + rng.randrange(50, 120)] for a in (rng.randrange(180) for _ in range(60))})
    owners = np.array([rng.randrange(1000) for _ in segments])
    holder, at, best = bwt_dedup.first_holders(segments, owners, 50), 0, {}
    for s, o in zip(segments, owners.tolist()):
        for p in range(len(s) - 49):
            best[s[p : p + 50]] = min(best.get(s[p : p + 50], o), o)
    for s in segments:
        assert holder[at : at + len(s) - 49].tolist() == [best[s[p : p + 50]] for p in range(len(s) - 49)]
        at += len(s) + 1
