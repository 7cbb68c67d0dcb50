import random
import re

from catalogflow.llm import cover_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(pairs, window):
    """Judge every window of every document by a dictionary of all windows."""
    first = {}
    big = 2**63 - 1
    split = [(big if i is None else i, WORD.findall(t or "")) for i, t in pairs]
    for i, words in split:
        for p in range(len(words) - window + 1):
            w = tuple(words[p : p + window])
            first[w] = min(first.get(w, i), i)
    out = []
    for (i, words), (own, _) in zip(split, pairs):
        gone = set()
        for p in range(len(words) - window + 1):
            if first[tuple(words[p : p + window])] < i:
                gone.update(range(p, p + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((own, len(words), len(gone), kept))
    return sorted(out, key=repr)


def test_covers_meet_every_shift():
    for period, cover in cover_dedup.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_edges(docs_of, rows):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = text(130)
    words = base.split()
    pairs = [
        (5, base), (9, base), (9, base), (2, "\n".join(words[17:70])), (7, text(33) + "\t" + " ".join(words[40:125])),
        (None, base), (11, None), (12, ""), (13, "  \n "), (14, "a " * 400), (15, "a " * 70), (16, "b " * 49),
        (17, "b " * 49), (18, "é x " * 60), (19, "é x " * 60), (9, text(60)), (20, text(20_000)),
    ]
    pairs.append((21, " ".join(pairs[-1][1].split()[9_000:12_000])))
    df = docs_of(pairs)
    for window in (50, 12, 3):
        assert rows(cover_dedup.dedup_passages(df, window)) == brute(pairs, window)
    assert rows(cover_dedup.dedup_passages(df.limit(0))) == []


def test_documents(documents, rows):
    pairs = [(r.doc_id, r.text) for r in documents.collect()]
    assert rows(cover_dedup.dedup_passages(documents)) == brute(pairs, 50)
