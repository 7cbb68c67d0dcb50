"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalogflow.llm import spelling

NAMES = ["word", "form", "root", "n", "n_near", "form_n"]
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(pairs, least=7):
    n = Counter()
    for i, t in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                n[run] += 1
    words = {w: c for w, c in n.items() if c >= 2}
    close = {w: sorted((v for v in words if near(w, v)), key=lambda v: (-words[v], v)) for w in words}
    form = {w: c[0] if c and words[c[0]] >= 10 * words[w] else None for w, c in close.items()}
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(close[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def typo(rng, word):
    i, kind = rng.randrange(len(word)), rng.randrange(3)
    letter = rng.choice("abcdeéÿ")
    return word[:i] + ["", letter, letter + word[i]][kind] + word[i + 1 :]


def test_planted_typos(docs_of, rows):
    rng = random.Random(3)
    base = ["".join(rng.choice("aabcdeééthn") for _ in range(rng.randrange(7, 13))) for _ in range(40)]
    pairs = []
    for i in range(60):
        words = [rng.choice(base) for _ in range(60)]
        words += [typo(rng, w) for w in words[:6]] + [typo(rng, typo(rng, w)) for w in words[6:9]]
        pairs.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
    want = brute(pairs)
    assert sum(r[1] is not None for r in want) > 20
    for parts in (3, 4):
        assert rows(spelling.variants(docs_of(pairs), parts=parts), *NAMES) == want


def test_chain_of_forms(docs_of, rows):
    pairs = [(1, " ".join(["abcdefgh"] * 2 + ["abcdefgx"] * 20 + ["abcdefyx"] * 200 + ["abcdezyx"] * 2000))]
    got = rows(spelling.variants(docs_of(pairs)), *NAMES)
    assert got == brute(pairs)
    assert {r[0]: r[2] for r in got}["abcdefgh"] == "abcdezyx"


def test_edges(docs_of, spark, rows):
    long = "q" * 30_000
    pairs = [
        (None, "Étudiant étudiant ÉTUDIANT"), (None, None), (1, ""), (1, None), (2, "étudiant étudiants"), (2, "étudiant étudiants"),
        (3, "short words only"), (4, f"{long} {long}x {long} {long}x"), (5, "x×÷ÿÀ-abcdefg ABCDEFG abcdefg1abcdefg"),
        (6, "straße straßen strassen straßen strassen"), (7, "aaaaaaa aaaaaaaa aaaaaaa aaaaaaaa aaaaaaaaa aaaaaaaaa"),
    ]
    docs = docs_of(pairs).withColumns({"word": F.lit("w"), "n": F.lit(1), "sig": F.lit(2), "form": F.lit("f"), "m": F.lit(0)})
    assert rows(spelling.variants(docs), *NAMES) == brute(pairs)
    assert rows(spelling.variants(docs_of([])), *NAMES) == []
    one = [(3, "nothing to see")]
    assert rows(spelling.variants(docs_of(one)), *NAMES) == []


def test_pieces_cut_between_runs(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh  ") for _ in range(9000))
    outside = re.compile(f"[^{spelling.LETTERS}]")
    monkeypatch.setattr(spelling, "PIECE", 50)
    parts = list(spelling._pieces(text, outside))
    assert "".join(parts) == text and len(parts) > 50
    assert [w for p in parts for w in re.findall("[a-h]{7,}", p)] == re.findall("[a-h]{7,}", text)


@pytest.mark.parametrize("word", ["abcdefg", "abcdefgh", "aabbccdd", "ééééééé"])
def test_halves_meet(word):
    """Every word at one edit shares a half in fitting roles."""
    own = dict(spelling.halves(word))
    for i in range(len(word) + 1):
        longer = dict(spelling.halves(word[:i] + "z" + word[i:]))
        assert any(own[h] & 1 and longer[h] & 2 for h in set(own) & set(longer))
        if i < len(word):
            other = dict(spelling.halves(word[:i] + "z" + word[i + 1 :]))
            assert any(own[h] & other[h] & 1 for h in set(own) & set(other))
