import re

import pytest

from catalogflow.llm import mixture

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def clamped(sizes, weights, share, cap):
    """Textbook rounds: hand out by weight, clamp, hand the excess out again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(sizes), dict.fromkeys(sizes, 0.0)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= cap * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_mix(spark, rows):
    texts = [(i, " ".join(["w"] * n), s) for i, (n, s) in enumerate(
        [(50, "b"), (3, "b"), (200, "é"), (1, None), (40, None), (900, "a"), (0, "zero"), (77, "B"), (500, "")])]
    texts += [(2, "x y", "a"), (2, "x y", "a"), (None, "p\tq\nr", "a"), (9, None, "b")]
    df = spark.createDataFrame([(*t, 1, 2) for t in texts], "doc_id long, text string, source string, target int, rank int")
    sizes = {}
    for _, t, s in texts:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    got = mixture.mix(df).collect()
    assert len(got) == len(texts)
    want = clamped(sizes, (5, 2, 1), 1.5, 2.0)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= len(texts)
    assert rows(mixture.mix(df)) == rows(mixture.mix(df.repartition(3)))
    assert rows(mixture.mix(df.limit(0))) == []


def test_repetitions_hold_the_taken_words(documents):
    mixed = mixture.mix(documents)
    out = mixture.repetitions(documents, mixed).collect()
    words = {}
    for r in out:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(WORD.findall(r.text))
    assert words == {r.doc_id: r.taken for r in mixed.collect() if r.taken}
    assert {"text", "lang", "source", "n_chars", "repetition"} <= set(out[0].asDict())
