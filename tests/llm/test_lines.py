import random

import pytest
from pyspark.sql import functions as F

from catalogflow.llm import line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        p = rng.randrange(len(out)) if out else 0
        kind = rng.randrange(3) if out else 1
        if kind == 0:
            out[p] = rng.choice("abé\U0001F600")
        elif kind == 1:
            out.insert(p, rng.choice("abé"))
        else:
            del out[p]
    return "".join(out)


@pytest.mark.parametrize("most", [1, 2, 4])
def test_banded_distance(spark, most):
    rng = random.Random(most)
    pairs = [("", ""), ("", "a"), ("abc", "abc"), ("ab", "ba"), ("a" * 9, "a" * 8)]
    for _ in range(250):
        a = "".join(rng.choice("abé ") for _ in range(rng.randrange(1, 60)))
        b = edited(rng, a, rng.randrange(0, most + 3))
        pairs += [(a, b), (b, a)]
    pairs = [(a, b) for a, b in pairs if abs(len(a) - len(b)) <= most]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", line_dedup.banded_distance(F.col("a"), F.col("b"), most).alias("d"),
                    line_dedup._within(F.col("a"), F.col("b"), most, part=7).alias("w")).collect()
    for r in got:
        true = distance(r.a, r.b)
        assert (r.d == true) if true <= most else (r.d > most), (r.a, r.b, r.d, true)
        assert (r.w == true) if true <= most else (r.w is None or r.w > most), (r.a, r.b, r.w, true)


def brute(pairs, most=2, shortest=20):
    big = 2**63 - 1
    rows = [(big if i is None else i, t or "") for i, t in pairs]
    first = {}
    for i, t in rows:
        for n, line in enumerate(t.split("\n")):
            if len(line) >= shortest:
                first.setdefault(line, []).append((i, n))
    first = {line: min(p) for line, p in first.items()}
    names = sorted(first, key=len)
    links = {line: [] for line in names}
    for x, a in enumerate(names):
        for b in names[x + 1 :]:
            if len(b) - len(a) > most:
                break
            if distance(a, b) <= most:
                links[a].append(b), links[b].append(a)
    out = []
    for (i, t), (own, _) in zip(rows, pairs):
        kept, gone, n_links = [], 0, 0
        for n, line in enumerate(t.split("\n")):
            n_links += len(links.get(line, ()))
            if line in first and min(first[x] for x in (line, *links[line])) < (i, n):
                gone += 1
            else:
                kept.append(line)
        out.append((own, len(t.split("\n")), gone, n_links, "\n".join(kept)))
    return sorted(out, key=repr)


def test_edges(docs_of, rows):
    rng = random.Random(5)
    line = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    base = [line(rng.randrange(18, 60)) for _ in range(12)]
    pairs = []
    for i in range(40):
        chosen = [edited(rng, rng.choice(base), rng.randrange(4)) for _ in range(rng.randrange(1, 6))]
        pairs.append((i, "\n".join([*chosen, "short", ""])))
    pairs += [(50, None), (51, ""), (52, "\n\n"), (None, base[0]), (53, "x" * 50_000 + "\n" + "x" * 49_999), (54, "é" * 30),
              (55, "é" * 30 + "\r"), pairs[3], pairs[3]]
    df = docs_of(pairs)
    short = [p for p in pairs if p[0] != 53]
    assert rows(line_dedup.dedup_lines(docs_of(short)).drop("text_tag")) == brute(short)
    assert rows(line_dedup.dedup_lines(docs_of(short), crowd=1).drop("text_tag")) == brute(short)
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(df).collect()}
    assert got[53] == 1 and got[50] == got[51] == 0
    assert rows(line_dedup.dedup_lines(df.limit(0))) == []


def test_crowded_segment(docs_of, rows):
    """Many unlike lines share a segment; the join keeps the near ones only."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    tails = [word(rng.choice((28, 29))) for _ in range(80)]
    tails += [edited(rng, rng.choice(tails), rng.randrange(1, 4)) for _ in range(40)]
    pairs = [(i, "shared segment" + t) for i, t in enumerate(tails)]
    assert rows(line_dedup.dedup_lines(docs_of(pairs), crowd=4).drop("text_tag")) == brute(pairs)
    assert rows(line_dedup.dedup_lines(docs_of(pairs), crowd=10**6).drop("text_tag")) == brute(pairs)


def test_documents(documents, rows):
    pairs = [(r.doc_id, r.text) for r in documents.filter("doc_id < 60").collect()]
    assert rows(line_dedup.dedup_lines(documents.filter("doc_id < 60")).drop("text_tag")) == brute(pairs)


def test_native(documents):
    plan = line_dedup.dedup_lines(documents)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


@pytest.mark.parametrize("most, shortest", [(1, 4), (3, 9), (4, 12)])
def test_thresholds(docs_of, rows, most, shortest):
    """Lengths around the edges of the classes, edits at both ends and between segments."""
    rng = random.Random(most)
    base = ["".join(rng.choice("abcd") for _ in range(n)) for n in (7, 8, 11, 12, 15, 16, 20, 23, 31, 32, 33, 39, 40, 63, 64, 80)]
    pairs = [(i, edited(rng, base[i % len(base)], rng.randrange(most + 2))) for i in range(160)]
    pairs += [(200 + i, "x" * most + b) for i, b in enumerate(base)] + [(300 + i, b + "y" * most) for i, b in enumerate(base)]
    got = line_dedup.dedup_lines(docs_of(pairs), most=most, shortest=shortest).drop("text_tag")
    assert rows(got) == brute(pairs, most, shortest)
