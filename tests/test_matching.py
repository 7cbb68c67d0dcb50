import random
from difflib import SequenceMatcher

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalogflow.operators import matching

WORDS = "deep map of the urban forest lidar point cloud fusion network change detection with a multi scale model".split()


def titles(rng, n):
    return [" ".join(rng.choices(WORDS, k=rng.randint(1, 12))) for _ in range(n)]


def damage(rng, title):
    chars = list(title)
    for _ in range(rng.randint(0, max(1, len(chars) // 7))):
        at = rng.randrange(len(chars) + 1)
        kind = rng.random()
        if kind < 0.4:
            chars.insert(at, rng.choice("abc xyz"))
        elif chars:
            at = min(at, len(chars) - 1)
            if kind < 0.8:
                del chars[at]
            else:
                chars[at] = rng.choice("abc xyz")
    return "".join(chars)


def brute_force(items, issued, threshold=0.90):
    def key(t):
        return " ".join((t or "").replace('"', "").split()).lower()

    known = {key(t) for t in issued} - {""}
    return sorted(
        t for t in items
        if key(t) and not any(SequenceMatcher(None, key(t), k).ratio() >= threshold for k in known)
    )


def run(spark, items, issued, **options):
    left = spark.createDataFrame([(t,) for t in items], "Title string")
    right = spark.createDataFrame([(t,) for t in issued], "Title string")
    return sorted(r.Title for r in matching.exclude_issued(left, right, "Title", **options).collect())


def test_exclude_issued_equals_brute_force(spark):
    rng = random.Random(3)
    issued = titles(rng, 300) + ["", None, "abcde", "maps", "abcdefg", "x"]
    items = titles(rng, 40) + [damage(rng, t) for t in rng.choices(issued[:300], k=260)]
    items += [None, '""', "abcdef", "abcdeg", "map", "abcdefgh", "x"]
    want = sorted(t.replace('"', "").strip() for t in brute_force(items, issued))
    got = run(spark, items, issued)
    assert got == want
    # with tiny crowds nearly all keys take the block search
    assert run(spark, items, issued, crowd=1, block=20) == want
    assert run(spark, items, issued, crowd=5, block=1000) == want
    assert 20 < len(got) < len(items) - 60


def test_long_titles_use_the_matchers_own_rules(spark):
    # beyond 200 characters the matcher ignores very common characters
    rng = random.Random(5)
    issued = [" ".join(rng.choices(WORDS, k=60)) for _ in range(12)]
    items = [damage(rng, t) for t in issued] + issued[:2]
    assert run(spark, items, issued) == sorted(t.strip() for t in brute_force(items, issued))


def test_a_crowd_of_one_pattern(spark):
    rng = random.Random(9)
    issued = [f"annual report number {rng.randrange(10**7):07d} of the land survey office" for _ in range(400)]
    items = [f"annual report number {rng.randrange(10**7):07d} of the land survey office" for _ in range(20)]
    items += [damage(rng, damage(rng, t)) for t in issued[:20]] + titles(rng, 10)
    assert run(spark, items, issued, crowd=50, block=64) == sorted(t.strip() for t in brute_force(items, issued))


def test_candidate_join_misses_no_pair(spark):
    rng = random.Random(11)
    pool = ["".join(rng.choices("ab ", k=rng.randint(1, 40))).strip() or "a" for _ in range(150)]
    pool = [" ".join(t.split()) for t in pool]
    left, right = sorted(set(pool[:75])), sorted({" ".join(t.split()) for t in pool[75:]} | {
        " ".join((damage(rng, t) or "b").split()) or "b" for t in pool[:75]})
    a = spark.createDataFrame([(str(i), t) for i, t in enumerate(left)], "a_id string, a string").withColumn("a_id", F.col("a_id").cast("binary"))
    b = spark.createDataFrame([(t,) for t in right], "Title string")
    for threshold in (0.8, 0.9):
        index = matching.build_title_index(b, threshold=threshold)
        pairs = matching.candidate_pairs(a, index).join(index.titles, "id").join(a, "a_id")
        found = {(r.a, r.title) for r in pairs.collect()}
        for x in left:
            for y in right:
                if x != y and SequenceMatcher(None, x, y).ratio() >= threshold:
                    assert (x, y) in found, (x, y, threshold)


def test_one_index_for_several_batches(spark):
    rng = random.Random(4)
    issued = titles(rng, 120)
    index = matching.build_title_index(spark.createDataFrame([(t,) for t in issued], "Title string"))
    for seed in (1, 2):
        items = [damage(random.Random(seed), t) for t in issued[:40]] + titles(random.Random(seed), 10)
        df = spark.createDataFrame([(t,) for t in items], "Title string")
        got = sorted(r.Title for r in matching.exclude_issued(df, index, "Title").collect())
        assert got == sorted(t.replace('"', "").strip() for t in brute_force(items, issued))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("catalogflow_")]


def test_the_index_is_not_shuffled_again(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    try:
        rng = random.Random(6)
        issued = spark.createDataFrame([(t,) for t in titles(rng, 50)], "Title string")
        items = spark.createDataFrame([(t,) for t in titles(rng, 20)], "Title string")
        plan = matching.exclude_issued(items, issued, "Title")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 8, plan
        assert "Bucketed: true" in plan
    finally:
        spark.conf.unset(key)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abc é", max_size=90), st.text("abc é", max_size=90))
def test_token_ratio_is_the_lcs_ratio(a, b):
    want = 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))
    assert abs(matching.token_ratio(a, b) - want) < 1e-9


def test_best_match_equals_brute_force(spark, monkeypatch):
    rng = random.Random(7)
    items = [(rng.choice("ppppq"), t) for t in titles(rng, 60)] + [("r", "alone"), (None, "x"), ("p", None)]
    cands = [(rng.choice("ppppq"), damage(rng, t)) for t in titles(rng, 80)]
    cands += [("p", "of map deep"), ("p", "deep map of"), ("q", "z" * 400)]
    items += [("p", "map of deep"), ("q", ""), ("q", "  ")]
    cands += [("q", " "), ("q", None)]

    def norm(t):
        return " ".join(sorted(t.split()))

    want = []
    for grp, title in items:
        scored = [(-matching.token_ratio(norm(title), norm(n)), n) for g, n in cands if g == grp and n is not None] if grp and title is not None else []
        best = min(scored, default=None)
        hit = best is not None and -best[0] >= 30
        want.append((grp, title, best[1] if hit else None, round(-best[0], 6) if hit else None))
    left = spark.createDataFrame(items, "grp2 string, title string")
    right = spark.createDataFrame(cands, "grp2 string, name string")
    for block, rare in ((1000, 200), (7, 200), (16, 2)):
        monkeypatch.setattr(matching, "RARE", rare)
        out = matching.best_match(left, right, "grp2", "title", "name", block=block)
        got = out.select("grp2", "title", "match", F.round("score", 6)).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_best_match_without_a_least_score(spark):
    left = spark.createDataFrame([("g", "abc"), ("h", "abc")], "grp string, title string")
    right = spark.createDataFrame([("g", "xyz"), ("g", "xy")], "grp string, name string")
    out = matching.best_match(left, right, "grp", "title", "name", min_score=0).collect()
    assert sorted((r.grp, r.match, r.score) for r in out) == [("g", "xy", 0.0), ("h", None, None)]


def test_a_segment_crowded_in_one_bucket_only(spark):
    # the issued title shares its last 16 characters one bucket later than the crowd does
    rng = random.Random(11)
    tail = "zqxjkvwyzqxjkvwy"
    letters = "abcdefghilmnoprstu"
    head = "".join(rng.choices(letters, k=24))
    item, issued = head + tail, head[:8] + "#" + head[8:14] + "#" + head[14:20] + "#" + head[20:] + "#" + tail
    crowd = ["".join(rng.choices(letters, k=12)) + tail + "".join(rng.choices(letters, k=12)) for _ in range(40)]
    for limit in (2, 39, 2000):
        assert run(spark, [item], [issued, *crowd], crowd=limit) == sorted(t for t in brute_force([item], [issued, *crowd])) == []
    assert run(spark, [item], crowd, crowd=2) == [item]


def test_frequent_syllables_make_no_pairs(spark):
    # short segments of such titles occur in most of them; only near letter counts and pairs of letters make a candidate
    rng = random.Random(13)
    syllables = "th in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve".split()

    def text():
        return " ".join("".join(rng.choices(syllables, k=rng.randint(2, 5))) for _ in range(14))[:118].strip()

    issued = [text() for _ in range(300)]
    items = [text() for _ in range(150)] + [damage(rng, t)[:118].strip() for t in issued[:50]]
    left = spark.createDataFrame([(str(i), " ".join(t.split())) for i, t in enumerate(items)], "a_id string, a string").withColumn("a_id", F.col("a_id").cast("binary"))
    index = matching.build_title_index(spark.createDataFrame([(t,) for t in issued], "Title string"), crowd=64)
    assert matching.candidate_pairs(left, index, block=32).count() <= 100
    want = sorted(t.strip() for t in brute_force(items, issued))
    for crowd, block in ((64, 32), (16384, 16384)):
        assert run(spark, items, issued, crowd=crowd, block=block) == want
    assert 150 <= len(want) < 200


def test_letters_beyond_the_limits_of_the_screens(spark):
    # one letter more often than signatures and pair counts can tell, and long texts
    issued = ["a" * 700, "ab" * 500, "x" * 40 + "y" * 40, "é" * 30]
    items = ["a" * 640, "a" * 500, "ab" * 460, "x" * 38 + "y" * 40, "y" * 40 + "x" * 40, "é" * 26, "é" * 20]
    assert run(spark, items, issued) == brute_force(items, issued)


def test_many_ratios_at_once(spark):
    # all widths around the words of 64 bits, and texts of very uneven length
    rng = random.Random(17)
    texts = sorted(("".join(rng.choices("abcdé ", k=n)) for n in (0, 1, 5, 63, 64, 65, 128, 200, 200, 3000)), key=len, reverse=True)
    order, encoded = matching._ordered(texts)
    assert order.tolist() == list(range(len(texts))) and sum(map(len, encoded[2])) == sum(map(len, texts))
    for widths in ((0, 1, 30, 63, 64), (65, 0, 127, 128, 129, 300)):
        items = ["".join(rng.choices("abcdxé ", k=n)) for n in widths]
        for pairs in ([(j, k) for j in range(len(texts)) for k in range(len(items))], [(1, 2), (4, 0), (4, 3), (9, 0)]):
            chosen, who = np.array(pairs).T
            want = [matching.token_ratio(items[k], texts[j]) for j, k in pairs]
            assert matching._ratios(items, encoded, who, chosen).tolist() == want
