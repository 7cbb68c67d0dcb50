import pyarrow as pa
import pytest

from catalogflow.llm import decontaminate as dc

ITEMS = [
    (1, "Tom has 12 apples and gives 5 apples to Mary Smith. How many apples does Tom keep for the 12 days of the trip?"),
    (2, "Of course the river bends near the old stone mill where nobody lives."),
    (3, "water boils at sea"), (4, "too short"), (5, None), (6, ""), (7, "5 6 7 8 9 10 11 12 13"),
    (None, "Of course the river bends near the old stone mill where nobody lives."),
]
GOOD = "As Ann has 31 apples and gives 7 apples to Joan Miller. How many apples does Ann keep for the 31 days of the trip? Yes."


@pytest.fixture
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 as hash", "'x' as _row", "2 as width")


def test_cases(docs_of, items):
    long_text = "filler word " * 40_000
    cases = [
        (1, GOOD, [1]),  # other numbers and names, used consistently
        (2, GOOD.replace("for the 31 days", "for the 44 days"), []),  # 12 stands for 31 and for 44
        (3, long_text + ITEMS[1][1].upper().replace(" ", "  \n") + long_text, [2]),
        (4, "xx Of course the river bends near the old stone", [2]), (5, "the river bends", []),
        (6, "he said: Water boils, at sea!", [3]), (7, None, []), (8, "", []), (9, "21 22 23 24 25 26 27 28 29", []),
        (9, GOOD, [1]), (9, GOOD, [1]), (None, GOOD, [1]), (11, "too short", []),
    ]
    got = dc.contamination(docs_of([c[:2] for c in cases]), items).collect()
    assert sorted(((r.doc_id, r.items) for r in got), key=repr) == sorted(((i, x) for i, _, x in cases), key=repr)
    assert all(r.contaminated == (r.n_items > 0) for r in got)
    assert {r.n_items for r in got if r.items == [2]} == {2}  # the item without id counts
    assert dc.contamination(docs_of([(1, "x")]).limit(0), items).collect() == []
    none = dc.contamination(docs_of([(1, GOOD)]), items.limit(0)).collect()
    assert [(r.items, r.contaminated) for r in none] == [([], False)]


def brute(text, items, share=0.5):
    """Every window of every item against every window of the text, by token lists."""
    cache, out = dc.Tokens(), []
    mine, slots, _ = dc.template(text.encode().split(), cache)
    mine = mine.tolist()
    where = {}
    for w in range(dc.SHORTEST, dc.WINDOW + 1):
        for p in range(len(mine) - w + 1):
            where.setdefault(tuple(mine[p : p + w]), []).append(p)
    for i, t in items:
        their, values, _ = dc.template(t.encode().split(), cache)
        w = min(len(their), dc.WINDOW)
        lines = {}
        for q in range(len(their) - w + 1) if w >= dc.SHORTEST else ():
            if (values[q : q + w] == 0).mean() >= dc.LITERALS:
                for p in where.get(tuple(their[q : q + w].tolist()), ()):
                    lines.setdefault(p - q, []).append(q)
        covered = set()
        for shift, starts in lines.items():
            pairs = {(int(values[q + k]), int(slots[q + k + shift])) for q in starts for k in range(w) if values[q + k]}
            if len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}):
                covered |= {q + k for q in starts for k in range(w)}
        if covered and len(covered) >= share * len(their):
            out.append(i)
    return sorted(out)


def test_documents(spark, documents):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    got = {r.doc_id: r.items for r in dc.contamination(documents, bench).collect()}
    want = {r.doc_id: brute(r.text, items) for r in documents.collect()}
    assert got == want and any(want.values())


def test_items_that_differ_in_values_alone(spark, docs_of):
    """Items of one template are matched once for each pattern of equal values, and all of them are named."""
    names = ["Tom", "Ann", "Joe", "Sue", "Max", "Eva"]
    ask = "Today {} has {} apples and gives {} apples to {} near the old stone mill before {} goes home"
    items = [(i, ask.format(names[i % 6], i + 3, i + 3 if i % 3 == 0 else i + 500, names[(i + 1) % 6], names[i % 6])) for i in range(40)]
    items += [(100, ask.format("Tom", 3, 9, "Tom", "Tom")), (None, items[0][1]), (101, items[1][1])]
    docs = [(i, "so it was. " + ask.format(*v) + ". the end") for i, v in enumerate([
        ("Lea", 7, 7, "Kim", "Lea"), ("Lea", 7, 8, "Kim", "Lea"), ("Lea", 7, 8, "Lea", "Lea"), ("Lea", 7, 8, "Kim", "Kim")])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.items, r.n_items) for r in dc.contamination(docs_of(docs), bench).collect()}
    want = {i: brute(t, items[:41] + items[42:]) for i, t in docs}
    assert {i: x for i, (x, _) in got.items()} == want
    assert [len(want[i]) for i in range(4)] == [14, 27, 1, 0] and got[0][1] == 15
    rows = pa.RecordBatch.from_pylist([{"item": i, "_text": t.encode()} for i, t in items])
    (out,) = dc._classed(iter([rows]))
    assert len(set(out.column("_id").to_pylist())) == 3
