import re

from pyspark.sql import functions as F

from catalogflow.llm import secrets

KEY = "AKIA" + "Q" * 16


def brute(text):
    """The contract's patterns as they stand, failing matches dropped afterwards."""
    out = []
    assign = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out += [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


TEXTS = [
    'é Password : "abcdefghijkl" token=short secret: token = "0123456789abcdef01"', f"x{KEY}AKIA y", "AKIAQQ AKIAAKIA" + "B" * 11,
    "apikey='aaaaaaaaaaaa' API_KEY==bbbbbbbbbbbb", "deadbeefdeadbeef" * 3 + " 123456789abcdef", None, "", "ghp_" + "Ab1" * 12,
    "paſſword=aaaaaaaaaaaaaaa toKen=bbbbbbbbbbbbbbb", "secret\n=\nabcdefghijklmnop", "token:" + "z" * 100_000,
    "password=token=abcdefghijklmno", "\U0001F600 passwd=correcthorsebattery",
]


def test_base_spans(docs_of):
    df = docs_of(list(enumerate(TEXTS)) + [(0, TEXTS[0]), (None, TEXTS[1])])
    got = secrets.scan_secrets(df).select("doc_id", secrets.span_text(F.col("spans"), 3).alias("base")).collect()
    want = [(i, ",".join(brute(t or ""))) for i, t in [*enumerate(TEXTS), (0, TEXTS[0]), (None, TEXTS[1])]]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert secrets.scan_secrets(df.limit(0)).collect() == []


def test_documents(documents):
    got = secrets.scan_secrets(documents).select("doc_id", secrets.span_text(F.col("spans"), 3)).collect()
    assert sorted(map(tuple, got)) == sorted((r.doc_id, ",".join(brute(r.text))) for r in documents.collect())


def test_ownership(spark):
    live = "9f8e7d6c5b4a39281706f5e4"
    data = [(i, f"key token={KEY.lower()}", f"s{i}", "en") for i in range(4)] + [(9, f"token={live}", "s9", None)] * 2
    data += [(10, "secret=aaaaaaaaaaaaaaaaaaaa", "s1", "en")]
    out = secrets.scan_secrets(spark.createDataFrame(data, "doc_id long, text string, source string, lang string"))
    by = {(r.doc_id, s.kind): (s.owners, s.repositories, s.verdict) for r in out.collect() for s in r.spans}
    assert by[0, "assign"] == (4, 4, "copied")
    assert by[9, "assign"] == by[9, "hex"] == (1, 1, "live")
    assert by[10, "assign"] == (1, 1, "weak")
