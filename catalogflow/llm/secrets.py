"""Secret scan with corpus-wide ownership of each candidate.

Candidates are found by patterns, hashed, and counted over the corpus by
distinct repositories and owners: a value that many owners hold is a copied
example, a random-looking value of one owner looks live.
"""

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from catalogflow.llm.common import slices
from catalogflow.session import materialize

# fixed values: base kinds in the order of the contract, then the added kinds
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]+", r"[0-9a-f]+"
BASE = ("assign", "access", "hex")
ADDED = {
    "github": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "slack": r"xox[abprs]-[A-Za-z0-9-]{20,}",
    "jwt": r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}",
    "pem": r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]+-----END [A-Z ]*PRIVATE KEY-----",
}
KINDS = (*BASE, *ADDED)
SPAN = "struct<start:int,stop:int,rank:int,value:string,bits:double>"
ARROW = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("rank", pa.int32()), ("value", pa.string()),
                   ("bits", pa.float64())])


def entropy(value):
    """Bits of a value's characters, all together."""
    n = len(value)
    return -sum(c * math.log2(c / n) for c in Counter(value).values())


def _finder():
    assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
    # runs are maximal, so a length bound inside the pattern drops the same runs
    access, hexes = re.compile(ACCESS.replace("+", "{14,}")), re.compile(HEX.replace("+", "{16,}"))
    added = [(KINDS.index(k), re.compile(p)) for k, p in ADDED.items()]
    words = ("password", "passwd", "secret", "token", "apikey", "api_key")
    marks = ("gh", "xox", "eyJ", "-----BEGIN")

    def find(text):
        low, out = text.lower(), []
        if any(w in low for w in words):
            out += [(*m.span(), 0, m[2]) for m in assign.finditer(text) if len(m[2]) >= 12]
        if "AKIA" in text:
            out += [(*m.span(), 1, m[0]) for m in access.finditer(text)]
        out += [(*m.span(), 2, m[0]) for m in hexes.finditer(text)]
        for (rank, pattern), mark in zip(added, marks):
            if mark in text:
                out += [(*m.span(), rank, m[0]) for m in pattern.finditer(text)]
        return sorted(out, key=lambda s: (s[0], s[2]))

    return find


def _scan(batches):
    find = _finder()
    for batch in slices(batches, "_text"):
        spans = [
            [{"start": a, "stop": b, "rank": k, "value": hashlib.sha256(v.encode()).hexdigest(), "bits": entropy(v)}
             for a, b, k, v in find(text.decode("utf-8", "replace"))]
            for text in batch.column("_text").to_pylist()
        ]
        kept = [batch.column(c) for c in ("doc_id", "own", "repo")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(spans, pa.list_(ARROW))], names=["doc_id", "own", "repo", "found"])


def _together(columns):
    return F.concat_ws("\1", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns])


def scan_secrets(docs, owner=("source",), repository=("source", "lang"), copied=3, least_bits=40.0, id_col="doc_id",
                 text_col="text"):
    """Candidate secrets of every document, each with its ownership over the corpus.

    Returns one row per input row: doc_id and ``spans``, an array sorted by start
    and kind of (start, stop, rank, kind, value, owners, repositories, verdict);
    places are code points, ``value`` is a SHA-256, never the secret. ``verdict``
    is ``copied`` if at least ``copied`` owners hold the value, ``live`` if fewer
    do and its characters carry ``least_bits``, else ``weak``. owner and
    repository name columns of docs; nulls there are one owner. Null and empty
    texts have no spans; repeated rows and null ids are scanned like any other.
    Values meet as distinct (value, owner, repository), combined in the map
    tasks, so one that a third of all rows hold makes no large group.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), _together(owner).alias("own"), _together(repository).alias("repo"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"),
    )
    found = rows.mapInArrow(_scan, f"doc_id long, own string, repo string, found array<{SPAN}>")
    found = materialize(found.withColumn("n", F.monotonically_increasing_id()), "secrets")
    each = found.filter(F.size("found") > 0).select("n", "own", "repo", F.explode("found").alias("s"))
    each = each.select("n", "own", "repo", "s.*")
    holders = each.select("value", "own", "repo").distinct()
    counts = holders.groupBy("value").agg(
        F.count_distinct("own").alias("owners"), F.count_distinct("repo").alias("repositories"))
    verdict = (
        F.when(F.col("owners") >= copied, "copied").when(F.col("bits") >= least_bits, "live").otherwise("weak")
    )
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("rank") + 1)
    span = F.struct("start", "rank", "stop", kind.alias("kind"), "value", "owners", "repositories", verdict.alias("verdict"))
    spans = each.join(counts, "value").groupBy("n").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    empty = F.lit(None).cast(spans.schema["spans"].dataType)
    plain, rich = found.filter(F.size("found") == 0), found.filter(F.size("found") > 0)
    none = plain.select("doc_id", F.coalesce(empty, F.array()).alias("spans"))
    return rich.join(spans, "n").select("doc_id", "spans").unionByName(none)


def span_text(spans, only=None):
    """``kind:start:end`` of the spans, comma-joined; ``only``: of that many first kinds."""
    if only is not None:
        spans = F.filter(spans, lambda s: s["rank"] < only)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def spans_of(spans, kind=None, verdict=None):
    """How many spans are of a kind or have a verdict."""
    keep = (lambda s: s["kind"] == kind) if kind else (lambda s: s["verdict"] == verdict)
    return F.size(F.filter(spans, keep)).cast("long")
