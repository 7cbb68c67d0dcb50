"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, units and names turn into typed
placeholders, all else into lower-case words without outer punctuation. Windows
of template tokens are hashed and joined with those of the benchmark; along one
alignment of document and item the same value must always stand for the same
value. So a question with other numbers or names is still found.
"""

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from catalogflow.llm.common import Rolling, arrow, keyed, mixed, plain_id, slices
from catalogflow.session import materialize

WINDOW, SHORTEST, LITERALS, FILTER_BITS, CACHED = 8, 4, 0.6, 23, 1_000_000
BASE = 0x94D049BB133111EB
NUMBER, UNIT, NAME = 1, 2, 3
# fixed values: units of measure
UNITS = frozenset(
    "mm cm m km in ft yd mi mile miles inch inches feet foot yard yards meter meters metre metres kilometer kilometers "
    "mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres "
    "cup cups s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "cent cents dollar dollars usd eur euro euros percent degree degrees mph kmh kwh watt watts volt volts".split()
)
_NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*%?")
_EDGES = re.compile(r"^[^\w$€£+-]+|[^\w%]+$")
SCHEMA = "hash long, _id long, _row long, pos int, width int, slots array<long>"
ARROW = pa.schema([("hash", pa.int64()), ("_id", pa.int64()), ("_row", pa.int64()), ("pos", pa.int32()),
                   ("width", pa.int32()), ("slots", pa.list_(pa.int64()))])


class Tokens(dict):
    """Template attributes of words, found once per word: an index into three arrays."""

    def __init__(self):
        super().__init__()
        self.value, self.kind, self.ends = np.zeros(4096, np.uint64), np.zeros(4096, np.int8), np.zeros(4096, bool)

    def __missing__(self, word):
        n = len(self)
        if n == len(self.value):
            self.value, self.kind, self.ends = (np.concatenate([x, np.zeros_like(x)]) for x in (self.value, self.kind, self.ends))
        text = word.decode("utf-8", "replace")
        core = _EDGES.sub("", text)
        low = core.lower()
        if core:
            self.value[n] = xxhash.xxh3_64_intdigest(low.encode()) | 1
        if _NUMBER.fullmatch(core):
            self.kind[n] = NUMBER
        elif low in UNITS:
            self.kind[n] = UNIT
        elif len(core) > 1 and core[0].isupper() and core[1:].islower():
            self.kind[n] = NAME
        self.ends[n] = text.rstrip("\"')]")[-1:] in (".", "!", "?", ":")
        self[word] = n
        return n


def template(words, cache):
    """Token hashes and slot values (0 for a literal) of a list of words; punctuation alone is no token.

    A capitalised word is a name unless it begins a sentence.
    """
    if len(cache) > CACHED:
        cache = Tokens()
    at = np.fromiter(map(cache.__getitem__, words), np.int64, len(words))
    value, kind, ends = cache.value[at], cache.kind[at], cache.ends[at]
    keep = value != 0
    value, kind, ends = value[keep], kind[keep].copy(), ends[keep]
    begins = np.r_[True, ends[:-1]] if len(ends) else ends
    kind[(kind == NAME) & begins] = 0
    return np.where(kind > 0, kind.astype(np.uint64), value), np.where(kind > 0, value, np.uint64(0)), cache


def _windows(widths, bitmap, whole):
    """Windows of each width with enough literals; ``whole``: short texts as one window; bitmap: keep only possible ones."""

    def run(batches):
        roll, cache = Rolling(BASE), Tokens()
        for batch in slices(batches, "_text"):
            found, slots = [], []
            for i, text in enumerate(batch.column("_text").to_pylist()):
                tokens, slot, cache = template(text.split(), cache)
                sizes = [min(len(tokens), max(widths))] if whole else widths
                for w in sizes:
                    if w < SHORTEST or len(tokens) < w:
                        continue
                    h = mixed(roll.windows(tokens, w) ^ np.uint64(w))
                    ok = np.ones(len(h), bool) if bitmap is None else _hit(bitmap, h)
                    p = np.flatnonzero(ok)
                    if len(p):
                        inside = slot[p[:, None] + np.arange(w)]
                        good = (inside == 0).mean(1) >= LITERALS
                        p, inside = p[good], inside[good]
                        found += [(h[q], i, q, w) for q in p.tolist()]
                        slots += inside.view(np.int64).tolist()
            if found:
                h, doc, pos, width = zip(*found)
                doc = np.array(doc)
                yield arrow(ARROW, np.array(h, np.uint64).view(np.int64), batch.column("_id").to_numpy()[doc],
                            batch.column("_row").to_numpy()[doc], pos, width, slots)

    return run


def _classed(batches):
    """Items with the class of their text: its template tokens and which of its slots hold the same value."""
    cache = Tokens()
    for batch in slices(batches, "_text"):
        classes = []
        for text in batch.column("_text").to_pylist():
            tokens, slot, cache = template(text.split(), cache)
            _, first, which = np.unique(slot, return_index=True, return_inverse=True)
            pattern = np.where(slot == 0, -1, first[which]) if len(slot) else slot
            classes.append(xxhash.xxh3_64_intdigest(tokens.astype(np.uint64).tobytes() + pattern.astype(np.int64).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), pa.array(np.array(classes, np.uint64).view(np.int64)), batch.column("_text")],
            names=["item", "_id", "_text"])


def _hit(bitmap, h):
    place = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (bitmap[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0


def _filter_of(windows):
    """A bitmap of fixed size (2^23 bits, 1 MB) that holds each window's hash, whatever the size of the benchmark."""
    place = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    words = windows.groupBy(F.shiftright(place, 6).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - FILTER_BITS}) & 63 as int))")).alias("bits"))
    bitmap = np.zeros(2**FILTER_BITS // 64, np.uint64)
    for at, bits in words.collect():
        bitmap[at] = np.int64(bits).view(np.uint64)
    return bitmap


def contamination(docs, benchmark, share=0.5, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text"):
    """Benchmark items that each document holds.

    Returns one row per input row: doc_id, items (sorted ids of the items of
    which at least ``share`` of the template tokens are covered by windows of 8
    tokens on consistent alignments), n_items and contaminated. Items of 4 to 7
    tokens are matched as a whole; shorter ones and windows mostly of
    placeholders never match. Null and empty texts hold nothing; equal items
    count each (items that differ in values alone are matched once); repeated rows get equal results; null item ids are not listed
    but count. Windows pass a bitmap of fixed size before they are shuffled.
    ``text_tag`` (``common.text_tag`` of the input text) tells rows of one id apart.
    """
    rows = keyed(docs, id_col, text_col)
    # items of one template whose slots agree alike are consistent with the same documents: one of them is matched for all
    item = benchmark.select(F.col(item_col).cast("long").alias("item"),
                            F.coalesce(F.col(item_text_col), F.lit("")).cast("binary").alias("_text"))
    item = materialize(item.mapInArrow(_classed, "item long, _id long, _text binary"), "items")
    texts = item.groupBy("_id").agg(F.min("_text").alias("_text")).withColumn("_row", F.lit(0).cast("long"))
    known = materialize(texts.mapInArrow(_windows([WINDOW], None, True), SCHEMA), "benchmark")
    widths = sorted(r[0] for r in known.select("width").distinct().collect()) or [WINDOW]
    found = rows.mapInArrow(_windows(widths, _filter_of(known), False), SCHEMA).withColumnRenamed("slots", "theirs")
    ours = known.select("hash", "width", F.col("_id").alias("text"), F.col("pos").alias("at"), F.col("slots").alias("ours"))
    match = found.join(ours, ["hash", "width"]).withColumn("shift", F.col("pos") - F.col("at"))
    match = materialize(match.select("_id", "_row", "text", "shift", "at", "width", "ours", "theirs"), "matches")
    line = ["_id", "_row", "text", "shift"]
    pairs = match.select(*line, F.explode(F.arrays_zip("ours", "theirs")).alias("s")).filter("s.ours <> 0 or s.theirs <> 0")
    pairs = pairs.select(*line, F.col("s.ours").alias("o"), F.col("s.theirs").alias("t")).distinct()
    broken = pairs.groupBy(*line).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o").alias("n_o"), F.count_distinct("t").alias("n_t")
    ).filter("n > n_o or n > n_t")
    good = match.join(broken.select(*line), line, "left_anti")
    places = good.select("_id", "_row", "text", F.explode(F.sequence("at", F.expr("at + width - 1"))).alias("at")).distinct()
    covered = places.groupBy("_id", "_row", "text").agg(F.count(F.lit(1)).alias("covered"))
    length = known.groupBy(F.col("_id").alias("text")).agg(F.max(F.col("pos") + F.col("width")).alias("tokens"))
    held = covered.join(length, "text").filter(F.col("covered") >= F.lit(share) * F.col("tokens"))
    named = held.join(item.select(F.col("_id").alias("text"), "item"), "text")
    per_row = named.groupBy("_id", "_row").agg(
        F.sort_array(F.collect_list("item")).alias("items"), F.count(F.lit(1)).alias("n_items"))
    out = rows.select("_id", "_row").join(per_row, ["_id", "_row"], "left")
    return out.select(
        plain_id("doc_id"), F.coalesce("items", F.array().cast("array<long>")).alias("items"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.col("n_items").isNotNull().alias("contaminated"),
        F.col("_row").alias("text_tag"),
    )
