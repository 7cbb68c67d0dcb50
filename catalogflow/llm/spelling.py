"""Spelling variants: a word's near words (one edit) and the frequent form they lead to.

Words are read as letter multisets, that is, as binary vectors over (letter,
occurrence). One inserted or deleted letter changes one component, a replaced
one two, so near words have a Hamming distance of at most two. The components
are dealt into parts; two vectors at distance two agree on all but two parts,
so each word carries one signature for each pair of parts left out (partition
and enumerate) and near words share a signature. A single edit also leaves one
half of the word as it was; the half is joined to the signature, which keeps
groups of words of the same letters small.
"""

import re
import zlib
from collections import Counter
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from catalogflow.llm.common import slices
from catalogflow.session import materialize, spread

# fixed values: letters of a run, and every how many of the hashes loses a letter
LETTERS = r"a-zÀ-ÿ"
EVERY = 31
PARTS = 4
HELD = 200_000  # words that a counting task holds before it sends them on
PIECE = 4_000_000  # code points of a text that are searched at once
SIGNED = pa.schema([("word", pa.string()), ("n", pa.int64()), ("sig", pa.int64()), ("role", pa.int8())])


# --- counts -----------------------------------------------------------------


def _pieces(text, outside):
    """The text in pieces that end between runs."""
    at = 0
    while len(text) - at > PIECE:
        cut = outside.search(text, at + PIECE)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def _written(word, start):
    """The word as the corpus spells it: every 31st hash of document and word loses one letter."""
    h = zlib.crc32(word.encode(), start)
    if h % EVERY:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _count(least):
    def run(batches):
        runs, outside = re.compile(f"[{LETTERS}]{{{least},}}"), re.compile(f"[^{LETTERS}]")
        held = Counter()

        def flushed():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                             names=["word", "n"])
            held.clear()
            return out

        for batch in slices(batches, "_text"):
            for doc, raw in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist()):
                start = zlib.crc32(f"{doc}:".encode())
                found = Counter()
                for piece in _pieces(raw.lower().decode(), outside):  # bytes: lowers A-Z only
                    found.update(runs.findall(piece))
                for word, n in found.items():
                    word = _written(word, start)
                    if len(word) >= least:
                        held[word] += n
                if len(held) > HELD:
                    yield flushed()
        if held:
            yield flushed()

    return run


def word_counts(docs, least=7, times=2, id_col="doc_id", text_col="text"):
    """word, n: words of at least ``least`` code points that occur at least ``times`` times.

    Words are combined inside the tasks, so a frequent word has few rows.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    counted = rows.mapInArrow(_count(least), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


# --- near words -------------------------------------------------------------


def _hash(text):
    return xxhash.xxh3_64_intdigest(text.encode())


def halves(word):
    """(half, role) of a word: both halves as the shorter or equal word (1) and as the longer one (2) of a pair.

    The shorter word of length n has its first n // 2 letters or its other
    ones untouched; the longer one is cut where that word would be cut.
    """
    n = len(word)
    own = {("<" + word[: n // 2]): 1, (">" + word[n // 2 :]): 1}
    m = n - 1
    for half in ("<" + word[: m // 2], ">" + word[n - (m - m // 2) :]):
        own[half] = own.get(half, 0) | 2
    return own.items()


def _signatures(parts):
    pairs = list(combinations(range(parts), 2))
    mask = (1 << 64) - 1

    def run(batches):
        known, seen = {}, {}

        def hashed(half):
            h = seen.get(half)
            if h is None:
                if len(seen) > HELD:
                    seen.clear()
                h = seen[half] = _hash(half)
            return h

        for batch in batches:
            sigs, roles, which = [], [], []
            for i, word in enumerate(batch.column("word").to_pylist()):
                at, sums = Counter(), [0] * parts
                for ch in word:
                    k = at[ch]
                    at[ch] = k + 1
                    found = known.get((ch, k))
                    if found is None:
                        if len(known) > HELD:
                            known.clear()
                        h = _hash(f"{ch}{k}")
                        found = known[ch, k] = (h % parts, h)
                    sums[found[0]] += found[1]
                total = sum(sums)
                ends = [(hashed(half), role) for half, role in halves(word)]
                for j, (a, b) in enumerate(pairs):
                    left = (total - sums[a] - sums[b]) * 0x9E3779B97F4A7C15 + j * 0xC2B2AE3D27D4EB4F
                    for half, role in ends:
                        sigs.append((left ^ half) & mask)
                        roles.append(role)
                        which.append(i)
            index = pa.array(which, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("word").take(index), batch.column("n").take(index),
                 pa.array(sigs, pa.uint64()).view(pa.int64()), pa.array(roles, pa.int8())], schema=SIGNED)

    return run


def near_words(words, parts=PARTS):
    """Pairs (a, na, b, nb) of words that differ by one inserted, deleted or replaced code point.

    Each pair once, the shorter or else smaller word first. The signatures are
    shuffled once; pairs are verified inside the join, so only near ones leave it.
    """
    signed = spread(words, "word").mapInArrow(_signatures(parts), "word string, n long, sig long, role byte")
    a = signed.select(F.col("word").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"), F.col("role").alias("ra"))
    b = signed.select(F.col("word").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"), F.col("role").alias("rb"))
    la, lb = F.length("a"), F.length("b")
    # the roles are tested with the lengths of both words, so both sides read one shuffle
    fits = F.when(lb == la, (F.col("a") < F.col("b")) & (F.col("ra").bitwiseAND(F.col("rb")).bitwiseAND(F.lit(1)) == 1)).when(
        lb == la + 1, (F.col("ra").bitwiseAND(F.lit(1)) == 1) & (F.col("rb").bitwiseAND(F.lit(2)) == 2)).otherwise(F.lit(False))
    one = F.when(fits, F.levenshtein("a", "b", 1) == 1).otherwise(F.lit(False))
    pairs = a.join(b, (F.col("sa") == F.col("sb")) & one)
    return pairs.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"))


def _roots(forms):
    """word, root: where the chain of forms from each word ends.

    A form is at least ten times as frequent, so a chain has at most 18 steps;
    each round doubles the steps that a row has followed.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = now.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        step = now.join(ahead, F.col("root") == F.col("_word"), "left").select(
            "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("_moved"))
        step = materialize(step, "forms")
        if step.filter("_moved").isEmpty():
            return step.drop("_moved")
        now = step.drop("_moved")


def variants(docs, least=7, times=2, factor=10, parts=PARTS, id_col="doc_id", text_col="text"):
    """One row per word: word, form, root, n, n_near, form_n.

    The form is the near word of largest n (of equal ones the smallest in code
    point order) if that is at least ``factor`` times the word's n; the root is
    where the forms lead. A null text has no words, a null id reads as an empty
    string; repeated rows count as often as they come. An empty table gives no
    rows. Texts of any length are read whole, in pieces that end between words.
    Other columns are left out, so none of them can clash.
    """
    words = materialize(word_counts(docs, least, times, id_col, text_col), "words")
    pairs = near_words(words, parts)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("m")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("m")))).alias("p")).select("p.*")
    best = both.groupBy(F.col("word").alias("_word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    joined = words.join(best, F.col("word") == F.col("_word"), "left")
    is_form = -F.col("best.m") >= factor * F.col("n")
    formed = materialize(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n")), "formed")
    roots = _roots(formed.filter("form is not null")).select(F.col("word").alias("_word"), F.col("root").alias("_root"))
    out = formed.join(roots, F.col("word") == F.col("_word"), "left")
    return out.select("word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")
