"""Fuzzy title joins.

``exclude_issued`` meets a stored index of the issued titles in blocks of near
lengths, where signatures of the letter counts screen all pairs without loss,
and scores only what they leave. ``best_match`` scores
the candidates that share rare words, then visits only those blocks of a group
whose upper bound reaches the best score so far. Neither emits the pairs of a
group.
"""

from difflib import SequenceMatcher
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_title, has_clean_title, squeeze, strip_quotes
from ..session import bucketed, materialize, spread

THRESHOLD = 0.90
MIN_SCORE = 30.0
SHELVES = 10.0  # shelves of title lengths per unit of their logarithm
CROWD = 16384  # titles in one block of a shelf
ITEMS = 16384  # items in one block of a shelf
BLOCK = 1000  # candidates in one block of a group
RARE = 200  # candidates of a group that share a word, at most, for the word to be a probe
HEAD = 32  # candidates of a block that are scored first
TOGETHER = 64  # items of a block that are scored together
PROBES = 3  # rarest words of an item that are looked up
LETTERS = 32  # classes of letters in the bounds
COUNT = 16  # letters of one class that a signature counts
FIRST = 2  # words of a signature, of the classes that vary most, that all pairs of a block compare
PAIRS = 512  # classes of neighbouring letters


# --- fuzzy anti join -------------------------------------------------------
#
# With ratio = 2M/(la+lb) >= t the texts have M letters in common, so the counts
# of their letters differ by la+lb-2M <= (1-t)(la+lb) in sum. Classes of letters
# and counts cut off at a limit differ by no more. Each count is a row of so many
# ones, so the sum is the number of bits in which two such signatures differ. As
# many letters lost or added turn one text into the other, and each changes at
# most three pairs of neighbours, which bounds the difference of their counts. M is
# at most the longest common subsequence, which the last screen takes.


def _edit_bounds(threshold):
    t = Fraction(str(threshold))
    return t.numerator, t.denominator


def _length_band(length, threshold):
    """Shortest and longest title that can reach the threshold."""
    p, q = _edit_bounds(threshold)
    low = F.ceil(length * F.lit(p) / F.lit(2 * q - p) - F.lit(1e-9))
    high = F.floor(length * F.lit(2 * q - p) / F.lit(p) + F.lit(1e-9))
    return low.cast("int"), high.cast("int")


def _shelf(length):
    """Number of a shelf of near lengths."""
    return F.floor(F.log(length) * SHELVES).cast("int")


class TitleIndex(NamedTuple):
    """A stored index of titles.

    titles: (id, title, lb), bucketed by id, the digest of the title.
    blocks: the number of blocks of each shelf of lengths.
    """

    titles: DataFrame
    blocks: dict
    threshold: float


def _title_id(title):
    return F.unhex(F.md5(title))


def _block_numbers(shelved, block):
    """How many blocks of at most about ``block`` rows each shelf takes; a row per shelf, of which there are few."""
    return {r["shelf"]: r["n"] for r in shelved.groupBy("shelf").agg(F.ceil(F.count(F.lit(1)) / block).alias("n")).collect()}


def build_title_index(issued, title="Title", threshold=THRESHOLD, crowd=CROWD, lengths=None):
    """Store the distinct non-empty titles for ``exclude_issued``, at most about ``crowd`` in a block.

    ``lengths``: shortest and longest title that is of use (default: all).
    """
    known = issued.filter(has_clean_title(title)).select(clean_title(title).alias("title"))
    if lengths:
        known = known.filter(F.length("title").between(*lengths))
    known = known.groupBy(_title_id(F.col("title")).alias("id")).agg(F.first("title").alias("title"))
    titles = bucketed(known.select("id", "title", F.length("title").alias("lb")), "id", "titles")
    return TitleIndex(titles, _block_numbers(titles.select(_shelf(F.col("lb")).alias("shelf")), crowd), threshold)


def _signatures(counts, order):
    """Letter counts as rows of ones: (words, texts), ``COUNT`` bits for each class, the classes in the given order."""
    rows = np.left_shift(np.uint64(1), np.minimum(counts[:, order], COUNT).astype(np.uint64)) - np.uint64(1)
    each = 64 // COUNT
    places = np.arange(each, dtype=np.uint64) * np.uint64(COUNT)
    return np.ascontiguousarray(np.bitwise_or.reduce(rows.reshape(len(counts), -1, each) << places, axis=2).T)


def _near(mine, signatures, limits):
    """Places of the signatures that differ from one in no more bits than their limits, the nearest first."""
    apart = np.zeros(signatures.shape[1], np.uint16)
    for word, own in zip(signatures[:FIRST], mine):
        apart += np.bitwise_count(word ^ own)
    at = np.flatnonzero(apart <= limits)
    apart = apart[at]
    for word, own in zip(signatures[FIRST:], mine[FIRST:]):
        apart += np.bitwise_count(word[at] ^ own)
    kept = np.flatnonzero(apart <= limits[at])
    return at[kept[np.argsort(apart[kept], kind="stable")]]


def _pair_counts(texts, step=512):
    """How often each of ``PAIRS`` classes of neighbouring letters occurs, cut off at 255: (texts, classes)."""
    out = np.empty((len(texts), PAIRS), np.uint8)
    for at in range(0, len(texts), step):
        some = texts[at:at + step]
        codes = np.frombuffer("".join(some).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        rows = np.repeat(np.arange(len(some)), [len(t) for t in some])
        kinds = codes[1:] * np.uint64(0x9E3779B97F4A7C15) + codes[:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
        kinds = ((kinds >> np.uint64(32)) % np.uint64(PAIRS)).astype(np.int64)
        inside = rows[1:] == rows[:-1]
        counts = np.bincount(rows[1:][inside] * PAIRS + kinds[inside], minlength=len(some) * PAIRS)
        out[at:at + step] = np.minimum(counts, 255).reshape(len(some), PAIRS)
    return out


def _reaches(a, b, threshold):
    m = SequenceMatcher(None, a, b)
    return m.quick_ratio() >= threshold and m.ratio() >= threshold


def _screened(items, titles, threshold):
    """For each item the places of the titles that may reach the threshold, the nearest first."""
    p, q = _edit_bounds(threshold)
    size = np.array([len(b) for b in titles], np.int64)
    order = np.argsort(size, kind="stable")
    size = size[order]
    placed = [titles[j] for j in order]
    counts = _letter_counts(placed, LETTERS)
    telling = np.argsort(-counts.var(axis=0), kind="stable")
    signatures, own = _signatures(counts, telling), _signatures(_letter_counts(items, LETTERS), telling)
    pairs, own_pairs = _pair_counts(placed), _pair_counts(items)
    for k, a in enumerate(items):
        la = len(a)
        first, last = np.searchsorted(size, [-(-la * p // (2 * q - p)), la * (2 * q - p) // p + 1])
        limits = np.minimum((la + size[first:last]) * (q - p) // q, 20_000).astype(np.uint16)
        found = _near(own[:, k], signatures[:, first:last], limits)
        theirs = pairs[first + found]
        apart = (np.maximum(theirs, own_pairs[k]) - np.minimum(theirs, own_pairs[k])).sum(axis=1, dtype=np.uint32)
        found = found[apart <= 3 * limits[found].astype(np.uint32)]
        masks = _positions(a) if len(found) else None
        yield a, (j for j in order[first + found].tolist()
                  if 2 * q * _common_subsequence(masks, la, titles[j]) >= p * (la + len(titles[j])))


def _similar_in_block(threshold):
    """Items of a block that resemble any title of it; stops at the first."""

    def search(items: pd.DataFrame, titles: pd.DataFrame) -> pd.DataFrame:
        found, texts = [], titles["b"].tolist()
        if len(items) and texts:
            found = [a for a, near in _screened(items["a"].tolist(), texts, threshold)
                     if any(_reaches(a, texts[j], threshold) for j in near)]
        return pd.DataFrame({"a": found}, dtype=object)

    return search


def _pairs_in_block(threshold):
    def search(items: pd.DataFrame, titles: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(items) and len(titles):
            ids = titles["id"].tolist()
            screened = _screened(items["a"].tolist(), titles["b"].tolist(), threshold)
            found = [(i, ids[j]) for i, (_, near) in zip(items["a_id"], screened) for j in near]
        return pd.DataFrame(found, columns=["a_id", "id"], dtype=object)

    return search


def _placed(df, text, own, other, n_own, n_other):
    """One row for each block of the other side in the row's shelf; shelves that one side lacks go."""
    def number(blocks):
        wanted = {k: n for k, n in blocks.items() if k in n_own and k in n_other}
        return F.element_at(F.create_map(*[F.lit(int(x)) for kv in wanted.items() for x in kv]), F.col("shelf")) if wanted else F.lit(None).cast("int")

    here = df.withColumns({"_n": number(n_own), "_m": number(n_other)}).filter("_n is not null")
    here = here.withColumn(own, F.pmod(F.xxhash64(text), F.col("_n")).cast("int"))
    return here.withColumn(other, F.explode(F.sequence(F.lit(0), F.col("_m") - 1))).drop("_n", "_m")


def _searched(items, index, block, search, schema):
    """Meet the items (a_id, a) with the titles of all lengths that can reach the threshold, block by block.

    Blocks hold a bounded number of rows, whatever texts are frequent, and a pair is a row only if ``search`` gives it.
    """
    low, high = _length_band(F.length("a"), index.threshold)
    shelved = items.select("a_id", "a", F.explode(F.sequence(_shelf(F.greatest(low, F.lit(1))), _shelf(high))).alias("shelf"))
    n_items = _block_numbers(shelved, block)
    titles = index.titles.select("id", F.col("title").alias("b"), _shelf(F.col("lb")).alias("shelf"))
    left = _placed(shelved, "a", "i", "j", n_items, index.blocks)
    right = _placed(titles, "b", "j", "i", index.blocks, n_items)
    by = ["shelf", "i", "j"]
    return spread(left, *by).groupBy(*by).cogroup(spread(right, *by).groupBy(*by)).applyInPandas(search(index.threshold), schema)


def candidate_pairs(items, index, block=ITEMS):
    """(a_id, id) of the items (a_id, a), distinct, and titles that pass the screens; no similar pair is missing."""
    return _searched(items, index, block, _pairs_in_block, "a_id binary, id binary")


def similar_titles(items, index, block=ITEMS):
    """Texts ``a`` of the items (a_id, a) with at least one title at or above the threshold."""
    return _searched(items, index, block, _similar_in_block, "a string")


def exclude_issued(items, issued, title, issued_title="Title", threshold=THRESHOLD, crowd=CROWD, block=ITEMS):
    """Items whose title is neither issued nor similar to an issued one.

    ``issued`` is a table or a ``TitleIndex`` that several batches probe. Items
    with an empty title go too; the quote marks of kept titles go.
    """
    keyed = items.filter(has_clean_title(title)).withColumn("_t", clean_title(title)).withColumn("_id", _title_id(F.col("_t")))
    index = issued
    if not isinstance(issued, TitleIndex):
        # an index for these items only holds titles of the lengths that they can match
        p, q = _edit_bounds(threshold)
        size = keyed.agg(F.min(F.length("_t")).alias("low"), F.max(F.length("_t")).alias("high")).first()
        lengths = ((size["low"] or 0) * p // (2 * q - p), -(-(size["high"] or 0) * (2 * q - p) // p))
        index = build_title_index(issued, issued_title, threshold, crowd, lengths)
    known = index.titles.select(F.col("id").alias("_k"), F.col("title").alias("_kt"))
    # digests meet first, and only then the texts are compared
    open_items = keyed.join(known, (F.col("_id") == F.col("_k")) & (F.col("_t") == F.col("_kt")), "left_anti")
    texts = open_items.groupBy(F.col("_id").alias("a_id")).agg(F.first("_t").alias("a"))
    similar = similar_titles(bucketed(texts, "a_id", "items"), index, block).select(_title_id(F.col("a")).alias("_s"))
    kept = open_items.join(similar, F.col("_id") == F.col("_s"), "left_anti")
    return kept.drop("_t", "_id").withColumn(title, strip_quotes(title))


# --- best match inside a group --------------------------------------------


def sorted_tokens(c):
    words = F.filter(F.split(squeeze(c), " "), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def _positions(text):
    """Bit mask of the places of each character."""
    masks = {}
    for i, ch in enumerate(text):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    return masks


def _common_subsequence(masks, width, text):
    """Length of the longest common subsequence by bit-parallel addition."""
    full = row = (1 << width) - 1
    for mask in [masks[ch] for ch in text if ch in masks]:
        hit = row & mask
        row = ((row + hit) | (row - hit)) & full
    return width - row.bit_count()


def token_ratio(a, b, masks=None):
    """100 * 2 * LCS / (la + lb) of two token-sorted strings."""
    if not a and not b:
        return 100.0
    return 200.0 * _common_subsequence(masks or _positions(a), len(a), b) / (len(a) + len(b))


def _encoded(texts):
    """Texts by falling length as small numbers: (number of each letter, for each step the letters of the texts that long)."""
    size = np.array([len(t) for t in texts], np.int64)
    letters, codes = np.unique(np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32), return_inverse=True)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)
    steps = np.split(codes[np.argsort(place, kind="stable")].astype(np.int32), np.cumsum(np.bincount(place))[:-1]) if len(codes) else []
    return {chr(c): k for k, c in enumerate(letters.tolist())}, steps


def _ratios(items, texts, who, chosen):
    """``token_ratio`` of many pairs at once: ``items[who]`` with ``texts[chosen]``, the texts by falling length, ``chosen`` rising.

    texts: (lengths, *_encoded). The rows of ``_common_subsequence`` side by side, in words of 64 bits with a carry.
    """
    size, numbers, steps = texts
    width = np.array([len(t) for t in items], np.int64)
    words = max(-(-int(width.max(initial=0)) // 64), 1)
    low = 2**64 - 1
    table, full = np.zeros((words, len(items), len(numbers)), np.uint64), np.zeros((words, len(items)), np.uint64)
    for k, text in enumerate(items):
        for w in range(words):
            full[w, k] = ((1 << len(text)) - 1) >> (64 * w) & low
        for ch, mask in _positions(text).items():
            if ch in numbers:
                for w in range(words):
                    table[w, k, numbers[ch]] = mask >> (64 * w) & low
    table, base, ones = table.reshape(words, -1), who * len(numbers), full[:, who]
    rows = ones.copy()
    for step, n in zip(steps, np.searchsorted(chosen, [len(step) for step in steps]).tolist()):
        if not n:
            break
        at = base[:n] + step[chosen[:n]]
        carry = None
        for own, row in zip(table, rows):
            v = row[:n]
            hit = v & own[at]
            total = v + hit
            over = total < v
            if carry is not None:
                total += carry
                over |= total < carry
            row[:n] = total | (v - hit)
            carry = over.astype(np.uint64)
    common = width[who] - np.bitwise_count(rows & ones).sum(axis=0, dtype=np.int64)
    total = width[who] + size[chosen]
    return np.where(total == 0, 100.0, 200.0 * common / np.maximum(total, 1))


def _letter_counts(texts, width=64):
    """Letters of each class, one row per text."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32) % width
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts]) * width
    return np.bincount(rows + codes, minlength=len(texts) * width).reshape(len(texts), width).astype(np.int32)


def _profile(batches):
    for pdf in batches:
        counts = _letter_counts(pdf["sorted"], LETTERS)
        yield pdf.assign(letters=list(counts), size=counts.sum(axis=1))


def _profiled(df):
    """Adds the length and the number of letters of each class."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(_profile, f"{kinds}, letters array<int>, size int")


def _words(df):
    return df.select("*", F.explode(F.array_distinct(F.split("sorted", " "))).alias("word")).filter("word <> ''")


def _ordered(texts):
    """Order of texts by falling length, and the texts in it for ``_ratios``."""
    size = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-size, kind="stable")
    return order, (size[order], *_encoded([texts[j] for j in order]))


def _tops(who, scores, names):
    """The best score and the smallest name that has it, for each item that has a pair."""
    best = {}
    for k, score, name in zip(who.tolist(), scores.tolist(), names):
        if k not in best or score > best[k][0] or (score == best[k][0] and name < best[k][1]):
            best[k] = (score, name)
    return best


def _score(batches):
    """Score pairs; of each item the best of the batch goes on."""
    for pdf in batches:
        order, texts = _ordered(pdf["other"].tolist())
        keys = list(zip(pdf["grp"], pdf["sorted"]))
        number = {key: k for k, key in enumerate(dict.fromkeys(keys))}
        items, who = list(number), np.array([number[keys[j]] for j in order], np.int64)
        scores = _ratios([text for _, text in items], texts, who, np.arange(len(order)))
        best = _tops(who, scores, pdf["name"].to_numpy()[order])
        yield pd.DataFrame([(*items[k], *found) for k, found in best.items()], columns=["grp", "sorted", "score", "name"])


def _best(scored):
    best = F.min(F.struct((-F.col("score")).alias("neg"), "name")).alias("_b")
    return scored.groupBy("grp", "sorted").agg(best).select("grp", "sorted", (-F.col("_b.neg")).alias("score"), F.col("_b.name").alias("name"))


def _by_rare_words(wanted, offered, kind):
    """Best candidate among those that share one of an item's rarest words: a score to beat.

    The words of a group are an inverted index; words of more than ``RARE``
    candidates are no probes, so an item meets at most PROBES * RARE candidates.
    """
    words = _words(offered.select("grp", "sorted", "name"))
    counts = words.groupBy("grp", "word").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") <= RARE)
    found = _words(wanted.select("grp", "sorted")).join(counts, ["grp", "word"])
    rarest = F.slice(F.array_sort(F.collect_list(F.struct("df", "word"))), 1, PROBES)
    probes = found.groupBy("grp", "sorted").agg(rarest.alias("few")).select("grp", "sorted", F.explode("few.word").alias("word"))
    index = words.select("grp", "word", F.col("sorted").alias("other"), "name")
    # a pair that meets by several words is scored again, which costs less than a shuffle of its texts
    pairs = spread(probes, "grp", "word", "sorted").join(index, ["grp", "word"]).select("grp", "sorted", "other", "name")
    return _best(pairs.mapInPandas(_score, f"grp {kind}, sorted string, score double, name string"))


def _blocks(offered, block):
    """Candidates in blocks of neighbours: of one group, near lengths and alphabetic order.

    Blocks are cut from a range partitioning, so a group of any size is dealt to
    many tasks and no block has more than ``block`` rows.
    """
    near = F.floor(F.log(F.col("size") + 1) * 8)
    parts = int(offered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = offered.withColumn("near", near).repartitionByRange(parts, "grp", "near", "sorted").sortWithinPartitions("grp", "near", "sorted")
    row = F.monotonically_increasing_id()
    return materialize(dealt.withColumn("block", F.floor(row / F.lit(block))), "blocks")


def _visits(items, blocks):
    """Which blocks can still hold a match at least as good as the item's best: (grp, block, sorted, least).

    M, the common letters, is at most what both have of each class, so a
    block's largest counts and shortest length bound the score of all its rows.
    """
    most = [F.max(F.element_at("letters", i + 1)).alias(f"l{i}") for i in range(LETTERS)]
    limits = blocks.groupBy("grp", "block").agg(F.min("size").alias("low"), F.max("size").alias("high"), *most)
    limits = limits.select(F.col("grp").alias("_grp"), "block", "low", "high", F.array(*[f"l{i}" for i in range(LETTERS)]).alias("most"))
    common = F.aggregate(F.zip_with("letters", "most", lambda x, y: F.least(x, y)), F.lit(0), lambda t, x: t + x)
    m = F.least(common, F.col("size"), F.col("high"))
    bound = F.lit(200.0) * m / F.greatest(F.col("size") + F.greatest(F.col("low"), m), F.lit(1))
    reach = F.when(F.col("size") + F.col("low") == 0, F.lit(100.0)).otherwise(bound) >= F.col("least") - F.lit(1e-9)
    return items.join(limits, (F.col("grp") == F.col("_grp")) & reach).select("grp", "block", "sorted", "least")


def _search_block(items: pd.DataFrame, cands: pd.DataFrame) -> pd.DataFrame:
    """The best candidate of the block for each item, if it reaches the item's least score.

    The candidates with the highest bounds are scored first, the others only
    if their bound reaches the best of these; ``TOGETHER`` items at a time.
    """
    found = []
    if len(items) and len(cands):
        order, texts = _ordered(cands["sorted"].tolist())
        names, size = cands["name"].to_numpy()[order], texts[0]
        counts = _letter_counts(cands["sorted"].to_numpy()[order])
        for begin in range(0, len(items), TOGETHER):
            some = items.iloc[begin:begin + TOGETHER]
            own, least = some["sorted"].tolist(), some["least"].to_numpy() - 1e-9
            bounds = np.stack([np.minimum(counts, mine).sum(axis=1) for mine in _letter_counts(own)])
            total = size + np.array([len(t) for t in own])[:, None]
            bounds = np.where(total == 0, 100.0, 200.0 * bounds / np.maximum(total, 1))
            first = np.zeros(bounds.shape, bool)
            np.put_along_axis(first, np.argsort(-bounds, axis=1, kind="stable")[:, :HEAD], True, axis=1)
            first &= bounds >= least[:, None]
            best, reach = {}, least.copy()
            for pairs in (first, None):
                if pairs is None:
                    pairs = ~first & (bounds >= reach[:, None])
                chosen, who = np.nonzero(pairs.T)
                if not len(who):
                    continue
                scores = _ratios(own, texts, who, chosen)
                np.maximum.at(reach, who, scores - 1e-9)
                high = scores >= reach[who]
                for k, top in _tops(who[high], scores[high], names[chosen[high]]).items():
                    best[k] = min(best.get(k, top), top, key=lambda x: (-x[0], x[1]))
            groups = some["grp"].tolist()
            found += [(groups[k], own[k], *top) for k, top in best.items()]
    return pd.DataFrame(found, columns=["grp", "sorted", "score", "name"])


def best_match(items, candidates, group, item_name, candidate_name, min_score=MIN_SCORE, block=BLOCK,
               candidate_group=None):
    """Best candidate per item inside its group, if it scores high enough.

    Adds ``match`` and ``score``; ties go to the smallest name. An equal token
    string is the best possible match; other items look up their rarest words
    in an index of the group, which gives a score to beat, and then visit only the
    blocks of candidates whose upper bound reaches it. The result is exact.
    """
    kind = items.schema[group].dataType.simpleString()
    wanted = items.filter(F.col(group).isNotNull() & F.col(item_name).isNotNull())
    wanted = wanted.select(F.col(group).alias("grp"), sorted_tokens(item_name).alias("sorted")).distinct()
    offered = candidates.filter(F.col(candidate_group or group).isNotNull() & F.col(candidate_name).isNotNull())
    if min_score > 0:
        # a length ratio beyond ``factor`` cannot reach the least score; the sizes
        # of all items bound the candidates before their tokens are sorted
        factor = (200.0 - min_score) / min_score
        size, plain = F.length("sorted"), F.length(squeeze(candidate_name))
        limits = wanted.agg(F.struct(F.min(size).alias("low"), F.max(size).alias("high")).alias("s")).scalar()
        offered = offered.filter((plain <= limits["high"] * factor + 1e-6) & (plain * factor + 1e-6 >= limits["low"]))
    offered = offered.select(
        F.col(candidate_group or group).alias("grp"), sorted_tokens(candidate_name).alias("sorted"),
        F.col(candidate_name).alias("name")).groupBy("grp", "sorted").agg(F.min("name").alias("name"))
    stored = _blocks(_profiled(offered), block)
    equal = wanted.join(stored.select("grp", "sorted", "name"), ["grp", "sorted"], "left")
    equal = materialize(equal, "wanted")
    done = equal.filter("name is not null").select("grp", "sorted", F.lit(100.0).alias("score"), "name")
    rest = equal.filter("name is null").select("grp", "sorted")
    first = materialize(_by_rare_words(rest, stored, kind), "first")
    known = first.select(F.col("grp").alias("_g"), F.col("sorted").alias("_s"), F.col("score").alias("_score"))
    open_items = rest.join(known, (F.col("grp") == F.col("_g")) & (F.col("sorted") == F.col("_s")), "left")
    least = F.greatest(F.coalesce("_score", F.lit(0.0)), F.lit(float(min_score)))
    # few bytes, but each row meets all blocks of its group
    open_items = spread(open_items.select("grp", "sorted", least.alias("least")), "grp", "sorted")
    met = materialize(_visits(_profiled(open_items), stored), "visits")
    sizes = met.groupBy(F.col("grp").alias("_g"), F.col("block").alias("_b")).agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    same = (F.col("grp") == F.col("_g")) & (F.col("block") == F.col("_b"))
    left = met.join(sizes, same).withColumn("part", F.pmod(F.xxhash64("sorted"), F.col("parts")))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")
    right = stored.join(sizes, same).select("grp", "block", copies, "sorted", "name")
    keys = ["grp", "block", "part"]
    scored = spread(left.select(*keys, "sorted", "least"), *keys).groupBy(*keys).cogroup(
        spread(right, *keys).groupBy(*keys)).applyInPandas(_search_block, f"grp {kind}, sorted string, score double, name string")
    found = _best(scored.unionByName(first.filter(F.col("score") >= min_score)))
    best = done.unionByName(found).select(
        F.col("grp").alias("_g"), F.col("sorted").alias("_c"), F.col("name").alias("match"), "score")
    keyed = items.withColumn("_s", sorted_tokens(item_name))
    return keyed.join(best, (F.col(group) == F.col("_g")) & (F.col("_s") == F.col("_c")), "left").drop("_s", "_g", "_c")
