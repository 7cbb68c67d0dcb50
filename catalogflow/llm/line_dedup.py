"""Line dedup by a segment-partition edit join, in DataFrame functions only.

A line is cut into threshold + 1 segments, at places that all lengths of a class
share. Two lines within the threshold share a segment at places whose shift the
segment's number bounds, so a line's substrings at those places probe an index
of segments by class of length. What meets is verified by a banded bit-parallel
edit distance. A segment that many
distinct lines hold is crowded: its lines bring character and bigram parities,
and only pairs whose parities allow so few edits leave the join.
"""

import numpy as np
from pyspark.sql import functions as F

from catalogflow.llm.common import LAST_ID, packed
from catalogflow.session import materialize

DISTANCE, SHORTEST = 2, 20
CROWD, FILTER_BITS = 16, 2**18
PAD = "￿"


def _let(value, then):
    """Evaluate a column once and use it several times."""
    return F.transform(F.array(value), then)[0]


def _trimmed(a, b):
    """Both strings without their common beginning and end, found by halving steps."""

    def common(x, y):
        steps = F.array(*[F.lit(2**i) for i in range(20, -1, -1)])
        room = F.least(F.length(x), F.length(y))
        # long common parts take several of the largest steps
        steps = F.concat(F.array_repeat(F.lit(2**20), F.floor(room / F.lit(2**20)).cast("int")), steps)
        return F.aggregate(steps, F.lit(0), lambda n, s: F.when(
            (n + s <= room) & (x.substr(n + 1, s) == y.substr(n + 1, s)), n + s).otherwise(n))

    return _let(common(a, b), lambda head: _let(
        F.struct(a.substr(head + 1, F.length(a)).alias("x"), b.substr(head + 1, F.length(b)).alias("y")), lambda r:
        _let(common(F.reverse(r["x"]), F.reverse(r["y"])), lambda tail: F.struct(
            r["x"].substr(F.lit(1), F.length(r["x"]) - tail).alias("x"),
            r["y"].substr(F.lit(1), F.length(r["y"]) - tail).alias("y")))))


def _within(a, b, most, part=48):
    """The distance if it is at most ``most``, else null or more.

    Lines that agree within ``most`` edits agree within twice as many in their
    first characters, so most others are left after a short comparison.
    """
    return _let(_trimmed(a, b), lambda r: F.when(
        F.levenshtein(r["x"].substr(1, part), r["y"].substr(1, part), 2 * most) >= 0,
        banded_distance(r["x"], r["y"], most)))


def banded_distance(a, b, most):
    """Edit distance of two strings whose lengths differ by at most ``most``; any larger value means more.

    Bit vectors of 2 * most + 2 places slide along the diagonal (Hyyrö's banded
    form of Myers' algorithm); one step of ``aggregate`` per character.
    """
    width = 2 * most + 2
    full, top, next_top = 2**width - 1, 2 ** (width - 1), 2 ** (width - 2)

    def chars(x):
        # an equal end of threshold + 1 signs changes no distance and keeps the first text long enough
        return F.split(F.concat(x, F.lit(PAD * (most + 1))), "")

    def run(x, y):
        def mask(i):
            bits = [F.when(F.get(x, i + (k - most)) == F.get(y, i), F.lit(2 ** (width - 1 - 2 * most + k))).otherwise(F.lit(0))
                    for k in range(2 * most + 1)]
            return F.struct(sum(bits[1:], bits[0]).cast("long").alias("m"), i.alias("i"))

        def flipped(v):
            return F.lit(full).cast("long").bitwiseXOR(v)

        def step(s, at):
            m, vp, vn = at["m"], s["vp"], s["vn"]
            d0 = ((m.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(m).bitwiseOR(vn).bitwiseAND(F.lit(full).cast("long"))

            def rest(d):
                hp = vn.bitwiseOR(flipped(d.bitwiseOR(vp)))
                hn = d.bitwiseAND(vp)
                down = F.shiftrightunsigned(d, 1)
                over = at["i"] - (F.size(x) - most)  # below 0: along the diagonal, then along the last row
                edge = F.expr(f"shiftright({next_top}L, 0)")
                place = F.when(over >= 0, F.call_function("shiftrightunsigned", edge, over.cast("int"))).otherwise(F.lit(0))
                dist = F.when(over < 0, s["dist"] + F.when(d.bitwiseAND(F.lit(top).cast("long")) == 0, 1).otherwise(0)).otherwise(
                    s["dist"] + F.when(hp.bitwiseAND(place) != 0, 1).otherwise(0) - F.when(hn.bitwiseAND(place) != 0, 1).otherwise(0))
                return F.struct(hn.bitwiseOR(flipped(down.bitwiseOR(hp))).bitwiseAND(F.lit(full).cast("long")).alias("vp"),
                                down.bitwiseAND(hp).alias("vn"), dist.cast("int").alias("dist"))

            return _let(d0, rest)

        first = F.struct(F.lit(((2 ** (most + 1) - 1) << (width - most - 1)) & full).cast("long").alias("vp"),
                         F.lit(0).cast("long").alias("vn"), F.lit(most).cast("int").alias("dist"))
        masks = F.transform(F.sequence(F.lit(0), F.size(y) - 1), mask)
        return F.aggregate(masks, first, step, lambda s: s["dist"])

    return _let(F.struct(chars(a).alias("x"), chars(b).alias("y")), lambda c: run(c["x"], c["y"]))


def _steps(most):
    """Where a line is cut, as (segment, shift, ahead, right, times, plus); see ``_keyed``.

    ``_keyed`` cuts most + 1 segments of equal size, segment i with room for
    m = min(i, most - i) more characters. The left half is counted from the
    beginning of the line, the right half from its end.
    """
    room = [min(i, most - i) for i in range(most + 1)]
    steps = []
    for i, m in enumerate(room):
        right = i > most - i
        for shift in range(m + 1):
            plus = shift + sum(room[:i]) if not right else -(shift + sum(room[i + 1 :]))
            steps += [(i, shift, ahead, right, i if not right else i - most - 1, plus) for ahead in (0, most)]
    return steps


def _least_length(most):
    """The shortest line with a character in every segment."""
    return sum(min(i, most - i) for i in range(most + 1)) + most + 1


def _class(chars, most, shortest):
    """The least length of a line that shares the cuts of lines of this length.

    Lengths with the same three leading bits form a class; lines that ``most``
    more characters would lift into the next class take part there too.
    """
    low = F.greatest(F.length(F.bin(chars)) - 3, F.lit(max(2, (most - 1).bit_length())))
    step = F.call_function("shiftleft", F.lit(1), low)
    return F.greatest(chars - chars % step - F.lit(most), F.lit(shortest)).cast("int")


def _keyed(line, most, shortest):
    """One row per line, class and step: its place, length, key and shift.

    Two lines within ``most`` edits meet in a class. Let i be the first segment
    of one of them up to whose end at most i edits lie. Then exactly i edits
    lie before it, none in it and at most most - i after it, so the other line
    holds it moved by at most i, counted from the beginning, and by at most
    most - i, counted from the end. The room of a segment lets either line be
    the one that probes with its moved substring, so moves in one direction do.
    The steps are rows, so that one small expression serves them all.
    """
    names = ("i", "shift", "ahead", "right", "times", "plus")
    steps = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, step)]) for step in _steps(most)])
    own, lifted = _class(F.col("chars"), most, shortest), _class(F.col("chars") + F.lit(most), most, shortest)
    each = line.select(*PLACE, "line", "chars", own.alias("own"), lifted.alias("lifted")).select("*", F.explode(steps).alias("s"))
    each = each.filter((F.col("s.ahead") == 0) | (F.col("own") != F.col("lifted")))
    least = F.when(F.col("s.ahead") == 0, F.col("own")).otherwise(F.col("lifted"))
    each = each.select(*PLACE, "line", "chars", "s", least.alias("least"), F.floor(
        (F.col("least") - F.lit(_least_length(most) - most - 1)) / F.lit(most + 1)).cast("int").alias("size"))
    at = F.when(F.col("s.right"), F.col("chars")).otherwise(0) + F.col("s.times") * F.col("size") + F.col("s.plus") + 1
    # 48 bits: what meets by chance is verified
    key = F.shiftrightunsigned(F.xxhash64("least", "s.i", F.col("line").substr(at.cast("int"), F.col("size"))), 16)
    return each.select(*PLACE, "line", "chars", key.alias("key"), F.col("s.shift").alias("shift"))


def _parities(line):
    """For each of 64 classes whether a line holds an odd number of its characters; the same of its bigrams."""

    def odd(hashes):
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda bits, h: bits.bitwiseXOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))))

    return _let(F.split(line, ""), lambda c: F.struct(
        odd(F.transform(c, lambda x: F.xxhash64(x))).alias("one"),
        odd(F.transform(F.sequence(F.lit(1), F.size(c) - 1), lambda i: F.xxhash64(F.get(c, i - 1), F.get(c, i)))).alias("two")))


def _alike(a, b, most):
    """Whether parities allow ``most`` edits: an edit changes at most two characters and four bigrams."""
    return (F.bit_count(a["one"].bitwiseXOR(b["one"])) <= 2 * most) & (F.bit_count(a["two"].bitwiseXOR(b["two"])) <= 4 * most)


def _crowded(rows, crowd, most, shortest, bits=FILTER_BITS):
    """A test for segments of different lines in more than ``crowd`` places; it may also hold for others.

    Counts meet in the map tasks and no text is shuffled. A bitmap of fixed
    size, whatever the number of segments, goes to the tasks.
    """
    lines = rows.select(*ROW, F.posexplode(F.split("_text", "\n", -1)).alias("no", "line")).withColumn("chars", F.length("line"))
    held = _keyed(lines.filter(F.col("chars") >= shortest), most, shortest).filter("shift = 0").select("key", F.hash("line").alias("line"))
    counts = held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("low"), F.max("line").alias("high"))
    many = counts.filter((F.col("n") > crowd) & (F.col("low") < F.col("high"))).select(F.pmod("key", F.lit(bits)).alias("at"))
    words = many.groupBy(F.floor(F.col("at") / 64).cast("int").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))).alias("bits"))
    table = np.zeros(bits // 64, np.int64)
    for w, found in materialize(words, "crowded").collect():
        table[w] = found
    words = F.split(F.lit(" ".join(map(str, table.tolist()))), " ").cast("array<long>")  # folded to one literal

    def test(key):
        at = F.pmod(key, F.lit(bits))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
        return F.get(words, F.floor(at / 64).cast("int")).bitwiseAND(bit) != 0

    return test if table.any() else lambda key: F.lit(False)


ROW = ["_id", "_row"]
PLACE = [*ROW, "no"]


def text_tag(text):
    """A number of 16 bits that tells texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit(0xFFFF))


def line_table(docs, shortest=SHORTEST, id_col="doc_id", text_col="text"):
    """(rows, lines): the texts by row, and (_id, _row, no, h), the MD5 of each line."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"),
        text_tag(text).alias("_row"), text.alias("_text"))
    lines = rows.select(*ROW, F.posexplode(F.split("_text", "\n", -1)).alias("no", "line"))
    return rows, lines.filter(F.length("line") >= shortest).select(*PLACE, F.unhex(F.md5("line")).alias("h"))


def _at(rows, places):
    """The lines at given places, as (place columns, line, other columns of ``places``).

    Places are gathered per row first, so the texts are shuffled by row only;
    every use of the texts shares that one shuffle.
    """
    more = [c for c in places.columns if c not in PLACE]
    per_row = places.groupBy(*ROW).agg(F.collect_list(F.struct("no", *more)).alias("_at"))
    # the lines are taken out before rows multiply
    taken = F.transform(F.array(F.split("_text", "\n", -1)), lambda lines: F.transform("_at", lambda p: F.struct(
        p.alias("p"), F.get(lines, p["no"]).alias("line"))))[0]
    joined = rows.join(per_row.hint("merge"), ROW).select(*ROW, F.explode(taken).alias("_l"))
    return joined.select(*ROW, "_l.p.no", "_l.line", *[F.col(f"_l.p.{c}") for c in more])


def similar_lines(docs, most=DISTANCE, shortest=SHORTEST, id_col="doc_id", text_col="text", crowd=CROWD):
    """Distinct lines and links between them: (places, links).

    places: (h, first, n), the first place (_id, _row, no) that holds the line
    and the number of its places;
    links: (place, other, distance) for every ordered pair of distinct lines
    within ``most`` edits, named by their first places. Lines of fewer than
    ``shortest`` code points (at least ``_least_length(most)``) are left out. Copies meet in the map tasks.
    Segments in more than ``crowd`` places are screened inside the join;
    the links are the same for any ``crowd``.
    """
    shortest = max(shortest, _least_length(most))
    rows, lines = line_table(docs, shortest, id_col, text_col)
    places = lines.groupBy("h").agg(F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("n"))
    line = _at(rows, places.select("first.*")).withColumn("chars", F.length("line"))
    crowded = _crowded(rows, crowd, most, shortest)
    keyed = _keyed(line, most, shortest).withColumn("odd", F.when(crowded(F.col("key")), _parities(F.col("line")))).drop("line")
    # the same columns under other names, so that both sides share one shuffle
    left, right = (keyed.select(*[F.col(c).alias(c + side) for c in keyed.columns]) for side in ("_a", "_b"))
    place, other = (F.struct(*[F.col(c + side).alias(c) for c in PLACE]) for side in ("_a", "_b"))
    met = left.join(right, F.col("key_a") == F.col("key_b")).filter(
        (place < other) & (F.least("shift_a", "shift_b") == 0) & (F.abs(F.col("chars_a") - F.col("chars_b")) <= most)).filter(
        F.col("odd_a").isNull() | _alike(F.col("odd_a"), F.col("odd_b"), most))
    pairs = met.select(place.alias("place"), other.alias("other")).distinct().select("place.*", "other")
    one = _at(rows, pairs).select(F.struct(*PLACE).alias("place"), F.col("line").alias("text"), "other.*")
    both = _at(rows, one).select("place", F.struct(*PLACE).alias("other"), _within(
        F.col("text"), F.col("line"), most).alias("distance"))
    close = both.filter(F.col("distance") <= most).distinct()
    each = [F.struct(F.col(a).alias("place"), F.col(b).alias("other"), "distance") for a, b in (("place", "other"), ("other", "place"))]
    return places, close.select(F.explode(F.array(*each)).alias("l")).select("l.*")


def _verdicts(docs, most, shortest, id_col, text_col, crowd):
    """(rows, per_row): the texts by row, and the numbers of the lines that go and the links of each row that has any."""
    rows, lines = line_table(docs, max(shortest, _least_length(most)), id_col, text_col)
    places, links = similar_lines(docs, most, shortest, id_col, text_col, crowd)
    earlier = links.groupBy(F.col("place").alias("first")).agg(F.min("other").alias("there"), F.count(F.lit(1)).alias("links"))
    verdict = places.join(earlier, "first", "left").filter("n > 1 or links > 0").select(
        "h", F.least("first", "there").alias("least"), "links")
    marked = lines.join(verdict, "h").withColumn("gone", F.col("least") < F.struct(*PLACE))
    per_row = marked.filter("gone or links > 0").select(*PLACE, "gone", "links").distinct().groupBy(*ROW).agg(
        F.collect_set(F.when(F.col("gone"), F.col("no"))).alias("gone"), F.sum("links").alias("n_links"))
    return rows, per_row


def _kept(text, gone):
    """The text without the lines of these numbers."""
    return _let(F.split(text, "\n", -1), lambda all_: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(all_) - 1), gone), lambda i: F.get(all_, i)), "\n"))


def without_repeated_lines(docs, most=DISTANCE, shortest=SHORTEST, id_col="doc_id", text_col="text", chars_col="n_chars", crowd=CROWD):
    """The rows of ``docs`` with all columns; the lines that ``dedup_lines`` removes are gone from the texts.

    ``chars_col`` follows the texts that changed. The rows are shuffled once, with the line numbers.
    """
    _, per_row = _verdicts(docs, most, shortest, id_col, text_col, crowd)
    own, text = F.col(f"row.`{id_col}`"), F.col(f"row.`{text_col}`")
    rows = packed(docs).select("row", F.coalesce(own.cast("long"), F.lit(LAST_ID)).alias("_id"), text_tag(text).alias("_row"))
    joined = rows.join(per_row.filter(F.size("gone") > 0).hint("merge"), ROW, "left")
    changed = F.col("gone").isNotNull()
    # computed once, and only where lines go
    joined = joined.withColumn("kept", F.when(changed, _kept(text, F.col("gone"))))
    row = F.col("row").withField(f"`{text_col}`", F.coalesce("kept", text)).withField(
        f"`{chars_col}`", F.when(changed, F.length("kept").cast("long")).otherwise(F.col(f"row.`{chars_col}`")))
    return joined.select(row.alias("row")).select("row.*")


def dedup_lines(docs, most=DISTANCE, shortest=SHORTEST, id_col="doc_id", text_col="text", crowd=CROWD):
    """Remove each line that comes again: a line within ``most`` edits of one at an earlier place.

    Places are ordered by id, then line number; ``text_tag`` (of the input text,
    see ``text_tag``) tells rows of one id apart. Lines are what stands between
    line feeds; lines of fewer than ``shortest`` code points always stay. They
    are judged on the input. Returns one row per input row: doc_id, n_lines,
    n_removed, n_links (links of its lines to other distinct lines) and
    kept_text. A null text is empty (one empty line); a null id counts as the
    largest; rows with an equal id and text share their places, so they do not
    remove each other's lines.
    """
    rows, per_row = _verdicts(docs, most, shortest, id_col, text_col, crowd)
    out = rows.join(per_row.hint("merge"), ROW, "left").withColumns({
        "gone": F.coalesce("gone", F.array().cast("array<int>")), "all": F.split("_text", "\n", -1)})
    places_kept = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), F.col("gone"))
    kept = F.transform(places_kept, lambda i: F.get("all", i))
    return out.select(
        F.when(F.col("_id") != LAST_ID, F.col("_id")).alias("doc_id"), F.size("all").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.size("gone") > 0, F.array_join(kept, "\n")).otherwise(F.col("_text")).alias("kept_text"),
        F.col("_row").alias("text_tag"),
    )
