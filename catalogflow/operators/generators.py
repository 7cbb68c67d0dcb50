"""Issue calendars and the seeded or hashed article picks."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.dates import volume_of_year
from ..functions.nulls import col
from .ordered import SPAN, running_index

# fixed values: constants of the 32-bit generator
STEP = 0x6D2B79F5
MASK = 0xFFFFFFFF
SCALE = 4294967296.0


def _issue_columns(anchors, anchor, days, base):
    df = anchors.select(*[c for c in anchors.columns if c != anchor], F.explode(days).alias("month"))
    year, number = F.year("month"), F.month("month")
    volume = volume_of_year(year)
    return df.select(
        *df.columns,
        year.alias("year"),
        volume.alias("volume"),
        number.alias("issue"),
        F.format_string("%s/%d/%08d/%08d", F.lit(base), year, volume, number).alias("url"),
    )


def issue_calendar(as_of, months, base, anchor="as_of"):
    """The last ``months`` issues, newest first, for each anchor day in a table."""
    start = F.trunc(F.col(anchor), "MM")
    step = F.expr("INTERVAL -1 MONTH")
    days = F.sequence(start, F.add_months(start, 1 - months), step)
    return _issue_columns(as_of, anchor, days, base)


def issue_calendar_since(as_of, start, base, anchor="as_of"):
    """All issues from a fixed first month to the anchor month."""
    days = F.sequence(F.lit(start).cast("date"), F.trunc(F.col(anchor), "MM"), F.expr("INTERVAL 1 MONTH"))
    return _issue_columns(as_of, anchor, days, base)


def issue_index(latest, start_year=2003, base=""):
    """Every issue from January of ``start_year`` to the latest one.

    ``latest`` holds one row (year, issue).
    """
    last = F.make_date(F.col("year"), F.col("issue"), F.lit(1))
    first = F.make_date(F.lit(start_year), F.lit(1), F.lit(1))
    months = latest.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("month"))
    year, number = F.year("month"), F.month("month")
    return months.select(
        "month",
        year.alias("year"),
        number.alias("issue"),
        volume_of_year(year).alias("volume"),
        F.format_string("No. %d, %s", number, F.date_format("month", "MMM yyyy")).alias("label"),
        F.format_string("%s%d%02d.html", F.lit(base), year, number).alias("url"),
    )


def random_pick(df, pool, ident, k=3, seed=0):
    """``k`` rows of each pool in a shuffled order fixed by the seed.

    The shuffle key is a digest of the row's id, so lost tasks re-run to the
    same picks, and each map task forwards at most ``k`` rows per pool.
    """
    draw = F.md5(F.concat_ws(":", F.col(ident).cast("string"), F.lit(str(seed))))
    w = Window.partitionBy(*pool).orderBy("_draw", ident)
    ranked = df.withColumn("_draw", draw).withColumn("pick", F.row_number().over(w))
    return ranked.filter(F.col("pick") <= k).drop("_draw")


def _imul(a, b):
    """Low 32 bits of a product of two unsigned 32-bit values."""
    low = a * b.bitwiseAND(F.lit(0xFFFF))
    high = (a * F.shiftright(b, 16)).bitwiseAND(F.lit(0xFFFF))
    return (low + F.shiftleft(high, 16)).bitwiseAND(F.lit(MASK))


def seeded_draw(n, seed):
    """The n-th (1-based) draw of the generator, as a closed form of ``n``."""
    n, seed = col(n).cast("bigint"), seed if not isinstance(seed, int) else F.lit(seed)
    mask = F.lit(MASK)
    steps = (n.bitwiseAND(mask) * F.lit(STEP & 0xFFFF)) + F.shiftleft(
        (n.bitwiseAND(mask) * F.lit(STEP >> 16)).bitwiseAND(F.lit(0xFFFF)), 16
    )
    state = (seed.cast("bigint") + steps).bitwiseAND(mask)
    t = _imul(state.bitwiseXOR(F.shiftright(state, 15)), state.bitwiseOR(F.lit(1)))
    mixed = _imul(t.bitwiseXOR(F.shiftright(t, 7)), t.bitwiseOR(F.lit(61)))
    t = t.bitwiseXOR((t + mixed).bitwiseAND(mask))
    return t.bitwiseXOR(F.shiftright(t, 14)) / F.lit(SCALE)


def daily_pick(df, pool_rank, seq, k=3, seed=0, span=SPAN):
    """``k`` rows per pool by a seeded shuffle in sequence order.

    ``pool_rank`` is 0 for the first pool, 1 for the second, and so on; each
    pool draws from ``seed`` plus its rank.
    """
    numbered = running_index(df, [pool_rank], seq, "_n", span=span)
    # the draw is computed in a projection of its own, then ranked
    drawn = numbered.withColumn("draw", seeded_draw("_n", F.lit(seed) + F.col(pool_rank)))
    w = Window.partitionBy(pool_rank).orderBy("draw", "_n")
    return drawn.withColumn("pick", F.row_number().over(w)).filter(F.col("pick") <= k).drop("_n")
