"""Numbers, years, issue keys and issue dates as Column expressions."""

import calendar
import datetime as dt

from pyspark.sql import functions as F

from .nulls import col, is_missing
from .text import strip

# fixed values: patterns and formats of the exchanged data
FIRST_YEAR = 1934
NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
ISSUE_PATH = r"/(\d{4})/000000(\d+)/000000(\d+)"
ISSUE_FOLDER = r"/(\d{4})/\d+/(\d+)/"
MONTH_YEAR = "MMMM yyyy"
ONLINE_FORMATS = ("MMMM d, yyyy", "MMM d, yyyy", "yyyy-MM-dd", "MM/dd/yyyy")


def _cast(c, kind):
    return c.try_cast(kind)


def as_double(c):
    """Plain decimal text to double, anything else to null."""
    text = strip(col(c).cast("string"))
    return F.when(text.rlike(NUMBER), _cast(text, "double"))


def as_whole(c):
    return _cast(as_double(c), "bigint")


def two_digits(n):
    return F.format_string("%02d", n)


def normalize_volume(c):
    return F.coalesce(as_whole(c).cast("string"), strip(col(c).cast("string")))


def normalize_issue(c):
    n = as_whole(c)
    return F.when(n.isNotNull(), two_digits(n)).otherwise(F.coalesce(strip(col(c).cast("string")), F.lit("")))


def normalize_year(c):
    """Year text of a number-like column; use ``year_of_date`` for dates."""
    text = strip(col(c).cast("string"))
    return F.coalesce(as_whole(c).cast("string"), F.regexp_replace(text, r"\.0$", ""), F.lit(""))


def year_of_date(c):
    return F.coalesce(F.year(col(c)).cast("string"), F.lit(""))


def volume_of_year(year):
    return col(year) - F.lit(FIRST_YEAR)


def pub_date(c):
    return F.date_format(col(c), MONTH_YEAR)


def issue_key(year, issue):
    year, issue = col(year), col(issue)
    return F.when((year != "") & (issue != ""), F.concat(year, issue)).otherwise(F.lit(""))


def _key_forms(text):
    """(pattern, key) pairs of the stored key spellings, best first."""
    dotted = r"^(\d{4})\.(\d{1,3})$"
    return [
        (r"^\d{6}$", text),
        (r"^\d{6}\.0+$", F.substring(text, 1, 6)),
        (dotted, F.concat(
            F.regexp_extract(text, dotted, 1),
            two_digits(_cast(F.regexp_extract(text, dotted, 2), "int")),
        )),
    ]


def canonical_issue_key(c):
    """Repair drifted keys (``202604.0``, ``2026.006``) to ``yyyyMM``."""
    text = strip(col(c).cast("string"))
    number = as_double(c)
    whole = _cast(number, "bigint")
    out = None
    for pattern, key in _key_forms(text):
        out = F.when(text.rlike(pattern), key) if out is None else out.when(text.rlike(pattern), key)
    out = out.when((number == whole) & whole.cast("string").rlike(r"^\d{6}$"), whole.cast("string"))
    return F.coalesce(out.otherwise(text), F.lit(""))


def key_from_url(url, pattern=ISSUE_PATH):
    year = F.regexp_extract(col(url), pattern, 1)
    number = _cast(F.regexp_extract(col(url), pattern, 3), "bigint")
    return F.when(year != "", F.concat(year, two_digits(number)))


def page_issue_key(key, url, variant="strict"):
    """Issue key of a row: from the key column, else from the link, else null."""
    if variant == "strip":
        return F.coalesce(F.regexp_replace(col(key).cast("string"), r"\.0$", ""), key_from_url(url))
    text = strip(col(key).cast("string"))
    out = None
    for pattern, value in _key_forms(text):
        out = F.when(text.rlike(pattern), value) if out is None else out.when(text.rlike(pattern), value)
    return F.coalesce(out, key_from_url(url))


def first_of_month(key):
    return F.try_to_date(F.concat(col(key), F.lit("01")), "yyyyMMdd")


def issue_date(key, url, host=None, folder=ISSUE_FOLDER, strict=False):
    """First day of the issue month from the key, else from the link.

    ``host`` restricts the link rule to links naming it. A six-digit key with
    an impossible month raises with ``strict``, else the link decides.
    """
    canonical = canonical_issue_key(key)
    six = canonical.rlike(r"^\d{6}$")
    from_key = F.when(six, first_of_month(canonical))
    number = _cast(F.regexp_extract(col(url), folder, 2), "int")
    from_url = F.when(
        number.between(1, 12),
        first_of_month(F.concat(F.regexp_extract(col(url), folder, 1), two_digits(number))),
    )
    if host:
        from_url = F.when(F.contains(col(url), F.lit(host)), from_url)
    if strict:
        bad = F.raise_error(F.concat(F.lit("impossible issue key "), canonical)).cast("date")
        from_key = F.when(six, F.coalesce(from_key, bad))
    return F.coalesce(from_key, from_url)


def date_from_url(url, pattern=ISSUE_PATH):
    """``Month yyyy`` of a link, with labels for unknown months and links."""
    year = F.regexp_extract(col(url), pattern, 1)
    number = _cast(F.regexp_extract(col(url), pattern, 3), "bigint")
    day = F.try_to_date(F.concat(F.lit("2000"), two_digits(number), F.lit("01")), "yyyyMMdd")
    month = F.when(number.between(1, 12), F.date_format(day, "MMMM"))
    known = F.concat(F.coalesce(month, F.lit("Unknown")), F.lit(" "), year)
    return F.coalesce(F.when(year != "", known), F.lit("Unknown Date"))


def display_date(published, url, issue_day=None):
    parts = [F.when(~is_missing(published), col(published))]
    if issue_day is not None:
        parts.append(pub_date(issue_day))
    return F.coalesce(*parts, date_from_url(url))


def parse_online_date(c, formats=ONLINE_FORMATS):
    text = strip(c)
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def month_abbreviation(c):
    return F.date_format(col(c), "MMM")


def issue_display(issue):
    digits = F.regexp_replace(col(issue), "^0+", "")
    digits = F.when(digits == "", F.lit("0")).otherwise(digits)
    return F.coalesce(as_whole(digits).cast("string"), col(issue))


def month_word(published):
    return F.substring_index(col(published), " ", 1)


def day_seed(c):
    return F.year(col(c)) * 1000 + F.dayofyear(col(c))


def shift_months(moment, months):
    """``moment`` moved by whole months, clamped to the month end.

    Runs on the driver so that the cutoff reaches the scan as a literal.
    """
    index = moment.year * 12 + moment.month - 1 + months
    year, month = divmod(index, 12)
    day = min(moment.day, calendar.monthrange(year, month + 1)[1])
    return moment.replace(year=year, month=month + 1, day=day)


def shift_days(moment, days):
    return moment + dt.timedelta(days=days)


def moment_like(df, column, moment):
    """A literal of the column's own timestamp type, so that the comparison
    needs no cast of the column and reaches the scan."""
    if isinstance(column, str) and column in df.columns:
        kind = df.schema[column].dataType.simpleString()
        if kind == "timestamp_ntz":
            return F.lit(moment.isoformat(sep=" ")).cast(kind)
    return F.lit(moment)
