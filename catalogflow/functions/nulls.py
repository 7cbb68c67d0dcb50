"""Missing-value rules: null and the scraped sentinel count as one thing."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
SENTINEL = "N/A"
NO_ABSTRACT = "No Abstract"


def col(c):
    return c if isinstance(c, Column) else F.col(c)


def is_missing(c, sentinel=SENTINEL):
    return col(c).isNull() | (col(c) == F.lit(sentinel))


def differs(c, value):
    """``!=`` that keeps null rows (a missing value differs from any value)."""
    return ~col(c).eqNullSafe(F.lit(value))


def matches(c, pattern):
    """Regex test where null is false, so its negation keeps null rows."""
    return F.coalesce(col(c).rlike(pattern), F.lit(False))


def has_text(c, needle):
    return F.coalesce(F.contains(col(c), F.lit(needle)), F.lit(False))
