"""Declared schemas. Nothing in this package infers a schema from data."""

from pyspark.sql import types as T


def _struct(spec):
    kinds = {
        "s": T.StringType(),
        "i": T.IntegerType(),
        "l": T.LongType(),
        "d": T.DateType(),
        "t": T.TimestampType(),
        "b": T.BinaryType(),
    }
    return T.StructType([T.StructField(name, kinds[kind], True) for name, kind in spec])


def _strings(*names):
    return _struct([(n, "s") for n in names])


# --- fixed values: column names of the exchanged files ---
RAW_METADATA = _struct([
    ("Title", "s"), ("Authors", "s"), ("Article Category", "s"), ("Date MMDDYY", "d"),
    ("Issue Number", "s"), ("Volume", "s"), ("Page Numbers", "s"), ("Access Status", "s"),
    ("DOI", "s"), ("Abstract", "s"), ("Graphical Abstract", "s"),
])
LEGACY_CATALOG = _strings("Title", "Authors", "Pages", "Access", "URL", "Abstract")
CATALOG = _struct(
    [(n, "s") for n in (
        "Title", "Authors", "Pages", "Access", "URL", "Abstract", "PubDate", "Year",
        "Volume", "Issue", "IssueKey", "GA_Link", "Category", "GA_Path",
    )]
    + [("ingest_seq", "l")]
)
FAST_TRACK = _strings("Title", "Date", "Link", "Access Status")
AFFILIATED = _strings("Title", "Authors", "Affiliations", "URL", "Abstract")
USAGE = _struct(
    [(n, "s") for n in (
        "Month", "Item Title", "Item Type", "DOI", "Parent Title", "Parent Type",
        "Proprietary ID", "ISSN", "e-ISSN", "ISBN", "e-ISBN",
    )]
    + [("Year", "i"), ("Volume", "i"), ("Issue", "i")]
    + [(n, "l") for n in (
        "Total Downloads", "Article Downloads", "Preprint Downloads", "PDF Downloads",
        "HTML Downloads", "Subscriber Downloads", "Free Downloads", "Open Access Downloads",
        "Free Trial", "Total Abstract Views", "Article Abstract Views", "Preprint Abstract Views",
    )]
    + [("Publisher", "s")]
)
JOURNAL = _strings("Journal Title", "Publisher Name", "Link to Journal")
JOURNAL_DETAIL = _strings(
    "Journal Title", "Publisher Name", "Link to Journal", "Print ISSN", "Online ISSN", "Latest Issue"
)
CITATIONS = _struct([("doi", "s"), ("title", "s"), ("citations", "i")])
MANIFEST = _struct([("filename", "s"), ("size_bytes", "l"), ("ts", "t")])
STATE = _struct([("filename", "s"), ("size_bytes", "l")])
SEEN = _strings("key")
PAGES = _strings("url", "html")
RUN_LOG = _struct([("file", "s"), ("line_no", "l"), ("line", "s")])
# --- end of fixed values ---
