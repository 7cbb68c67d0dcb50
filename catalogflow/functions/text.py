"""String expressions (Column -> Column), all evaluated in the JVM except
``decompose``. ``(?U)`` makes Java character classes Unicode-aware."""

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .nulls import SENTINEL, col

# fixed values: patterns and labels of the exchanged data
DOI_PREFIX = r"(?iU)^(?:https?://(?:dx\.)?doi\.org/|doi\.org/|doi:)\s*"
DOI_ROOT = "https://doi.org/"
DOI_HOST = "doi.org"
OPEN_LABEL = "Open Access content"
MEMBER_LABEL = "Subscribed content"
SHARE_LINK_ID = r"/d/([^/]+)/"
LONG_DATE = "MMMM d, yyyy"
# white space by the Unicode rules, the plain blank first
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c):
    """Trim all Unicode white space; looks at the ends of the text only."""
    return F.btrim(col(c), F.lit(WHITE_SPACE))


def squeeze(c):
    """Trim and turn each run of white space into one blank."""
    return strip(F.regexp_replace(col(c), r"(?U)[\s\x1c-\x1f]+", " "))


def normalize_doi(c):
    bare = strip(F.regexp_replace(strip(c), DOI_PREFIX, ""))
    return F.coalesce(F.regexp_replace(bare, "/+$", ""), F.lit(""))


def doi_url(c, normalize=True):
    doi = normalize_doi(c) if normalize else F.coalesce(col(c), F.lit(""))
    return F.when(doi != "", F.concat(F.lit(DOI_ROOT), doi)).otherwise(F.lit(""))


def extract_doi(url):
    url = col(url)
    return F.when(F.contains(url, F.lit(DOI_HOST)), strip(F.substring_index(url, DOI_HOST + "/", -1)))


def clean_authors(c):
    """Drop footnote numbers after names; a null list stays null."""
    out = F.regexp_replace(col(c), r"(?U)\s*\d+\s*[;,]", ";")
    out = F.regexp_replace(out, r"(?U)\s*\d+\s*$", "")
    return strip(F.regexp_replace(out, ";;+", ";"))


def author_names(c, separator=";"):
    """Ordered array of the non-empty names of a separated list."""
    names = F.transform(F.split(col(c), separator), strip)
    return F.filter(names, lambda x: x != "")


def clean_author_links(c):
    return F.array_join(author_names(F.regexp_replace(col(c), r"(?U)\b\d+\b", "")), "; ")


def join_names(c, separator=", "):
    return F.array_join(col(c), separator)


def normalize_title(c):
    return F.lower(squeeze(c))


def strip_quotes(c):
    return strip(F.replace(col(c), F.lit('"'), F.lit("")))


def clean_title(c):
    """Title key for matching: null counts as empty, no double quotes at all."""
    return F.lower(squeeze(F.replace(F.coalesce(col(c), F.lit("")), F.lit('"'), F.lit(""))))


def has_clean_title(c):
    """Whether ``clean_title`` leaves anything, without computing it."""
    return F.btrim(F.coalesce(col(c), F.lit("")), F.lit(WHITE_SPACE + '"')) != ""


@F.pandas_udf(T.StringType())
def decompose(s: pd.Series) -> pd.Series:
    """Compatibility decomposition; Spark has no built-in for it."""
    return s.map(lambda x: unicodedata.normalize("NFKD", x), na_action="ignore")


def normalize_string(c):
    """Fold accents, drop punctuation, collapse blanks, lower-case.

    Plain texts are decomposed already and do not pass through Python.
    """
    text = col(c)
    other = text.rlike(r"[^\x00-\x7f]")
    letters = F.coalesce(decompose(F.when(other, text)), text)
    return F.lower(squeeze(F.regexp_replace(letters, r"(?U)[^\p{L}\p{N}_\s]", "")))


def flatten_text(c):
    return strip(F.replace(F.replace(col(c), F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit("")))


def clean_query_title(c):
    return F.translate(col(c), "\"'", "")


def strip_session(url):
    return F.regexp_replace(col(url), r";jsessionid=[^/?#]*", "")


def long_date(c):
    return F.date_format(col(c), LONG_DATE)


def page_label(is_inpress, date, pages):
    return F.when(col(is_inpress), long_date(date)).otherwise(F.concat(F.lit("pp. "), col(pages)))


def access_label(c, open_label=OPEN_LABEL, other_label=MEMBER_LABEL):
    return F.when(col(c).eqNullSafe("OA"), F.lit(open_label)).otherwise(F.lit(other_label))


def asset_file_id(link):
    found = F.regexp_extract(col(link), SHARE_LINK_ID, 1)
    return F.when(found != "", found)


def asset_path(link, year, issue):
    return F.concat(
        F.lit("img/"), col(year), F.lit("/"), col(issue), F.lit("/"), asset_file_id(link), F.lit(".png")
    )


def asset_status(link):
    """``none`` for a missing link, ``bad`` for one without a file id."""
    return (
        F.when(col(link).isNull(), F.lit("none"))
        .when(asset_file_id(link).isNull(), F.lit("bad"))
        .otherwise(F.lit("ok"))
    )


def fold_path(path):
    """Lexical path folding: drop ``.`` and empty parts, resolve ``..``."""
    path = col(path)
    absolute = F.startswith(path, F.lit("/"))
    root = (
        F.when(path.rlike(r"^//(?!/)"), F.lit("//"))
        .when(absolute, F.lit("/"))
        .otherwise(F.lit(""))
    )
    start = F.array().cast("array<string>")

    def step(acc, part):
        can_pop = (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1) != "..")
        popped = F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
        return (
            F.when(part.isin("", "."), acc)
            .when((part == "..") & can_pop, popped)
            .when((part == "..") & absolute, acc)
            .otherwise(F.concat(acc, F.array(part)))
        )

    folded = F.concat(root, F.array_join(F.aggregate(F.split(path, "/"), start, step), "/"))
    return F.when(folded == "", F.lit(".")).otherwise(folded)


def resolve_asset_path(src, base_dir, known_prefixes=()):
    """Local path of an image source, null for a source stored elsewhere."""
    src, base = col(src), col(base_dir) if not isinstance(base_dir, str) else F.lit(base_dir)
    external = F.lit(False)
    for scheme in ("http://", "https://", "data:"):
        external = external | F.startswith(src, F.lit(scheme))
    joined = F.when(F.startswith(src, F.lit("/")), src).otherwise(F.concat(base, F.lit("/"), src))
    joined = F.when(base == "", src).otherwise(joined)
    out = F.when(external, F.lit(None).cast("string")).otherwise(fold_path(joined))
    for prefix in known_prefixes:
        out = F.when(F.startswith(src, F.lit(prefix)), F.substr(src, F.lit(len(prefix) + 1))).otherwise(out)
    return F.when(src.isNotNull(), out)


def absolute_url(base, href):
    return F.when(col(href).isNotNull(), F.concat(F.lit(base), col(href))).otherwise(F.lit(SENTINEL))


def issue_url(first_url, issue_key, content_path, base):
    """Folder of the article link, or one built from year, volume and issue."""
    year = F.try_to_number(F.substring(col(issue_key), 1, 4), F.lit("9999")).cast("int")
    number = F.try_to_number(F.substring(col(issue_key), 5, 2), F.lit("99")).cast("int")
    built = F.format_string("%s/%d/000000%02d/000000%02d", F.lit(base), year, year - 1934, number)
    folder = F.regexp_replace(col(first_url), "/[^/]*$", "")
    return F.when(F.contains(col(first_url), F.lit(content_path)), folder).otherwise(built)


def shorten(c, n):
    return F.concat(F.substring(col(c), 1, n), F.lit("..."))


def size_kb(c):
    # half-even on the exact quotient, as C-style formatting does
    return F.format_string("%.1fKB", F.bround(col(c) / F.lit(1024.0), 1))


def size_change(old, new, arrow=" → "):
    return F.concat(size_kb(old), F.lit(arrow), size_kb(new))


def summarise_list(names, n=3):
    names = col(names)
    rest = F.size(names) - n
    more = F.when(rest > 0, F.concat(F.lit(" and "), rest.cast("string"), F.lit(" more"))).otherwise("")
    return F.concat(F.array_join(F.slice(names, 1, n), ", "), more)


def image_sources(html, tag="img", attribute="src"):
    """All quoted values of one attribute of one tag, in document order."""
    pattern = f"(?i)<{tag}[^>]+{attribute}=[\"']([^\"']+)[\"']"
    return F.regexp_extract_all(col(html), F.lit(pattern), F.lit(1))


def html_blocks(html, tag="article"):
    return F.regexp_extract_all(col(html), F.lit(f"(?is)<{tag}\\b.*?</{tag}>"), F.lit(0))


def escape_html(c):
    out = F.replace(col(c), F.lit("&"), F.lit("&amp;"))
    for raw, entity in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return out
