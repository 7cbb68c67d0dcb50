"""Article fragments and ordered documents.

Page themes are the caller's: fragments carry class names, not styles.
"""

from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.nulls import col, is_missing
from ..functions.text import escape_html, strip
from .ordered import earlier_spans, span_summaries, stored_spans, with_spans


@dataclass(frozen=True)
class Theme:
    """Labels (fixed values, spelled as published) and class names of a fragment."""

    kind: str = "Research Articles"
    open_badge: str = "Open Access"
    choice_badge: str = "Editor’s Choice"
    online: str = "Avaliable online: "
    authors: str = "Authors: "
    abstract: str = "Abstract:"
    more: str = "Read more..."
    first_class: str = "entry first"
    next_class: str = "entry"


DEFAULT = Theme()


def _text(c, escape):
    value = F.coalesce(col(c).cast("string"), F.lit(""))
    return escape_html(value) if escape else value


def _wrap(tag, body, cls=None):
    head = f'<{tag} class="{cls}">' if cls else f"<{tag}>"
    return F.concat(F.lit(head), body, F.lit(f"</{tag}>"))


def _present(c, body):
    return F.when(~is_missing(c) & (strip(col(c).cast("string")) != ""), body).otherwise(F.lit(""))


def _header(is_open, theme):
    badge = F.when(col(is_open), _wrap("span", F.lit(theme.open_badge), "open")).otherwise(F.lit(""))
    return _wrap("div", F.concat(F.lit(theme.kind + " "), badge), "kind")


def _link(url, title, escape):
    target = F.coalesce(F.when(strip(url) != "", col(url)), F.lit("#"))
    href = escape_html(target) if escape else target
    return _wrap("h3", F.concat(F.lit('<a href="'), href, F.lit('">'), _text(title, escape), F.lit("</a>")))


def _abstract(abstract, theme, escape):
    body = F.concat(
        F.lit(theme.abstract), _wrap("details", F.concat(_wrap("summary", F.lit(theme.more)), _text(abstract, escape)))
    )
    return _wrap("div", body, "abstract")


def _article(parts, is_first, theme):
    body = F.concat(*parts)
    if is_first is None:
        return _wrap("article", body, theme.next_class)
    return F.when(col(is_first), _wrap("article", body, theme.first_class)).otherwise(
        _wrap("article", body, theme.next_class)
    )


def article_fragment(title, url, authors, abstract, info, is_open, is_first=None, is_choice=None, image=None,
                     theme=DEFAULT, escape=False):
    """One article: badges, linked title, info line, authors, foldable abstract, image."""
    parts = [_header(is_open, theme)]
    if is_choice is not None:
        parts.append(F.when(col(is_choice), _wrap("span", F.lit(theme.choice_badge), "choice")).otherwise(""))
    parts += [
        _link(url, title, escape),
        _wrap("div", _text(info, escape), "info"),
        _wrap("div", F.concat(F.lit(theme.authors), _text(authors, escape)), "authors"),
        _abstract(abstract, theme, escape),
    ]
    if image is not None:
        picture = F.concat(F.lit('<img src="'), col(image), F.lit('">'))
        parts.append(F.when(col(image).isNotNull(), picture).otherwise(""))
    return _article(parts, is_first, theme)


def in_press_fragment(title, url, authors, abstract, online, is_open, is_first=None, theme=DEFAULT, escape=False):
    """An in-press article; each missing part is left out."""
    parts = [
        _header(is_open, theme),
        _present(title, _link(url, title, escape)),
        _present(online, _wrap("div", F.concat(F.lit(theme.online), _text(online, escape)), "info")),
        _present(authors, _wrap("div", F.concat(F.lit(theme.authors), _text(authors, escape)), "authors")),
        _present(abstract, _abstract(abstract, theme, escape)),
    ]
    return _article(parts, is_first, theme)


def usage_info(year, volume, issue):
    parts = []
    for label, c in (("Year: ", year), (", Volume: ", volume), (", Issue: ", issue)):
        parts += [F.lit(label), F.coalesce(col(c).cast("string"), F.lit(""))]
    return F.concat(*parts)


def usage_fragment(title, url, authors, abstract, year, volume, issue, is_open, theme=DEFAULT, escape=False):
    info = usage_info(year, volume, issue)
    return article_fragment(title, url, authors, abstract, info, is_open, theme=theme, escape=escape)


def minimal_fragment(title, authors, info=None, is_first=None, theme=DEFAULT, escape=False):
    parts = [
        _wrap("h3", _text(title, escape)),
        _wrap("div", F.concat(F.lit(theme.authors), _text(authors, escape)), "authors"),
    ]
    if info is not None:
        parts.append(_wrap("div", _text(info, escape), "info"))
    return _article(parts, is_first, theme)


def issue_header(issue_key, url):
    """Heading of an issue page and the link to the whole issue."""
    key = col(issue_key)
    name = F.concat(F.lit("Issue "), F.lpad(F.substring(key, 5, 2), 2, "0"), F.lit(" - Year "), F.substring(key, 1, 4))
    link = F.concat(F.lit('<p><a href="'), col(url), F.lit('">View Full Issue</a></p>'))
    return _wrap("header", F.concat(_wrap("h1", name), link))


PART_BYTES = 1_000_000


def assemble(df, group, pos, fragment, most=None, out="html"):
    """Fragments of a group in order, joined to documents.

    With ``most`` a document comes in numbered parts that are cut by bytes: a
    fragment belongs to part ``offset // most`` of its offset in the document, so a
    part has at most ``most`` bytes and one fragment, a group of any size stays
    spread out, and the parts in order are the document; the fragments are
    stored in between. Without it each group
    becomes one text: only for groups that are small by construction, such as the
    issues of a year. ``pos`` is an integer, unique in the group; null fragments are left out.
    """
    group = list(group)
    keyed, keys = df, group
    if most is not None:
        sized = df.select(*group, F.col(pos).alias("_p"), F.col(fragment).alias("_f")).withColumn("_bytes", F.octet_length("_f").cast("long"))
        # fragments are made once: stored with their offsets in their spans, which the spans before them only shift
        stored = stored_spans(sized, group, "_p", lambda w: {"_local": F.sum("_bytes").over(w.rowsBetween(Window.unboundedPreceding, -1))})
        sums = span_summaries(stored, group, F.sum("_bytes").alias("_n"))
        before = sums.withColumn("_before", F.sum("_n").over(earlier_spans(group))).drop("_n")
        offset = F.coalesce("_local", F.lit(0)) + F.coalesce("_before", F.lit(0))
        keyed = with_spans(stored, group, before).filter("_f is not null").withColumn("part", F.floor(offset / F.lit(most)))
        keys, pos, fragment = [*group, "part"], "_p", "_f"
    ordered = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(fragment).alias("f"))))
    return keyed.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["f"]), "").alias(out))


def issue_pages(df, group, pos, fragment, header, footer="", most=PART_BYTES, out="html"):
    """One document per issue, in parts cut by bytes (one part up to ``most`` bytes).

    Head and foot are the fragments before the first and after the last one.
    """
    ends = df.groupBy(group).agg(F.min(pos).alias("_low"), F.max(pos).alias("_high"), F.first(col(header)).alias("_head"))
    both = ends.select(group, F.explode(F.array(
        F.struct((F.col("_low") - 1).alias(pos), F.col("_head").alias(fragment)),
        F.struct((F.col("_high") + 1).alias(pos), F.lit(footer).alias(fragment)))).alias("_e"))
    rows = df.select(group, pos, fragment).unionByName(both.select(group, "_e.*"))
    return assemble(rows, [group], pos, fragment, most, out)


def index_fragment(label, url, flag):
    """One line of the issue index."""
    mark = F.when(col(flag) != "", F.concat(F.lit(" <strong>"), col(flag), F.lit("</strong>"))).otherwise("")
    return _wrap("li", F.concat(F.lit('<a href="'), col(url), F.lit('">'), col(label), F.lit("</a>"), mark))


def index_by_year(index, flag="access_flag"):
    """One block per year, newest issue first."""
    lines = index.withColumn("_f", index_fragment("label", "url", flag)).withColumn("_p", -F.col("issue"))
    years = assemble(lines, ["year", "volume"], "_p", "_f", out="items")
    head = F.concat(F.lit("<ul><li>Volume "), F.col("volume").cast("string"), F.lit("</li>"))
    return years.select("year", "volume", F.concat(head, F.col("items"), F.lit("</ul>")).alias("html"))
