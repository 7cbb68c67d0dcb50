"""Article rows from HTML pages and from section text.

HTML needs a parser, so pages go through ``mapInPandas`` in Arrow batches, one
page at a time; text extraction uses array expressions inside one row.
"""

from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions.nulls import SENTINEL, col
from ..functions.text import clean_author_links, strip
from .ordered import running_sum

# fixed values: page vocabulary
PAGES = 64  # pages whose rows leave together
VOID_TAGS = {"br", "img", "hr", "meta", "link", "input"}
DATE_PREFIX = "Appeared or available online:"
HEADING_WORDS = ("Article", "Original", "Columns")
HEADING_EXCLUDED = "In-Press Articles"
AUTHOR_TITLE = "Search for articles by this author"
FOOTER = r"Delivered by|Page\s\d+"
REFERENCE = (
    r"(?md)^(.*?),\s*(.+?)\.\s*(\d{4})\.\s+([A-Za-z0-9\s\&\(\)\,\.\-\:\/]+?)\s+"
    r"(\d+\(?[a-zA-Z0-9]*\)?):([0-9\–]+)\."
)


class _Node:
    __slots__ = ("tag", "attrs", "parent", "items", "place")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.items = tag, attrs, parent, []
        self.place = len(parent.items) if parent is not None else 0

    def below(self):
        """All nodes and texts below, in order; no recursion, as raw pages nest without limit."""
        stack = [iter(self.items)]
        while stack:
            for item in stack[-1]:
                yield item
                if isinstance(item, _Node):
                    stack.append(iter(item.items))
                    break
            else:
                stack.pop()

    def walk(self):
        return (item for item in self.below() if isinstance(item, _Node))

    def all(self, tag=None, cls=None, ident=None, title=None):
        for n in self.walk():
            if tag and n.tag != tag:
                continue
            if cls and cls not in (n.attrs.get("class") or "").split():
                continue
            if ident and n.attrs.get("id") != ident:
                continue
            if title and title not in (n.attrs.get("title") or ""):
                continue
            yield n

    def first(self, *args, **kw):
        return next(self.all(*args, **kw), None)

    def pieces(self):
        return (item for item in self.below() if not isinstance(item, _Node))

    def text(self):
        """Text pieces stripped one by one and joined."""
        return "".join(p.strip() for p in self.pieces())

    def raw(self):
        return "".join(self.pieces())

    def release(self):
        """Cut parents and children apart; else a tree waits for the collector of reference cycles."""
        for n in list(self.walk()):
            n.parent, n.items = None, ()

    def next_text(self):
        after = self.parent.items[self.place + 1:self.place + 2]
        return after[0] if after and isinstance(after[0], str) else ""

    def up(self, tag):
        node = self.parent
        while node is not None and node.tag != tag:
            node = node.parent
        return node


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {}, None)
        self.open = Counter()

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, dict(attrs), self.at)
        self.at.items.append(node)
        if tag not in VOID_TAGS:
            self.at = node
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.at.items.append(_Node(tag, dict(attrs), self.at))

    def handle_endtag(self, tag):
        if not self.open[tag]:
            return
        while True:
            closed, self.at = self.at, self.at.parent
            self.open[closed.tag] -= 1
            if closed.tag == tag:
                return

    def handle_data(self, data):
        items = self.at.items
        if items and isinstance(items[-1], str):
            items[-1] += data
        else:
            items.append(data)


def _parse(html):
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def _extract(pages, rule, fields, url="url", html="html"):
    """Run ``rule(page) -> rows`` over a page table, batch by batch.

    Rows carry the page's link as ``page_url`` and their place on it as ``pos``.
    """
    schema = "page_url string, pos int, " + ", ".join(f"`{f}` string" for f in fields)

    kinds = pa.schema([("page_url", pa.string()), ("pos", pa.int32()), *[(f, pa.string()) for f in fields]])

    def run(batches):
        # one page is in memory as text and tree at a time, whatever the size of the batch
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES):
                rows = []
                for u, h in zip(*batch.slice(at, PAGES).columns):
                    page = _parse(h.as_py())
                    rows += [(u.as_py(), i, *row) for i, row in enumerate(rule(page))]
                    page.release()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)

    return pages.select(F.col(url).cast("string"), F.col(html).cast("string")).mapInArrow(run, schema)


def _or_sentinel(node):
    return node.text() if node is not None else SENTINEL


def extract_toc(pages, base="", words=HEADING_WORDS, excluded=HEADING_EXCLUDED):
    """Article blocks of issue pages, below each matching heading."""

    def rule(page):
        for head in page.all("p", "heading"):
            text = head.text()
            if text == excluded or not any(w in text for w in words):
                continue
            after = head.parent.items[head.parent.items.index(head) + 1:]
            for block in (n for n in after if isinstance(n, _Node)):
                classes = (block.attrs.get("class") or "").split()
                if block.tag == "p" and "heading" in classes:
                    break
                if block.tag == "div" and "data" in classes:
                    yield toc_row(block)

    def toc_row(block):
        link = block.first("a")
        notes = (br.next_text() for br in block.all("br"))
        page_note = next((t.strip() for t in notes if "pp." in t), SENTINEL)
        icon = block.first("span", "access-icon")
        image = icon.first("img") if icon is not None else None
        return (
            _or_sentinel(block.first("strong")),
            _or_sentinel(block.first("em")),
            page_note or SENTINEL,
            image.attrs.get("title", SENTINEL) if image is not None else SENTINEL,
            base + link.attrs.get("href", "") if link is not None else SENTINEL,
        )

    return _extract(pages, rule, ["Title", "Authors", "Pages", "Access", "URL"])


def extract_article(pages, style="label"):
    """Abstract and authors of article pages.

    ``label``: the links beside the authors label, numbers removed, ``;`` list.
    ``titled``: the links with the author search title, ``,`` list.
    """

    def authors_of(page):
        labels = (s for s in page.all("strong") if "Authors:" in s.raw())
        label = next(labels, None)
        if label is None:
            return SENTINEL
        if style == "titled":
            return ", ".join(a.text() for a in page.all("a", title=AUTHOR_TITLE))
        block = label.up("p")
        return "; ".join(a.text() for a in block.all("a")) if block is not None else SENTINEL

    def rule(page):
        abstract = _or_sentinel(page.first("div", ident="Abst"))
        return [(authors_of(page), abstract.replace("\n", " ").replace("\r", "").strip())]

    rows = _extract(pages, rule, ["Authors", "Abstract"])
    if style == "label":
        cleaned = F.when(F.col("Authors") == SENTINEL, F.col("Authors")).otherwise(clean_author_links("Authors"))
        rows = rows.withColumn("Authors", cleaned)
    return rows


def extract_fast_track(pages, base="", prefix=DATE_PREFIX, list_id="fasttrackItems"):
    """Title, date, link and access of the listed items, exact copies once."""

    def rule(page):
        listing = page.first("ul", ident=list_id)
        for item in listing.all("li") if listing is not None else ():
            link = item.first("a")
            if link is None:
                continue
            block = link.up("p")
            breaks = list(block.all("br")) if block is not None else []
            date = breaks[-1].next_text().replace(prefix, "").strip() if breaks else ""
            image = item.first("img")
            yield (
                (link.attrs.get("title") or "").strip(),
                date,
                base + (link.attrs.get("href") or "").strip(),
                (image.attrs.get("title") or "").strip() if image is not None else "Unknown",
            )

    rows = _extract(pages, rule, ["Title", "Date", "Link", "Access Status"])
    return rows.drop("page_url", "pos").distinct()


def extract_journals(pages):
    """Journal title, the publisher that follows it, and the journal link."""

    def clean(text):
        return text.replace("\n", " ").strip()

    def rule(page):
        entries = [n for n in page.all("li") if {"journalTitle", "publishername"} & set((n.attrs.get("class") or "").split())]
        rows, publisher = [], SENTINEL
        for n in reversed(entries):
            if "publishername" in n.attrs["class"].split():
                publisher = clean(n.raw())
            if "journalTitle" in n.attrs["class"].split():
                link = n.first("a")
                title = clean(link.raw()) if link is not None else SENTINEL
                href = clean(link.attrs["href"]) if link is not None and link.attrs.get("href") else SENTINEL
                rows.append((title, publisher, href))
        return reversed(rows)

    return _extract(pages, rule, ["Journal Title", "Publisher Name", "Link to Journal"])


def extract_journal_details(pages, compat=False):
    """Print and online ISSN and the latest issue of a journal page.

    ``compat`` takes the first ISSN for both kinds when the page mentions an
    online one; otherwise the ISSN's own text must mention it. A page without
    HTML gives the ``Error`` triple.
    """

    def issn(node):
        return node.raw().replace("-", "").strip() if node is not None else SENTINEL

    def rule(page):
        if not page.items:
            return [("Error", "Error", "Error")]
        links = [a for a in page.all("a", "issnDevicestyle") if "-" in a.raw()]
        online = [a for a in links if "(Online)" in (page.raw() if compat else a.raw() + a.next_text())]
        printed = links if compat else [a for a in links if a not in online]
        latest = page.first("a", title="Number")
        return [(
            issn(printed[0] if printed else None),
            issn(online[0] if online else None),
            latest.attrs["title"].strip() if latest is not None else SENTINEL,
        )]

    return _extract(pages, rule, ["Print ISSN", "Online ISSN", "Latest Issue"])


def extract_details(pages, title=("h1", None, None), authors=(None, "contributions", None),
                    affiliation=(None, "aff", None), abstract=(None, None, "Abst")):
    """Title, authors, joined affiliations and abstract of a detail page.

    Each rule is (tag, class, id); the defaults are the journal's page layout.
    """

    def rule(page):
        parts = [n.raw().strip() for n in page.all(*affiliation)]
        heading = page.first(*title)
        writers, text = page.first(*authors), page.first(*abstract)
        return [(
            heading.raw().strip() if heading is not None else SENTINEL,
            writers.raw().strip() if writers is not None else SENTINEL,
            " | ".join(parts) if parts else SENTINEL,
            text.raw().strip() if text is not None else SENTINEL,
        )]

    return _extract(pages, rule, ["Title", "Authors", "Affiliations", "Abstract"])


# --- section text ----------------------------------------------------------


def _after_heading(page, heading):
    """Text behind the heading; the whole page where it has none."""
    head = F.lit(heading)
    return F.when(F.contains(page, head), F.substr(page, F.locate(heading, page) + len(heading))).otherwise(page)


def _ends_entry(line):
    return line.rlike(r"\.\z") | F.contains(line, F.lit(", and "))


def _split_entries(entries, columns, footer):
    """Title and authors at the first full stop; incomplete entries go."""
    entries = entries.withColumn("entry", strip("entry")).filter("entry <> ''")
    if footer:
        entries = entries.filter(~F.contains(F.col("entry"), F.lit(footer)))
    cut = F.locate(". ", F.col("entry"))
    out = entries.select(
        *columns,
        strip(F.substr("entry", F.lit(1), cut - 1)).alias("Title"),
        strip(F.substr("entry", cut + 2)).alias("Authors"),
        cut.alias("_cut"),
    )
    return out.filter("_cut > 0 and Title <> '' and Authors <> ''").drop("_cut")


def extract_section(df, doc, pages, heading, footer=None):
    """Stitched (title, authors) entries of the section under a heading.

    ``pages`` is an array of page texts. Wrapped lines are joined until one
    ends with a full stop or holds ``, and ``; lines without letters are
    skipped, and entries naming ``footer`` are dropped. All work stays inside
    the row.
    """
    start = F.array_position(F.transform(F.col(pages), lambda p: F.contains(p, F.lit(heading))), F.lit(True))
    tail = F.when(start > 0, F.slice(F.col(pages), start.cast("int"), F.size(pages)))
    after = F.transform(tail, lambda p: _after_heading(p, heading))
    lines = F.flatten(F.transform(after, lambda p: F.split(p, "\n")))
    texts = F.filter(lines, lambda x: x.rlike("[A-Za-z]"))
    mark = "\u0001"
    marked = F.transform(
        texts, lambda x: F.when(_ends_entry(x), F.concat(strip(x), F.lit(mark))).otherwise(strip(x))
    )
    parts = F.split(F.array_join(marked, " "), mark)
    # outer: the planner then adds no filter that evaluates the array again
    entries = df.select(doc, F.posexplode_outer(parts).alias("pos", "entry"))
    return _split_entries(entries, [doc, "pos"], footer)


def extract_section_pages(df, doc, page, text, heading, footer=None):
    """The same for one row per page, for documents of any number of pages.

    A line's place is its page and its number there. The entry number is the
    count of ending lines on the pages before plus that on the page, so pages
    may have any number of lines and no document is gathered into one row (an
    entry is one: text without any ending line is one entry).
    """
    first = df.filter(F.contains(F.col(text), F.lit(heading))).groupBy(F.col(doc).alias("_doc")).agg(
        F.min(page).alias("_first")
    )
    inside = df.join(first, (F.col(doc) == F.col("_doc")) & (F.col(page) >= F.col("_first")))
    lines = inside.select(doc, F.col(page).cast("bigint").alias("_page"), F.posexplode_outer(
        F.split(_after_heading(F.col(text), heading), "\n")).alias("_n", "_line"))
    lines = lines.filter(F.col("_line").rlike("[A-Za-z]")).select(
        doc, "_page", "_n", strip("_line").alias("_text"), _ends_entry(F.col("_line")).cast("bigint").alias("_end"))
    ends = lines.groupBy(doc, "_page").agg(F.sum("_end").alias("_ends"))
    before = running_sum(ends, [doc], "_page", "_ends", "_earlier").select(
        F.col(doc).alias("_d"), F.col("_page").alias("_p"), "_earlier")
    numbered = running_sum(lines, [doc, "_page"], "_n", "_end", "_inside")
    numbered = numbered.join(before, (F.col(doc) == F.col("_d")) & (F.col("_page") == F.col("_p")))
    ordered = F.array_sort(F.collect_list(F.struct("_page", "_n", "_text")))
    entries = numbered.groupBy(doc, (F.col("_earlier") + F.col("_inside")).alias("pos")).agg(
        F.array_join(F.transform(ordered, lambda x: x["_text"]), " ").alias("entry"))
    return _split_entries(entries, [doc, "pos"], footer)


def extract_section_simple(df, doc, page, heading, footer=FOOTER):
    """One entry per line after the heading line, up to the footer."""
    lines = F.split(F.col(page), "\n")
    is_head = F.transform(lines, lambda x: F.contains(x, F.lit(heading)))
    start = F.array_position(is_head, F.lit(True)).cast("int")
    rest = F.when(start > 0, F.slice(lines, start + 1, F.size(lines)))
    stops = F.transform(rest, lambda x: x.rlike(footer))
    stop = F.array_position(stops, F.lit(True)).cast("int")
    body = F.when(stop > 0, F.slice(rest, 1, F.greatest(stop - 1, F.lit(0)))).otherwise(rest)
    entries = df.select(doc, F.posexplode_outer(body).alias("pos", "line"))
    split = r"(?s)^(.*?)\.\s+(.*)$"
    return entries.filter(F.col("line").rlike(split)).select(
        doc, "pos",
        strip(F.regexp_extract("line", split, 1)).alias("Title"),
        strip(F.regexp_extract("line", split, 2)).alias("Authors"),
    )


def extract_references(df, doc, text):
    """Citation entries of a text: authors, title and publication info."""
    found = F.regexp_extract_all(col(text), F.lit(REFERENCE), F.lit(0))
    hits = df.select(doc, F.posexplode_outer(found).alias("pos", "hit")).filter("hit is not null")
    g = [None] + [strip(F.regexp_extract("hit", REFERENCE, i)) for i in range(1, 7)]
    journal = F.concat(g[4], F.lit(", "), g[3])
    cut = F.locate(". ", journal)
    title = F.when(cut > 0, F.substr(journal, F.lit(1), cut - 1)).otherwise(journal)
    rest = F.when(cut > 0, F.substr(journal, cut + 2)).otherwise(F.lit(""))
    return hits.select(
        doc, "pos",
        F.concat(g[1], F.lit(", "), g[2]).alias("Authors"),
        title.alias("Title"),
        F.concat(rest, F.lit(" Volume/Issue: "), g[5], F.lit(", Pages: "), g[6]).alias("Publication Info"),
    )
