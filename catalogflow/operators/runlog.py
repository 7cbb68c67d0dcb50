"""Run-log analytics over ``(file, line_no, line)`` tables.

``scan`` reads the logs once; all reports are taken from it.
"""

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..session import materialize
from .ordered import SPAN, earlier_spans, last_so_far, span_summaries, stored_spans, with_spans


@dataclass(frozen=True)
class Markers:
    """Texts that the run log uses (fixed values of the log format)."""

    run_start: str = "全自动更新"
    list_head: str = "📊 S3 文件列表:"
    list_end: str = "📌"
    nothing_new: str = "没有新文件或变化需要处理"
    succeeded: str = "成功处理:"
    succeeded_count: str = r"成功处理: (\d+) 个文件"
    processed_head: str = "已处理的文件:"
    failed: str = "❌"
    html_head: str = "生成的文件:"
    html_end: tuple = ("💡", "✅")
    html_made: str = "已生成:"
    stats: tuple = ("📊 In-Press 统计:", "📊 Issue ")
    commit_done: str = "✅ Git commit 完成"
    commit_failed: str = "⚠️  Git 操作失败"
    commit_none: str = "ℹ️  没有变化需要提交"
    push_start: str = "📤 Pushing to GitHub"
    push_done: tuple = ("Successfully", "main ->", "✅ GitHub push 成功")
    push_current: tuple = ("Everything up-to-date",)
    push_failed: tuple = ("❌ GitHub push 失败", "fatal:")


ZH = Markers()


def _has(needle):
    return F.contains(F.col("line"), F.lit(needle))


def _starts(needles):
    out = F.lit(False)
    for n in needles:
        out = out | F.startswith(F.col("text"), F.lit(n))
    return out


def last_run(lines, markers=ZH):
    """Lines from the last start marker of each file; all lines without one."""
    starts = lines.groupBy("file").agg(F.max(F.when(_has(markers.run_start), F.col("line_no"))).alias("_start"))
    marked = lines.join(starts.select(F.col("file").alias("_f"), "_start"), F.col("file") == F.col("_f"))
    return marked.filter(F.col("_start").isNull() | (F.col("line_no") >= F.col("_start"))).drop("_f", "_start")


def _rules(markers):
    """Heading and end test of each list of a run."""
    blank = F.col("text") == ""
    return {
        "listed": (_has(markers.list_head), blank | _has(markers.list_end)),
        "processed": (_has(markers.processed_head), blank | _starts([markers.failed])),
        "html": (_has(markers.html_head), blank | _starts(markers.html_end)),
    }


KINDS = ("listed", "processed", "html")


class Scan(NamedTuple):
    """What one pass over the logs finds.

    rows: the lines of the last run of each file with ``text``, ``item`` and, per
    list kind, ``head_...``, the line number of the heading that the line is an item of.
    ``last_listed`` is the last file list that has items.
    facts: one row per file: status, processed, commit and push.
    """

    rows: DataFrame
    facts: DataFrame


def _needles(markers):
    return {
        "none": [markers.nothing_new], "ok": [markers.succeeded], "c_done": [markers.commit_done],
        "c_failed": [markers.commit_failed], "c_none": [markers.commit_none], "p_start": [markers.push_start],
        "p_done": markers.push_done, "p_current": markers.push_current, "p_failed": markers.push_failed,
    }


def scan(lines, markers=ZH, span=SPAN):
    """One segmented scan of ``(file, line_no, line)``.

    The rows are written once in spans. A span's summary holds its last start, the last
    event of each list, the messages after its last start, and the last file list with an
    item. Summaries are associative: one pass over those of a file tells every
    span what came before it and the file where its last run starts.
    """
    rules = _rules(markers)
    rows = lines.select("file", "line_no", "line").withColumn("text", strip("line"))
    is_item = F.startswith(F.col("text"), F.lit("-"))
    rows = rows.withColumns({"item": F.when(is_item, F.substr("text", F.lit(3))), **{
        f"e_{k}": F.when(head, F.col("line_no")).when(~is_item & end, F.lit(-1).cast("bigint")) for k, (head, end) in rules.items()}})

    def local(window):
        start = F.max(F.when(_has(markers.run_start), F.col("line_no"))).over(
            window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        return {"s": start, **{f"l_{k}": last_so_far(f"e_{k}", window) for k in KINDS}}

    stored = stored_spans(rows, ["file"], "line_no", local, span)
    here = F.col("s").isNull() | (F.col("line_no") >= F.col("s"))
    found = F.regexp_extract("line", markers.succeeded_count, 1)
    listed = F.col("item").isNotNull() & F.col("e_listed").isNull()
    summaries = span_summaries(
        stored, ["file"], F.max("s").alias("s"), F.max("line_no").alias("end"),
        *[F.max_by(f"e_{k}", F.when(F.col(f"e_{k}").isNotNull(), F.col("line_no"))).alias(f"v_{k}") for k in KINDS],
        *[F.max(here & F.array_max(F.array(*[_has(n) for n in words]))).alias(f"m_{k}") for k, words in _needles(markers).items()],
        F.min(F.when(here & (found != ""), F.struct("line_no", found.alias("n")))).alias("n"),
        F.max(F.when(listed & (F.col("l_listed") >= 0), F.col("l_listed"))).alias("own_list"),
        F.max(listed & F.col("l_listed").isNull()).alias("open_items"),
    )
    before, whole = earlier_spans(["file"]), Window.partitionBy("file")
    known = summaries.withColumns({
        "start": F.max("s").over(whole), **{f"b_{k}": F.last(f"v_{k}", ignorenulls=True).over(before) for k in KINDS}})
    # the last list of a span: its own, or the one that was open when it began
    inherited = F.when(F.col("open_items") & (F.col("b_listed") >= 0), F.col("b_listed"))
    last = F.greatest("own_list", inherited)
    counts = F.col("start").isNull() | (F.col("end") >= F.col("start"))
    in_run = F.col("start").isNull() | (last >= F.col("start"))
    known = known.withColumns({
        "last_listed": F.max(F.when(counts & in_run, last)).over(whole), "n": F.min(F.when(counts, F.col("n"))).over(whole)["n"],
        **{f"m_{k}": F.max(F.when(counts, F.col(f"m_{k}"))).over(whole) for k in _needles(markers)}})
    told = known.select("_cell", "file", "_span", "start", "last_listed", *_status_columns(), *_publish_columns(), *[f"b_{k}" for k in KINDS])
    told = materialize(told, "told")  # one row per span, read for the lines and for the facts
    joined = with_spans(stored, ["file"], told)
    run = joined.filter(F.col("start").isNull() | (F.col("line_no") >= F.col("start")))
    heads = {}
    for k in KINDS:
        filled = F.coalesce(F.col(f"l_{k}"), F.col(f"b_{k}"))
        in_list = F.col("item").isNotNull() & (F.col(f"e_{k}").isNull() | (F.col(f"e_{k}") < 0)) & (filled >= F.coalesce("start", F.lit(0)))
        heads[f"head_{k}"] = F.when(in_list, filled)
    run = run.withColumns(heads).select(
        "file", "line_no", "line", "text", "item", *heads, "last_listed", "status", "processed", "commit", "push")
    facts = told.groupBy("file").agg(*[F.max(c).alias(c) for c in ("status", "processed", "commit", "push")])
    return Scan(run, facts)


def _scanned(lines, markers, span):
    return lines if isinstance(lines, Scan) else scan(lines, markers, span)


def list_items(lines, kind, markers=ZH, span=SPAN):
    """Dash lines of one kind of list, with the line number of their heading.

    A line belongs to a list when the nearest event of that list above it is
    its heading. ``lines`` is a table of lines or a ``Scan``, as in all functions below.
    """
    rows = _scanned(lines, markers, span).rows
    return rows.select("file", "line_no", "item", F.col(f"head_{kind}").alias("head_no")).filter("head_no is not null")


def listed_files(lines, markers=ZH, span=SPAN):
    """Items of the last non-empty file list of each run."""
    rows = _scanned(lines, markers, span).rows
    return rows.filter("head_listed = last_listed").select("file", "line_no", "item")


def processed_files(lines, markers=ZH, span=SPAN):
    return list_items(lines, "processed", markers, span).select("file", "line_no", "item")


def _status_columns():
    status = (
        F.when(F.col("m_none"), F.lit("nothing_new"))
        .when(F.col("m_ok") & F.col("n").isNotNull(), F.lit("processed"))
        .when(F.col("m_ok"), F.lit("ran"))
        .otherwise(F.lit("check"))
    )
    return status.alias("status"), F.when(status == "processed", F.col("n").try_cast("int")).alias("processed")


def run_status(lines, markers=ZH, span=SPAN):
    """``nothing_new``, ``processed`` with a count, ``ran`` or ``check``."""
    return _scanned(lines, markers, span).facts.select("file", "status", "processed")


def _made_name(markers):
    after = F.get(F.split("line", markers.html_made), F.lit(1))
    return F.get(F.split(strip(after), r"(?U)\s+"), F.lit(0))


def _reports_page(markers):
    return _has(markers.html_made) & ~_has(markers.html_head)


def updated_html(lines, markers=ZH, span=SPAN):
    """Updated HTML files, first-seen order by ``line_no``."""
    rows = _scanned(lines, markers, span).rows
    names = F.array(F.when(F.col("head_html").isNotNull(), strip("item")), F.when(_reports_page(markers), _made_name(markers)))
    found = rows.select("file", "line_no", F.explode(names).alias("name")).filter(F.endswith(F.col("name"), F.lit(".html")))
    return found.groupBy("file", "name").agg(F.min("line_no").alias("line_no"))


def change_stats(lines, markers=ZH, span=SPAN):
    rows = _scanned(lines, markers, span).rows
    return rows.filter(_starts(markers.stats)).select("file", "line_no", F.col("text").alias("item"))


def _publish_columns():
    commit = (
        F.when(F.col("m_c_done"), F.lit("committed"))
        .when(F.col("m_c_failed"), F.lit("failed"))
        .when(F.col("m_c_none"), F.lit("no_change"))
    )
    push = F.when(
        F.col("m_p_start"),
        F.when(F.col("m_p_done"), F.lit("pushed"))
        .when(F.col("m_p_current"), F.lit("up_to_date"))
        .when(F.col("m_p_failed"), F.lit("failed"))
        .otherwise(F.lit("check")),
    )
    return commit.alias("commit"), push.alias("push")


def publish_status(lines, markers=ZH, span=SPAN):
    """Commit and push outcome of each run by precedence of its messages."""
    return _scanned(lines, markers, span).facts.select("file", "commit", "push")


def summary_lines(lines, markers=ZH, span=SPAN):
    """The run report as ordered rows ``(file, part, line_no, item)``.

    Parts: 1 listed files, 2 status, 3 processed files, 4 updated pages,
    5 change counts, 6 commit and push. All come out of one scan.
    """
    found = _scanned(lines, markers, span)

    def entry(number, when, item):
        return F.when(when, F.struct(F.lit(number).alias("part"), item.alias("item")))

    def page(when, name):
        return entry(4, when & F.endswith(name, F.lit(".html")), name)

    entries = F.array(
        entry(1, F.col("head_listed") == F.col("last_listed"), F.col("item")),
        entry(3, F.col("head_processed").isNotNull() & (F.col("status") == "processed"), F.col("item")),
        page(F.col("head_html").isNotNull(), strip("item")),
        page(_reports_page(markers), _made_name(markers)),
        entry(5, _starts(markers.stats), F.col("text")),
    )
    per_line = found.rows.select("file", "line_no", F.explode(entries).alias("e")).filter("e is not null")
    per_line = per_line.select("file", "line_no", "e.part", "e.item")
    # a page counts once, at its first line; all other entries stay as they are
    place = F.when(F.col("part") != 4, F.col("line_no"))
    listed = per_line.groupBy("file", "part", "item", place.alias("_p")).agg(F.min("line_no").alias("line_no")).drop("_p")
    label = F.concat_ws(" ", "status", F.col("processed").cast("string"))
    notes = F.concat_ws(", ", F.concat(F.lit("commit "), F.col("commit")), F.concat(F.lit("push "), F.col("push")))
    summary = F.array(
        F.struct(F.lit(2).alias("part"), label.alias("item")), F.struct(F.lit(6).alias("part"), notes.alias("item"))
    )
    single = found.facts.select("file", F.explode(summary).alias("e")).select(
        "file", "e.part", "e.item", F.lit(0).cast("bigint").alias("line_no")
    )
    return listed.unionByName(single.filter("item <> ''"))


def summary_message(lines, markers=ZH, span=SPAN):
    """The report as texts: one per file, part and span of log lines.

    Joined in that order they are the message of the run.
    """
    rows = summary_lines(lines, markers, span).withColumn("chunk", F.floor(F.col("line_no") / span))
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "item")))
    text = F.array_join(F.transform(ordered, lambda x: x["item"]), "\n")
    return rows.groupBy("file", "part", "chunk").agg(text.alias("message"))
