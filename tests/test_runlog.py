import random

from catalogflow.operators import runlog

LOG = """== 全自动更新 ==
📊 S3 文件列表:
   - old.xlsx: 1.0 KB

========
== 全自动更新 ==
📋 已处理的文件数: 0
📊 S3 文件列表:
   - 26-04_April_metadata.xlsx: 17.6 KB
   - b.xlsx: 2.0 KB

📌 发现 1 个文件需要处理:
   - 26-04_April_metadata.xlsx: 新文件

✅ 成功处理: 1 个文件

已处理的文件:
   - 26-04_April_metadata.xlsx (17.6 KB): 新文件

   📊 In-Press 统计: +1 / -0 / 当前 4 篇
   ✅ 已生成: IssuesArticles/html/202604.html (6)
📋 生成的文件:
   - in_press.html
   - IssuesArticles/html/202604.html
   - data.csv

   ✅ Git commit 完成
📤 Pushing to GitHub...
   abc1234..def5678  main -> main"""


def lines(spark, **logs):
    data = [(name, i, line) for name, text in logs.items() for i, line in enumerate(text.split("\n"))]
    return spark.createDataFrame(data, "file string, line_no bigint, line string")


def test_sections_of_the_last_run(spark, rows):
    for span in (5, 1000):
        run = runlog.last_run(lines(spark, a=LOG))
        assert run.count() == 24
        assert rows(runlog.listed_files(run, span=span), "item") == [("26-04_April_metadata.xlsx: 17.6 KB",), ("b.xlsx: 2.0 KB",)]
        assert rows(runlog.processed_files(run, span=span), "item") == [("26-04_April_metadata.xlsx (17.6 KB): 新文件",)]
        html = runlog.updated_html(run, span=span).orderBy("line_no").collect()
        assert [r.name for r in html] == ["IssuesArticles/html/202604.html", "in_press.html"]
    assert rows(runlog.change_stats(run), "item") == [("📊 In-Press 统计: +1 / -0 / 当前 4 篇",)]
    assert rows(runlog.run_status(run)) == [("a", "processed", 1)]
    assert rows(runlog.publish_status(run)) == [("a", "committed", "pushed")]


def test_status_precedence(spark, rows):
    logs = lines(
        spark, none="没有新文件或变化需要处理\n成功处理: 2 个文件", odd="成功处理: x", bare="nothing",
        failed="⚠️  Git 操作失败: e\n📤 Pushing to GitHub\nfatal: no", current="ℹ️  没有变化需要提交\n📤 Pushing to GitHub\nEverything up-to-date\nfatal:",
        unclear="📤 Pushing to GitHub",
    )
    assert rows(runlog.run_status(logs)) == [
        ("bare", "check", None), ("current", "check", None), ("failed", "check", None), ("none", "nothing_new", None),
        ("odd", "ran", None), ("unclear", "check", None),
    ]
    got = {r.file: (r.commit, r.push) for r in runlog.publish_status(logs).collect()}
    assert got == {
        "none": (None, None), "odd": (None, None), "bare": (None, None), "failed": ("failed", "failed"),
        "current": ("no_change", "up_to_date"), "unclear": (None, "check"),
    }


def test_a_later_empty_list_does_not_hide_the_last_full_one(spark, rows):
    log = "📊 S3 文件列表:\n- a\n\n📊 S3 文件列表:\n\n- stray"
    assert rows(runlog.listed_files(lines(spark, x=log)), "item") == [("a",)]


def test_message(spark):
    parts = runlog.summary_message(lines(spark, a=LOG), span=1000).orderBy("part", "chunk").collect()
    text = "\n".join(p.message for p in parts).split("\n")
    assert text[0].startswith("26-04_April") and "processed 1" in text and text[-1] == "commit committed, push pushed"


def brute(text):
    """The last run of one log, line by line."""
    m = runlog.ZH
    lines = list(enumerate(text.split("\n")))
    start = max((i for i, t in lines if m.run_start in t), default=0)
    lists, open_list, pages, stats = [], None, {}, []
    html_open = None
    for i, line in lines[start:]:
        t = line.strip()
        if m.list_head in line:
            open_list = []
            lists.append(open_list)
        elif t.startswith("-"):
            if open_list is not None:
                open_list.append((i, t[2:]))
        elif not t or m.list_end in line:
            open_list = None
        if m.html_head in line:
            html_open = True
        elif t.startswith("-"):
            if html_open and t[2:].strip().endswith(".html"):
                pages.setdefault(t[2:].strip(), i)
        elif not t or t.startswith(m.html_end):
            html_open = False
        if m.html_made in line and m.html_head not in line:
            name = line.split(m.html_made)[1].strip().split()[0]
            if name.endswith(".html"):
                pages.setdefault(name, i)
        if t.startswith(m.stats):
            stats.append((i, t))
    return [x for x in lists if x][-1:], pages, stats


def test_random_logs_in_any_spans(spark, rows):
    m, rng = runlog.ZH, random.Random(2)
    vocabulary = [m.run_start, m.list_head, "📋 " + m.html_head, "", "📌 n", "   - a.html", "- b.xlsx", "- c.html", "plain", "✅ " + m.html_made + " d.html (2)",
                  "📊 Issue 202601: +1", m.commit_done, m.push_start, "main -> x"]
    logs = {f"f{k}": "\n".join(rng.choices(vocabulary, [1, 6, 6, 4, 2, 9, 9, 9, 5, 3, 2, 1, 1, 1], k=rng.randint(1, 60))) for k in range(40)}
    want = {k: brute(t) for k, t in logs.items()}
    for span in (2, 7, 1000):
        found = runlog.scan(lines(spark, **logs), span=span)
        assert rows(runlog.listed_files(found)) == sorted(
            ((k, i, t) for k, (lists, _, _) in want.items() for x in lists for i, t in x), key=repr)
        assert rows(runlog.updated_html(found)) == sorted(((k, n, i) for k, (_, p, _) in want.items() for n, i in p.items()), key=repr)
        assert rows(runlog.change_stats(found)) == sorted(((k, i, t) for k, (_, _, s) in want.items() for i, t in s), key=repr)


def test_one_pass_and_few_shuffles(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for report in (runlog.listed_files, runlog.updated_html, runlog.summary_lines):
            plan = report(lines(spark, a=LOG), span=5)._jdf.queryExecution().executedPlan().toString()
            # one more shuffle dealt the lines to the stored spans
            assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") <= 4, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
