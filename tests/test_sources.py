import json
import marshal
from datetime import datetime as dt

import pytest

from lodeweave.sources import fleet, history, repository, snapshots, trackers
from pyspark.sql import functions as F


def test_tree_with_tracked_files(spark, tmp_path):
    (tmp_path / "src/deep").mkdir(parents=True)
    (tmp_path / "src/deep/a.PY").write_text("print(1)\n")
    (tmp_path / "README.md").write_text("# x")
    (tmp_path / "untracked.txt").write_text("no")
    tracked = spark.createDataFrame([("src/deep/a.PY",), ("README.md",), ("gone.c",)], "relpath string")
    rows = {r.relpath: (r.ext, r.size_bytes, r.content) for r in repository.tree(spark, str(tmp_path), tracked, content=True).collect()}
    assert rows == {"src/deep/a.PY": ("py", 9, "print(1)\n"), "README.md": ("md", 3, "# x")}


def test_documents_and_nested_checkouts(spark):
    there = ["README.md", "README.de.md", "Makefile", "docs/a.md", "docs/x/b.md", "docker-compose.dev.yml", "Dockerfile", "api/Dockerfile", "api/Dockerfile.prod", "run.sh", "wt/one/Dockerfile"]
    away = ["docs/a.png", "x/README.md", "x/Makefile", "x/run.sh", "venv/Dockerfile", "docs/build/a.md", "a.py", "Dockerfiles/x"]
    files = spark.createDataFrame([(x,) for x in [*there, *away, "README.md"]], "relpath string")
    assert sorted(r[0] for r in repository.documents(files).collect()) == sorted(there)
    markers = spark.createDataFrame([("wt/one",)], "dir string")
    assert "wt/one/Dockerfile" not in {r[0] for r in repository.without_nested(files, markers).collect()}
    assert {r[0] for r in repository.below(files, "docs/").collect()} == {"docs/a.md", "docs/x/b.md", "docs/a.png", "docs/build/a.md"}
    assert {r[0] for r in repository.below(files, "docs", ["/*.md"]).collect()} == {"docs/a.md"}


def test_commit_details_and_cursors(spark):
    shown = [("a", "3\t1\tx y.py\n-\t-\tb.bin\n\ndiff --git a/x b/x\n+1\n\ndiff --git a/b b/b\n"), ("b", ""), (None, "x")]
    rows = {r.sha: r for r in history.commit_details(spark.createDataFrame(shown, "sha string, value string")).collect()}
    assert rows["a"].diff_text.startswith("diff --git a/x") and rows["a"].diff_text.count("diff --git") == 2 and (rows["a"].added, rows["a"].deleted) == (3, 1)
    assert [f.path for f in rows["a"].files] == ["x y.py", "b.bin"] and rows["b"].diff_text == "" and rows["b"].files == []
    numbers = spark.createDataFrame([(i,) for i in (5, 3, 9, 7, None)], "cl_number int")
    page = lambda last: [r[0] for r in history.page_after(numbers, "cl_number", last, 2).collect()]
    assert page(None) == [3, 5] and page(5) == [7, 9] and page(9) == []
    commits = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2), ("d", 3)], "sha string, authored_at int")
    assert {r.sha for r in history.after_commit(commits, "b").collect()} == {"c", "d"} and history.after_commit(commits, "zz").count() == 4
    pulls = spark.createDataFrame([(1,), (2,)], "pr_number int")
    assert {r.pr_number: r.diff_text for r in history.with_diffs(pulls, spark.createDataFrame([(1, "d")], "pr_number int, diff_text string")).collect()} == {1: "d", 2: ""}


def test_commit_log_lines(spark):
    sha = "0123456789abcdef0123456789abcdef01234567"
    lines = [f"{sha}|2024-01-02T03:04:05+05:30|a@b|A B|Fix a|b (#42)", f"{sha[:-1]}0|2024-01-02T03:04:05Z|a@b|A|Merge pull request #43 from x", "short|x|y|z|w", "no bars"]
    rows = sorted(history.commit_log(spark.createDataFrame([(x,) for x in lines], "value string")).collect(), key=lambda r: r.sha, reverse=True)
    assert [(r.subject, r.pr_number) for r in rows] == [("Fix a|b (#42)", 42), ("Merge pull request #43 from x", 43)]
    assert rows[0].authored_at == dt(2024, 1, 1, 21, 34, 5)


def test_numstat(spark):
    lines = spark.createDataFrame([("s", "3\t1\ta b.py"), ("s", "-\t-\tx.bin"), ("s", "noise")], "sha string, value string")
    assert {tuple(r) for r in history.numstat(lines, "sha").collect()} == {("s", "a b.py", 3, 1), ("s", "x.bin", 0, 0)}


def test_change_records_unpivot(spark, tmp_path):
    with open(tmp_path / "a.bin", "wb") as f:
        marshal.dump({b"change": b"12", b"user": b"u", b"time": b"1700000000", b"desc": b"d", b"depotFile0": b"//x", b"action0": b"edit", b"rev0": b"5", b"depotFile1": b"//y"}, f)
        marshal.dump({b"change": b"13", b"user": b"v"}, f)
    rows = {r.cl_number: r for r in history.described_changes(history.change_records(spark, f"{tmp_path}/*.bin")).collect()}
    assert [(x.path, x.action, x.rev) for x in rows[12].files] == [("//x", "edit", 5), ("//y", None, None)]
    assert rows[13].files == [] and rows[13].submitted_at is None


def test_pages_back_to_back(spark, tmp_path):
    one = [{"number": 1, "title": "t", "labels": [{"name": "bug"}, {"name": None}], "user": {"login": "u"}, "updated_at": "2024-01-01T00:00:00Z", "state": "open"}, {"number": 2, "pull_request": {"url": "x"}, "updated_at": "2024-01-01T00:00:00Z"}]
    two = {"number": 3, "updated_at": "2024-02-01T00:00:00Z", "body": None}
    (tmp_path / "p.json").write_text(json.dumps(one) + "\n" + json.dumps(two) + json.dumps([]))
    rows = {r.issue_number: r for r in trackers.issues(trackers.pages(spark, str(tmp_path))).collect()}
    assert set(rows) == {1, 3} and rows[1].labels == ["bug", ""] and rows[3].assignees == [] and rows[3].title == ""
    assert {r.issue_number for r in trackers.issues(trackers.pages(spark, str(tmp_path)), "2024-01-15").collect()} == {3}


def test_pulls_and_closing_references(spark):
    page = [json.dumps({"number": 5, "state": "closed", "merged_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-02T00:00:00Z", "head": {"sha": "s"}, "base": {"ref": "main"}}), json.dumps({"number": 6, "state": "open", "draft": True, "updated_at": "2024-01-02T00:00:00Z"})]
    rows = {r.pr_number: r for r in trackers.pulls(spark.createDataFrame([(p,) for p in page], "value string")).collect()}
    assert rows[5].state == "merged" and rows[5].draft is False and rows[6].draft is True
    nested = {"data": {"repository": {"pullRequests": {"nodes": [{"number": 1, "closingIssuesReferences": {"nodes": [{"number": 7}, {"number": 8}]}}, {"number": 2, "closingIssuesReferences": None}, None]}}}}
    edges = trackers.closing_references(spark.createDataFrame([(json.dumps(nested),), (json.dumps({"data": None}),)], "value string"))
    assert {tuple(r) for r in edges.collect()} == {(1, 7), (1, 8)}


def test_bugs_with_comments(spark):
    bug = json.dumps({"bugs": [{"id": 9, "summary": "s", "last_change_time": "2024-01-01T00:00:00Z"}, {"id": 10, "last_change_time": "2023-12-31T23:59:59Z"}]})
    talk = json.dumps({"bugs": {"9": {"comments": [{"id": 1, "text": "first"}, {"id": 2, "text": "second"}]}}})
    bugs = trackers.bugs(spark.createDataFrame([(bug,)], "value string"), "2024-01-01 00:00:00")
    assert {r.id for r in bugs.collect()} == {9, 10}
    rows = {r.id: r for r in trackers.described(bugs, trackers.comments(spark.createDataFrame([(talk,)], "value string"))).collect()}
    assert (rows[9].description, rows[9].comment_text, rows[10].description) == ("first", "first\nsecond", "")


def test_sweeps_reports_logs_and_monitor(spark, tmp_path):
    state = {"sweep": "s", "jobs": {"a": {"id": "a", "status": "done", "task_mean": 0.0}, "b": {"id": "b", "status": "done"}}}
    (tmp_path / "state.json").write_text(json.dumps(state, indent=1))
    jobs = fleet.with_reports(fleet.sweep_jobs(spark, str(tmp_path)), spark.createDataFrame([("a", 0.9), ("b", 0.4)], "job_id string, task_mean double"))
    assert {r.job_id: r.task_mean for r in jobs.collect()} == {"a": 0.0, "b": 0.4}
    log = spark.createDataFrame([(1, "train_loss=1.5 train_loss=0.25"), (2, "train_loss: nan"), (3, "none")], "k int, t string")
    got = {r.k: r.train_loss for r in fleet.last_loss(log, "k", "t").collect()}
    assert got[1] == 0.25 and got[2] != got[2] and got[3] is None
    rows = fleet.gpu_rows(spark.createDataFrame([("0, 71 , 5",), ("1",), ("",)], "value string"), ["gpu", "temp", "load"]).collect()
    assert [tuple(r) for r in rows] == [("0", "71", "5"), ("1", "", "")]


def test_a_failed_merge_leaves_the_table(spark, tmp_path):
    table = snapshots.KeyedTable(spark, f"{tmp_path}/t", "id", "id bigint", 4)
    assert table.read().count() == 0
    table.merge(spark.range(3), lambda stored, new: stored.union(new).distinct())

    def fail(x):
        raise RuntimeError("no")

    with pytest.raises(Exception):
        table.merge(spark.range(9).select(F.udf(fail, "bigint")("id").alias("id")), lambda stored, new: stored.union(new))
    assert sorted(r.id for r in table.read().collect()) == [0, 1, 2]


def test_sample_sink_and_text_source(spark, tmp_path):
    rows = spark.createDataFrame([("train", "a", 1), ("train", "b", None), ("test", "c", 3)], "split string, text string, n int")
    snapshots.write_samples(rows, f"{tmp_path}/out")
    assert sorted(r.text for r in snapshots.read_text_only(spark, f"{tmp_path}/out").collect()) == ["a", "b", "c"]
    assert snapshots.manifest(rows, repo="r") == {"repo": "r", "totals": {"train": 2, "test": 1}}


def test_code_facts(spark):
    from lodeweave.sources import code

    files = [("a.py", "import os\nfrom .x import y\nclass A:\n    def f(self):\n        os.walk(g())\n        raise ValueError('x')\n"), ("bad.py", "def (:\n"), ("b.rs", "use crate::m::N;\npub fn run() {}\nfn go() {}\n"), ("c.py", None), (None, "x = 1")]
    got = {tuple(r) for r in code.code_facts(spark.createDataFrame(files, "path string, content string")).collect()}
    want = {("a.py", *x) for x in [("imports", "os"), ("imports", ".x"), ("defines", "A"), ("defines", "f"), ("calls", "walk"), ("calls", "g"), ("calls", "ValueError"), ("raises", "ValueError")]}
    assert got == want | {("b.rs", "imports", "crate::m::N"), ("b.rs", "defines", "run"), ("b.rs", "defines", "go")}


def test_reports_hold_no_responses(spark, tmp_path):
    tasks = spark.createDataFrame([("t1", 0.5, "secret answer"), ("t2", None, "x")], "id string, score double, response string")
    snapshots.write_report(tasks, f"{tmp_path}/r", perplexity=1.5, task_mean=0.5)
    assert {tuple(r) for r in spark.read.schema("id string, score double").json(f"{tmp_path}/r/tasks").collect()} == {("t1", 0.5), ("t2", None)}
    assert "response" not in spark.read.json(f"{tmp_path}/r/tasks").columns and spark.read.json(f"{tmp_path}/r/summary").first().perplexity == 1.5
