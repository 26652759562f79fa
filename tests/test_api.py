import pytest

from lodeweave.api import Store
from lodeweave.functions.embedding import hashing_vectors, vector_of
from pyspark.sql import functions as F


def test_arguments_are_checked(spark, sf_dir):
    store = Store(spark, sf_dir)
    for bad in (("", 5), ("  ", 5), ("x", 0), ("x", 21)):
        with pytest.raises(ValueError):
            store.find_similar_issues(*bad)
    with pytest.raises(ValueError):
        store.find_similar_issues("x", 5, 1.5)


def test_an_issue_finds_itself(spark, sf_dir):
    store = Store(spark, sf_dir)
    issue = store.issues().where("body is not null").orderBy("issue_number").first()
    top = store.find_similar_issues(f"{issue.title} {issue.body}", 3).collect()
    assert top[0].issue_number == issue.issue_number and [r["rank"] for r in top] == [1, 2, 3] and all(r.confidence >= 0 for r in top)


def test_documents_changes_and_grep(spark, sf_dir):
    store = Store(spark, sf_dir)
    assert store.search_docs("which timeout of the sender", 4).count() == 4
    assert store.find_similar_changes("fix the reader", 2).count() == 2
    assert store.grep(r"^#", 5).count() <= 5


def test_pull_diffs(spark, sf_dir):
    store = Store(spark, sf_dir)
    row = store.pulls().where("length(diff_text) > 200").orderBy("pr_number").first()
    cut = store.get_pull_diff(row.pr_number, 100)
    assert cut.truncated and cut.diff.startswith(row.diff_text[:100]) and f"full diff is {len(row.diff_text)} chars" in cut.diff
    assert not store.get_pull_diff(row.pr_number, 10**7).truncated
    with pytest.raises(KeyError):
        store.get_pull_diff(-5)
    change = store.changes().where("length(diff_text) > 0").orderBy("cl_number").first()
    assert store.get_change_files(change.cl_number).count() >= 1


def test_hashed_vectors_are_units(spark):
    rows = hashing_vectors(spark.createDataFrame([(1, "a b"), (2, None), (None, "x"), (3, "!!")], "k bigint, t string"), "k", F.col("t"), 64).collect()
    assert {r.id for r in rows} == {1, 2, 3} and all(abs(sum(x * x for x in r.v) - 1) < 1e-5 for r in rows)
    assert vector_of("", 8, {})[0] == 1.0
