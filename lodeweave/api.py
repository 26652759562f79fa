"""Search and lookup functions over the tables of one store, for callers with one question at a time."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from lodeweave.functions.embedding import hashing_vectors
from lodeweave.functions.globs import any_of
from lodeweave.operators import chunks as C, retrieval as R
from lodeweave.operators.linking import current, top_per_key
from lodeweave.session import read

MOST = 20
CANDIDATES = 20


def check(query: str, k: int, confidence: float = 0.0) -> None:
    if not query or not query.strip():
        raise ValueError("the query is empty")
    if not 1 <= k <= MOST:
        raise ValueError(f"k must be from 1 to {MOST}")
    if not 0 <= confidence <= 1:
        raise ValueError("confidence must be from 0 to 1")


def hybrid(docs: DataFrame, id_col: str, text, queries: DataFrame, k: int, mode: str = "and_or") -> DataFrame:
    """queries(query bigint, text) -> (query, doc, score, rank): nearest hashed vectors and BM25, fused."""
    near = R.nearest(hashing_vectors(queries, "query", F.col("text")), hashing_vectors(docs, id_col, text), CANDIDATES)
    lexical = R.bm25(docs, id_col, text, R.query_terms(queries, "query", F.col("text")), CANDIDATES, mode)
    return R.fuse([near, lexical], k)


def with_fixes(hits: DataFrame, issues: DataFrame, links: DataFrame, pulls: DataFrame, min_confidence: float) -> DataFrame:
    """Hits with title, state, excerpt, and the best linked pull with its first three hunks; 0.0 where none is linked."""
    best = top_per_key(links.where(F.col("confidence") >= min_confidence), ["issue_number"], [F.desc("confidence"), "pr_number"]).select("issue_number", "pr_number", "confidence")
    hunks = C.hunks(C.diff_files(pulls, "pr_number", "diff_text"), "pr_number")
    first = top_per_key(hunks, ["pr_number"], ["file_index", "hunk_index"], 3)
    excerpt = first.groupBy("pr_number").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("file_index", "hunk_index", "hunk"))), lambda x: x["hunk"]), "\n\n").alias("fix_excerpt"))
    meta = issues.select("issue_number", "title", "state", F.substring("body", 1, 500).alias("excerpt")).join(best, "issue_number", "left").join(excerpt, "pr_number", "left")
    return hits.join(meta, hits.doc == meta.issue_number).drop("doc").withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))


class Store:
    """Tables of one folder; every method returns a DataFrame or one row."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _query(self, text: str) -> DataFrame:
        return self.spark.createDataFrame([(0, text)], "query bigint, text string")

    def issues(self) -> DataFrame:
        return current(read(self.spark, self.folder, "issues"), "issue_number", "updated_at", "state", "title")

    def pulls(self) -> DataFrame:
        return current(read(self.spark, self.folder, "pulls"), "pr_number").where("deleted_at is null")

    def changes(self) -> DataFrame:
        return current(read(self.spark, self.folder, "changes"), "cl_number").where("deleted_at is null")

    def find_similar_issues(self, query: str, k: int = 5, min_confidence: float = 0.8) -> DataFrame:
        check(query, k, min_confidence)
        issues = self.issues()
        hits = hybrid(issues, "issue_number", F.concat_ws("\n", "title", "body"), self._query(query), k)
        return with_fixes(hits, issues, read(self.spark, self.folder, "issue_pr_links"), self.pulls(), min_confidence).orderBy("rank")

    def search_docs(self, query: str, k: int = 5) -> DataFrame:
        check(query, k)
        docs = read(self.spark, self.folder, "documents", "doc_id", "source", "text")
        hits = hybrid(docs, "doc_id", F.col("text"), self._query(query), k)
        return hits.join(docs, hits.doc == docs.doc_id).select("doc_id", "source", "score", "rank", F.substring("text", 1, 1500).alias("excerpt")).orderBy("rank")

    def find_similar_changes(self, query: str, k: int = 5) -> DataFrame:
        check(query, k)
        changes = self.changes()
        hits = hybrid(changes, "cl_number", F.col("description"), self._query(query), k)
        return hits.join(changes, hits.doc == changes.cl_number).select("cl_number", "author", "description", "score", "rank", F.substring("diff_text", 1, 800).alias("excerpt")).orderBy("rank")

    def get_pull_diff(self, number: int, max_chars: int = 20_000) -> Row:
        """The diff of a pull, cut with a marker; KeyError when there is none."""
        from lodeweave.functions.text import truncated

        diff = F.coalesce("diff_text", F.lit(""))
        row = self.pulls().where(F.col("pr_number") == number).select("pr_number", truncated(diff, max_chars).alias("diff"), (F.length(diff) > max_chars).alias("truncated")).first()
        if row is None:
            raise KeyError(number)
        return row

    def get_change_files(self, number: int) -> DataFrame:
        """The blocks of a changelist per file; a diff without headers is one block without a path."""
        rows = self.changes().where(F.col("cl_number") == number).where("length(diff_text) > 0")
        files = C.diff_files(rows, "cl_number", "diff_text").select("cl_number", "file_path", "block")
        bare = rows.where(~F.col("diff_text").rlike(C.GIT_HEADER)).select("cl_number", F.lit("").alias("file_path"), F.col("diff_text").alias("block"))
        return files.unionByName(bare)

    def list_files(self, repo: str, part: str = "", patterns: list[str] | None = None) -> DataFrame:
        files = read(self.spark, self.folder, "file_records", "repo", "relpath").where(F.col("repo") == repo).distinct()
        files = files.where(F.lower("relpath").contains(part.lower()))
        return files.where(F.col("relpath").rlike(any_of(patterns))) if patterns else files

    def grep(self, pattern: str, max_results: int = 100) -> DataFrame:
        re.compile(pattern)
        found = C.matching_lines(read(self.spark, self.folder, "documents", "doc_id", "text"), "doc_id", "text", pattern)
        return found.orderBy("doc_id", "line_no").limit(max_results)
