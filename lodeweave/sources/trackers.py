"""Issue tracker pages as tables: issues, pulls, closing references, bugs and comments."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

PAGE = """number bigint, title string, body string, state string, state_reason string, labels array<struct<name string>>,
assignees array<struct<login string>>, user struct<login string>, created_at timestamp, updated_at timestamp, closed_at timestamp,
merged_at timestamp, head struct<sha string>, base struct<ref string>, draft boolean, pull_request struct<url string>"""


def _documents(batches):
    decoder = json.JSONDecoder()
    for batch in batches:
        out = []
        for text in batch.column(0).to_pylist():
            at, text = 0, text or ""
            while at < len(text):
                while at < len(text) and text[at].isspace():
                    at += 1
                if at == len(text):
                    break
                value, at = decoder.raw_decode(text, at)
                out += [json.dumps(v, sort_keys=True) for v in (value if isinstance(value, list) else [value])]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Files of JSON objects, arrays, or several of them back to back -> (value): one JSON object a row."""
    return spark.read.text(path, wholetext=True).mapInArrow(_documents, "value string")


def _names(column: str, field: str):
    return F.transform(F.coalesce(F.col(f"r.{column}"), F.array().cast(f"array<struct<{field} string>>")), lambda x: F.coalesce(x[field], F.lit("")))


def issues(objects: DataFrame, since: str = "2008-01-01") -> DataFrame:
    """Issues of pages, without the pulls among them, changed since a time (not before 2008)."""
    r = objects.select(F.from_json("value", PAGE).alias("r"), F.col("value").alias("raw_json"))
    cut = F.greatest(F.lit(since).cast("timestamp"), F.lit("2008-01-01").cast("timestamp"))
    return r.where(F.col("r.number").isNotNull() & F.col("r.pull_request").isNull() & (F.col("r.updated_at") >= cut)).select(
        F.col("r.number").alias("issue_number"), F.coalesce("r.title", F.lit("")).alias("title"), F.col("r.body"), "r.state", "r.state_reason",
        _names("labels", "name").alias("labels"), _names("assignees", "login").alias("assignees"), F.col("r.user.login").alias("author"), "r.created_at", "r.updated_at", "r.closed_at", "raw_json",
    )


def pulls(objects: DataFrame, since: str = "2008-01-01") -> DataFrame:
    """Pulls of pages changed since a time; a pull with a merge time is merged whatever its state says."""
    r = objects.select(F.from_json("value", PAGE).alias("r"))
    state = F.when(F.col("r.merged_at").isNotNull(), "merged").otherwise(F.col("r.state"))
    return r.where(F.col("r.number").isNotNull() & (F.col("r.updated_at") >= F.lit(since).cast("timestamp"))).select(
        F.col("r.number").alias("pr_number"), F.coalesce("r.title", F.lit("")).alias("title"), F.col("r.body"), state.alias("state"), F.col("r.head.sha").alias("head_sha"),
        F.col("r.base.ref").alias("base_branch"), "r.merged_at", F.col("r.user.login").alias("author"), F.coalesce("r.draft", F.lit(False)).alias("draft"), "r.updated_at",
    )


CLOSING = """data struct<repository struct<pullRequests struct<nodes array<struct<number bigint,
closingIssuesReferences struct<nodes array<struct<number bigint>>>>>>>>"""


def closing_references(objects: DataFrame) -> DataFrame:
    """(pr_number, issue_number) edges of nested pages; nulls at any level give no edge."""
    node = objects.select(F.explode(F.from_json("value", CLOSING)["data"]["repository"]["pullRequests"]["nodes"]).alias("p"))
    return node.select(F.col("p.number").alias("pr_number"), F.explode("p.closingIssuesReferences.nodes.number").alias("issue_number")).where("pr_number is not null and issue_number is not null").distinct()


BUG = "id bigint, summary string, component string, severity string, status string, resolution string, creation_time timestamp, last_change_time timestamp, assigned_to string"


def bugs(objects: DataFrame, since: str | None = None) -> DataFrame:
    """Bugs of REST pages; the last second before the watermark is read again."""
    out = objects.select(F.inline(F.from_json("value", f"bugs array<struct<{_colons(BUG)}>>")["bugs"]))
    return out.where(F.col("last_change_time") >= F.lit(since).cast("timestamp") - F.expr("interval 1 second")) if since else out


def comments(objects: DataFrame) -> DataFrame:
    """(bug_id, ordinal, creator, text, creation_time): comment 0 is the description."""
    entry = "struct<comments:array<struct<id:bigint,creator:string,text:string,creation_time:timestamp>>>"
    bug = objects.select(F.explode(F.from_json("value", f"bugs map<string,{entry}>")["bugs"]).alias("k", "v"))
    return bug.select(F.col("k").cast("bigint").alias("bug_id"), F.posexplode("v.comments").alias("ordinal", "c")).select("bug_id", "ordinal", "c.creator", "c.text", "c.creation_time")


def described(bug_rows: DataFrame, comment_rows: DataFrame) -> DataFrame:
    """Bugs with their description and all comments in order, joined by line feeds."""
    text = comment_rows.groupBy("bug_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", F.coalesce("text", F.lit("")).alias("t")))).alias("cs"))
    return bug_rows.join(text, bug_rows.id == text.bug_id, "left").select(
        *bug_rows.columns, F.coalesce(F.get("cs", F.lit(0))["t"], F.lit("")).alias("description"), F.coalesce(F.array_join(F.transform("cs", lambda c: c["t"]), "\n"), F.lit("")).alias("comment_text")
    )


def _colons(ddl: str) -> str:
    return ",".join(":".join(f.split()) for f in ddl.split(","))
