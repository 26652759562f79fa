"""Link queries over issues, pulls, changes, commits and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodeweave.functions import text as T
from lodeweave.operators import linking as L
from lodeweave.session import read


def _pulls(spark, sf_dir) -> DataFrame:
    return L.current(read(spark, sf_dir, "pulls"), "pr_number").where("deleted_at is null")


def _issues(spark, sf_dir) -> DataFrame:
    return L.current(read(spark, sf_dir, "issues"), "issue_number", "updated_at", "state", "title")


def jo_temporal(spark, sf_dir):
    return L.temporal_links(_issues(spark, sf_dir), _pulls(spark, sf_dir))


def jo_body(spark, sf_dir):
    return L.body_links(_pulls(spark, sf_dir))


def jo_merged(spark, sf_dir):
    """Both kinds of derived links and the stored ones, merged; the map of signals as sorted text."""
    stored = read(spark, sf_dir, "issue_pr_links", "issue_number", "pr_number", "confidence", "source")
    every = stored.unionByName(jo_temporal(spark, sf_dir)).unionByName(jo_body(spark, sf_dir))
    merged = L.merge_links(every)
    signals = F.array_join(F.transform(F.map_entries("signals"), lambda e: F.concat(e["key"], F.lit("="), F.format_string("%.2f", e["value"]))), ";")
    return merged.withColumn("signals", signals)


def jo_fix_candidates(spark, sf_dir):
    """Issues and changes of one person at most 60 days apart, scored by the signals that fire."""
    issues = _issues(spark, sf_dir).select("issue_number", "title", "state", F.col("updated_at").alias("changed"), F.explode("assignees").alias("author")).where("author <> ''")
    changes = L.current(read(spark, sf_dir, "changes"), "cl_number").where("deleted_at is null and submitted_at is not null").select("cl_number", "author", "submitted_at", "description")
    pairs = L.within_days(issues, changes, ["author"], "changed", "submitted_at", 60)
    days = F.floor((F.unix_micros("submitted_at") - F.unix_micros("changed")) / 86_400_000_000)
    total = L.score(
        {
            "same_person": (F.lit(True), "0.20"),
            "closed": (F.col("state") == "closed", "0.10"),
            "near": (F.abs(days) <= 7, "0.50"),
            "fix": (F.lower("description").startswith("fix"), "0.20"),
        }
    )
    return pairs.select("issue_number", "cl_number", days.cast("bigint").alias("days"), total.cast("double").alias("confidence")).distinct().where("confidence >= 0.8")


def jo_best_pull(spark, sf_dir):
    links = read(spark, sf_dir, "issue_pr_links", "issue_number", "pr_number", "confidence", "extracted_at").where("confidence >= 0.8")
    return L.top_per_key(links, ["issue_number"], [F.desc("confidence"), "pr_number", F.desc("extracted_at")]).select("issue_number", "pr_number", "confidence")


def jo_first_chunks(spark, sf_dir):
    """The first three chunks of every changelist, joined by blank lines."""
    chunks = read(spark, sf_dir, "cl_chunks", "chunk_id", "cl_number", "chunk_text").where("cl_number is not null").distinct()
    first = L.top_per_key(chunks, ["cl_number"], ["chunk_id", "chunk_text"], 3)
    ordered = F.array_sort(F.collect_list(F.struct("chunk_id", F.coalesce("chunk_text", F.lit("")).alias("t"))))
    return first.groupBy("cl_number").agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "\n\n").alias("excerpt"))


def jo_commit_pulls(spark, sf_dir):
    """Pull numbers named in commit subjects against the stored ones."""
    commits = L.current(read(spark, sf_dir, "commits", "sha", "message", "pr_number", "indexed_at"), "sha", "pr_number", "message")
    named = T.pull_of_subject(T.subject(F.col("message")))
    return commits.select("sha", named.alias("named"), "pr_number", named.eqNullSafe(F.col("pr_number")).alias("agrees"))


def jo_corroborated(spark, sf_dir):
    links = read(spark, sf_dir, "issue_pr_links", "issue_number", "pr_number", "confidence", "source").withColumn("source", F.explode(F.split("source", ",")))
    return L.corroborated(links)


def jo_co_change(spark, sf_dir):
    """Directories of the depot that change in one changelist, in both directions."""
    chunks = read(spark, sf_dir, "cl_chunks", "cl_number", "file_path")
    return L.co_changed(chunks.withColumn("dir", F.regexp_extract("file_path", r"^//depot/[^/]+/([^/]+)/", 1)).where("dir <> ''"), "cl_number", "dir")


def jo_touched_by_fix(spark, sf_dir):
    """Files that changelists of an issue's assignee touched within a week of its closing: two equi-joins."""
    issues = _issues(spark, sf_dir).where("closed_at is not null").select("issue_number", "closed_at", F.explode("assignees").alias("author")).where("author <> ''")
    changes = L.current(read(spark, sf_dir, "changes"), "cl_number").where("deleted_at is null and submitted_at is not null").select("cl_number", "author", "submitted_at")
    near = L.within_days(issues, changes, ["author"], "closed_at", "submitted_at", 7).select("issue_number", "cl_number").distinct()
    files = read(spark, sf_dir, "cl_chunks", "cl_number", "file_path").where("file_path is not null").distinct()
    return near.join(files, "cl_number").groupBy("issue_number").agg(F.countDistinct("file_path").alias("files"), F.countDistinct("cl_number").alias("changes"))


_CUR = """with p as (select * from pulls where pr_number is not null qualify row_number() over (partition by pr_number order by indexed_at desc) = 1),
pulls1 as (select * from p where deleted_at is null),
issues1 as (select * from issues where issue_number is not null qualify row_number() over (partition by issue_number order by indexed_at desc, updated_at desc nulls last, state desc nulls last, title desc nulls last) = 1),
c as (select * from changes where cl_number is not null qualify row_number() over (partition by cl_number order by indexed_at desc) = 1),
changes1 as (select * from c where deleted_at is null and submitted_at is not null),
assigned as (select issue_number, title, state, closed_at, updated_at, unnest(assignees) as author from issues1),
temporal as (select distinct issue_number, pr_number, 0.5 as confidence, 'temporal_author' as source from assigned a join pulls1 p on a.author = p.author
  where a.author <> '' and not coalesce(draft, false) and abs(epoch_us(closed_at) - epoch_us(merged_at)) <= 604800000000),
body as (select distinct cast(unnest(regexp_extract_all(body, '(?i)\\b(?:close[sd]?|fix(?:es|ed)?|resolve[sd]?)\\s+#(\\d{1,6})\\b', 1)) as bigint) as issue_number, pr_number, 0.85 as confidence, 'body_closes_keyword' as source
  from pulls1 where not coalesce(draft, false))
"""

QUERIES = {f.__name__: f for f in (jo_temporal, jo_body, jo_merged, jo_fix_candidates, jo_best_pull, jo_first_chunks, jo_commit_pulls, jo_corroborated, jo_co_change, jo_touched_by_fix)}
SQL = {
    "jo_temporal": _CUR + "select issue_number, pr_number, confidence::double as confidence, source from temporal",
    "jo_body": _CUR + "select issue_number, pr_number, confidence::double as confidence, source from body",
    "jo_merged": _CUR
    + """, every as (select issue_number, pr_number, confidence::double as confidence, source from issue_pr_links union all select issue_number, pr_number, confidence::double, source from temporal union all select issue_number, pr_number, confidence::double, source from body),
one as (select issue_number, pr_number, max(confidence) as confidence, source from (select issue_number, pr_number, confidence, unnest(string_split(source, ',')) as source from every) group by issue_number, pr_number, source)
select issue_number, pr_number, max(confidence) as confidence, string_agg(source, ',' order by source) as source,
  string_agg(source || '=' || printf('%.2f', confidence), ';' order by source) as signals from one group by 1, 2""",
    "jo_fix_candidates": _CUR
    + """select * from (select distinct issue_number, cl_number, cast(floor((epoch_us(submitted_at) - epoch_us(updated_at)) / 86400000000) as bigint) as days,
  cast(least(1.0, 0.20 + case when state = 'closed' then 0.10 else 0 end + case when abs(floor((epoch_us(submitted_at) - epoch_us(updated_at)) / 86400000000)) <= 7 then 0.50 else 0 end
    + case when lower(description) like 'fix%' then 0.20 else 0 end) as double) as confidence
  from assigned a join changes1 c on a.author = c.author where a.author <> '' and abs(epoch_us(updated_at) - epoch_us(submitted_at)) <= 5184000000000) where round(confidence, 6) >= 0.8""",
    "jo_best_pull": "select issue_number, pr_number, confidence from issue_pr_links where confidence >= 0.8 qualify row_number() over (partition by issue_number order by confidence desc, pr_number, extracted_at desc) = 1",
    "jo_first_chunks": """select cl_number, string_agg(coalesce(chunk_text, ''), chr(10) || chr(10) order by chunk_id, coalesce(chunk_text, '')) as excerpt from (
  select * from (select distinct chunk_id, cl_number, chunk_text from cl_chunks where cl_number is not null)
  qualify row_number() over (partition by cl_number order by chunk_id, chunk_text nulls first) <= 3) group by 1""",
    "jo_commit_pulls": """with cur as (select sha, split_part(message, chr(10), 1) as s, pr_number from commits where sha is not null
  qualify row_number() over (partition by sha order by indexed_at desc, pr_number desc nulls last, message desc nulls last) = 1),
named as (select sha, pr_number, cast(coalesce(nullif(regexp_extract(s, '\\(#(\\d+)\\)\\s*$', 1), ''), nullif(regexp_extract(s, '^Merge pull request #(\\d+)\\b', 1), ''), nullif(regexp_extract(s, '^Merges PR #(\\d+)\\b', 1), '')) as bigint) as named from cur)
select sha, named, pr_number, named is not distinct from pr_number as agrees from named""",
    "jo_corroborated": """with s as (select issue_number, pr_number, source, max(confidence) as c from (select issue_number, pr_number, confidence, unnest(string_split(source, ',')) as source from issue_pr_links) group by 1, 2, 3)
select issue_number, pr_number, count(*) as sources, round(case when max(c) >= 1 then 1.0 else least(0.99, 1 - product(1 - c)) end, 6) as confidence from s group by 1, 2""",
    "jo_co_change": """with p as (select distinct cl_number as e, regexp_extract(file_path, '^//depot/[^/]+/([^/]+)/', 1) as i from cl_chunks where cl_number is not null and file_path is not null),
q as (select * from p where i <> ''), k as (select * from q where e in (select e from q group by e having count(*) between 2 and 12))
select x.i as a, y.i as b, count(*) as support, least(0.95, round(count(*) / (count(*) + 2), 6)) as confidence from k x join k y on x.e = y.e and x.i <> y.i group by 1, 2 having count(*) >= 2""",
    "jo_touched_by_fix": _CUR
    + """, near as (select distinct issue_number, cl_number from assigned a join changes1 c on a.author = c.author where a.author <> '' and abs(epoch_us(closed_at) - epoch_us(submitted_at)) <= 604800000000)
select issue_number, count(distinct file_path) as files, count(distinct cl_number) as changes from near join cl_chunks using (cl_number) where file_path is not null group by 1""",
}
