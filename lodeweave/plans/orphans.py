"""Queries on references whose record is missing, withdrawn or late."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodeweave.operators import references as R
from lodeweave.session import discard, materialize, read


def _references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    commits = R.references(read(spark, sf_dir, "commits", "sha", "pr_number", "indexed_at"), "commits", F.col("sha"), "pr_number", "indexed_at")
    links = read(spark, sf_dir, "issue_pr_links", "issue_number", "pr_number", "extracted_at")
    pair = F.concat(F.coalesce(F.col("issue_number").cast("string"), F.lit("")), F.lit(":"), F.col("pr_number").cast("string"))
    chunks = R.references(read(spark, sf_dir, "cl_chunks", "chunk_id", "cl_number", "indexed_at"), "cl_chunks", F.col("chunk_id"), "cl_number", "indexed_at")
    return R.union_all([commits, R.references(links, "issue_pr_links", pair, "pr_number", "extracted_at")]), chunks


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    to_pulls, to_changes = _references(spark, sf_dir)
    pulls = read(spark, sf_dir, "pulls", "pr_number", "indexed_at", "deleted_at")
    changes = read(spark, sf_dir, "changes", "cl_number", "indexed_at", "deleted_at")
    return R.orphan_references(to_pulls, pulls, "pr_number").unionByName(R.orphan_references(to_changes, changes, "cl_number"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans(spark, sf_dir).select("ref_table", "ref_key", "target_key")


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references per table, month of storing and reason."""
    return (
        orphans(spark, sf_dir)
        .groupBy("ref_table", F.date_format("first_at", "yyyy-MM").alias("month"), "reason")
        .agg(F.count(F.lit(1)).alias("references"), F.countDistinct("target_key").alias("targets"))
    )


def p1_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current orphan keys of both record tables with their signed reference counts."""
    to_pulls, to_changes = _references(spark, sf_dir)
    out = []
    for refs, table, number in ((to_pulls, "pulls", "pr_number"), (to_changes, "changes", "cl_number")):
        records = read(spark, sf_dir, table, number, "indexed_at", "deleted_at")
        state = R.key_state(R.reference_deltas(refs).unionByName(R.existence_deltas(records, number)))
        out.append(R.orphan_keys(state).withColumn("record_table", F.lit(table)))
    return R.union_all(out)


def p1_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current orphan keys from the maintained counts: the tables are folded in quarter by quarter, in order of storing."""
    to_pulls, to_changes = _references(spark, sf_dir)
    out = []
    for refs, table, number in ((to_pulls, "pulls", "pr_number"), (to_changes, "changes", "cl_number")):
        records = read(spark, sf_dir, table, number, "indexed_at", "deleted_at")
        quarter = lambda c: F.coalesce(F.date_format(F.date_trunc("quarter", c), "yyyy-MM"), F.lit(""))
        refs, records = refs.withColumn("quarter", quarter("first_at")), records.withColumn("quarter", quarter("indexed_at"))
        quarters = sorted(r[0] for r in refs.select("quarter").union(records.select("quarter")).distinct().collect())  # as many as the calendar has
        state = spark.createDataFrame([], R.STATE)
        for one in quarters:
            # references come once each here; a feed that repeats them asks unseen() first
            deltas = R.batch_deltas(state, refs.where(F.col("quarter") == one), records.where(F.col("quarter") == one), number)
            before, state = state, materialize(R.add_deltas(state, deltas), "keys")
            discard(before)
        out.append(R.orphans_of_state(state).withColumn("record_table", F.lit(table)))
    return R.union_all(out)


_REFS = """
with refs as (
  select 'commits' as ref_table, coalesce(sha, '') as ref_key, pr_number as target_key, min(indexed_at) as first_at
  from commits where pr_number is not null group by 1, 2, 3
  union all
  select 'issue_pr_links', coalesce(cast(issue_number as varchar), '') || ':' || cast(pr_number as varchar), pr_number, min(extracted_at)
  from issue_pr_links where pr_number is not null group by 1, 2, 3
  union all
  select 'cl_chunks', coalesce(cast(chunk_id as varchar), ''), cl_number, min(indexed_at)
  from cl_chunks where cl_number is not null group by 1, 2, 3
), rec as (
  select 'pulls' as record_table, pr_number as target_key, indexed_at, deleted_at from pulls where pr_number is not null
  union all
  select 'changes', cl_number, indexed_at, deleted_at from changes where cl_number is not null
), latest as (
  select record_table, target_key, min(indexed_at) as first_row, max(indexed_at) as last_row from rec group by 1, 2
), st as (
  select l.record_table, l.target_key, l.first_row, max(case when r.deleted_at is not null then 1 else 0 end) as gone
  from latest l join rec r on r.record_table = l.record_table and r.target_key = l.target_key and r.indexed_at is not distinct from l.last_row
  group by 1, 2, 3
), found as (
  select refs.*, case when ref_table = 'cl_chunks' then 'changes' else 'pulls' end as record_table,
    case when st.target_key is null then 'missing' when st.gone = 1 then 'withdrawn' when st.first_row > refs.first_at then 'later' end as reason
  from refs left join st on st.target_key = refs.target_key
    and st.record_table = case when ref_table = 'cl_chunks' then 'changes' else 'pulls' end
)
"""

QUERIES = {"p1_found": p1_found, "p1_report": p1_report, "p1_keys": p1_keys, "p1_folded": p1_folded}
SQL = {
    "p1_found": _REFS + "select ref_table, ref_key, target_key from found where reason is not null",
    "p1_report": _REFS
    + """select ref_table, strftime(first_at, '%Y-%m') as month, reason, count(*) as "references", count(distinct target_key) as targets
from found where reason is not null group by 1, 2, 3""",
    **dict.fromkeys(("p1_keys", "p1_folded"), _REFS + "select target_key, count(*) as refs, reason, record_table from found where reason in ('missing', 'withdrawn') group by 1, 3, 4"),
}
