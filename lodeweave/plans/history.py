"""State, fact and graph queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodeweave.operators import graph as G, history as H
from lodeweave.operators.components import connected_components
from lodeweave.operators.linking import current
from lodeweave.session import read


def _facts(spark, sf_dir) -> DataFrame:
    issues = read(spark, sf_dir, "issues", "issue_number", "state", "indexed_at", "updated_at").where("issue_number is not null").distinct()
    return H.intervals(H.changes_only(issues, ["issue_number"], "state", "indexed_at", "updated_at", "state"), ["issue_number"], "indexed_at", "updated_at", "state")


def up_current_pulls(spark, sf_dir):
    return current(read(spark, sf_dir, "pulls", "pr_number", "title", "state", "indexed_at", "deleted_at"), "pr_number").select("pr_number", "title", "state", F.col("deleted_at").isNotNull().alias("withdrawn"))


def up_issue_facts(spark, sf_dir):
    return _facts(spark, sf_dir).select("issue_number", "state", "valid_from", "valid_to")


def up_links_replayed(spark, sf_dir):
    """Links stored in two halves, each overwritten only by strictly higher confidence."""
    links = read(spark, sf_dir, "issue_pr_links", "issue_number", "pr_number", "confidence", "extracted_at").where("extracted_at is not null")
    early, late = links.where("extracted_at < timestamp '2024-07-01'"), links.where("extracted_at >= timestamp '2024-07-01'")
    first = lambda df: H.upsert_links(df.limit(0), df)
    return H.upsert_links(first(early), first(late)).select("issue_number", "pr_number", "confidence")


def jo_state_as_of(spark, sf_dir):
    """The state of the issue when each link was extracted."""
    links = read(spark, sf_dir, "issue_pr_links", "issue_number", "pr_number", "extracted_at").distinct()
    facts = _facts(spark, sf_dir).withColumnRenamed("valid_from", "since")
    return H.as_of(links, facts.select("issue_number", "state", "since"), ["issue_number"], "extracted_at", "since", ["state", "since"])


def ag_counts(spark, sf_dir):
    out = None
    for table, key in (("issues", "issue_number"), ("pulls", "pr_number"), ("commits", "sha"), ("changes", "cl_number"), ("cl_chunks", "chunk_id"), ("issue_pr_links", "issue_number")):
        one = read(spark, sf_dir, table, key).agg(F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("keys"))
        out = one if out is None else out.unionByName(one)
    return out


def ag_link_sources(spark, sf_dir):
    return read(spark, sf_dir, "issue_pr_links", "source").groupBy("source").agg(F.count(F.lit(1)).alias("links"))


def ag_watermarks(spark, sf_dir):
    """The newest stored row of every stream and its key."""
    out = None
    for table, key in (("issues", "issue_number"), ("pulls", "pr_number"), ("changes", "cl_number")):
        one = read(spark, sf_dir, table, key, "indexed_at").agg(F.lit(table).alias("stream"), F.max("indexed_at").alias("watermark"), F.max_by(key, F.struct("indexed_at", key)).alias("last_key"))
        out = one if out is None else out.unionByName(one)
    return out


def ag_checksums(spark, sf_dir):
    files = read(spark, sf_dir, "file_records", "file_id", "repo", "relpath", "size_bytes", "split")
    return files.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), H.checksum(files, ["file_id", "repo", "relpath", "size_bytes"]).alias("checksum"))


def jo_stale_paths(spark, sf_dir):
    """Paths that samples were built from and that no file record of the repository lists any more, with the share per repository."""
    used = read(spark, sf_dir, "samples", F.col("source").alias("repo"), F.col("meta.src_path").alias("relpath")).where("repo is not null and relpath is not null").distinct()
    listed = read(spark, sf_dir, "file_records", "repo", "relpath").distinct().withColumn("_listed", F.lit(1))
    both = used.join(listed, ["repo", "relpath"], "left")
    return both.groupBy("repo").agg(F.count(F.lit(1)).alias("paths"), F.sum(F.when(F.col("_listed").isNull(), 1).otherwise(0)).alias("stale")).withColumn("share", F.round(F.col("stale") / F.col("paths"), 6))


def jo_uncontaminated(spark, sf_dir):
    """Samples whose path no evaluation passage cites."""
    cited = read(spark, sf_dir, "eval_items", "passage").select(F.explode(F.regexp_extract_all("passage", F.lit(r"\b[a-z]+(?:/[a-z_]+)+\.[a-z]+\b"), F.lit(0))).alias("src_path")).distinct()
    return read(spark, sf_dir, "samples", "sample_id", F.col("meta.src_path").alias("src_path")).join(cited, "src_path", "left_anti").select("sample_id")


def ag_fact_health(spark, sf_dir):
    """Per state: facts, current ones, and issues that came back to a state they had left."""
    facts = _facts(spark, sf_dir)
    seen = facts.groupBy("issue_number", "state").agg(F.count(F.lit(1)).alias("times"), F.max(F.when(F.col("valid_to").isNull(), 1).otherwise(0)).alias("open"))
    return seen.groupBy("state").agg(F.sum("times").alias("facts"), F.sum("open").cast("bigint").alias("current"), F.sum(F.when(F.col("times") > 1, 1).otherwise(0)).alias("reopened"))


def _edges(spark, sf_dir) -> DataFrame:
    """Issues and pulls as one graph; pulls carry negative numbers."""
    links = read(spark, sf_dir, "issue_pr_links", "issue_number", "pr_number", "confidence").groupBy("issue_number", "pr_number").agg(F.max("confidence").alias("confidence"))
    there = links.select(F.col("issue_number").alias("src"), (-F.col("pr_number")).alias("dst"), "confidence")
    return there.unionByName(there.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "confidence")).where("src <> 0 and dst <> 0")


def gr_reach(spark, sf_dir):
    """Everything within three links of every issue."""
    edges = _edges(spark, sf_dir)
    return G.reach(edges, edges.where("src > 0").select("src").distinct(), 3)


def gr_paths(spark, sf_dir):
    """Shortest paths of at most three links with their weakest confidence."""
    edges = _edges(spark, sf_dir)
    found = G.best_paths(edges, edges.where("src > 0").select("src").distinct(), 3)
    return found.select("src", "dst", "hops", "confidence", F.array_join(F.transform("path", lambda x: x.cast("string")), ">").alias("path"))


def gr_components(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    return connected_components(edges.select(F.col("src").alias("a"), F.col("dst").alias("b")))


def gr_decayed(spark, sf_dir):
    """Confidence of links that halves every 60 days before the newest; certain ones do not fade."""
    links = read(spark, sf_dir, "issue_pr_links", "issue_number", "pr_number", "confidence", "extracted_at")
    newest = links.agg(F.max(F.unix_micros("extracted_at"))).first()[0]
    age = (F.lit(newest) - F.unix_micros("extracted_at")) / 86_400_000_000
    faded = F.when(F.col("confidence") >= 1, F.col("confidence")).otherwise(H.decayed(F.col("confidence"), age))
    return links.groupBy("pr_number").agg(F.round(F.max(faded), 6).alias("confidence"), F.count(F.lit(1)).alias("links"))


_FACTS = """with i as (select distinct issue_number, state, indexed_at, updated_at from issues where issue_number is not null),
n as (select *, row_number() over w = 1 or state is distinct from lag(state) over w as fresh from i window w as (partition by issue_number order by indexed_at, updated_at, state)),
facts as (select issue_number, state, indexed_at as valid_from, lead(indexed_at) over (partition by issue_number order by indexed_at, updated_at, state) as valid_to, updated_at from n where fresh)
"""
_EDGES = """l as (select issue_number, pr_number, max(confidence) as confidence from issue_pr_links group by 1, 2),
e as (select * from (select issue_number as src, -pr_number as dst, confidence from l union all select -pr_number, issue_number, confidence from l) where src <> 0 and dst <> 0)
"""

QUERIES = {f.__name__: f for f in (up_current_pulls, up_issue_facts, up_links_replayed, jo_state_as_of, ag_counts, ag_link_sources, ag_watermarks, ag_checksums, jo_stale_paths, jo_uncontaminated, ag_fact_health, gr_reach, gr_paths, gr_components, gr_decayed)}
SQL = {
    "up_current_pulls": "select pr_number, title, state, deleted_at is not null as withdrawn from pulls where pr_number is not null qualify row_number() over (partition by pr_number order by indexed_at desc) = 1",
    "up_issue_facts": _FACTS + "select issue_number, state, valid_from, valid_to from facts",
    "up_links_replayed": "select issue_number, pr_number, max(confidence) as confidence from issue_pr_links where extracted_at is not null group by 1, 2",
    "jo_state_as_of": _FACTS + "select k.issue_number, pr_number, extracted_at, state, valid_from as since from (select distinct issue_number, pr_number, extracted_at from issue_pr_links) k asof left join facts f on k.issue_number = f.issue_number and k.extracted_at >= f.valid_from",
    "ag_counts": " union all ".join(f"select '{t}' as table_name, count(*) as rows, count(distinct {k}) as keys from {t}" for t, k in (("issues", "issue_number"), ("pulls", "pr_number"), ("commits", "sha"), ("changes", "cl_number"), ("cl_chunks", "chunk_id"), ("issue_pr_links", "issue_number"))),
    "ag_link_sources": "select source, count(*) as links from issue_pr_links group by 1",
    "ag_watermarks": " union all ".join(f"select * from (select '{t}' as stream, indexed_at as watermark, {k} as last_key from {t} order by indexed_at desc, {k} desc limit 1)" for t, k in (("issues", "issue_number"), ("pulls", "pr_number"), ("changes", "cl_number"))),
    "ag_checksums": "select split, count(*) as rows, cast(sum(('0x' || substr(md5(concat_ws('|', cast(file_id as varchar), coalesce(repo, '~'), coalesce(relpath, '~'), coalesce(cast(size_bytes as varchar), '~'))), 1, 8))::bigint) as bigint) as checksum from file_records group by 1",
    "jo_stale_paths": """select repo, count(*) as paths, sum(case when ok is null then 1 else 0 end)::bigint as stale, round(sum(case when ok is null then 1 else 0 end) / count(*), 6) as share
from (select distinct source as repo, meta.src_path as relpath from samples where source is not null and meta.src_path is not null) left join (select distinct repo, relpath, 1 as ok from file_records) using (repo, relpath) group by 1""",
    "jo_uncontaminated": """select sample_id from samples where meta.src_path is null or meta.src_path not in (select unnest(regexp_extract_all(passage, '\\b[a-z]+(?:/[a-z_]+)+\\.[a-z]+\\b')) from eval_items)""",
    "ag_fact_health": _FACTS + "select state, sum(times)::bigint as facts, sum(open)::bigint as current, sum(case when times > 1 then 1 else 0 end)::bigint as reopened from (select issue_number, state, count(*) as times, max(case when valid_to is null then 1 else 0 end) as open from facts group by 1, 2) group by 1",
    "gr_reach": "with recursive " + _EDGES + """, r as (select distinct src, src as dst, 0 as hops from e where src > 0 union select r.src, e.dst, r.hops + 1 from r join e on r.dst = e.src where r.hops < 3)
select src, dst, min(hops) as hops from r group by 1, 2 having min(hops) > 0""",
    "gr_paths": "with recursive " + _EDGES + """, r as (select distinct src, src as dst, 0 as hops, 1.0::double as c, [src] as path from e where src > 0
  union all select r.src, e.dst, r.hops + 1, least(r.c, e.confidence), list_append(r.path, e.dst) from r join e on r.dst = e.src where r.hops < 3 and not list_contains(r.path, e.dst))
select src, dst, hops, c as confidence, array_to_string(path, '>') as path from r where hops > 0 qualify row_number() over (partition by src, dst order by hops, c desc, path) = 1""",
    "gr_components": "with recursive " + _EDGES + """, r as (select src as node, src as root from e union select r.node, e.dst from r join e on r.root = e.src)
select node, min(root) as root from r group by 1 having min(root) < node""",
    "gr_decayed": """select pr_number, round(max(case when confidence >= 1 then confidence else confidence * pow(0.5, (epoch_us(m) - epoch_us(extracted_at)) / 86400000000.0 / 60.0) end), 6) as confidence, count(*) as links
from issue_pr_links, (select max(extracted_at) as m from issue_pr_links) group by 1""",
}
