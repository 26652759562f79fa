"""Queries over facts that Spark derives from links, commits, changelists, issues, files and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodeweave.operators import facts as K, graph as G
from lodeweave.plans.history import _edges
from lodeweave.session import read

CUT = "2024-07-01"


def _raw(spark, sf_dir) -> DataFrame:
    links = read(spark, sf_dir, "issue_pr_links", "issue_number", "pr_number", "confidence", "source", "extracted_at").where("issue_number is not null and pr_number is not null and extracted_at is not null")
    solved = links.select(
        F.concat(F.lit("issue:"), "issue_number").alias("subject"), F.lit("resolved_by").alias("predicate"), F.concat(F.lit("pull:"), "pr_number").alias("object"), "confidence",
        F.when(F.col("confidence") >= 0.85, "det").when(F.col("confidence") >= 0.6, "heur").otherwise("llm").alias("tier"), F.col("extracted_at").alias("since"),
    )
    commits = read(spark, sf_dir, "commits", "sha", "pr_number", "indexed_at").where("sha is not null and pr_number is not null and indexed_at is not null")
    merged = commits.select(F.concat(F.lit("commit:"), "sha").alias("subject"), F.lit("merged_in").alias("predicate"), F.concat(F.lit("pull:"), "pr_number").alias("object"), F.lit(1.0).alias("confidence"), F.lit("det").alias("tier"), F.col("indexed_at").alias("since"))
    return solved.unionByName(merged)


def _facts(spark, sf_dir) -> DataFrame:
    return K.superseded(K.insert_facts(_raw(spark, sf_dir).limit(0), _raw(spark, sf_dir)))


def up_facts(spark, sf_dir):
    """Facts after the early rows, all rows, and all rows again."""
    raw = _raw(spark, sf_dir)
    early = K.insert_facts(raw.limit(0), raw.where(F.col("since") < CUT))
    return K.insert_facts(K.insert_facts(early, raw), raw)


def up_superseded(spark, sf_dir):
    return _facts(spark, sf_dir)


def up_entities(spark, sf_dir):
    """Files as entities: those listed before July 2024 are stored, the others come in."""
    files = read(spark, sf_dir, "file_records", "repo", "relpath", "abspath", "scanned_at").where("relpath is not null and scanned_at is not null")
    rows = files.select(F.lit("file").alias("kind"), F.element_at(F.split("relpath", "/"), -1).alias("name"), "repo", F.when(F.length("relpath") % 3 > 0, F.col("relpath")).alias("path"), F.col("scanned_at").alias("since"))
    none = spark.createDataFrame([], "kind string, name string, repo string, path string, first_seen timestamp, last_seen timestamp")
    return K.get_or_create(K.get_or_create(none, rows.where(F.col("since") < CUT)), rows.where(F.col("since") >= CUT))


def up_state_facts(spark, sf_dir):
    """Diagnostics: events of the newest day of every user, five at most."""
    events = read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts").withColumn("day", F.to_date("ts"))
    return K.latest_run(events, ["user_id"], "day", ["ts", "event_id"], 5).select("user_id", "event_id", "event_type")


def gr_query(spark, sf_dir):
    """What resolved which issue with 0.8 or more, as of July 2024."""
    return K.query_facts(_facts(spark, sf_dir), predicate="resolved_by", least=0.8, as_of=F.lit(CUT).cast("timestamp")).select("subject", "object", "confidence", "tier")


def gr_explain(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    return K.explain(facts, facts.select(F.col("object").alias("entity")))


def gr_capped(spark, sf_dir):
    return K.capped(_facts(spark, sf_dir).select(F.col("object").alias("subject"), F.concat(F.lit("inverse_"), "predicate").alias("predicate"), F.col("subject").alias("object"), "confidence", "since"), 2)


def gr_exhausted(spark, sf_dir):
    """For every issue: what three links explore, and whether nothing is left beyond, which proves that no path leads to anything else."""
    edges = _edges(spark, sf_dir)
    return G.exhausted(edges, edges.where("src > 0").select("src").distinct(), 3)


def gr_impact(spark, sf_dir):
    """How many pulls and issues a change of an issue reaches, by distance, against the direction of the links."""
    edges = _edges(spark, sf_dir).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return G.reach(edges, edges.where("src > 0").select("src").distinct(), 3).groupBy("src", "hops").agg(F.count(F.lit(1)).alias("reached"))


def gr_may_reach(spark, sf_dir):
    """The best path of two links with a tenth less certainty each."""
    edges = _edges(spark, sf_dir)
    paths = G.best_paths(edges, edges.where("src > 0").select("src").distinct(), 2)
    return paths.select("src", "dst", "hops", F.round(F.col("confidence") * F.pow(F.lit(0.9), F.col("hops") - 1), 6).alias("confidence"))


def _imports(spark, sf_dir) -> DataFrame:
    rows = read(spark, sf_dir, "samples", F.col("meta.src_path").alias("path"), "text").where("path is not null and text is not null")
    each = rows.select(F.substring_index("path", "/", 1).alias("module"), "path", F.explode(F.regexp_extract_all("text", F.lit(r"(?m)^(?:import org\.|use crate::)(\w+)"), F.lit(1))).alias("used"))
    return each.distinct()


def ag_module_depends(spark, sf_dir):
    """Modules that depend on one another by the imports of their files, with the number of files that prove it."""
    return _imports(spark, sf_dir).groupBy("module", "used").agg(F.countDistinct("path").alias("support"))


def gr_module_reach(spark, sf_dir):
    """Second phase: what modules depend on through one other, by any proof."""
    direct = ag_module_depends(spark, sf_dir).where("module <> used").select(F.col("module").alias("src"), F.col("used").alias("dst"))
    return G.reach(direct, direct.select("src").distinct(), 2)


def jo_tests(spark, sf_dir):
    """Files and the tests named after them in the same repository."""
    files = read(spark, sf_dir, "file_records", "repo", "relpath").where("repo is not null and relpath is not null").distinct().withColumn("name", F.element_at(F.split("relpath", "/"), -1))
    tests = files.where("name like 'test\\\\_%'").select("repo", F.col("relpath").alias("test_path"), F.expr("substring(name, 6)").alias("name"))
    return tests.join(files, ["repo", "name"]).select("repo", "test_path", "relpath")


def jo_duplicate_chains(spark, sf_dir):
    """Every issue points to the next smaller issue that one of its pulls resolves; the end of its chain."""
    links = read(spark, sf_dir, "issue_pr_links", "issue_number", "pr_number").where("issue_number is not null and pr_number is not null").distinct()
    a, b = links.alias("a"), links.alias("b")
    pairs = a.join(b, F.col("a.pr_number") == F.col("b.pr_number")).where("b.issue_number < a.issue_number")
    pointers = pairs.groupBy(F.col("a.issue_number").alias("node")).agg(F.max("b.issue_number").alias("next"))
    return K.terminals(pointers)


def ag_health(spark, sf_dir):
    return K.health(_facts(spark, sf_dir))


def ag_census(spark, sf_dir):
    return _facts(spark, sf_dir).groupBy("predicate", "tier").agg(F.count(F.lit(1)).alias("facts"), F.count_if(F.col("valid_to").isNull()).alias("live"))


_RAW = """with raw as (select 'issue:' || issue_number as subject, 'resolved_by' as predicate, 'pull:' || pr_number as object, confidence, case when confidence >= 0.85 then 'det' when confidence >= 0.6 then 'heur' else 'llm' end as tier, extracted_at as since
  from issue_pr_links where issue_number is not null and pr_number is not null and extracted_at is not null
  union all select 'commit:' || sha, 'merged_in', 'pull:' || pr_number, 1.0, 'det', indexed_at from commits where sha is not null and pr_number is not null and indexed_at is not null)
"""
_FACTS = _RAW + """, once as (select * from raw qualify row_number() over (partition by subject, predicate, object order by since, confidence desc, tier) = 1),
rk as (select *, case tier when 'det' then 2 when 'heur' then 1 else 0 end as rank, row_number() over (partition by subject, predicate order by since, case tier when 'det' then 2 when 'heur' then 1 else 0 end desc, object) as pos from once),
facts as (select subject, predicate, object, confidence, tier, since, case when (select max(rank) from rk e where e.subject = r.subject and e.predicate = r.predicate and e.pos < r.pos) > rank then since
  else (select min(since) from rk l where l.subject = r.subject and l.predicate = r.predicate and l.pos > r.pos and l.rank >= r.rank) end as valid_to from rk r)
"""
_EDGES = """with recursive l as (select issue_number, pr_number, max(confidence) as confidence from issue_pr_links where issue_number is not null and pr_number is not null group by 1, 2),
e as (select * from (select issue_number as src, -pr_number as dst, confidence from l union all select -pr_number, issue_number, confidence from l) where src <> 0 and dst <> 0),
"""
_REACHED = _EDGES + """r as (select distinct src, src as dst, 0 as hops from e where src > 0 union select r.src, e.dst, r.hops + 1 from r join e on r.dst = e.src where r.hops < 4 and e.src <> e.dst),
m as (select src, dst, min(hops) as hops from r group by 1, 2)
"""
QUERIES = {f.__name__: f for f in (up_facts, up_superseded, up_entities, up_state_facts, gr_query, gr_explain, gr_capped, gr_exhausted, gr_impact, gr_may_reach, ag_module_depends, gr_module_reach, jo_tests, jo_duplicate_chains, ag_health, ag_census)}
_IMPORTS = """with i as (select distinct split_part(meta.src_path, '/', 1) as module, meta.src_path as path, unnest(regexp_extract_all(text, '(?m)^(?:import org\\.|use crate::)(\\w+)', 1)) as used from samples where meta.src_path is not null and text is not null)
"""
SQL = {
    "up_facts": _RAW + ", early as (select * from raw where since < '2024-07-01' qualify row_number() over (partition by subject, predicate, object order by since, confidence desc, tier) = 1) select * from early union all select * from raw where (subject, predicate, object) not in (select (subject, predicate, object) from early) qualify row_number() over (partition by subject, predicate, object order by since, confidence desc, tier) = 1",
    "up_superseded": _FACTS + "select * from facts",
    "up_entities": """with f as (select *, split_part(relpath, '/', -1) as name, case when length(relpath) % 3 > 0 then relpath end as p, scanned_at >= timestamptz '2024-07-01 00:00:00+00' as late from file_records where relpath is not null and scanned_at is not null)
select 'file' as kind, name, repo, coalesce(arg_min(p, (scanned_at, p)) filter (p is not null and not late), arg_min(p, (scanned_at, p)) filter (p is not null)) as path, min(scanned_at) as first_seen, max(scanned_at) as last_seen from f group by name, repo""",
    "up_state_facts": """with e as (select *, cast(ts as date) as day, max(cast(ts as date)) over (partition by user_id) as newest from events)
select user_id, event_id, event_type from e where day = newest qualify row_number() over (partition by user_id order by ts, event_id) <= 5""",
    "gr_query": _FACTS + "select subject, object, confidence, tier from facts where predicate = 'resolved_by' and confidence >= 0.8 and since <= timestamptz '2024-07-01 00:00:00+00' and (valid_to is null or valid_to > timestamptz '2024-07-01 00:00:00+00')",
    "gr_explain": _FACTS + """, n as (select distinct object as entity from facts)
select distinct * from (select entity, 'out' as direction, predicate, object as other, confidence from facts join n on subject = entity union all select entity, 'in', predicate, subject, confidence from facts join n on object = entity)""",
    "gr_capped": _FACTS + """select object as subject, 'inverse_' || predicate as predicate, subject as object, confidence, since, greatest(0, count(*) over (partition by object, predicate) - 2) as left_away from facts
qualify row_number() over (partition by object, predicate order by confidence desc, subject, since) <= 2""",
    "gr_exhausted": _REACHED + "select src, count(*) filter (hops between 1 and 3) as explored, count(*) filter (hops = 4) = 0 as complete from m group by 1",
    "gr_impact": _REACHED + "select src, hops, count(*) as reached from m where hops between 1 and 3 group by 1, 2",
    "gr_may_reach": _EDGES + """o as (select src, dst, 1 as hops, confidence as c from e where src > 0 and src <> dst),
t as (select a.src, b.dst, 2 as hops, max(least(a.confidence, b.confidence)) as c from e a join e b on a.dst = b.src where a.src > 0 and b.dst <> a.src and (a.src, b.dst) not in (select (src, dst) from o) group by 1, 2)
select src, dst, hops, round(c * 0.9 ** (hops - 1), 6) as confidence from (select * from o union all select * from t)""",
    "ag_module_depends": _IMPORTS + "select module, used, count(distinct path) as support from i group by 1, 2",
    "gr_module_reach": _IMPORTS + """, d as (select module as src, used as dst from i where module <> used group by 1, 2),
t as (select a.src, b.dst from d a join d b on a.dst = b.src where a.src <> b.dst)
select src, dst, min(hops) as hops from (select src, dst, 1 as hops from d union all select src, dst, 2 from t) group by 1, 2""",
    "jo_tests": """with f as (select distinct repo, relpath, split_part(relpath, '/', -1) as name from file_records where repo is not null and relpath is not null)
select t.repo, t.relpath as test_path, f.relpath from f t join f on t.repo = f.repo and f.name = substr(t.name, 6) where starts_with(t.name, 'test_')""",
    "jo_duplicate_chains": """with recursive l as (select distinct issue_number as i, pr_number as p from issue_pr_links where issue_number is not null and pr_number is not null),
q as (select a.i as node, max(b.i) as next from l a join l b on a.p = b.p and b.i < a.i group by 1), c as (select node, next from q union all select c.node, q.next from c join q on c.next = q.node)
select node, min(next) as terminal, false as cyclic from c group by 1""",
    "ag_health": _FACTS + """select count(*) as facts, count(*) filter (valid_to is null) as live, round(avg(case when tier = 'det' then 1.0 else 0 end), 6) as det_share, (select coalesce(sum(n - 1), 0)::bigint from (select count(*) as n from facts group by subject, predicate, object, since)) as copies,
  (select count(*) from (select 1 from facts where valid_to is null group by subject, predicate having count(distinct object) > 1)) as contradictions, (select count(*) from (select 1 from facts group by subject having count(*) filter (valid_to is null) = 0)) as dormant,
  count(*) - count(*) filter (valid_to is null) as superseded from facts""",
    "ag_census": _FACTS + "select predicate, tier, count(*) as facts, count(*) filter (valid_to is null) as live from facts group by 1, 2",
}
