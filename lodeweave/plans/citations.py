"""Queries on citations and scored pairs. The tables cite nothing in prose, so the texts are written from their links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodeweave.operators import citations as C
from lodeweave.operators.linking import current, top_per_key
from lodeweave.session import read

BASE = 10_000  # makes numbers as long as those of bugs and changes are
FORMS = ("CL #{}", "changelist {}", "see @swarm/{}", "http://h.example/changes/{} and", "submitted as {}", "number {}")
BUG_FORMS = ("bug-{}", "BZ #{}", "show_bug.cgi?id={}", "fixes {}", "closed bug {}", "item {}")


def _said(forms: tuple[str, ...], number) -> object:
    """One of the forms, by the number, with the number in it."""
    out = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        before, after = form.split("{}")
        out = F.when(F.pmod(number, F.lit(len(forms))) == i, F.concat(F.lit(before), number.cast("string"), F.lit(after))).otherwise(out)
    return out


def _links(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "issue_pr_links", "issue_number", "pr_number", "confidence").where("issue_number is not null and pr_number is not null").groupBy("issue_number", "pr_number").agg(F.max("confidence").alias("confidence"))


def _comments(spark, sf_dir) -> DataFrame:
    """(bug, comments): the pulls linked to an issue, cited as changes in its comments."""
    one = _links(spark, sf_dir).withColumn("t", _said(FORMS, F.col("pr_number") + BASE))
    return one.groupBy((F.col("issue_number") + BASE).alias("bug")).agg(F.array_join(F.array_sort(F.collect_list("t")), "; ").alias("comments"))


def _descriptions(spark, sf_dir) -> DataFrame:
    """(cl, description): the issues linked to a pull, cited as bugs in its description."""
    one = _links(spark, sf_dir).where("confidence >= 0.85").withColumn("t", _said(BUG_FORMS, F.col("issue_number") + BASE))
    return one.groupBy((F.col("pr_number") + BASE).alias("cl")).agg(F.array_join(F.array_sort(F.collect_list("t")), "; ").alias("description"))


def se_change_refs(spark, sf_dir):
    """Change numbers cited in comments, those from 10300 on."""
    return _comments(spark, sf_dir).select("bug", F.explode(C.cited_numbers(F.col("comments"), C.CHANGE_PATTERNS, 10_300)).alias("cl"))


def se_bug_refs(spark, sf_dir):
    """Bug numbers cited in descriptions, those from 10300 on."""
    return _descriptions(spark, sf_dir).select("cl", F.explode(C.cited_numbers(F.col("description"), C.BUG_PATTERNS, 10_300)).alias("bug"))


def _pairs(spark, sf_dir, threshold="0.80") -> DataFrame:
    issues = current(read(spark, sf_dir, "issues", "issue_number", "assignees", "state", "state_reason", "updated_at", "title", "indexed_at"), "issue_number", "updated_at", "state", "title")
    bugs = issues.select((F.col("issue_number") + BASE).alias("bug"), F.get("assignees", F.lit(0)).alias("assigned_to"), (F.col("state") == "closed").alias("fixed"), F.col("updated_at").alias("changed"))
    pulls = current(read(spark, sf_dir, "pulls", "pr_number", "author", "merged_at", "indexed_at"), "pr_number")
    changes = pulls.select((F.col("pr_number") + BASE).alias("cl"), "author", F.col("merged_at").alias("submitted"))
    return C.scored_pairs(bugs.join(_comments(spark, sf_dir), "bug", "left"), changes.join(_descriptions(spark, sf_dir), "cl", "left"), threshold)


def jo_scored_pairs(spark, sf_dir):
    """Bugs and changes within 60 days whose signals weigh 0.8 or more."""
    return _pairs(spark, sf_dir)


def jo_scored_pairs_of_persons(spark, sf_dir):
    """The same from 0.6 on, which persons and time reach without a citation."""
    return _pairs(spark, sf_dir, "0.60")


def jo_fix_excerpt(spark, sf_dir):
    """The best fix of every bug with the first 800 characters of its diff."""
    best = top_per_key(_pairs(spark, sf_dir), ["bug"], [F.desc("confidence"), "cl"])
    pulls = current(read(spark, sf_dir, "pulls", "pr_number", "diff_text", "indexed_at"), "pr_number")
    return best.join(pulls, best.cl == pulls.pr_number + BASE).select("bug", "cl", "confidence", F.substring(F.coalesce("diff_text", F.lit("")), 1, 800).alias("excerpt"))


def up_fix_links(spark, sf_dir):
    """Links of the strict threshold, overwritten by those of the looser one: the best confidence, the signals that came last."""
    return C.upsert_fix_links(_pairs(spark, sf_dir), _pairs(spark, sf_dir, "0.60").where("cl % 2 = 0").withColumn("confidence", F.lit(0.6)).withColumn("signals", F.concat(F.lit("again:"), "signals")))


def jo_explicit(spark, sf_dir):
    return C.explicit_links(read(spark, sf_dir, "issue_pr_links", "pr_number", "issue_number"))


def jo_unseen(spark, sf_dir):
    """Pulls that no link names: rows whose id is stored already are skipped."""
    pulls = read(spark, sf_dir, "pulls", "pr_number").where("pr_number is not null").distinct()
    return pulls.join(read(spark, sf_dir, "issue_pr_links", "pr_number").distinct(), "pr_number", "left_anti")


def _said_sql(forms: tuple[str, ...], number: str) -> str:
    whens = " ".join(f"when {i} then '{f.split('{}')[0]}' || {number} || '{f.split('{}')[1]}'" for i, f in enumerate(forms))
    return f"case {number} % {len(forms)} {whens} end"


def _cited_sql(text: str, patterns: tuple[str, ...], least: int) -> str:
    lists = ", ".join(f"regexp_extract_all(coalesce({text}, ''), '{p}', 1)" for p in patterns)
    return f"list_sort(list_distinct(list_filter(list_transform(flatten([{lists}]), lambda x: x::bigint), lambda n: n >= {least})))"


_TEXTS = f"""with links as (select issue_number, pr_number, max(confidence) as confidence from issue_pr_links where issue_number is not null and pr_number is not null group by 1, 2),
comments as (select issue_number + {BASE} as bug, string_agg(t, '; ' order by t) as comments from (select *, {_said_sql(FORMS, f'(pr_number + {BASE})')} as t from links) group by 1),
descriptions as (select pr_number + {BASE} as cl, string_agg(t, '; ' order by t) as description from (select *, {_said_sql(BUG_FORMS, f'(issue_number + {BASE})')} as t from links where confidence >= 0.85) group by 1)
"""
_SCORED = _TEXTS + f""", bugs as (select issue_number + {BASE} as bug, assignees[1] as assigned_to, state = 'closed' as fixed, updated_at as changed, comments, {_cited_sql("comments", C.CHANGE_PATTERNS, 1000)} as cites from (
  select * from issues where issue_number is not null qualify row_number() over (partition by issue_number order by indexed_at desc, updated_at desc nulls last, state desc nulls last, title desc nulls last) = 1) left join comments on bug = issue_number + {BASE} where updated_at is not null),
cls as (select pr_number + {BASE} as cl, author, merged_at as submitted, diff_text, {_cited_sql("description", C.BUG_PATTERNS, 1000)} as cited from (
  select * from pulls where pr_number is not null qualify row_number() over (partition by pr_number order by indexed_at desc) = 1) left join descriptions on cl = pr_number + {BASE} where merged_at is not null),
fired as (select bug, cl, diff_text, list_contains(cites, cl) as s1, list_contains(cited, bug) as s2, abs(floor((epoch_us(submitted) - epoch_us(changed)) / 86400000000)) <= 7 as s3,
  coalesce(assigned_to <> '' and assigned_to = author, false) as s4, coalesce(fixed, false) as s5 from bugs, cls where abs(epoch_us(submitted) - epoch_us(changed)) <= 60 * 86400000000),
scored as (select bug, cl, diff_text, array_to_string(list_filter([case when s1 then 'bug_comment_cites_cl' end, case when s2 then 'cl_desc_cites_bug' end, case when s3 then 'temporal_proximity' end, case when s4 then 'assignee_author_match' end, case when s5 then 'bug_status_fixed' end], lambda x: x is not null), ',') as signals,
  least(100, 50 * s1::int + 50 * s2::int + 30 * s3::int + 20 * s4::int + 10 * s5::int) as points from fired)
"""
QUERIES = {f.__name__: f for f in (se_change_refs, se_bug_refs, jo_scored_pairs, jo_scored_pairs_of_persons, jo_fix_excerpt, up_fix_links, jo_explicit, jo_unseen)}
SQL = {
    "se_change_refs": _TEXTS + f"select bug, unnest({_cited_sql('comments', C.CHANGE_PATTERNS, 10_300)}) as cl from comments",
    "se_bug_refs": _TEXTS + f"select cl, unnest({_cited_sql('description', C.BUG_PATTERNS, 10_300)}) as bug from descriptions",
    "jo_scored_pairs": _SCORED + "select bug, cl, signals, points / 100.0::double as confidence from scored where points >= 80",
    "jo_scored_pairs_of_persons": _SCORED + "select bug, cl, signals, points / 100.0::double as confidence from scored where points >= 60",
    "jo_fix_excerpt": _SCORED + "select bug, cl, points / 100.0::double as confidence, left(coalesce(diff_text, ''), 800) as excerpt from scored where points >= 80 qualify row_number() over (partition by bug order by points desc, cl) = 1",
    "up_fix_links": _SCORED + """, a as (select bug, cl, signals, points / 100.0::double as confidence from scored where points >= 80), b as (select bug, cl, 'again:' || signals as signals, 0.6::double as confidence from scored where points >= 60 and cl % 2 = 0)
select bug, cl, coalesce(b.signals, a.signals) as signals, greatest(a.confidence, b.confidence) as confidence from a full join b using (bug, cl)""",
    "jo_explicit": "select distinct issue_number, pr_number, 1.0::double as confidence, 'explicit' as source from issue_pr_links where issue_number is not null and pr_number is not null",
    "jo_unseen": "select distinct pr_number from pulls where pr_number is not null and pr_number not in (select pr_number from issue_pr_links where pr_number is not null)",
}
