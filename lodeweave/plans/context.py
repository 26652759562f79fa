"""Queries that put retrieved context together, with both arms, and that judge answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lodeweave.functions import text as T
from lodeweave.operators import evaluation as E, retrieval as R
from lodeweave.operators.linking import current, top_per_key
from lodeweave.plans import retrieval as P
from lodeweave.plans.evaluation import _responses
from lodeweave.session import read, read_spread

ALIASES = {"configuration": ["config", "cfg", "settings"], "repository": ["repo"], "identifier": ["id", "ident"], "message": ["msg"]}
IDENT = r"\b[a-z]+(?:_[a-z]+)+\b"
CITED = r"\b[a-z]+(?:/[a-z_]+)+\.[a-z]+\b"


def _numbered(spark, sf_dir) -> DataFrame:
    """Query i of the batch is vector 20 i with the i-th prompt by item id; a fixed table of 300 rows."""
    vectors = read(spark, sf_dir, "embeddings", F.col("vec_id").alias("query"))
    return P._prompts(spark, sf_dir).withColumn("query", ((F.row_number().over(Window.orderBy("item_id")) - 1) * 20).cast("bigint")).join(vectors, "query")


def _two_arms(spark, sf_dir, docs, key: str, text, base: DataFrame, k: int) -> DataFrame:
    numbered = _numbered(spark, sf_dir)
    queries = P._vectors(spark, sf_dir).join(numbered.select(F.col("query").alias("id")), "id", "left_semi").select("id", "v")
    lexical = R.bm25(docs, key, text, R.query_terms(numbered, "query", F.col("prompt")), P.K)
    return R.fuse([R.nearest(queries, base, P.K), lexical], k)


def rt_two_arm_issues(spark, sf_dir):
    """Similar issues by vector and words, with the best linked pull; the vector of an issue has its number."""
    issues = P._current(read(spark, sf_dir, "issues", "issue_number", "title", "body", "state", "indexed_at", "updated_at"), "issue_number", "updated_at", "state", "title")
    base = P._vectors(spark, sf_dir).join(issues.select(F.col("issue_number").alias("id")), "id", "left_semi").select("id", "v")
    hits = _two_arms(spark, sf_dir, issues, "issue_number", F.concat_ws("\n", "title", "body"), base, 5)
    best = top_per_key(read(spark, sf_dir, "issue_pr_links").where("confidence >= 0.8"), ["issue_number"], [F.desc("confidence"), "pr_number"]).select("issue_number", "pr_number", "confidence")
    meta = issues.select("issue_number", "title", F.substring("body", 1, 500).alias("excerpt")).join(best, "issue_number", "left")
    return hits.join(meta, hits.doc == meta.issue_number).select("query", "rank", "score", "issue_number", "title", "excerpt", "pr_number", F.coalesce("confidence", F.lit(0.0)).alias("confidence"))


def rt_two_arm_commits(spark, sf_dir):
    """Commits by vector and words; unlinked ones are kept. The vector of a commit is chosen by its sha."""
    commits = P._current(read_spread(spark, sf_dir, "commits", "sha", "message", "diff_text", "pr_number", "indexed_at"), "sha", "message")
    number = lambda n: F.conv(F.substring("sha", 1, n), 16, 10).cast("bigint")
    vectors = read(spark, sf_dir, "embeddings", "vec_id").count()
    commits = commits.withColumn("id", number(15)).withColumn("vec", number(6) % vectors)
    base = commits.select("id", "vec").join(P._vectors(spark, sf_dir).select(F.col("id").alias("vec"), "v"), "vec").select("id", "v")
    hits = _two_arms(spark, sf_dir, commits, "id", F.concat_ws("\n", "message", "diff_text"), base, 5)
    return hits.join(commits, hits.doc == commits.id).select("query", "rank", "score", "sha", T.subject(F.col("message")).alias("subject"), F.substring("diff_text", 1, 2000).alias("excerpt"), "pr_number")


def rt_lexical_first(spark, sf_dir):
    """Documents: lexical hits first, then near ones at a distance of 1.3 at most that are not among them."""
    base = P._vectors(spark, sf_dir)
    near = R.nearest(base.where("id % 20 = 0").select("id", "v"), base.select("id", "v"), 10)
    lexical = R.bm25(read_spread(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", F.col("text"), R.query_terms(_numbered(spark, sf_dir), "query", F.col("prompt")), 5)
    return R.after_lexical(lexical, near, 8, 1.3)


def rt_recent(spark, sf_dir):
    """BM25 over documents of which the older fade: the ten best of the twenty best."""
    docs = read_spread(spark, sf_dir, "documents", "doc_id", "text", "fetched_at")
    hits = P._bm25(spark, sf_dir, "documents", "doc_id", F.col("text"))
    now = F.lit("2025-01-01").cast("timestamp")
    faded = hits.join(docs.select(F.col("doc_id").alias("doc"), "fetched_at"), "doc").withColumn("faded", F.round(R.recency(F.col("score"), F.col("fetched_at"), now), 6))
    return top_per_key(faded, ["query"], [F.desc("faded"), "doc"], 10, "place").select("query", "doc", "faded", "place")


def rt_folded(spark, sf_dir):
    """How often documents hold names that aliases stand for, identifiers counted whole and by their parts."""
    docs = read_spread(spark, sf_dir, "documents", "doc_id", "source", "text").where("text is not null")
    words = docs.select("source", F.explode(R.folded(T.code_words(F.col("text")), ALIASES)).alias("word"))
    return words.where(F.col("word").isin([*ALIASES, "cache", "cache_key", "retry"])).groupBy("source", "word").agg(F.count(F.lit(1)).alias("times"))


def rt_to_embed(spark, sf_dir):
    """Documents without a vector of this model for their text: a third was embedded from other texts, a third by another model."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    stored = docs.select("doc_id", F.sha2(F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" "))).otherwise(F.col("text")), 256).alias("src_hash"), F.when(F.col("doc_id") % 3 == 1, "old").otherwise("new").alias("model"))
    return R.to_embed(docs, stored, "doc_id", F.col("text"), "new").select("doc_id", "src_hash")


def rt_augmented(spark, sf_dir):
    """The three best documents of every prompt as context, the most relevant last."""
    hits = P._bm25(spark, sf_dir, "documents", "doc_id", F.col("text"), 3)
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text").withColumnRenamed("doc_id", "doc")
    full = hits.join(docs, "doc")
    return R.augmented(full, F.concat_ws("/", "source", "doc"), F.lit(1), T.line_count(F.col("text")), F.substring("text", 1, 200)).select("query", F.md5("prompt").alias("digest"), F.length("prompt").alias("characters"))


def rt_shared_budget(spark, sf_dir):
    """The five best documents of every prompt in 3000 characters, shared out evenly."""
    hits = P._bm25(spark, sf_dir, "documents", "doc_id", F.col("text"), 5)
    docs = read(spark, sf_dir, "documents", "doc_id", "text").withColumnRenamed("doc_id", "doc")
    return R.shared_budget(hits.join(docs, "doc"), "text", 3000)


def ev_recall(spark, sf_dir):
    """Share of the vectors of a query's label among its nearest."""
    base = read(spark, sf_dir, "embeddings", F.col("vec_id").alias("id"), F.col("embedding").alias("v"), "label")
    near = R.nearest(base.where("id % 20 = 0").select("id", "v"), base.select("id", "v"), 11).where("query <> doc")
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("rank"))).where("rank <= 10")
    labels = base.select("id", "label")
    hits = near.join(labels.withColumnRenamed("id", "query").withColumnRenamed("label", "group_label"), "query").join(labels.withColumnRenamed("id", "doc"), "doc")
    totals = labels.join(labels.groupBy("label").agg((F.count(F.lit(1)) - 1).alias("total")), "label").select(F.col("id").alias("query"), "total")
    return E.recall_at(hits.select("group_label", "query", "rank", (F.col("label") == F.col("group_label")).alias("relevant")), totals, "group_label")


def ev_answer_quality(spark, sf_dir):
    """Documents as answers: the paths they cite against the files that are listed, per kind, per kind and language, and over all."""
    docs = read(spark, sf_dir, "documents", "doc_id", "lang", "source", "text", "n_chars").where("text is not null")
    answers = docs.select(F.col("doc_id").alias("answer"), F.split_part("source", F.lit("/"), F.lit(1)).alias("kind"), F.lower(F.substring("lang", 1, 2)).alias("lang"), F.col("n_chars").alias("cost"))
    cited = docs.select(F.col("doc_id").alias("answer"), F.explode(F.regexp_extract_all("text", F.lit(CITED), F.lit(0))).alias("ref"))
    known = read(spark, sf_dir, "samples", F.col("meta.src_path").alias("ref")).where("ref is not null")
    return E.answer_quality(answers, cited, known, [["kind"], ["kind", "lang"], []], "kind", "lang")


def ev_fabrication(spark, sf_dir):
    """Identifiers in answers that neither the passage nor the prompt of the item names, per category."""
    items = read(spark, sf_dir, "eval_items", "item_id", "passage", "prompt")
    answers = _responses(spark, sf_dir).select("doc_id", "item_id", "category").join(items, "item_id").join(read(spark, sf_dir, "documents", "doc_id", "text"), "doc_id").withColumnRenamed("doc_id", "answer").where("text is not null")
    found = lambda *cols: F.regexp_extract_all(F.concat_ws(" ", *cols), F.lit(IDENT), F.lit(0))
    made = E.fabrication(answers.select("answer", "category", "text", "passage", "prompt"), found("text"), found("passage", "prompt"))
    return made.join(answers.select("answer", "category"), "answer").groupBy("category").agg(
        F.count_if(F.col("made_up") > 0).alias("fabricating"), F.count(F.lit(1)).alias("answers"), F.sum("named").alias("named"), F.sum("made_up").alias("made_up")
    )


def ev_promotion(spark, sf_dir):
    """Whether answers of one kind may take the place of another's: better in the mean, no worse in the guarded categories."""
    means = _responses(spark, sf_dir).groupBy("kind", "category").agg(F.round(E.mean_or_zero("score"), 6).alias("task_mean"))
    return E.promotion(means.where("kind = 'wiki'"), means.where("kind = 'docs'"), "category", "task_mean", ["debugging", "qa"], 0.05)


def ag_status_counts(spark, sf_dir):
    """Events by status, and the user of the best finished one of each."""
    events = read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value")
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("jobs"), F.max("value").alias("best"), F.max_by("user_id", F.struct("value", -F.col("event_id"))).alias("best_user"))


_DOC = ("documents", "doc_id", "coalesce(text, '')")
_NQ = "select query, prompt from (select prompt, (row_number() over (order by item_id) - 1) * 20 as query from eval_items) where query in (select vec_id from embeddings)"
_DIST = "round(sqrt(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i]::double - b.v[i]::double) * (q.v[i]::double - b.v[i]::double)))), 6)"


def _near_sql(base: str, k: int = 20) -> str:
    return f"""nq as ({_NQ}), qv as (select query as id, embedding as v from nq join embeddings on vec_id = query), bv as ({base}),
nn as (select query, doc, distance, row_number() over (partition by query order by distance, doc) as rank from (select q.id as query, b.id as doc, {_DIST} as distance from qv q, bv b) qualify rank <= {k}), """


_FUSED = """, fused as (select query, doc, round(sum(1.0 / (60 + rank)), 9) as score, min(case when l = 0 then rank end) as r0, min(case when l = 1 then rank end) as r1 from (select query, doc, rank, 0 as l from nn union all select query, doc, rank, 1 from top) group by 1, 2),
hits as (select query, doc, score, row_number() over (partition by query order by score desc, r0 nulls last, r1 nulls last, doc) as rank from fused qualify rank <= 5) """
_COMMITS = P._CURRENT_COMMITS.replace("select sha, message, diff_text from commits", "select sha, message, diff_text, pr_number, ('0x' || substr(sha, 1, 15))::bigint as id, ('0x' || substr(sha, 1, 6))::bigint % (select count(*) from embeddings) as vec from commits")
_FOLD = " ".join(f"when '{o}' then '{name}'" for name, others in ALIASES.items() for o in others)
QUERIES = {f.__name__: f for f in (rt_two_arm_issues, rt_two_arm_commits, rt_lexical_first, rt_recent, rt_folded, rt_to_embed, rt_augmented, rt_shared_budget, ev_recall, ev_answer_quality, ev_fabrication, ev_promotion, ag_status_counts)}
SQL = {
    "rt_two_arm_issues": P._bm25_sql("cur", "issue_number", "concat_ws(chr(10), title, body)", 20, qs=_NQ, head=P._CURRENT_ISSUES + _near_sql("select issue_number as id, embedding as v from cur join embeddings on vec_id = issue_number")) + _FUSED
    + """, best as (select issue_number, pr_number, confidence from issue_pr_links where confidence >= 0.8 qualify row_number() over (partition by issue_number order by confidence desc, pr_number) = 1)
select query, rank, score, cur.issue_number, title, left(body, 500) as excerpt, pr_number, coalesce(confidence, 0.0) as confidence from hits join cur on doc = cur.issue_number left join best on best.issue_number = cur.issue_number""",
    "rt_two_arm_commits": P._bm25_sql("cur", "id", "concat_ws(chr(10), message, diff_text)", 20, qs=_NQ, head=_COMMITS + _near_sql("select id, embedding as v from cur join embeddings on vec_id = vec")) + _FUSED
    + "select query, rank, score, sha, split_part(message, chr(10), 1) as subject, left(diff_text, 2000) as excerpt, pr_number from hits join cur on doc = id",
    "rt_lexical_first": P._bm25_sql(*_DOC, 5, qs=_NQ, head=P._NEAR + ", ")
    + """, m as (select query, doc, min((arm, place)) as s from (select query, doc, 0 as arm, rank as place from top union all select query, doc, 1, rank from nn where rank <= 10 and distance <= 1.3) group by 1, 2)
select query, doc, row_number() over (partition by query order by s, doc) as rank, s[1] as arm from m qualify rank <= 8""",
    "rt_recent": P._bm25_sql(*_DOC, 20)
    + """, f as (select query, doc, round(score * coalesce(exp(-greatest(0.0, (epoch_us(timestamptz '2025-01-01 00:00:00+00') - epoch_us(fetched_at)) / 31557600000000.0) / 3.0), 1.0), 6) as faded from top join documents on doc = doc_id)
select query, doc, faded, row_number() over (partition by query order by faded desc, doc) as place from f qualify place <= 10""",
    "rt_folded": f"""with w as (select source, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) as w from documents where text is not null), a as (select source, case w {_FOLD} else w end as w from w),
p as (select source, w, list_filter(string_split(w, '_'), lambda p: p <> '') as p from a), e as (select source, unnest(case when len(p) > 1 then list_prepend(w, p) else [w] end) as word from p)
select source, word, count(*) as times from e where word in ({", ".join(repr(x) for x in [*ALIASES, "cache", "cache_key", "retry"])}) group by 1, 2""",
    "rt_to_embed": "select doc_id, sha256(text) as src_hash from documents where text is not null and doc_id % 3 <> 2",
    "rt_augmented": P._bm25_sql(*_DOC, 3)
    + """, p as (select query, string_agg(concat_ws('/', source, doc) || ':1-' || len(string_split(text, chr(10))) || chr(10) || left(text, 200), chr(10) || chr(10) order by rank desc) as prompt from top join documents on doc = doc_id group by 1)
select query, md5(prompt) as digest, length(prompt) as characters from p""",
    "rt_shared_budget": P._bm25_sql(*_DOC, 5, head="with recursive ")
    + """, h as (select query, rank, doc, coalesce(text, '') as t, count(*) over (partition by query) as n from top join documents on doc = doc_id),
o as (select *, row_number() over (partition by query order by rank, doc) as pos from h),
s as (select query, 0::bigint as pos, 0::bigint as used, null::bigint as doc, 0::bigint as size from (select distinct query from o)
  union all select o.query, o.pos, used + z, o.doc, z from (select s.query, s.used, o.pos, o.doc, case when length(o.t) <= (3000 - s.used) // (o.n - s.pos) then length(o.t)
    else coalesce(length(regexp_extract(left(o.t, (3000 - s.used) // (o.n - s.pos)), '(?s)^(.*)\\n', 1)), 0) end as z from s join o on o.query = s.query and o.pos = s.pos + 1) o)
select query, row_number() over (partition by query order by pos) - 1 as place, doc, size, max(used) over (partition by query) as used from s where size > 0""",
    "ev_recall": f"""with vecs as (select vec_id as id, embedding as v, label from embeddings), d as (select q.id as query, q.label as group_label, b.id as doc, b.label, {_DIST} as distance from vecs q, vecs b where q.id % 20 = 0),
t as (select *, row_number() over (partition by query order by distance, doc) as r0 from d qualify r0 <= 11), r as (select *, row_number() over (partition by query order by r0) as rank from t where query <> doc qualify rank <= 10),
n as (select label, count(*) - 1 as total from vecs group by 1), f as (select group_label, query, count(*) filter (label = group_label and rank <= 3) as f3, count(*) filter (label = group_label and rank <= 10) as f10 from r group by 1, 2)
select group_label, count(*) as queries, round(avg(case when total > 0 then f3 / total else 0 end), 6) as recall_3, round(avg(case when total > 0 then f10 / total else 0 end), 6) as recall_10 from f join n on n.label = group_label group by 1""",
    "ev_answer_quality": f"""with a as (select doc_id, split_part(source, '/', 1) as kind, lower(left(lang, 2)) as lang, n_chars, list_distinct(regexp_extract_all(text, '{CITED}')) as refs from documents where text is not null),
k as (select distinct meta.src_path as ref from samples where meta.src_path is not null), c as (select doc_id, unnest(refs) as ref from a), g as (select doc_id, count(*) as good from c join k using (ref) group by 1),
e as (select kind, lang, n_chars, len(refs) as refs, coalesce(good, 0) as good from a left join g using (doc_id))
select kind, lang, count(*) as answers, round(avg((refs > 0)::int), 6) as citation_rate, round(coalesce(sum(good) / nullif(sum(refs), 0), 0.0), 6) as precision, round(avg((good < refs)::int), 6) as hallucination_rate, round(avg(n_chars), 6) as mean_cost
from e group by grouping sets ((kind), (kind, lang), ())""",
    "ev_fabrication": f"""with items as (select *, row_number() over (order by item_id) - 1 as place from eval_items), n as (select count(*) as n from eval_items),
x as (select category, list_distinct(regexp_extract_all(text, '{IDENT}')) as a, regexp_extract_all(concat_ws(' ', passage, prompt), '{IDENT}') as g from documents join items on doc_id % (select n from n) = place where text is not null),
y as (select category, len(a) as named, len(list_filter(a, lambda w: not list_contains(g, w))) as made_up from x)
select category, count(*) filter (made_up > 0) as fabricating, count(*) as answers, sum(named)::bigint as named, sum(made_up)::bigint as made_up from y group by 1""",
    "ag_status_counts": "select event_type, count(*) as jobs, max(value) as best, arg_max(user_id, (value, -event_id)) as best_user from events group by 1",
}
from lodeweave.plans.evaluation import _ITEMS  # noqa: E402

SQL["ev_promotion"] = _ITEMS + """, m as (select kind, category, round(coalesce(avg(score::double), 0), 6) as v from resp group by 1, 2),
b as (select coalesce(o.category, n.category) as category, o.v as old, n.v as new from (select * from m where kind = 'wiki') o full join (select * from m where kind = 'docs') n on o.category = n.category)
select round(avg(new), 6) as candidate, round(avg(old), 6) as baseline, count(*) filter (category in ('debugging', 'qa') and coalesce(new, 0) < coalesce(old, 0) - 0.05) as regressions,
  coalesce(round(avg(new), 6) > round(avg(old), 6) and count(*) filter (category in ('debugging', 'qa') and coalesce(new, 0) < coalesce(old, 0) - 0.05) = 0, false) as promoted from b"""
