"""Retrieval queries: BM25, nearest vectors, hybrid fusion, hydration and enrichment of hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lodeweave.api import Store, hybrid, with_fixes
from lodeweave.functions import text as T
from lodeweave.operators import retrieval as R
from lodeweave.session import read, read_spread

K = 20


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "eval_items", "item_id", "prompt")


def _bm25(spark, sf_dir, table, id_col, text, k=K, mode="or") -> DataFrame:
    docs = read_spread(spark, sf_dir, table)
    return R.bm25(docs, id_col, text, R.query_terms(_prompts(spark, sf_dir), "item_id", F.col("prompt")), k, mode)


def rt_bm25(spark, sf_dir):
    return _bm25(spark, sf_dir, "documents", "doc_id", F.col("text"))


def rt_bm25_and(spark, sf_dir):
    return _bm25(spark, sf_dir, "documents", "doc_id", F.col("text"), mode="and")


def rt_bm25_and_or(spark, sf_dir):
    return _bm25(spark, sf_dir, "documents", "doc_id", F.col("text"), mode="and_or")


def _vectors(spark, sf_dir):
    return R.assert_unit(read(spark, sf_dir, "embeddings"), "embedding").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), "label")


def rt_nearest(spark, sf_dir):
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    base = _vectors(spark, sf_dir)
    return R.nearest(base.where("id % 20 = 0").select("id", "v"), base.select("id", "v"), K)


def _hybrid(spark, sf_dir, k=10):
    """Query i of the batch is vector 20 i with the i-th prompt by item id."""
    base = _vectors(spark, sf_dir)
    near = R.nearest(base.where("id % 20 = 0").select("id", "v"), base.select("id", "v"), K)
    # eval_items is a fixed table of 300 rows, so one partition numbers it
    numbered = _prompts(spark, sf_dir).withColumn("query", (F.row_number().over(Window.orderBy("item_id")) - 1) * 20).join(base.select(F.col("id").alias("query")), "query")
    docs = read_spread(spark, sf_dir, "documents", "doc_id", "text")
    lexical = R.bm25(docs, "doc_id", F.col("text"), R.query_terms(numbered, "query", F.col("prompt")), K)
    return R.fuse([near, lexical], k)


def rt_hybrid(spark, sf_dir):
    """Hybrid top 10 with the documents they name; a hit without a document stays away after the cut."""
    meta = read(spark, sf_dir, "documents", "doc_id", "lang", "source", "n_chars", "text").withColumnRenamed("doc_id", "doc")
    hits = _hybrid(spark, sf_dir)
    return meta.join(hits, "doc").select("query", "doc", "score", "rank_0", "rank_1", "rank", "lang", "source", "n_chars", F.substring("text", 1, 500).alias("excerpt"))


def rt_weighted_fusion(spark, sf_dir):
    """Weighted fusion of two lexical lists over the newest rows: changes by description, pulls by title and body."""
    terms = R.query_terms(_prompts(spark, sf_dir), "item_id", F.col("prompt"))
    changes = _current(read(spark, sf_dir, "changes", "cl_number", "description", "indexed_at"), "cl_number", "description")
    pulls = _current(read(spark, sf_dir, "pulls", "pr_number", "title", "body", "indexed_at"), "pr_number", "title", "body")
    lists = [(R.bm25(changes, "cl_number", F.col("description"), terms, K), 0.4), (R.bm25(pulls, "pr_number", F.concat_ws(" ", "title", "body"), terms, K), 0.6)]
    return R.weighted_fusion(lists, 10)


def _current(df: DataFrame, key: str, *tie: str) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.desc("indexed_at"), *[F.desc_nulls_last(t) for t in tie])
    return df.where(F.col(key).isNotNull()).withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def rt_similar_issues(spark, sf_dir, k=5, min_confidence=0.8):
    """The k best issues per prompt with their best linked pull: 0.0 where none is linked."""
    issues = _current(read(spark, sf_dir, "issues", "issue_number", "title", "body", "state", "indexed_at", "updated_at"), "issue_number", "updated_at", "state", "title")
    text = F.concat_ws("\n", "title", "body")
    hits = R.bm25(issues, "issue_number", text, R.query_terms(_prompts(spark, sf_dir), "item_id", F.col("prompt")), k)
    links = read(spark, sf_dir, "issue_pr_links").where(F.col("confidence") >= min_confidence)
    best = links.withColumn("_r", F.row_number().over(Window.partitionBy("issue_number").orderBy(F.desc("confidence"), "pr_number"))).where("_r = 1").select("issue_number", "pr_number", "confidence")
    meta = issues.select("issue_number", "title", "state", F.substring("body", 1, 500).alias("excerpt")).join(best, "issue_number", "left")
    return hits.join(meta, hits.doc == meta.issue_number).select("query", "rank", "score", "issue_number", "title", "state", "excerpt", "pr_number", F.coalesce("confidence", F.lit(0.0)).alias("confidence"))


def rt_search_commits(spark, sf_dir, k=5):
    """The k best commits per prompt over message and diff, with an excerpt of the diff."""
    commits = read_spread(spark, sf_dir, "commits", "sha", "message", "diff_text", "indexed_at")
    commits = _current(commits, "sha", "message")
    text = F.concat_ws("\n", "message", "diff_text")
    hits = R.bm25(commits, "sha", text, R.query_terms(_prompts(spark, sf_dir), "item_id", F.col("prompt")), k)
    meta = commits.select("sha", F.substring_index("message", "\n", 1).alias("subject"), F.substring("diff_text", 1, 2000).alias("excerpt"))
    return hits.join(meta, hits.doc == meta.sha).select("query", "rank", "score", "sha", "subject", "excerpt")


def rt_hybrid_issues(spark, sf_dir, k=5):
    """Hybrid top issues per prompt with hashed vectors, enriched with their best linked pull and its first hunks."""
    store = Store(spark, sf_dir)
    issues = store.issues()
    queries = _prompts(spark, sf_dir).select(F.col("item_id").alias("query"), F.col("prompt").alias("text"))
    hits = hybrid(issues, "issue_number", F.concat_ws("\n", "title", "body"), queries, k)
    return with_fixes(hits, issues, read(spark, sf_dir, "issue_pr_links"), store.pulls(), 0.8)


def rt_best_line(spark, sf_dir):
    """The line of each of the five best documents per prompt that holds most of its words."""
    hits = _bm25(spark, sf_dir, "documents", "doc_id", F.col("text"), 5).select("query", "doc")
    docs = read(spark, sf_dir, "documents", "doc_id", "text").withColumnRenamed("doc_id", "doc")
    lines = hits.select("doc").distinct().join(docs, "doc").select("doc", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    words = lines.select("doc", "line_no", F.explode(F.array_distinct(T.words(F.col("line")))).alias("term"))
    terms = R.query_terms(_prompts(spark, sf_dir), "item_id", F.col("prompt")).select("query", "term")
    found = hits.join(words, "doc").join(terms, ["query", "term"]).groupBy("query", "doc", "line_no").agg(F.count(F.lit(1)).alias("hits"))
    w = Window.partitionBy("query", "doc").orderBy(F.desc("hits"), "line_no")
    return found.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("query", "doc", (F.col("line_no") + 1).cast("bigint").alias("line_no"), "hits")


def _terms_sql(table: str, key: str, text: str) -> str:
    return f"""
toks as (select {key} as doc, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+') as w from {table} where {key} is not null),
posts as (select doc, term, count(*) as tf, any_value(len) as len from (select doc, len(w) as len, unnest(w) as term from toks) group by 1, 2),
corpus as (select count(*) as n, sum(len(w)) as total from toks),
"""


_QTERMS = """
qt as (select query, term, count(*) as times from (select query, unnest(regexp_extract_all(lower(prompt), '[\\p{L}\\p{N}]+')) as term from qs) group by 1, 2),
df as (select term, count(*) as df from posts where term in (select term from qt) group by 1),
wt as (select term, case when ln((n - df + 0.5) / (df + 0.5)) > 0 then ln((n - df + 0.5) / (df + 0.5)) else 1e-6 end as idf, total / n as mean from df, corpus),
sc as (select query, doc, round(sum(times * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 9) as score, count(*) as hits
  from posts join wt using (term) join qt using (term) group by 1, 2),
"""


def _bm25_sql(table, key, text, k, qs="select item_id as query, prompt from eval_items", mode="or", head="with ", name="top") -> str:
    keep = {"or": "select query, doc, score from sc", "and": "select query, doc, score from sc join need using (query) where hits = need", "and_or": "select query, doc, score from (select *, max(case when hits = need then 1 else 0 end) over (partition by query) as f from sc join need using (query)) where f = 0 or hits = need"}[mode]
    return (
        head + f"qs as ({qs})," + _terms_sql(table, key, text) + _QTERMS
        + f"need as (select query, count(*) as need from qt group by 1), kept as ({keep}), "
        + f"{name} as (select query, doc, score, row_number() over (partition by query order by score desc, doc) as rank from kept qualify rank <= {k}) "
    )


_NEAR = """with vecs as (select vec_id as id, embedding as v from embeddings),
near as (select q.id as query, b.id as doc, round(sqrt(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i]::double - b.v[i]::double) * (q.v[i]::double - b.v[i]::double)))), 6) as distance,
  from vecs q, vecs b where q.id % 20 = 0),
nn as (select query, doc, distance, row_number() over (partition by query order by distance, doc) as rank from near qualify rank <= 20) """

_CURRENT_ISSUES = """with cur as (select issue_number, title, body, state from issues where issue_number is not null
  qualify row_number() over (partition by issue_number order by indexed_at desc, updated_at desc nulls last, state desc nulls last, title desc nulls last) = 1), """
_CURRENT_COMMITS = "with cur as (select sha, message, diff_text from commits where sha is not null qualify row_number() over (partition by sha order by indexed_at desc, message desc nulls last) = 1), "

QUERIES = {
    "rt_bm25": rt_bm25,
    "rt_bm25_and": rt_bm25_and,
    "rt_bm25_and_or": rt_bm25_and_or,
    "rt_nearest": rt_nearest,
    "rt_hybrid": rt_hybrid,
    "rt_weighted_fusion": rt_weighted_fusion,
    "rt_similar_issues": rt_similar_issues,
    "rt_search_commits": rt_search_commits,
    "rt_hybrid_issues": rt_hybrid_issues,
    "rt_best_line": rt_best_line,
}
_DOC = ("documents", "doc_id", "coalesce(text, '')")
SQL = {
    "rt_bm25": _bm25_sql(*_DOC, K) + "select * from top",
    "rt_bm25_and": _bm25_sql(*_DOC, K, mode="and") + "select * from top",
    "rt_bm25_and_or": _bm25_sql(*_DOC, K, mode="and_or") + "select * from top",
    "rt_nearest": _NEAR + "select * from nn",
    "rt_hybrid": _bm25_sql(*_DOC, K, qs="select query, prompt from (select prompt, (row_number() over (order by item_id) - 1) * 20 as query from eval_items) where query in (select vec_id from embeddings)", head=_NEAR + ", ")
    + """, fused as (select query, doc, round(sum(1.0 / (60 + rank)), 9) as score, min(case when l = 0 then rank end) as rank_0, min(case when l = 1 then rank end) as rank_1
  from (select query, doc, rank, 0 as l from nn union all select query, doc, rank, 1 from top) group by 1, 2),
best as (select *, row_number() over (partition by query order by score desc, rank_0 nulls last, rank_1 nulls last, doc) as rank from fused qualify rank <= 10)
select best.*, lang, source, n_chars, left(text, 500) as excerpt from best join documents on doc_id = doc""",
    "rt_similar_issues": _bm25_sql("cur", "issue_number", "concat_ws(chr(10), title, body)", 5, head=_CURRENT_ISSUES)
    + """, best as (select issue_number, pr_number, confidence from issue_pr_links where confidence >= 0.8
  qualify row_number() over (partition by issue_number order by confidence desc, pr_number) = 1)
select query, rank, score, cur.issue_number, title, state, left(body, 500) as excerpt, pr_number, coalesce(confidence, 0.0) as confidence
from top join cur on doc = cur.issue_number left join best on best.issue_number = cur.issue_number""",
    "rt_search_commits": _bm25_sql("cur", "sha", "concat_ws(chr(10), message, diff_text)", 5, head=_CURRENT_COMMITS)
    + "select query, rank, score, sha, split_part(message, chr(10), 1) as subject, left(diff_text, 2000) as excerpt from top join cur on doc = sha",
}


def _fusion_sql() -> str:
    one = lambda table, key, text: _bm25_sql(table, key, text, K) + "select query, doc, score from top"
    return f"""with cc as (select * from changes where cl_number is not null qualify row_number() over (partition by cl_number order by indexed_at desc, description desc nulls last) = 1),
pp as (select * from pulls where pr_number is not null qualify row_number() over (partition by pr_number order by indexed_at desc, title desc nulls last, body desc nulls last) = 1),
a as ({one("cc", "cl_number", "coalesce(description, '')")}), b as ({one("pp", "pr_number", "concat_ws(' ', title, body)")}),
parts as (
  select query, doc, 0.4 * case when hi > lo then (score - lo) / (hi - lo) else 1.0 end as part from (select *, max(score) over (partition by query) as hi, min(score) over (partition by query) as lo from a)
  union all
  select query, doc, 0.6 * case when hi > lo then (score - lo) / (hi - lo) else 1.0 end from (select *, max(score) over (partition by query) as hi, min(score) over (partition by query) as lo from b)
)
select query, doc, round(sum(part), 6) as score, row_number() over (partition by query order by round(sum(part), 6) desc, doc) as rank from parts group by 1, 2 qualify rank <= 10"""


SQL["rt_weighted_fusion"] = _fusion_sql()
SQL["rt_best_line"] = _bm25_sql(*_DOC, 5) + """, l as (select doc_id as doc, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as line_no from documents where doc_id in (select doc from top)),
w as (select doc, line_no, unnest(list_distinct(regexp_extract_all(lower(line), '[\\p{L}\\p{N}]+'))) as term from l),
f as (select query, doc, line_no, count(*) as hits from top join w using (doc) join (select query, term from qt) using (query, term) group by 1, 2, 3)
select query, doc, line_no, hits from f qualify row_number() over (partition by query, doc order by hits desc, line_no) = 1"""
