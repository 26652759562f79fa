"""Evaluation and monitoring queries over eval items, documents, embeddings, file records and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lodeweave.functions import text as T
from lodeweave.operators import evaluation as E, history as H, monitoring as M, retrieval as R
from lodeweave.session import read, read_spread


def _responses(spark, sf_dir) -> DataFrame:
    """Every document is a response to the item whose place among the items is its id modulo their number."""
    items = read(spark, sf_dir, "eval_items", "item_id", "category", "expected_signals", "forbidden_signals")
    # a fixed table of 300 rows, so one partition numbers it
    numbered = items.withColumn("place", F.row_number().over(Window.orderBy("item_id")) - 1)
    n = items.count()
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text").withColumn("place", F.pmod("doc_id", F.lit(max(1, n))))
    return docs.join(numbered, "place").select("doc_id", "item_id", "category", F.split_part("source", F.lit("/"), F.lit(1)).alias("kind"), F.round(E.task_score("expected_signals", "forbidden_signals", "text"), 6).alias("score"))


def ev_task_scores(spark, sf_dir):
    return _responses(spark, sf_dir).select("doc_id", "item_id", "score")


def ev_task_means(spark, sf_dir):
    """Mean scores per category and kind, per category, and over all, in one pass."""
    return _responses(spark, sf_dir).groupingSets([["category", "kind"], ["category"], []], "category", "kind").agg(
        F.count(F.lit(1)).alias("responses"), F.round(E.mean_or_zero("score"), 6).alias("task_mean")
    )


def ev_lift(spark, sf_dir):
    means = _responses(spark, sf_dir).groupBy("kind").agg(F.round(E.mean_or_zero("score"), 6).alias("task_mean"))
    return E.lift(means, "kind", "task_mean", "wiki")


def ev_ranking(spark, sf_dir):
    """hit@k and MRR of nearest vectors: a neighbour with the query's label is relevant."""
    base = read(spark, sf_dir, "embeddings", F.col("vec_id").alias("id"), F.col("embedding").alias("v"), "label")
    near = R.nearest(base.where("id % 20 = 0").select("id", "v"), base.select("id", "v"), 11).where("query <> doc")
    order = Window.partitionBy("query").orderBy("rank")
    near = near.withColumn("rank", F.row_number().over(order)).where("rank <= 10")
    labels = base.select("id", "label")
    hits = near.join(labels.withColumnRenamed("id", "query").withColumnRenamed("label", "group_label"), "query").join(labels.withColumnRenamed("id", "doc"), "doc")
    return E.ranking_metrics(hits.select("group_label", "query", "rank", (F.col("label") == F.col("group_label")).alias("relevant")), "group_label")


def ev_perplexity(spark, sf_dir):
    events = read(spark, sf_dir, "events", "event_type", "value", "props")
    tokens = F.get_json_object("props", "$.k").cast("bigint")
    return events.groupBy("event_type").agg(F.round(E.perplexity(F.col("value") / 100, tokens), 6).alias("perplexity"), F.sum(tokens).alias("tokens"))


def ev_percentiles(spark, sf_dir):
    events = read(spark, sf_dir, "events", "event_type", "value")
    return E.exact_percentiles(events, "event_type", "value", {"p50": 0.5, "p99": 0.99}).select("event_type", F.round("p50", 6).alias("p50"), F.round("p99", 6).alias("p99"))


def ev_diversity(spark, sf_dir):
    docs = read_spread(spark, sf_dir, "documents", "source", "text").where("text is not null")
    return E.diversity(docs.withColumn("kind", F.split_part("source", F.lit("/"), F.lit(1))), "kind", T.words(F.col("text")))


def ev_composition(spark, sf_dir):
    """Top directories of the listed files before and after July 2024."""
    files = read(spark, sf_dir, "file_records", "relpath", "scanned_at").where("relpath is not null")
    return E.composition_change(files, F.substring_index("relpath", "/", 1), "scanned_at", F.lit("2024-07-01").cast("timestamp"))


def ev_failure_runs(spark, sf_dir):
    """Users with three or more errors in a row."""
    events = read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts")
    return H.runs(events, ["user_id"], F.col("event_type") == "error", ["ts", "event_id"]).where("length >= 3")


def st_tumbling(spark, sf_dir):
    return M.tumbling(read(spark, sf_dir, "events"), "ts", "1 hour", "event_type")


def st_sliding(spark, sf_dir):
    return M.sliding(read(spark, sf_dir, "events"), "ts", "2 hours", "30 minutes", "event_type")


def st_sessions(spark, sf_dir):
    return M.sessions(read(spark, sf_dir, "events"), "ts", "30 minutes", "user_id")


_ITEMS = """with items as (select *, row_number() over (order by item_id) - 1 as place from eval_items), n as (select count(*) as n from eval_items),
resp as (select doc_id, item_id, category, split_part(source, '/', 1) as kind, round(
  case when coalesce(len(expected_signals), 0) = 0 then 1.0 else len(list_filter(expected_signals, lambda s: contains(lower(text), lower(s)))) / len(expected_signals) end
  - case when coalesce(len(forbidden_signals), 0) = 0 then 0.0 else len(list_filter(forbidden_signals, lambda s: contains(lower(text), lower(s)))) / len(forbidden_signals) end, 6) as score
  from documents join items on doc_id % (select n from n) = place)
"""
_WINDOW = "count(*) as n, round(sum(value), 4) as total, max(value) as highest"
QUERIES = {f.__name__: f for f in (ev_task_scores, ev_task_means, ev_lift, ev_ranking, ev_perplexity, ev_percentiles, ev_diversity, ev_composition, ev_failure_runs, st_tumbling, st_sliding, st_sessions)}
SQL = {
    "ev_task_scores": _ITEMS + "select doc_id, item_id, score::double as score from resp",
    "ev_task_means": _ITEMS + "select category, kind, count(*) as responses, round(coalesce(avg(score::double), 0), 6) as task_mean from resp group by grouping sets ((category, kind), (category), ())",
    "ev_lift": _ITEMS + """, m as (select kind, round(coalesce(avg(score::double), 0), 6) as task_mean from resp group by 1)
select kind, task_mean, round(task_mean - b, 6) as lift, coalesce(round(task_mean - b, 6) >= 0.05, false) as enabled from m, (select max(task_mean) as b from m where kind = 'wiki')""",
    "ev_ranking": """with vecs as (select vec_id as id, embedding as v, label from embeddings),
d as (select q.id as query, q.label as group_label, b.id as doc, b.label, round(sqrt(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i]::double - b.v[i]::double) * (q.v[i]::double - b.v[i]::double)))), 6) as distance from vecs q, vecs b where q.id % 20 = 0),
t as (select *, row_number() over (partition by query order by distance, doc) as r0 from d qualify r0 <= 11),
r as (select *, row_number() over (partition by query order by r0) as rank from t where query <> doc qualify rank <= 10),
f as (select group_label, query, min(case when label = group_label then rank end) as first from r group by 1, 2)
select group_label, count(*) as queries, round(avg(case when first <= 1 then 1.0 else 0 end), 6) as hit_1, round(avg(case when first <= 3 then 1.0 else 0 end), 6) as hit_3, round(avg(case when first <= 10 then 1.0 else 0 end), 6) as hit_10, round(avg(coalesce(1.0 / first, 0)), 6) as mrr from f group by 1""",
    "ev_perplexity": "select event_type, round(exp(sum(value / 100 * (props->>'$.k')::bigint) / sum((props->>'$.k')::bigint)), 6) as perplexity, sum((props->>'$.k')::bigint)::bigint as tokens from events group by 1",
    "ev_percentiles": "select event_type, round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.99), 6) as p99 from events group by 1",
    "ev_diversity": """with w as (select split_part(source, '/', 1) as kind, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as w from documents where text is not null), v as (select * from w where len(w) > 1),
p as (select kind, p, count(*) as n from (select kind, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as p from v) group by 1, 2),
s as (select kind, t, count(*) as n from (select kind, unnest(w) as t from v) group by 1, 2)
select kind, distinct_pairs, entropy from (select kind, round(count(*) / sum(n), 6) as distinct_pairs from p group by 1) join (select kind, round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 6) as entropy from s group by 1) using (kind)""",
    "ev_composition": """with f as (select split_part(relpath, '/', 1) as item, scanned_at >= timestamptz '2024-07-01 00:00:00+00' as late from file_records where relpath is not null)
select item, sum(case when not late then 1 else 0 end)::bigint as before, sum(case when late then 1 else 0 end)::bigint as after, sum(case when late then 1 else -1 end)::bigint as change from f group by 1""",
    "ev_failure_runs": """with e as (select user_id, ts, event_type = 'error' as f, row_number() over (partition by user_id order by ts, event_id) - row_number() over (partition by user_id, event_type = 'error' order by ts, event_id) as g from events)
select user_id, min(ts) as first, count(*) as length from e where f group by user_id, g having count(*) >= 3""",
    "st_tumbling": f"select time_bucket(interval '1 hour', ts) as window_start, event_type, {_WINDOW} from events group by 1, 2",
    "st_sliding": f"select window_start, event_type, {_WINDOW} from (select *, unnest(list_transform(range(0, 4), lambda i: time_bucket(interval '30 minutes', ts) - i * interval '30 minutes')) as window_start from events) group by 1, 2",
    "st_sessions": f"""with s as (select *, case when ts - lag(ts) over w < interval '30 minutes' then 0 else 1 end as fresh from events window w as (partition by user_id order by ts)),
g as (select *, sum(fresh) over (partition by user_id order by ts rows unbounded preceding) as g from s) select min(ts) as window_start, user_id, {_WINDOW} from g group by user_id, g""",
}
