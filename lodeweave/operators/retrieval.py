"""Ranked retrieval for batches of queries: BM25, exact nearest vectors in blocks, rank fusion, hydration.

Queries are a table like any other; every operator answers all of them in one job.
Ties are broken by id, so results are the same at any partitioning. Null texts have
no words, null vectors no neighbours; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from lodeweave.functions.text import words
from lodeweave.session import materialize

K1, B = 1.2, 0.75  # fixed values of the ranking formula
FLOOR_IDF = 1e-6


def query_terms(queries: DataFrame, id_col: str, text: Column) -> DataFrame:
    """(query, term, times): repeated words of a query count each."""
    return (
        queries.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("query"), F.explode(words(text)).alias("term"))
        .groupBy("query", "term").agg(F.count(F.lit(1)).alias("times"))
    )


def wanted_words(docs: DataFrame, id_col: str, text: Column, vocabulary: list[str]) -> DataFrame:
    """(doc, words, len, lens, rows): the words of the vocabulary in each document; rows of one document are put together.

    A text is cut into words once, and words that no query asks for go before the shuffle.
    """
    cut = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), words(F.coalesce(text, F.lit(""))).alias("w"))
    kept = cut.select("doc", F.size("w").alias("len"), F.filter("w", lambda x: x.isin(vocabulary)).alias("w"))
    return kept.groupBy("doc").agg(
        F.flatten(F.collect_list("w")).alias("words"), F.first("len").alias("len"), F.sum("len").alias("lens"), F.count(F.lit(1)).alias("rows")
    )


QUERY_ROWS = 1 << 20  # terms of queries that go to the tasks at a time
SLAB = 1024  # documents whose weights a task multiplies at a time


def _score_batches(names: list, vocabulary: dict[str, int], idf: np.ndarray, times: np.ndarray, mean: float, k: int, mode: str):
    """mapInArrow body over (doc, words, len): (query, doc, score, complete) that can be among the k best of a query."""
    asked, labels, size = (times > 0).astype(np.float64), pa.array(names), len(vocabulary)
    need = asked.sum(0)
    ahead = 1e9  # by which a complete document beats all others

    def run(batches):
        best = np.full((k, len(names)), -np.inf)  # the k best so far of each query, in rising order
        for batch in (x.slice(at, SLAB) for x in batches for at in range(0, x.num_rows, SLAB)):
            found = batch.column("words")
            codes = pc.dictionary_encode(found.flatten())
            term = np.array([vocabulary[t] for t in codes.dictionary.to_pylist()], dtype=np.int64)[codes.indices.to_numpy()]
            row = np.repeat(np.arange(batch.num_rows), np.diff(found.offsets.to_numpy()))
            tf = np.bincount(row * size + term, minlength=batch.num_rows * size).reshape(batch.num_rows, size).astype(np.float64)
            length = batch.column("len").to_numpy(zero_copy_only=False).astype(np.float64)
            w = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[:, None] / mean))
            score, hits = (w @ times).round(9), (tf > 0) @ asked
            complete = hits == need
            value = np.where(complete if mode == "and" else hits > 0, score + ahead * (complete if mode == "and_or" else 0), -np.inf)
            best = np.sort(np.concatenate([best, value]), axis=0)[-k:]
            row, query = np.nonzero((value >= best[0]) & np.isfinite(value))
            yield pa.RecordBatch.from_arrays(
                [labels.take(pa.array(query)), batch.column("doc").take(pa.array(row)), pa.array(score[row, query]), pa.array(complete[row, query])], names=["query", "doc", "score", "complete"]
            )

    return run


def bm25(docs: DataFrame, id_col: str, text: Column, terms: DataFrame, k: int, mode: str = "or", carried: int = 1 << 22) -> DataFrame:
    """(query, doc, score, rank) of the k best documents per query; score is positive, higher is better.

    terms(query, term, times). mode "and" keeps documents with all terms of the query, "or" with any, "and_or" falls back to
    any where no document has all. Queries go to every task in blocks of at most `carried` cells of terms by queries (32 MB);
    a task multiplies the weights of its documents with them and passes on what can be among the k best, so no row is made
    for each query and document. The words that a block asks for are written once and give the frequencies as well.
    """
    kind = "string" if dict(terms.dtypes)["query"] == "string" else "bigint"
    few = terms.limit(QUERY_ROWS + 1).collect()
    blocks = 1
    if len(few) > QUERY_ROWS or len({r["query"] for r in few}) * len({r["term"] for r in few}) > carried:
        size = terms.agg(F.countDistinct("query").alias("queries"), F.countDistinct("term").alias("terms"), F.count(F.lit(1)).alias("rows")).first()
        blocks = max(1, -(-size["queries"] * size["terms"] // carried), -(-size["rows"] // QUERY_ROWS))
    scored = None
    for block in range(blocks):
        rows = few if blocks == 1 else terms.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).collect()  # one block
        names = sorted({r["query"] for r in rows})
        vocabulary = {t: i for i, t in enumerate(sorted({r["term"] for r in rows}))}
        times, place = np.zeros((len(vocabulary), len(names))), {q: i for i, q in enumerate(names)}
        for r in rows:
            times[vocabulary[r["term"]], place[r["query"]]] = r["times"]
        if not names:
            continue
        found = materialize(wanted_words(docs, id_col, text, list(vocabulary)), "words")
        each = found.select("rows", "lens", F.explode(F.array_append(F.array_distinct("words"), F.lit(""))).alias("term"))
        n = total = 0
        df = np.zeros(len(vocabulary))
        for r in each.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("rows").alias("rows"), F.sum("lens").alias("total")).collect():  # the vocabulary, and "" for all
            if r["term"]:
                df[vocabulary[r["term"]]] = r["df"]
            else:
                n, total = r["rows"], r["total"]
        with np.errstate(divide="ignore", invalid="ignore"):
            idf = np.log((n - df + 0.5) / (df + 0.5))
        idf = np.where(idf > 0, idf, FLOOR_IDF)
        part = found.select("doc", "words", "len").mapInArrow(
            _score_batches(names, vocabulary, idf, times, max(total / max(1, n), 1e-9), k, mode), f"query {kind}, doc {dict(found.dtypes)['doc']}, score double, complete boolean"
        )
        scored = part if scored is None else scored.unionByName(part)
    if scored is None:
        return docs.limit(0).select(F.lit(None).cast(kind).alias("query"), F.col(id_col).alias("doc"), F.lit(0.0).alias("score"), F.lit(0).alias("rank"))
    first = [F.desc("complete")] if mode == "and_or" else []
    order = Window.partitionBy("query").orderBy(*first, F.desc("score"), "doc")
    top = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    if mode == "and_or":  # complete documents come first, and they are all there is where one is complete
        top = top.withColumn("best", F.first("complete").over(Window.partitionBy("query").orderBy("rank"))).where("complete or not best")
    return top.select("query", "doc", "score", "rank")


def _topk(qid: np.ndarray, q: np.ndarray, bid: np.ndarray, b: np.ndarray, k: int):
    """The k nearest rows of b for every row of q: (query, doc, distance) arrays, ties to the smaller id."""
    d = np.sqrt(np.maximum(0, (q * q).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (q @ b.T))).round(6)
    order = np.lexsort((np.broadcast_to(bid, d.shape), d), axis=1)[:, :k]
    rows = np.repeat(np.arange(len(qid)), order.shape[1])
    return qid[rows], bid[order.ravel()], d[rows, order.ravel()]


def _scan_topk(qid: np.ndarray, q: np.ndarray, k: int):
    """mapInArrow body over base(id, v): keeps the k nearest of each query over all batches of a task."""

    def run(batches):
        best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        for batch in batches:
            if not batch.num_rows or not len(qid):
                continue
            bid = batch.column(0).to_numpy(zero_copy_only=False)
            b = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.float64)
            found = [np.concatenate(x) for x in zip(best, _topk(qid, q, bid, b, k))]
            order = np.lexsort((found[1], found[2], found[0]))
            query, doc, distance = (x[order] for x in found)
            first = np.concatenate(([True], query[1:] != query[:-1]))
            place = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0))
            best = tuple(x[place < k] for x in (query, doc, distance))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], names=["query", "doc", "distance"])

    return run


def _block_topk(k: int):
    def run(queries: pa.Table, base: pa.Table) -> pa.Table:
        if not queries.num_rows or not base.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "doc": pa.array([], pa.int64()), "distance": pa.array([], pa.float64())})
        q, b = (np.stack(t.column("v").to_numpy(zero_copy_only=False)).astype(np.float64) for t in (queries, base))
        found = _topk(queries.column("id").to_numpy(), q, base.column("id").to_numpy(), b, k)
        return pa.table(dict(zip(("query", "doc", "distance"), map(pa.array, found))))

    return run


def nearest(queries: DataFrame, base: DataFrame, k: int, query_block: int = 1024, base_block: int = 65536, carried: int = 1 << 22) -> DataFrame:
    """Exact k nearest (query, doc, distance, rank) by L2; queries(id, v) against base(id, v).

    The base stays where it is: up to `carried` numbers of query vectors (32 MB) are handed to every task, which scans its
    part once and keeps k rows a query. More queries than that are met block by block through a shuffle; the rows are the same.
    """
    queries, base = queries.where("id is not null and v is not null"), base.where("id is not null and v is not null")
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("v")), F.lit(0)).alias("numbers")).first()
    if size["numbers"] <= carried:
        rows = queries.select("id", "v").collect()  # bounded by the check above
        q = np.array([r["v"] for r in rows], dtype=np.float64)
        best = base.select("id", "v").mapInArrow(_scan_topk(np.array([r["id"] for r in rows], dtype=np.int64), q, k), "query bigint, doc bigint, distance double")
    else:
        nq, nb = max(1, -(-size["n"] // query_block)), max(1, -(-base.count() // base_block))
        q = queries.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(nq)).cast("int")).withColumn("bb", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))))
        b = base.withColumn("bb", F.pmod(F.xxhash64("id"), F.lit(nb)).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
        best = q.groupBy("qb", "bb").cogroup(b.groupBy("qb", "bb")).applyInArrow(_block_topk(k), "query bigint, doc bigint, distance double")
    order = Window.partitionBy("query").orderBy("distance", "doc")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def fuse(lists: list[DataFrame], k: int, rrf_k: int = 60) -> DataFrame:
    """Reciprocal rank fusion of (query, doc, rank) lists: sum of 1 / (rrf_k + rank); earlier lists win ties."""
    ranked = None
    for i, one in enumerate(lists):
        rows = one.select("query", "doc", F.lit(i).alias("list"), "rank")
        ranked = rows if ranked is None else ranked.unionByName(rows)
    ranks = [F.min(F.when(F.col("list") == i, F.col("rank"))).alias(f"rank_{i}") for i in range(len(lists))]
    fused = ranked.groupBy("query", "doc").agg(F.round(F.sum(F.lit(1.0) / (rrf_k + F.col("rank"))), 9).alias("score"), *ranks)
    order = Window.partitionBy("query").orderBy(F.desc("score"), *[F.asc_nulls_last(f"rank_{i}") for i in range(len(lists))], "doc")
    return fused.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def weighted_fusion(scores: list[tuple[DataFrame, float]], k: int) -> DataFrame:
    """Linear fusion of (query, doc, score) lists after min-max scaling per query; a missing score counts 0."""
    parts = None
    w = Window.partitionBy("query")
    for df, weight in scores:
        span = F.max("score").over(w) - F.min("score").over(w)
        scaled = F.when(span > 0, (F.col("score") - F.min("score").over(w)) / span).otherwise(1.0)
        rows = df.select("query", "doc", (scaled * weight).alias("part"))
        parts = rows if parts is None else parts.unionByName(rows)
    fused = parts.groupBy("query", "doc").agg(F.round(F.sum("part"), 6).alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc")
    return fused.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def assert_unit(df: DataFrame, column: str, tolerance: float = 0.01) -> DataFrame:
    """Fails the job when a vector's L2 norm is further from 1 than the tolerance."""
    norm = F.sqrt(F.aggregate(column, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    ok = F.assert_true(F.abs(norm - 1) <= tolerance, F.lit(f"{column} is not a unit vector"))
    return df.where(ok.isNull())


def recency(score: Column, at: Column, now: Column, years: float = 3.0) -> Column:
    """A score that fades with age: exp(-age / years); what has no time, or lies ahead, does not fade."""
    age = F.greatest(F.lit(0.0), (F.unix_micros(now) - F.unix_micros(at)) / F.lit(31_557_600_000_000.0))
    return score * F.coalesce(F.exp(-age / years), F.lit(1.0))


def after_lexical(lexical: DataFrame, dense: DataFrame, k: int, least: float | None = None) -> DataFrame:
    """Lexical hits first, then dense ones that are not among them: (query, doc, rank, arm); no dense hit beyond the distance `least`."""
    near = dense if least is None else dense.where(F.col("distance") <= least)
    both = lexical.select("query", "doc", F.lit(0).alias("arm"), F.col("rank").alias("place")).unionByName(near.select("query", "doc", F.lit(1).alias("arm"), F.col("rank").alias("place")))
    first = both.groupBy("query", "doc").agg(F.min(F.struct("arm", "place")).alias("s")).select("query", "doc", "s.*")
    order = Window.partitionBy("query").orderBy("arm", "place", "doc")
    return first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "doc", "rank", "arm")


def folded(words: Column, aliases: dict[str, list[str]]) -> Column:
    """Words with every alias replaced by the name it stands for, and identifiers of several parts followed by their parts."""
    names = F.create_map(*[F.lit(x) for name, others in sorted(aliases.items()) for other in sorted(others) for x in (other, name)]) if aliases else None
    each = F.transform(words, lambda w: F.coalesce(F.get(F.array(F.element_at(names, w)), F.lit(0)), w)) if names is not None else words
    parts = lambda w: F.filter(F.split(w, "_"), lambda p: p != "")
    return F.flatten(F.transform(each, lambda w: F.when(F.size(parts(w)) > 1, F.concat(F.array(w), parts(w))).otherwise(F.array(w))))


def to_embed(rows: DataFrame, stored: DataFrame, key: str, text: Column, model: str) -> DataFrame:
    """(key, src_hash, text) of rows that have no vector of this model for the text they now have."""
    now = rows.select(key, F.sha2(text, 256).alias("src_hash"), text.alias("text")).where("text is not null")
    return now.join(stored.where(F.col("model") == model).select(key, "src_hash"), [key, "src_hash"], "left_anti")


def augmented(hits: DataFrame, path: Column, start: Column, end: Column, text: Column) -> DataFrame:
    """(query, prompt): the chunks of each query under `path:start-end` lines, the most relevant last."""
    piece = F.concat(path, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"), F.lit("\n"), text)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("rank")).alias("r"), piece.alias("p"))))
    return hits.groupBy("query").agg(F.array_join(F.transform(ordered, lambda x: x["p"]), "\n\n").alias("prompt"))


def shared_budget(hits: DataFrame, text: str, budget: int) -> DataFrame:
    """(query, packed): chunks in rank order, each given an equal share of what is left of a budget of characters.

    What a short chunk does not use goes to those after it; a longer one is cut at the last line end that fits.
    """
    ordered = F.array_sort(F.collect_list(F.struct("rank", "doc", F.coalesce(F.col(text), F.lit("")).alias("t"))))
    n = F.col("n")

    def step(acc, x):
        share = F.floor((F.lit(budget) - acc["used"]) / (n - acc["seen"])).cast("int")
        fits = F.length(x["t"]) <= share
        head = F.substring(x["t"], F.lit(1), share)
        lines = F.regexp_extract(head, r"(?s)^(.*)\n", 1)  # up to the last line end
        piece = F.when(fits, x["t"]).otherwise(lines)
        pieces = F.when(F.length(piece) > 0, F.concat(acc["pieces"], F.array(F.struct(x["doc"].alias("doc"), F.length(piece).alias("size"))))).otherwise(acc["pieces"])
        return F.struct((acc["used"] + F.length(piece)).cast("int").alias("used"), (acc["seen"] + 1).cast("int").alias("seen"), pieces.alias("pieces"))

    each = hits.groupBy("query").agg(ordered.alias("xs"), F.count(F.lit(1)).cast("int").alias("n"))
    kind = dict(hits.dtypes)["doc"]
    start = F.struct(F.lit(0).alias("used"), F.lit(0).alias("seen"), F.array().cast(f"array<struct<doc: {kind}, size: int>>").alias("pieces"))
    packed = each.select("query", F.aggregate("xs", start, step).alias("a"))
    return packed.select("query", "a.used", F.posexplode("a.pieces").alias("place", "p")).select("query", "place", "p.doc", "p.size", "used")
