"""Scores and quality measures: task signals, ranking metrics, perplexity, lift, diversity, percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def hit_share(signals: str, response: str, empty: float) -> Column:
    """Share of the signals that occur in the response, in any case; `empty` without signals."""
    found = F.filter(signals, lambda s: F.lower(response).contains(F.lower(s)))
    return F.when(F.coalesce(F.size(signals), F.lit(0)) <= 0, F.lit(empty)).otherwise(F.size(found) / F.size(signals))


def task_score(expected: str, forbidden: str, response: str) -> Column:
    return hit_share(expected, response, 1.0) - hit_share(forbidden, response, 0.0)


def mean_or_zero(column: str) -> Column:
    return F.coalesce(F.avg(column), F.lit(0.0))


def perplexity(loss: Column, tokens: Column) -> Column:
    """exp of the token-weighted mean loss; NaN without tokens."""
    n = F.sum(tokens)
    return F.when(n > 0, F.exp(F.sum(loss * tokens) / n)).otherwise(F.lit(float("nan")))


def ranking_metrics(hits: DataFrame, group: str, cuts: tuple[int, ...] = (1, 3, 10)) -> DataFrame:
    """hits(group, query, rank, relevant boolean) -> hit@k, recall-free MRR per group, queries without a relevant hit count 0."""
    first = hits.groupBy(group, "query").agg(F.min(F.when(F.col("relevant"), F.col("rank"))).alias("first"))
    shares = [F.round(F.avg(F.when(F.col("first") <= k, 1.0).otherwise(0.0)), 6).alias(f"hit_{k}") for k in cuts]
    return first.groupBy(group).agg(F.count(F.lit(1)).alias("queries"), *shares, F.round(F.avg(F.coalesce(1.0 / F.col("first"), F.lit(0.0))), 6).alias("mrr"))


def lift(scores: DataFrame, group: str, value: str, baseline: str, threshold: float = 0.05) -> DataFrame:
    """Difference of every group to the baseline group, and whether it reaches the threshold."""
    base = scores.where(F.col(group) == baseline).select(F.col(value).alias("base"))
    rows = base.limit(1).collect()
    reference = F.lit(rows[0]["base"] if rows else None).cast("double")
    return scores.withColumn("lift", F.round(F.col(value) - reference, 6)).withColumn("enabled", F.coalesce(F.round(F.col(value) - reference, 6) >= threshold, F.lit(False)))


def diversity(texts: DataFrame, group: str, words: Column) -> DataFrame:
    """Share of distinct word pairs and entropy of the words in bits, per group; words and pairs are counted as hashes in one pass."""
    w = texts.select(group, words.alias("w"))
    single = F.transform("w", lambda x: F.struct(F.lit(False).alias("pair"), F.xxhash64(x).alias("h")))
    pairs = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.struct(F.lit(True).alias("pair"), F.xxhash64(F.get("w", i - 1), F.get("w", i)).alias("h")))
    each = w.select(group, F.explode_outer(F.when(F.size("w") > 1, F.concat(single, pairs))).alias("x")).select(group, "x.*")
    counted = each.where("h is not null").groupBy(group, "pair", "h").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    word = lambda c: F.sum(F.when(~F.col("pair"), c))
    return counted.groupBy(group).agg(
        F.round(F.count_if("pair") / F.sum(F.when(F.col("pair"), n)), 6).alias("distinct_pairs"),
        F.round(F.log2(word(n)) - word(n * F.log2(n)) / word(n), 6).alias("entropy"),
    )


def exact_percentiles(rows: DataFrame, group: str, value: str, shares: dict[str, float], parts: int = 256) -> DataFrame:
    """Interpolated percentiles per group: (group, one column a share); null values do not count.

    Approximate quantiles cut the values of a group into parts; the parts are counted, and only the values of those that hold
    a wanted rank are put in order, counted by value. No buffer holds a group.
    """
    known = rows.where(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).alias("v"))
    edges = known.groupBy("g").agg(F.percentile_approx("v", F.array(*[F.lit(i / parts) for i in range(1, parts)]), 10 * parts).alias("edges"), F.count(F.lit(1)).alias("n"))
    # an edge list a group; a value's part is the number of edges below it
    part = F.size(F.filter("edges", lambda e: e < F.col("v")))
    placed = known.join(edges, "g").select("g", "v", "n", part.alias("part"))
    counts = placed.groupBy("g", "part").agg(F.count(F.lit(1)).alias("here"), F.max("n").alias("n"))
    before = F.sum("here").over(Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranks = F.array(*[f(F.lit(p) * (F.col("n") - 1)).cast("bigint") for p in shares.values() for f in (F.floor, F.ceil)])
    counts = counts.withColumn("before", F.coalesce(before, F.lit(0))).withColumn("ranks", ranks)
    wanted = counts.where(F.exists("ranks", lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("here"))))
    values = placed.join(wanted.select("g", "part", "before", "ranks"), ["g", "part"]).groupBy("g", "part", "v").agg(F.count(F.lit(1)).alias("times"), F.first("before").alias("before"), F.first("n").alias("n"), F.first("ranks").alias("ranks"))
    last = F.col("before") + F.sum("times").over(Window.partitionBy("g", "part").orderBy("v"))
    at = values.withColumn("last", last).withColumn("first", F.col("last") - F.col("times"))
    pick = lambda i: F.max(F.when((F.get("ranks", F.lit(i)) >= F.col("first")) & (F.get("ranks", F.lit(i)) < F.col("last")), F.col("v")))
    picked = at.groupBy("g").agg(F.max("n").alias("n"), *[pick(i).alias(f"r{i}") for i in range(2 * len(shares))])
    out = []
    for i, (name, p) in enumerate(shares.items()):
        place = F.lit(p) * (F.col("n") - 1)
        out.append((F.col(f"r{2 * i}") + (F.col(f"r{2 * i + 1}") - F.col(f"r{2 * i}")) * (place - F.floor(place))).alias(name))
    return picked.select(F.col("g").alias(group), *out)


def composition_change(rows: DataFrame, item: Column, time: str, cut: Column) -> DataFrame:
    """Counts of an item before and after a point in time."""
    old = rows.where(F.col(time) < cut).groupBy(item.alias("item")).agg(F.count(F.lit(1)).alias("before"))
    new = rows.where(F.col(time) >= cut).groupBy(item.alias("item")).agg(F.count(F.lit(1)).alias("after"))
    both = old.join(new, "item", "full_outer").na.fill(0, ["before", "after"])
    return both.withColumn("change", F.col("after") - F.col("before"))


def ranked_summary(rows: DataFrame, value: str, key: str) -> DataFrame:
    """Rows in the order of a report: best value first, missing values last, ties by key."""
    return rows.orderBy(F.desc_nulls_last(value), key)


def recall_at(hits: DataFrame, relevant: DataFrame, group: str, cuts: tuple[int, ...] = (3, 10)) -> DataFrame:
    """hits(group, query, rank, relevant), relevant(query, total) -> mean share of the relevant rows among the first k, per group."""
    found = hits.groupBy(group, "query").agg(*[F.count_if(F.col("relevant") & (F.col("rank") <= k)).alias(f"f{k}") for k in cuts])
    shares = [F.round(F.avg(F.when(F.col("total") > 0, F.col(f"f{k}") / F.col("total")).otherwise(0.0)), 6).alias(f"recall_{k}") for k in cuts]
    return found.join(relevant, "query", "left").groupBy(group).agg(F.count(F.lit(1)).alias("queries"), *shares)


def answer_quality(answers: DataFrame, cited: DataFrame, known: DataFrame, sets: list[list[str]], *columns: str) -> DataFrame:
    """Per grouping set: answers, share that cites, precision of what is cited, share that cites something unknown, mean cost.

    answers(answer, cost, columns...), cited(answer, ref), known(ref).
    """
    marked = cited.distinct().join(known.distinct().withColumn("_known", F.lit(True)), "ref", "left")
    per = marked.groupBy("answer").agg(F.count(F.lit(1)).alias("refs"), F.count_if("_known").alias("good"))
    each = answers.join(per, "answer", "left").na.fill(0, ["refs", "good"])
    refs, good = F.col("refs"), F.col("good")
    return each.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.count(F.lit(1)).alias("answers"), F.round(F.avg((refs > 0).cast("int")), 6).alias("citation_rate"),
        F.round(F.coalesce(F.sum(good) / F.nullif(F.sum(refs), F.lit(0)), F.lit(0.0)), 6).alias("precision"),
        F.round(F.avg((good < refs).cast("int")), 6).alias("hallucination_rate"), F.round(F.avg("cost"), 6).alias("mean_cost"),
    )


def fabrication(answers: DataFrame, words: Column, grounds: Column) -> DataFrame:
    """answers(answer, ...) -> (answer, named, made_up): identifiers of an answer, and those that stand in none of its grounds."""
    named = F.array_distinct(words)
    return answers.select("answer", F.size(named).alias("named"), F.size(F.array_except(named, grounds)).alias("made_up"))


def promotion(baseline: DataFrame, candidate: DataFrame, group: str, value: str, guarded: list[str], tolerance: float = 0.0) -> DataFrame:
    """One row: whether a candidate is strictly better in the mean and loses in no guarded group by more than the tolerance."""
    both = baseline.select(group, F.col(value).alias("old")).join(candidate.select(group, F.col(value).alias("new")), group, "full")
    lost = F.count_if(F.col(group).isin(guarded) & (F.coalesce("new", F.lit(0.0)) < F.coalesce("old", F.lit(0.0)) - tolerance))
    out = both.agg(F.round(F.avg("new"), 6).alias("candidate"), F.round(F.avg("old"), 6).alias("baseline"), lost.alias("regressions"))
    return out.withColumn("promoted", F.coalesce((F.col("candidate") > F.col("baseline")) & (F.col("regressions") == 0), F.lit(False)))
