"""Numbers that texts cite, and pairs of bugs and changes scored by the signals between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodeweave.operators.linking import score, within_days

# fixed values: patterns of change numbers in comments and of bug numbers in descriptions
CHANGE_PATTERNS = (
    r"(?i)\bCL\s*#?\s*(\d{4,})\b",
    r"(?i)\bchange(?:list)?\s+(\d{4,})\b",
    r"(?i)@(?:p4|swarm|change)[/_]?(\d{4,})",
    r"/changes/(\d{4,})",
    r"(?i)\bsubmitted\s+as\s+(\d{4,})\b",
)
BUG_PATTERNS = (
    r"(?i)\bbug\s*[-#]?\s*(\d{4,})\b",
    r"(?i)\bBZ\s*[-#]?\s*(\d{4,})\b",
    r"show_bug\.cgi\?id=(\d{4,})",
    r"(?i)\bfix(?:es|ed)?\s+(?:bug\s+)?(\d{4,})\b",
    r"(?i)\bclos(?:es|ed)?\s+(?:bug\s+)?(\d{4,})\b",
)
# fixed values: what a signal weighs
WEIGHTS = {"bug_comment_cites_cl": "0.50", "cl_desc_cites_bug": "0.50", "temporal_proximity": "0.30", "assignee_author_match": "0.20", "bug_status_fixed": "0.10"}


def cited_numbers(text: Column, patterns: tuple[str, ...], least: int = 1000) -> Column:
    """The set of numbers that any pattern captures and that are not below `least`, in rising order; a null text cites nothing."""
    found = F.flatten(F.array(*[F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(p), F.lit(1)) for p in patterns]))
    numbers = F.transform(found, lambda x: x.try_cast("bigint"))
    return F.array_sort(F.array_distinct(F.filter(numbers, lambda n: n >= least)))


def scored_pairs(bugs: DataFrame, changes: DataFrame, threshold: str = "0.80", window_days: int = 60, near_days: int = 7, least: int = 1000) -> DataFrame:
    """bugs(bug, assigned_to, fixed, changed, comments), changes(cl, author, submitted, description) -> (bug, cl, signals, confidence).

    All pairs within the window whose signals reach the threshold. Which signals a pair must have to get there decides how
    candidates are made: where the others together fall short, only pairs that cite one another are looked up; where they
    need the same person, pairs of one person; and time buckets over all pairs only where less would do.
    """
    b = bugs.where("bug is not null and changed is not null").withColumn("cites", cited_numbers(F.col("comments"), CHANGE_PATTERNS, least))
    c = changes.where("cl is not null and submitted is not null").withColumn("cited", cited_numbers(F.col("description"), BUG_PATTERNS, least))
    named = b.select("bug", F.explode("cites").alias("cl")).unionByName(c.select(F.explode("cited").alias("bug"), "cl")).distinct()
    weight = {k: float(v) for k, v in WEIGHTS.items()}
    alone = weight["temporal_proximity"] + weight["bug_status_fixed"]
    sides = named.join(b, "bug").join(c, "cl")
    columns = ["bug", "cl", "assigned_to", "author", "fixed", "changed", "submitted", "cites", "cited"]
    if alone + weight["assignee_author_match"] >= float(threshold):
        person = alone < float(threshold)
        left, right = (b.withColumn("who", F.col("assigned_to") if person else F.lit(0)), c.withColumn("who", F.col("author") if person else F.lit(0)))
        sides = sides.select(columns).unionByName(within_days(left, right, ["who"], "changed", "submitted", window_days).select(columns)).dropDuplicates(["bug", "cl"])
    within = sides.where(F.abs(F.unix_micros("submitted") - F.unix_micros("changed")) <= window_days * 86_400_000_000)
    days = F.floor((F.unix_micros("submitted") - F.unix_micros("changed")) / 86_400_000_000)
    fired = {
        "bug_comment_cites_cl": F.array_contains("cites", F.col("cl")),
        "cl_desc_cites_bug": F.array_contains("cited", F.col("bug")),
        "temporal_proximity": F.abs(days) <= near_days,
        "assignee_author_match": F.coalesce((F.col("assigned_to") != "") & (F.col("assigned_to") == F.col("author")), F.lit(False)),
        "bug_status_fixed": F.coalesce("fixed", F.lit(False)),
    }
    total = score({k: (v, WEIGHTS[k]) for k, v in fired.items()})
    names = F.array_join(F.array_compact(F.array(*[F.when(v, k) for k, v in fired.items()])), ",")
    return within.select("bug", "cl", names.alias("signals"), total.alias("exact")).where(F.col("exact") >= F.lit(threshold).cast("decimal(5,2)")).select("bug", "cl", "signals", F.col("exact").cast("double").alias("confidence"))


def upsert_fix_links(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """(bug, cl, signals, confidence): confidence is the greatest of old and new, signals are those that came last."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    return both.groupBy("bug", "cl").agg(F.max_by("signals", F.struct("_new", "signals")).alias("signals"), F.max("confidence").alias("confidence"))


def explicit_links(edges: DataFrame) -> DataFrame:
    """(pr_number, issue_number) edges in either order of columns and any number of copies -> one certain link each."""
    return edges.where("issue_number is not null and pr_number is not null").select("issue_number", "pr_number").distinct().select("issue_number", "pr_number", F.lit(1.0).alias("confidence"), F.lit("explicit").alias("source"))
