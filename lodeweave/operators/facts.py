"""A fact table: (subject, predicate, object, confidence, tier, since) rows, their insertion, supersession, lookup and health."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lodeweave.session import discard, materialize

TIERS = {"det": 2, "heur": 1, "llm": 0}  # a fact is not retired by one of a lower tier
TRIPLE = ["subject", "predicate", "object"]


def _rank():
    out = F.lit(0)
    for name, rank in TIERS.items():
        out = F.when(F.col("tier") == name, rank).otherwise(out)
    return out


def get_or_create(stored: DataFrame, seen: DataFrame) -> DataFrame:
    """Entities (kind, name, repo, path, first_seen, last_seen) after rows (kind, name, repo, path, since): a null repo is a key like
    any other, a known path is never overwritten, an unknown one is filled by the earliest that comes."""
    old = stored.select("kind", "name", "repo", "path", "first_seen", "last_seen", F.lit(0).alias("_new"))
    new = seen.select("kind", "name", "repo", "path", F.col("since").alias("first_seen"), F.col("since").alias("last_seen"), F.lit(1).alias("_new"))
    known = F.when(F.col("path").isNotNull(), F.struct("_new", "first_seen", "path"))
    return old.unionByName(new).groupBy("kind", "name", "repo").agg(F.min(known)["path"].alias("path"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def insert_facts(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored facts and those incoming whose triple is new, once each at their earliest time; the same input again adds nothing."""
    order = Window.partitionBy(*TRIPLE).orderBy("since", F.desc("confidence"), "tier")
    once = incoming.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")
    match = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in TRIPLE]
    return stored.unionByName(once.alias("n").join(stored.select(*TRIPLE).distinct().alias("o"), match, "left_anti").select(stored.columns))


def superseded(facts: DataFrame) -> DataFrame:
    """Single-valued slots (subject, predicate): each fact with valid_to, the time of the first later fact of its tier or a higher
    one with another object; a fact that a higher tier precedes is retired where it starts."""
    slot = Window.partitionBy("subject", "predicate").orderBy("since", F.desc("rank"), "object")
    ranked = facts.withColumn("rank", _rank())
    above = F.max("rank").over(slot.rowsBetween(Window.unboundedPreceding, -1))
    # the rows after it, by tier: the first that may retire it
    later = [F.min(F.when(F.col("rank") >= r, F.col("since"))).over(slot.rowsBetween(1, Window.unboundedFollowing)).alias(f"later_{r}") for r in sorted(set(TIERS.values()))]
    out = ranked.select("*", above.alias("above"), *later)
    end = F.lit(None).cast("timestamp")
    for r in sorted(set(TIERS.values())):
        end = F.when(F.col("rank") == r, F.col(f"later_{r}")).otherwise(end)
    return out.withColumn("valid_to", F.when(F.col("above") > F.col("rank"), F.col("since")).otherwise(end)).select(*facts.columns, "valid_to")


def query_facts(facts: DataFrame, subject: str | None = None, predicate: str | None = None, object: str | None = None, least: float = 0.0, as_of=None, limit: int | None = None) -> DataFrame:
    """Facts that match what is given, at least so certain, valid at a time; the most certain first where there is a limit."""
    out = facts.where(F.col("confidence") >= least)
    for column, value in (("subject", subject), ("predicate", predicate), ("object", object)):
        if value is not None:
            out = out.where(F.col(column) == value)
    if as_of is not None:
        out = out.where((F.col("since") <= as_of) & (F.col("valid_to").isNull() | (F.col("valid_to") > as_of)))
    return out if limit is None else out.orderBy(F.desc("confidence"), *TRIPLE, "since").limit(limit)


def explain(facts: DataFrame, entities: DataFrame) -> DataFrame:
    """(entity, direction, predicate, other, confidence): what is said of each entity and what refers to it."""
    e = entities.select("entity").distinct()
    out = facts.join(e, facts.subject == e.entity).select("entity", F.lit("out").alias("direction"), "predicate", F.col("object").alias("other"), "confidence")
    into = facts.join(e, facts.object == e.entity).select("entity", F.lit("in").alias("direction"), "predicate", F.col("subject").alias("other"), "confidence")
    return out.unionByName(into).distinct()


def capped(facts: DataFrame, most: int) -> DataFrame:
    """The `most` most certain facts of every (subject, predicate), and how many were left away beside each."""
    slot = Window.partitionBy("subject", "predicate")
    order = slot.orderBy(F.desc("confidence"), "object", "since")
    counts = facts.groupBy("subject", "predicate").agg(F.count(F.lit(1)).alias("_all"))
    kept = facts.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most).drop("_r")
    return kept.join(counts, ["subject", "predicate"]).withColumn("left_away", F.greatest(F.lit(0), F.col("_all") - most)).drop("_all")


def latest_run(rows: DataFrame, target: list[str], run: str, order: list, most: int) -> DataFrame:
    """Rows of the newest run of each target, at most so many of a run."""
    newest = rows.groupBy(*target).agg(F.max(run).alias("_run"))
    kept = rows.join(newest, target).where(F.col(run) == F.col("_run")).drop("_run")
    return kept.withColumn("_r", F.row_number().over(Window.partitionBy(*target).orderBy(*order))).where(F.col("_r") <= most).drop("_r")


def terminals(pointers: DataFrame, max_rounds: int = 40) -> DataFrame:
    """pointers(node, next) -> (node, terminal, cyclic): the end of every chain, by pointer doubling.

    A node has one pointer (the smallest where there are several). Chains that run into a circle end at no node of it: they
    are marked and the terminal is null. Every round doubles the steps taken, so long chains take few rounds.
    """
    p = pointers.where("node is not null and next is not null and node <> next").groupBy("node").agg(F.min("next").alias("next"))
    at = materialize(p, "chains")
    nodes = at.count()
    for turn in range(1, max_rounds + 1):
        ahead = at.select(F.col("node").alias("next"), F.col("next").alias("far"))
        step = materialize(at.select("node", "next").join(ahead, "next", "left").select("node", F.coalesce("far", "next").alias("next"), F.col("far").isNotNull().alias("moved")), "chains")
        if step.where("moved").isEmpty():
            return step.select("node", F.col("next").alias("terminal"), F.lit(False).alias("cyclic"))
        discard(at)
        at = step
        if 2**turn > nodes:  # what still moves after as many steps as there are nodes stands in a circle
            break
    ends = at.join(p.select(F.col("node").alias("next")), "next", "left_semi").select("node").distinct().withColumn("cyclic", F.lit(True))
    out = at.join(ends, "node", "left").withColumn("cyclic", F.coalesce("cyclic", F.lit(False)))
    return out.select("node", F.when(~F.col("cyclic"), F.col("next")).alias("terminal"), "cyclic")


def health(facts: DataFrame) -> DataFrame:
    """One row: live and superseded facts, share of certain tiers, exact duplicates, dormant subjects, slots with several live objects."""
    live = F.col("valid_to").isNull()
    copies = facts.groupBy(*TRIPLE, "since").agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") - 1).alias("copies"))
    slots = facts.where(live).groupBy("subject", "predicate").agg(F.countDistinct("object").alias("objects")).agg(F.count_if(F.col("objects") > 1).alias("contradictions"))
    dormant = facts.groupBy("subject").agg(F.count_if(live).alias("live")).agg(F.count_if(F.col("live") == 0).alias("dormant"))
    sums = facts.agg(F.count(F.lit(1)).alias("facts"), F.count_if(live).alias("live"), F.round(F.avg(F.when(F.col("tier") == "det", 1.0).otherwise(0.0)), 6).alias("det_share"))
    one = lambda df: df.withColumn("_one", F.lit(1))  # noqa: E731  four tables of one row
    joined = one(sums).join(one(copies), "_one").join(one(slots), "_one").join(one(dormant), "_one").drop("_one")
    return joined.withColumn("superseded", F.col("facts") - F.col("live"))
