"""Tracked files under one spelling: canonical paths, runs of sizes, the spelling test. Shared by the joins on paths.

A path is reduced to repo, directories below the checkout root, name letters, digits and
extension, without case, slashes' direction, "-", "_" and blanks. Records of one path whose
sizes lie within the tolerance form a run (sorted neighbours, not pairs) and become one
node; a missing size joins the whole path. Sizes of one path that are not in one run are
more than the tolerance apart, so a path has a few hundred nodes at most, however many
records it has. Two nodes are one file when repo, extension and digits are equal, sizes
agree, the directories are the same in any order or one side has one directory more, and
the names are one another's spelling. Directories that differ otherwise are unlike: files
of equal name in them are different files.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lodeweave.session import materialize

# directories under a checkout that hold further checkouts, one level below them (fixed values)
NESTED = r"^(?:(?:\.?worktrees|\.trees|tmp/wt)/[^/]+/)+"
SIZE_TOLERANCE = 0.03
SLIPS = 2  # that a name may have


def clean_slashes(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, r"\\", "/"), r"/(\./)+|/+", "/")


def canonical_paths(files: DataFrame, column: str) -> DataFrame:
    """file_records -> (id, repo, size, dirs, name, stem, key, digits, ext) of abspath or relpath, in one spelling.

    An absolute path is cut behind the first directory pair that is the repo's name; where it has none, it counts whole.
    """
    p = clean_slashes(F.col(column))
    at = F.instr(F.lower(p), F.concat(F.lit("/"), F.lower("repo"), F.lit("/")))
    whole = F.regexp_replace(p, r"^(?:[A-Za-z]:)?/", "")
    below = F.when(at > 0, F.substring(p, at + F.length("repo") + 2, F.length(p))).otherwise(whole) if column == "abspath" else whole
    below = F.regexp_replace(F.regexp_replace(below, r"^(\./)+", ""), NESTED, "")
    d = (
        files.where(F.col("file_id").isNotNull() & F.col("repo").isNotNull() & (F.length(column) > 0))
        .select(F.col("file_id").alias("id"), "repo", F.col("size_bytes").alias("size"), below.alias("below"))
        .withColumn("name", F.element_at(F.split("below", "/"), -1))
        .withColumn("dirs", F.expr("transform(filter(slice(split(below, '/'), 1, size(split(below, '/')) - 1), x -> x <> ''), x -> regexp_replace(lower(x), '[-_ ]', ''))"))
        .withColumn("ext", F.lower(F.regexp_extract("name", r"[^.]\.([^.]+)$", 1)))
        .withColumn("stem", F.when(F.col("ext") != "", F.expr("substring(name, 1, length(name) - length(ext) - 1)")).otherwise(F.col("name")))
        .withColumn("digits", F.regexp_replace(F.regexp_replace("stem", r"[^0-9]+", " "), r"^ | $", ""))
        .withColumn("key", F.regexp_replace(F.lower("stem"), r"[^\p{L}\p{N}.]", ""))
    )
    return d.select("id", "repo", "size", "dirs", "name", "stem", "key", "digits", "ext")


# ---- spelling --------------------------------------------------------------------------------


def split_words(stem: str) -> list[str]:
    return [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[^\W_a-zA-Z]+", stem)]


def slip(a: str, b: str) -> int:
    """0 equal, 1 one letter doubled, dropped or swapped with its neighbour, 2 anything else."""
    if a == b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return 1 if i + 1 < len(a) and a[i] == b[i + 1] and a[i + 1] == b[i] and a[i + 2 :] == b[i + 2 :] else 2
    return 1 if len(b) == len(a) + 1 and a[i:] == b[i + 1 :] else 2


def same_name(a: str, b: str, ka: str, kb: str, slips=slip) -> bool:
    """Names are one another's spelling: letters equal but for one slip, or one slip a word and two at most."""
    if ka == kb:
        return True
    if min(len(ka), len(kb)) < 4:
        return False
    if slips(ka, kb) < 2:
        return True
    wa, wb = split_words(a), split_words(b)
    each = [slips(x, y) for x, y in zip(wa, wb)]
    return len(wa) == len(wb) and max(each, default=2) < 2 and sum(each) <= SLIPS


# ---- nodes -----------------------------------------------------------------------------------


def path_nodes(files: DataFrame, column: str, tolerance: float = SIZE_TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """(nodes, links inside them): nodes(id, lo, hi, open, stem, key, letters, base, bag), links (a, b) to the smallest id of a node."""
    paths = canonical_paths(files, column)
    place = ["repo", "ext", "digits", "key", "dirs"]
    rows = paths.select("id", "size", F.xxhash64("repo", "ext", "digits", "key", F.concat_ws("/", "dirs")).alias("p"), *place, "stem")
    w = Window.partitionBy("p").orderBy("size", "id")
    back = F.lag("size").over(w)
    starts = F.when(back.isNull() | (F.col("size") - back > F.col("size") * tolerance), 1).otherwise(0)
    any_null = F.max(F.when(F.col("size").isNull(), 1).otherwise(0)).over(Window.partitionBy("p"))
    runs = rows.withColumn("open", any_null).withColumn("s", F.when(F.col("open") == 1, 0).otherwise(starts))
    runs = runs.withColumn("run", F.sum("s").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = materialize(runs.select("id", "p", "run", "open", "size", *place, "stem"), "paths")
    nodes = runs.groupBy("p", "run").agg(
        F.min("id").alias("id"), F.max("open").alias("open"), F.min("size").alias("lo"), F.max("size").alias("hi"),
        *[F.first(c).alias(c) for c in place], F.min("stem").alias("stem"),
    )
    inside = runs.select("p", "run", F.col("id").alias("b")).join(nodes.select("p", "run", F.col("id").alias("a")), ["p", "run"]).where("a < b").select("a", "b")
    nodes = nodes.select(
        "id", "lo", "hi", "open", "stem", "key", F.regexp_replace("key", r"\.", "").alias("letters"),
        F.xxhash64("repo", "ext", "digits").alias("base"), F.sort_array("dirs").alias("bag"),
    )
    return nodes, inside


def by_directories(nodes: DataFrame) -> DataFrame:
    """Each node under its directories (less = false), and under them less one (less = true), as a hash `at`."""
    each = "transform(sequence(0, size(bag)), i -> struct(concat_ws('/', filter(bag, (x, j) -> j <> i)) as at, i < size(bag) as less))"
    return (
        nodes.withColumn("d", F.explode(F.array_distinct(F.expr(each))))
        .withColumn("at", F.xxhash64("base", "d.at")).withColumn("less", F.col("d.less")).drop("d", "bag", "base")
    )


def under_directories(nodes: DataFrame) -> DataFrame:
    """The rows of by_directories with less = false alone."""
    return nodes.withColumn("at", F.xxhash64("base", F.concat_ws("/", "bag"))).withColumn("less", F.lit(False)).drop("bag", "base")


def meeting(left: DataFrame, right: DataFrame, also: Column | None = None, tolerance: float = SIZE_TOLERANCE) -> DataFrame:
    """Candidates (a, b, sa, sb, ka, kb) of equal k with agreeing sizes: whole directories on the left, whole or less one on the right."""
    x, y = left.alias("x"), right.alias("y")
    gap = F.greatest(F.col("x.lo"), F.col("y.lo")) - F.least(F.col("x.hi"), F.col("y.hi"))
    sized = (F.col("x.open") == 1) | (F.col("y.open") == 1) | (gap <= F.greatest(F.col("x.lo"), F.col("y.lo")) * tolerance)
    once = F.col("y.less") | (F.col("x.id") < F.col("y.id"))
    pairs = x.join(y, F.col("x.k") == F.col("y.k")).where((F.col("x.id") != F.col("y.id")) & once & sized & (F.lit(True) if also is None else also))
    first = F.col("x.id") < F.col("y.id")
    lesser = lambda c: F.when(first, F.col(f"x.{c}")).otherwise(F.col(f"y.{c}"))
    greater = lambda c: F.when(first, F.col(f"y.{c}")).otherwise(F.col(f"x.{c}"))
    return pairs.select(
        lesser("id").alias("a"), greater("id").alias("b"), lesser("stem").alias("sa"), greater("stem").alias("sb"), lesser("key").alias("ka"), greater("key").alias("kb"),
    ).distinct()


def spelled_alike(pairs: DataFrame, slips=slip) -> DataFrame:
    """The candidates whose names are one another's spelling, as links (a, b)."""

    def run(batches):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("sa", "sb", "ka", "kb")]
            keep = pa.array([same_name(*row, slips=slips) for row in zip(*cols)], pa.bool_())
            yield batch.filter(keep).select(["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")
