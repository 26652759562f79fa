"""The same or nearly the same record in training and evaluation splits: edit-distance segment join.

The segments of a string are its distinct runs of three words, at every position. A
similarity of one half leaves one of any k + 1 of its n segments whole in the other
string, k = n - ceil(n / 2), whatever the edits are and wherever they stand. So of every
string the k + 1 rarest segments are looked up among those of the others, and pairs
whose numbers of segments differ by more than half are passed over (both exact; longer
segments, positions and numbers of words prove nothing about sets of runs). Candidates
are verified by dynamic programming within a band of k diagonals, k = n // 9, which
proves the likeness, and where the band is too narrow by the runs themselves.

Likeness is passed on, so every string is cut and not the evaluation strings alone:
the chain from one to the other may lead through training records. Equal sets of
segments are linked first. A segment of many strings is matched with one of them
first, and again only between groups that are still apart.

Paths are relpaths of one repo, extension and digits. The letters of a name are cut into
k + 1 segments for k = 2 slips, and a segment meets its like under equal directories, or
directories less one on one side. Dynamic programming in a band of one diagonal verifies
the whole name or its words.

Nulls, empty and short texts are as in the groups of near-equal records; a null split
makes a record neither train nor evaluation. Extra columns are ignored, empty tables
give no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodeweave.operators.components import connected_components
from lodeweave.session import materialize, read

from .neardup import LIGHT, text_links
from .paths import SLIPS, by_directories, meeting, path_nodes, spelled_alike, under_directories
from .shingles import WORD

EDIT_SHARE = 9
BROADCAST_PAIRS = 200_000  # so many ids are a few MB


# ---- verification ----------------------------------------------------------------------------


def edits_within(a: list, b: list, k: int) -> int | None:
    """Edit distance of two sequences if it is at most k: furthest points on the diagonals of the band."""
    start, n, m = 0, len(a), len(b)
    while n and m and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    while start < n and start < m and a[start] == b[start]:
        start += 1
    a, b = a[start:n], b[start:m]
    n, m = len(a), len(b)
    if abs(n - m) > k:
        return None
    goal = m - n
    far = {0: 0}
    for e in range(k + 1):
        new = {}
        for d in range(-e, e + 1):
            if e == 0:
                i = 0
            else:
                i = max(far.get(d - 1, -2), far.get(d, -2) + 1, far.get(d + 1, -2) + 1)
                if i < 0:
                    continue
                i = min(i, n, m - d)
            while i < n and i + d < m and i >= 0 and i + d >= 0 and a[i] == b[i + d]:
                i += 1
            new[d] = i
        far = new
        if far.get(goal, -1) >= n:
            return e
    return None


def alike(a: list[str], b: list[str], threshold: float = 0.5, width: int = 3) -> bool:
    """Similarity of the distinct runs of words: proved by the band where it reaches, counted elsewhere."""
    if min(len(a), len(b)) < width:
        return False
    runs = set(zip(*(a[i:] for i in range(width))))
    if edits_within(a, b, len(runs) // EDIT_SHARE) is not None:
        return True
    other = set(zip(*(b[i:] for i in range(width))))
    return len(runs & other) >= threshold * len(runs | other)


def _verify_batches(batches):
    for batch in batches:
        keep, words = [], {}
        for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "x", "y"))):
            for key, text in ((a, x), (b, y)):
                if key not in words:
                    words[key] = WORD.findall(text.lower())
            keep.append(alike(words[a], words[b]))
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Alike pairs among (a, b). Where the pairs are few, only their texts are shuffled: the ids are handed to every task."""
    pairs = materialize(pairs, "candidates")
    if pairs.count() <= BROADCAST_PAIRS:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        texts = texts.join(F.broadcast(ids), "id", "left_semi")
    x = texts.select(F.col("id").alias("a"), F.col("text").alias("x"))
    y = texts.select(F.col("id").alias("b"), F.col("text").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verify_batches, "a bigint, b bigint")


# ---- paths -----------------------------------------------------------------------------------


def banded_slips(a: str, b: str, k: int = 1) -> int:
    """Letters dropped, doubled or swapped with the next between two names, k + 1 where more than k: dynamic programming in a band."""
    if abs(len(a) - len(b)) > k:
        return k + 1
    far = k + 1
    before: list[int] = []
    row = [j if j <= k else far for j in range(len(b) + 1)]
    for i in range(1, len(a) + 1):
        new = [far] * (len(b) + 1)
        if i <= k:
            new[0] = i
        for j in range(max(1, i - k), min(len(b), i + k) + 1):
            if a[i - 1] == b[j - 1]:
                new[j] = row[j - 1]
            else:
                new[j] = min(row[j], new[j - 1]) + 1
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    new[j] = min(new[j], before[j - 2] + 1)
        before, row = row, new
    return min(row[-1], far)


def name_segments(letters: str) -> Column:
    """The letters in order, cut into one segment more than a name may have slips; numbered, for a segment meets its like alone.

    Cuts fall between letters and not between places: a swap leaves the ordered letters as they are, and a dropped or doubled
    letter is one edit of one segment, so two names with two slips have a segment whole in both, at its own number.
    """
    return F.expr(
        f"transform(array(sort_array(split({letters}, ''))), cs -> transform(sequence(0, {SLIPS}), s -> concat(s, array_join("
        f"filter(cs, x -> x <> '' and pmod(ascii(x), {SLIPS + 1}) = s), ''))))[0]"
    )


def path_segments(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes by segment (k): under their directories, and under those or those less one. A name is cut once, and not under each directory."""
    cut = nodes.withColumn("segments", name_segments("letters")).drop("letters")
    keyed = lambda rows: rows.withColumn("k", F.explode(F.transform("segments", lambda s: F.xxhash64("at", s)))).drop("at", "segments")
    return keyed(under_directories(cut)), keyed(by_directories(cut))


def path_segment_links(files: DataFrame) -> DataFrame:
    """file_records -> links (a, b) of records whose relpaths name one file of one repo: segment join, banded verification."""
    nodes, inside = path_nodes(files, "relpath")
    pairs = meeting(*path_segments(nodes))
    return inside.unionByName(spelled_alike(pairs, banded_slips))


# ---- join ------------------------------------------------------------------------------------


def segment_links(texts: DataFrame) -> DataFrame:
    """texts(id, text) -> links (a, b) that join all alike texts into groups."""
    texts = texts.where("id is not null and length(text) > 0").select("id", "text")
    return text_links(texts, light=LIGHT, check=lambda pairs, table, threshold: verify(pairs, texts), pivots=0)


def cross_pairs(links: DataFrame, records: DataFrame) -> DataFrame:
    """links and records(id, split) -> (id_a, id_b), id_a < id_b: one of train and one of val or test in one group."""
    comps = connected_components(links)
    members = comps.select("root", F.col("node").alias("id")).unionByName(comps.select("root", F.col("root").alias("id")).distinct())
    sided = members.join(records.select("id", "split"), "id").where(F.col("split").isin("train", "val", "test"))
    train, held = sided.where("split = 'train'"), sided.where("split <> 'train'")
    return (
        train.alias("t").join(held.alias("e"), F.col("t.root") == F.col("e.root"))
        .select(F.least("t.id", "e.id").alias("id_a"), F.greatest("t.id", "e.id").alias("id_b"))
        .distinct()
    )


def overlaps(samples: DataFrame, files: DataFrame) -> DataFrame:
    texts = samples.select(F.col("sample_id").alias("id"), "text")
    return cross_pairs(segment_links(texts), samples.withColumnRenamed("sample_id", "id")).withColumn("src_table", F.lit("samples")).unionByName(
        cross_pairs(path_segment_links(files), files.withColumnRenamed("file_id", "id")).withColumn("src_table", F.lit("file_records"))
    ).select("src_table", "id_a", "id_b")


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (
        read(spark, sf_dir, "samples", "sample_id", "split", "source", "text"),
        read(spark, sf_dir, "file_records", "file_id", "repo", "relpath", "size_bytes", "split"),
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(*_tables(spark, sf_dir))


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps per table, evaluation split and source: pairs, and evaluation records concerned."""
    samples, files = _tables(spark, sf_dir)
    found = materialize(overlaps(samples, files), "pairs")
    known = samples.select(F.lit("samples").alias("src_table"), F.col("sample_id").alias("id"), "split", "source").unionByName(
        files.select(F.lit("file_records").alias("src_table"), F.col("file_id").alias("id"), "split", F.col("repo").alias("source"))
    ).where("split in ('val', 'test')")
    either = found.select("src_table", F.explode(F.array("id_a", "id_b")).alias("id"))
    return either.join(known, ["src_table", "id"]).groupBy("src_table", "split", "source").agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("id").alias("records"))
