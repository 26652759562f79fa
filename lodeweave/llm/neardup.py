"""Groups of near-equal records: pivot distance tables over set fingerprints.

Texts. A text is the set of its distinct three-word shingles (width and threshold
are parameters). Every set has a fingerprint: a bit string in which each shingle
sets one bit. The Hamming distance of two fingerprints is at most the size of the
symmetric difference of the sets, and similarity t bounds that difference by
(|A| + |B|) * (1 - t) / (1 + t). Distances from every fingerprint to a fixed number
of reference fingerprints are computed once; by the triangle inequality a pair
whose distances to any one reference differ by more than the bound cannot be alike
and is discarded (an exact test: no link is lost). Survivors are verified on the
shingle sets themselves.

The pairs that the table is asked about come from the rarest shingles: alike sets
share one among the |A| - ceil(t|A|) + 1 shingles of A that the fewest texts have.
Shingles that only one text has are never joined. A shingle of many texts does not
pair all of them: each is compared with the smallest id only, and a second look
takes just those texts which are not yet in one group. Equal sets are collapsed to
their smallest id before any pair is made.

Paths. Records of one path and size are one node (see paths). The fingerprint of a name
has a bit for each occurrence of each letter; a slip of the pen changes its Hamming
distance to any reference set of letters by one at most. The table of these distances
makes the candidates: a band join on three coordinates within equal directories, or
directories less one on one side; the largest difference of all twenty-one discards, and an
edit test word by word verifies.

Nulls: a null or short text, or a null id, is in no group; a null repo or path is in
no group; a null size agrees with any size. Extra columns are ignored. Empty tables
give no rows.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from lodeweave.operators.components import connected_components
from lodeweave.session import materialize, read

from .paths import SLIPS, by_directories, meeting, path_nodes, spelled_alike, under_directories
from .shingles import HASH_BITS, MASK, shingle_batches

WIDTH, THRESHOLD = 3, 0.5
BITS, PIVOTS = 1024, 70
LANES, TOP = 7, 63  # coordinates are kept in steps, from 0 to TOP, seven to a long
STEP = BITS // (TOP + 1)
DRAWN = 512  # texts among which the references are chosen
SAMPLED, LEAST_CROWD, CROWDED, SALTS = 64, 32, 10_000, 256  # one text in 64 is asked which shingles are crowded: no row depends on it
LIGHT = 48  # a shingle of so many texts at most pairs all of them
MOST = (1 << 63 - HASH_BITS) - 1  # a larger count has no room above a hash


def pivot_bound(threshold: float) -> float:
    return (1 - threshold) / (1 + threshold)


# ---- fingerprints and the distance table -----------------------------------------------------


def fingerprints(lists: pa.ListArray, bits: int = BITS) -> np.ndarray:
    """A (rows, bits) 0/1 matrix: each element of a list sets one bit."""
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), bits), dtype=np.float32)
    out[np.repeat(np.arange(len(sizes)), sizes), (values % np.uint64(bits)).astype(np.int64)] = 1
    return out


def spread_references(fp: np.ndarray, pivots: int) -> np.ndarray:
    """So many of the fingerprints that each lies far from those before it: the next is the one farthest from its nearest."""
    if len(fp) <= pivots:
        return fp
    chosen = [0]
    gap = np.abs(fp - fp[0]).sum(1)
    while len(chosen) < pivots:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, np.abs(fp - fp[chosen[-1]]).sum(1))
    return fp[chosen]


def distance_table(references: np.ndarray, pivots: int, bits: int = BITS):
    """mapInArrow body: adds p1, p2, ..., the distances to the references in steps of bits/64, seven of 8 bits in each."""
    step = bits // (TOP + 1)
    ref = references.astype(np.float32)
    ones = ref.sum(1)

    def run(batches):
        for batch in batches:
            fp = fingerprints(batch.column("hs"), bits)
            d = fp.sum(1)[:, None] + ones[None, :] - 2 * (fp @ ref.T)
            q = np.minimum(TOP, d // step).astype(np.int64)
            packed = np.zeros((len(pivot_columns(pivots)), len(q)), np.int64)
            for i in range(q.shape[1]):
                packed[i // LANES] |= q[:, i] << np.int64(8 * (i % LANES))
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, packed)], names=[*batch.schema.names, *pivot_columns(pivots)])

    return run


def pivot_columns(pivots: int) -> list[str]:
    return [f"p{i + 1}" for i in range(-(-pivots // LANES))]


def with_pivots(sets: DataFrame, order: str, bits: int = BITS, pivots: int = PIVOTS) -> DataFrame:
    """sets(..., hs) with its distance table; the references are spread out among DRAWN rows taken by hash."""
    if not pivots:
        return sets
    rows = sets.orderBy(F.xxhash64(order, F.lit(7)), order).limit(DRAWN).select(F.array_distinct(F.transform("hs", lambda h: F.pmod(h, F.lit(bits)))).alias("hs")).collect()  # DRAWN fingerprints
    fp = fingerprints(pa.array([r["hs"] for r in rows], pa.list_(pa.int64())), bits) if rows else np.zeros((1, bits), np.float32)
    schema = T.StructType([*sets.schema.fields, *[T.StructField(c, T.LongType()) for c in pivot_columns(pivots)]])
    return sets.mapInArrow(distance_table(spread_references(fp, pivots), pivots, bits), schema)


def each_lane(value: int) -> int:
    return sum(value << 8 * i for i in range(LANES))


def pivots_allow(a: str, b: str, bound: Column, pivots: int, step: int = STEP) -> Column:
    """True unless some coordinate of the distance table differs by more than the bound (and by what rounding to steps may hide).

    Seven coordinates are compared at once: a lane of (x + bound + 128) - y keeps its highest bit exactly when y is not above
    x by more than the bound, and no lane borrows from the next.
    """
    if not pivots:
        return F.lit(True)
    reach = F.least(F.lit(TOP), F.floor(bound / step) + (1 if step > 1 else 0)).cast("bigint") * F.lit(each_lane(1))
    high = F.lit(each_lane(128))
    over = lambda x, y: ((x + reach).bitwiseOR(high) - y).bitwiseAND(high) == high
    out = F.lit(True)
    for p in pivot_columns(pivots):
        x, y = F.col(f"{a}.{p}"), F.col(f"{b}.{p}")
        out = out & over(x, y) & over(y, x)
    return out


# ---- texts -----------------------------------------------------------------------------------


def text_links(texts: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, light: int | None = None, check=None, pivots: int = PIVOTS) -> DataFrame:
    """texts(id bigint, text string) -> links (a, b) that join every pair of alike texts into one group.

    Every alike pair of different shingle sets is either a row or joined by rows; equal sets
    are linked to their smallest id. `check(pairs, table, threshold)` keeps the alike pairs
    of the candidates; without pivots no table is made.
    """
    light_texts, check = light or LIGHT, check or partial(verify, pivots=pivots)
    sets = texts.where("id is not null and text is not null and length(text) > 0").mapInArrow(
        shingle_batches(width), "id bigint, n int, hs array<bigint>"
    )
    sampled = texts.where(F.pmod(F.xxhash64("id", F.lit(13)), F.lit(SAMPLED)) == 0)
    crowded = crowded_shingles(sampled.where("length(text) > 0").mapInArrow(shingle_batches(width), "id bigint, n int, hs array<bigint>"))
    least = F.ceil(F.col("n") * F.lit(threshold))
    docs = (
        shared_shingles(sets, crowded).groupBy("id")
        .agg(F.max("n").alias("n"), F.sort_array(F.collect_list("h")).alias("hs"))
        .where(F.size("hs") >= least)
    )
    docs = materialize(docs, "sets")
    # equal sets: all shingles shared and the same ones
    whole = docs.where("size(hs) = n").select("id", F.xxhash64("n", "hs").alias("k1"), F.hash("n", "hs").alias("k2"))
    copies = (
        whole.join(whole.groupBy("k1", "k2").agg(F.min("id").alias("a")), ["k1", "k2"])
        .where("a < id").select("a", F.col("id").alias("b"))
    )
    copies = materialize(copies, "copies")
    table = with_pivots(docs.join(copies.select(F.col("b").alias("id")), "id", "left_anti"), "id", pivots=pivots)
    table = materialize(table, "pivots")

    # prefix: the rarest n - ceil(tn) + 1, of which n - size(hs) are shingles nobody else has
    keep = (F.col("n") - least + 1 - (F.col("n") - F.size("hs"))).cast("int")
    prefix = table.select("id", "n", F.explode(F.slice("hs", F.lit(1), keep)).alias("h")).withColumn("c", F.shiftright("h", HASH_BITS))
    light, hot = prefix.where(F.col("c") <= light_texts), prefix.where(F.col("c") > light_texts)
    # a pair meets in many shingles: it is told once, and then the table is asked about it
    sizes = F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * F.lit(threshold)
    near = (
        light.alias("x").join(light.alias("y"), F.col("x.h") == F.col("y.h"))
        .where((F.col("x.id") < F.col("y.id")) & sizes)
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    )
    star = hot.groupBy("h").agg(F.min("id").alias("a")).join(hot.select("h", F.col("id").alias("b")), "h").where("a < b").select("a", "b")
    found = materialize(check(near.unionByName(star).distinct(), table, threshold), "links")
    if not hot.isEmpty():
        found = found.unionByName(hot_links(hot, found, table, threshold, check))
    return copies.unionByName(found)


def shared_shingles(sets: DataFrame, crowded: DataFrame) -> DataFrame:
    """sets(id, n, hs) -> (id, n, h): the shingles that other texts have too, each as one ranked number."""
    each = sets.where("n > 0").select("id", "n", F.explode("hs").alias("h")).join(F.broadcast(crowded), "h", "left")
    # the rows of a crowded shingle are dealt to many tasks, by a salt above the bits of its hash; one number to sort by is sorted fastest
    salt = F.when(F.col("much").isNotNull(), F.pmod(F.xxhash64("id"), F.lit(SALTS)) + 1).otherwise(F.lit(0).cast("bigint"))
    dealt = each.select("id", "n", F.shiftleft(salt, HASH_BITS).bitwiseOR(F.col("h")).alias("k"))
    counted = dealt.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("k"))).where(f"c > 1 or k >= {1 << HASH_BITS}")
    # its count from the sample is as good an order as any
    shared = counted.withColumn("h", F.col("k").bitwiseAND(F.lit(int(MASK)))).join(F.broadcast(crowded), "h", "left")
    return shared.select("id", "n", ranked(F.coalesce("much", "c"), F.col("h")).alias("h"))


def ranked(count: Column, h: Column) -> Column:
    """A shingle as one number: its count above the bits of its hash, so that numbers in order are shingles from the rarest on.

    A count beyond MOST is as MOST: those shingles are put in order by their hash, which is an order too.
    """
    return F.shiftleft(F.least(count, F.lit(MOST)), HASH_BITS).bitwiseOR(h)


def crowded_shingles(sets: DataFrame) -> DataFrame:
    """(h, much): the CROWDED most frequent shingles of a sample with their counts, scaled up; the others hold at most one row in CROWDED each."""
    counts = sets.select(F.explode("hs").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= LEAST_CROWD)
    return counts.orderBy(F.desc("c"), "h").limit(CROWDED).select("h", (F.col("c") * SAMPLED).alias("much"))


def verify(pairs: DataFrame, table: DataFrame, threshold: float, pivots: int = PIVOTS) -> DataFrame:
    """Pairs (a, b) whose sets have similarity of at least the threshold; the pivot table is asked first."""
    x, y = table.alias("x"), table.alias("y")
    bound = (F.col("x.n") + F.col("y.n")) * F.lit(pivot_bound(threshold))
    meet = F.size(F.array_intersect("x.hs", "y.hs"))
    return (
        pairs.join(x, F.col("a") == F.col("x.id"))
        .join(y, F.col("b") == F.col("y.id"))
        .where(pivots_allow("x", "y", bound, pivots))
        .select("a", "b", meet.alias("meet"), (F.col("x.n") + F.col("y.n")).alias("nn"))
        .where(F.col("meet") >= F.lit(threshold) * (F.col("nn") - F.col("meet")))
        .select("a", "b")
    )


def hot_links(hot: DataFrame, found: DataFrame, table: DataFrame, threshold: float, check=verify) -> DataFrame:
    """Second look at shingles of many texts: only members of different groups are still compared."""
    comps = connected_components(found)
    marked = hot.join(comps.select(F.col("node").alias("id"), "root"), "id", "left").withColumn("g", F.coalesce("root", "id"))
    mixed = marked.groupBy("h").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo < hi").select("h")
    left = marked.join(mixed, "h").select("id", "n", "h", "g")
    sizes = F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * F.lit(threshold)
    pairs = (
        left.alias("x").join(left.alias("y"), F.col("x.h") == F.col("y.h"))
        .where((F.col("x.id") < F.col("y.id")) & (F.col("x.g") != F.col("y.g")) & sizes)
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    )
    return check(pairs, table, threshold)


# ---- paths -----------------------------------------------------------------------------------

ALPHABET = "abcdefghijklmnopqrstuvwxyz"
REFERENCES = 21  # of names: reference j holds the letters whose number meets j in an odd number of bits
BAND, BANDED = 4, 3  # width of a band, and how many coordinates are cut into bands


def reference_letters(j: int) -> str:
    return "".join(c for n, c in enumerate(ALPHABET, 1) if (n & j).bit_count() % 2)


def name_coordinate(letters: Column, j: int) -> Column:
    """Hamming distance of the letters of a name (each occurrence a bit) to reference j, but for a constant: others less its letters."""
    others = F.length(F.translate(letters, reference_letters(j), ""))
    return 2 * others - F.length(letters)


def name_table(nodes: DataFrame) -> DataFrame:
    """Adds p1 to p3, the distances of a name to all references, and c1 to c3, those cut into bands."""
    middle = (TOP + 1) // 2
    lane = lambda j: F.greatest(F.lit(0), F.least(F.lit(TOP), name_coordinate(F.col("letters"), j) + middle)).cast("bigint")
    packed = lambda js: sum((F.shiftleft(lane(j), 8 * i) for i, j in enumerate(js)), F.lit(0).cast("bigint"))
    columns = pivot_columns(REFERENCES)
    return nodes.select(
        "*", *[packed(range(LANES * i + 1, LANES * (i + 1) + 1)).alias(c) for i, c in enumerate(columns)],
        *[name_coordinate(F.col("letters"), 1 << n).alias(f"c{n + 1}") for n in range(BANDED)],
    )


def path_links(files: DataFrame) -> DataFrame:
    """file_records -> links (a, b) that join all records of one file of one repo into a group.

    Candidates are a band join on the pivot table: a slip changes a distance by one at most, so names of two slips lie
    within two of one another in every coordinate. Three coordinates are cut into bands (a name on the left is offered to
    the bands it can reach, exact at any length), the others discard, and the spelling test verifies.
    """
    nodes, inside = path_nodes(files, "abspath")
    named = name_table(nodes).drop("letters")
    bands = [f"c{n + 1}" for n in range(BANDED)]
    low = lambda c, d: F.floor((F.col(c) + d) / BAND)
    left = under_directories(named)
    for c in bands:
        left = left.withColumn(c, F.explode(F.sequence(low(c, -SLIPS), low(c, SLIPS))))
    right = by_directories(named).select("*", *[low(c, 0).alias(f"b{c}") for c in bands])
    left = left.withColumn("k", F.xxhash64("at", *bands)).drop("at", *bands)
    right = right.withColumn("k", F.xxhash64("at", *[f"b{c}" for c in bands])).drop("at", *bands, *[f"b{c}" for c in bands])
    pairs = meeting(left, right, pivots_allow("x", "y", F.lit(SLIPS), REFERENCES, step=1))
    return inside.unionByName(spelled_alike(pairs))


# ---- groups ----------------------------------------------------------------------------------


def groups(links: DataFrame) -> DataFrame:
    return connected_components(links).select(F.col("root").alias("rep_id"), F.col("node").alias("member_id"))


def near_duplicates(samples: DataFrame, files: DataFrame) -> DataFrame:
    """(src_table, rep_id, member_id): one row for each member of a group but its smallest id."""
    texts = text_links(samples.select(F.col("sample_id").alias("id"), "text"))
    return groups(texts).withColumn("src_table", F.lit("samples")).unionByName(
        groups(path_links(files)).withColumn("src_table", F.lit("file_records"))
    ).select("src_table", "rep_id", "member_id")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(
        read(spark, sf_dir, "samples", "sample_id", "text"),
        read(spark, sf_dir, "file_records", "file_id", "repo", "abspath", "size_bytes"),
    )
