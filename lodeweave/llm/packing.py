"""Texts into containers of fixed capacity, by minimum bin slack.

Texts are measured in tokens of a public tokenizer. A text longer than the capacity
fills whole containers by itself and only its rest is packed with others; no other
text is cut. The rests and the short texts are dealt by hash into blocks of at most
BLOCK pieces in the mean, and a task packs one block: per container, the longest
piece left is the seed, and a bitset of reachable sums over the lengths still
available finds the fullest combination for the space that remains; its pieces are
taken away. A block wastes at most one container's worth more than packing all at
once, and it bounds what a task holds, whatever the table or a hot key.

Null and empty texts have no tokens and no row; null ids are skipped; of rows that
repeat an id the longest text counts; a null or non-positive capacity is skipped,
repeated profiles count once. Other columns are ignored.
"""

from __future__ import annotations

import base64
import os

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodeweave.session import materialize, read

VOCABULARY = os.environ.get("LODEWEAVE_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# fixed value: the word pattern that belongs to this vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK = 8192
MAX_PROFILES = 1000


def token_counts(texts: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """texts(id bigint, text) -> (id, tokens)."""

    def run(batches):
        import tiktoken

        with open(vocabulary, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        encode = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for batch in batches:
            n = pa.array([len(encode(t)) for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n], names=["id", "tokens"])

    return texts.where("id is not null and length(text) > 0").select("id", "text").mapInArrow(run, "id bigint, tokens bigint")


def fullest(lengths: list[int], counts: list[int], space: int) -> list[int]:
    """Indices (with repeats) of lengths whose sum is the largest that fits the space; lengths fall."""
    reach = [1]  # bit s of reach[k]: the first k lengths can sum to s
    used: list[int] = []
    limit = (1 << (space + 1)) - 1
    full = 1 << space
    for i, length in enumerate(lengths):
        if length > space or not counts[i]:
            continue
        bits, taken = reach[-1], 0
        most = min(counts[i], space // length)
        while taken < most and not bits & full:
            more = (bits | bits << length) & limit
            if more == bits:
                break
            reach.append(more)
            used.append(i)
            bits, taken = more, taken + 1
        if bits & full:
            break
    total = reach[-1].bit_length() - 1
    out = []
    for k in range(len(used), 0, -1):
        if not reach[k - 1] >> total & 1:
            out.append(used[k - 1])
            total -= lengths[used[k - 1]]
    return out


def pack(lengths: list[int], capacity: int) -> list[list[int]]:
    """Containers as lists of item numbers, each within the capacity; every item is in exactly one."""
    items: dict[int, list[int]] = {}
    for number in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i), reverse=True):
        items.setdefault(lengths[number], []).append(number)
    distinct = sorted(items, reverse=True)
    counts = [len(items[d]) for d in distinct]
    bins = []
    top = 0
    while top < len(distinct):
        if not counts[top]:
            top += 1
            continue
        counts[top] -= 1
        chosen = [items[distinct[top]].pop()]
        for i in fullest(distinct, counts, capacity - distinct[top]):
            counts[i] -= 1
            chosen.append(items[distinct[i]].pop())
        bins.append(chosen)
        if len(bins) % 64 == 0:  # drop lengths that are used up
            live = [k for k in range(len(distinct)) if counts[k]]
            distinct, counts, top = [distinct[k] for k in live], [counts[k] for k in live], 0
    return bins


def _pack_block(table: pa.Table) -> pa.Table:
    capacity = table.column("capacity")[0].as_py()
    order = sorted(range(table.num_rows), key=lambda i: (table.column("id")[i].as_py(), table.column("piece")[i].as_py()))
    table = table.take(pa.array(order, pa.int64()))
    bins = pack(table.column("size").to_pylist(), capacity)
    where = [0] * table.num_rows
    for number, chosen in enumerate(bins):
        for i in chosen:
            where[i] = number
    block = table.column("block")[0].as_py()
    container = pa.array([f"b{block}-{w}" for w in where], pa.string())
    return pa.table([table.column(c) for c in ("profile", "id", "piece", "start", "size")] + [container], names=["profile", "id", "piece", "start", "size", "container"])


def pack_texts(counts: DataFrame, profiles: DataFrame, block: int = BLOCK) -> DataFrame:
    """(id, tokens) and (profile, capacity_tokens) -> (profile, id, piece, start, size, container).

    start and size are in tokens of the text; containers are named within a profile.
    """
    sizes = materialize(counts.where("id is not null and tokens > 0").groupBy("id").agg(F.max("tokens").alias("tokens")), "tokens")
    # a fixed table of a few rows: the profiles are part of the plan, and more than MAX_PROFILES are refused
    wanted = profiles.where("profile is not null and capacity_tokens > 0").groupBy("profile").agg(F.max("capacity_tokens").cast("bigint").alias("capacity")).limit(MAX_PROFILES + 1).collect()
    if len(wanted) > MAX_PROFILES:
        raise ValueError(f"more than {MAX_PROFILES} profiles")
    plan = F.array(*[F.struct(F.lit(r["profile"]).alias("profile"), F.lit(r["capacity"]).cast("bigint").alias("capacity")) for r in sorted(wanted)]) if wanted else F.array().cast("array<struct<profile: string, capacity: bigint>>")
    pieces = sizes.withColumn("p", F.explode(plan)).select("id", "tokens", "p.profile", "p.capacity")
    whole = (
        pieces.where("tokens >= capacity")
        .select("profile", "id", "capacity", F.explode(F.sequence(F.lit(0), (F.col("tokens") / F.col("capacity")).cast("int") - 1)).alias("piece"))
        .select("profile", "id", "piece", (F.col("piece") * F.col("capacity")).cast("bigint").alias("start"), F.col("capacity").alias("size"), F.concat(F.lit("w"), "id", F.lit("-"), "piece").alias("container"))
    )
    rest = pieces.where("tokens % capacity > 0").select(
        "profile", "capacity", "id", F.expr("cast(tokens div capacity as int)").alias("piece"), F.expr("cast(tokens div capacity * capacity as bigint)").alias("start"), F.expr("tokens % capacity").alias("size")
    )
    blocks = max(1, -(-sizes.count() // block))
    rest = rest.withColumn("block", F.pmod(F.xxhash64("id", F.lit(11)), F.lit(blocks)).cast("int"))
    packed = rest.groupBy("profile", "block").applyInArrow(_pack_block, "profile string, id bigint, piece int, start bigint, size bigint, container string")
    return whole.unionByName(packed)


def fill(assignment: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per profile: containers, tokens, and the share of the space that is used."""
    bins = assignment.groupBy("profile", "container").agg(F.sum("size").alias("used"))
    return (
        bins.join(F.broadcast(profiles.select("profile", "capacity_tokens")), "profile")
        .groupBy("profile", "capacity_tokens")
        .agg(F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"))
        .withColumn("used_share", F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))
    )


def p6_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(read(spark, sf_dir, "documents", "doc_id", "text").withColumnRenamed("doc_id", "id"))
    return pack_texts(counts, read(spark, sf_dir, "pack_profiles")).withColumnRenamed("id", "doc_id")


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill(p6_assignment(spark, sf_dir), read(spark, sf_dir, "pack_profiles"))
