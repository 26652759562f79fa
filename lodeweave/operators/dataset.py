"""Dataset building: path filters, exact dedup, hash split, sample formats, quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodeweave.functions.globs import any_of
from lodeweave.functions.text import hash_fraction, hash_int, line_count


def extension(path: Column) -> Column:
    """Lower-case suffix without the dot; names that only begin with a dot have none."""
    return F.lower(F.regexp_extract(path, r"[^/.][^/]*\.([^./]+)$", 1))


def keep_files(
    files: DataFrame, min_bytes: int = 1, max_bytes: int = 1 << 20, allow: list[str] | None = None, deny: list[str] | None = None,
    include: list[str] | None = None, exclude: list[str] | None = None,
) -> DataFrame:
    """Size bounds inclusive, extension allow and deny lists (deny wins), include and exclude globs (exclude wins)."""
    norm = lambda xs: sorted({x.strip().lower().lstrip(".") for x in xs})
    out = files.where(F.col("size_bytes").between(min_bytes, max_bytes))
    ext = extension(F.col("relpath"))
    if deny:
        out = out.where(~ext.isin(norm(deny)))
    if allow:
        out = out.where(ext.isin(norm(allow)))
    if include:
        out = out.where(F.col("relpath").rlike(any_of(include)))
    if exclude:
        out = out.where(~F.col("relpath").rlike(any_of(exclude)))
    return out


def first_of_content(rows: DataFrame, content: str, order: str) -> DataFrame:
    """Exact-content dedup: the first row in order for each SHA-256; null content is kept as it is."""
    digest = F.sha2(F.col(content).cast("binary"), 256)
    w = Window.partitionBy("_digest").orderBy(order)
    known = rows.where(F.col(content).isNotNull()).withColumn("_digest", digest).withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank", "_digest")
    return known.unionByName(rows.where(F.col(content).isNull()))


def split_of(path: Column, salt: Column, weights: dict[str, float]) -> Column:
    """Split by the hash of salt and path against cumulative weights, so adding files never moves others."""
    if any(w < 0 for w in weights.values()) or abs(sum(weights.values()) - 1) > 1e-9:
        raise ValueError("weights must be non-negative and sum to 1")
    x, out, edge = hash_fraction(F.concat(salt, F.lit(":"), path)), None, 0.0
    names = list(weights)
    for name in names[:-1]:
        edge += weights[name]
        out = F.when(x < edge, name) if out is None else out.when(x < edge, name)
    return F.lit(names[-1]) if out is None else out.otherwise(names[-1])


def document_sample(repo: Column, path: Column, content: Column) -> Column:
    return F.concat(F.lit("<|repo_name|>"), repo, F.lit("\n<|file_sep|>"), path, F.lit("\n"), content)


def fim_samples(rows: DataFrame, key: str, content: str, seed: str = "0", min_lines: int = 1) -> DataFrame:
    """Fill-in-the-middle samples: a span of lines hidden by hash, a line at least left on either side.

    (key, start_line, middle_lines, text): prefix, suffix and middle in this order; their
    concatenation in reading order is the content. Shorter contents are left out.
    """
    n = line_count(F.col(content))
    base = F.concat(F.lit(seed + ":"), F.col(key).cast("string"))
    out = rows.where(F.col(content).isNotNull()).withColumn("_n", n).where(F.col("_n") >= min_lines + 2)
    out = out.withColumn("middle_lines", (1 + hash_int(F.concat(base, F.lit(":len")), F.col("_n") - 2)).cast("int"))
    out = out.withColumn("start_line", (1 + hash_int(F.concat(base, F.lit(":at")), F.col("_n") - 1 - F.col("middle_lines"))).cast("int"))
    lines = F.split(F.col(content), "\n", -1)
    part = lambda a, m: F.array_join(F.slice(lines, a, m), "\n")
    prefix = F.concat(part(F.lit(1), F.col("start_line")), F.lit("\n"))
    middle = F.concat(part(F.col("start_line") + 1, F.col("middle_lines")), F.lit("\n"))
    suffix = part(F.col("start_line") + F.col("middle_lines") + 1, F.col("_n") - F.col("start_line") - F.col("middle_lines"))
    text = F.concat(F.lit("<|fim_prefix|>"), prefix, F.lit("<|fim_suffix|>"), suffix, F.lit("<|fim_middle|>"), middle)
    return out.select(key, "start_line", "middle_lines", text.alias("text"))


def diff_instructions(commits: DataFrame, subject: tuple[int, int] = (12, 200), lines: tuple[int, int] = (2, 400)) -> DataFrame:
    """Chat pairs from commits whose subject and diff are within bounds: (sha, diff_lines, text)."""
    s = F.substring_index("message", "\n", 1)
    n = line_count(F.col("diff_text"))
    text = F.concat(F.lit("<|im_start|>user\n"), s, F.lit("<|im_end|>\n<|im_start|>assistant\n"), F.col("diff_text"), F.lit("<|im_end|>"))
    return (
        commits.where("message is not null and length(diff_text) > 0")
        .where(F.length(s).between(*subject) & n.between(*lines))
        .select("sha", n.alias("diff_lines"), text.alias("text"))
    )


def quota(rows: DataFrame, group: str, key: str, shares: dict[str, float]) -> DataFrame:
    """Hash-ordered sample of each group up to its share of the largest total all groups allow.

    A row is kept when its hash rank within the group is within the group's quota; the same rows are kept on every run. The
    hashes are counted in 4096 ranges, whole ranges below the quota are kept, and only the range at its edge is put in order.
    """
    known = rows.where(F.col(group).isin(list(shares))).withColumn("_h", F.sha2(F.col(key).cast("string"), 256))
    known = known.withColumn("_range", F.substring("_h", 1, 3))
    counts = known.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_here"))
    have = {r[group]: r["have"] for r in counts.groupBy(group).agg(F.sum("_here").alias("have")).collect()}  # one row a share
    total = min((int(have.get(k, 0) / v) for k, v in shares.items() if v > 0), default=0)
    share = F.create_map(*[x for k, v in shares.items() for x in (F.lit(k), F.lit(int(total * v)))])
    upto = F.sum("_here").over(Window.partitionBy(group).orderBy("_range"))
    ranges = counts.withColumn("_left", share[F.col(group)] - (upto - F.col("_here"))).where(F.col("_left") > 0)
    placed = known.join(ranges, [group, "_range"])
    whole = placed.where(F.col("_left") >= F.col("_here"))
    edge = placed.where(F.col("_left") < F.col("_here"))
    ranked = edge.withColumn("_rank", F.row_number().over(Window.partitionBy(group, "_range").orderBy("_h", key))).where(F.col("_rank") <= F.col("_left"))
    return whole.select(*rows.columns).unionByName(ranked.select(*rows.columns))


def chat_pairs(rows: DataFrame, key: str, user: Column, assistant: Column, system: str | None = None) -> DataFrame:
    """(key, messages): a conversation as a JSON array of roles and contents; rows without either side are left out."""
    turns = ([("system", F.lit(system))] if system else []) + [("user", user), ("assistant", assistant)]
    said = F.array(*[F.struct(F.lit(role).alias("role"), content.alias("content")) for role, content in turns])
    return rows.where((F.length(user) > 0) & (F.length(assistant) > 0)).select(key, F.to_json(said).alias("messages"))


def time_split(rows: DataFrame, time: str, key: str, share: float = 0.8) -> DataFrame:
    """Adds split: the older `share` of the rows is train, the newer eval; rows without a time are train.

    Days are counted and summed up, and only the day at the edge is put in order (by time, then key).
    """
    dated = rows.withColumn("_day", F.to_date(time))
    days = dated.where("_day is not null").groupBy("_day").agg(F.count(F.lit(1)).alias("_here"))
    upto = F.sum("_here").over(Window.orderBy("_day"))  # one row a day
    total = F.sum("_here").over(Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    edge = days.withColumn("_left", F.floor(total * share) - (upto - F.col("_here")))
    placed = dated.join(edge, "_day", "left")
    whole = placed.where((F.col("_left") >= F.col("_here")) | (F.col("_left") <= 0) | F.col("_day").isNull())
    cut = placed.where((F.col("_left") < F.col("_here")) & (F.col("_left") > 0))
    ranked = cut.withColumn("split", F.when(F.row_number().over(Window.partitionBy("_day").orderBy(time, key)) <= F.col("_left"), "train").otherwise("eval"))
    return whole.withColumn("split", F.when(F.col("_left") <= 0, "eval").otherwise("train")).select(*rows.columns, "split").unionByName(ranked.select(*rows.columns, "split"))


def capped_share(rows: DataFrame, flag: Column, key: str, most: float) -> DataFrame:
    """All rows without the flag, and in hash order so many with it that they are at most that share of the result."""
    known = rows.withColumn("_kind", F.when(flag, "capped").otherwise("free"))
    have = {r["_kind"]: r["count"] for r in known.groupBy("_kind").count().collect()}  # two rows
    allowed = min(have.get("capped", 0), int(most * have.get("free", 0) / (1 - most))) if most < 1 else have.get("capped", 0)
    return known.where("_kind = 'free'").select(*rows.columns).unionByName(_first_by_hash(known.where("_kind = 'capped'"), key, allowed).select(*rows.columns))


def _first_by_hash(rows: DataFrame, key: str, n: int) -> DataFrame:
    hashed = rows.withColumn("_h", F.sha2(F.col(key).cast("string"), 256)).withColumn("_range", F.substring("_h", 1, 3))
    counts = hashed.groupBy("_range").agg(F.count(F.lit(1)).alias("_here"))
    ranges = counts.withColumn("_left", F.lit(n) - (F.sum("_here").over(Window.orderBy("_range")) - F.col("_here"))).where("_left > 0")  # 4096 rows
    placed = hashed.join(ranges, "_range")
    edge = placed.where("_left < _here").withColumn("_rank", F.row_number().over(Window.partitionBy("_range").orderBy("_h", key))).where("_rank <= _left")
    return placed.where("_left >= _here").select(*rows.columns).unionByName(edge.select(*rows.columns))
