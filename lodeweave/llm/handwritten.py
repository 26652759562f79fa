"""Generated, minified or vendored files among tracked files, by attribute rules over paths.

Rules are lines of repository attribute files (`pattern attr -attr attr=false !attr`). A
file belongs to a directory of a repository; its patterns apply below that directory, a
deeper file outranks a shallower one, and within a file the last matching line wins, for
each attribute by itself. Repositories that declare nothing get the patterns mined from
those that do: a pattern as declared, or, where declared in several forms, reduced to its
last directory or its file part; it is kept when enough repositories declare it and few
take it back. The attribute files of a few made repositories are always among them (see
declared). Names with the content hash of a build, and source files of a size nobody
types, come last.

Every pattern has one key: a directory, a name, an ending, or a word that a match must
hold. A file is exploded into its keys and joined with the rules on them, so a rule meets
the files that can match it and no others; only patterns that their key does not decide
are run as expressions. Rules are far fewer than files and Spark decides whether to send
them round; the rows of a hot repository or directory stay where they are or are split.

Paths are compared below the checkout root and below nested checkouts, with either
slash, in any case. A null path falls back on ext and size; a null size is never bulk;
null ids are skipped; repeated rows give one row. Other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodeweave.functions.globs import glob_regex
from lodeweave.session import materialize, read

from .declared import attribute_rows
from .paths import NESTED, clean_slashes

ATTRIBUTES = ("linguist-generated", "linguist-vendored")
BULK_BYTES = 400_000

# fixed values: names that carry a content hash of a build
HASHED = r"[.\-](?=[0-9a-f]*[0-9])[0-9a-f]{8,40}\.(?:js|mjs|css)$"


def parse_attributes(content: str | None) -> list[tuple[int, str, str, bool | None]]:
    """(line, pattern, attribute, value) of an attribute file; value None takes an earlier line back."""
    rules = []
    for number, line in enumerate((content or "").splitlines(), 1):
        parts = line.split()
        if not parts or parts[0].startswith("#"):
            continue
        for item in parts[1:]:
            name, _, value = item.partition("=")
            if name.startswith(("-", "!")):
                state = False if name[0] == "-" else None
                name = name[1:]
            else:
                state = value.lower() not in ("false", "0", "no", "unset")
            if name in ATTRIBUTES:
                rules.append((number, parts[0], name, state))
    return rules


def pattern_key(pattern: str) -> tuple[str, bool]:
    """(key, whether the key alone decides) of a pattern at any level; keys are d:directory, n:name, s:ending, t:word, or ":" for any file."""
    bare = pattern.lower().removeprefix("**/").lstrip("/")
    plain = lambda x: bool(x) and not re.search(r"[*?\[\]/\\]", x)
    if bare.endswith("/**") and plain(bare[:-3]):
        return f"d:{bare[:-3]}", True
    if plain(bare):
        return f"n:{bare}", True
    if bare.startswith("*") and plain(bare[1:]) and bare[1] in "._-":
        return f"s:{bare[1:]}", True
    parts = bare.split("/")
    folders = [p for p in parts[:-1] if plain(p)]
    if folders:
        return f"d:{max(folders, key=len)}", False
    words = re.findall(r"(?<![*?\]a-z0-9])[a-z0-9]+(?![*?\[a-z0-9])", re.sub(r"\[[^\]/]*\]", "*", parts[-1]))
    return (f"t:{max(words, key=len)}" if words else ":"), False


def clean_path(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(clean_slashes(col), r"^(?:\./)*/?", ""), NESTED, "")


def with_keys(files: DataFrame) -> DataFrame:
    """files(..., low, name, dirs) -> a row for each key of a file."""
    endings = F.expr("filter(transform(sequence(1, length(name)), i -> substring(name, i)), x -> x rlike '^[._-]')")
    mark = lambda kind, xs: F.transform(xs, lambda x: F.concat(F.lit(kind), x))
    words = F.regexp_extract_all("low", F.lit("[a-z0-9]+"), F.lit(0))
    keys = F.concat(mark("d:", F.col("dirs")), F.array(F.concat(F.lit("n:"), "name"), F.lit(":")), mark("s:", endings), mark("t:", words))
    return files.withColumn("key", F.explode(F.array_distinct(keys))).drop("dirs", "name")


def declared_rules(attribute_files: DataFrame) -> DataFrame:
    """attribute_files(repo, dir, content) -> (repo, dir, line_no, pattern, attr, value, key, regex); null contents declare nothing."""

    @F.udf("array<struct<line_no int, pattern string, attr string, value boolean, key string, regex string>>")
    def parse(content):
        return [(n, p, a, v, pattern_key(p)[0], "(?i)" + glob_regex(p)) for n, p, a, v in parse_attributes(content)]

    return (
        attribute_files.where("repo is not null and content is not null")
        .select("repo", F.lower(F.regexp_replace(F.coalesce("dir", F.lit("")), r"^/+|/+$", "")).alias("dir"), F.explode(parse("content")).alias("r"))
        .select("repo", "dir", "r.*")
    )


def mined_patterns(rules: DataFrame, least_repos: int = 2, against: float = 0.2) -> DataFrame:
    """Patterns that carry over: (pattern, attr, repos, key, sure, regex), declared by enough repositories and taken back by few.

    A pattern counts as it is declared; where several patterns end in one directory or one file part, that counts as well.
    """

    @F.udf("struct<key string, sure boolean, regex string>")
    def matcher(pattern):
        return (*pattern_key(pattern), "(?:^|/)" + glob_regex("/" + pattern.lower())[1:])

    p = F.regexp_replace("pattern", r"^(?:/|\*\*/)+", "")
    last = F.when(p.rlike(r"/(\*\*?)?$"), F.concat(F.regexp_extract(p, r"([^/*]+)/(?:\*\*?)?$", 1), F.lit("/**"))).otherwise(F.element_at(F.split(p, "/"), -1))
    forms = rules.select("repo", "attr", "value", p.alias("full"), F.explode(F.array_distinct(F.array(p, last))).alias("pattern")).where("pattern not in ('/**', '*', '**', '')")
    yes = F.col("value") == True  # noqa: E712
    counted = forms.groupBy("pattern", "attr").agg(
        F.countDistinct(F.when(yes, F.col("repo"))).alias("repos"), F.countDistinct(F.when(~F.coalesce(yes, F.lit(False)), F.col("repo"))).alias("others"),
        F.countDistinct("full").alias("forms"), F.max(F.col("full") == F.col("pattern")).alias("itself"),
    )
    kept = counted.where((F.col("repos") >= least_repos) & (F.col("others") <= F.col("repos") * against) & (F.col("itself") | (F.col("forms") > 1)))
    return kept.select("pattern", "attr", "repos", matcher("pattern").alias("m")).select("pattern", "attr", "repos", "m.*")


def resolve_declared(keyed: DataFrame, rules: DataFrame) -> DataFrame:
    """keyed(file_id, repo, path, low, key) -> (file_id, attr, value, pattern) by the rule that outranks all others that match."""
    r = rules.select(F.col("repo").alias("rule_repo"), "dir", "line_no", "pattern", "attr", "value", F.col("key").alias("rule_key"), "regex")
    inside = F.expr("dir = '' or startswith(low, concat(dir, '/'))")
    below = F.expr("case when dir = '' then path else substring(path, length(dir) + 2) end")
    depth = F.when(F.col("dir") == "", 0).otherwise(F.size(F.split("dir", "/")))
    rank = F.struct(depth, "line_no")
    return (
        keyed.join(r, (F.col("repo") == F.col("rule_repo")) & (F.col("key") == F.col("rule_key")))
        .where(inside).withColumn("below", below).where(F.expr("below rlike regex"))
        .groupBy("file_id", "attr").agg(F.max_by("value", rank).alias("value"), F.max_by("pattern", rank).alias("pattern"))
    )


def not_handwritten(files: DataFrame, attribute_files: DataFrame | None = None, bulk_bytes: int = BULK_BYTES) -> DataFrame:
    """file_records -> (file_id, reason, rule) of the files that a tool or another project wrote.

    reason is declared, mined, hashed name or bulk; rule is the pattern that says so. Where a repository declares a file to be
    neither generated nor vendored, its word stands against all others.
    """
    spark = files.sparkSession
    given = spark.createDataFrame(attribute_rows(), "repo string, dir string, content string")
    if attribute_files is not None:
        given = given.unionByName(attribute_files.select("repo", "dir", "content"))
    rules = materialize(declared_rules(given), "rules")
    ext = F.lower(F.regexp_replace(F.coalesce("ext", F.lit("")), r"^\.", ""))
    path = F.coalesce(F.nullif(clean_path(F.coalesce("relpath", F.lit(""))), F.lit("")), F.concat(F.lit("."), ext))
    paths = files.where("file_id is not null").select("file_id", "repo", path.alias("path"), F.col("size_bytes").alias("size"))
    # a generator keeps the cleaned path and its parts from being computed again in every branch below
    paths = paths.select("file_id", "repo", "size", F.inline(F.array(F.struct("path", F.lower("path").alias("low")))))
    parts = F.split("low", "/")
    paths = paths.select("*", F.inline(F.array(F.struct(F.element_at(parts, -1).alias("name"), F.slice(parts, 1, F.size(parts) - 1).alias("dirs")))))
    keyed = with_keys(paths.drop("size"))
    mined = mined_patterns(rules).select("pattern", "key", "sure", "regex")
    declaring = rules.select("repo").distinct()
    said = resolve_declared(keyed.join(declaring, "repo", "left_semi"), rules).where("value is not null").groupBy("file_id").agg(F.max("value").alias("yes"), F.max_by("pattern", "value").alias("rule"))
    evidence = [
        said.select("file_id", F.lit(4).alias("weight"), F.when(F.col("yes"), "declared").alias("reason"), "rule"),
        keyed.join(mined, "key").where(F.expr("sure or low rlike regex")).select("file_id", F.lit(3).alias("weight"), F.lit("mined").alias("reason"), F.col("pattern").alias("rule")),
        paths.where(F.col("name").rlike(HASHED)).select("file_id", F.lit(2).alias("weight"), F.lit("hashed name").alias("reason"), F.lit("").alias("rule")),
        paths.where(F.col("size") >= bulk_bytes).select("file_id", F.lit(1).alias("weight"), F.lit("bulk").alias("reason"), F.lit("").alias("rule")),
    ]
    every = evidence[0]
    for one in evidence[1:]:
        every = every.unionByName(one)
    best = every.groupBy("file_id").agg(F.max(F.struct("weight", "reason", "rule")).alias("e"))
    return best.select("file_id", "e.reason", "e.rule").where("reason is not null")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = read(spark, sf_dir, "file_records", "file_id", "repo", "relpath", "ext", "size_bytes")
    return not_handwritten(files).select("file_id")


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that nobody wrote by hand, counted by reason and rule."""
    files = read(spark, sf_dir, "file_records", "file_id", "repo", "relpath", "ext", "size_bytes")
    return not_handwritten(files).groupBy("reason", "rule").agg(F.count(F.lit(1)).alias("files"))
