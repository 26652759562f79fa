"""Version-control logs as tables: one-line logs with numstat, and changelist records."""

from __future__ import annotations

import io
import marshal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodeweave.functions.text import iso_to_utc, pull_of_subject


def commit_log(lines: DataFrame) -> DataFrame:
    """value = "sha|time|email|name|subject" -> (sha, authored_at, email, author, subject, pr_number).

    Only the first four bars divide; rows without a 40-digit sha are dropped.
    """
    p = F.split("value", r"\|", 5)
    rows = lines.where(F.size(p) == 5).select(p[0].alias("sha"), p[1].alias("at"), p[2].alias("email"), p[3].alias("author"), p[4].alias("subject"))
    return rows.where(F.col("sha").rlike(r"^[0-9a-f]{40}$")).select("sha", iso_to_utc(F.col("at")).alias("authored_at"), "email", "author", "subject", pull_of_subject(F.col("subject")).alias("pr_number"))


def numstat(lines: DataFrame, key: str) -> DataFrame:
    """(key, value = "added<TAB>deleted<TAB>path") -> (key, path, added, deleted); "-" of binary files counts 0."""
    p = F.split("value", "\t", 3)
    n = lambda i: F.coalesce(F.try_to_number(p[i], F.lit("999999999")), F.lit(0)).cast("int")
    return lines.where(F.size(p) == 3).select(key, p[2].alias("path"), n(0).alias("added"), n(1).alias("deleted"))


def commit_details(shown: DataFrame) -> DataFrame:
    """shown(sha, value = numstat lines, an empty line, the patch) -> (sha, files array of path, added, deleted; added, deleted, diff_text).

    A commit without a patch has an empty one; "-" of binary files counts 0.
    """
    parts = F.split("value", r"\n(?=diff --git )", 2)
    lines = F.filter(F.transform(F.split(parts[0], "\n"), lambda x: F.split(x, "\t", 3)), lambda p: F.size(p) == 3)
    n = lambda x: F.coalesce(x.try_cast("int"), F.lit(0))
    files = F.transform(lines, lambda p: F.struct(p[2].alias("path"), n(p[0]).alias("added"), n(p[1]).alias("deleted")))
    total = lambda name: F.aggregate("files", F.lit(0), lambda a, x: a + x[name])
    out = shown.where(F.col("sha").isNotNull()).select("sha", files.alias("files"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("diff_text"))
    return out.select("sha", "files", total("added").alias("added"), total("deleted").alias("deleted"), "diff_text")


def change_records(spark: SparkSession, path: str) -> DataFrame:
    """Files of marshalled dictionaries, wherever Spark reads files from -> one row a dictionary: record map<string,string>."""

    def decode(batches):
        text = lambda x: x.decode("utf-8", "replace") if isinstance(x, bytes) else str(x)
        for batch in batches:
            rows = []
            for content in batch.column(0).to_pylist():
                file = io.BytesIO(content)
                while file.tell() < len(content):
                    try:
                        record = marshal.load(file)
                    except EOFError:  # a record that was cut off
                        break
                    rows.append([(text(k), text(v)) for k, v in record.items()])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.map_(pa.string(), pa.string()))], names=["record"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(decode, "record map<string,string>")


def page_after(rows: DataFrame, key: str, last, size: int) -> DataFrame:
    """The next `size` rows after a cursor, in order of the key; null keys are on no page. The greatest key is the next cursor."""
    later = rows.where(F.col(key).isNotNull()) if last is None else rows.where(F.col(key) > last)
    return later.orderBy(key).limit(size)


def after_commit(commits: DataFrame, sha: str, time: str = "authored_at") -> DataFrame:
    """Commits newer than a known one, it excluded; all where it is unknown."""
    known = commits.where(F.col("sha") == sha).agg(F.max(time).alias("at")).first()["at"]
    return commits if known is None else commits.where((F.col(time) >= known) & (F.col("sha") != sha))


def with_diffs(pulls: DataFrame, diffs: DataFrame) -> DataFrame:
    """Pulls with the diff that was fetched for them; one that could not be fetched is empty."""
    one = diffs.groupBy("pr_number").agg(F.max("diff_text").alias("diff_text"))
    return pulls.drop("diff_text").join(one, "pr_number", "left").withColumn("diff_text", F.coalesce("diff_text", F.lit("")))


def described_changes(records: DataFrame) -> DataFrame:
    """record map -> (cl_number, author, submitted_at, description, files); numbered fields become an array of files."""
    r = F.col("record")
    n = F.size(F.filter(F.map_keys(r), lambda k: k.rlike(r"^depotFile\d+$")))
    at = lambda name, i: F.try_element_at(r, F.concat(F.lit(name), i.cast("string")))
    files = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(at("depotFile", i).alias("path"), at("action", i).alias("action"), at("rev", i).cast("int").alias("rev")))).otherwise(F.array().cast("array<struct<path:string,action:string,rev:int>>"))
    return records.where(F.try_element_at(r, F.lit("change")).isNotNull()).select(
        r["change"].cast("bigint").alias("cl_number"), r["user"].alias("author"), F.timestamp_seconds(F.try_element_at(r, F.lit("time")).cast("bigint")).alias("submitted_at"), F.try_element_at(r, F.lit("desc")).alias("description"), files.alias("files")
    )
