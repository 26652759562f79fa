"""Working trees and documents as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodeweave.functions.globs import any_of
from lodeweave.operators.dataset import extension


def tree(spark: SparkSession, root: str, tracked: DataFrame | None = None, content: bool = False) -> DataFrame:
    """(relpath, abspath, size_bytes, ext[, content]) of the regular files below a root.

    tracked(relpath) keeps the listed files only. Without content, Spark reads names and sizes and no bytes.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    path = F.regexp_replace("path", r"^file:/*", "/")
    base = "/" + root.removeprefix("file:").strip("/") + "/"
    out = files.select(
        F.expr(f"substring(regexp_replace(path, '^file:/*', '/'), {len(base) + 1})").alias("relpath"), path.alias("abspath"), F.col("length").alias("size_bytes"),
        *([F.col("content").cast("string").alias("content")] if content else []),
    ).withColumn("ext", extension(F.col("relpath")))
    return out.join(tracked.select("relpath").distinct(), "relpath", "left_semi") if tracked is not None else out


# fixed values: documentation files of a checkout (a leading slash ties a pattern to the root), and directories that are passed over
DOC_PATTERNS = [
    "/README*.md",
    "/Makefile",
    "/makefile",
    "docs/**/*.md",
    "/docker-compose*.yml",
    "/docker-compose*.yaml",
    "/Dockerfile",
    "/Dockerfile.*",
    "**/Dockerfile",
    "**/Dockerfile.*",
    "/*.sh",
]
SKIPPED_PARTS = (".git", "node_modules", ".venv", "venv", "__pycache__", "dist", "build")


def documents(files: DataFrame, patterns: list[str] | None = None, skipped: tuple[str, ...] = SKIPPED_PARTS) -> DataFrame:
    """Files whose path matches a document pattern and has no skipped directory in it, once each."""
    parts = F.split("relpath", "/")
    return files.where(F.col("relpath").rlike(any_of(patterns or DOC_PATTERNS)) & ~F.exists(parts, lambda p: p.isin(*skipped))).dropDuplicates(["relpath"])


def without_nested(files: DataFrame, markers: DataFrame) -> DataFrame:
    """Files that lie in no nested checkout; markers(dir) are the directories that hold a repository of their own."""
    parts = F.split("relpath", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n - 1), "/"))
    under = files.select("relpath", F.explode(F.filter(above, lambda d: d != "")).alias("dir")).join(markers.select("dir").distinct(), "dir", "left_semi").select("relpath").distinct()
    return files.join(under, "relpath", "left_anti")


def below(files: DataFrame, scope: str, patterns: list[str] | None = None) -> DataFrame:
    """Files below a directory, or all for "", whose path from there matches one of the patterns."""
    scope = scope.strip("/")
    rest = F.col("relpath") if not scope else F.expr(f"substring(relpath, {len(scope) + 2})")
    out = files if not scope else files.where(F.startswith("relpath", F.lit(scope + "/")))
    return out.where(rest.rlike(any_of(patterns))) if patterns else out
