"""Text expressions: words, references in prose, subjects, lines, truncation, hash fractions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: patterns of closing references, of pull numbers in subjects, of change and bug references
CLOSING = r"(?i)\b(?:close[sd]?|fix(?:es|ed)?|resolve[sd]?)\s+#(\d{1,6})\b"
PULL_IN_SUBJECT = (r"\(#(\d+)\)\s*$", r"^Merge pull request #(\d+)\b", r"^Merges PR #(\d+)\b")


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def closing_references(body: Column) -> Column:
    """Distinct numbers after closing keywords, as an array of bigint."""
    return F.array_distinct(F.transform(F.regexp_extract_all(body, F.lit(CLOSING), F.lit(1)), lambda x: x.cast("bigint")))


def subject(message: Column) -> Column:
    return F.substring_index(message, "\n", 1)


def pull_of_subject(line: Column) -> Column:
    """The pull number a commit subject names: the first of three forms that matches."""
    return F.coalesce(*[F.nullif(F.regexp_extract(line, p, 1), F.lit("")) for p in PULL_IN_SUBJECT]).cast("bigint")


def iso_to_utc(text: Column) -> Column:
    """ISO text with any offset as a timestamp; text that is none gives null."""
    return F.try_to_timestamp(text)


def line_count(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def truncated(text: Column, limit: int) -> Column:
    """The text, or its first `limit` characters and a marker that tells the full length."""
    marker = F.concat(F.lit("\n\n[...truncated; full diff is "), F.length(text).cast("string"), F.lit(" chars]"))
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, limit), marker))


def hash_fraction(key: Column) -> Column:
    """The first 8 bytes of SHA-256 as a fraction of 2^64."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(2.0**64)


def hash_int(key: Column, modulus: Column) -> Column:
    """A number from 0 below the modulus, from the first 7 hex digits of SHA-256."""
    return F.pmod(F.conv(F.substring(F.sha2(key, 256), 1, 7), 16, 10).cast("bigint"), modulus)


def cut_short(text: Column, limit: int, number: Column | None = None) -> Column:
    """The text, or its first `limit` characters and a short marker, with the number of the change where one is given."""
    marker = F.lit("\n... (truncated)") if number is None else F.concat(F.lit("\n... (truncated; CL "), number.cast("string"), F.lit(")"))
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, limit), marker))


def was_cut(diff: Column, limit: int = 1_000_000) -> Column:
    """Whether a diff was truncated where it came from: it says so, or it is longer than any that is kept whole."""
    return F.coalesce(F.contains(diff, F.lit("... truncated")) | (F.length(diff) > limit), F.lit(False))


def code_words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and underlines: an identifier is one word."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
