"""Chunkers: diffs into files and hunks, documents into sections, texts into windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

GIT_HEADER = r"(?m)^diff --git a/\S+ b/(\S+)"


def diff_files(rows: DataFrame, key: str, diff: str) -> DataFrame:
    """(key, file_index, file_path, block): one row per file of a git diff, in order; text before the first header is no file."""
    blocks = rows.where(F.length(diff) > 0).select(key, F.posexplode(F.split(diff, r"(?m)(?=^diff --git )")).alias("pos", "block"))
    named = blocks.withColumn("file_path", F.regexp_extract("block", GIT_HEADER, 1)).where("file_path <> ''")
    order = Window.partitionBy(key).orderBy("pos")
    return named.withColumn("file_index", F.row_number().over(order) - 1).select(key, "file_index", "file_path", "block")


def hunks(files: DataFrame, key: str) -> DataFrame:
    """(key, file_index, file_path, hunk_index, hunk): the hunks of every file, the preamble left out."""
    parts = F.filter(F.split("block", r"(?m)(?=^@@ )"), lambda x: x.startswith("@@ "))
    return files.select(key, "file_index", "file_path", F.posexplode(parts).alias("hunk_index", "hunk"))


def line_changes(files: DataFrame, key: str) -> DataFrame:
    """(key, file_index, file_path, added, deleted): changed lines below the file headers."""
    lines = F.filter(F.split("block", "\n"), lambda x: ~x.startswith("+++ ") & ~x.startswith("--- "))
    count = lambda mark: F.size(F.filter(lines, lambda x: x.startswith(mark)))
    return files.select(key, "file_index", "file_path", count("+").alias("added"), count("-").alias("deleted"))


def change_summary(changes: DataFrame, key: str) -> DataFrame:
    """(key, files, added, deleted, summary): one line a file in order."""
    line = F.concat("file_path", F.lit(" (+"), "added", F.lit(" -"), "deleted", F.lit(")"))
    ordered = F.array_sort(F.collect_list(F.struct("file_index", line.alias("line"))))
    return changes.groupBy(key).agg(
        F.countDistinct("file_path").alias("files"), F.sum("added").alias("added"), F.sum("deleted").alias("deleted"),
        F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("summary"),
    )


def sections(rows: DataFrame, key: str, text: str, most: int = 2000) -> DataFrame:
    """(key, chunk_index, heading, chunk): sections under ATX headings, cut at `most` characters, blank pieces dropped.

    The heading line stays in its section; text before the first heading has the heading "".
    """
    lines = rows.where(F.length(text) > 0).select(key, F.posexplode(F.split(text, r"(?m)(?=^#{1,6}[ \t]+\S)")).alias("pos", "body"))
    head = F.trim(F.regexp_extract("body", r"^#{1,6}[ \t]+([^\n]*)", 1))
    count = F.greatest(F.lit(1), F.ceil(F.length("body") / most)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(F.col("body"), i * most + 1, F.lit(most)))
    cut = lines.select(key, "pos", head.alias("heading"), F.posexplode(pieces).alias("piece", "chunk")).where(F.col("chunk").rlike(r"\S"))
    order = Window.partitionBy(key).orderBy("pos", "piece")
    return cut.withColumn("chunk_index", F.row_number().over(order) - 1).select(key, "chunk_index", "heading", "chunk")


def word_windows(rows: DataFrame, key: str, words: Column, size: int = 512, overlap: int = 64) -> DataFrame:
    """(key, start, words): overlapping windows over the words of a text; the last reaches its end."""
    step = size - overlap
    w = rows.select(key, words.alias("_w")).where(F.size("_w") > 0)
    last = F.greatest(F.lit(0), F.ceil((F.size("_w") - overlap) / step) - 1).cast("int")
    starts = w.withColumn("start", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: i * step)))
    return starts.select(key, "start", F.slice("_w", F.col("start") + 1, F.lit(size)).alias("words"))


def matching_lines(rows: DataFrame, key: str, text: str, pattern: str) -> DataFrame:
    """(key, line_no, line): lines of a text that match a regular expression."""
    lines = rows.where(F.length(text) > 0).select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return lines.where(F.col("line").rlike(pattern)).select(key, (F.col("line_no") + 1).alias("line_no"), "line")


def packed(rows: DataFrame, keys: list[str], order: list, text: str, budget: int, parts: int = 256) -> DataFrame:
    """Rows in rank order while they fit a budget of characters per key, with the running size.

    The first column of the order is a number; its range within a key is cut into parts whose sizes are summed up first, and
    only parts that begin within the budget are put in order: a key with very many rows is not sorted in one task.
    """
    size = F.length(F.coalesce(text, F.lit("")))
    ends = rows.groupBy(*keys).agg(F.min(order[0]).alias("_lo"), F.max(order[0]).alias("_hi"))
    part = F.coalesce(F.floor((F.col(order[0]) - F.col("_lo")) * parts / (F.col("_hi") - F.col("_lo") + 1)), F.lit(-1))
    placed = rows.join(ends, keys).withColumn("_part", part).drop("_lo", "_hi")
    sums = placed.groupBy(*keys, "_part").agg(F.sum(size).alias("_size"))
    before = F.sum("_size").over(Window.partitionBy(*keys).orderBy("_part")) - F.col("_size")
    begins = sums.withColumn("_before", before).where(F.col("_before") <= budget).select(*keys, "_part")
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(begins, [*keys, "_part"]).drop("_part").withColumn("used", F.sum(size).over(w)).where(F.col("used") <= budget)


HUNK_HEADER = r"(?m)(?=^@@ [^@]+ @@)"
FILE_MARKER = r"(?m)(?=^\+\+\+ b/)"


def marker_files(rows: DataFrame, key: str, diff: str) -> DataFrame:
    """(key, file_index, file_path, block): a block from each line "+++ b/path" to the next; what stands before the first belongs to it."""
    parts = rows.where(F.length(diff) > 0).select(key, F.split(diff, FILE_MARKER).alias("_p"))
    lead = F.when(~F.get("_p", F.lit(0)).startswith("+++ b/"), F.get("_p", F.lit(0))).otherwise("")
    blocks = F.filter("_p", lambda x: x.startswith("+++ b/"))
    each = parts.select(key, lead.alias("_lead"), F.posexplode(blocks).alias("file_index", "_b"))
    path = F.rtrim(F.regexp_extract("_b", r"^\+\+\+ b/([^\r\n]*)", 1))
    return each.select(key, "file_index", path.alias("file_path"), F.when(F.col("file_index") == 0, F.concat("_lead", "_b")).otherwise(F.col("_b")).alias("block"))


def marker_hunks(files: DataFrame, key: str) -> DataFrame:
    """(key, file_index, file_path, hunk_index, hunk): the lines before the first hunk header are hunk 0; a block without headers is whole."""
    return files.select(key, "file_index", "file_path", F.posexplode(F.split("block", HUNK_HEADER)).alias("hunk_index", "hunk"))


def byte_pieces(text: Column, most: int) -> Column:
    """The text in pieces of at most `most` bytes of UTF-8, no character cut in two; a null text has none."""

    def cut(value):
        if value is None:
            return None
        data, out, at = value.encode("utf-8"), [], 0
        if len(data) <= most:
            return [value]
        while at < len(data):
            end = min(at + most, len(data))
            while end < len(data) and end > at + 1 and data[end] & 0xC0 == 0x80:
                end -= 1
            if end < len(data) and data[end] & 0xC0 == 0x80:  # one character is longer than a piece may be
                end = min(at + 4, len(data))
                while end < len(data) and data[end] & 0xC0 == 0x80:
                    end -= 1
            out.append(data[at:end].decode("utf-8", errors="replace"))
            at = end
        return out

    return F.udf(cut, "array<string>", useArrow=True)(text)


def marker_chunks(rows: DataFrame, key: str, diff: str, most: int = 4000) -> DataFrame:
    """(key, file_index, file_path, hunk_index, piece, chunk): hunks of marked files, cut where they are too long."""
    hunks_ = marker_hunks(marker_files(rows, key, diff), key)
    long = F.octet_length("hunk") > most  # only those go through Python
    whole = hunks_.where(~long).select(key, "file_index", "file_path", "hunk_index", F.lit(0).alias("piece"), F.col("hunk").alias("chunk"))
    return whole.unionByName(hunks_.where(long).select(key, "file_index", "file_path", "hunk_index", F.posexplode(byte_pieces(F.col("hunk"), most)).alias("piece", "chunk")))


def symbol_windows(rows: DataFrame, key: str, text: str, pattern: str, before: int = 10, after: int = 19) -> DataFrame:
    """(key, symbol, start_line, end_line, window): the lines around each line that names a symbol, counted from 1."""
    lines = rows.where(F.length(text) > 0).select(key, F.split(text, "\n").alias("_l"))
    marked = lines.withColumn("_m", F.transform("_l", lambda x, i: F.struct((i + 1).alias("at"), F.regexp_extract(x, pattern, 1).alias("symbol"))))
    each = marked.withColumn("_s", F.explode(F.filter("_m", lambda x: x["symbol"] != "")))
    start = F.greatest(F.lit(1), F.col("_s.at") - before)
    end = F.least(F.size("_l"), F.col("_s.at") + after)
    return each.select(key, F.col("_s.symbol").alias("symbol"), start.alias("start_line"), end.alias("end_line"), F.array_join(F.slice("_l", start, end - start + 1), "\n").alias("window"))


# fixed values: what makes a line a heading; an underline makes one of the line above it
HEADINGS = {"atx": r"^#{1,6}[ \t]+(\S.*?)\s*$", "numbered": r"^(\d+(?:\.\d+)*\.?[ \t]+[A-Z]\S.*?)\s*$"}
UNDERLINE = r"^(?:=|-){3,}\s*$"


def headed_lines(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, line, heading): lines without quote marks, and the heading each stands under, by three kinds of headings."""
    quoted = F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, r"^(?:> ?)+", ""))
    lines = rows.where(F.length(text) > 0).select(key, quoted.alias("_l")).select(key, "_l", F.posexplode("_l").alias("line_no", "line"))
    below = F.coalesce(F.get("_l", F.col("line_no") + 1), F.lit(""))
    mark = F.when(F.col("line").rlike(HEADINGS["atx"]), F.regexp_extract("line", HEADINGS["atx"], 1)).when(
        F.col("line").rlike(HEADINGS["numbered"]), F.regexp_extract("line", HEADINGS["numbered"], 1)
    ).when(below.rlike(UNDERLINE) & F.col("line").rlike(r"^\w"), F.trim("line"))
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.select(key, (F.col("line_no") + 1).alias("line_no"), "line", mark.alias("_h"))
    return marked.withColumn("heading", F.coalesce(F.last("_h", ignorenulls=True).over(w), F.lit(""))).drop("_h")
