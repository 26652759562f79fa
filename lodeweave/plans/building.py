"""Queries of the second chunker, of windows and headings, and of sample streams, splits by time and caps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lodeweave.functions import text as T
from lodeweave.operators import chunks as C, dataset as D
from lodeweave.operators.linking import current
from lodeweave.session import read
from lodeweave.sources import code as S

SYMBOL = r"^\s*(?:pub fn|fn|def|class|export function|export const|func)\s+(\w+)"


def _changes(spark, sf_dir) -> DataFrame:
    return current(read(spark, sf_dir, "changes", "cl_number", "diff_text", "indexed_at", "deleted_at"), "cl_number").where("deleted_at is null and length(diff_text) > 0")


def tc_marker_files(spark, sf_dir):
    return C.marker_files(_changes(spark, sf_dir), "cl_number", "diff_text").select("cl_number", "file_index", "file_path", F.md5("block").alias("digest"))


def tc_marker_hunks(spark, sf_dir):
    return C.marker_hunks(C.marker_files(_changes(spark, sf_dir), "cl_number", "diff_text"), "cl_number").select("cl_number", "file_index", "hunk_index", F.md5("hunk").alias("digest"))


def tc_marker_chunks(spark, sf_dir):
    """Hunks cut into pieces of 200 bytes at most."""
    return C.marker_chunks(_changes(spark, sf_dir), "cl_number", "diff_text", 200).select("cl_number", "file_index", "hunk_index", "piece", F.octet_length("chunk").alias("bytes"), F.md5("chunk").alias("digest"))


def tc_cut_short(spark, sf_dir):
    """The short markers of truncation, without and with the number."""
    return _changes(spark, sf_dir).select("cl_number", T.cut_short(F.col("diff_text"), 300).alias("plain"), T.cut_short(F.col("diff_text"), 300, F.col("cl_number")).alias("numbered"))


def fi_cut_diffs(spark, sf_dir):
    """Changelists whose diff came truncated: here longer than 2500 characters counts."""
    return _changes(spark, sf_dir).select("cl_number", T.was_cut(F.col("diff_text"), 2500).alias("cut"))


def tc_symbols(spark, sf_dir):
    """Thirty lines around every declaration in the samples."""
    rows = read(spark, sf_dir, "samples", "sample_id", "text").where("text is not null")
    return C.symbol_windows(rows, "sample_id", "text", SYMBOL).select("sample_id", "symbol", "start_line", "end_line", F.md5("window").alias("digest"))


def tc_headings(spark, sf_dir):
    """Lines of documents by the heading they stand under."""
    lines = C.headed_lines(read(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
    return lines.groupBy("doc_id", "heading").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("line")).alias("characters"))


def ds_chats(spark, sf_dir):
    commits = current(read(spark, sf_dir, "commits", "sha", "message", "diff_text", "indexed_at"), "sha", "message")
    chats = D.chat_pairs(commits, "sha", T.subject(F.col("message")), F.col("diff_text"))
    said = F.from_json("messages", "array<struct<role: string, content: string>>")
    return chats.select("sha", F.transform(said, lambda x: x["role"]).alias("roles"), F.md5(F.array_join(F.transform(said, lambda x: x["content"]), "|")).alias("digest"))


def se_samples(spark, sf_dir):
    """Document, fill-in-the-middle and diff samples in one stream; diffs are for training alone."""
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text").where("length(text) > 0").withColumn("key", F.concat_ws("/", "source", "doc_id"))
    split = D.split_of(F.col("key"), F.lit("7"), {"train": 0.8, "val": 0.1, "test": 0.1})
    plain = docs.select("key", F.lit("document").alias("format"), split.alias("split"), F.length("text").alias("characters"))
    hidden = D.fim_samples(docs, "key", "text").select("key", F.lit("fim").alias("format"), split.alias("split"), "middle_lines", "start_line")
    commits = current(read(spark, sf_dir, "commits", "sha", "message", "diff_text", "indexed_at"), "sha", "message")
    diffs = D.diff_instructions(commits).select(F.col("sha").alias("key"), F.lit("diff_instr").alias("format"), F.lit("train").alias("split"), "diff_lines")
    return plain.unionByName(hidden, allowMissingColumns=True).unionByName(diffs, allowMissingColumns=True)


def ds_allowed(spark, sf_dir):
    """Files of the allowed extensions, of which one is denied after all."""
    files = D.keep_files(read(spark, sf_dir, "file_records", "file_id", "relpath", "size_bytes"), 1, 1 << 20, allow=[".PY", "go", " rs ", "json"], deny=["json"])
    return files.select("file_id", D.extension(F.col("relpath")).alias("extension"))


def ds_time_split(spark, sf_dir):
    """The older four fifths of the samples for training, the newer for evaluation."""
    return D.time_split(read(spark, sf_dir, "samples", "sample_id", "built_at"), "built_at", "sample_id").select("sample_id", F.col("split").alias("part"))


def ds_capped(spark, sf_dir):
    """Fill-in-the-middle samples are a tenth of the set at most."""
    rows = read(spark, sf_dir, "samples", "sample_id", F.col("meta.format").alias("format"))
    return D.capped_share(rows, F.coalesce(F.col("format") == "fim", F.lit(False)), "sample_id", 0.1)


def tk_recent_commits(spark, sf_dir):
    """The 200 newest commits."""
    commits = current(read(spark, sf_dir, "commits", "sha", "authored_at", "message", "indexed_at"), "sha", "message")
    return commits.select("sha", F.unix_timestamp(T.iso_to_utc(F.col("authored_at"))).alias("authored")).orderBy(F.desc_nulls_last("authored"), "sha").limit(200)


def tk_first_examples(spark, sf_dir):
    """The first 200 evaluation samples in order of their number."""
    return read(spark, sf_dir, "samples", "sample_id", "split", "source").where("split in ('val', 'test')").orderBy("sample_id").limit(200)


def up_replaced_parts(spark, sf_dir):
    """Chunks of the newest version of every changelist: a version is a day of storing, and it replaces all before it."""
    chunks = read(spark, sf_dir, "cl_chunks", "chunk_id", "cl_number", "indexed_at").where("cl_number is not null and indexed_at is not null").withColumn("version", F.to_date("indexed_at"))
    newest = chunks.groupBy("cl_number").agg(F.max("version").alias("version"))
    return chunks.join(newest, ["cl_number", "version"]).select("cl_number", "chunk_id").distinct()


def fi_grep_scoped(spark, sf_dir):
    """Lines of samples of one language below one of two directories that declare a function."""
    rows = read(spark, sf_dir, "samples", "sample_id", F.col("meta.src_path").alias("path"), "text").where("path is not null")
    scoped = rows.where(F.col("path").rlike(r"\.(?:py|rs)$") & (F.lower("path").contains("/s") | F.lower("path").startswith("a")))
    return C.matching_lines(scoped, "sample_id", "text", r"^\s*(?:def|pub fn) \w+\(").select("sample_id", "line_no", "line")


def sc_code_facts(spark, sf_dir):
    """Facts of the whole files among the samples, without the lines that name repository and path."""
    rows = read(spark, sf_dir, "samples", F.col("meta.src_path").alias("path"), F.col("meta.format").alias("format"), "text").where("format = 'document' and path is not null")
    return S.code_facts(rows.select("path", F.regexp_replace("text", r"^<\|repo_name\|>[^\n]*\n<\|file_sep\|>[^\n]*\n", "").alias("content")))


def _declared(spark, sf_dir) -> DataFrame:
    rows = read(spark, sf_dir, "samples", "sample_id", "source", F.col("meta.src_path").alias("path"), "text").where("text is not null and path is not null")
    return C.symbol_windows(rows.withColumn("key", F.struct("source", "path")), "key", "text", SYMBOL).select("key.source", "key.path", "symbol", "start_line", "window")


def rt_definition_hop(spark, sf_dir):
    """Calls `thing.member(` in documents whose member is declared in one file alone: the document and that file."""
    sites = _declared(spark, sf_dir).select("symbol", "path").distinct()
    single = sites.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.first("path").alias("path")).where("n = 1")
    docs = read(spark, sf_dir, "documents", "doc_id", "text").where("text is not null")
    calls = docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\w+\.(\w+)\("), F.lit(1)))).alias("symbol"))
    return calls.join(single, "symbol").select("doc_id", "symbol", "path")


def tc_contrast(spark, sf_dir):
    """Pairs for training by contrast: a symbol, the window that declares it, and a window of another file of the repository that does not."""
    each = _declared(spark, sf_dir).where("source is not null").select("source", "path", "symbol", F.md5("window").alias("digest")).distinct()
    order = Window.partitionBy("source").orderBy(F.md5(F.concat_ws("|", "path", "symbol", "digest")), "path", "symbol", "digest")
    after = each.withColumn("next", F.lead(F.struct("path", "symbol", "digest")).over(order))
    return after.where((F.col("next.path") != F.col("path")) & (F.col("next.symbol") != F.col("symbol"))).select("source", "path", "symbol", F.col("digest").alias("positive"), F.col("next.digest").alias("negative"))


_CHANGES = "with live as (select * from (select * from changes where cl_number is not null qualify row_number() over (partition by cl_number order by indexed_at desc) = 1) where deleted_at is null and length(diff_text) > 0)"
_MARKED = _CHANGES + """, raw as (select cl_number, string_split(chr(10) || diff_text, chr(10) || '+++ b/') as p from live),
files as (select cl_number, i - 2 as file_index, rtrim(split_part(p[i], chr(10), 1)) as file_path,
  case when i = 2 and p[1] <> '' then p[1][2:] || chr(10) else '' end || '+++ b/' || p[i] || case when i < len(p) then chr(10) else '' end as block from (select cl_number, p, unnest(range(2, len(p) + 1)) as i from raw)),
hs as (select cl_number, file_index, string_split(regexp_replace(block, '(?m)^(@@ [^@]+ @@)', chr(1) || '\\1', 'g'), chr(1)) as h from files),
hunks as (select cl_number, file_index, unnest(range(0, len(h))) as hunk_index, unnest(h) as hunk from hs)
"""
QUERIES = {f.__name__: f for f in (tc_marker_files, tc_marker_hunks, tc_marker_chunks, tc_cut_short, fi_cut_diffs, tc_symbols, tc_headings, ds_chats, se_samples, ds_allowed, ds_time_split, ds_capped, tk_recent_commits, tk_first_examples, up_replaced_parts, fi_grep_scoped, sc_code_facts, rt_definition_hop, tc_contrast)}
_SPLIT = "case when x < 0.8 then 'train' when x < 0.9 then 'val' else 'test' end"
SQL = {
    "tc_marker_files": _MARKED + "select cl_number, file_index, file_path, md5(block) as digest from files",
    "tc_marker_hunks": _MARKED + "select cl_number, file_index, hunk_index, md5(hunk) as digest from hunks",
    "tc_marker_chunks": _MARKED + """, ends as (select *, list_transform(range(0, length(hunk) + 1), lambda i: strlen(left(hunk, i))) as b from hunks),
cut as (with recursive c as (select cl_number, file_index, hunk_index, hunk, b, 0 as piece, 0::bigint as a, (len(list_filter(b, lambda x: x <= 200)) - 1)::bigint as z from ends
  union all select cl_number, file_index, hunk_index, hunk, b, piece + 1, z, (len(list_filter(b, lambda x: x <= b[z + 1] + 200)) - 1)::bigint from c where z < length(hunk)) select * from c)
select cl_number, file_index, hunk_index, piece, strlen(substr(hunk, a + 1, z - a)) as bytes, md5(substr(hunk, a + 1, z - a)) as digest from cut""",
    "tc_cut_short": _CHANGES + """select cl_number, case when length(diff_text) <= 300 then diff_text else left(diff_text, 300) || chr(10) || '... (truncated)' end as plain,
  case when length(diff_text) <= 300 then diff_text else left(diff_text, 300) || chr(10) || '... (truncated; CL ' || cl_number || ')' end as numbered from live""",
    "fi_cut_diffs": _CHANGES + "select cl_number, contains(diff_text, '... truncated') or length(diff_text) > 2500 as cut from live",
    "tc_symbols": """with l as (select sample_id, string_split(text, chr(10)) as l from samples where length(text) > 0), m as (select sample_id, l, unnest(range(1, len(l) + 1)) as n from l),
s as (select sample_id, l, n, regexp_extract(l[n], '^\\s*(?:pub fn|fn|def|class|export function|export const|func)\\s+(\\w+)', 1) as symbol from m)
select sample_id, symbol, greatest(1, n - 10) as start_line, least(len(l), n + 19) as end_line, md5(array_to_string(l[greatest(1, n - 10):least(len(l), n + 19)], chr(10))) as digest from s where symbol <> ''""",
    "tc_headings": """with q as (select doc_id, list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^(?:> ?)+', '')) as l from documents where length(text) > 0),
m as (select doc_id, l, unnest(range(1, len(l) + 1)) as n from q),
h as (select doc_id, n, l[n] as line, case when regexp_matches(l[n], '^#{1,6}[ \\t]+(\\S.*?)\\s*$') then regexp_extract(l[n], '^#{1,6}[ \\t]+(\\S.*?)\\s*$', 1)
  when regexp_matches(l[n], '^(\\d+(?:\\.\\d+)*\\.?[ \\t]+[A-Z]\\S.*?)\\s*$') then regexp_extract(l[n], '^(\\d+(?:\\.\\d+)*\\.?[ \\t]+[A-Z]\\S.*?)\\s*$', 1)
  when regexp_matches(coalesce(l[n + 1], ''), '^(?:=|-){3,}\\s*$') and regexp_matches(l[n], '^\\w') then trim(l[n]) end as h from m),
u as (select *, coalesce(last_value(h ignore nulls) over (partition by doc_id order by n), '') as heading from h)
select doc_id, heading, count(*) as lines, sum(length(line))::bigint as characters from u group by 1, 2""",
    "ds_chats": """with c as (select * from commits where sha is not null qualify row_number() over (partition by sha order by indexed_at desc, message desc nulls last) = 1)
select sha, ['user', 'assistant'] as roles, md5(split_part(message, chr(10), 1) || '|' || diff_text) as digest from c where length(split_part(message, chr(10), 1)) > 0 and length(diff_text) > 0""",
    "se_samples": """with d as (select concat_ws('/', source, doc_id) as key, text, cast(('0x' || substr(sha256('7:' || concat_ws('/', source, doc_id)), 1, 16))::ubigint as double) / 18446744073709551616.0 as x from documents where length(text) > 0),
f as (select key, x, len(string_split(text, chr(10))) as n from d where len(string_split(text, chr(10))) >= 3),
g as (select *, 1 + ('0x' || substr(sha256('0:' || key || ':len'), 1, 7))::bigint % (n - 2) as m from f),
c as (select * from commits where sha is not null qualify row_number() over (partition by sha order by indexed_at desc, message desc nulls last) = 1),
i as (select sha, split_part(message, chr(10), 1) as s, len(string_split(diff_text, chr(10))) as n from c where message is not null and length(diff_text) > 0)
select key, 'document' as format, """ + _SPLIT + """ as split, length(text) as characters, null::int as middle_lines, null::int as start_line, null::bigint as diff_lines from d
union all select key, 'fim', """ + _SPLIT + """, null, m, 1 + ('0x' || substr(sha256('0:' || key || ':at'), 1, 7))::bigint % (n - 1 - m), null from g
union all select sha, 'diff_instr', 'train', null, null, null, n from i where length(s) between 12 and 200 and n between 2 and 400""",
    "ds_allowed": "select file_id, e as extension from (select file_id, size_bytes, lower(regexp_extract(relpath, '[^/.][^/]*\\.([^./]+)$', 1)) as e from file_records) where size_bytes between 1 and 1048576 and e in ('py', 'go', 'rs')",
    "ds_time_split": "select sample_id, case when built_at is null or r <= floor(n * 0.8) then 'train' else 'eval' end as part from (select sample_id, built_at, row_number() over (partition by built_at is null order by built_at, sample_id) as r, count(built_at) over () as n from samples)",
    "ds_capped": """with s as (select sample_id, meta.format as format, coalesce(meta.format = 'fim', false) as f from samples), a as (select floor(0.1 * count(*) filter (not f) / 0.9) as most from s)
select sample_id, format from s where not f union all select sample_id, format from (select *, row_number() over (order by sha256(sample_id::varchar), sample_id) as r from s where f), a where r <= most""",
    "tk_recent_commits": """with c as (select * from commits where sha is not null qualify row_number() over (partition by sha order by indexed_at desc, message desc nulls last) = 1)
select sha, epoch(try_cast(authored_at as timestamptz))::bigint as authored from c order by authored desc nulls last, sha limit 200""",
    "tk_first_examples": "select sample_id, split, source from samples where split in ('val', 'test') order by sample_id limit 200",
    "up_replaced_parts": """with c as (select *, cast(indexed_at as date) as v from cl_chunks where cl_number is not null and indexed_at is not null)
select distinct cl_number, chunk_id from c join (select cl_number, max(v) as v from c group by 1) using (cl_number, v)""",
    "fi_grep_scoped": """with l as (select sample_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as line_no from samples
  where length(text) > 0 and regexp_matches(meta.src_path, '\\.(?:py|rs)$') and (contains(lower(meta.src_path), '/s') or starts_with(lower(meta.src_path), 'a')))
select sample_id, line_no, line from l where regexp_matches(line, '^\\s*(?:def|pub fn) \\w+\\(')""",
}
_DECLARED = """with l as (select distinct source, meta.src_path as path, string_split(text, chr(10)) as l, sample_id from samples where length(text) > 0 and meta.src_path is not null), m as (select source, path, l, unnest(range(1, len(l) + 1)) as n from l),
s as (select source, path, l, n, regexp_extract(l[n], '^\\s*(?:pub fn|fn|def|class|export function|export const|func)\\s+(\\w+)', 1) as symbol from m),
d as (select source, path, symbol, greatest(1, n - 10) as start_line, array_to_string(l[greatest(1, n - 10):least(len(l), n + 19)], chr(10)) as win from s where symbol <> '')
"""
SQL["rt_definition_hop"] = _DECLARED + """, one as (select symbol, min(path) as path from d group by 1 having count(distinct path) = 1),
c as (select doc_id, unnest(list_distinct(regexp_extract_all(text, '\\w+\\.(\\w+)\\(', 1))) as symbol from documents where text is not null) select doc_id, symbol, path from c join one using (symbol)"""
SQL["tc_contrast"] = _DECLARED + """, e as (select distinct source, path, symbol, md5(win) as digest from d where source is not null),
n as (select *, lead(path) over w as p2, lead(symbol) over w as s2, lead(digest) over w as d2 from e window w as (partition by source order by md5(concat_ws('|', path, symbol, digest)), path, symbol, digest))
select source, path, symbol, digest as positive, d2 as negative from n where p2 <> path and s2 <> symbol"""
