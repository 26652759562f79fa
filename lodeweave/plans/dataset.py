"""Dataset and chunking queries over file records, samples, commits, pulls, changes and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodeweave.functions import text as T
from lodeweave.functions.globs import any_of
from lodeweave.operators import chunks as C, dataset as D
from lodeweave.operators.linking import current
from lodeweave.session import read

EXCLUDE = ["vendor/**", "**/node_modules/**", "*.min.js", "**/__snapshots__/**"]
INCLUDE = ["src/**", "lib/**", "app/**", "**/services/**", "*.py"]
WEIGHTS = {"train": 0.8, "val": 0.1, "test": 0.1}


def ds_filtered(spark, sf_dir):
    files = read(spark, sf_dir, "file_records", "file_id", "repo", "relpath", "size_bytes")
    return D.keep_files(files, 300, 40_000, deny=["lock", ".Snap", "map"], include=INCLUDE, exclude=EXCLUDE).select("file_id", D.extension(F.col("relpath")).alias("extension"), "size_bytes")


def ds_distinct_texts(spark, sf_dir):
    return D.first_of_content(read(spark, sf_dir, "samples", "sample_id", "source", "text"), "text", "sample_id").select("sample_id", "source")


def ds_split(spark, sf_dir):
    files = read(spark, sf_dir, "file_records", "file_id", "repo", "relpath").where("relpath is not null and repo is not null")
    return files.select("file_id", D.split_of(F.col("relpath"), F.col("repo"), WEIGHTS).alias("split"))


def ds_manifest(spark, sf_dir):
    return (
        read(spark, sf_dir, "samples", "split", "text", "meta").groupBy("split")
        .agg(F.count(F.lit(1)).alias("samples"), F.countDistinct("meta.src_path").alias("files"), F.sum(F.length("text")).alias("characters"))
    )


def _bodies(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "documents", "doc_id", "source", "text").where("length(text) > 0")


def ds_documents(spark, sf_dir):
    s = D.document_sample(F.col("source"), F.concat("source", F.lit("/"), "doc_id"), F.col("text"))
    return _bodies(spark, sf_dir).select("doc_id", F.md5(s).alias("digest"), F.length(s).alias("characters"))


def ds_fim(spark, sf_dir):
    return D.fim_samples(_bodies(spark, sf_dir), "doc_id", "text").select("doc_id", "start_line", "middle_lines", F.md5("text").alias("digest"))


def ds_instructions(spark, sf_dir):
    commits = current(read(spark, sf_dir, "commits", "sha", "message", "diff_text", "indexed_at"), "sha", "message")
    return D.diff_instructions(commits).select("sha", "diff_lines", F.md5("text").alias("digest"))


def ds_mix(spark, sf_dir):
    rows = read(spark, sf_dir, "samples", "sample_id", F.col("meta.format").alias("format"))
    return D.quota(rows, "format", "sample_id", {"document": 0.7, "fim": 0.2, "diff_instr": 0.1}).select("sample_id", "format")


def _diffs(spark, sf_dir):
    pulls = current(read(spark, sf_dir, "pulls", "pr_number", "diff_text", "indexed_at", "deleted_at"), "pr_number").where("deleted_at is null")
    return C.diff_files(pulls, "pr_number", "diff_text")


def tc_files(spark, sf_dir):
    return _diffs(spark, sf_dir).select("pr_number", "file_index", "file_path", F.md5("block").alias("digest"))


def tc_hunks(spark, sf_dir):
    return C.hunks(_diffs(spark, sf_dir), "pr_number").select("pr_number", "file_index", "hunk_index", F.md5("hunk").alias("digest"))


def tc_summary(spark, sf_dir):
    return C.change_summary(C.line_changes(_diffs(spark, sf_dir), "pr_number"), "pr_number")


def tc_sections(spark, sf_dir):
    return C.sections(read(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text").select("doc_id", "chunk_index", "heading", F.md5("chunk").alias("digest"))


def tc_windows(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text").where("text is not null")
    return C.word_windows(docs, "doc_id", T.words(F.col("text")), 256, 32).select("doc_id", "start", F.size("words").alias("size"), F.md5(F.array_join("words", " ")).alias("digest"))


def tc_truncated(spark, sf_dir):
    changes = current(read(spark, sf_dir, "changes", "cl_number", "diff_text", "indexed_at"), "cl_number")
    return changes.where("diff_text is not null").select("cl_number", T.truncated(F.col("diff_text"), 800).alias("excerpt"), (F.length("diff_text") > 800).alias("cut"))


def fi_grep(spark, sf_dir):
    return C.matching_lines(read(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", r"(?i)\bwarn(?:ing)?\b.*=\d{3,}")


def rt_packed(spark, sf_dir):
    """Chunks of every changelist in order while they fit 3000 characters."""
    chunks = read(spark, sf_dir, "cl_chunks", "chunk_id", "cl_number", "chunk_text").where("cl_number is not null").distinct()
    return C.packed(chunks, ["cl_number"], ["chunk_id", "chunk_text"], "chunk_text", 3000).select("cl_number", "chunk_id", "used")


_INC, _EXC = any_of(INCLUDE), any_of(EXCLUDE)
_PULLS = "with p as (select * from pulls where pr_number is not null qualify row_number() over (partition by pr_number order by indexed_at desc) = 1), live as (select pr_number, diff_text from p where deleted_at is null and length(diff_text) > 0)"
_FILES = _PULLS + """, raw as (select pr_number, unnest(string_split(chr(10) || diff_text, chr(10) || 'diff --git ')) as b, generate_subscripts(string_split(chr(10) || diff_text, chr(10) || 'diff --git '), 1) as pos,
  len(string_split(chr(10) || diff_text, chr(10) || 'diff --git ')) as n from live),
files as (select pr_number, pos - 2 as file_index, regexp_extract('diff --git ' || b, '^diff --git a/\\S+ b/(\\S+)', 1) as file_path, 'diff --git ' || b || case when pos < n then chr(10) else '' end as block from raw where pos > 1)
"""
_FRACTION = "cast(('0x' || substr(sha256(repo || ':' || relpath), 1, 16))::ubigint as double) / 18446744073709551616.0"

QUERIES = {f.__name__: f for f in (ds_filtered, ds_distinct_texts, ds_split, ds_manifest, ds_documents, ds_fim, ds_instructions, ds_mix, tc_files, tc_hunks, tc_summary, tc_sections, tc_windows, tc_truncated, fi_grep, rt_packed)}
SQL = {
    "ds_filtered": f"""select file_id, e as extension, size_bytes from (select *, lower(regexp_extract(relpath, '[^/.][^/]*\\.([^./]+)$', 1)) as e from file_records)
where size_bytes between 300 and 40000 and e not in ('lock', 'snap', 'map') and regexp_matches(relpath, '{_INC}') and not regexp_matches(relpath, '{_EXC}')""",
    "ds_distinct_texts": "select sample_id, source from (select *, row_number() over (partition by sha256(text) order by sample_id) as r from samples where text is not null) where r = 1 union all select sample_id, source from samples where text is null",
    "ds_split": f"select file_id, case when x < 0.8 then 'train' when x < 0.9 then 'val' else 'test' end as split from (select file_id, {_FRACTION} as x from file_records where relpath is not null and repo is not null)",
    "ds_manifest": "select split, count(*) as samples, count(distinct meta.src_path) as files, cast(sum(length(text)) as bigint) as characters from samples group by 1",
    "ds_documents": "select doc_id, md5(s) as digest, length(s) as characters from (select doc_id, '<|repo_name|>' || source || chr(10) || '<|file_sep|>' || source || '/' || doc_id || chr(10) || text as s from documents where length(text) > 0)",
    "ds_fim": """with a as (select doc_id, string_split(text, chr(10)) as l from documents where length(text) > 0), b as (select *, len(l) as n from a where len(l) >= 3),
c as (select *, 1 + ('0x' || substr(sha256('0:' || doc_id || ':len'), 1, 7))::bigint % (n - 2) as m from b),
d as (select *, 1 + ('0x' || substr(sha256('0:' || doc_id || ':at'), 1, 7))::bigint % (n - 1 - m) as s from c)
select doc_id, s as start_line, m as middle_lines, md5('<|fim_prefix|>' || array_to_string(l[1:s], chr(10)) || chr(10) || '<|fim_suffix|>' || array_to_string(l[s + m + 1:n], chr(10)) || '<|fim_middle|>' || array_to_string(l[s + 1:s + m], chr(10)) || chr(10)) as digest from d""",
    "ds_instructions": """with c as (select * from commits where sha is not null qualify row_number() over (partition by sha order by indexed_at desc, message desc nulls last) = 1),
d as (select sha, split_part(message, chr(10), 1) as s, diff_text, len(string_split(diff_text, chr(10))) as n from c where message is not null and length(diff_text) > 0)
select sha, n as diff_lines, md5('<|im_start|>user' || chr(10) || s || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || diff_text || '<|im_end|>') as digest from d where length(s) between 12 and 200 and n between 2 and 400""",
    "ds_mix": """with r as (select sample_id, meta.format as format from samples where meta.format in ('document', 'fim', 'diff_instr')),
w as (select * from (values ('document', 0.7::double), ('fim', 0.2::double), ('diff_instr', 0.1::double)) t(format, share)),
t as (select floor(min(have / share)) as total from (select format, count(*) as have from r group by 1) join w using (format))
select sample_id, format from (select r.*, share, row_number() over (partition by format order by sha256(cast(sample_id as varchar)), sample_id) as k from r join w using (format)), t where k <= floor(total * share)""",
    "tc_files": _FILES + "select pr_number, file_index, file_path, md5(block) as digest from files",
    "tc_hunks": _FILES
    + """, h as (select pr_number, file_index, unnest(string_split(block, chr(10) || '@@ ')) as b, generate_subscripts(string_split(block, chr(10) || '@@ '), 1) as pos, len(string_split(block, chr(10) || '@@ ')) as n from files)
select pr_number, file_index, pos - 2 as hunk_index, md5('@@ ' || b || case when pos < n then chr(10) else '' end) as digest from h where pos > 1""",
    "tc_summary": _FILES
    + """, l as (select pr_number, file_index, file_path, list_filter(string_split(block, chr(10)), lambda x: not starts_with(x, '+++ ') and not starts_with(x, '--- ')) as ls from files),
n as (select pr_number, file_index, file_path, len(list_filter(ls, lambda x: starts_with(x, '+'))) as added, len(list_filter(ls, lambda x: starts_with(x, '-'))) as deleted from l)
select pr_number, count(distinct file_path) as files, cast(sum(added) as bigint) as added, cast(sum(deleted) as bigint) as deleted, string_agg(file_path || ' (+' || added || ' -' || deleted || ')', chr(10) order by file_index) as summary from n group by 1""",
    "tc_sections": """with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as n, len(string_split(text, chr(10))) as all_n from documents where length(text) > 0),
s as (select *, sum(case when regexp_matches(line, '^#{1,6}[ \\t]+\\S') then 1 else 0 end) over (partition by doc_id order by n) as sec from l),
b as (select doc_id, sec, string_agg(line, chr(10) order by n) || case when max(n) < any_value(all_n) then chr(10) else '' end as body from s group by 1, 2),
c as (select doc_id, sec, trim(regexp_extract(body, '^#{1,6}[ \\t]+([^\\n]*)', 1)) as heading, body, unnest(range(0, greatest(1, cast(ceil(length(body) / 2000.0) as bigint)))) as piece from b),
d as (select doc_id, sec, piece, heading, substr(body, piece * 2000 + 1, 2000) as chunk from c)
select doc_id, row_number() over (partition by doc_id order by sec, piece) - 1 as chunk_index, heading, md5(chunk) as digest from d where regexp_matches(chunk, '\\S')""",
    "tc_windows": """with w as (select doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as w from documents where text is not null), s as (select doc_id, w, unnest(range(0, greatest(1, cast(ceil((len(w) - 32) / 224.0) as bigint)))) * 224 as start from w where len(w) > 0)
select doc_id, start, len(w[start + 1:start + 256]) as size, md5(array_to_string(w[start + 1:start + 256], ' ')) as digest from s""",
    "tc_truncated": """with c as (select * from changes where cl_number is not null qualify row_number() over (partition by cl_number order by indexed_at desc) = 1)
select cl_number, case when length(diff_text) <= 800 then diff_text else left(diff_text, 800) || chr(10) || chr(10) || '[...truncated; full diff is ' || length(diff_text) || ' chars]' end as excerpt, length(diff_text) > 800 as cut from c where diff_text is not null""",
    "fi_grep": """select doc_id, line_no, line from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as line_no from documents where length(text) > 0) where regexp_matches(line, '(?i)\\bwarn(?:ing)?\\b.*=\\d{3,}')""",
    "rt_packed": """select cl_number, chunk_id, used from (select cl_number, chunk_id, sum(length(coalesce(chunk_text, ''))) over (partition by cl_number order by chunk_id, chunk_text nulls first rows unbounded preceding) as used
  from (select distinct chunk_id, cl_number, chunk_text from cl_chunks where cl_number is not null)) where used <= 3000""",
}
