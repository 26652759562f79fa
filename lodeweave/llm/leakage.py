"""Evaluation passages inside a corpus: broadcast n-gram set, window scan, verified hits.

Passages and documents are normalised alike (compatibility forms, case, quotes,
joiners and marks dropped) and cut into words. The n-grams of the passages that
belong to one item only form a hash set, which every task gets; its size is checked
and beyond BROADCAST_NGRAMS the same hits come from a join on the hash instead. A
document is scanned once, all its token windows against the set. Each (document,
item) pair with hits is verified sentence by sentence: the words of the sentence
must stand in the document in order, at the place the hits point to, but for a tenth
or so; the sentences found must themselves keep the order of the passage. A document
gives an item away when such sentences, two at least, hold a quarter of the words of
the passage. Sentences that several items share count for nothing.

Leaked spans are cut out of the text as it is written, whatever its typography; a
document that is mostly passages is left out whole.

Null or empty texts and passages give no rows, null ids are skipped, repeated rows
give one row. One hit is enough to look at a pair; a passage shorter than an n-gram
has none, and as a single sentence it would be no case. Other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodeweave.session import materialize, read

from .shingles import WordHashes, windows

NGRAM = 5
SHARE = 0.25
SENTENCE_SHARE = 0.7  # words of a sentence that must be there
CLOSE_SENTENCE = 0.8  # and of one that counts as close
UNCHANGED = 0.85  # words of all sentences found
BROADCAST_NGRAMS = 2_000_000
TOKEN = re.compile(r"\w+")
DROPPED = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
END = re.compile(r"(?<=[.!?])\s+")


def normal(text: str) -> str:
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", text).translate(DROPPED)
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(normal(text)) if text else []


def token_places(text: str) -> list[tuple[int, int]]:
    """Where the tokens of a text stand in the text as it is written: (start, end) in characters, one for each of tokens(text)."""
    if text.isascii():
        return [m.span() for m in TOKEN.finditer(text)]
    letters, places = [], []
    for at, c in enumerate(text):
        for x in unicodedata.normalize("NFKD", c).translate(DROPPED):
            if not unicodedata.combining(x):
                letters.append(x)
                places.append(at)
    low = "".join(letters).lower()
    if len(low) != len(letters):
        places = [at for x, at in zip(letters, places) for _ in x.lower()]
    return [(places[m.start()], places[m.end() - 1] + 1) for m in TOKEN.finditer(low)]


class Passage(NamedTuple):
    item: int
    words: list[str]
    sentences: list[tuple[int, int]]  # word spans
    counted: list[bool]  # not shared with another item


def passages(rows: list[tuple[int, str]]) -> list[Passage]:
    """The passages of distinct items with their sentences; a sentence of several items is not counted."""
    out, seen = [], Counter()
    split: dict[int, list[list[str]]] = {}
    for item, text in sorted(dict(rows).items()):
        split[item] = [t for s in END.split(text or "") if (t := tokens(s))]
        seen.update({" ".join(s) for s in split[item]})
    for item, sentences in split.items():
        spans, at = [], 0
        for s in sentences:
            spans.append((at, at + len(s)))
            at += len(s)
        if at:
            out.append(Passage(item, [w for s in sentences for w in s], spans, [seen[" ".join(s)] == 1 for s in sentences]))
    return out


class Index(NamedTuple):
    hashes: np.ndarray  # sorted, one item each
    item: np.ndarray  # number of the passage
    at: np.ndarray  # word position


def ngram_index(items: list[Passage], n: int = NGRAM) -> Index:
    """The n-grams that one item alone has, at their first place in it."""
    flat = np.array([xxhash.xxh64_intdigest(w) for p in items for w in p.words], dtype=np.uint64)
    h, owner, at = windows(flat, np.array([len(p.words) for p in items], dtype=np.int64), n)
    order = np.lexsort((at, owner, h))
    h, owner, at = h[order], owner[order], at[order]
    if not len(h):
        return Index(h, owner, at)
    first = np.concatenate(([True], h[1:] != h[:-1]))
    group = np.cumsum(first) - 1
    same = np.zeros(group[-1] + 1, dtype=bool)
    lo = np.full(len(same), np.iinfo(np.int64).max)
    hi = np.full(len(same), -1)
    np.minimum.at(lo, group, owner)
    np.maximum.at(hi, group, owner)
    same = lo == hi
    keep = first & same[group]
    return Index(h[keep], owner[keep], at[keep])


def common_words(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def matched_ends(a: list[str], b: list[str]) -> tuple[int, int]:
    """First and last place in b (end exclusive) of a longest common subsequence, the shortest stretch where there are several."""
    rows = [[0] * (len(b) + 1)]
    for x in a:
        last, row = rows[-1], [0]
        for j, y in enumerate(b, 1):
            row.append(last[j - 1] + 1 if x == y else max(last[j], row[-1]))
        rows.append(row)
    i, j = len(a), len(b)
    while j and rows[i][j - 1] == rows[i][j]:
        j -= 1
    end = start = j
    while i and j and rows[i][j]:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            start = j
        elif rows[i - 1][j] >= rows[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return start, end


def verified(p: Passage, words: list[str], hits: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(sentence, from, to, words of it, words matched) found in the document, in the order of the passage; hits are (passage, document) positions."""
    candidates = []
    for k, (a, b) in enumerate(p.sentences):
        if not p.counted[k]:
            continue
        starts = sorted({d - (q - a) for q, d in hits if a - NGRAM < q < b})
        places: list[int] = []
        for s in starts:
            if not places or s - places[-1] > (b - a) // 2 + 2:
                places.append(s)
        for s in places:
            slack = 3 + (b - a) // 5
            lo, hi = max(0, s - slack), min(len(words), s + (b - a) + slack)
            matched = common_words(p.words[a:b], words[lo:hi])
            if matched >= SENTENCE_SHARE * (b - a):
                candidates.append((s, k, b - a, matched, lo, hi))
    # heaviest chain with rising sentence numbers and rising places
    candidates.sort()
    best: list[tuple[int, list[int]]] = []
    for i, (_, k, weight, *_) in enumerate(candidates):
        top = max(((w, chain) for (w, chain) in best if candidates[chain[-1]][1] < k), default=(0, []), key=lambda x: x[0])
        best.append((top[0] + weight, [*top[1], i]))
    chain = max(best, default=(0, []), key=lambda x: x[0])[1]
    out = []
    for _, k, size, matched, lo, hi in (candidates[i] for i in chain):
        a, b = p.sentences[k]
        first, last = matched_ends(p.words[a:b], words[lo:hi])
        out.append((k, lo + first, lo + last, size, matched))
    return out


def can_leak(p: Passage, hits: list[tuple[int, int]]) -> bool:
    """Whether the sentences that hits point to could give the item away if all of them were found: two at least, of a quarter of the passage."""
    at = [q for q, _ in hits]
    sizes = [b - a for k, (a, b) in enumerate(p.sentences) if p.counted[k] and any(a - NGRAM < q < b for q in at)]
    return len(sizes) >= 2 and sum(sizes) >= SHARE * len(p.words)


def judge(p: Passage, words: list[str], hits: list[tuple[int, int]]) -> tuple | None:
    """(item, share of the passage, share of the words unchanged, close sentences, word spans), None when nothing is found."""
    found = verified(p, words, hits)
    if not found:
        return None
    size = sum(n for *_, n, _ in found)
    close = sum(m >= CLOSE_SENTENCE * n for *_, n, m in found)
    return p.item, size / len(p.words), sum(m for *_, m in found) / size, close, [x[1] for x in found], [x[2] for x in found]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 7
    types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=["doc_id", "item_id", "share", "unchanged", "close", "word_from", "word_to"])


def _scan(items: list[Passage], index: Index, leaks_only: bool):
    def run(batches):
        cache = WordHashes()
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            words = [tokens(t) for t in texts]
            counts = np.array([len(w) for w in words], dtype=np.int64)
            flat = np.fromiter((cache[w] for ws in words for w in ws), dtype=np.uint64, count=int(counts.sum()))
            h, owner, at = windows(flat, counts, NGRAM)
            rows = []
            if len(h) and len(index.hashes):
                place = np.minimum(np.searchsorted(index.hashes, h), len(index.hashes) - 1)
                hit = index.hashes[place] == h
                pairs: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
                for d, i, q, o in zip(owner[hit].tolist(), index.item[place[hit]].tolist(), index.at[place[hit]].tolist(), at[hit].tolist()):
                    pairs[d, i].append((q, o))
                for (d, i), hits in pairs.items():
                    if leaks_only and not can_leak(items[i], hits):
                        continue
                    if verdict := judge(items[i], words[d], hits):
                        rows.append((docs[d], *verdict))
            yield _rows(rows)

    return run


SCHEMA = "doc_id bigint, item_id bigint, share double, unchanged double, close int, word_from array<int>, word_to array<int>"


def _by_join(documents: DataFrame, items: DataFrame, leaks_only: bool) -> DataFrame:
    """The same pairs when the n-grams are too many for every task: hits by join, verified per document and item."""
    spark = documents.sparkSession

    def grams(batches):
        cache = WordHashes()
        for batch in batches:
            words = [tokens(t) for t in batch.column(1).to_pylist()]
            counts = np.array([len(w) for w in words], dtype=np.int64)
            flat = np.fromiter((cache[w] for ws in words for w in ws), dtype=np.uint64, count=int(counts.sum()))
            h, owner, at = windows(flat, counts, NGRAM)
            ids = np.array(batch.column(0).to_pylist(), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), pa.array(ids[owner]), pa.array(at.astype(np.int32))], names=["h", "id", "at"])

    texts = items.where("item_id is not null and length(passage) > 0").select(F.col("item_id").alias("id"), F.col("passage").alias("text"))
    own = texts.mapInArrow(grams, "h bigint, id bigint, at int").groupBy("h").agg(F.min("id").alias("item_id"), F.max("id").alias("other"), F.min("at").alias("q")).where("item_id = other").drop("other")
    seen = documents.select("doc_id", "text").mapInArrow(grams, "h bigint, id bigint, at int").withColumnRenamed("id", "doc_id")
    hits = seen.join(own, "h").groupBy("doc_id", "item_id").agg(F.collect_list(F.struct("q", "at")).alias("hits"))
    def normalised(batches):
        for batch in batches:
            ids, found = batch.column(0).to_pylist(), [{" ".join(t) for s in END.split(x) if (t := tokens(s))} for x in batch.column(1).to_pylist()]
            pairs = [(i, s) for i, ss in zip(ids, found) for s in ss]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in pairs], pa.int64()), pa.array([s for _, s in pairs], pa.string())], names=["id", "s"])

    sentences = texts.mapInArrow(normalised, "id bigint, s string").distinct()
    several = sentences.groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("s")
    stock = sentences.join(several, "s", "left_semi").groupBy("id").agg(F.collect_set("s").alias("stock"))
    rows = hits.join(documents.select("doc_id", "text"), "doc_id").join(texts.withColumnRenamed("text", "passage").withColumnRenamed("id", "item_id"), "item_id").join(stock.withColumnRenamed("id", "item_id"), "item_id", "left")

    def verify(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                p = passages([(r["item_id"], r["passage"])])[0]
                shared = set(r["stock"] or [])
                p = p._replace(counted=[" ".join(p.words[a:b]) not in shared for a, b in p.sentences])
                hits = [(x["q"], x["at"]) for x in r["hits"]]
                if leaks_only and not can_leak(p, hits):
                    continue
                if verdict := judge(p, tokens(r["text"]), hits):
                    out.append((r["doc_id"], *verdict))
            yield _rows(out)

    return rows.mapInArrow(verify, SCHEMA)


def passage_hits(documents: DataFrame, items: DataFrame, broadcast_ngrams: int = BROADCAST_NGRAMS, leaks_only: bool = False) -> DataFrame:
    """(doc_id, item_id, share, unchanged, close, word_from, word_to) for every document that holds a counted sentence of an item.

    With leaks_only, pairs that cannot be leaks whatever is found are not verified; leaks() of the rows is the same.
    """
    documents = documents.where("doc_id is not null and length(text) > 0")
    words = items.agg(F.coalesce(F.sum(F.size(F.split("passage", r"\s+"))), F.lit(0))).first()[0]
    if words > broadcast_ngrams:
        return _by_join(documents, items, leaks_only)
    rows = [(r["item_id"], r["passage"]) for r in items.select("item_id", "passage").where("item_id is not null and passage is not null").collect()]
    known = passages(rows)
    return documents.select("doc_id", "text").mapInArrow(_scan(known, ngram_index(known), leaks_only), SCHEMA)


def leaks(hits: DataFrame) -> DataFrame:
    """The hits that give an item away: a quarter of the passage, nearly unchanged, in two close sentences at least."""
    return hits.where((F.col("share") >= SHARE) & (F.col("unchanged") >= UNCHANGED) & (F.col("close") >= 2))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text less the given spans of tokens; all else stays as it is written, and spans may overlap."""
    marks = token_places(text)
    out, at = [], 0
    for a, b in sorted(spans):
        a, b = max(0, a), min(b, len(marks))
        if a < b:
            if marks[a][0] > at:
                out.append(text[at : marks[a][0]])
            at = max(at, marks[b - 1][1])
    return "".join([*out, text[at:]])


def without_passages(documents: DataFrame, leaked: DataFrame, most: float = 0.5) -> DataFrame:
    """documents(doc_id, text) less the passages of leaked(doc_id, item_id, word_from, word_to).

    (doc_id, text, items, words, words_removed): the leaked spans of all items are cut out of the text as it is written; a
    document of which more than `most` of the words would go is left out whole, and its text is null. Documents that give
    nothing away come through unchanged with no items. The spans of a document are as many as its leaked sentences.
    """
    spans = leaked.select("doc_id", "item_id", F.explode(F.arrays_zip("word_from", "word_to")).alias("s")).groupBy("doc_id").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"), F.array_sort(F.collect_set(F.struct(F.col("s.word_from").alias("a"), F.col("s.word_to").alias("b")))).alias("spans")
    )

    def cut(batches):
        for batch in batches:
            rows = []
            for doc, text, items, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "items", "spans"))):
                if not found or not text:
                    rows.append((doc, text, items or [], len(tokens(text)), 0))
                    continue
                words = len(token_places(text))
                gone = len(set().union(*(range(x["a"], min(x["b"], words)) for x in found)))
                rows.append((doc, None if gone > most * words else without_spans(text, [(x["a"], x["b"]) for x in found]), items, words, gone))
            cols = list(zip(*rows)) or [()] * 5
            types = (pa.int64(), pa.string(), pa.list_(pa.int64()), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=["doc_id", "text", "items", "words", "words_removed"])

    whole = documents.where("doc_id is not null").select("doc_id", "text").join(spans, "doc_id", "left").select("doc_id", "text", "items", "spans")
    return whole.mapInArrow(cut, "doc_id bigint, text string, items array<bigint>, words bigint, words_removed bigint")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = passage_hits(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "eval_items", "item_id", "passage"), leaks_only=True)
    return leaks(hits).select("doc_id", "item_id").distinct()


def p7_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that gave items away, less the passages: words before, words removed, what is left as a digest (null: left out whole)."""
    documents = read(spark, sf_dir, "documents", "doc_id", "text")
    leaked = leaks(passage_hits(documents, read(spark, sf_dir, "eval_items", "item_id", "passage"), leaks_only=True))
    clean = without_passages(documents, materialize(leaked, "leaks")).where(F.size("items") > 0)
    return clean.select("doc_id", F.size("items").alias("items"), "words", "words_removed", F.md5(F.col("text").cast("binary")).alias("digest"))
