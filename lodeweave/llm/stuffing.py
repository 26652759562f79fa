"""Keyword-stuffed pages and link lists, by rank-frequency curves.

A page is cut into lines and sentences. Lines of marks (code, settings, log and table
rows, headings) are set aside: a page that is mostly such lines is no case. What
remains is running text; a link counts as one word, a tag as another. One Arrow pass
reads the pages and writes their words with counts; a second one reduces those to the
frequency spectrum (how many words occur how often) and to the divergence
(Kullback-Leibler) from the prose of its languages over three bins: the
head words of the languages, links and tags, all others. SQL windows turn the spectrum
into ranks and fit log frequency against log rank; slope, residual and divergence are
set against the median page of prose of the same language and a comparable length.

The curves decide. A divergence well beyond that of a page of which one half is prose
makes a case; one well below makes none, unless slope or residual are extreme. In
between, and for the latter, a count breaks the tie: the share of the text that
stands in keyword runs, bare links or tags must be more than half.

Head words are counted over the running text of all pages and bounded per language
(HEAD words, at most 26*26 languages), which bounds what the tasks are handed. Spectra
are a few rows a page whatever its length. Null and empty texts, and texts under
MIN_WORDS words, are no cases; a null or odd lang is replaced by the nearest language;
ids that are null are skipped, repeated rows give one row, other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lodeweave.session import discard, materialize, read

HEAD = 60
MIN_WORDS = 20
SPAM_SHARE = 0.5  # of the text in a tie
MARKED_SHARE = 0.5  # of the text in lines of marks, beyond which a page is no page of words
CERTAIN, DOUBTFUL = 1.6, 0.6  # divergence over that of a page of which one half is prose
EXTREME = 6.0  # deviations of slope and residual from the median page of prose
LETTERS = re.compile(r"[^\W\d_]+")

URL = r"(?:https?://|www\.)[^\s\"'<>|)\]]+"
LINK = re.compile(rf"<a\s[^>]*>(.*?)</a>|\[([^\]]*)\]\({URL}\)|{URL}", re.S | re.I)
LINKED = re.compile(r"://|www\.|<a\s", re.I)
HASHTAG = re.compile(r"(?<!\S)#\w+[,;|]?")
TAG = re.compile(r"(?<!\S)#(?=\w)")
SENTENCE = re.compile(r"(?<=[.!?])\s+")
HARD = re.compile(r"[_{}()=<>`\"\[\]\\$]|\d{1,2}:\d{2}|::|->|;\s*$")
HARD_WORD = re.compile(rf"(?<!\S)\S*?(?:{HARD.pattern})\S*")
LEAD = re.compile(r"\s*(?:#{1,6}\s|//|--\s|%|@@|\|)")
PLAIN_NOT = re.compile(r"[_{}()=<>`\"\[\]\\$#|%@/;]|:[\d:]|-[>-]|www\.", re.I)  # a line without any of these is words alone
HARD_SHARE = 1 / 8  # words with marks in a line of marks
LINK_WORD, TAG_WORD = "://", "#"


def language(lang: str | None) -> str:
    code = (lang or "").strip().lower()[:2]
    return code if re.fullmatch(r"[a-z]{2}", code) and (lang or "").lower() != "und" else ""


class Running(NamedTuple):
    words: list[str]
    marked: float  # share of the text in lines of marks


def running(text: str) -> Running:
    """The words of the running text in lower case, a link and a tag as one word each; lines of marks are left out."""
    words: list[str] = []
    marked = total = 0
    for line in text.split("\n"):
        size = len(line.strip())
        if not size:
            continue
        total += size
        if not PLAIN_NOT.search(line):
            words += LETTERS.findall(line.lower())
            continue
        for piece in SENTENCE.split(line):
            links = 0
            if LINKED.search(piece):
                links = sum(1 for _ in LINK.finditer(piece))
                bare = LINK.sub(lambda m: f" {m.group(1) or m.group(2) or ''} ", piece)
            else:
                bare = piece
            bare, tags = TAG.subn(" ", bare) if "#" in bare else (bare, 0)
            plain, hard = HARD_WORD.subn(" ", bare) if HARD.search(bare) else (bare, 0)
            if (not links and not tags and LEAD.match(piece)) or (hard and hard >= (len(plain.split()) + hard + 8 * links + tags) * HARD_SHARE):
                marked += len(piece.strip())
                continue
            words += LETTERS.findall(plain.lower())
            words += [LINK_WORD] * links + [TAG_WORD] * tags
    return Running(words, marked / total if total else 0.0)


# ---- words of all pages ----------------------------------------------------------------------

COUNTS = "array<struct<w: string, c: int>>"
SLICE = 1000  # pages whose words are in memory at once


def _word_batches(batches):
    for batch in (part.slice(at, SLICE) for part in batches for at in range(0, part.num_rows, SLICE)):
        sizes, marks, ends, flat, times = [], [], [0], [], []
        texts = batch.column("text").to_pylist()
        for text in texts:
            words, marked = running(text)
            counts = Counter(words)
            flat += counts.keys()
            times += counts.values()
            ends.append(len(flat))
            sizes.append(len(words))
            marks.append(marked)
        pairs = pa.StructArray.from_arrays([pa.array(flat, pa.string()), pa.array(times, pa.int32())], names=["w", "c"])
        # the text itself is asked for again only where a page can be a case
        texts = pa.array([t if n >= MIN_WORDS and m <= MARKED_SHARE else None for t, n, m in zip(texts, sizes, marks)], pa.string())
        langs = pa.array(map(language, batch.column("lang").to_pylist()), pa.string())
        columns = [batch.column("doc_id"), langs, texts, pa.array(sizes, pa.int32()), pa.array(marks, pa.float64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang", "text", "words", "marked", "counts"])


def page_words(documents: DataFrame) -> DataFrame:
    """documents(doc_id, text, lang) -> (doc_id, lang, text, words, marked, counts), written: the running text is cut into words once."""
    pages = documents.where("length(text) > 0").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    return materialize(pages.mapInArrow(_word_batches, f"doc_id bigint, lang string, text string, words int, marked double, counts {COUNTS}"), "words")


# ---- head words of each language -------------------------------------------------------------


class Prose(NamedTuple):
    owner: dict[str, str]  # head word -> the language in which it is most widespread
    mass: dict[str, float]  # language -> share of head words in its running text
    links: dict[str, float]  # language -> share of links and tags


def head_words(pages: DataFrame, head: int = HEAD) -> Prose:
    """The `head` most widespread words of each language and how often prose has them; the size is bounded by its parameters."""
    told = pages.where("lang <> ''")
    words = told.select("lang", F.explode("counts").alias("x")).select("lang", F.col("x.w").alias("word"), F.col("x.c").alias("times")).where("length(word) <= 12")
    pages_and_times = F.count(F.lit(1)).alias("pages"), F.sum("times").alias("times")
    total = words.groupBy("lang", "word").agg(*pages_and_times).unionByName(
        told.select("lang", F.lit("").alias("word"), F.col("words").alias("times")).groupBy("lang", "word").agg(*pages_and_times)
    )
    special = F.col("word").isin("", LINK_WORD, TAG_WORD)
    order = Window.partitionBy("lang").orderBy(F.desc(special), F.desc("pages"), "word")
    rows = total.withColumn("r", F.row_number().over(order)).where((F.col("r") <= head) | special).collect()  # so many rows a language
    size = {r["lang"]: (r["pages"], r["times"]) for r in rows if r["word"] == ""}
    most = max((pages for pages, _ in size.values()), default=0)
    kept = {lang for lang, (pages, times) in size.items() if pages >= max(2, most / 1000) and times}
    best: dict[str, tuple[float, str]] = {}
    for r in rows:
        if r["lang"] in kept and r["word"] not in ("", LINK_WORD, TAG_WORD):
            best[r["word"]] = max(best.get(r["word"], (0.0, "")), (r["pages"] / size[r["lang"]][0], r["lang"]))
    share = lambda words: {lang: sum(r["times"] for r in rows if r["lang"] == lang and words(r["word"])) / size[lang][1] for lang in kept}
    return Prose({w: lang for w, (_, lang) in best.items()}, share(lambda w: w not in ("", LINK_WORD, TAG_WORD)), share(lambda w: w in (LINK_WORD, TAG_WORD)))


# ---- one page --------------------------------------------------------------------------------


def relative_entropy(q: tuple[float, ...], p: tuple[float, ...]) -> float:
    """Divergence of the bins p of a page from the bins q of prose, both kept away from zero."""
    clip = lambda xs: [max(x, 0.002) for x in xs]
    q, p = clip(q), clip(p)
    return sum(a / sum(q) * math.log(a / sum(q) / (b / sum(p))) for a, b in zip(q, p))


def divergence(counts: Counter, n: int, prose: Prose) -> tuple[str, float, float, float]:
    """(language, head mass, divergence, the same over that of a page of which one half is prose); a mixed page has mixed prose."""
    by_language: Counter = Counter()
    for w, c in counts.items():
        if lang := prose.owner.get(w):
            by_language[lang] += c
    hits = sum(by_language.values())
    code = max(by_language, key=lambda c: (by_language[c], c), default=max(prose.mass, key=lambda c: (prose.mass[c], c), default=""))
    if not code:
        return "", 0.0, 0.0, 0.0
    mixed = lambda of: sum(of[c] * k for c, k in by_language.items()) / hits if hits else of[code]
    usual, linked = mixed(prose.mass), mixed(prose.links)
    q = (usual, linked, max(0.0, 1 - usual - linked))
    mass, links = hits / n, (counts[LINK_WORD] + counts[TAG_WORD]) / n
    # more head words than usual, or fewer links, is no sign of keywords
    p = (min(mass, usual), max(links, linked), 0.0)
    p = (p[0], p[1], max(0.0, 1 - p[0] - p[1]))
    half = relative_entropy(q, (usual / 2, linked, 1 - usual / 2 - linked))
    d = relative_entropy(q, p)
    return code, mass, d, d / half if half > 0 else 0.0


FOREIGN_LINKED = re.compile(r"[_{}()=`\[\]\\$]")
FOREIGN = re.compile(r"[_{}()=<>`\"\[\]\\$]|\d{1,2}:\d{2}|^\s*(?:#{1,6}|//|--|%)\s|^\s*[+@]")
PIECE = re.compile(r"(?<=[.!?])[\s ]+|\n+")


def spam_share(text: str, prose_words) -> float:
    """Share of the text in keyword runs, bare links and product tags; links with an account of them are none."""
    words_all = [w.lower() for w in LETTERS.findall(LINK.sub(lambda m: f" {m.group(1) or m.group(2) or ''} ", text))]
    counts = Counter(words_all)
    least = max(4, len(words_all) / 80)
    dominant = {w for w, c in counts.items() if c >= least and w not in prose_words}
    spam = total = 0
    for piece in PIECE.split(text):
        size = len(piece.strip())
        if not size:
            continue
        total += size
        bare = LINK.sub(" ", piece)
        links = sum(1 for _ in LINK.finditer(piece)) if len(bare) != len(piece) else 0
        tags = HASHTAG.findall(bare)
        rest = HASHTAG.sub(" ", bare) if tags else bare
        if FOREIGN_LINKED.search(rest) if links else FOREIGN.search(rest):
            continue
        words = [w.lower() for w in LETTERS.findall(rest)]
        known = sum(w in prose_words for w in words)
        often = sum(w in dominant for w in words)
        if words and often * 3 >= len(words):
            spam += size  # keywords over and over, in a list or dressed as sentences
        elif links or len(tags) >= 2 or (tags and not words):
            if known * 6 <= len(words) or len(words) <= 5 * links:
                spam += size  # links without an account, tags
        elif words and not known and len(words) <= 5 and not re.search(r"[.!?:,]$", piece.strip()):
            spam += size  # a bare phrase on a line of its own
        elif words and known * 6 <= len(words):
            separators = len(re.findall(r"[,;/|•·]", rest))
            if separators >= 2 and separators * 6 >= len(words):
                spam += size  # names in a row
    return spam / total if total else 0.0


def _page_batches(prose: Prose):
    def run(batches):
        for batch in (part.slice(at, SLICE) for part in batches for at in range(0, part.num_rows, SLICE)):
            out: list[list] = [[] for _ in range(9)]
            lists = batch.column("counts")
            flat, ends = lists.flatten(), lists.offsets.to_pylist()
            words, times = flat.field("w").to_pylist(), flat.field("c").to_pylist()
            for i, (doc, text, n, marked) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "words", "marked")))):
                own = slice(ends[i] - ends[0], ends[i + 1] - ends[0])
                counts = Counter(dict(zip(words[own], times[own])))
                code, mass, d, ratio = divergence(counts, n, prose)
                spectrum = sorted(Counter(counts.values()).items(), reverse=True)
                top = max((c for w, c in counts.items() if w not in prose.owner), default=0)
                # the count can matter only between the limits, or where some word repeats enough to bend the curve
                tie = ratio < CERTAIN and (ratio >= DOUBTFUL or top * 25 >= n)
                share = spam_share(text, prose.owner) if tie else 0.0
                for column, value in zip(out, (doc, code, n, marked, mass, d, ratio, share, [{"f": f, "c": c} for f, c in spectrum])):
                    column.append(value)
            types = (pa.int64(), pa.string(), pa.int32(), *[pa.float64()] * 5, pa.list_(pa.struct([("f", pa.int32()), ("c", pa.int32())])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["doc_id", "lang", "words", "marked", "mass", "divergence", "ratio", "share", "spectrum"])

    return run


# ---- curves ----------------------------------------------------------------------------------


def curves(pages: DataFrame) -> DataFrame:
    """pages(doc_id, ..., spectrum) -> the same rows with slope and residual of log frequency against log rank; one shuffle by doc_id."""
    kept = [c for c in pages.columns if c not in ("doc_id", "spectrum")]
    points = pages.select("doc_id", *kept, F.explode("spectrum").alias("s")).select("doc_id", *kept, F.col("s.f").alias("f"), F.col("s.c").alias("c"))
    w = Window.partitionBy("doc_id").orderBy(F.desc("f")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = points.withColumn("last", F.sum("c").over(w)).withColumn("first", F.col("last") - F.col("c") + 1)
    x, y, c = F.log(F.sqrt(F.col("first") * F.col("last"))), F.log("f"), F.log1p("c")
    s = ranked.select("doc_id", *kept, x.alias("_x"), y.alias("_y"), c.alias("_w")).groupBy("doc_id").agg(
        *[F.first(k).alias(k) for k in kept],
        F.sum("_w").alias("sw"), F.sum(F.expr("_w * _x")).alias("sx"), F.sum(F.expr("_w * _y")).alias("sy"),
        F.sum(F.expr("_w * _x * _x")).alias("sxx"), F.sum(F.expr("_w * _x * _y")).alias("sxy"), F.sum(F.expr("_w * _y * _y")).alias("syy"),
    )
    vx, vxy, vy = F.expr("sxx - sx * sx / sw"), F.expr("sxy - sx * sy / sw"), F.expr("syy - sy * sy / sw")
    slope = F.when(vx > 1e-9, vxy / vx).otherwise(0.0)
    return s.select("doc_id", *kept, slope.alias("slope"), F.sqrt(F.greatest(F.lit(0.0), (vy - slope * vxy) / F.col("sw"))).alias("residual"))


def deviations(scored: DataFrame) -> DataFrame:
    """Adds the distance of slope, residual and divergence from prose of the language and length, in robust deviations.

    Prose are the pages whose divergence is below DOUBTFUL of that of a page of which one half is prose.
    """
    keyed = scored.withColumn("bucket", F.floor(F.log2("words")))
    prose, measures = keyed.where(F.col("ratio") < DOUBTFUL), ("slope", "residual", "divergence")
    for tag, keys in {"b": ["lang", "bucket"], "l": ["lang"]}.items():
        quartiles = prose.groupBy(*keys).agg(
            F.count(F.lit(1)).alias(f"{tag}_n"),
            *[F.percentile_approx(m, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"{tag}_{m}") for m in measures],
        )
        keyed = keyed.join(F.broadcast(quartiles), keys, "left")  # at most languages times 64 lengths
    for m in measures:
        quartile = F.when(F.col("b_n") >= 50, F.col(f"b_{m}")).otherwise(F.col(f"l_{m}"))
        spread = F.greatest((quartile[2] - quartile[0]) * F.lit(0.7413), F.lit(0.01))
        keyed = keyed.withColumn(f"z_{m}", F.coalesce((F.col(m) - quartile[1]) / spread, F.lit(0.0)))
    return keyed.select(*scored.columns, *[f"z_{m}" for m in measures])


def score_pages(documents: DataFrame) -> DataFrame:
    """documents(doc_id, text, lang) -> one row a page of words: divergence, ratio, slope, residual, their deviations, share."""
    words = page_words(documents)
    pages = (
        words.where(f"doc_id is not null and words >= {MIN_WORDS} and marked <= {MARKED_SHARE}").select("doc_id", "text", "words", "marked", "counts")
        .mapInArrow(_page_batches(head_words(words)), "doc_id bigint, lang string, words int, marked double, mass double, divergence double, ratio double, share double, spectrum array<struct<f: int, c: int>>")
    )
    scored = materialize(curves(pages.dropDuplicates(["doc_id"])), "curves")
    discard(words)
    return deviations(scored)


def stuffed_pages(documents: DataFrame) -> DataFrame:
    bent = (F.abs("z_slope") > EXTREME) | (F.abs("z_residual") > EXTREME)
    tie = ((F.col("ratio") >= DOUBTFUL) | bent) & (F.col("share") > SPAM_SHARE)
    return score_pages(documents).where((F.col("ratio") >= CERTAIN) | tie)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffed_pages(read(spark, sf_dir, "documents", "doc_id", "text", "lang")).select("doc_id").distinct()
