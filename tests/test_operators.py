import itertools
import random
from datetime import datetime as dt, timedelta

import pytest
from pyspark.sql import functions as F

from lodeweave.functions.globs import glob_regex
from lodeweave.operators import chunks as C, dataset as D, evaluation as E, graph as G, history as H, linking as L, retrieval as R
from lodeweave.operators.components import connected_components


def pairs(df):
    return {tuple(r) for r in df.collect()}


def test_components_against_union_find(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(500, k) for k in range(501, 900)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    want = {(find(x), x) for x in list(parent) if find(x) != x}
    assert pairs(connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))) == want
    assert pairs(connected_components(spark.createDataFrame([], "a bigint, b bigint"))) == set()


@pytest.mark.parametrize("pattern,hit,miss", [("*.py", "a/b.py", "a/b.pyc"), ("src/**", "src/a/b", "lib/src/a"), ("**/x/*.c", "a/x/y.c", "a/x/y/z.c"), ("a?c", "abc", "ac"), ("[!a]b", "cb", "ab"), ("d/**/e", "d/e", "d/f")])
def test_globs(pattern, hit, miss):
    import re

    assert re.search(glob_regex(pattern), hit) and not re.search(glob_regex(pattern), miss)


def test_file_filter_lists(spark):
    files = spark.createDataFrame([("a/b.PY", 10), ("a/c.js", 10), ("a/d.py", 99), (".bashrc", 10), ("vendor/x.py", 10), ("e.py", None)], "relpath string, size_bytes bigint")
    keep = lambda **k: {r[0] for r in D.keep_files(files, 1, 50, **k).collect()}
    assert keep(allow=[".py"]) == {"a/b.PY", "vendor/x.py"}
    assert keep(allow=["py"], deny=["PY"]) == set()
    assert keep(include=["*.py", "*.PY", "*.js"], exclude=["vendor/**"]) == {"a/b.PY", "a/c.js"}


def test_split_is_stable_and_near_its_weights(spark):
    files = spark.range(4000).select(F.concat(F.lit("p/"), "id").alias("p"))
    out = files.select("p", D.split_of(F.col("p"), F.lit("r"), {"train": 0.8, "val": 0.1, "test": 0.1}).alias("s"))
    counts = {r["s"]: r["count"] for r in out.groupBy("s").count().collect()}
    assert abs(counts["train"] / 4000 - 0.8) < 0.02
    assert pairs(out.where("p < 'p/2'")) <= pairs(out)
    with pytest.raises(ValueError):
        D.split_of(F.col("p"), F.lit("r"), {"train": 0.8})


def test_fim_round_trip(spark):
    texts = {1: "a\nb", 2: "a\nb\nc", 3: "\n".join(map(str, range(40))), 4: None, 5: "", 6: "x\n\n\n"}
    rows = {r.id: r for r in D.fim_samples(spark.createDataFrame(list(texts.items()), "id int, t string"), "id", "t").collect()}
    assert set(rows) == {2, 3, 6} and (rows[2].start_line, rows[2].middle_lines) == (1, 1)
    for key, r in rows.items():
        prefix, rest = r.text.removeprefix("<|fim_prefix|>").split("<|fim_suffix|>")
        suffix, middle = rest.split("<|fim_middle|>")
        assert prefix + middle + suffix == texts[key] and prefix and middle


def test_dedup_keeps_the_first(spark):
    rows = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y"), (4, None), (5, None)], "id int, t string")
    assert {r[0] for r in D.first_of_content(rows, "t", "id").collect()} == {1, 2, 4, 5}


def test_intervals_equal_nested_loops(spark):
    rnd = random.Random(5)
    base = dt(2024, 1, 1)
    a = [(i, rnd.choice("xyz"), base + timedelta(hours=rnd.randrange(1500))) for i in range(150)]
    b = [(i, rnd.choice("xyz"), base + timedelta(hours=rnd.randrange(1500))) for i in range(150)]
    b += [(900, "x", None)]
    got = L.within_days(spark.createDataFrame(a, "i int, k string, t timestamp"), spark.createDataFrame(b, "j int, k string, u timestamp"), ["k"], "t", "u", 7)
    want = {(x[0], y[0]) for x, y in itertools.product(a, b) if x[1] == y[1] and y[2] and abs(x[2] - y[2]) <= timedelta(days=7)}
    assert pairs(got.select("i", "j")) == want and got.count() == len(want)


def test_window_edges_are_inclusive(spark):
    t = dt(2024, 1, 10)
    a = spark.createDataFrame([(1, "x", t)], "i int, k string, t timestamp")
    b = spark.createDataFrame([(1, "x", t + timedelta(days=7)), (2, "x", t + timedelta(days=7, microseconds=1)), (3, "x", t - timedelta(days=7))], "j int, k string, u timestamp")
    assert {r.j for r in L.within_days(a, b, ["k"], "t", "u", 7).collect()} == {1, 3}


def test_temporal_links_ignore_empty_names_and_drafts(spark):
    t = dt(2024, 1, 10)
    issues = spark.createDataFrame([(1, t, ["", "a"]), (2, None, ["a"]), (3, t, None)], "issue_number bigint, closed_at timestamp, assignees array<string>")
    pulls = spark.createDataFrame([(9, t, "", False), (8, t, "a", True), (7, None, "a", False), (6, t, "a", None)], "pr_number bigint, merged_at timestamp, author string, draft boolean")
    assert pairs(L.temporal_links(issues, pulls).select("issue_number", "pr_number")) == {(1, 6)}


def test_scores_are_exact_decimals(spark):
    s = L.score({"a": (F.lit(True), "0.50"), "b": (F.lit(True), "0.20"), "c": (F.lit(True), "0.10")})
    assert spark.range(1).select((s >= 0.8).alias("x")).first().x


def test_merge_and_upsert_links(spark):
    cols = "issue_number bigint, pr_number bigint, confidence double, source string"
    links = spark.createDataFrame([(1, 2, 0.5, "b"), (1, 2, 0.9, "a,b"), (1, 2, 0.5, "b"), (3, 4, 1.0, "c")], cols)
    merged = {(r.issue_number, r.pr_number): r for r in L.merge_links(links).collect()}
    assert merged[1, 2].confidence == 0.9 and merged[1, 2].source == "a,b" and merged[1, 2].signals == {"a": 0.9, "b": 0.9}
    store = spark.createDataFrame([(1, 1, 0.85, "old"), (2, 2, 0.5, "old"), (3, 3, 0.7, "old")], cols)
    new = spark.createDataFrame([(1, 1, 0.5, "new"), (2, 2, 1.0, "new"), (3, 3, 0.7, "new")], cols)
    assert {(r.issue_number, r.source) for r in H.upsert_links(store, new).collect()} == {(1, "old"), (2, "new"), (3, "old")}


def test_co_change_support_and_blast_radius(spark):
    rows = [("big", f"f{i}") for i in range(20)] + [(f"e{k}", x) for k in range(3) for x in ("a", "b")] + [(f"g{k}", x) for k in range(2) for x in ("a", "c")] + [("n", None)]
    got = L.co_changed(spark.createDataFrame(rows, "e string, i string"), "e", "i", 12, 3)
    assert pairs(got.select("a", "b", "support")) == {("a", "b", 3), ("b", "a", 3)}


def test_facts_flip_flop_and_as_of(spark):
    t = [dt(2024, 1, d) for d in range(1, 10)]
    rows = spark.createDataFrame([(1, "A", t[0]), (1, "A", t[1]), (1, "B", t[2]), (1, "A", t[4]), (2, None, t[0])], "k int, v string, at timestamp")
    facts = H.intervals(H.changes_only(rows, ["k"], "v", "at"), ["k"], "at")
    got = [(r.k, r.v, r.valid_from, r.valid_to) for r in facts.orderBy("k", "valid_from").collect()]
    assert got == [(1, "A", t[0], t[2]), (1, "B", t[2], t[4]), (1, "A", t[4], None), (2, None, t[0], None)]
    asked = spark.createDataFrame([(1, t[1], "p"), (1, t[2], "q"), (1, t[8], "r"), (3, t[1], "s")], "k int, at timestamp, tag string")
    seen = H.as_of(asked, rows.withColumnRenamed("at", "since"), ["k"], "at", "since", ["v"])
    assert pairs(seen.select("tag", "v")) == {("p", "A"), ("q", "B"), ("r", "A"), ("s", None)}


def test_pruning_stays_in_its_repository(spark):
    t = dt(2024, 1, 1)
    facts = spark.createDataFrame([("r1", "a", None), ("r2", "a", None)], "repo string, path string, valid_to timestamp")
    out = H.archived(facts, spark.createDataFrame([("r2", "a")], "repo string, path string"), ["repo", "path"], F.lit(t))
    assert pairs(out.select("repo", "valid_to")) == {("r1", t), ("r2", None)}


def test_upsert_keeps_chosen_columns(spark):
    old = spark.createDataFrame([(1, "a", "born"), (2, "b", "born")], "id int, v string, c string")
    new = spark.createDataFrame([(1, "z", "now"), (3, "y", "now")], "id int, v string, c string")
    once = H.upsert(old, new, ["id"], keep=["c"])
    assert pairs(once) == {(1, "z", "born"), (2, "b", "born"), (3, "y", "now")}
    assert pairs(H.upsert(once, new, ["id"], keep=["c"])) == pairs(once)


def test_reach_ends_on_cycles_and_depth(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (1, 3), (3, 4), (4, 5)], "src bigint, dst bigint")
    got = pairs(G.reach(edges, spark.createDataFrame([(1,)], "src bigint"), 2))
    assert got == {(1, 2, 1), (1, 3, 1), (1, 4, 2)}


def test_paths_take_the_strongest_of_the_shortest(spark):
    edges = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.5), (2, 4, 0.4), (3, 4, 0.5)], "src bigint, dst bigint, confidence double")
    got = {r.dst: (r.hops, r.confidence, r.path) for r in G.best_paths(edges, spark.createDataFrame([(1,)], "src bigint"), 3).collect()}
    assert got[4] == (2, 0.5, [1, 3, 4])


def test_sections_headings_and_pieces(spark):
    text = "intro\n# A\n\n# B\n" + "x" * 5000
    rows = [(r.chunk_index, r.heading, len(r.chunk)) for r in C.sections(spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "   \n ")], "id int, t string"), "id", "t").orderBy("chunk_index").collect()]
    assert [h for _, h, _ in rows] == ["", "A", "B", "B", "B"] and [i for i, *_ in rows] == list(range(5)) and max(n for *_, n in rows) == 2000


def test_diff_files_and_hunks(spark):
    diff = "noise\ndiff --git a/x.py b/y.py\n--- a/x.py\n+++ b/y.py\n@@ -1 +1 @@\n-a\n+b\n@@ -9 +9 @@\n+c\ndiff --git a/z b/z\nBinary"
    files = C.diff_files(spark.createDataFrame([(1, diff), (2, None), (3, "")], "id int, d string"), "id", "d")
    assert [(r.file_index, r.file_path) for r in files.orderBy("file_index").collect()] == [(0, "y.py"), (1, "z")]
    assert C.hunks(files, "id").count() == 2
    assert pairs(C.line_changes(files, "id").select("file_path", "added", "deleted")) == {("y.py", 2, 1), ("z", 0, 0)}


def test_fusion_ties_and_single_lists(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query bigint, doc bigint, rank int")
    b = spark.createDataFrame([(1, 12, 1), (1, 11, 2)], "query bigint, doc bigint, rank int")
    assert [r.doc for r in R.fuse([a, b], 3).orderBy("rank").collect()] == [11, 10, 12]


def test_bm25_prefers_repeated_terms_and_floors_common_ones(spark):
    docs = spark.createDataFrame([(1, "cart crash"), (2, "cart crash crash now"), (3, "cart"), (4, "cart other words"), (5, None)], "id bigint, t string")
    terms = R.query_terms(spark.createDataFrame([(7, "Crash cart"), (8, "zebra"), (9, None)], "q bigint, t string"), "q", F.col("t"))
    out = R.bm25(docs, "id", F.col("t"), terms, 10).orderBy("rank").collect()
    assert {r["query"] for r in out} == {7} and {r.doc for r in out[:2]} == {1, 2} and len(out) == 4
    both = R.bm25(docs, "id", F.col("t"), terms, 10, "and")
    assert {r.doc for r in both.collect()} == {1, 2}


@pytest.mark.parametrize("mode", ["or", "and", "and_or"])
def test_bm25_in_blocks_of_queries_gives_the_same(spark, mode):
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(30)]
    docs = spark.createDataFrame([(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 40)))) for i in range(150)] + [(151, None), (None, "w1")], "id bigint, t string").repartition(5)
    terms = R.query_terms(spark.createDataFrame([(i, " ".join(rnd.sample(vocabulary, 4))) for i in range(12)], "q bigint, t string"), "q", F.col("t"))
    rows = lambda carried: sorted(map(tuple, R.bm25(docs, "id", F.col("t"), terms, 5, mode, carried).collect()))
    assert rows(1 << 22) == rows(60) != []
    assert R.bm25(docs.limit(0), "id", F.col("t"), terms, 5, mode).count() == 0 == R.bm25(docs, "id", F.col("t"), terms.limit(0), 5, mode).count()


def test_nearest_in_blocks_equals_brute_force(spark):
    rnd = random.Random(1)
    vs = [(i, [rnd.random() for _ in range(8)]) for i in range(120)]
    df = spark.createDataFrame(vs + [(999, None)], "id bigint, v array<float>")
    for carried in (1 << 20, 0):  # queries handed to every task, and met block by block
        got = {(r["query"], r["rank"]): r.doc for r in R.nearest(df.where("id % 20 = 0"), df, 3, 2, 17, carried).collect()}
        for q in range(0, 120, 20):
            best = sorted(range(120), key=lambda j: (round(sum((a - b) ** 2 for a, b in zip(vs[q][1], vs[j][1])) ** 0.5, 5), j))[:3]
            assert [got[q, k] for k in (1, 2, 3)] == best
        assert R.nearest(df.limit(0), df, 3, 2, 17, carried).count() == 0 == R.nearest(df, df.limit(0), 3, 2, 17, carried).count()


def test_unit_norm_is_asserted(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0])], "id int, v array<float>")
    assert R.assert_unit(df.where("id = 1"), "v").count() == 1
    with pytest.raises(Exception):
        R.assert_unit(df, "v").collect()


def test_task_scores(spark):
    rows = spark.createDataFrame([(["A", "b"], ["c"], "xx a C"), ([], [], "q"), (None, None, "q"), (["z"], [], None)], "e array<string>, f array<string>, r string")
    got = [r[0] for r in rows.select(E.task_score("e", "f", "r")).collect()]
    assert got[:3] == [-0.5, 1.0, 1.0]


def test_runs(spark):
    rows = spark.createDataFrame([(1, i, s) for i, s in enumerate("eexeeex")] + [(2, 0, "x")], "u int, t int, s string")
    assert pairs(H.runs(rows, ["u"], F.col("s") == "e", ["t"])) == {(1, 0, 2), (1, 3, 3)}


# ---- citations ---------------------------------------------------------------------------------


def test_cited_numbers(spark):
    from lodeweave.operators import citations as C

    texts = [("CL 1234, cl#5678 and changelist 1234; /changes/9999", [1234, 5678, 9999]), ("CL 999 change 123", []), ("submitted as 4321 @p4/7777", [4321, 7777]), (None, []), ("CL 99999999999999999999999", [])]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, t string")
    got = {r.i: r.n for r in df.select("i", C.cited_numbers(F.col("t"), C.CHANGE_PATTERNS).alias("n")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(texts)}
    bugs = spark.createDataFrame([("Fixes bug 1001 and BZ-1002, show_bug.cgi?id=1003 closes 1004 bug #1001",)], "t string").select(C.cited_numbers(F.col("t"), C.BUG_PATTERNS, 1002).alias("n"))
    assert bugs.first().n == [1002, 1003, 1004]


def test_scored_pairs_at_every_threshold_equal_all_pairs(spark):
    from lodeweave.operators import citations as C

    rnd = random.Random(4)
    t = dt(2024, 3, 1)
    bugs = [(1000 + i, rnd.choice(["a", "b", "", None]), rnd.random() < 0.5, t + timedelta(hours=rnd.randrange(-2000, 2000)), rnd.choice(["CL 2003", "change 2005 and CL#2001", None, "nothing"])) for i in range(25)]
    changes = [(2000 + i, rnd.choice(["a", "b", ""]), t + timedelta(hours=rnd.randrange(-2000, 2000)), rnd.choice(["fixes 1003", "bug 1010, bug 1011", None])) for i in range(20)]
    b = spark.createDataFrame(bugs, "bug bigint, assigned_to string, fixed boolean, changed timestamp, comments string")
    c = spark.createDataFrame(changes, "cl bigint, author string, submitted timestamp, description string")
    import re

    numbers = lambda s: {int(x) for x in re.findall(r"\d{4}", s or "")}
    for threshold in (0.8, 0.6, 0.3):
        want = {}
        for bug, who, fixed, changed, comments in bugs:
            for cl, author, submitted, description in changes:
                if abs(submitted - changed) <= timedelta(days=60):
                    points = 50 * (cl in numbers(comments)) + 50 * (bug in numbers(description)) + 30 * (abs((submitted - changed).days) <= 7) + 20 * (bool(who) and who == author) + 10 * fixed
                    if min(points, 100) >= threshold * 100:
                        want[bug, cl] = min(points, 100) / 100
        got = {(r.bug, r.cl): r.confidence for r in C.scored_pairs(b, c, f"{threshold:.2f}").collect()}
        assert got == want and want
    assert C.scored_pairs(b.limit(0), c).count() == 0


# ---- facts -------------------------------------------------------------------------------------


FACT = "subject string, predicate string, object string, confidence double, tier string, since timestamp"


def day(n):
    return dt(2024, 1, 1) + timedelta(days=n)


def test_inserting_again_adds_nothing_and_nulls_are_equal(spark):
    from lodeweave.operators import facts as K

    rows = [("a", "p", "x", 1.0, "det", day(2)), ("a", "p", "x", 0.5, "llm", day(1)), ("a", "p", None, 1.0, "det", day(1)), (None, "p", "x", 1.0, "det", day(3))]
    df = spark.createDataFrame(rows, FACT)
    once = K.insert_facts(df.limit(0), df)
    assert once.count() == 3 and K.insert_facts(once, df).count() == 3
    assert {r.since for r in once.where("subject = 'a' and object = 'x'").collect()} == {day(1)}


def test_a_lower_tier_retires_nothing(spark):
    from lodeweave.operators import facts as K

    rows = [("s", "p", "a", 1.0, "llm", day(1)), ("s", "p", "b", 1.0, "det", day(2)), ("s", "p", "c", 1.0, "heur", day(3)), ("s", "p", "d", 1.0, "det", day(4)), ("t", "p", "a", 1.0, "heur", day(1))]
    got = {(r.subject, r.object): r.valid_to for r in K.superseded(spark.createDataFrame(rows, FACT)).collect()}
    assert got == {("s", "a"): day(2), ("s", "b"): day(4), ("s", "c"): day(3), ("s", "d"): None, ("t", "a"): None}


def test_entities_keep_a_known_path(spark):
    from lodeweave.operators import facts as K

    none = spark.createDataFrame([], "kind string, name string, repo string, path string, first_seen timestamp, last_seen timestamp")
    rows = lambda *xs: spark.createDataFrame(list(xs), "kind string, name string, repo string, path string, since timestamp")
    one = K.get_or_create(none, rows(("file", "n", None, None, day(1)), ("file", "n", None, None, day(2))))
    two = K.get_or_create(one, rows(("file", "n", None, "p/n", day(3))))
    three = K.get_or_create(two, rows(("file", "n", None, "q/n", day(0)), ("file", "n", "r", "z", day(5))))
    assert {(r.repo, r.path, r.first_seen, r.last_seen) for r in three.collect()} == {(None, "p/n", day(0), day(3)), ("r", "z", day(5), day(5))}


def test_chains_end_and_circles_are_marked(spark):
    from lodeweave.operators import facts as K

    long = [(i, i - 1) for i in range(2, 40)]
    rows = [*long, (100, 101), (101, 102), (102, 100), (103, 100), (200, 200), (None, 3)]
    got = {r.node: (r.terminal, r.cyclic) for r in K.terminals(spark.createDataFrame(rows, "node bigint, next bigint")).collect()}
    assert got == {i: (1, False) for i in range(2, 40)} | {i: (None, True) for i in (100, 101, 102, 103)}
    assert K.terminals(spark.createDataFrame([], "node bigint, next bigint")).count() == 0


def test_proof_of_no_path(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8)], "src bigint, dst bigint")
    sources = spark.createDataFrame([(1,), (9,), (7,)], "src bigint")
    assert {r.src: (r.explored, r.complete) for r in G.exhausted(edges, sources, 2).collect()} == {1: (2, False), 9: (1, True), 7: (0, True)}


def test_caps_tell_what_is_left_away(spark):
    from lodeweave.operators import facts as K

    df = spark.createDataFrame([("s", "p", str(i), i / 10, "det", day(i)) for i in range(5)] + [("t", "p", "x", 1.0, "det", day(1))], FACT)
    assert {(r.subject, r.object, r.left_away) for r in K.capped(df, 2).collect()} == {("s", "4", 3), ("s", "3", 3), ("t", "x", 0)}


# ---- second chunker and samples ----------------------------------------------------------------


def test_marker_chunks_cover_the_diff(spark):
    diff = "--- a/Foo.java\n+++ b/Foo.java\n@@ -1,2 +1,3 @@\n-x\n+y\n--- a/Bar.java\n+++ b/Bar.java \n@@ -5,1 +5,2 @@\n-p\n+q\n@@ -9 +9 @@ f\n" + "+é✓é\n" * 300
    rows = spark.createDataFrame([(1, diff), (2, None), (3, ""), (4, "no marker"), (5, "+++ b/x\nrest")], "k int, d string")
    files = {(r.k, r.file_index): r.file_path for r in C.marker_files(rows, "k", "d").collect()}
    assert files == {(1, 0): "Foo.java", (1, 1): "Bar.java", (5, 0): "x"}
    chunks = C.marker_chunks(rows, "k", "d", 100).orderBy("k", "file_index", "hunk_index", "piece").collect()
    assert "".join(r.chunk for r in chunks if r.k == 1) == diff and all(len(r.chunk.encode()) <= 100 for r in chunks)
    assert [r.hunk_index for r in chunks if r.file_path == "Bar.java" and r.piece == 0] == [0, 1, 2]


@pytest.mark.parametrize("most", [1, 2, 3, 5, 64])
def test_pieces_never_cut_a_character(spark, most):
    text = "aé✓\U0001f600b" * 7
    pieces = spark.createDataFrame([(text,), (None,), ("",)], "t string").select(C.byte_pieces(F.col("t"), most).alias("p")).collect()
    assert "".join(pieces[0].p) == text and all(len(p.encode()) <= max(most, 4) for p in pieces[0].p) and pieces[1].p is None and pieces[2].p == [""]


def test_time_split_and_caps_are_exact(spark):
    rows = [(i, day(i // 7)) for i in range(50)] + [(99, None)]
    df = spark.createDataFrame(rows, "k int, t timestamp")
    train = {r.k for r in D.time_split(df, "t", "k").where("split = 'train'").collect()}
    assert train == set(range(40)) | {99}
    flagged = spark.createDataFrame([(i, i % 2 == 0) for i in range(200)], "k int, f boolean")
    kept = D.capped_share(flagged, F.col("f"), "k", 0.1).collect()
    assert sum(not r.f for r in kept) == 100 and sum(r.f for r in kept) == 11
    assert D.capped_share(flagged.where("not f"), F.col("f"), "k", 0.1).count() == 100 and D.capped_share(flagged.limit(0), F.col("f"), "k", 0.1).count() == 0


def test_exact_percentiles(spark):
    rnd = random.Random(3)
    rows = [("a", rnd.choice([1.0, 2.0, rnd.random()])) for _ in range(700)] + [("b", 5.0), ("c", None)]
    got = {r.g: (r.p50, r.p99) for r in E.exact_percentiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", {"p50": 0.5, "p99": 0.99}, 16).collect()}
    import numpy as np

    values = [v for g, v in rows if g == "a"]
    assert abs(got["a"][0] - np.quantile(values, 0.5)) < 1e-9 and abs(got["a"][1] - np.quantile(values, 0.99)) < 1e-9 and got["b"] == (5.0, 5.0) and set(got) == {"a", "b"}


def test_headings_of_three_kinds(spark):
    text = "lead\n> # One\nbody\nTwo\n===\nx\n3.1 Three Things\ny"
    got = [(r.line, r.heading) for r in C.headed_lines(spark.createDataFrame([(1, text), (2, None)], "k int, t string"), "k", "t").orderBy("line_no").collect()]
    assert got == [("lead", ""), ("# One", "One"), ("body", "One"), ("Two", "Two"), ("===", "Two"), ("x", "Two"), ("3.1 Three Things", "3.1 Three Things"), ("y", "3.1 Three Things")]


# ---- context -----------------------------------------------------------------------------------


def test_shared_budget_carries_forward(spark):
    hits = spark.createDataFrame([(1, 1, 10, "ab\n"), (1, 2, 11, "line one\nline two\nline three"), (1, 3, 12, None), (2, 1, 13, "x" * 50)], "query bigint, rank int, doc bigint, t string")
    got = {(r["query"], r.doc): r["size"] for r in R.shared_budget(hits, "t", 30).collect()}
    assert got == {(1, 10): 3, (1, 11): 8}  # an equal share of what is left, cut at a line end; one long line fits nowhere


def test_folded_words_and_lexical_first(spark):
    df = spark.createDataFrame([(["cfg", "load_user_cache", "_x", "plain"],)], "w array<string>")
    assert df.select(R.folded(F.col("w"), {"config": ["cfg", "conf"]}).alias("f")).first().f == ["config", "load_user_cache", "load", "user", "cache", "_x", "plain"]
    lexical = spark.createDataFrame([(1, 5, 1), (1, 6, 2)], "query bigint, doc bigint, rank int")
    dense = spark.createDataFrame([(1, 6, 1, 0.1), (1, 7, 2, 0.2), (1, 8, 3, 0.9)], "query bigint, doc bigint, rank int, distance double")
    assert [(r.doc, r.arm) for r in R.after_lexical(lexical, dense, 5, 0.5).orderBy("rank").collect()] == [(5, 0), (6, 0), (7, 1)]


def test_vectors_are_made_once_per_text_and_model(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k bigint, t string")
    first = R.to_embed(rows, spark.createDataFrame([], "k bigint, src_hash string, model string"), "k", F.col("t"), "m")
    assert {r.k for r in first.collect()} == {1, 2}
    stored = first.select("k", "src_hash", F.lit("m").alias("model"))
    assert R.to_embed(rows, stored, "k", F.col("t"), "m").count() == 0 and R.to_embed(rows, stored, "k", F.col("t"), "n").count() == 2
    assert {r.k for r in R.to_embed(rows.withColumn("t", F.concat("t", F.lit("!"))), stored, "k", F.col("t"), "m").collect()} == {1, 2}


def test_answer_quality_and_promotion(spark):
    answers = spark.createDataFrame([(1, "x", 10.0), (2, "x", 20.0), (3, "y", 30.0)], "answer int, kind string, cost double")
    cited = spark.createDataFrame([(1, "a"), (1, "a"), (1, "z"), (3, "a")], "answer int, ref string")
    known = spark.createDataFrame([("a",), ("b",)], "ref string")
    got = {r.kind: (r.answers, r.citation_rate, r.precision, r.hallucination_rate, r.mean_cost) for r in E.answer_quality(answers, cited, known, [["kind"], []], "kind").collect()}
    assert got == {"x": (2, 0.5, 0.5, 0.5, 15.0), "y": (1, 1.0, 1.0, 0.0, 30.0), None: (3, 0.666667, 0.666667, 0.333333, 20.0)}
    frame = lambda a, b: spark.createDataFrame([("g", a), ("h", b)], "group string, v double")
    assert E.promotion(frame(0.5, 0.5), frame(0.4, 0.9), "group", "v", ["h"]).first().promoted
    assert not E.promotion(frame(0.5, 0.5), frame(0.4, 0.9), "group", "v", ["g"]).first().promoted
    assert not E.promotion(frame(0.5, 0.5), frame(0.5, 0.5), "group", "v", []).first().promoted


def test_summaries_put_missing_values_last(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", None), ("c", 0.9), ("d", 0.5)], "k string, v double")
    assert [r.k for r in E.ranked_summary(df, "v", "k").collect()] == ["c", "a", "d", "b"]
