import random
import re

import pytest
from pyspark.sql import functions as F

from lodeweave.llm import neardup as N, overlap as O, paths as P2
from lodeweave.operators.components import connected_components

WORDS = re.compile(r"[a-z0-9_]+")


def brute(rows, threshold=0.5, width=3):
    sets = {}
    for key, text in rows:
        if key is not None and text:
            w = WORDS.findall(text.lower())
            if len(w) >= width:
                sets[key] = set(zip(*(w[i:] for i in range(width))))
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {(find(k), k) for k in keys if find(k) != k}


def corpus(seed=1, families=25):
    """Families of edited, extended and rotated texts, some with one notice on top, and texts of their own."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(900)]
    notice = [f"notice{i}" for i in range(40)]
    rows, key = [], 0
    for family in range(families):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randrange(20, 160))]
        if family % 3 == 0:
            base = notice + base
        for _ in range(rnd.randrange(1, 7)):
            w = list(base)
            for _ in range(rnd.randrange(0, max(1, len(w) // 9))):
                at = rnd.randrange(len(w))
                w[at : at + 1] = rnd.choice([[], [w[at], "more"], ["other"]])
            kind = rnd.randrange(5)
            if kind == 0:
                cut = rnd.randrange(len(w))
                w = w[cut:] + w[:cut]
            elif kind == 1:
                w = w + [rnd.choice(vocabulary) for _ in range(len(w) // 2)]
            rows.append((key, " ".join(w).upper() if rnd.random() < 0.3 else "\r\n\t".join(w)))
            key += 1
    return rows


EDGES = [(9001, None), (9002, ""), (9003, "one two"), (9004, "É!?"), (None, "a b c d e"), (9005, "a b c"), (9006, "A, b; c."), (9007, "a b c a b c a b c"), (9008, "z " * 50000), (9009, "z z z")]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(corpus() + EDGES, "id bigint, text string")


def test_text_groups_equal_all_pairs(spark, texts):
    assert {tuple(r) for r in N.groups(N.text_links(texts)).collect()} == brute(corpus() + EDGES)


def test_segment_groups_equal_all_pairs(spark, texts):
    assert {tuple(r) for r in connected_components(O.segment_links(texts)).collect()} == brute(corpus() + EDGES)


def test_hot_shingles_still_find_every_link(spark, monkeypatch):
    monkeypatch.setattr(N, "LIGHT", 2)
    monkeypatch.setattr(O, "LIGHT", 2)
    rows = corpus(7, 12)
    df = spark.createDataFrame(rows, "id bigint, text string")
    want = brute(rows)
    assert {tuple(r) for r in N.groups(N.text_links(df)).collect()} == want
    assert {tuple(r) for r in connected_components(O.segment_links(df)).collect()} == want


def spread():
    """Texts with a word put in at even distances or with blocks in another order: alike, though hardly a longer run is left whole."""
    rows = []
    for n, step in ((24, 8), (48, 8), (96, 8), (240, 8), (70, 7), (60, 6)):
        base = [f"s{n}w{i}" for i in range(n)]
        more = [w for i, w in enumerate(base, 1) for w in ([w, f"s{n}x{i}"] if i % step == 0 else [w])]
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(more))]
    head, *blocks = [f"b{i}" for i in range(3)], *[[f"b{3 + 6 * j + i}" for i in range(6)] for j in range(12)]
    rows += [(len(rows), " ".join(sum(blocks, head))), (len(rows) + 1, " ".join(sum(blocks[::-1], head)))]
    return rows


def test_evenly_spread_insertions_equal_all_pairs(spark):
    want = brute(spread())
    assert len(want) >= 5
    df = spark.createDataFrame(spread(), "id bigint, text string")
    assert {tuple(r) for r in connected_components(O.segment_links(df)).collect()} == want


def test_texts_told_again_equal_all_pairs(spark):
    """Numbers of words differ by any factor while the sets of runs are alike."""
    base, phrase = [f"t{i}" for i in range(100)], [f"p{i}" for i in range(10)]
    rows = [(i, " ".join(w)) for i, w in enumerate((base, base * 3, phrase * 4, phrase * 6, phrase * 50, ["q", "r", "s", "t"] * 3, ["q", "r", "s", "t"] * 40))]
    want = {(0, 1), (2, 3), (2, 4), (5, 6)}
    assert brute(rows) == want
    df = spark.createDataFrame(rows, "id bigint, text string")
    assert {tuple(r) for r in connected_components(O.segment_links(df)).collect()} == want
    assert {tuple(r) for r in N.groups(N.text_links(df)).collect()} == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id bigint, text string")
    assert N.groups(N.text_links(none)).count() == 0 and connected_components(O.segment_links(none)).count() == 0
    files = spark.createDataFrame([], "file_id bigint, repo string, abspath string, size_bytes bigint")
    assert N.groups(N.path_links(files)).count() == 0


def test_pivots_never_discard_an_alike_pair(spark, texts):
    sets = texts.where("length(text) > 0 and id is not null").mapInArrow(N.shingle_batches(3), "id bigint, n int, hs array<bigint>").where("n > 0")
    table = N.with_pivots(sets, "id").collect()
    for a in table:
        for b in table:
            meet, total = len(set(a.hs) & set(b.hs)), len(set(a.hs) | set(b.hs))
            if meet * 2 >= total:
                for p, q in ((a[c], b[c]) for c in N.pivot_columns(N.PIVOTS)):
                    for i in range(N.LANES):
                        gap = abs((p >> 8 * i & 255) - (q >> 8 * i & 255)) * N.STEP
                        assert gap <= (a.n + b.n) / 3 + N.STEP


def test_lanes_compare_like_numbers(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(400):
        x = [rnd.randrange(64) for _ in range(14)]
        t = rnd.randrange(0, 70)
        y = [min(63, max(0, v + rnd.randrange(-t - 2, t + 3) // rnd.choice((1, 2)))) for v in x]
        pack = lambda v: sum(n << 8 * j for j, n in enumerate(v))
        rows.append((i, pack(x[:7]), pack(x[7:]), pack(y[:7]), pack(y[7:]), t, max(abs(m - n) for m, n in zip(x, y)) <= t))
    df = spark.createDataFrame(rows, "i int, a1 bigint, a2 bigint, b1 bigint, b2 bigint, t int, want boolean")
    x, y = df.select("i", "t", "want", F.col("a1").alias("p1"), F.col("a2").alias("p2")).alias("x"), df.select("i", F.col("b1").alias("p1"), F.col("b2").alias("p2")).alias("y")
    got = x.join(y, F.col("x.i") == F.col("y.i")).select("want", N.pivots_allow("x", "y", F.col("t"), 14, step=1).alias("got")).collect()
    assert all(r.want == r.got for r in got) and len({r.want for r in got}) == 2


def test_crowded_shingles_change_no_group(spark, texts, monkeypatch):
    for name, value in (("SAMPLED", 1), ("LEAST_CROWD", 3), ("CROWDED", 40), ("SALTS", 3)):
        monkeypatch.setattr(N, name, value)
    assert 0 < N.crowded_shingles(texts.where("length(text) > 0").mapInArrow(N.shingle_batches(3), "id bigint, n int, hs array<bigint>")).count() <= 40
    assert {tuple(r) for r in N.groups(N.text_links(texts)).collect()} == brute(corpus() + EDGES)


def paths(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "file_id bigint, repo string, abspath string, size_bytes bigint")
    return {tuple(r) for r in N.groups(N.path_links(df)).collect()}


def relpaths(spark, rows):
    """The same files, each by its path below the root, through the segment join."""
    below = [(i, r, p and r and p.replace("\\", "/").split(f"/{r}/", 1)[-1], s) for i, (r, p, s) in enumerate(rows)]
    df = spark.createDataFrame(below, "file_id bigint, repo string, relpath string, size_bytes bigint")
    return {tuple(r) for r in N.groups(O.path_segment_links(df)).collect()}


def test_paths_that_list_one_file(spark):
    base = "/home/ci/o/r/src/api/views/load_user_cache.py"
    rows = [
        ("o/r", base, 1000),
        ("o/r", "C:\\w\\o\\r\\src\\api\\views\\load_user_cache.py", 1000),
        ("o/r", "/x/job-1/o/r/./src//api/Views/LOAD_USER_CACHE.py", 1010),
        ("o/r", "/x/o/r/.worktrees/fix-1/src/views/api/load_user_cache.py", None),
        ("o/r", "/x/o/r/src/api/core/views/load_usre_cache.py", 1000),
        ("o/r", "/x/o/r/src/views/load-user-cache.py", 1000),
        ("o/r", "/x/o/r/src/api/views/load_user_cachhe.py", 1000),
    ]
    assert paths(spark, rows) == relpaths(spark, rows) == {(0, i) for i in range(1, len(rows))}


@pytest.mark.parametrize(
    "repo,path,size",
    [
        ("o/q", "/x/o/q/src/api/views/load_user_cache.py", 1000),
        ("o/r", "/x/o/r/src/api/views/load_user_cache.py", 1100),
        ("o/r", "/x/o/r/src/api/views/load_user_cache_2.py", 1000),
        ("o/r", "/x/o/r/src/api/views/load_user_cache.ts", 1000),
        ("o/r", "/x/o/r/src/api/views/load_user_queue.py", 1000),
        ("o/r", "/x/o/r/lib/jobs/mail/load_user_cache.py", 1000),
        (None, "/x/o/r/src/api/views/load_user_cache.py", 1000),
        ("o/r", None, 1000),
        ("o/r", "", 1000),
    ],
)
def test_paths_of_other_files(spark, repo, path, size):
    rows = [("o/r", "/home/o/r/src/api/views/load_user_cache.py", 1000), (repo, path, size)]
    assert paths(spark, rows) == relpaths(spark, rows) == set()


def test_files_of_equal_name_in_unlike_directories(spark):
    rows = [("o/r", f"/x/o/r/packages/{d}/index.ts", s) for d, s in (("alpha", 1000), ("beta", 1005), ("gamma", 1001))]
    rows += [("o/r", "/x/o/r/src/billing/views.py", 700), ("o/r", "/x/o/r/src/orders/views.py", 700), ("o/r", "/x/o/r/test/tests/x_case.py", 5), ("o/r", "/x/o/r/tests/x_case.py", 5)]
    # a directory more is a small difference, another directory is not
    assert paths(spark, rows) == relpaths(spark, rows) == {(5, 6)}


def test_one_name_in_many_directories_makes_no_pairs(spark):
    pairs = {}
    for n in (200, 400):
        df = spark.range(n).selectExpr("id as file_id", "'o/r' as repo", "concat('packages/p', char(97 + id % 26), repeat('x', cast(id div 26 as int)), '/index.ts') as relpath", "1000 + id as size_bytes")
        nodes, _ = P2.path_nodes(df, "relpath")
        d = P2.by_directories(nodes).withColumn("k", F.xxhash64("at", "letters"))
        pairs[n] = (nodes.count(), P2.meeting(d.where("not less"), d).count())
    assert pairs == {200: (200, 0), 400: (400, 0)}


def test_encoder_is_no_slip_of_decoder():
    assert not P2.same_name("x_decoder", "x_encoder", "xdecoder", "xencoder")
    assert P2.same_name("loadCache", "laodCachee", "loadcache", "laodcachee")
    assert P2.slip("abc", "acb") == 1 and P2.slip("abc", "abbc") == 1 and P2.slip("abc", "ab") == 1 and P2.slip("abc", "abd") == 2


def test_the_band_counts_slips():
    rnd = random.Random(5)
    for _ in range(3000):
        a = "".join(rnd.choice("abcd") for _ in range(rnd.randrange(1, 9)))
        b = rnd.choice(sorted(slips_of(a)) + ["".join(rnd.choice("abcd") for _ in range(rnd.randrange(1, 9)))])
        assert O.banded_slips(a, b) == P2.slip(a, b)


def slips_of(word):
    swaps = {word[:i] + word[i + 1] + word[i] + word[i + 2 :] for i in range(len(word) - 1)}
    return swaps | {word[:i] + word[i + 1 :] for i in range(len(word))} | {word[: i + 1] + word[i:] for i in range(len(word))}


def test_every_slip_of_a_name_is_met(spark):
    """All one-slip spellings of keys of 4 to 10 letters, and all two-slip spellings of two words, against brute force."""
    names = ["unit", "utils", "parser", "clients", "reporter", "generator", "dispatcher"]
    cases = [(w, v) for w in names for v in sorted(slips_of(w) - {w})]
    pairs = [("ab", "cd"), ("load", "user"), ("cache", "index"), ("a.bcd", "efg.h")]
    cases += [(f"{x}_{y}", f"{v}_{w}") for x, y in pairs for v in sorted(slips_of(x)) for w in sorted(slips_of(y))]
    cases += [("a.b.c.d.load_cache", "a_b_c_d_laod_cahce")]
    rows = [(f"r{i}", f"/x/r{i}/src/{name}.py", 1000) for i, case in enumerate(cases) for name in case]
    key = lambda s: s.replace("_", "")
    want = {i for i, (a, b) in enumerate(cases) if P2.same_name(a, b, key(a), key(b))}
    assert len(want) > 300 and {i // 2 for i, _ in paths(spark, rows)} == want == {i // 2 for i, _ in relpaths(spark, rows)}


def test_sizes_chain_within_the_tolerance(spark):
    rows = [("r", "/a/r/x/file_name.c", s) for s in (1000, 1025, 1050, 1200, None)]
    assert paths(spark, rows[:4]) == {(0, 1), (0, 2)}
    assert paths(spark, rows) == {(0, 1), (0, 2), (0, 3), (0, 4)}


def test_cross_pairs(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (7, 8)], "a bigint, b bigint")
    records = spark.createDataFrame([(1, "val", 0), (2, "train", 0), (3, "train", 0), (7, "train", 0), (8, None, 0), (8, "holdout", 0)], "id bigint, split string, a int")
    assert {tuple(r) for r in O.cross_pairs(links, records).collect()} == {(1, 2), (1, 3)}


def test_banded_distance_equals_full():
    rnd = random.Random(2)

    def full(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
        return row[-1]

    for _ in range(400):
        a = [rnd.choice("abc") for _ in range(rnd.randrange(12))]
        b = [rnd.choice("abc") for _ in range(rnd.randrange(12))]
        d, k = full(a, b), rnd.randrange(8)
        assert O.edits_within(a, b, k) == (d if d <= k else None)


def test_clashing_extra_columns(spark):
    samples = spark.createDataFrame([(1, "train", "s", "a b c d e f", 1, 2), (2, "val", "s", "a b c d e f", 1, 2)], "sample_id bigint, split string, source string, text string, a int, root int")
    files = spark.createDataFrame([(1, "r", "/x/r/a/b_c.py", "a/b_c.py", 5, "train", 1), (2, "r", "/y/r/a/b_c.py", "a/b_c.py", 5, "test", 1)], "file_id bigint, repo string, abspath string, relpath string, size_bytes bigint, split string, p int")
    assert {tuple(r) for r in N.near_duplicates(samples, files).collect()} == {("samples", 1, 2), ("file_records", 1, 2)}
    assert {tuple(r) for r in O.overlaps(samples, files).collect()} == {("samples", 1, 2), ("file_records", 1, 2)}


def test_shared_shingles_are_put_in_order_by_one_number(spark):
    sets = spark.createDataFrame([(1, 3, [5, 6, 7]), (2, 2, [6, 7]), (3, 2, [7, 8]), (4, 0, [])], "id bigint, n int, hs array<bigint>")
    for crowd in ([], [(6, 2 * N.MOST), (8, 90)]):
        much = {5: 1, 6: 2, 7: 3, 8: 1} | dict(crowd)
        crowded = spark.createDataFrame(crowd, "h bigint, much bigint")
        rows = N.shared_shingles(sets, crowded)
        want = [(i, n, min(much[h], N.MOST) << N.HASH_BITS | h) for i, n, hs in sets.collect() for h in hs if much[h] > 1]
        assert sorted(map(tuple, rows.collect())) == sorted(want)
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    assert re.search(r"Window \[count\(1\)[^\n]*\], \[k#\d+L?\]", plan), plan


def test_names_are_cut_once_a_node(spark):
    files = spark.createDataFrame([(i, "r", f"a/b{i}/b{i}/c/na.me{i}.py", 10 + i) for i in range(3)], "file_id bigint, repo string, relpath string, size_bytes bigint")
    nodes, _ = P2.path_nodes(files, "relpath")
    same = lambda df: sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)
    assert same(P2.under_directories(nodes)) == same(P2.by_directories(nodes).where("not less"))
    left, right = O.path_segments(nodes)
    assert left.count() == 3 * (P2.SLIPS + 1) and right.count() == 3 * 4 * (P2.SLIPS + 1)
    # below the explosion into directories, and not above it
    plan = right._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("array_join") > plan.rindex("Generate")
