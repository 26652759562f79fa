from datetime import datetime as dt, timedelta

from pyspark.sql import functions as F

from lodeweave.operators import monitoring as M, references as R
from lodeweave.operators.linking import current
from lodeweave.session import read
from lodeweave.sources.snapshots import KeyedTable
from lodeweave.streaming import monitor, upserts


def split_by_time(df, time, path, parts):
    ranked = df.orderBy(time).coalesce(1)
    n = ranked.count()
    rows = ranked.collect()
    for i in range(parts):
        df.sparkSession.createDataFrame(rows[n * i // parts : n * (i + 1) // parts], df.schema).coalesce(1).write.mode("append").parquet(f"{path}")


def test_replayed_batches_equal_one_pass(spark, sf_dir, tmp_path):
    issues = read(spark, sf_dir, "issues", "issue_number", "title", "state", "updated_at", "indexed_at")
    split_by_time(issues, "indexed_at", f"{tmp_path}/in", 3)
    table = KeyedTable(spark, f"{tmp_path}/issues", "issue_number", issues.schema, 4)
    assert upserts.watermark_of(table) is None
    each = upserts.upsert_newest(table, "issue_number", "updated_at", "state", "title")
    for _ in range(2):  # the second run finds nothing new
        upserts.run_available(upserts.file_stream(spark, f"{tmp_path}/in", issues.schema), f"{tmp_path}/cp", each)
    want = sorted(map(tuple, current(issues, "issue_number", "updated_at", "state", "title").select(*issues.columns).collect()), key=repr)
    stored = lambda: sorted(map(tuple, table.read().select(*issues.columns).collect()), key=repr)
    assert stored() == want
    mark = upserts.watermark_of(table)
    each(issues.orderBy("indexed_at").limit(20), 1)  # a batch delivered again, and late rows, change nothing
    each(issues.limit(0), 9)
    assert stored() == want and upserts.watermark_of(table) == mark


def test_a_merge_rewrites_touched_partitions_only(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", "id", "id bigint, v string", 8)
    upsert = lambda stored, new: new.unionByName(stored.join(new, "id", "left_anti"))
    table.merge(spark.range(100).selectExpr("id", "'a' as v"), upsert)
    files = {str(f): f.stat().st_mtime_ns for f in tmp_path.glob("t/_bucket=*/*.parquet")}
    table.merge(spark.createDataFrame([(5, "b")], "id bigint, v string"), upsert)
    kept = [f for f in files if f in {str(g) for g in tmp_path.glob("t/_bucket=*/*.parquet")}]
    assert table.read().where("v = 'b'").collect()[0].id == 5 and table.read().count() == 100
    assert len({f.split("_bucket=")[1][0] for f in kept}) == 7


def test_late_links_upgrade_weaker_ones(spark, tmp_path):
    schema = "issue_number bigint, pr_number bigint, confidence double, source string, extracted_at timestamp"
    table = KeyedTable(spark, f"{tmp_path}/links", ["issue_number", "pr_number"], schema, 4)
    each = upserts.upgrade_links(table)
    t = dt(2024, 1, 1)
    each(spark.createDataFrame([(1, 2, 0.5, "temporal_author", t), (3, 4, 0.85, "body_closes_keyword", t)], schema), 0)
    each(spark.createDataFrame([(1, 2, 1.0, "explicit", t), (3, 4, 0.5, "temporal_author", t), (5, 6, 0.5, "temporal_author", t)], schema), 1)
    want = {(1, 2): (1.0, "explicit"), (3, 4): (0.85, "body_closes_keyword"), (5, 6): (0.5, "temporal_author")}
    assert {(r.issue_number, r.pr_number): (r.confidence, r.source) for r in table.read().collect()} == want


def test_parts_of_a_newer_record_replace_all_older_ones(spark, tmp_path):
    schema = "pr_number bigint, part int, body string, indexed_at timestamp"
    table = KeyedTable(spark, f"{tmp_path}/parts", "pr_number", schema, 4)
    each = upserts.replace_children(table, "pr_number")
    t, u = dt(2024, 1, 1), dt(2024, 1, 2)
    old, new = [(1, i, f"a{i}", t) for i in range(3)] + [(2, 0, "x", t)], [(1, 0, "b", u)]
    for number, rows in enumerate((old, new, new, old)):  # delivered again and late
        each(spark.createDataFrame(rows, schema), number)
    assert sorted((r.pr_number, r.part, r.body) for r in table.read().collect()) == [(1, 0, "b"), (2, 0, "x")]


def test_streamed_reference_counts_equal_one_pass(spark, sf_dir, tmp_path):
    """Raw rows in batches, one of them delivered twice: the maintained counts give the orphans of one pass over all rows."""
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # the smallest tables have no such orphan
    pulls = read(spark, sf_dir, "pulls", "pr_number", "indexed_at", "deleted_at").select(F.lit("").alias("sha"), "pr_number", "indexed_at", "deleted_at")
    commits = read(spark, sf_dir, "commits", "sha", "pr_number", "indexed_at").select(F.coalesce("sha", F.lit("?")).alias("sha"), "pr_number", "indexed_at", F.lit(None).cast("timestamp").alias("deleted_at"))
    rows = pulls.unionByName(commits)
    split_by_time(rows, "indexed_at", f"{tmp_path}/in", 3)
    keys = KeyedTable(spark, f"{tmp_path}/keys", "target_key", R.STATE + ", batch bigint", 4)
    seen = KeyedTable(spark, f"{tmp_path}/seen", "target_key", "ref_table string, ref_key string, target_key bigint, first_at timestamp, batch bigint", 4)
    kinds = lambda b: (R.references(b.where("sha <> ''"), "commits", F.col("sha"), "pr_number", "indexed_at"), b.where("sha = ''"))
    each = upserts.fold_references(keys, seen, "pr_number", kinds)
    upserts.run_available(upserts.file_stream(spark, f"{tmp_path}/in", rows.schema), f"{tmp_path}/cp", each)
    want = R.orphan_keys(R.key_state(R.reference_deltas(kinds(rows)[0]).unionByName(R.existence_deltas(kinds(rows)[1], "pr_number"))))
    want = sorted(map(tuple, want.select("target_key", "refs", "reason").collect()))
    got = lambda: sorted(map(tuple, R.orphans_of_state(keys.read()).select("target_key", "refs", "reason").collect()))
    assert got() == want and want
    each(rows.where("pr_number % 3 = 0"), 2)  # the last batch number again
    each(rows.where("pr_number % 3 = 0"), 7)  # rows delivered again as a new batch
    assert got() == want


def test_streamed_windows_and_duplicates(spark, tmp_path):
    t = dt(2024, 1, 1)
    rows = [(i, t + timedelta(minutes=10 * i), "a", float(i)) for i in range(30)]
    schema = "event_id bigint, ts timestamp, kind string, value double"
    spark.createDataFrame(rows + rows[:5], schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = monitor.distinct_within(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "ts", "1 hour", "event_id")
    query = M.tumbling(stream, "ts", "1 hour", "kind").writeStream.outputMode("append").format("memory").queryName("windows").start()
    query.processAllAvailable()
    query.stop()
    got = {(r.window_start, r.n) for r in spark.sql("select * from windows").collect()}
    want = {(r.window_start, r.n) for r in M.tumbling(spark.createDataFrame(rows, schema), "ts", "1 hour", "kind").collect()}
    assert got and got <= want


def test_refreshes_of_all_one_and_what_moved(spark, tmp_path):
    schema = "path string, body string, indexed_at timestamp"
    table = KeyedTable(spark, f"{tmp_path}/docs", "path", schema, 4)
    t, u = dt(2024, 1, 1), dt(2024, 1, 2)
    frame = lambda *rows: spark.createDataFrame(list(rows), schema)
    stored = lambda: {(r.path, r.body) for r in table.read().collect()}
    upserts.refresh_all(table, frame(("a", "1", t), ("b", "1", t), ("c", "1", t)))
    upserts.refresh_all(table, frame(("a", "2", t), ("d", "1", t)))
    assert stored() == {("a", "2"), ("d", "1")}
    source = frame(("a", "3", u), ("d", "1", t))
    assert upserts.refresh_if_moved(table, source) and not upserts.refresh_if_moved(table, source)
    upserts.refresh_one(table, frame(("d", "9", t), ("a", "9", t)), "d")
    assert stored() == {("a", "3"), ("d", "9")} and upserts.watermark_of(table) == u
    upserts.refresh_all(table, frame())
    assert stored() == set()
