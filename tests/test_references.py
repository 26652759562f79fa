from datetime import datetime as dt

from pyspark.sql import functions as F

from lodeweave.operators import references as R

T = [dt(2024, 1, d) for d in range(1, 20)]
REC = "number bigint, indexed_at timestamp, deleted_at timestamp, extra string"
REF = "k string, number bigint, indexed_at timestamp, reason string"


def found(spark, refs, records):
    r = R.references(spark.createDataFrame(refs, REF), "t", F.col("k"), "number", "indexed_at")
    return {(x.ref_key, x.target_key): x.reason for x in R.orphan_references(r, spark.createDataFrame(records, REC), "number").collect()}


def test_reasons(spark):
    records = [
        (1, T[0], None, None),
        (2, T[0], None, None), (2, T[5], T[5], None),
        (3, T[0], None, None), (3, T[2], T[2], None), (3, T[6], None, None),
        (4, T[9], None, None),
        (None, T[0], None, None),
    ]
    refs = [("a", 1, T[3], None), ("b", 2, T[3], None), ("c", 3, T[3], None), ("d", 4, T[3], None), ("d", 4, T[10], None), ("e", 0, T[3], None), ("f", -7, T[3], None), ("g", None, T[3], None), ("h", 4, T[9], None)]
    assert found(spark, refs, records) == {("b", 2): "withdrawn", ("d", 4): "later", ("e", 0): "missing", ("f", -7): "missing"}


def test_repeated_rows_and_ties(spark):
    records = [(1, T[1], None, None), (1, T[4], None, None), (1, T[4], T[4], None)]
    assert found(spark, [("a", 1, T[5], None)] * 3, records) == {("a", 1): "withdrawn"}


def test_empty_and_null_times(spark):
    assert found(spark, [], []) == {}
    assert found(spark, [("a", 1, None, None), (None, 1, T[0], None)], [(1, None, None, None)]) == {}
    assert found(spark, [("a", 1, None, None)], []) == {("a", 1): "missing"}


def fold(spark, batches):
    state, seen = spark.createDataFrame([], R.STATE), None
    for refs, records in batches:
        r = R.references(spark.createDataFrame(refs, REF), "t", F.col("k"), "number", "indexed_at")
        fresh = r if seen is None else R.unseen(r, seen)
        state = R.add_deltas(state, R.batch_deltas(state, fresh, spark.createDataFrame(records, REC), "number"))
        seen = r if seen is None else seen.unionByName(fresh)
    return {r.target_key: (r.refs, r.present, r.reason) for r in R.orphans_of_state(state).select("target_key", "refs", F.lit(0).alias("present"), "reason").collect()}


def test_raw_batches_equal_one_pass(spark):
    refs = [("a", k % 4, T[k], None) for k in range(12)]
    records = [(0, T[1], None, None), (0, T[8], T[8], None), (1, T[2], None, None), (1, T[5], T[5], None), (1, T[9], None, None), (2, T[3], T[3], None), (1, T[2], None, None)]
    whole = fold(spark, [(refs, records)])
    assert {k: v[2] for k, v in whole.items()} == {0: "withdrawn", 2: "withdrawn", 3: "missing"}
    for cut in (1, 4, 8, 11):
        early, late = ([x for x in refs if (x[2] < T[cut]) == side] for side in (True, False))
        before, after = ([x for x in records if (x[1] < T[cut]) == side] for side in (True, False))
        assert fold(spark, [(early, before), (late, after)]) == whole
        assert fold(spark, [(late, after), (early, before)]) == whole  # late batches
        assert fold(spark, [(early, before), (early, before), (late, after), (late, before)]) == whole  # delivered again


def test_a_withdrawal_in_a_later_batch_makes_an_orphan(spark):
    assert fold(spark, [([("a", 1, T[2], None)], [(1, T[1], None, None)]), ([], [(1, T[3], T[3], None)])]) == {1: (1, 0, "withdrawn")}
    assert fold(spark, [([("a", 1, T[2], None)], [(1, T[1], None, None)]), ([], [(1, T[3], T[3], None)]), ([], [(1, T[4], None, None)])]) == {}
