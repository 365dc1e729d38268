"""Block fingerprints of captures and stored snapshots."""

from pyspark.sql import functions as F

from strobe.operators.compare import compare_blocks, differing_blocks, fingerprints, frames_of
from strobe.operators.snapshots import merge_snapshot, merged, write_snapshot

SAMPLES = "conn_id long, acq_no long, sample_idx long, `A.B.Value` long, x double"
COLUMNS = ["A.B.Value", "x"]


def _samples(spark, change=None, drop=()):
    rows = [(0, a, i, 10 * i, float(i)) for a in (1, 2, 3) for i in range(40) if (a, i) not in drop]
    if change:
        rows = [r if (r[1], r[2]) != change else (*r[:4], None) for r in rows]
    return spark.createDataFrame(rows, SAMPLES)


def _marks(df):
    return fingerprints(df, COLUMNS, 8)


def test_only_differing_blocks_are_found(spark):
    a = _samples(spark)
    assert differing_blocks(_marks(a), _marks(a.orderBy(F.desc("sample_idx")).repartition(3))).count() == 0
    b = _samples(spark, change=(2, 17), drop={(3, 39)})
    got = sorted(tuple(r) for r in differing_blocks(_marks(a), _marks(b)).collect())
    assert got == [(0, 2, "x", 2), (0, 3, "A.B.Value", 4), (0, 3, "x", 4)]
    found = compare_blocks(a, b, differing_blocks(_marks(a), _marks(b)), COLUMNS, 8).collect()
    assert sorted((r.acq_no, r.sample_idx, r.before["x"], r.after and r.after["x"]) for r in found) == [(2, 17, 17.0, None), (3, 39, 39.0, None)]


def test_a_side_may_be_empty(spark):
    a, none = _samples(spark), spark.createDataFrame([], SAMPLES)
    assert differing_blocks(_marks(none), _marks(none)).count() == 0
    assert differing_blocks(_marks(a), _marks(none)).count() == 3 * 2 * 5


def test_frames_of_other_blocks_are_not_read(spark):
    index = spark.createDataFrame([(0, 2, k, "frame", 5 * k, 5) for k in range(8)] + [(0, 2, None, "end", None, None)], "conn_id long, acq_no long, frame_no long, kind string, first_sample long, n_rows long")
    blocks = spark.createDataFrame([(0, 2, "x", 2)], "conn_id long, acq_no long, column string, block long")
    assert sorted(r.frame_no for r in frames_of(index, blocks, 8).collect()) == [3, 4]  # samples 16 to 23


def test_merge_shuffles_the_changes_alone(spark):
    rows = spark.range(200).select("id", F.concat(F.lit("v"), "id").alias("v"))
    name = write_snapshot(rows, "id", "v")
    feed = spark.createDataFrame([(3, 1, "a"), (3, 2, "b"), (4, 1, None), (500, 9, "new"), (501, 1, "x"), (501, 2, None)], "f long, s int, v string")
    out = merged(spark, name, feed, "f", "v", "s")
    got = {r.key: (r.value, r.before) for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    snapshot_side = final[: final.index("Bucketed: true") if "Bucketed: true" in final else None]
    assert "Bucketed: true" in plan and snapshot_side.count("Exchange") <= 1 and plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
    want = {i: (f"v{i}", f"v{i}") for i in range(200)} | {3: ("b", "v3"), 500: ("new", None)}
    want.pop(4)
    assert got == want
    follow = merge_snapshot(spark, name, feed, "f", "v", "s")
    assert {r.key: r.value for r in spark.table(follow).collect()} == {k: v for k, (v, _) in want.items()}
    assert merged(spark, follow, feed.limit(0), "f", "v", "s").count() == len(want)
