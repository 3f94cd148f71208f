"""S1 (hand-worked sessions and intervals) and invariants of the chunked scan and the bucketed range join."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stridex.operators import intervals as iv
from stridex.operators import sessions as ses

U = 100_000_000
S1_TIMES = [0, 1, 2, 3, 4, 5, 6, 7, 9, 9.5]


def _frame(spark, rows, cols=("user_id", "activity", "timestamp", "x", "y", "z")):
    return spark.createDataFrame(rows, "user_id string, activity string, timestamp long, x double, y double, z double")


def s1(spark):
    return _frame(spark, [("u1", "Walking", int(t * U), 1.0, 2.0, 3.0) for t in S1_TIMES])


def test_s1_sessions(spark):
    got = ses.gap_sessions(s1(spark), gap=U, width=5 * U).orderBy("session_id").collect()
    assert [(r.session_id, r.session_start, r.session_stop, r.n_samples, r.intervals) for r in got] == [
        (0, 0, 7 * U, 8, 1), (1, 9 * U, int(9.5 * U), 2, 0)]


def test_s1_stop_anchored(spark):
    a = iv.assign_intervals(s1(spark), gap=U, width=5 * U, anchor="stop")
    got = {}
    for r in a.collect():
        got.setdefault((r.session_id, r.i, r.lo, r.hi), []).append(r.timestamp / U)
    assert {k: sorted(v) for k, v in got.items()} == {
        (0, 0, 2 * U, 7 * U): [3, 4, 5, 6],
        (0, 1, 7 * U, 12 * U): [9, 9.5],
        (1, 0, int(4.5 * U), int(9.5 * U)): [5, 6, 7, 9],
    }


def test_s1_start_anchored(spark):
    a = iv.assign_intervals(s1(spark), gap=U, width=5 * U, anchor="start")
    got = {}
    for r in a.collect():
        got.setdefault((r.session_id, r.i, r.lo, r.hi), []).append(r.timestamp / U)
    assert {k: sorted(v) for k, v in got.items()} == {
        (0, 0, 0, 5 * U): [0, 1, 2, 3, 4],
        (0, 1, 5 * U, 10 * U): [5, 6, 7],
        (1, 0, 9 * U, 14 * U): [9, 9.5],
    }


def test_s1_interval_bounds(spark):
    s = ses.gap_sessions(s1(spark), gap=U, width=5 * U)
    got = sorted((r.session_id, r.i, r.lo, r.hi) for r in iv.interval_bounds(s, width=5 * U).collect())
    assert got == [(0, 0, 2 * U, 7 * U), (0, 1, 7 * U, 12 * U), (1, 0, int(4.5 * U), int(9.5 * U))]


def test_lone_sample_equal_times_negative(spark):
    rows = [("a", "Sitting", 500, 0.0, 0.0, 0.0),                                 # lone sample
            ("b", "Sitting", 10, 0.0, 0.0, 0.0), ("b", "Sitting", 10, 1.0, 1.0, 1.0),  # equal timestamps
            ("c", "Sitting", -25, 0.0, 0.0, 0.0), ("c", "Sitting", -12, 0.0, 0.0, 0.0),
            ("c", "Sitting", 3, 0.0, 0.0, 0.0)]
    df = _frame(spark, rows)
    s = {(r.user_id, r.session_id): (r.session_start, r.session_stop, r.n_samples, r.intervals)
         for r in ses.gap_sessions(df, gap=10, width=5).collect()}
    assert s == {("a", 0): (500, 500, 1, 0), ("b", 0): (10, 10, 2, 0),
                 ("c", 0): (-25, -25, 1, 0), ("c", 1): (-12, -12, 1, 0), ("c", 2): (3, 3, 1, 0)}
    a = iv.assign_intervals(df, gap=10, width=5, anchor="stop").collect()
    # lone sample: interval 0 is (t - 5, t) -- empty; equal times: (5, 10) excludes 10 -- empty; negative: (-30,-25)
    # etc. catch nothing of their own; -12 falls in no interval of session 0 ((-30, -25)) and session 2's (-2, 3)
    assert a == []
    b = iv.assign_intervals(df, gap=10, width=20, anchor="stop").collect()
    got = sorted((r.user_id, r.session_id, r.i, r.timestamp) for r in b)
    # width 20: intervals 0 of c's sessions: (-45,-25): none; (-32,-12): -25; (-17, 3): -12
    assert got == [("c", 1, 0, -25), ("c", 2, 0, -12)]


def _brute_sessions(pdf, gap):
    out = []
    for (u, a), g in pdf.groupby(["user_id", "activity"]):
        t = np.sort(g["timestamp"].to_numpy())
        sid = np.concatenate([[0], np.cumsum(np.diff(t) > gap)])
        for k in np.unique(sid):
            tt = t[sid == k]
            out.append((u, a, int(k), int(tt.min()), int(tt.max()), len(tt)))
    return sorted(out)


def _random_samples(seed, n=600, users=3):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        u = f"u{rng.integers(users)}"
        act = ["Walking", "Jogging"][rng.integers(2)]
        t = int(rng.integers(-5000, 5000)) * 7
        rows.append((u, act, t, float(rng.normal()), float(rng.normal() * 5), float(rng.normal())))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("chunk", [50, 333, 10**9])
def test_chunked_scan_matches_brute_force(spark, seed, chunk):
    rows = _random_samples(seed)
    pdf = pd.DataFrame(rows, columns=["user_id", "activity", "timestamp", "x", "y", "z"])
    df = _frame(spark, rows)
    got = sorted(tuple(r) for r in ses.gap_sessions(df, gap=60, width=100, chunk=chunk)
                 .select("user_id", "activity", "session_id", "session_start", "session_stop", "n_samples").collect())
    assert got == _brute_sessions(pdf, 60)
    lab = ses.label_sessions(df, gap=60, chunk=chunk).collect()
    # every sample in exactly one session; neighbours within a session differ by <= gap
    assert len(lab) == len(rows)
    starts = {(r.user_id, r.activity, r.session_id): r.session_start for r in lab}
    for r in lab:
        assert r.session_start == starts[(r.user_id, r.activity, r.session_id)]
        assert r.session_start <= r.timestamp
        if r.diff is not None:
            assert (r.diff > 60) == r.jump


def _brute_stop_assign(pdf, gap, width):
    out = []
    sess = _brute_sessions(pdf, gap)
    for u, a, sid, start, stop, _ in sess:
        k = (stop - start) // width
        g = pdf[(pdf.user_id == u) & (pdf.activity == a)]
        for i in range(k + 1):
            lo, hi = stop + (i - 1) * width, stop + i * width
            for t in g.timestamp[(g.timestamp > lo) & (g.timestamp < hi)]:
                out.append((u, a, sid, i, lo, hi, int(t)))
    return sorted(out)


@pytest.mark.parametrize("bucket", [None, 13, 250, 10**7])
def test_bucketed_range_join_matches_theta_join(spark, bucket):
    rows = _random_samples(5, n=400, users=2)
    pdf = pd.DataFrame(rows, columns=["user_id", "activity", "timestamp", "x", "y", "z"])
    df = _frame(spark, rows)
    got = iv.assign_intervals(df, gap=60, width=35, anchor="stop", chunk=400, bucket=bucket)
    got = sorted(tuple(r) for r in got.select("user_id", "activity", "session_id", "i", "lo", "hi", "timestamp")
                 .collect())
    assert got == _brute_stop_assign(pdf, 60, 35)


def test_row_order_and_partitioning_change_nothing(spark):
    from stridex.operators.features import features
    rows = _random_samples(11, n=500, users=3)
    base = _frame(spark, rows)
    shuffled = _frame(spark, list(reversed(rows))).repartition(7)
    single = _frame(spark, rows).coalesce(1)

    def run(df):
        a = iv.assign_intervals(df, gap=60, width=35, anchor="stop", chunk=300)
        f = features(a, ["user_id", "activity", "session_id", "i"])
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in f.collect())
    ref = run(base)
    assert ref and run(shuffled) == ref and run(single) == ref


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_range_method_matches_brute_force_with_copies(spark, partitions):
    rows = _random_samples(21, n=500, users=2)
    rows += rows[:40]                                        # exact copies
    pdf = pd.DataFrame(rows, columns=["user_id", "activity", "timestamp", "x", "y", "z"])
    df = _frame(spark, rows)
    got = sorted(tuple(r) for r in ses.gap_sessions(df, gap=60, width=100, method="range", partitions=partitions)
                 .select("user_id", "activity", "session_id", "session_start", "session_stop", "n_samples").collect())
    assert got == _brute_sessions(pdf, 60)
    a = ses.label_sessions(df, gap=60, method="range", partitions=partitions)
    b = ses.label_sessions(df, gap=60, chunk=10**9)
    key = lambda r: (r.user_id, r.activity, r.timestamp, r.session_id, r.session_start)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))
    t1 = iv.assign_intervals(df, gap=60, width=35, anchor="start", method="range")
    t2 = iv.assign_intervals(df, gap=60, width=35, anchor="start")
    cols = ["user_id", "activity", "session_id", "i", "timestamp"]
    assert sorted(tuple(r) for r in t1.select(*cols).collect()) == sorted(tuple(r) for r in t2.select(*cols).collect())


@pytest.mark.parametrize("method", ["chunk", "range"])
def test_sessions_are_separated_by_more_than_gap(spark, method):
    rows = _random_samples(31, n=600, users=3)
    df = _frame(spark, rows)
    s = ses.gap_sessions(df, gap=40, width=100, chunk=200, method=method).collect()
    by_key = {}
    for r in s:
        by_key.setdefault((r.user_id, r.activity), []).append(r)
    assert sum(r.n_samples for r in s) == len(rows)
    for key, ss in by_key.items():
        ss.sort(key=lambda r: r.session_id)
        assert [r.session_id for r in ss] == list(range(len(ss)))
        for a, b in zip(ss, ss[1:]):
            assert b.session_start - a.session_stop > 40


def test_a_long_session_is_expanded_by_many_tasks(spark):
    """One session of ten million intervals among short ones: no task expands more than a share of it."""
    df = spark.createDataFrame([("u", "Walking", 0, 0, 10**9, 10_000_000), *[("v", "Walking", k, k, k + 5, 1) for k in range(50)]],
                               "user_id string, activity string, session_id long, session_start long, session_stop long, "
                               "intervals long")
    got = iv.interval_bounds(df, width=100).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in got) == 10_000_001 + 100 and len(got) >= 4
    assert max(r["count"] for r in got) < 4_000_000
