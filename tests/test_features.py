"""G1 (hand-worked features), the edge groups, and the equalities between plan shapes."""
import math

import numpy as np
import pytest

from stridex.operators import features as feat
from stridex.schema import FEATURES

G1 = [(0, 1.0, 0.0, 0.0), (100000000, 3.0, 10.0, 4.0), (200000000, 5.0, 9.95, 0.0), (300000000, 7.0, 10.2, -4.0)]
G1_EXPECTED = {
    "mean_x": 4.0, "mean_y": 7.5375, "mean_z": 0.0,
    "var_x": 6.66666667, "var_y": 25.26229167, "var_z": 10.66666667,
    "std_x": 2.23606798, "std_y": 4.35278287, "std_z": 2.82842712,
    "aad_x": 2.0, "aad_y": 3.76875, "aad_z": 2.0,
    "resultant": 9.079379805105745, "peak_time": 200000000.0, "diff_xy": -3.5375,
}


def frame(spark, groups):
    rows = [(g, t, x, y, z) for g, pts in groups.items() for (t, x, y, z) in pts]
    return spark.createDataFrame(rows, "g string, timestamp long, x double, y double, z double")


@pytest.mark.parametrize("bounded", [False, True])
def test_g1(spark, bounded):
    r = feat.features(frame(spark, {"g1": G1}), ["g"], bounded=bounded).collect()[0]
    assert r.n == 4
    for k, v in G1_EXPECTED.items():
        assert r[k] == pytest.approx(v, abs=1e-8), k


def test_g1_untruncated_peaks(spark):
    r = feat.features(frame(spark, {"g1": G1}), ["g"], truncate_y=False).collect()[0]
    assert r.peak_time == 100000000.0


EDGE = {
    "one_row": [(5, 1.0, 2.0, 3.0)],
    "max_2_5": [(0, 0.0, 2.5, 0.0), (10, 0.0, 1.0, 0.0), (20, 0.0, 2.2, 0.0)],      # trunc 2 <= 2.25: no peaks
    "negative": [(0, 0.0, -0.5, 0.0), (10, 0.0, -0.7, 0.0), (30, 0.0, -0.2, 0.0)],  # all cut to 0 > 0.9*(-0.2)
    "same_time": [(7, 0.0, 10.0, 0.0), (7, 0.0, 10.0, 0.0), (9, 0.0, 1.0, 0.0)],    # two peak rows, one time
}


@pytest.mark.parametrize("bounded", [False, True])
def test_edge_groups(spark, bounded):
    got = {r.g: r for r in feat.features(frame(spark, EDGE), ["g"], bounded=bounded).collect()}
    one = got["one_row"]
    assert (one.var_x, one.var_y, one.var_z, one.std_x, one.std_y, one.std_z, one.peak_time) == (0.0,) * 7
    assert got["max_2_5"].peak_time == 0.0
    assert got["negative"].peak_time == 15.0
    assert got["same_time"].peak_time == 0.0
    for r in got.values():
        assert all(r[c] is not None and not math.isnan(r[c]) for c in FEATURES)


def test_no_rows_gives_zero_vector(spark):
    f = feat.features(frame(spark, {"g1": G1}), ["g"]).withColumnRenamed("g", "user_id")
    users = spark.createDataFrame([("g1",), ("nobody",)], "user_id string")
    got = {r.user_id: r for r in feat.zero_features(users, f).collect()}
    assert got["nobody"].n == 0 and all(got["nobody"][c] == 0.0 for c in FEATURES)
    assert got["g1"].mean_y == pytest.approx(7.5375)


def _random_groups(seed, groups=12):
    rng = np.random.default_rng(seed)
    out = {}
    for k in range(groups):
        n = int(rng.integers(1, 40))
        ts = np.sort(rng.choice(10_000, size=n, replace=False)) * 1000
        out[f"g{k}"] = [(int(t), float(rng.normal() * 3), float(rng.uniform(-2, 12)), float(rng.normal()))
                        for t in ts]
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_plan_shapes_agree_and_match_numpy(spark, seed):
    groups = _random_groups(seed)
    df = frame(spark, groups)
    a = {r.g: r for r in feat.features(df, ["g"], bounded=False).collect()}
    b = {r.g: r for r in feat.features(df, ["g"], bounded=True).collect()}
    lag = {r.g: r.peak_time for r in feat.peak_time_by_lag(df, ["g"]).collect()}
    for g, pts in groups.items():
        t = np.array([p[0] for p in pts]); x = np.array([p[1] for p in pts])
        y = np.array([p[2] for p in pts]); z = np.array([p[3] for p in pts])
        peaks = np.unique(t[np.trunc(y) > 0.9 * y.max()])
        pt = float(np.mean(np.diff(peaks))) if len(peaks) > 1 else 0.0
        want = {"mean_x": x.mean(), "var_y": y.var(ddof=1) if len(y) > 1 else 0.0, "std_z": z.std(),
                "aad_y": np.abs(y - y.mean()).mean(), "resultant": np.sqrt(x * x + y * y + z * z).mean(),
                "peak_time": pt, "diff_xy": x.mean() - y.mean()}
        for k, v in want.items():
            assert a[g][k] == pytest.approx(v, rel=1e-9, abs=1e-9), (g, k)
            assert b[g][k] == pytest.approx(v, rel=1e-9, abs=1e-9), (g, k)
        assert lag.get(g, 0.0) == pytest.approx(pt)
        # population std squared times n/(n-1) is the sample variance
        if len(x) > 1:
            assert a[g].std_x ** 2 * len(x) / (len(x) - 1) == pytest.approx(a[g].var_x)


def test_peak_deltas_positive(spark):
    df = frame(spark, _random_groups(9))
    assert all(r.delta > 0 for r in feat.peak_deltas(df, ["g"], chunk=5000).collect())


def test_bad_axes_shape_sessions_but_not_features(spark):
    from stridex.operators import sessions as ses
    rows = [("u", "Walking", 0, 1.0, 2.0, 3.0), ("u", "Walking", 10, None, 2.0, 3.0),
            ("u", "Walking", 20, float("nan"), 2.0, 3.0), ("u", "Walking", 30, 3.0, 4.0, 5.0)]
    df = spark.createDataFrame(rows, "user_id string, activity string, timestamp long, x double, y double, z double")
    s = ses.gap_sessions(df, gap=10, width=100).collect()
    assert [(r.session_start, r.session_stop, r.n_samples) for r in s] == [(0, 30, 4)]
    f = feat.features(df, ["user_id"]).collect()[0]
    assert f.n == 2 and f.mean_x == 2.0
