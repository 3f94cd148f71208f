"""Property tests (hypothesis): sessions and stop-anchored intervals against brute force on random inputs with
duplicate and negative timestamps, random gap, width and chunk, for both session methods."""
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stridex.operators import intervals as iv
from stridex.operators import sessions as ses
from test_sessions_intervals import _brute_sessions, _brute_stop_assign

times = st.lists(st.integers(min_value=-300, max_value=300), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ta=times, tb=times, gap=st.integers(1, 40), width=st.integers(1, 60), chunk=st.integers(1, 500),
       method=st.sampled_from(["chunk", "range"]))
def test_sessions_and_intervals_match_brute_force(spark, ta, tb, gap, width, chunk, method):
    rows = [("a", "Walking", t, 1.0, 1.0, 1.0) for t in ta] + [("b", "Sitting", t, 2.0, 2.0, 2.0) for t in tb]
    pdf = pd.DataFrame(rows, columns=["user_id", "activity", "timestamp", "x", "y", "z"])
    df = spark.createDataFrame(rows, "user_id string, activity string, timestamp long, x double, y double, z double")
    got = ses.gap_sessions(df, gap=gap, width=width, chunk=chunk, method=method, partitions=3)
    got = sorted(tuple(r) for r in got.select("user_id", "activity", "session_id", "session_start", "session_stop",
                                              "n_samples").collect())
    assert got == _brute_sessions(pdf, gap)
    a = iv.assign_intervals(df, gap=gap, width=width, anchor="stop", chunk=chunk, method=method)
    a = sorted(tuple(r) for r in a.select("user_id", "activity", "session_id", "i", "lo", "hi", "timestamp")
               .collect())
    assert a == _brute_stop_assign(pdf, gap, width)


samples = st.lists(st.tuples(st.integers(0, 50), st.floats(-20, 20, allow_nan=False),
                             st.floats(-3, 15, allow_nan=False), st.floats(-5, 5, allow_nan=False)),
                   min_size=1, max_size=30)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(g1=samples, g2=samples)
def test_features_plans_agree_with_numpy(spark, g1, g2):
    import numpy as np

    from stridex.operators.features import features
    rows = [("p", t * 1000, x, y, z) for t, x, y, z in g1] + [("q", t * 1000, x, y, z) for t, x, y, z in g2]
    df = spark.createDataFrame(rows, "g string, timestamp long, x double, y double, z double")
    a = {r.g: r for r in features(df, ["g"]).collect()}
    b = {r.g: r for r in features(df, ["g"], bounded=True).collect()}
    for g, pts in (("p", g1), ("q", g2)):
        t = np.array([p[0] * 1000 for p in pts]); y = np.array([p[2] for p in pts]); x = np.array([p[1] for p in pts])
        peaks = np.unique(t[np.trunc(y) > 0.9 * y.max()])
        want_pt = float(np.mean(np.diff(peaks))) if len(peaks) > 1 else 0.0
        for r in (a[g], b[g]):
            assert r.n == len(pts)
            assert abs(r.peak_time - want_pt) < 1e-6
            assert abs(r.aad_x - np.abs(x - x.mean()).mean()) < 1e-9
            assert abs(r.var_y - (y.var(ddof=1) if len(y) > 1 else 0.0)) < 1e-7
