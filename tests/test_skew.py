"""A group holding most rows: results stay exact and AQE splits it in the statistics join (no one-task group)."""
from contextlib import contextmanager

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stridex.operators import features as feat
from stridex.operators import selection as sel
from stridex.operators import sessions as ses

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def skewed(spark, hot_rows=200_000, cold_groups=500):
    """One frame (no union Catalyst could split): the first ``hot_rows`` ids are group "hot", the next
    ``cold_groups * 10`` ids spread over ``cold_groups`` groups."""
    n = hot_rows + cold_groups * 10
    r = spark.range(0, n, numPartitions=8)
    hot = F.col("id") < F.lit(hot_rows)
    cid = F.col("id") - F.lit(hot_rows)
    return r.select(
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("c"), (cid % cold_groups).cast("string"))).alias("g"),
        F.when(hot, F.col("id")).otherwise(cid).alias("timestamp"),
        F.when(hot, (F.col("id") % 7).cast("double")).otherwise(F.lit(1.0)).alias("x"),
        F.when(hot, (F.col("id") % 11).cast("double")).otherwise((cid % 5).cast("double")).alias("y"),
        F.when(hot, F.lit(1.0)).otherwise(F.lit(2.0)).alias("z"))


def test_hot_group_is_split_and_exact(spark):
    with conf(spark, SKEW_CONF):
        f = feat.features(skewed(spark), ["g"])
        rows = {r.g: r for r in f.collect()}
        plan = f._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    hot = rows["hot"]
    n = 200_000
    assert hot.n == n
    assert hot.mean_x == pytest.approx(sum(i % 7 for i in range(n)) / n)
    mean_y = sum(i % 11 for i in range(n)) / n
    assert hot.aad_y == pytest.approx(sum(abs(i % 11 - mean_y) for i in range(n)) / n)
    assert hot.peak_time == 11.0                           # y = 10 at every 11th timestamp
    assert len(rows) == 501


def test_hot_user_latest_n_is_partially_limited(spark):
    df = skewed(spark).withColumnRenamed("g", "user_id")
    plan = sel.latest_n(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


DAY = 86_400 * 10**9


def _cut_evenly(df, n, instants=False):
    """With default arguments the hot key is found and no window of rows or of chunk summaries holds a large share."""
    limit, hot = ses.hot_keys(df, ses.KEYS)
    assert len(hot) == 1 and n / 3.1 < list(hot.values())[0] <= n / 2.9
    rows = df.select(*ses.KEYS, "timestamp")
    cut = ses._chunked(rows.distinct() if instants else rows, ses.KEYS, ses.quantile_cuts(df, ses.KEYS, limit, hot))
    sizes = cut.groupBy("user_id", "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] < 0.01 * n
    far = sizes.groupBy("user_id", F.floor(F.col("_chunk") / ses.FAN).alias("f")).count()
    assert far.agg(F.max("count")).first()[0] <= ses.FAN


def _plain_sessions(df, gap):
    by = {}
    for u, t in df.select("user_id", "timestamp").collect():
        by.setdefault(u, []).append(t)
    want = []
    for u, ts in by.items():
        ts.sort()
        cut = [0] + [i for i in range(1, len(ts)) if ts[i] - ts[i - 1] > gap] + [len(ts)]
        want += [(u, k, ts[a], ts[b - 1], b - a) for k, (a, b) in enumerate(zip(cut, cut[1:]))]
    return sorted(want)


@pytest.mark.parametrize("gap", [0, 40, 10**6])
def test_burst_with_default_arguments(spark, gap):
    """Nearly all samples of the hot user lie in a ten-thousandth of its time, and thousands are copies of one instant."""
    n = 30_000
    t = (F.when(F.col("id") % 15 == 0, F.lit(777)).when(F.col("id") % 3 == 0, 1000 + F.col("id") * 3 + F.col("id") % 2)
         .otherwise(F.col("id") * 1_000_000))
    df = spark.range(0, n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 997).cast("string"))).alias("user_id"),
        F.lit("Walking").alias("activity"), t.cast("long").alias("timestamp"))
    df = df.unionByName(spark.createDataFrame([("hot", "Walking", 10**9)], "user_id string, activity string, timestamp long"))
    _cut_evenly(df, n, instants=True)
    got = ses.gap_sessions(df, gap=gap, width=10)
    assert sorted((x.user_id, x.session_id, x.session_start, x.session_stop, x.n_samples) for x in got.collect()) == _plain_sessions(df, gap)
    lab = ses.label_sessions(df, gap=gap)
    assert "_chunk" in lab._jdf.queryExecution().executedPlan().toString()
    from_rows = ses.sessions_from_labelled(lab, 10)
    assert sorted(map(tuple, from_rows.collect())) == sorted(map(tuple, got.collect()))
    w = Window.partitionBy("user_id").orderBy("timestamp")
    diffs = df.select("user_id", "timestamp", (F.col("timestamp") - F.lag("timestamp").over(w)).alias("diff"))
    key = lambda r: (r[0], r[1], -1 if r[2] is None else r[2])
    assert sorted(map(tuple, ses.time_diffs(df).select("user_id", "timestamp", "diff").collect()), key=key) == sorted(
        map(tuple, diffs.collect()), key=key)


def test_cuts_of_several_hot_keys(spark):
    """Keys of very different size: each is cut into about as many chunks as its rows over the limit, cold ones not at all."""
    df = spark.range(0, 60_000, numPartitions=4).select(
        F.expr("CASE WHEN id % 2 = 0 THEN 'a' WHEN id % 10 = 1 THEN 'b' WHEN id % 50 = 3 THEN 'c' ELSE concat('u', id % 4999) END")
        .alias("user_id"), F.lit("Walking").alias("activity"), (F.col("id") * F.col("id")).alias("timestamp"))
    limit, hot = ses.hot_keys(df, ses.KEYS)
    cut = ses._chunked(df, ses.KEYS, ses.quantile_cuts(df, ses.KEYS, limit, hot))
    got = {r.user_id: (r.chunks, r.most) for r in cut.groupBy("user_id", "_chunk").count().groupBy("user_id").agg(
        F.count("count").alias("chunks"), F.max("count").alias("most")).collect()}
    assert set(u for u, (c, _) in got.items() if c > 1) == {"a", "b", "c"}
    assert all(m <= 2.5 * limit for _, m in got.values()) and got["a"][0] >= 30_000 // (2 * limit)
    assert ses.hot_limit(10) == 256 and ses.hot_limit(10**6) == 3906 and ses.hot_limit(10**12) == 10**6


@pytest.mark.parametrize("gap", [0, DAY, 2 * DAY])
def test_hot_user_sessions_with_default_arguments(spark, gap):
    """One user holds a third of the rows. With default arguments no window, of rows or of chunk summaries, holds more
    than a small share, whatever the gap, and the sessions are those of a plain scan."""
    n, step = 30_000, 30 * DAY // 30_000
    r = spark.range(0, n, numPartitions=8)
    df = r.select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 997).cast("string")))
                  .alias("user_id"), F.lit("Walking").alias("activity"),
                  (F.col("id") * step + F.col("id") % 7).alias("timestamp"))
    _cut_evenly(df, n)
    s = ses.gap_sessions(df, gap=gap, width=10)
    assert "_chunk" in s._jdf.queryExecution().executedPlan().toString()
    got = [(x.user_id, x.session_id, x.session_start, x.session_stop, x.n_samples) for x in s.collect()]
    assert sorted(got) == _plain_sessions(df, gap)


@pytest.mark.parametrize("chunk", [1, 7, 50, 5000, 10**9])
def test_sessions_at_any_chunk(spark, chunk):
    """Chunks of one row, chunks over several far groups, one chunk: labels as in a plain scan."""
    import random
    rng = random.Random(chunk)
    rows = [("ab"[rng.random() < 0.2], "Walking", rng.choice([rng.randrange(0, 3000), rng.randrange(0, 200_000)]))
            for _ in range(700)]
    rows = list({(u, t): (u, a, t) for u, a, t in rows}.values())
    df = spark.createDataFrame(rows, "user_id string, activity string, timestamp long")
    got = {(r.user_id, r.timestamp): (r.session_id, r.session_start, r.prev_timestamp)
           for r in ses.label_sessions(df, gap=40, chunk=chunk).collect()}
    want = {}
    for u in "ab":
        sid, start, prev = 0, None, None
        for t in sorted(t for v, _, t in rows if v == u):
            if prev is None:
                start = t
            elif t - prev > 40:
                sid, start = sid + 1, t
            want[u, t] = (sid, start, prev)
            prev = t
    assert got == want


def test_hot_group_peaks_are_split(spark):
    with conf(spark, SKEW_CONF):
        for q in (feat.peak_rows, feat.peak_deltas):
            df = q(skewed(spark), ["g"])
            n = df.count()
            out = q(skewed(spark), ["g"])
            out.collect()
            assert n > 10_000 and "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_latest_n_is_cut_before_the_shuffle_for_any_n(spark):
    df = skewed(spark).withColumnRenamed("g", "user_id")
    plan = sel.latest_n(df, 1001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Partial") >= 2 and "_slice" in plan


def test_latest_n_ties_do_not_depend_on_the_layout(spark):
    rows = [("u", t, float(x), float(t % 3), 0.0) for t in (5, 5, 5, 6, 6, 4) for x in range(4)]
    cols = "user_id string, timestamp long, x double, y double, z double"
    got = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows[::1 if parts < 7 else -1], cols).repartition(parts, "x" if parts > 1 else "y")
        got.add(tuple(sorted(map(tuple, sel.latest_n(df, 10).collect()))))
        got.add(tuple(sorted(map(tuple, sel.latest_n_user(df, "u", 10).collect()))))
    assert len(got) == 1


def test_hot_user_semi_join_is_split(spark):
    with conf(spark, SKEW_CONF):
        df = skewed(spark).withColumnRenamed("g", "user_id")
        users = df.select("user_id").distinct()                 # an unbounded user list (no broadcast)
        kept = sel.restrict_to_users(df, users)
        assert kept.count() == 205_000
        out = sel.restrict_to_users(df, users)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan


def test_burst_with_copies_range_method(spark):
    base = skewed(spark, hot_rows=100_000, cold_groups=50).select(
        F.col("g").alias("user_id"), F.lit("Walking").alias("activity"), "timestamp")
    copies = spark.range(0, 1000, numPartitions=4).select(
        F.lit("hot").alias("user_id"), F.lit("Walking").alias("activity"), F.lit(5).cast("long").alias("timestamp"))
    df = base.unionByName(copies)
    got = ses.gap_sessions(df, gap=5, width=10, method="range", partitions=16)
    hot = got.where(F.col("user_id") == "hot").collect()
    assert len(hot) == 1
    assert (hot[0].session_start, hot[0].session_stop, hot[0].n_samples) == (0, 99_999, 101_000)
    ref = ses.gap_sessions(df, gap=5, width=10, chunk=10**9)  # one time chunk holds the whole burst
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in ref.collect())
