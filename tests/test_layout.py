"""Clustered sample tables: what is read, not only what is pushed."""
import pytest
from pyspark.sql import functions as F

from stridex.operators import selection as sel
from stridex.sources import layout as L
from stridex.sources.commits import CommitLog

USERS, EACH = 200, 500


@pytest.fixture(scope="module")
def table(spark, tmp_shared):
    """100,000 samples in small row groups and pages; every third sample belongs to one hot user."""
    path = tmp_shared("clustered")
    rows = spark.range(0, USERS * EACH, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % USERS)).alias("user_id"),
        F.col("id").alias("timestamp"), *[(F.col("id") % k).cast("double").alias(c) for c, k in (("x", 7), ("y", 11), ("z", 13))])
    L.write_clustered(rows, path, "a", buckets=8, partitions=16, **{"parquet.block.size": "4096", "parquet.page.size": "1024",
                                                                    "parquet.page.row.count.limit": "100"})
    return path, rows


def _scanned(df):
    """(rows that left the scan before any filter, files read) of an executed query."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.getClass().getSimpleName():
        plan = plan.executedPlan()
    leaves, out = plan.collectLeaves(), [0, 0]
    for i in range(leaves.size()):
        m = leaves.apply(i).metrics()
        for k, name in enumerate(("numOutputRows", "numFiles")):
            if m.contains(name):
                out[k] += m.apply(name).value()
    return out


def test_a_user_is_read_without_a_scan(spark, table):
    path, rows = table
    t = L.read_clustered(spark, path)
    n_rows, n_files = _scanned(t.where("x >= 0"))
    assert n_rows == USERS * EACH and n_files >= 16
    mine = sel.filter_user(t, "u7")
    n, files = _scanned(mine)
    want = rows.where("user_id = 'u7'").count()
    assert mine.count() == want and files < n_files / 2 and n < 0.02 * n_rows    # the bucket's files, and few of their row groups
    hot = sel.filter_open_range(sel.filter_user(t, "hot"), 1000, 1300)
    n, files = _scanned(hot)
    assert hot.count() == 100 and n < 0.02 * n_rows                          # a stretch of the hot user, not all of it
    n, _ = _scanned(sel.filter_user(t, "nobody"))
    assert n < 0.02 * n_rows


def test_the_hot_user_is_dealt_over_files(spark, table):
    path, rows = table
    per = L.read_clustered(spark, path).where("user_id = 'hot'").groupBy(F.input_file_name()).count()
    assert per.count() >= 4 and per.agg(F.max("count")).first()[0] < 0.1 * USERS * EACH


def test_named_and_many_users(spark, table, monkeypatch):
    """Few users of a frame become names, many become buckets; the rows are the same."""
    from stridex.streaming.live_prediction import _touched
    path, rows = table
    t = L.read_clustered(spark, path)
    users = spark.createDataFrame([("u7",), ("u9",), ("u7",), ("nobody",)], "user_id string")
    want = rows.where("user_id IN ('u7', 'u9')").count()
    got = _touched(t, users)
    assert got.count() == want and "u9" in got._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(L, "NAMED_USERS", 2)
    got = _touched(t, users)
    assert got.count() == want and "u9" not in got._jdf.queryExecution().optimizedPlan().toString().split("Join")[-1][:400]
    plain = t.drop("user_bucket")
    assert _touched(plain, users).count() == want and L.buckets_of(plain) is None


def test_parts_are_appended_once(spark, tmp_shared):
    path = tmp_shared("parts")
    rows = spark.range(10).select(F.concat(F.lit("u"), "id").alias("user_id"), F.col("id").alias("timestamp"))
    for part in ("monday", "monday", "tuesday"):
        L.write_clustered(rows, path, part, buckets=4)
    assert L.read_clustered(spark, path).count() == 20
    L.write_clustered(rows, path, "other", buckets=2)
    with pytest.raises(ValueError, match="buckets"):
        L.read_clustered(spark, path)
    assert len(CommitLog(spark, path).keys()) == 3


def test_stream_predict_reads_the_clustered_table(spark, tmp_shared, table):
    """ST1 over a clustered table: the batch's user costs its own rows."""
    from stridex.streaming.live_prediction import _touched
    path, rows = table
    one = spark.createDataFrame([("u11",)], "user_id string")
    got = sel.latest_n(_touched(L.read_clustered(spark, path), one), 20)
    n, _ = _scanned(got)
    assert got.count() == 20 and n < 0.03 * USERS * EACH
