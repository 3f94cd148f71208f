"""L1: live samples arriving as five files plus late rows; ST1 and ST2 end equal to batch prediction over all files."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fixtures import m1
from stridex.operators.selection import latest_n
from stridex.plans import prediction as pred
from stridex.plans import training as tr
from stridex.schema import ACCEL_LIVE, PREDICTION
from stridex.sources.readers import read_live
from stridex.sources.sinks import read_predictions
from stridex.streaming import start_prediction_stream
from stridex.sources.readers import stream_live

N = 100


@pytest.fixture(scope="module")
def setup(spark, tmp_shared):
    samples = m1(spark, users=6, extra_user=False).cache()
    model = tr.train_models(tr.labeled_points(samples, user_cap=None)).forest
    live = samples.drop("activity")
    # late rows for u00: one newer than its 100th newest sample (counts), one older than all (ignored)
    w = Window.partitionBy("user_id").orderBy(F.desc("timestamp"))
    ranked = live.where(F.col("user_id") == "u00").withColumn("rn", F.row_number().over(w))
    t50 = ranked.where("rn = 50").first().timestamp
    late = spark.createDataFrame([("u00", t50 + 1, 40.0, -30.0, 25.0), ("u00", 1, 50.0, 50.0, 50.0)],
                                 "user_id string, timestamp long, x double, y double, z double")
    bounds = list(live.select(F.percentile_approx("timestamp", [0.2, 0.4, 0.6, 0.8])).first()[0])
    cuts = [None, *bounds, None]
    parts = []
    for k in range(5):
        cond = F.lit(True)
        if cuts[k] is not None:
            cond = cond & (F.col("timestamp") > cuts[k])
        if cuts[k + 1] is not None:
            cond = cond & (F.col("timestamp") <= cuts[k + 1])
        parts.append(live.where(cond))
    parts[-1] = parts[-1].unionByName(late)
    return model, parts, live.unionByName(late)


def _final(spark, sink):
    p = read_predictions(spark, sink, with_batch=True)
    w = Window.partitionBy("user_id").orderBy(F.desc("batch_id"))
    return {r.user_id: r.prediction for r in
            p.withColumn("rn", F.row_number().over(w)).where("rn = 1").collect()}


@pytest.mark.parametrize("stateful", [False, True])
def test_stream_equals_batch(spark, tmp_shared, setup, stateful):
    model, parts, everything = setup
    src, sink, ckpt = tmp_shared("src"), tmp_shared("sink"), tmp_shared("ckpt")
    for k, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(src)
        q = start_prediction_stream(stream_live(spark, src, max_files_per_trigger=1), model, sink, ckpt,
                                    table=lambda: read_live(spark, src), n=N, stateful=stateful, as_of=k)
        q.awaitTermination()
    n_rows = read_predictions(spark, sink).count()
    # a restart without new files adds nothing (ST4: offsets and commits in the checkpoint)
    q = start_prediction_stream(stream_live(spark, src), model, sink, ckpt, table=lambda: read_live(spark, src),
                                n=N, stateful=stateful, as_of=99)
    q.awaitTermination()
    assert read_predictions(spark, sink).count() == n_rows
    batch = {r.user_id: r.prediction for r in pred.predict(everything, model, n=N, as_of=0).collect()}
    assert _final(spark, sink) == batch


def test_periodic_trigger_and_console(spark, tmp_shared, setup, capsys):
    model, parts, _ = setup
    src, sink, ckpt = tmp_shared("src"), tmp_shared("sink"), tmp_shared("ckpt")
    parts[0].coalesce(1).write.parquet(src)
    q = start_prediction_stream(stream_live(spark, src), model, sink, ckpt, n=N, stateful=True, as_of=5,
                                trigger={"processingTime": "1 second"}, console=3)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert read_predictions(spark, sink).count() > 0
    assert "-- batch 0" in capsys.readouterr().out


def test_progress_listener(spark, tmp_shared, setup):
    """Five files, one a batch: the listener has rows and durations of each; the sink each batch."""
    from stridex.streaming import BatchProgress
    model, parts, _ = setup
    src, sink = tmp_shared("src"), tmp_shared("sink")
    for p in parts:
        p.coalesce(1).write.mode("append").parquet(src)
    with BatchProgress(spark) as progress:
        q = start_prediction_stream(stream_live(spark, src, max_files_per_trigger=1), model, sink, tmp_shared("ckpt"), n=N, as_of=1)
        assert progress.ended(q)
        rows = progress.batches(q)
    assert [r[1] for r in rows] == [0, 1, 2, 3, 4] and [r[2] for r in rows] == [p.count() for p in parts]
    assert all(0 < r[4] <= r[3] for r in rows) and progress.slower_than(0, q) == rows
    assert progress.frame(q).count() == 5 == read_predictions(spark, sink, with_batch=True).select("batch_id").distinct().count()


def test_stream_takes_the_newest_model(spark, tmp_shared, setup):
    """A version published between two batches is used from the next batch on."""
    from stridex.sources.models import PublishedModel, publish_model
    model, parts, everything = setup
    src, sink, ckpt, path = (tmp_shared(x) for x in ("src", "sink", "ckpt", "model"))
    wrong = tr.train_models(tr.labeled_points(everything.withColumn("activity", F.lit("Sitting")), user_cap=None),
                            models=("forest",)).forest
    source = PublishedModel(path)
    for k, m in enumerate([wrong, model]):
        assert publish_model(m, path) == k + 1
        parts[0].coalesce(1).write.mode("append").parquet(src)
        start_prediction_stream(stream_live(spark, src), source, sink, ckpt, n=N, as_of=k).awaitTermination()
    said = {k: {r.prediction for r in read_predictions(spark, sink, with_batch=True).where(f"batch_id = {k}").collect()} for k in (0, 1)}
    assert said[0] == {"Sitting"} and len(said[1]) > 1


def test_sink_has_the_declared_columns(spark, tmp_shared, setup):
    model, parts, _ = setup
    src, sink = tmp_shared("src"), tmp_shared("sink")
    parts[0].coalesce(1).write.parquet(src)
    start_prediction_stream(stream_live(spark, src), model, sink, tmp_shared("c"), n=N, as_of=1).awaitTermination()
    assert read_predictions(spark, sink).schema.fieldNames() == PREDICTION.fieldNames()


def test_fresh_checkpoint_keeps_earlier_results(spark, tmp_shared, setup):
    """A new checkpoint numbers its batches from 0 again; the rows of the first run must stay."""
    model, parts, _ = setup
    sink = tmp_shared("sink")
    users = ["u00", "u01"]
    for u in users:
        src = tmp_shared("src")
        parts[0].where(F.col("user_id") == u).coalesce(1).write.parquet(src)
        start_prediction_stream(stream_live(spark, src), model, sink, tmp_shared("ckpt"), n=N,
                                as_of=1).awaitTermination()
    assert sorted(r.user_id for r in read_predictions(spark, sink).collect()) == users


def test_cli_stream_restarts_where_it_stopped(spark, tmp_shared, setup):
    """Twice without --checkpoint, new files between: every prediction once."""
    from stridex.__main__ import main
    from stridex.sources.models import save_model
    model, parts, _ = setup
    src, sink, path = tmp_shared("src"), tmp_shared("sink"), save_model(model, tmp_shared("model"))
    argv = ["stream", "--live", src, "--model", path, "--out", sink, "--every", "once"]
    for k, u in enumerate(["u00", "u01"]):
        parts[0].where(F.col("user_id") == u).coalesce(1).write.mode("append").parquet(src)
        main(argv, spark)
        assert sorted(r.user_id for r in read_predictions(spark, sink).collect()) == ["u00", "u01"][:k + 1]


def test_stateless_needs_the_table(spark, tmp_shared, setup):
    model, parts, _ = setup
    src = tmp_shared("src")
    parts[0].coalesce(1).write.parquet(src)
    with pytest.raises(ValueError, match="table"):
        start_prediction_stream(stream_live(spark, src), model, tmp_shared("s"), tmp_shared("c"), stateful=False)


def _stored(t):
    """Rows written so far by every segment, and the rows of those that count."""
    live, covered = t.segments()
    return [t._read(t.log.entry(k)).count() for k in live], [t._read(t.log.entry(k)).count() for k in covered]


def test_newest_table_segments_and_replay(spark, tmp_shared, setup):
    """Replaying a batch gives the same rows, merged already or not; merges keep what counts; a user untouched by later
    batches keeps its samples."""
    from stridex.streaming import NewestTable
    _, parts, everything = setup
    t = NewestTable(spark, tmp_shared("newest"), 10, buckets=4)
    for k, p in enumerate(parts):
        first = sorted(map(tuple, t.update(p, k).collect()))
        assert sorted(map(tuple, t.update(p, k).collect())) == first
        t.compact()
        assert sorted(map(tuple, t.update(p, k).collect())) == first
    live, covered = t.segments()
    assert [t._range(k) for k in live] == [(0, 3), (4, 4)] and not covered
    want = sorted(map(tuple, latest_n(everything, 10).select("user_id", "timestamp", "x", "y", "z").collect()))
    rows = t._read(t.log.entry(live[0])).unionByName(t._read(t.log.entry(live[1])))
    assert sorted(map(tuple, latest_n(rows, 10).select("user_id", "timestamp", "x", "y", "z").collect())) == want
    again = NewestTable(spark, t.log.path, 10, buckets=4)                    # another process finds the same table
    assert again.segments() == (live, covered)


def test_newest_table_writes_rows_in_proportion_to_batches(spark, tmp_shared):
    """Many users are held, ten batches touch one sample of each of a few users all over the buckets: what is written follows
    the batches, not the table; the number of segments stays logarithmic; buckets grow with the rows."""
    from stridex.streaming import NewestTable, live_prediction
    t = NewestTable(spark, tmp_shared("newest"), 5, buckets=4)
    sample = ["x + 0D AS x", "x + 1D AS y", "x + 2D AS z"]
    base = spark.range(3000).selectExpr("concat('u', id % 1000) AS user_id", "id AS timestamp", "id AS x").selectExpr(
        "user_id", "timestamp", *sample)
    assert t.update(base, 0).count() == 3000
    written, keys = [], set(t.log.keys())
    for k in range(1, 21):
        few = spark.range(40).selectExpr(f"concat('u', id * 25 + {k % 5}) AS user_id", f"{10_000 + k} AS timestamp", "id AS x"
                                         ).selectExpr("user_id", "timestamp", *sample)
        assert t.update(few, k).groupBy("user_id").count().where("count < 4").count() == 0
        t.compact()
        new = [x for x in t.log.keys() if x not in keys]
        keys |= set(new)
        written.append(sum(t._read(t.log.entry(x)).count() for x in new))
    assert len(t.segments()[0]) <= 3 * live_prediction.FAN
    # one merge takes the base in once; all else is the batches' own rows, once per level
    assert sum(written) <= 20 * 40 * 3 + 2 * 3000 and sorted(written)[:14] == [40] * 14
    held = None
    for key in t.segments()[0]:
        x = t._read(t.log.entry(key))
        held = x if held is None else held.unionByName(x)
    newest = latest_n(held, 5)
    assert newest.where("timestamp < 3000").groupBy("user_id").count().count() == 1000
    assert newest.where("timestamp > 9999").count() == 200 * 4


def test_newest_table_buckets_follow_the_rows(spark, tmp_shared, setup, monkeypatch):
    from stridex.streaming import NewestTable, live_prediction
    monkeypatch.setattr(live_prediction, "BUCKET_ROWS", 10)
    monkeypatch.setattr(live_prediction, "FAN", 2)
    _, parts, everything = setup
    t = NewestTable(spark, tmp_shared("newest"), N, buckets=2)
    extra = [spark.createDataFrame([(f"zz{k}", 5, 1.0, 2.0, 3.0)], ACCEL_LIVE) for k in range(4)]
    for k, p in enumerate([*parts, *extra]):
        assert t.update(p, k).count() > 0
        t.compact()
    assert max(t.log.entry(k).facts["buckets"] for k in t.segments()[0]) > 2
    users = spark.createDataFrame([(f"u0{k}", 9 * 10**18, 1.0, 2.0, 3.0) for k in range(6)], ACCEL_LIVE)
    want = latest_n(everything.select("user_id", "timestamp", "x", "y", "z").unionByName(users), N)
    assert sorted(map(tuple, t.update(users, 99).collect())) == sorted(map(tuple, want.collect()))


def test_bucketed_table_is_pruned(spark, tmp_shared, setup):
    from stridex.streaming import bucketed
    from stridex.streaming.live_prediction import _touched
    _, _, everything = setup
    path = tmp_shared("live")
    bucketed(everything, 8).write.partitionBy("user_bucket").parquet(path)
    live = spark.read.parquet(path)
    got = _touched(live, spark.createDataFrame([("u00",)], "user_id string"))
    assert got.select("user_id").distinct().collect()[0][0] == "u00"
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [user_bucket" in plan or "user_bucket#" in plan.split("PartitionFilters")[1][:80]


def test_bucketed_table_with_empty_top_buckets(spark, tmp_shared, setup):
    """The highest buckets hold no user; every user's samples are found, whether the table's number of buckets is stored with
    it, given, or unknown."""
    from stridex.streaming import bucketed
    from stridex.streaming.live_prediction import _touched
    model, parts, everything = setup
    n = next(n for n in range(32, 60) if bucketed(everything, n).agg(F.max("user_bucket")).first()[0] < n - 2)
    path, bare, src = tmp_shared("live"), tmp_shared("bare"), tmp_shared("src")
    bucketed(everything, n).write.partitionBy("user_bucket").parquet(path)
    stored = spark.read.parquet(path)
    spark.read.schema(f"{ACCEL_LIVE.simpleString()[7:-1].replace(':', ' ')}, user_bucket int").parquet(path).write.partitionBy(
        "user_bucket").parquet(bare)
    unmarked = spark.read.parquet(bare)
    assert not unmarked.schema["user_id"].metadata and stored.schema["user_id"].metadata
    for u, rows in {r.user_id: r["count"] for r in everything.groupBy("user_id").count().collect()}.items():
        users = spark.createDataFrame([(u,)], "user_id string")
        assert [_touched(t, users, k).count() for t, k in ((stored, None), (stored, 3), (unmarked, n), (unmarked, None))] == [rows] * 4
    everything.coalesce(1).write.parquet(src)
    final = []
    for table, k in ((lambda: read_live(spark, src), None), (lambda: stored, None), (lambda: unmarked, n), (lambda: unmarked, None)):
        sink = tmp_shared("sink")
        start_prediction_stream(stream_live(spark, src), model, sink, tmp_shared("ckpt"), table=table, n=N, stateful=False,
                                as_of=1, buckets=k).awaitTermination()
        final.append(_final(spark, sink))
    assert final[0].keys() == {f"u0{k}" for k in range(6)} and all(f == final[0] for f in final)


def test_default_stream_has_no_python_step(spark, tmp_shared, setup):
    from stridex.streaming import NewestTable
    _, parts, _ = setup
    t = NewestTable(spark, tmp_shared("newest"), 10)
    plan = t.update(parts[0], 0)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
