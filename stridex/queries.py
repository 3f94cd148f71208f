"""Driver queries: one Spark plan per operator of the inventory, each with a DuckDB oracle where SQL can say it.

Input is the driver's ``events`` table through the adapter (FIXTURES.md, "E"). Timestamps are nanoseconds, and
the events are sparse (hours apart), so the time parameters are scaled: set A (gap 2 days, width 1 day)
reaches interval numbers above 0, set B (gap 1 day, width 5 days, the reference's 1:5 ratio) lets one sample
fall into several intervals. Every query runs over the whole table.

Oracle conventions: doubles whose value depends on summation order are rounded to 6 places on both sides, after
a shift of 1e-9. Without the shift, exact decimal ties are common (a mean of 16 three-decimal values has 7
decimals ending in 5) and each engine's last-bit noise sends them to a different side; 1e-9 is far above that
noise and far below the 6th place, and no exact value of the inputs' decimal form can sit on the shifted
boundary (for groups under 15 625 rows). ``+ 0.0`` in SQL turns DuckDB's ``-0.0`` into ``0.0``. Doubles computed
exactly the same way in both engines (peak time, labels) are not rounded. DuckDB's ``//`` truncates towards zero, so SQL floors explicitly.
"""
from __future__ import annotations

import contextlib
import io
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .config import scratch_path
from .operators import features as feat
from .operators import intervals as iv
from .operators import labels as lab
from .operators import selection as sel
from .operators import sessions as ses
from .plans import prediction as pred
from .plans import training as tr
from .schema import FEATURES, KEYS, LABELS
from .sources import readers as rd

DAY = 86_400 * 10**9
SET_A = dict(gap=2 * DAY, width=DAY)
SET_B = dict(gap=DAY, width=5 * DAY)
LATEST_SMALL = 20
LATEST_REF = 100
CONSOLE_ROWS = 5
STREAM_SLICES = 4            # files, and micro-batches, of the streams over a growing table
USER = "7"
ACTIVITY = "Walking"
# 2024-01-01 00:00:07.179575 (a sample instant at sf0.01, so strictness is exercised) .. ten days later
RANGE_LO = 1_704_067_207_179_575_000
RANGE_HI = RANGE_LO + 10 * DAY
AS_OF = 1_706_745_600_000  # 2024-02-01 00:00:00 UTC in ms: a fixed result stamp for repeatable prediction rows
UNROUNDED = {"peak_time", "label", "prediction"}
ROUND_SHIFT = 1e-9

Query = Callable[[SparkSession, str], DataFrame]


# ----------------------------------------------------------------------------------------------------------------
# Spark side
# ----------------------------------------------------------------------------------------------------------------

def rounded(df: DataFrame) -> DataFrame:
    """Round order-sensitive doubles to 6 places for the cross-engine comparison."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType) and f.name not in UNROUNDED:
            cols.append(F.round(F.col(f.name) + F.lit(ROUND_SHIFT), 6).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _training(spark, d):
    return rd.training_from_events(spark, d)


def _domain(spark, d):
    return sel.activity_domain(_training(spark, d))


def _live(spark, d):
    return rd.live_from_events(spark, d)


def q_scan_training(spark, d):
    return _training(spark, d)


def q_scan_live(spark, d):
    return _live(spark, d)


def q_filter_user(spark, d):
    return sel.filter_user(rd.training_from_events(spark, d, users=[USER]), USER)


def q_filter_user_activity(spark, d):
    return sel.filter_user_activity(rd.training_from_events(spark, d, users=[USER]), USER, ACTIVITY)


def q_filter_open_range(spark, d):
    return sel.filter_open_range(rd.training_from_events(spark, d, after=RANGE_LO, before=RANGE_HI), RANGE_LO, RANGE_HI)


def q_activity_domain(spark, d):
    return _domain(spark, d)


def q_label_encode(spark, d):
    return lab.encode_labels(_training(spark, d)).select("user_id", "activity", "timestamp", "label")


def q_label_decode(spark, d):
    enc = lab.encode_labels(_training(spark, d)).select("user_id", "timestamp", "label")
    return lab.decode_labels(enc, "label", "activity")


def q_distinct_users(spark, d):
    return sel.distinct_users(_training(spark, d))


def q_capped_users(spark, d):
    return sel.capped_users(_training(spark, d), 10)


def q_restrict_users(spark, d):
    t = _training(spark, d)
    return sel.restrict_to_users(t, sel.capped_users(t, 10))


def q_latest_n_user(spark, d):
    return sel.latest_n_user(rd.live_from_events(spark, d, users=[USER]), USER, LATEST_REF)


def q_latest_n_all_users(spark, d):
    return sel.latest_n(_live(spark, d), LATEST_SMALL)


def q_time_bounds(spark, d):
    return sel.time_bounds(_domain(spark, d))


def q_time_diffs(spark, d):
    return ses.time_diffs(_domain(spark, d), gap=SET_A["gap"])


def q_time_jumps(spark, d):
    return ses.time_jumps(_domain(spark, d), gap=SET_A["gap"])


def q_session_rows(spark, d):
    lab = ses.label_sessions(_domain(spark, d), gap=SET_A["gap"])
    return lab.select(*KEYS, "timestamp", "session_id", "session_start", "jump")


def q_time_ordered(spark, d):
    return sel.time_ordered(_domain(spark, d)).select(*KEYS, "timestamp")


def q_gap_sessions(spark, d):
    return ses.gap_sessions(_domain(spark, d), **SET_A)


def q_gap_sessions_range(spark, d):
    return ses.gap_sessions(_domain(spark, d), method="range", **SET_A)


def q_gap_sessions_b(spark, d):
    return ses.gap_sessions(_domain(spark, d), **SET_B)


def q_interval_bounds(spark, d):
    return iv.interval_bounds(ses.gap_sessions(_domain(spark, d), **SET_A), width=SET_A["width"])


def q_interval_bounds_start(spark, d):
    return iv.interval_bounds(ses.gap_sessions(_domain(spark, d), **SET_A), width=SET_A["width"], anchor="start")


def _assigned(spark, d, params, anchor="stop"):
    a = iv.assign_intervals(_domain(spark, d), anchor=anchor, **params)
    return a.select(*KEYS, "session_id", "i", "lo", "hi", "timestamp", "x", "y", "z")


def q_interval_assign(spark, d):
    return _assigned(spark, d, SET_A)


def q_interval_assign_b(spark, d):
    return _assigned(spark, d, SET_B)


def q_interval_tiled(spark, d):
    return iv.interval_groups(_assigned(spark, d, SET_A, anchor="start"))


def _key_features(spark, d):
    return feat.features(_domain(spark, d), KEYS)


def q_feat_mean(spark, d):
    return rounded(_key_features(spark, d).select(*KEYS, "n", "mean_x", "mean_y", "mean_z"))


def q_feat_variance(spark, d):
    return rounded(_key_features(spark, d).select(*KEYS, "var_x", "var_y", "var_z"))


def q_feat_stddev(spark, d):
    return rounded(_key_features(spark, d).select(*KEYS, "std_x", "std_y", "std_z"))


def q_feat_abs_dev(spark, d):
    return rounded(_key_features(spark, d).select(*KEYS, "aad_x", "aad_y", "aad_z"))


def q_feat_resultant(spark, d):
    return rounded(_key_features(spark, d).select(*KEYS, "resultant"))


def q_feat_axis_diff(spark, d):
    return rounded(_key_features(spark, d).select(*KEYS, "diff_xy"))


def q_peak_rows(spark, d):
    return feat.peak_rows(_domain(spark, d), KEYS)


def q_peak_deltas(spark, d):
    return feat.peak_deltas(_domain(spark, d), KEYS)


def q_feat_peak_time(spark, d):
    return _key_features(spark, d).select(*KEYS, "peak_time")


def q_peak_time_lag(spark, d):
    return feat.peak_time_by_lag(_domain(spark, d), KEYS)


def q_features_untruncated(spark, d):
    f = feat.features(_domain(spark, d), KEYS, truncate_y=False)
    return f.select(*KEYS, "n", "peak_time")


def q_features_latest(spark, d):
    return rounded(pred.latest_features(_live(spark, d), LATEST_REF))


def q_features_latest_small(spark, d):
    return rounded(pred.latest_features(_live(spark, d), LATEST_SMALL))


def q_features_requested_users(spark, d):
    users = spark.read.parquet(f"{d.rstrip('/')}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("user_id"))
    return rounded(pred.latest_features(_live(spark, d), LATEST_SMALL, users=users))


def q_features_interval(spark, d):
    a = iv.assign_intervals(_domain(spark, d), **SET_A)
    return rounded(feat.features(a, tr.POINT_KEYS, written=True))


def q_features_interval_b(spark, d):
    a = iv.assign_intervals(_domain(spark, d), **SET_B)
    return rounded(feat.features(a, tr.POINT_KEYS, written=True))


def q_features_tiled(spark, d):
    a = iv.assign_intervals(_domain(spark, d), anchor="start", **SET_A)
    return rounded(feat.features(a, tr.POINT_KEYS, written=True))


def _points(spark, d, params=SET_A):
    return tr.labeled_points(_training(spark, d), **params)


def q_labeled_points(spark, d):
    return rounded(_points(spark, d))


def q_hash_split(spark, d):
    p = lab.hash_split(_points(spark, d), tr.POINT_KEYS)
    return p.select(*tr.POINT_KEYS, "label", "is_train")


# Models are checked on samples made separable: every axis is shifted by a large multiple of the class, so the class of a
# group is the prediction a right model must give. Training samples have the class of their activity; live samples, which
# have none, the class user id mod 4. The class reaches the axes only; predictions come from the models.
SHIFT = 10_000.0


def _shifted(df, klass):
    return df.withColumns({c: F.col(c) + k * SHIFT * klass for c, k in (("x", 2), ("y", 1), ("z", 1))})


def _user_class():
    return F.pmod(F.col("user_id").cast("long"), F.lit(4)).cast("double")


def _live_shifted(live):
    return _shifted(live, _user_class())


def _trained(spark, d, *models, **kw) -> tr.Trained:
    from .functions import label_index
    s = _domain(spark, d)
    points = tr.labeled_points(_shifted(s, label_index("activity")), **SET_A)
    return tr.train_models(points, models=models or ("tree", "forest"), **kw)


def q_train_tree(spark, d):
    t = _trained(spark, d, "tree")
    return t.tree.transform(t.test).select(*tr.POINT_KEYS, "label", "prediction")


def q_train_forest(spark, d):
    t = _trained(spark, d, "forest")
    from .plans.voting import majority_vote
    return majority_vote(t.forest, t.test).select(*tr.POINT_KEYS, "label", "prediction")


def q_training_report(spark, d):
    """C1 with its default arguments but for the scaled times: all users, both models, the report."""
    from .functions import label_index
    return tr.train(_shifted(_domain(spark, d), label_index("activity")), **SET_A).report()


def q_save_load_tree(spark, d):
    """IO5/IO8: save, load, predict with the loaded model."""
    from .sources.models import load_tree
    path = scratch_path(spark, "tree-model")
    t = _trained(spark, d, "tree", tree_path=path)
    return load_tree(path).transform(t.test).select(*tr.POINT_KEYS, "label", "prediction")


def q_save_load_forest(spark, d):
    """IO6/IO7."""
    from .plans.voting import majority_vote
    from .sources.models import load_forest
    path = scratch_path(spark, "forest-model")
    t = _trained(spark, d, "forest", forest_path=path)
    return majority_vote(load_forest(path), t.test).select(*tr.POINT_KEYS, "label", "prediction")


def q_random_split(spark, d):
    """M4, random form: how often each point is on either side (once, in all), and whether the share is near 60 %."""
    a, b = tr.split(_points(spark, d), how="random")
    both = a.select(*tr.POINT_KEYS, F.lit(1).alias("t")).unionByName(b.select(*tr.POINT_KEYS, F.lit(0).alias("t")))
    share = both.agg(F.avg("t").alias("s")).select(F.col("s").between(0.5, 0.7).alias("share_ok"))
    return both.groupBy(*tr.POINT_KEYS).agg(F.count(F.lit(1)).alias("times")).join(F.broadcast(share))


def q_predict_tree(spark, d):
    t = _trained(spark, d, "tree")
    return pred.predict(_live_shifted(_live(spark, d)), t.tree, LATEST_REF, as_of=AS_OF)


def q_predict_forest(spark, d):
    t = _trained(spark, d, "forest")
    return pred.predict(_live_shifted(_live(spark, d)), t.forest, LATEST_REF, vote="average", as_of=AS_OF)


def q_predict_majority(spark, d):
    t = _trained(spark, d, "forest")
    return pred.predict(_live_shifted(_live(spark, d)), t.forest, LATEST_REF, vote="majority", as_of=AS_OF)


def q_predict_newest(spark, d):
    """R2 where N matters: a user's newest 20 samples have the user's class, all older ones the next class."""
    live = rd.valid_axes(_live(spark, d))
    newest = Window.partitionBy("user_id").orderBy(*sel.newest_first(live))
    live = live.withColumn("_old", (F.row_number().over(newest) > LATEST_SMALL).cast("double"))
    live = _shifted(live, F.pmod(_user_class() + F.col("_old"), F.lit(4.0))).drop("_old")
    return pred.predict(live, _trained(spark, d, "forest").forest, LATEST_SMALL, as_of=AS_OF)


def q_predict_user(spark, d):
    """One known and one unknown user (whose features are zeros)."""
    t = _trained(spark, d, "tree")
    users = [USER, "nobody"]
    return pred.predict(_live_shifted(rd.live_from_events(spark, d, users=users)), t.tree, LATEST_REF, users=users,
                        as_of=AS_OF)


def q_predict_store(spark, d):
    t = _trained(spark, d, "forest")
    out = scratch_path(spark, "predictions")
    pred.predict_and_store(_live_shifted(_live(spark, d)), t.forest, out, n=LATEST_REF, as_of=AS_OF)
    from .sources.sinks import read_predictions
    return read_predictions(spark, out)


def _streamed(spark, d, model, n, stateful, prepare=lambda df: df):
    from .streaming import stream_predict_events
    return stream_predict_events(spark, d, model, n=n, stateful=stateful, as_of=AS_OF, prepare=prepare)


def q_stream_predict(spark, d):
    return _streamed(spark, d, _trained(spark, d, "forest").forest, LATEST_REF, False, _live_shifted)


def q_stream_predict_state(spark, d):
    return _streamed(spark, d, _trained(spark, d, "forest").forest, LATEST_REF, True, _live_shifted)


def _sliced(spark, d, slices: int = STREAM_SLICES) -> str:
    """The events dealt by id into ``slices`` files that arrive one after the other."""
    path = scratch_path(spark, "event-slices")
    for k in range(slices):
        rd.read_events(spark, d).where(F.col("event_id") % slices == k).coalesce(1).write.mode("append").parquet(path)
    return path


def _slice_stream(spark, path, per_batch: int = 1):
    return rd.events_as_live(spark.readStream.schema(rd.EVENTS).option("maxFilesPerTrigger", per_batch).parquet(path))


def q_stream_batches(spark, d):
    """R5, ST2, ST3: a run of several micro-batches; after each, the features of its users' newest 20 samples so far."""
    from .sources.sinks import read_published
    from .streaming import start_prediction_stream
    sink = scratch_path(spark, "stream-batches")
    start_prediction_stream(_slice_stream(spark, _sliced(spark, d)), None, sink, scratch_path(spark, "stream-checkpoint"),
                            n=LATEST_SMALL).awaitTermination()
    return rounded(read_published(spark, sink).drop("run"))


def q_stream_console(spark, d):
    """R5, IO9: a periodic run, stopped when its input is used up; per batch the users stored and the rows it printed."""
    from .sources.sinks import read_published
    from .streaming import start_prediction_stream
    sink, text = scratch_path(spark, "stream-console"), io.StringIO()
    stream = _slice_stream(spark, _sliced(spark, d))
    with contextlib.redirect_stdout(text):
        q = start_prediction_stream(stream, None, sink, scratch_path(spark, "stream-checkpoint"), n=LATEST_SMALL,
                                    trigger={"processingTime": "1 second"}, console=CONSOLE_ROWS)
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    shown = []
    for part in text.getvalue().split("-- batch ")[1:]:
        batch_id, *lines = part.splitlines()
        shown.append((int(batch_id), sum(x.startswith("|") for x in lines) - 1))       # one such line is the heading
    users = read_published(spark, sink).groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("users"))
    return users.join(spark.createDataFrame(shown, "batch_id long, shown long"), "batch_id", "full")


def q_stream_recovery(spark, d):
    """ST4, IO4: the stream dies after publishing a batch and before noting it in the checkpoint; the restart replays that
    batch, then goes on. Every prediction is there once, with its batch."""
    from .sources.commits import CommitLog
    from .sources.sinks import read_predictions
    from .streaming import start_prediction_stream
    model = _trained(spark, d, "forest").forest
    src, sink, ckpt = _sliced(spark, d), scratch_path(spark, "stream-recovery"), scratch_path(spark, "stream-checkpoint")

    def run():
        stream = _live_shifted(_slice_stream(spark, src, per_batch=2))
        start_prediction_stream(stream, model, sink, ckpt, n=LATEST_SMALL, as_of=AS_OF).awaitTermination()
    run()
    log = CommitLog(spark, ckpt)
    log._delete(f"{ckpt}/commits/1")
    log._delete(f"{ckpt}/commits/.1.crc")
    run()
    return read_predictions(spark, sink, with_batch=True).select("batch_id", "user_id", "timestamp", "prediction")


def q_clustered_filters(spark, d):
    """P2-P4 on a clustered table of two published parts: one user's samples of an activity in an open time range."""
    from .sources.layout import read_clustered, write_clustered
    path, c = scratch_path(spark, "clustered"), rd.training_from_events(spark, d)
    for part, rows in (("old", sel.filter_open_range(c, -1, RANGE_HI)), ("new", c.where(F.col("timestamp") >= RANGE_HI))):
        write_clustered(rows, path, part)
    mine = sel.filter_user_activity(read_clustered(spark, path), USER, ACTIVITY)
    return sel.filter_open_range(mine, RANGE_LO, 2 * RANGE_HI).drop("user_bucket")


def q_predict_store_rerun(spark, d):
    """IO4: a batch job run three times, twice under one id: each id's rows once."""
    from .sources.sinks import read_predictions
    t = _trained(spark, d, "tree")
    out, live = scratch_path(spark, "predictions"), _live_shifted(_live(spark, d))
    for run in ("monday", "monday", "tuesday"):
        pred.predict_and_store(live, t.tree, out, run=run, n=LATEST_SMALL, as_of=AS_OF)
    return read_predictions(spark, out, with_batch=True).select("run", "user_id", "timestamp", "prediction")


def q_stream_features(spark, d):
    """IO3, ST1, ST3: what a stream computes for each user's newest 20 samples."""
    return rounded(_streamed(spark, d, None, LATEST_SMALL, False))


def q_stream_features_state(spark, d):
    return rounded(_streamed(spark, d, None, LATEST_SMALL, True))


def q_rejected_samples(spark, d):
    """Q21: rows that features leave out. Every 50th event loses its y here, as the given table has no bad axes."""
    t = _training(spark, d)
    bad = t.withColumn("y", F.when(F.pmod(F.expr("timestamp div 1000"), F.lit(50)) != 0, F.col("y")))
    return rd.rejected_samples(bad).select("user_id", "activity", "timestamp")


QUERIES: dict[str, Query] = {
    "scan_training": q_scan_training,
    "scan_live": q_scan_live,
    "filter_user": q_filter_user,
    "filter_user_activity": q_filter_user_activity,
    "filter_open_range": q_filter_open_range,
    "activity_domain": q_activity_domain,
    "label_encode": q_label_encode,
    "label_decode": q_label_decode,
    "distinct_users": q_distinct_users,
    "capped_users": q_capped_users,
    "restrict_users": q_restrict_users,
    "latest_n_user": q_latest_n_user,
    "latest_n_all_users": q_latest_n_all_users,
    "time_bounds": q_time_bounds,
    "time_ordered": q_time_ordered,
    "session_rows": q_session_rows,
    "time_diffs": q_time_diffs,
    "time_jumps": q_time_jumps,
    "gap_sessions": q_gap_sessions,
    "gap_sessions_b": q_gap_sessions_b,
    "gap_sessions_range": q_gap_sessions_range,
    "interval_bounds": q_interval_bounds,
    "interval_bounds_start": q_interval_bounds_start,
    "interval_assign": q_interval_assign,
    "interval_assign_b": q_interval_assign_b,
    "interval_tiled": q_interval_tiled,
    "feat_mean": q_feat_mean,
    "feat_variance": q_feat_variance,
    "feat_stddev": q_feat_stddev,
    "feat_abs_dev": q_feat_abs_dev,
    "feat_resultant": q_feat_resultant,
    "feat_axis_diff": q_feat_axis_diff,
    "peak_rows": q_peak_rows,
    "peak_deltas": q_peak_deltas,
    "feat_peak_time": q_feat_peak_time,
    "peak_time_lag": q_peak_time_lag,
    "features_untruncated": q_features_untruncated,
    "features_latest": q_features_latest,
    "features_latest_small": q_features_latest_small,
    "features_requested_users": q_features_requested_users,
    "features_interval": q_features_interval,
    "features_interval_b": q_features_interval_b,
    "features_tiled": q_features_tiled,
    "labeled_points": q_labeled_points,
    "hash_split": q_hash_split,
    "train_tree": q_train_tree,
    "train_forest": q_train_forest,
    "training_report": q_training_report,
    "predict_tree": q_predict_tree,
    "predict_forest": q_predict_forest,
    "predict_majority": q_predict_majority,
    "predict_newest": q_predict_newest,
    "predict_store": q_predict_store,
    "stream_predict": q_stream_predict,
    "stream_predict_state": q_stream_predict_state,
    "stream_features": q_stream_features,
    "stream_batches": q_stream_batches,
    "stream_console": q_stream_console,
    "stream_recovery": q_stream_recovery,
    "predict_store_rerun": q_predict_store_rerun,
    "clustered_filters": q_clustered_filters,
    "stream_features_state": q_stream_features_state,
    "save_load_tree": q_save_load_tree,
    "save_load_forest": q_save_load_forest,
    "random_split": q_random_split,
    "predict_user": q_predict_user,
    "rejected_samples": q_rejected_samples,
}


# ----------------------------------------------------------------------------------------------------------------
# DuckDB oracle
# ----------------------------------------------------------------------------------------------------------------

_ADAPT = """
training AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id,
         CASE event_type WHEN 'click' THEN 'Walking' WHEN 'view' THEN 'Jogging' WHEN 'purchase' THEN 'Standing'
                         WHEN 'signup' THEN 'Sitting' WHEN 'error' THEN 'Upstairs' END AS activity,
         epoch_us(ts) * 1000 AS "timestamp",
         value / 10.0 AS x,
         CAST(json_extract(props, '$.k') AS DOUBLE) / 5.0 AS y,
         (event_id % 97) / 10.0 - 4.8 AS z
  FROM events
),
clean AS (
  SELECT * FROM training WHERE user_id IS NOT NULL AND activity IS NOT NULL AND "timestamp" IS NOT NULL
),
live AS (SELECT user_id, "timestamp", x, y, z FROM training WHERE user_id IS NOT NULL AND "timestamp" IS NOT NULL),
dom AS (SELECT * FROM clean WHERE activity IN ('Walking', 'Jogging', 'Standing', 'Sitting'))
"""


_ADAPT_SLICED = """sliced AS (
  SELECT CAST(event_id % SLICES AS INTEGER) AS b, CAST(user_id AS VARCHAR) AS user_id, epoch_us(ts) * 1000 AS "timestamp",
         value / 10.0 AS x, CAST(json_extract(props, '$.k') AS DOUBLE) / 5.0 AS y, (event_id % 97) / 10.0 - 4.8 AS z
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL)"""

_AXES_OK = ("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL AND NOT isnan(x) AND NOT isnan(y) "
            "AND NOT isnan(z)")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([_ADAPT.strip(), *[c.strip() for c in ctes]]) + "\n"


def _r(expr: str, name: str) -> str:
    return f"round(({expr}) + {ROUND_SHIFT!r}, 6) + 0.0 AS {name}"


def _floordiv(a: str, b: str) -> str:
    return f"((({a}) - ((({a}) % ({b})) + ({b})) % ({b})) // ({b}))"


def _sessions_cte(gap: int, width: int, src: str = "dom", name: str = "sessions") -> list[str]:
    return [
        f"""{name}_d AS (
  SELECT user_id, activity, "timestamp", x, y, z,
         "timestamp" - lag("timestamp") OVER (PARTITION BY user_id, activity ORDER BY "timestamp") AS diff
  FROM {src})""",
        f"""{name}_l AS (
  SELECT *, CAST(SUM(CASE WHEN diff > {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, activity
         ORDER BY "timestamp" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_id
  FROM {name}_d)""",
        f"""{name} AS (
  SELECT user_id, activity, session_id, min("timestamp") AS session_start, max("timestamp") AS session_stop,
         count(*) AS n_samples, (max("timestamp") - min("timestamp")) // {width} AS intervals
  FROM {name}_l GROUP BY user_id, activity, session_id)""",
    ]


def _intervals_cte(width: int, anchor: str = "stop") -> str:
    if anchor == "stop":
        lo, hi = f"session_stop + (i - 1) * {width}", f"session_stop + i * {width}"
    else:
        lo, hi = f"session_start + i * {width}", f"session_start + (i + 1) * {width}"
    return f"""ivals AS (
  SELECT user_id, activity, session_id, i, {lo} AS lo, {hi} AS hi
  FROM (SELECT *, CAST(unnest(generate_series(0, intervals)) AS BIGINT) AS i FROM sessions))"""


_ASSIGN_STOP = """assigned AS (
  SELECT v.user_id, v.activity, v.session_id, v.i, v.lo, v.hi, t."timestamp", t.x, t.y, t.z
  FROM ivals v JOIN dom t ON t.user_id = v.user_id AND t.activity = v.activity
   AND t."timestamp" > v.lo AND t."timestamp" < v.hi)"""


def _assign_tiled(width: int) -> str:
    return f"""assigned AS (
  SELECT user_id, activity, session_id, i, session_start + i * {width} AS lo,
         session_start + (i + 1) * {width} AS hi, "timestamp", x, y, z
  FROM (SELECT l.*, s.session_start, (l."timestamp" - s.session_start) // {width} AS i
        FROM sessions_l l JOIN sessions s USING (user_id, activity, session_id)) q)"""


def _features_sql(src: str, keys: list[str], cols: list[str] | None = None, truncate_y: bool = True) -> str:
    """Reference-form features: stats, then deviations from the mean and peaks by lag over distinct peak times."""
    k = ", ".join(keys)
    kj = " AND ".join(f"r.{c} = st.{c}" for c in keys)
    ctes = [
        f"""f_src AS (SELECT * FROM {src} WHERE {_AXES_OK})""",
        f"""f_st AS (SELECT {k}, avg(x) AS mx, avg(y) AS my, avg(z) AS mz, max(y) AS ymax FROM f_src GROUP BY {k})""",
        f"""f_j AS (
  SELECT r.*, st.mx, st.my, st.mz, st.ymax,
         CASE WHEN {'trunc(r.y)' if truncate_y else 'r.y'} > 0.9 * st.ymax THEN r."timestamp" END AS pt
  FROM f_src r JOIN f_st st ON {kj})""",
        f"""f_pk AS (SELECT DISTINCT {k}, pt FROM f_j WHERE pt IS NOT NULL)""",
        f"""f_dl AS (SELECT {k}, pt - lag(pt) OVER (PARTITION BY {k} ORDER BY pt) AS delta FROM f_pk)""",
        f"""f_pt AS (SELECT {k}, avg(delta) FILTER (WHERE delta > 0) AS pt_mean FROM f_dl GROUP BY {k})""",
        f"""f_all AS (
  SELECT {', '.join('a.' + c for c in keys)}, count(*) AS n,
         avg(x) AS mean_x, avg(y) AS mean_y, avg(z) AS mean_z,
         coalesce(var_samp(x), 0.0) AS var_x, coalesce(var_samp(y), 0.0) AS var_y, coalesce(var_samp(z), 0.0) AS var_z,
         sqrt(avg((x - mx) * (x - mx))) AS std_x, sqrt(avg((y - my) * (y - my))) AS std_y,
         sqrt(avg((z - mz) * (z - mz))) AS std_z,
         avg(abs(x - mx)) AS aad_x, avg(abs(y - my)) AS aad_y, avg(abs(z - mz)) AS aad_z,
         avg(sqrt(x * x + y * y + z * z)) AS resultant,
         coalesce(any_value(p.pt_mean), 0.0) AS peak_time,
         avg(x) - avg(y) AS diff_xy
  FROM f_j a LEFT JOIN f_pt p ON {' AND '.join(f'a.{c} = p.{c}' for c in keys)}
  GROUP BY {', '.join('a.' + c for c in keys)})""",
    ]
    return ctes


def _features_select(keys: list[str], cols: list[str] | None = None, with_n: bool = True) -> str:
    cols = FEATURES if cols is None else cols
    out = list(keys) + (["n"] if with_n else [])
    for c in cols:
        out.append(f"CAST({c} AS DOUBLE) AS {c}" if c == "peak_time" else _r(c, c))
    return "SELECT " + ", ".join(out) + " FROM f_all"


def _key_feature_sql(cols: list[str], with_n: bool = False) -> str:
    return _with(*_features_sql("dom", KEYS)) + _features_select(KEYS, cols, with_n)


def _latest_cte(n: int, src: str = "live") -> str:
    return f"""latest AS (
  SELECT user_id, "timestamp", x, y, z FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" DESC, x NULLS FIRST, y NULLS FIRST,
           z NULLS FIRST) AS rn FROM {src}
    WHERE {_AXES_OK}) q
  WHERE rn <= {n})"""


def _interval_feature_sql(params: dict, anchor: str = "stop") -> str:
    g, w = params["gap"], params["width"]
    keys = ["user_id", "activity", "session_id", "i"]
    assign = [_intervals_cte(w), _ASSIGN_STOP] if anchor == "stop" else [_assign_tiled(w)]
    return (_with(*_sessions_cte(g, w), *assign, *_features_sql("assigned", keys))
            + _features_select(keys))


def _label_case(col: str = "activity") -> str:
    return (f"CAST(CASE {col} WHEN 'Walking' THEN 0 WHEN 'Jogging' THEN 1 WHEN 'Standing' THEN 2 "
            f"WHEN 'Sitting' THEN 3 END AS DOUBLE)")


def _points_sql(params: dict) -> tuple[list[str], list[str]]:
    g, w = params["gap"], params["width"]
    keys = ["user_id", "activity", "session_id", "i"]
    ctes = [*_sessions_cte(g, w), _intervals_cte(w), _ASSIGN_STOP, *_features_sql("assigned", keys)]
    return ctes, keys


def _oracle() -> dict[str, str]:
    A, B = SET_A, SET_B
    o: dict[str, str] = {}
    o["scan_training"] = _with() + 'SELECT user_id, activity, "timestamp", x, y, z FROM clean'
    o["scan_live"] = _with() + 'SELECT user_id, "timestamp", x, y, z FROM live'
    o["filter_user"] = _with() + f"SELECT * FROM clean WHERE user_id = '{USER}'"
    o["filter_user_activity"] = _with() + f"SELECT * FROM clean WHERE user_id = '{USER}' AND activity = '{ACTIVITY}'"
    o["filter_open_range"] = _with() + f'SELECT * FROM clean WHERE "timestamp" > {RANGE_LO} AND "timestamp" < {RANGE_HI}'
    o["activity_domain"] = _with() + "SELECT * FROM dom"
    o["label_encode"] = _with() + (f'SELECT user_id, activity, "timestamp", {_label_case()} AS label FROM dom')
    o["label_decode"] = _with() + (
        f'SELECT user_id, "timestamp", {_label_case()} AS label, activity FROM dom')
    o["distinct_users"] = _with() + "SELECT DISTINCT user_id FROM clean"
    o["capped_users"] = _with() + "SELECT DISTINCT user_id FROM clean ORDER BY user_id LIMIT 10"
    o["restrict_users"] = _with() + (
        "SELECT * FROM clean WHERE user_id IN (SELECT DISTINCT user_id FROM clean ORDER BY user_id LIMIT 10)")
    o["latest_n_user"] = _with() + (
        f"""SELECT * FROM live WHERE user_id = '{USER}' ORDER BY "timestamp" DESC LIMIT {LATEST_REF}""")
    o["latest_n_all_users"] = _with(_latest_cte(LATEST_SMALL)) + "SELECT * FROM latest"
    o["time_bounds"] = _with() + (
        'SELECT user_id, activity, min("timestamp") AS t_first, max("timestamp") AS t_last, count(*) AS n '
        "FROM dom GROUP BY user_id, activity")
    o["time_diffs"] = _with() + (
        'SELECT user_id, activity, "timestamp", '
        'lag("timestamp") OVER (PARTITION BY user_id, activity ORDER BY "timestamp") AS prev_timestamp, '
        '"timestamp" - lag("timestamp") OVER (PARTITION BY user_id, activity ORDER BY "timestamp") AS diff FROM dom')
    o["time_jumps"] = _with() + (
        'SELECT * FROM (SELECT user_id, activity, '
        'lag("timestamp") OVER (PARTITION BY user_id, activity ORDER BY "timestamp") AS prev_timestamp, "timestamp", '
        '"timestamp" - lag("timestamp") OVER (PARTITION BY user_id, activity ORDER BY "timestamp") AS diff FROM dom) q '
        f'WHERE diff > {A["gap"]}')
    o["gap_sessions"] = _with(*_sessions_cte(A["gap"], A["width"])) + "SELECT * FROM sessions"
    o["session_rows"] = _with(*_sessions_cte(A["gap"], A["width"])) + (
        'SELECT l.user_id, l.activity, l."timestamp", l.session_id, s.session_start, '
        f'coalesce(l.diff > {A["gap"]}, false) AS jump '
        "FROM sessions_l l JOIN sessions s USING (user_id, activity, session_id)")
    o["time_ordered"] = _with() + 'SELECT user_id, activity, "timestamp" FROM dom ORDER BY "timestamp"'
    o["features_untruncated"] = (_with(*_features_sql("dom", KEYS, truncate_y=False))
                                 + "SELECT user_id, activity, n, CAST(peak_time AS DOUBLE) AS peak_time FROM f_all")
    o["gap_sessions_b"] = _with(*_sessions_cte(B["gap"], B["width"])) + "SELECT * FROM sessions"
    o["gap_sessions_range"] = o["gap_sessions"]
    o["interval_bounds"] = _with(*_sessions_cte(A["gap"], A["width"]), _intervals_cte(A["width"])) + "SELECT * FROM ivals"
    o["interval_bounds_start"] = (_with(*_sessions_cte(A["gap"], A["width"]), _intervals_cte(A["width"], "start"))
                                  + "SELECT * FROM ivals")
    o["interval_assign"] = (_with(*_sessions_cte(A["gap"], A["width"]), _intervals_cte(A["width"]), _ASSIGN_STOP)
                            + "SELECT * FROM assigned")
    o["interval_assign_b"] = (_with(*_sessions_cte(B["gap"], B["width"]), _intervals_cte(B["width"]), _ASSIGN_STOP)
                              + "SELECT * FROM assigned")
    o["interval_tiled"] = (_with(*_sessions_cte(A["gap"], A["width"]), _assign_tiled(A["width"]))
                           + "SELECT user_id, activity, session_id, i, lo, hi, count(*) AS n FROM assigned "
                             "GROUP BY user_id, activity, session_id, i, lo, hi")
    o["feat_mean"] = _key_feature_sql(["mean_x", "mean_y", "mean_z"], with_n=True)
    o["feat_variance"] = _key_feature_sql(["var_x", "var_y", "var_z"])
    o["feat_stddev"] = _key_feature_sql(["std_x", "std_y", "std_z"])
    o["feat_abs_dev"] = _key_feature_sql(["aad_x", "aad_y", "aad_z"])
    o["feat_resultant"] = _key_feature_sql(["resultant"])
    o["feat_axis_diff"] = _key_feature_sql(["diff_xy"])
    o["feat_peak_time"] = _key_feature_sql(["peak_time"])
    o["peak_rows"] = _with(*_features_sql("dom", KEYS)) + (
        'SELECT user_id, activity, "timestamp", y, CAST(trunc(y) AS BIGINT) AS y_cut, ymax AS y_max '
        "FROM f_j WHERE pt IS NOT NULL")
    o["peak_deltas"] = _with(*_features_sql("dom", KEYS)) + (
        "SELECT * FROM (SELECT user_id, activity, lag(pt) OVER (PARTITION BY user_id, activity ORDER BY pt) "
        'AS prev_peak, pt AS "timestamp", pt - lag(pt) OVER (PARTITION BY user_id, activity ORDER BY pt) AS delta '
        "FROM f_pk) q WHERE prev_peak IS NOT NULL")
    o["peak_time_lag"] = _with(*_features_sql("dom", KEYS)) + (
        "SELECT user_id, activity, CAST(pt_mean AS DOUBLE) AS peak_time FROM f_pt WHERE pt_mean IS NOT NULL")
    o["features_latest"] = (_with(_latest_cte(LATEST_REF), *_features_sql("latest", ["user_id"]))
                            + _features_select(["user_id"]))
    o["features_latest_small"] = (_with(_latest_cte(LATEST_SMALL), *_features_sql("latest", ["user_id"]))
                                  + _features_select(["user_id"]))
    zero_cols = ", ".join(
        f"CAST(coalesce({c}, 0.0) AS DOUBLE) AS {c}" if c == "peak_time" else _r(f"coalesce({c}, 0.0)", c)
        for c in FEATURES)
    o["features_requested_users"] = (
        _with(_latest_cte(LATEST_SMALL), *_features_sql("latest", ["user_id"]),
              "req AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS user_id FROM customer)")
        + f"SELECT r.user_id, CAST(coalesce(f.n, 0) AS BIGINT) AS n, {zero_cols} "
          "FROM req r LEFT JOIN f_all f ON r.user_id = f.user_id")
    o["features_interval"] = _interval_feature_sql(A)
    o["features_interval_b"] = _interval_feature_sql(B)
    o["features_tiled"] = _interval_feature_sql(A, anchor="start")
    ctes, keys = _points_sql(A)
    feats = _features_select(keys)[len("SELECT "):].replace(" FROM f_all", "")
    o["labeled_points"] = (_with(*ctes) + f"SELECT {feats}, {_label_case()} AS label FROM f_all "
                           f"WHERE {_label_case()} IS NOT NULL")
    key_text = "concat_ws('|', user_id, activity, CAST(session_id AS VARCHAR), CAST(i AS VARCHAR))"
    o["hash_split"] = (_with(*ctes) + f"SELECT user_id, activity, session_id, i, {_label_case()} AS label, "
                       f"((CAST(('0x' || substr(md5({key_text}), 1, 8)) AS BIGINT)) % 100) < 60 AS is_train "
                       f"FROM f_all WHERE {_label_case()} IS NOT NULL")
    is_train = (f"((CAST(('0x' || substr(md5({key_text}), 1, 8)) AS BIGINT)) % 100) < 60")
    held_out = (_with(*ctes) + f"SELECT user_id, activity, session_id, i, {_label_case()} AS label, "
                f"{_label_case()} AS prediction FROM f_all WHERE {_label_case()} IS NOT NULL AND NOT {is_train}")
    for name in ("train_tree", "train_forest", "save_load_tree", "save_load_forest"):
        o[name] = held_out
    o["training_report"] = (_with(*ctes) + "SELECT count(*) AS n_points, 1.0::DOUBLE AS dt_accuracy, "
                            f"1.0::DOUBLE AS rf_accuracy FROM f_all WHERE {_label_case()} IS NOT NULL")
    o["random_split"] = (_with(*ctes) + "SELECT user_id, activity, session_id, i, 1::BIGINT AS times, true AS share_ok "
                         f"FROM f_all WHERE {_label_case()} IS NOT NULL")
    text = "CASE CAST(user_id AS BIGINT) % 4 " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(LABELS)) + " END"
    predicted = _with() + (f"SELECT DISTINCT user_id, {AS_OF}::BIGINT AS \"timestamp\", {text} AS prediction FROM live "
                           f"WHERE {_AXES_OK}")
    for name in ("predict_tree", "predict_forest", "predict_majority", "predict_newest", "predict_store", "stream_predict",
                 "stream_predict_state"):
        o[name] = predicted
    o["predict_user"] = predicted + (f" AND user_id = '{USER}' UNION ALL SELECT 'nobody', {AS_OF}::BIGINT, '{LABELS[0]}'")
    sliced = _ADAPT_SLICED.replace("SLICES", str(STREAM_SLICES))
    so_far = f"""latest AS (SELECT batch_id, user_id, "timestamp", x, y, z FROM (
  SELECT t.b AS batch_id, s.*, row_number() OVER (PARTITION BY t.b, s.user_id ORDER BY s."timestamp" DESC, x NULLS FIRST,
         y NULLS FIRST, z NULLS FIRST) AS rn
  FROM (SELECT DISTINCT b, user_id FROM sliced WHERE {_AXES_OK}) t JOIN sliced s ON s.user_id = t.user_id AND s.b <= t.b
  WHERE {_AXES_OK}) q WHERE rn <= {LATEST_SMALL})"""
    o["stream_batches"] = ("WITH " + ", ".join([sliced, so_far, *_features_sql("latest", ["batch_id", "user_id"])]) + " "
                           + _features_select(["batch_id", "user_id"]))
    o["stream_console"] = (f"WITH {sliced} SELECT CAST(b AS BIGINT) AS batch_id, count(DISTINCT user_id) AS users, "
                           f"least({CONSOLE_ROWS}, count(DISTINCT user_id)) AS shown FROM sliced WHERE {_AXES_OK} GROUP BY b")
    o["stream_recovery"] = (f"WITH {sliced} SELECT DISTINCT CAST(b // 2 AS INTEGER) AS batch_id, user_id, {AS_OF}::BIGINT AS "
                            f'"timestamp", {text} AS prediction FROM sliced WHERE {_AXES_OK}')
    o["clustered_filters"] = _with() + (f"SELECT * FROM clean WHERE user_id = '{USER}' AND activity = '{ACTIVITY}' AND "
                                        f'"timestamp" > {RANGE_LO} AND "timestamp" < {2 * RANGE_HI}')
    o["predict_store_rerun"] = predicted.replace("SELECT DISTINCT user_id", "SELECT DISTINCT run, user_id").replace(
        "FROM live WHERE", "FROM live, (VALUES ('monday'), ('tuesday')) v(run) WHERE")
    o["stream_features"] = o["stream_features_state"] = o["features_latest_small"]
    o["rejected_samples"] = _with() + ('SELECT user_id, activity, "timestamp" FROM clean WHERE "timestamp" // 1000 % 50 = 0 '
                                       f"OR NOT ({_AXES_OK})")
    return o


ORACLE: dict[str, str] = _oracle()
