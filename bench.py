"""Benchmark: headline queries at $BENCH_SF_DIR (default sf0.1) on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion through the ``noop`` sink (the whole plan executes, nothing is pulled to the driver):
one cold run, then ``WARM_RUNS`` more; warm is the best of those (the JVM keeps compiling hot code for several
runs). ``*_hot`` runs on the same events with every third one given to a single user. ``queries`` holds the warm seconds and ``value`` their sum; ``cold`` the first runs. Plan building and
file listing are inside every timing. Training runs twice; its models feed the prediction and streaming timings. ``slowest_batch``: seconds of the longest of
four micro-batches.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stridex import queries as Q  # noqa: E402
from stridex.config import local_session  # noqa: E402
from stridex.operators import features as feat  # noqa: E402
from stridex.operators import selection as sel  # noqa: E402
from stridex.operators import sessions as ses  # noqa: E402
from stridex.plans import prediction as pred  # noqa: E402
from stridex.plans import training as tr  # noqa: E402
from stridex.sources import readers as rd  # noqa: E402

WARM_RUNS = 3
HEADLINE = ["scan_training", "latest_n_all_users", "features_latest", "time_diffs", "gap_sessions",
            "interval_assign_b", "interval_tiled", "features_interval", "features_interval_b", "labeled_points"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 8), app="stridex-bench")
    cold, warm = {}, {}
    def measure(name, f, warm_runs=WARM_RUNS):
        cold[name] = timed(f)
        warm[name] = min(timed(f) for _ in range(warm_runs))

    for name in HEADLINE:
        fn = Q.QUERIES[name]
        measure(name, lambda: run(fn(spark, sf_dir)))

    def hot():
        from pyspark.sql import functions as F
        e = rd.read_events(spark, sf_dir)
        return sel.activity_domain(rd.events_as_training(
            e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))))
    measure("gap_sessions_hot", lambda: run(ses.gap_sessions(hot(), **Q.SET_A)))
    measure("peak_rows_hot", lambda: run(feat.peak_rows(hot(), ["user_id", "activity"])))
    measure("latest_n_hot", lambda: run(sel.latest_n(hot().drop("activity"), Q.LATEST_REF)))

    box = {}

    def train():
        box["t"] = tr.train_models(tr.labeled_points(rd.training_from_events(spark, sf_dir), **Q.SET_A))
        run(box["t"].report())
    measure("train_report", train, warm_runs=1)
    live = lambda: rd.live_from_events(spark, sf_dir)
    for name, vote, model in [("predict_tree", "average", "tree"), ("predict_majority", "majority", "forest")]:
        m = getattr(box["t"], model)
        measure(name, lambda: run(pred.predict(live(), m, Q.LATEST_REF, vote=vote, as_of=Q.AS_OF)))
    from stridex.streaming import stream_predict_events
    for name, stateful in [("stream_predict", False), ("stream_predict_state", True)]:
        f = lambda: run(stream_predict_events(spark, sf_dir, box["t"].forest, n=Q.LATEST_REF,
                                              stateful=stateful, as_of=Q.AS_OF))
        measure(name, f, warm_runs=2)
    # several micro-batches of one run; the longest of the second run's against the reference's cadence of 5 s
    from stridex.streaming import BatchProgress
    with BatchProgress(spark) as progress:
        measure("stream_batches", lambda: run(Q.QUERIES["stream_batches"](spark, sf_dir)), warm_runs=1)
        time.sleep(1)                 # reports arrive after the batch
        slowest = max((r[3] for r in progress.batches()[-Q.STREAM_SLICES:]), default=0) / 1000
    spark.stop()
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "warm_seconds_total", "value": round(sum(warm.values()), 3), "unit": "sec",
                      "queries": warm, "cold": cold, "slowest_batch": slowest, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))


if __name__ == "__main__":
    main()
