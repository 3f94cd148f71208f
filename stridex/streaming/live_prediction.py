"""Continuous prediction (C3: IO3, ST1-ST4, R4, R5, IO9).

ST1 (``stateful=False``): every micro-batch names the users that got new samples; their newest N samples are read
from the live table (a late sample counts only if it is among the newest N, as in the reference), featurised,
classified and published in the sink. A clustered table (``sources.layout``) is read in the users' buckets, row groups and
pages only.

ST2 (``stateful=True``): the newest N samples of every user are kept as a log-structured table in the checkpoint folder. A
batch adds one segment with its own newest N per user, in buckets by user hash, and reads the earlier samples of its users
from the touched buckets of the other segments. ``FAN`` segments of one level are merged into one of the next, keeping the
newest N, so a row is written once per level: rows written are linear in the batch, up to the logarithm of the number of
batches, and there are at most ``FAN`` segments of a level. All of it is DataFrame work in the JVM; the table grows with
users, not samples. Segments are published atomically (``sources.commits``): a replayed batch finds its segment.

Recovery (ST4) is Structured Streaming's: offsets, commits and the table live under the checkpoint folder in the
cluster's shared folder; a restart resumes from there, and a replayed batch publishes nothing a second time.

A model can be given as a ``PublishedModel``: each batch takes its newest version.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_path
from ..operators.features import features
from ..operators.selection import latest_n, restrict_to_users
from ..plans.prediction import classify, now_millis
from ..schema import ACCEL_LIVE, DEFAULT_LATEST_N
from ..sources.readers import live_from_events, stream_events_as_live, valid_axes
from ..sources.commits import CommitLog, Entry
from ..sources.layout import BUCKETS, bucketed, of_users, read_clustered, write_clustered
from ..sources.models import PublishedModel
from ..sources.sinks import read_predictions, read_published, run_id, write_batch

FAN = 4                       # segments of a level that are merged into one of the next
BUCKET_ROWS = 100_000         # rows of a merged segment's bucket, about
_COLS = ACCEL_LIVE.fieldNames()


def _stamp(as_of) -> Column:
    if as_of is None:
        return now_millis()
    return as_of if isinstance(as_of, Column) else F.lit(int(as_of))


def _emit(feats: DataFrame, model, vote: str, as_of, sink: str, run: str, batch_id: int, console: int = 0) -> None:
    out = feats
    if isinstance(model, PublishedModel):
        model = model.current()
    if model is not None:
        res = classify(feats, model, vote)
        out = res.select("user_id", _stamp(as_of).cast("long").alias("timestamp"), F.col("activity").alias("prediction"))
    done = write_batch(out, sink, run, batch_id)
    if console:                      # IO9: the first rows of every batch, read back from what was published
        print(f"-- batch {batch_id}")
        out.sparkSession.read.parquet(done.folder).show(console, False)


class NewestTable:
    """ST2's table: segments ``seg=<first batch>-<last batch>`` of disjoint batch ranges, each in buckets by user hash. The
    number of buckets is a power of two times ``buckets``, kept with the segment, and follows its rows."""

    def __init__(self, spark: SparkSession, path: str, n: int, buckets: int = BUCKETS):
        self.spark, self.n, self.buckets = spark, n, buckets
        self.log = CommitLog(spark, path)

    @staticmethod
    def _range(key: str) -> tuple[int, int]:
        first, last = key.split("=")[1].split("-")
        return int(first), int(last)

    def _name(self, first: int, last: int) -> str:
        return f"seg={first:012d}-{last:012d}"

    def segments(self) -> tuple[list[str], list[str]]:
        """Keys of the segments that count, in order, and of those that a merged one covers."""
        live, covered = [], []
        for k in sorted(self.log.keys(), key=lambda k: (self._range(k)[0], -self._range(k)[1])):
            inside = live and self._range(k)[1] <= self._range(live[-1])[1]
            (covered if inside else live).append(k)
        return live, covered

    def _write(self, rows: DataFrame, buckets: int, merged: bool = False):
        def write(folder: str) -> dict:
            (bucketed(rows, buckets).repartition("user_bucket").sortWithinPartitions("user_bucket", "user_id")
             .write.partitionBy("user_bucket").parquet(folder))
            return {"buckets": buckets, **({"rows": self.spark.read.parquet(folder).count()} if merged else {})}
        return write

    def _read(self, e: Entry, buckets: list[int] | None = None) -> DataFrame:
        """The samples of a segment, of the given buckets only; no sample if it holds none of them."""
        there = self._held(e)
        wanted = there if buckets is None else sorted(set(there) & set(buckets))
        if not wanted:
            return self._none()
        return self.spark.read.schema(ACCEL_LIVE).parquet(*[f"{e.folder}/user_bucket={b}" for b in wanted])

    def _none(self) -> DataFrame:
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in ACCEL_LIVE])

    def _held(self, e: Entry) -> list[int]:
        names = [f.getPath().getName() for f in self.log._list(e.folder)]
        return sorted(int(x.split("=")[1]) for x in names if x.startswith("user_bucket="))

    def update(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Add a batch; the newest N samples of the users that have valid samples in it."""
        live, _ = self.segments()
        mine = next((k for k in live if self._range(k)[0] <= batch_id <= self._range(k)[1]), None)
        new = latest_n(valid_axes(batch.select(*_COLS)), self.n)
        if mine is None:
            mine = self._name(batch_id, batch_id)
            self.log.publish(mine, self._write(new, self.buckets))
            live = self.segments()[0]
        others = [k for k in live if k != mine]
        e = self.log.entry(mine)
        if self._range(mine) == (batch_id, batch_id):
            rows, buckets = self._read(e), self._held(e)
            users = rows.select("user_id").distinct()
        else:                                                  # a replay of a batch that is merged already
            users = new.select("user_id").distinct()
            buckets = [r[0] for r in bucketed(users, self.buckets).select("user_bucket").distinct().collect()]
            rows, others = self._none(), live
        old = []
        for k in others:
            e = self.log.entry(k)
            times = e.facts["buckets"] // self.buckets
            old.append(self._read(e, [b + i * self.buckets for b in buckets for i in range(times)]))
        if old:
            held = old[0]
            for x in old[1:]:
                held = held.unionByName(x)
            rows = latest_n(rows.unionByName(restrict_to_users(held, users)), self.n)
        return rows

    def compact(self) -> None:
        """Remove the segments that the last compaction covered, then merge where ``FAN`` of a level stand in a row."""
        live, covered = self.segments()
        for k in covered:
            self.log.retract(self.log.entry(k))
        while True:
            sizes = [(k, self._level(k)) for k in live]
            run = next((sizes[i:i + FAN] for i in range(len(sizes) - FAN + 1)
                        if len({lv for _, lv in sizes[i:i + FAN]}) == 1), None)
            if run is None:
                return
            es = [self.log.entry(k) for k, _ in run]
            rows = self._read(es[0])
            for e in es[1:]:
                rows = rows.unionByName(self._read(e))
            rows = latest_n(rows, self.n)
            buckets = max(e.facts["buckets"] for e in es)
            while sum(e.facts.get("rows", 0) for e in es) > 2 * BUCKET_ROWS * buckets:
                buckets *= 2
            name = self._name(self._range(run[0][0])[0], self._range(run[-1][0])[1])
            self.log.publish(name, self._write(rows, buckets, merged=True))
            live = self.segments()[0]

    def _level(self, key: str) -> int:
        first, last = self._range(key)
        level, size = 0, FAN
        while last - first + 1 >= size:
            level, size = level + 1, size * FAN
        return level


def _touched(table: DataFrame, users: DataFrame, buckets: int | None = None) -> DataFrame:
    """The rows of the given users; of a clustered table only what can hold them is read (``sources.layout``)."""
    return restrict_to_users(of_users(table, users, buckets), users)


def start_prediction_stream(stream: DataFrame, model, sink: str, checkpoint: str,
                            table: Callable[[], DataFrame] | None = None, n: int = DEFAULT_LATEST_N,
                            stateful: bool = True, vote: str = "majority", as_of=None,
                            trigger: dict | None = None, console: int = 0, buckets: int | None = None):
    """Start C3 on a streaming frame of live samples. ``stateful=True`` (ST2, the default) keeps each user's newest
    N samples as a table; ``stateful=False`` (ST1) reads ``table()`` for the touched users every batch, as the
    reference did -- fine when the table is bucketed by user, a full scan per batch otherwise. ``buckets`` is the number
    of buckets of ST2's new segments (``BUCKETS`` by default) or of an ST1 table that doesn't carry its number itself.
    ``trigger`` defaults to ``{"availableNow": True}`` (R4);
    ``{"processingTime": "5 seconds"}`` is the reference's cadence (R5). ``console=k`` prints the first ``k``
    predictions of every batch (IO9). Without a ``model`` the sink gets the features."""
    trigger = trigger or {"availableNow": True}
    run = run_id(checkpoint)
    if stateful:
        newest = NewestTable(stream.sparkSession, f"{checkpoint.rstrip('/')}/newest", n, buckets or BUCKETS)

        def per_batch(batch: DataFrame, batch_id: int):
            rows = newest.update(batch, batch_id)
            _emit(features(rows, ["user_id"], bounded=True), model, vote, as_of, sink, run, batch_id, console)
            newest.compact()
    else:
        if table is None:
            raise ValueError("stateful=False needs the live table: a micro-batch alone is no history")

        def per_batch(batch: DataFrame, batch_id: int):
            live = valid_axes(_touched(table(), batch.select("user_id").distinct(), buckets))
            _emit(features(latest_n(live.select(*_COLS), n), ["user_id"], bounded=True), model, vote, as_of, sink, run,
                  batch_id, console)
    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint).trigger(**trigger)
    return w.start()


def stream_predict_events(spark: SparkSession, sf_dir: str, model, n: int = DEFAULT_LATEST_N,
                          stateful: bool = False, vote: str = "majority", as_of=None,
                          sink: str | None = None, checkpoint: str | None = None,
                          prepare: Callable[[DataFrame], DataFrame] = lambda df: df, clustered: bool = True) -> DataFrame:
    """One-shot (availableNow) run of C3 over the driver's events table as a file stream; returns the sink's rows
    (predictions, or features without a ``model``). ``prepare`` is applied to the stream and the table. ST1's live table is
    stored clustered first, as a user's would be, or read as it is (``clustered=False``)."""
    sink = sink or scratch_path(spark, "stream-predictions")
    checkpoint = checkpoint or scratch_path(spark, "stream-checkpoint")
    table = lambda: prepare(live_from_events(spark, sf_dir))
    if clustered and not stateful:
        store = scratch_path(spark, "live-table")
        write_clustered(prepare(live_from_events(spark, sf_dir)), store, "all")
        table = lambda: read_clustered(spark, store)
    q = start_prediction_stream(prepare(stream_events_as_live(spark, sf_dir)), model, sink, checkpoint, table=table, n=n,
                                stateful=stateful, vote=vote, as_of=as_of)
    q.awaitTermination()
    if model is None:
        return read_published(spark, sink).drop("run", "batch_id")
    return read_predictions(spark, sink)
