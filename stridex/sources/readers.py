"""Sources (IO1-IO3): sample tables, the driver's ``events`` table seen through the adapter, and file streams.

Every reader declares its schema (no inference) and drops rows without keys or timestamp. Axes are checked where
they are used (``valid_axes``: NULL or NaN axes would fail the reference's unboxing and Spark's ANSI casts), so a
step that needs only keys and times -- user lists, sessions -- reads only those columns from the files.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ACCEL_LIVE, ACCEL_TRAINING, EVENTS

# Fixed values of the events adapter: event type -> activity label. "error" maps outside the domain on purpose.
EVENT_ACTIVITY = {
    "click": "Walking",
    "view": "Jogging",
    "purchase": "Standing",
    "signup": "Sitting",
    "error": "Upstairs",
}

_AXES = ["x", "y", "z"]


def _keys_present(required: list[str]) -> Column:
    cond = F.lit(True)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    return cond


def validate_samples(df: DataFrame, with_activity: bool = True) -> DataFrame:
    """Rows with user, timestamp (and activity) present."""
    return df.where(_keys_present(["user_id", "timestamp"] + (["activity"] if with_activity else [])))


def axes_ok() -> Column:
    cond = F.lit(True)
    for c in _AXES:
        cond = cond & F.col(c).isNotNull() & ~F.isnan(F.col(c))
    return cond


def valid_axes(df: DataFrame) -> DataFrame:
    """Rows whose three axes are present and not NaN (the rows a feature can use)."""
    return df.where(axes_ok())


def rejected_samples(df: DataFrame, with_activity: bool = True) -> DataFrame:
    """Rows no feature can use (missing keys/time or bad axes), for auditing."""
    keys = _keys_present(["user_id", "timestamp"] + (["activity"] if with_activity else []))
    return df.where(~(keys & axes_ok()))


def read_training(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """IO1: training samples ``ACCEL_TRAINING``. ``fmt`` is any Spark data source (parquet, orc, delta, ...)."""
    df = spark.read.format(fmt).schema(ACCEL_TRAINING).options(**options).load(path)
    return validate_samples(df.select(*ACCEL_TRAINING.fieldNames()))


def read_live(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """IO2: live samples ``ACCEL_LIVE`` (no activity column is read)."""
    df = spark.read.format(fmt).schema(ACCEL_LIVE).options(**options).load(path)
    return validate_samples(df.select(*ACCEL_LIVE.fieldNames()), with_activity=False)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _activity(event_type: Column) -> Column:
    expr = F.lit(None).cast("string")
    for k, v in reversed(list(EVENT_ACTIVITY.items())):
        expr = F.when(event_type == F.lit(k), F.lit(v)).otherwise(expr)
    return expr


def raw_predicate(users=None, after: int | None = None, before: int | None = None) -> Column:
    """User names and an open time range (nanoseconds) as a predicate on the raw events columns, which reaches the scan.

    ``users`` that are no integer match no event. ``after`` and ``before`` are excluded; event times are whole
    microseconds, so the range is first taken to microseconds without loss."""
    cond = F.lit(True)
    if users is not None:
        ids = [int(u) for u in users if str(u).lstrip("-").isdigit() and str(int(u)) == str(u)]
        cond = cond & F.col("user_id").isin(ids)
    for ns, low in ((after, True), (before, False)):
        if ns is not None:
            at = F.expr(f"TIMESTAMP_NTZ'{_instant(ns // 1000 if low else -(-ns // 1000))}'")
            cond = cond & ((F.col("ts") > at) if low else (F.col("ts") < at))
    return cond


def _instant(micros: int) -> str:
    from datetime import datetime, timedelta
    return (datetime(1970, 1, 1) + timedelta(microseconds=micros)).isoformat(sep=" ", timespec="microseconds")


def _adapt(events: DataFrame, with_activity: bool) -> DataFrame:
    """The events adapter: timestamp in nanoseconds since epoch (zone free), axes derived from value, props, id.

    Key and time checks are on raw columns (they reach the Parquet scan as pushed filters). The props text is
    parsed once per row by a ``json_tuple`` generator, which Catalyst drops -- and with it the props column --
    when no step uses ``y``.
    """
    raw = events.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    if with_activity:                    # a live sample needs no activity, so any type of event is one
        raw = raw.where(F.col("event_type").isin(list(EVENT_ACTIVITY)))
    parsed = raw.select("*", F.json_tuple("props", "k").alias("_k"))
    cols = [F.col("user_id").cast("string").alias("user_id")]
    if with_activity:
        cols.append(_activity(F.col("event_type")).alias("activity"))
    cols += [
        (F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)") * F.lit(1000)).alias("timestamp"),
        (F.col("value") / F.lit(10.0)).alias("x"),
        (F.col("_k").try_cast("double") / F.lit(5.0)).alias("y"),
        ((F.col("event_id") % F.lit(97)) / F.lit(10.0) - F.lit(4.8)).alias("z"),
    ]
    return parsed.select(*cols)


def events_as_training(events: DataFrame) -> DataFrame:
    return _adapt(events, with_activity=True)


def events_as_live(events: DataFrame) -> DataFrame:
    return _adapt(events, with_activity=False)


def training_from_events(spark: SparkSession, sf_dir: str, **wanted) -> DataFrame:
    """Training samples of the events table; ``wanted`` as in ``raw_predicate``."""
    return events_as_training(read_events(spark, sf_dir).where(raw_predicate(**wanted)))


def live_from_events(spark: SparkSession, sf_dir: str, **wanted) -> DataFrame:
    """Live samples of the events table; ``wanted`` as in ``raw_predicate``."""
    return events_as_live(read_events(spark, sf_dir).where(raw_predicate(**wanted)))


def stream_live(spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None,
                **options) -> DataFrame:
    """IO3: live samples as a stream (file source; any streaming source with the same schema fits)."""
    r = spark.readStream.format(fmt).schema(ACCEL_LIVE).options(**options)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return validate_samples(r.load(path).select(*ACCEL_LIVE.fieldNames()), with_activity=False)


def stream_events_as_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``events`` table as a file stream, through the adapter."""
    raw = (spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet")
           .parquet(sf_dir.rstrip("/")))
    return events_as_live(raw)
