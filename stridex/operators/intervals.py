"""Intervals of sessions and the assignment of samples to them.

``anchor="stop"`` (the reference's behaviour, the default): interval ``i`` of a session, ``i = 0 .. intervals``
inclusive, is the open range ``(stop + (i-1)*width, stop + i*width)``. Both ends are excluded, intervals run
past the session's stop, and they catch samples of *any* session of the same key, so one sample can fall into
several intervals.

``anchor="start"`` (the documented intent): the session is tiled from its start into half-open
``[start + i*width, start + (i+1)*width)``; each sample lies in exactly one tile, found by arithmetic, no join.

Stop-anchored assignment is a range join. It never materialises the intervals: a sample ``t`` of a key lies in
interval ``i`` of session ``s`` exactly when ``stop_s - width < t < stop_s + intervals_s*width``, ``t - stop_s`` is
not a multiple of ``width`` (the excluded bounds), and then ``i = floor((t - stop_s) / width) + 1``. Sessions are
spread over time buckets of ``bucket`` ticks covering that span, samples get the bucket of their timestamp, and
the join is an equi-join on (key, bucket) with the span as residual; each (sample, session) pair meets in exactly
one bucket, so nothing is de-duplicated. Buckets also split a hot key over many join partitions. (With a gap far below
the width almost every sample stops a session, and each of them opens an interval of its own: the output itself then
grows with width / gap per sample.)
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import explode_range, floor_div
from ..schema import DEFAULT_GAP, DEFAULT_WIDTH, KEYS
from .sessions import gap_sessions, label_sessions

GROUP = ["session_id", "i"]


def interval_bounds(sessions: DataFrame, width: int = DEFAULT_WIDTH, anchor: str = "stop",
                    keys: list[str] = KEYS) -> DataFrame:
    """Every interval of every session (``INTERVAL`` schema), empty ones included."""
    w = int(width)
    s = explode_range(sessions, "0L", "intervals", "i", spread=[*keys, "session_id"])
    if anchor == "stop":
        lo = F.col("session_stop") + (F.col("i") - 1) * F.lit(w)
        hi = F.col("session_stop") + F.col("i") * F.lit(w)
    elif anchor == "start":
        lo = F.col("session_start") + F.col("i") * F.lit(w)
        hi = lo + F.lit(w)
    else:
        raise ValueError(f"anchor must be 'stop' or 'start', not {anchor!r}")
    return s.select(*keys, "session_id", "i", lo.alias("lo"), hi.alias("hi"))


def assign_stop_anchored(samples: DataFrame, sessions: DataFrame, width: int = DEFAULT_WIDTH,
                         keys: list[str] = KEYS, bucket: int | None = None) -> DataFrame:
    """Samples joined to the stop-anchored intervals that contain them; empty intervals never appear.

    Output: the sample columns plus ``session_id, i, lo, hi``.
    """
    w = int(width)
    b = int(bucket or w)
    span_lo = F.col("session_stop") - F.lit(w)                          # exclusive
    span_hi = F.col("session_stop") + F.col("intervals") * F.lit(w)     # exclusive
    s = sessions.select(*keys, "session_id", "session_stop", "intervals", span_lo.alias("_slo"),
                        span_hi.alias("_shi"))
    b_lo = f"((session_stop - {w} + 1) - pmod(session_stop - {w} + 1, {b})) div {b}"
    b_hi = f"((session_stop + intervals * {w} - 1) - pmod(session_stop + intervals * {w} - 1, {b})) div {b}"
    s = explode_range(s, b_lo, b_hi, "_b", spread=[*keys, "session_id"]).drop("intervals")
    r = samples.select("*", floor_div("timestamp", b).alias("_b"))
    d = F.col("timestamp") - F.col("session_stop")
    j = r.join(s, [*keys, "_b"]).where((F.col("timestamp") > F.col("_slo")) & (F.col("timestamp") < F.col("_shi"))
                                       & (F.pmod(d, F.lit(w)) != 0))
    i = floor_div("timestamp - session_stop", w) + 1
    cols = [c for c in samples.columns if c not in keys]
    return j.select(*keys, *cols, "session_id", i.alias("i"),
                    (F.col("session_stop") + (i - 1) * F.lit(w)).alias("lo"),
                    (F.col("session_stop") + i * F.lit(w)).alias("hi"))


def assign_tiled(labelled: DataFrame, width: int = DEFAULT_WIDTH) -> DataFrame:
    """Tile index from the sample's own session start; no join."""
    w = int(width)
    i = F.expr(f"(timestamp - session_start) div {w}")
    lo = F.col("session_start") + i * F.lit(w)
    return labelled.select("*", i.alias("i"), lo.alias("lo"), (lo + F.lit(w)).alias("hi"))


def assign_intervals(samples: DataFrame, gap: int = DEFAULT_GAP, width: int = DEFAULT_WIDTH, anchor: str = "stop",
                     keys: list[str] = KEYS, chunk: int | None = None, bucket: int | None = None,
                     method: str = "auto") -> DataFrame:
    """Samples -> sessions -> the intervals each sample falls into (``session_id, i, lo, hi`` added).
    ``method`` is the sessionization method (``"auto"``, ``"chunk"`` or ``"range"``, see ``sessions``)."""
    if anchor == "stop":
        sessions = gap_sessions(samples, gap=gap, width=width, keys=keys, chunk=chunk, method=method)
        return assign_stop_anchored(samples, sessions, width=width, keys=keys, bucket=bucket)
    if anchor == "start":
        lab = label_sessions(samples, gap=gap, keys=keys, chunk=chunk, method=method)
        return assign_tiled(lab, width=width).drop("prev_timestamp", "diff", "jump", "session_start")
    raise ValueError(f"anchor must be 'stop' or 'start', not {anchor!r}")


def interval_groups(assigned: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Non-empty intervals with their row count (``INTERVAL`` + ``n``)."""
    return assigned.groupBy(*keys, *GROUP, "lo", "hi").agg(F.count(F.lit(1)).alias("n"))
