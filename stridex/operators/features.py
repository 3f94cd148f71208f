"""The fifteen features per group (F1-F18): one function for training intervals, batch and stream prediction.

Definitions (reference semantics):

- mean, variance with n-1 (0.0 for one row), standard deviation with n (population), mean absolute deviation
  from the mean, mean resultant sqrt(x^2+y^2+z^2), mean x - mean y;
- time between peaks: a peak is a row whose y *cut towards zero to an integer* is strictly over 0.9 x the group's
  max of the uncut y; with the distinct peak times sorted, the mean of neighbour differences, which telescopes to
  ``(last - first) / (distinct count - 1)``; 0.0 with fewer than two distinct peak times.

Two plan shapes:

- ``bounded=False`` (default; groups of any size): the group statistics are a plain aggregate (partial
  aggregation before the shuffle, so a group holding a third of all rows is pre-reduced in every map task). The
  mean- and max-dependent parts need those statistics next to every row: ``attach_group_stats`` joins them in
  the shape AQE's skew join can split (a hot group's rows are cut into many tasks), then everything is
  aggregated again with a partial aggregate before the shuffle. The distinct peak count is a two-level distinct
  aggregate whose first level is keyed by (group, peak time).
- ``bounded=True`` (groups known to be small, e.g. a user's latest N): one shuffle; a window over the group gives
  the means and max, the same exchange serves the aggregate, and the distinct peak times of a group (at most N)
  are counted with a set.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import resultant, trunc_to_long
from ..schema import FEATURES, PEAK_RATIO
from ..sources.readers import valid_axes

AXES = ["x", "y", "z"]


def _peak(truncate_y: bool):
    y = trunc_to_long("y") if truncate_y else F.col("y")
    return y > F.lit(PEAK_RATIO) * F.col("_ymax")


def _moment_aggs():
    out = [F.count(F.lit(1)).alias("n")]
    out += [F.avg(a).alias(f"mean_{a}") for a in AXES]
    out += [F.coalesce(F.var_samp(a), F.lit(0.0)).alias(f"var_{a}") for a in AXES]
    out += [F.stddev_pop(a).alias(f"std_{a}") for a in AXES]
    out.append(F.avg(resultant()).alias("resultant"))
    return out


def _deviation_aggs(truncate_y: bool, bounded: bool):
    pk = F.when(_peak(truncate_y), F.col("timestamp"))
    out = [F.avg(F.abs(F.col(a) - F.col(f"_m{a}"))).alias(f"aad_{a}") for a in AXES]
    out += [F.min(pk).alias("_pmin"), F.max(pk).alias("_pmax")]
    out.append((F.size(F.collect_set(pk)) if bounded else F.count_distinct(pk)).alias("_pn"))
    return out


def _finish(df: DataFrame, keys: list[str]) -> DataFrame:
    pn = F.col("_pn")
    computed = {
        "peak_time": F.when(pn > 1, (F.col("_pmax") - F.col("_pmin")) / (pn - 1)).otherwise(F.lit(0.0))
                      .cast("double"),
        "diff_xy": F.col("mean_x") - F.col("mean_y"),
    }
    return df.select(*keys, "n", *[computed[c].alias(c) if c in computed else F.col(c) for c in FEATURES])


def features(df: DataFrame, keys: list[str], bounded: bool = False, truncate_y: bool = True,
             written: bool = False) -> DataFrame:
    """``keys + n + FEATURES`` for every group of ``df`` (needs columns timestamp, x, y, z). Rows with a missing or
    NaN axis are not used. ``written``: write the rows to the shared folder first; the unbounded form reads them three
    times, which is worth a write when ``df`` is a join."""
    rows = valid_axes(df.select(*keys, "timestamp", *AXES))
    if written and not bounded:
        from ..sources.tables import materialize
        rows = materialize(rows, "feature-rows")
    if bounded:
        w = Window.partitionBy(*keys)
        rows = rows.select("*", *[F.avg(a).over(w).alias(f"_m{a}") for a in AXES], F.max("y").over(w).alias("_ymax"))
        agg = rows.groupBy(*keys).agg(*_moment_aggs(), *_deviation_aggs(truncate_y, bounded=True))
        return _finish(agg, keys)
    # moments straight from one aggregate; only the mean/max-dependent features go through the join-back, and
    # they come back through a left join on a side that is unique per key -- which Catalyst removes when a
    # caller uses none of its columns (a query asking only for means never shuffles the rows twice)
    moments = rows.groupBy(*keys).agg(*_moment_aggs(), F.max("y").alias("_ymax"))
    stats = moments.select(*keys, *[F.col(f"mean_{a}").alias(f"_m{a}") for a in AXES], "_ymax")
    dev = attach_group_stats(rows, stats, keys).groupBy(*keys).agg(*_deviation_aggs(truncate_y, bounded=False))
    return _finish(moments.drop("_ymax").join(dev, keys, "left"), keys)


def attach_group_stats(rows: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` joined with their group's row of ``stats`` (one row per group), shaped so a hot group can be split.

    The join runs on a derived group key (a 64-bit hash of the keys) plus the keys themselves (so collisions
    are harmless). Neither side is then already partitioned for the join: both are plain shuffles, the shape
    AQE's skew-join rule needs to cut a hot group's rows into many tasks (replicating its single statistics
    row), and the aggregate that follows gets its own exchange after a partial aggregate. ``stats`` is an
    aggregate, so it is small next to ``rows``; if it is under the broadcast threshold AQE broadcasts it
    instead, and the rows do not move at all.
    """
    gk = F.xxhash64(*keys)
    r = rows.select("*", gk.alias("_gk"))
    s = stats.select("*", gk.alias("_gk"))
    return r.join(s, ["_gk", *keys]).drop("_gk")


def zero_features(users: DataFrame, feats: DataFrame, key: str = "user_id") -> DataFrame:
    """F16: every asked-for user, with 15 zeros (and n = 0) when the user has no rows."""
    out = users.select(key).distinct().join(feats, key, "left")
    return out.fillna(0.0, subset=FEATURES).fillna(0, subset=["n"])


def peak_rows(df: DataFrame, keys: list[str], truncate_y: bool = True) -> DataFrame:
    """The peak rows of every group with the cut y and the group max. The max comes back to
    the rows in the shape of ``attach_group_stats``, so a hot group is split over many tasks."""
    rows = valid_axes(df.select(*keys, "timestamp", *AXES)).select(*keys, "timestamp", "y")
    mx = rows.groupBy(*keys).agg(F.max("y").alias("_ymax"))
    j = attach_group_stats(rows, mx, keys).where(_peak(truncate_y))
    return j.select(*keys, "timestamp", "y", trunc_to_long("y").alias("y_cut"), F.col("_ymax").alias("y_max"))


def peak_deltas(df: DataFrame, keys: list[str], truncate_y: bool = True, chunk: int | None = None) -> DataFrame:
    """differences between neighbouring distinct peak times (all > 0), the lag form of F14.

    Runs on the chunked scan of ``sessions.label_sessions``, so a group with very many peaks is never one task.
    """
    from .sessions import label_sessions

    p = peak_rows(df, keys, truncate_y).select(*keys, "timestamp").distinct()
    d = label_sessions(p, gap=0, keys=keys, chunk=chunk)
    return (d.where(F.col("prev_timestamp").isNotNull())
             .select(*keys, F.col("prev_timestamp").alias("prev_peak"), "timestamp", F.col("diff").alias("delta")))


def peak_time_by_lag(df: DataFrame, keys: list[str], truncate_y: bool = True) -> DataFrame:
    """F13/F14 as the reference states them (mean of kept deltas); equals the closed form in ``features``."""
    d = peak_deltas(df, keys, truncate_y)
    return d.groupBy(*keys).agg(F.avg("delta").alias("peak_time"))
