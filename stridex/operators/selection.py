"""Projections, filters, user lists and latest-N."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DEFAULT_LATEST_N, DEFAULT_USER_CAP, KEYS, LABELS
from ..sources.layout import of_user


def filter_user(df: DataFrame, user: str) -> DataFrame:
    """Equality on ``user_id`` (reaches the scan of a sample table, with the user's bucket on a clustered one; the events
    adapter translates it, see readers)."""
    return df.where(of_user(user, df))


def filter_user_activity(df: DataFrame, user: str, activity: str) -> DataFrame:
    """User and activity, activity compared by label text, case-sensitive."""
    return df.where(of_user(user, df) & (F.col("activity") == F.lit(activity)))


def filter_open_range(df: DataFrame, lo: int, hi: int, column: str = "timestamp") -> DataFrame:
    """``lo < t < hi`` -- both ends excluded."""
    return df.where((F.col(column) > F.lit(lo)) & (F.col(column) < F.lit(hi)))


def activity_domain(df: DataFrame) -> DataFrame:
    """P5: only the four labelled activities."""
    return df.where(F.col("activity").isin(LABELS))


def distinct_users(df: DataFrame) -> DataFrame:
    """Two-phase distinct (partial aggregate before the shuffle, so a hot user costs one row per task)."""
    return df.select("user_id").distinct()


def capped_users(df: DataFrame, n: int | None = DEFAULT_USER_CAP) -> DataFrame:
    """The first ``n`` users by id (the reference took "the first ten" of an unordered set). None = all."""
    users = distinct_users(df)
    return users if n is None else users.orderBy("user_id").limit(n)


def restrict_to_users(df: DataFrame, users: DataFrame | Iterable[str] | None) -> DataFrame:
    """Keep rows of the given users (duplicates in ``users`` do not matter).

    Names become a predicate that reaches the scan. A frame becomes a left semi join on a derived key (hash of the
    user id, plus the id): both inputs are then plain shuffles, the shape AQE's skew join can split when one user
    holds a large share of the rows, and AQE broadcasts the list itself if its measured size allows it.
    """
    if users is None:
        return df
    if not isinstance(users, DataFrame):
        return df.where(F.col("user_id").isin([str(u) for u in users]))
    uk = F.xxhash64("user_id")
    side = users.select("user_id", uk.alias("_uk"))
    return df.select("*", uk.alias("_uk")).join(side, ["_uk", "user_id"], "left_semi").drop("_uk")


def newest_first(df: DataFrame) -> list[Column]:
    """A total order of samples, newest first: ties of the timestamp go by the axes the frame has."""
    return [F.desc("timestamp"), *[F.asc(c) for c in ("x", "y", "z") if c in df.columns]]


def latest_n_user(df: DataFrame, user: str, n: int = DEFAULT_LATEST_N) -> DataFrame:
    """The newest ``n`` samples of one user (top-k, no activity filter)."""
    return filter_user(df, user).orderBy(*newest_first(df)).limit(n)


LATEST_SLICES = 32


def latest_n(df: DataFrame, n: int = DEFAULT_LATEST_N, by: str = "user_id") -> DataFrame:
    """The newest ``n`` samples of every user, in two rounds.

    The first round takes the newest ``n`` of each (user, slice by hash of time and axes), the second the newest of those: a
    user holding a third of all rows is spread over ``LATEST_SLICES`` tasks, and the last round gets at most
    ``n * LATEST_SLICES`` rows of a user, whatever ``n`` and the number of map tasks. ``row_number() <= n`` also lets
    Catalyst cut rows before the shuffle (``WindowGroupLimit``; its threshold is raised in the recommended settings).
    """
    order = newest_first(df)
    piece = Window.partitionBy(by, "_slice").orderBy(*order)
    spread = F.xxhash64("timestamp", *[c for c in ("x", "y", "z") if c in df.columns])       # a burst at one instant too
    some = df.withColumn("_slice", F.pmod(spread, F.lit(LATEST_SLICES)))
    some = some.withColumn("_rn", F.row_number().over(piece)).where(F.col("_rn") <= n).drop("_rn", "_slice")
    w = Window.partitionBy(by).orderBy(*order)
    return some.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def time_bounds(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """T5: first and last instant and row count per key (partial aggregate, skew safe)."""
    return df.groupBy(*keys).agg(F.min("timestamp").alias("t_first"), F.max("timestamp").alias("t_last"),
                                 F.count(F.lit(1)).alias("n"))


def time_ordered(df: DataFrame, descending: bool = False) -> DataFrame:
    """Rows in time order."""
    return df.orderBy(F.desc("timestamp") if descending else F.asc("timestamp"))
