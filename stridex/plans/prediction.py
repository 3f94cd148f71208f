"""Prediction (M9, M10, R1-R4, C2): each user's newest N samples -> features -> model -> label text -> rows."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.features import features, zero_features
from ..operators.labels import assemble, decode_labels
from ..operators.selection import latest_n, restrict_to_users
from ..schema import DEFAULT_LATEST_N, PREDICTION
from ..sources.readers import valid_axes
from ..sources.sinks import append_predictions
from .voting import majority_vote


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def latest_features(live: DataFrame, n: int = DEFAULT_LATEST_N, users: DataFrame | Iterable[str] | None = None
                    ) -> DataFrame:
    """Features of each user's newest ``n`` samples (groups bounded by ``n``: one shuffle).

    With ``users`` given (names or a frame), those users only, and a user without rows gets 15 zeros (F16).
    """
    rows = valid_axes(restrict_to_users(live, users))
    feats = features(latest_n(rows, n), ["user_id"], bounded=True)
    if users is None:
        return feats
    if not isinstance(users, DataFrame):
        users = live.sparkSession.createDataFrame([(u,) for u in users], "user_id string")
    return zero_features(users, feats)


def classify(feats: DataFrame, model, vote: str = "majority") -> DataFrame:
    """M9/M10 (+M11 for forests with ``vote="majority"``) and M2: adds ``prediction`` (0..3) and ``activity``."""
    pts = assemble(feats)
    if isinstance(model, RandomForestClassificationModel) and vote == "majority":
        out = majority_vote(model, pts)
    else:
        out = model.copy().setRawPredictionCol("").setProbabilityCol("").transform(pts)
    return decode_labels(out.drop("features"), "prediction", "activity")


def predict(live: DataFrame, model, n: int = DEFAULT_LATEST_N, users=None, vote: str = "majority",
            as_of: Column | int | None = None) -> DataFrame:
    """R1/R2 (C2): ``PREDICTION`` rows ``(user_id, timestamp, prediction)``; ``timestamp`` is ``as_of`` in ms
    (default: now, as the reference stamped processing time)."""
    res = classify(latest_features(live, n, users), model, vote)
    ts = now_millis() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(int(as_of)))
    return res.select("user_id", ts.cast("long").alias("timestamp"), F.col("activity").alias("prediction"))


def predict_and_store(live: DataFrame, model, path: str, run: str | None = None, **kw) -> DataFrame:
    """Predict once and publish the rows in the result table; the rows as stored. A second call with the same ``run``
    publishes nothing and returns what the first one stored."""
    done = append_predictions(predict(live, model, **kw), path, run=run)
    return live.sparkSession.read.schema(PREDICTION).parquet(done.folder)
