"""stridex: classifying user activity from motion-sensor samples with Spark DataFrame and Spark ML plans.

Samples -> gap sessions -> intervals -> fifteen features -> decision tree / random forest -> the current activity of
every user, in batch or with Structured Streaming.
"""
from .config import apply_recommended, local_session, shared_dir
from .operators.features import features
from .operators.intervals import assign_intervals, interval_bounds
from .operators.sessions import gap_sessions, label_sessions
from .plans.prediction import predict
from .plans.training import labeled_points, train, train_models
from .schema import FEATURES, LABELS

__all__ = ["apply_recommended", "local_session", "shared_dir", "features", "assign_intervals", "interval_bounds",
           "gap_sessions", "label_sessions", "predict", "labeled_points", "train", "train_models", "FEATURES",
           "LABELS"]
