"""Declared schemas, the activity domain, feature order and default parameters.

The reference never declares a schema; every column type below is the one its code casts to at run time.
"""
from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference's for right results:
# activity labels in class-number order 0, 1, 2, 3.
LABELS = ["Walking", "Jogging", "Standing", "Sitting"]

# The fifteen features in vector order (positions 0 to 14).
FEATURES = [
    "mean_x", "mean_y", "mean_z",
    "var_x", "var_y", "var_z",
    "std_x", "std_y", "std_z",
    "aad_x", "aad_y", "aad_z",
    "resultant", "peak_time", "diff_xy",
]

# The reference's jump gap and interval width (ticks of the timestamp column),
# the number of newest samples used for a prediction, and the model settings.
DEFAULT_GAP = 100_000_000
DEFAULT_WIDTH = 500_000_000
DEFAULT_LATEST_N = 100
DEFAULT_USER_CAP = 10
PEAK_RATIO = 0.9
TREE_PARAMS = dict(impurity="gini", maxDepth=20, maxBins=32)
FOREST_PARAMS = dict(numTrees=10, featureSubsetStrategy="auto", impurity="gini", maxDepth=20, maxBins=32, seed=12345)
TRAIN_FRACTION = 0.6
# Execution settings of the tree learners: node ids cached on the executors instead of shipping trees, bigger node
# batches per pass, node-id cache checkpointed every 10 passes. The batch size can change the order in which a forest
# draws its feature subsets, so it belongs to the forest's definition as the seed does.
FIT_SETTINGS = dict(cacheNodeIds=True, maxMemoryInMB=1024, checkpointInterval=10)

KEYS = ["user_id", "activity"]

ACCEL_TRAINING = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("activity", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("z", T.DoubleType()),
])

ACCEL_LIVE = T.StructType([f for f in ACCEL_TRAINING.fields if f.name != "activity"])

SESSION = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("activity", T.StringType()),
    T.StructField("session_id", T.LongType()),
    T.StructField("session_start", T.LongType()),
    T.StructField("session_stop", T.LongType()),
    T.StructField("n_samples", T.LongType()),
    T.StructField("intervals", T.LongType()),
])

INTERVAL = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("activity", T.StringType()),
    T.StructField("session_id", T.LongType()),
    T.StructField("i", T.LongType()),
    T.StructField("lo", T.LongType()),
    T.StructField("hi", T.LongType()),
])

PREDICTION = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("prediction", T.StringType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
