"""Training (C1): samples -> labelled points -> decision tree and random forest -> accuracies.

No driver loop over users or activities: the intervals of every (user, activity) are built and featurised in one
plan, and only ``fit`` triggers jobs. Both learners are Spark ML's distributed tree learners.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.classification import (DecisionTreeClassificationModel, DecisionTreeClassifier,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import features
from ..operators.intervals import GROUP, assign_intervals
from ..operators.labels import assemble, encode_labels, hash_split, random_split
from ..operators.selection import activity_domain, capped_users, restrict_to_users
from ..schema import (DEFAULT_GAP, DEFAULT_WIDTH, FEATURES, FIT_SETTINGS, FOREST_PARAMS, KEYS,
                      LABELS, TRAIN_FRACTION, TREE_PARAMS)
from ..sources.models import save_model
from ..sources.tables import materialize
from .voting import majority_vote

POINT_KEYS = [*KEYS, *GROUP]

# Part of the forest's definition, like its seed, as bootstrap draws are per partition: a function of the points alone.
FIT_LEAST, POINTS_PER_PARTITION = 8, 200_000          # some 50 MB of cached points


def fit_partitions(points: int) -> int:
    """Partitions of a fit on ``points`` rows."""
    return max(FIT_LEAST, -(-points // POINTS_PER_PARTITION))


def labeled_points(samples: DataFrame, gap: int = DEFAULT_GAP, width: int = DEFAULT_WIDTH, anchor: str = "stop",
                   user_cap: int | None = None, chunk: int | None = None, bucket: int | None = None,
                   method: str = "auto") -> DataFrame:
    """M3: one row per non-empty interval: keys, ``n``, the fifteen features and ``label`` (0..3).

    All users, unless ``user_cap`` asks for the first users by id over the whole table (P7). ``method`` is the
    sessionization method. The assigned rows are written once: the range join runs a single time.
    """
    s = samples
    if user_cap is not None:
        s = restrict_to_users(s, capped_users(samples, user_cap))
    s = activity_domain(s)
    assigned = assign_intervals(s, gap=gap, width=width, anchor=anchor, chunk=chunk, bucket=bucket,
                                method=method)
    feats = features(assigned, POINT_KEYS, written=True)
    return encode_labels(feats)


def _with_label_metadata(df: DataFrame) -> DataFrame:
    # nominal metadata fixes numClasses = 4 even when a class is missing from the training rows
    meta = {"ml_attr": {"type": "nominal", "name": "label", "vals": LABELS}}
    return df.withColumn("label", F.col("label").alias("label", metadata=meta))


@dataclass
class Trained:
    tree: DecisionTreeClassificationModel
    forest: RandomForestClassificationModel
    points: DataFrame
    train: DataFrame
    test: DataFrame

    def test_predictions(self) -> DataFrame:
        """``model, label, prediction`` for both models on the test rows (forest by majority vote)."""
        t = self.tree.transform(self.test).select(F.lit("tree").alias("model"), "label", "prediction")
        f = majority_vote(self.forest, self.test).select(F.lit("forest").alias("model"), "label", "prediction")
        return t.unionByName(f)

    def report(self) -> DataFrame:
        """One row ``n_points, dt_accuracy, rf_accuracy``; accuracy of an empty test set is NaN (0/0)."""
        tagged = (self.points.select(F.lit("point").alias("model"), F.lit(None).cast("double").alias("label"),
                                     F.lit(None).cast("double").alias("prediction"))
                  .unionByName(self.test_predictions()))
        ok = (F.col("label") == F.col("prediction")).cast("double")

        def acc(name):
            hits = F.sum(F.when(F.col("model") == name, ok))
            total = F.count(F.when(F.col("model") == name, F.lit(1)))
            return F.when(total == 0, F.lit(float("nan"))).otherwise(hits / total)

        return tagged.agg(F.count(F.when(F.col("model") == "point", F.lit(1))).alias("n_points"),
                          acc("tree").alias("dt_accuracy"), acc("forest").alias("rf_accuracy"))


def split(points: DataFrame, how: str = "hash", fraction: float = TRAIN_FRACTION, seed: int = 12345):
    """M4: ``hash`` (repeatable, the default) or ``random`` (the reference's random 60/40, seeded)."""
    if how == "hash":
        s = hash_split(points, POINT_KEYS, fraction)
        return s.where("is_train").drop("is_train"), s.where(~F.col("is_train")).drop("is_train")
    if how == "random":
        return tuple(random_split(points, fraction, seed))
    raise ValueError(f"split must be 'hash' or 'random', not {how!r}")


def fit_tree(train: DataFrame) -> DecisionTreeClassificationModel:
    """M6: gini, depth 20, 32 bins, no categorical features."""
    return DecisionTreeClassifier(labelCol="label", featuresCol="features", **TREE_PARAMS, **FIT_SETTINGS).fit(train)


def fit_forest(train: DataFrame) -> RandomForestClassificationModel:
    """M7: 10 trees, feature subset "auto", gini, depth 20, 32 bins, seed 12345."""
    return RandomForestClassifier(labelCol="label", featuresCol="features", **FOREST_PARAMS,
                                  **FIT_SETTINGS).fit(train)


def fixed_layout(df: DataFrame, partitions: int) -> DataFrame:
    """Rows in a layout that depends on the data and ``partitions`` only: hash partitions by the point key, sorted
    inside. Forest bootstrap draws are per partition and per row position, so with this layout the same seed
    gives the same forest on any cluster, and a partition recomputed after an executor loss gets the same draws."""
    return df.repartition(partitions, *POINT_KEYS).sortWithinPartitions(*POINT_KEYS)


def train_models(points: DataFrame, how: str = "hash", fraction: float = TRAIN_FRACTION, seed: int = 12345,
                 tree_path: str | None = None, forest_path: str | None = None,
                 partitions: int | None = None, write_points: bool = True, models=("tree", "forest")) -> Trained:
    """C1 after the points: write them once (shared folder), split, cache the training side (M5), fit the ``models``
    asked for, optionally save them (IO5, IO6). The split, the fits and the report all read the written points, whose number
    sets the ``partitions`` of the fits unless they are given."""
    if write_points:
        points = materialize(points, "labeled-points")
    pts = _with_label_metadata(assemble(points))
    train, test = split(pts, how=how, fraction=fraction, seed=seed)
    train = fixed_layout(train, partitions or fit_partitions(points.count())).select("label", "features").persist()
    try:
        # the two fits are independent jobs over the same cached rows: submit them together so the cluster runs
        # their stages side by side (each seeded; concurrency does not change either model)
        with ThreadPoolExecutor(max_workers=2) as pool:
            tree_f = pool.submit(fit_tree, train) if "tree" in models else None
            forest_f = pool.submit(fit_forest, train) if "forest" in models else None
            tree, forest = (f and f.result() for f in (tree_f, forest_f))
    finally:
        train.unpersist()
    if tree_path and tree:
        save_model(tree, tree_path)
    if forest_path and forest:
        save_model(forest, forest_path)
    return Trained(tree, forest, pts, train, test)


def train(samples: DataFrame, gap: int = DEFAULT_GAP, width: int = DEFAULT_WIDTH, anchor: str = "stop",
          user_cap: int | None = None, how: str = "hash", method: str = "auto", **kw) -> Trained:
    """The whole training job, on all users unless ``user_cap`` is given."""
    return train_models(labeled_points(samples, gap=gap, width=width, anchor=anchor, user_cap=user_cap, method=method),
                        how=how, **kw)


__all__ = ["labeled_points", "split", "fit_tree", "fit_forest", "train_models", "train", "Trained", "FEATURES"]
