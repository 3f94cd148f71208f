"""Random-forest prediction by one vote per tree (the RDD-API forest the reference used), not by averaged
leaf probabilities (the DataFrame-API forest). Ties go to the lowest class number."""
from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def majority_vote(model: RandomForestClassificationModel, df: DataFrame, features_col: str = "features",
                  prediction_col: str = "prediction") -> DataFrame:
    cur = df
    cols = []
    for k, tree in enumerate(model.trees):
        name = f"_vote{k}"
        t = tree.copy().setFeaturesCol(features_col).setPredictionCol(name)
        t = t.setRawPredictionCol("").setProbabilityCol("")
        cur = t.transform(cur)
        cols.append(name)
    counts = [sum((F.col(c) == F.lit(float(k))).cast("int") for c in cols) for k in range(model.numClasses)]
    arr = F.array(*counts)
    winner = (F.array_position(arr, F.array_max(arr)) - 1).cast("double")
    return cur.withColumn(prediction_col, winner).drop(*cols)
