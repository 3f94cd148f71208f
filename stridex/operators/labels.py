"""Labels, labelled points and the train/test split (M1-M4)."""
from __future__ import annotations

from pyspark.ml.feature import IndexToString, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import label_index, label_text
from ..schema import FEATURES, LABELS, TRAIN_FRACTION


def label_encoder(input_col: str = "activity", output_col: str = "label") -> StringIndexerModel:
    """M1 as an ML stage: fixed label order, rows outside the domain skipped, 4-class nominal metadata."""
    return StringIndexerModel.from_labels(LABELS, inputCol=input_col, outputCol=output_col, handleInvalid="skip")


def label_decoder(input_col: str = "prediction", output_col: str = "predicted_activity") -> IndexToString:
    """M2 as an ML stage."""
    return IndexToString(inputCol=input_col, outputCol=output_col, labels=LABELS)


def encode_labels(df: DataFrame, activity: str = "activity", label: str = "label") -> DataFrame:
    """M1 as a column expression: 0..3, rows outside the domain dropped."""
    return df.withColumn(label, label_index(activity)).where(F.col(label).isNotNull())


def decode_labels(df: DataFrame, label: str = "prediction", out: str = "predicted_activity") -> DataFrame:
    """M2: class number -> label text; an unknown number raises."""
    return df.withColumn(out, label_text(label))


def assemble(df: DataFrame, output_col: str = "features") -> DataFrame:
    """the fifteen columns as one ML vector, in the fixed order."""
    return VectorAssembler(inputCols=FEATURES, outputCol=output_col, handleInvalid="error").transform(df)


def split_key(cols: list[str]):
    """Deterministic per-row bucket 0..99 from an md5 of the key columns (same value in any SQL engine with md5)."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(100))


def hash_split(df: DataFrame, key_cols: list[str], fraction: float = TRAIN_FRACTION) -> DataFrame:
    """M4, repeatable: ``is_train`` from the key hash. Recomputing a lost partition gives the same split, which a
    random split over a shuffled input does not guarantee."""
    return df.withColumn("is_train", split_key(key_cols) < F.lit(int(round(fraction * 100))))


def random_split(df: DataFrame, fraction: float = TRAIN_FRACTION, seed: int = 12345):
    """M4 as in the reference (random 60/40), seeded. The input is written to the shared folder first, so its
    partition contents are fixed and a recomputed partition cannot move rows between the two sides."""
    from ..sources.tables import materialize
    fixed = materialize(df, "split-input")
    return fixed.randomSplit([fraction, 1.0 - fraction], seed=seed)
