"""Sinks (IO4, IO9): prediction rows ``PREDICTION``, published once per run and batch.

A stream writes each micro-batch aside and publishes it under its run and batch number (``commits``): a replayed batch finds
itself published and writes nothing. The run id comes from the checkpoint folder, which is what numbers the batches: a
restart from the same checkpoint goes on in the same run, a fresh checkpoint starts a run of its own and leaves earlier
results alone. A batch job publishes under its run id (a new one unless given), so a re-run with the same id adds nothing.
"""
from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..schema import PREDICTION
from .commits import CommitLog, Entry

_COLS = PREDICTION.fieldNames()


def run_id(checkpoint: str) -> str:
    return "r" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def write_batch(df: DataFrame, path: str, run: str, batch_id: int, fmt: str = "parquet") -> Entry:
    """IO4 inside ``foreachBatch``: publish a micro-batch, once per run and batch."""
    return CommitLog(df.sparkSession, path).publish(
        f"run={run},batch_id={int(batch_id):012d}", lambda folder: df.write.format(fmt).save(folder),
        place=f"run={run}/batch_id={int(batch_id)}")


def append_predictions(df: DataFrame, path: str, fmt: str = "parquet", run: str | None = None) -> Entry:
    """IO4: append ``(user_id, timestamp, prediction)`` rows, once per ``run``."""
    return write_batch(df.select(*_COLS), path, run or f"r{uuid.uuid4().hex[:12]}", 0, fmt)


def read_published(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """All published rows of a sink with their ``run`` and ``batch_id``; None without any."""
    log = CommitLog(spark, path)
    folders = [e.folder for e in log.entries()]
    if not folders:
        return None
    return spark.read.format(fmt).option("basePath", f"{log.path}/data").load(folders).drop("attempt")


def read_predictions(spark: SparkSession, path: str, fmt: str = "parquet", with_batch: bool = False) -> DataFrame:
    """``PREDICTION`` rows of a sink; ``with_batch`` adds the ``run`` and ``batch_id`` of each."""
    df = read_published(spark, path, fmt)
    log = CommitLog(spark, path)
    if df is None and not log.exists() and log.holds_files():       # rows appended by other means, without publications
        df = spark.read.format(fmt).load(path)
    if df is None:
        df = spark.createDataFrame([], f"{PREDICTION.simpleString()[7:-1].replace(chr(58), chr(32))}, run string, batch_id int"
                                   if with_batch else PREDICTION)
    return df.select(*_COLS, *(c for c in ("run", "batch_id") if with_batch and c in df.columns))
