"""Helpers shared by the training-data operators."""
from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Java pattern of the words of contracts that split on ASCII blanks only.
BLANK_WORD = r"([^\x20\x09-\x0D]+)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship_by_value(module: str) -> None:
    """Workers get this module's functions with the task, so the package need not be installed on them."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship_by_value(__name__)


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker. (Globals of a module shipped by value last for one task.)"""
    return sys.__dict__.setdefault("_stridex_cache", {})


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def remainder(col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; -1 for a null id (never held out, never learned from)."""
    return F.coalesce(F.crc32(col.cast("string")) % n, F.lit(-1))


def lower_ascii(col: Column) -> Column:
    return F.translate(col, _UPPER, _LOWER)


def sub_batches(texts, limit: int = 1_000_000):
    """Index ranges (i, j) of consecutive texts whose lengths add up to about ``limit`` (one long text stands alone)."""
    i = total = 0
    for j, t in enumerate(texts):
        n = len(t)
        if total and total + n > limit:
            yield i, j
            i, total = j, 0
        total += n + 1
    if i < len(texts):
        yield i, len(texts)
