"""Intermediate tables in the cluster's shared folder (lineage cuts that survive executor loss)."""
from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import scratch_path

# Shuffle files of a write are dead weight once the table exists: nothing refers to that plan again.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    The lineage is cut (a lost executor costs a re-read, not a re-run of the whole plan) and every later use reads
    the table instead of recomputing the plan. An eager ``checkpoint()`` would compute the plan twice (once to
    count, once to write) unless it were cached first; ``localCheckpoint`` would not survive executor loss. The
    write's shuffle files are removed when it ends, so a job of many steps needs the disk of its largest one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.format(fmt).save(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).format(fmt).load(path)
    out.__dict__["_stridex_path"] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the folders of materialized tables whose last reader has ended (that is, has itself been written)."""
    for t in tables:
        path = t.__dict__.pop("_stridex_path", None)
        if path:
            spark = t.sparkSession
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
