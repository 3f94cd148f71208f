"""Clustered sample tables (P2-P4, T1, ST1): stored so that a user's samples, or a stretch of them, are found without a scan.

Rows lie in ``user_bucket`` folders by user hash, inside in files and row groups sorted by (user, time), with Parquet Bloom
filters on the user. A query for users prunes folders by their buckets, row groups and pages by the user's minimum and
maximum (and by Bloom filter for few names), and a time range the pages of that user. A hot user is not one file: the
range exchange deals (bucket, user, time) in even parts. Appends are published atomically (``commits``): each is a part of
its own, and a reader sees all published parts or none of a failed one.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .commits import CommitLog

BUCKETS = 32
STORED = "user_buckets"       # key of the number of buckets in the metadata of ``user_id``
NAMED_USERS = 1_000           # up to so many users of a frame become a predicate of names


def user_bucket(user: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(buckets)).cast("int")


def bucketed(samples: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Samples with ``user_bucket``. The number of buckets goes with the table, in the metadata of ``user_id``."""
    samples = samples.withMetadata("user_id", {**samples.schema["user_id"].metadata, STORED: buckets})
    return samples.withColumn("user_bucket", user_bucket(F.col("user_id"), buckets))


def buckets_of(table: DataFrame) -> int | None:
    return table.schema["user_id"].metadata.get(STORED) if "user_bucket" in table.columns else None


def write_clustered(samples: DataFrame, path: str, part: str, buckets: int = BUCKETS, partitions: int | None = None,
                    distinct_users: int = 100_000, **options) -> None:
    """Publish ``samples`` as part ``part`` of the table (once: a part that is there stays). ``distinct_users`` sizes the
    Bloom filter of a row group; ``options`` go to the Parquet writer."""
    spark = samples.sparkSession
    n = int(partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["user_bucket", "user_id", "timestamp"]

    def write(folder: str) -> dict:
        d = bucketed(samples, buckets).repartitionByRange(n, *order).sortWithinPartitions(*order)
        d.write.partitionBy("user_bucket").options(**{
            "parquet.bloom.filter.enabled#user_id": "true", "parquet.bloom.filter.expected.ndv#user_id": str(distinct_users),
            **options}).parquet(folder)
        return {"buckets": buckets}
    CommitLog(spark, path).publish(f"part={part}", write)


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    """All published parts, with ``user_bucket``. The parts must have one number of buckets."""
    log = CommitLog(spark, path)
    parts = log.entries()
    if len({e.facts["buckets"] for e in parts}) != 1:
        raise ValueError(f"{path}: parts with {sorted({e.facts['buckets'] for e in parts})} buckets")
    df = spark.read.option("basePath", f"{log.path}/data").parquet(*[e.folder for e in parts]).drop("attempt")
    return df.withMetadata("user_id", {STORED: parts[0].facts["buckets"]})


def of_user(user: str, table: DataFrame) -> Column:
    """The predicate of a user; on a clustered table it names the user's bucket too."""
    named, n = F.col("user_id") == F.lit(user), buckets_of(table)
    return named if n is None else named & (F.col("user_bucket") == user_bucket(F.lit(user), n))


def of_users(table: DataFrame, users: DataFrame, buckets: int | None = None) -> DataFrame:
    """``table`` cut down, on its folders and row groups, to a superset of the users' rows: by buckets if their number is
    stored with the table or given, and by names if there are at most ``NAMED_USERS``."""
    n = buckets_of(table) or (buckets if "user_bucket" in table.columns else None)
    if n is None:
        return table
    few = [r[0] for r in users.select("user_id").distinct().limit(NAMED_USERS + 1).collect()]
    if len(few) <= NAMED_USERS:
        table = table.where(F.col("user_id").isin(few))
        users = users.sparkSession.createDataFrame([(u,) for u in few], "user_id string")
    held = [r[0] for r in users.select(user_bucket(F.col("user_id"), n).alias("b")).distinct().collect()]    # at most ``n``
    return table.where(F.col("user_bucket").isin(held))
