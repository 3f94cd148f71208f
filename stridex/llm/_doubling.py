"""Repeated strings by distributed prefix doubling over byte positions.

The rank of a position at offset ``h`` names its next ``h`` bytes: positions share a rank where those bytes are equal. Ranks of
``2 h`` come from the pairs (rank of i, rank of i + h): Spark groups the pairs, gives every pair that occurs more than once a
new rank and drops the others, as their strings are unique. From ``length / 8`` three doublings reach the length; whatever
has a rank then starts a repeated string.

Only positions that can matter are ranked. Equal texts are one text, whose copies repeat as a whole if they are long enough.
Of each text, windows count whose anchor (``_repeats``: the lowest hash of a seed inside the window, so equal windows have equal
anchors) has a seed that occurs twice; a window's start and the offsets that its doublings look up are the positions.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import discard, materialize
from ._common import ship_by_value
from ._hashing import Hashes
from ._repeats import Spec, _find_runs, pack, unpack

ship_by_value(__name__)

SLICE = 1 << 18               # positions hashed at a time
_NAMES = pa.schema([("tid", pa.int64()), ("pos", pa.int64()), ("x", pa.int64()), ("y", pa.int64())])


def _names(h: int, reach: int):
    """Texts with the window starts to rank ((first << 32 | last) spans) -> (tid, pos, name of the next ``h`` bytes) of the
    starts and the offsets up to ``reach`` behind them."""
    def run(batches):
        for b in batches:
            for tid, z, spans in zip(b.column("tid").to_pylist(), b.column("z").to_pylist(), b.column("spans").to_pylist()):
                raw = np.frombuffer(unpack(z), np.uint8)
                s = np.sort(np.array(spans, np.int64))
                lo, hi = s >> 32, (s & 0xFFFFFFFF) + reach + 1
                top = np.maximum.accumulate(hi)
                new = np.append(True, lo[1:] > top[:-1])
                lo, hi = lo[new], top[np.append(np.flatnonzero(new)[1:] - 1, len(top) - 1)]
                for a, e in zip(lo.tolist(), hi.tolist()):
                    for at in range(a, e, SLICE):
                        to = min(e, at + SLICE)
                        part = Hashes(raw[at:to + h - 1])
                        x = part.every(h)[:to - at]
                        other = Hashes(raw[at:to + h - 1][::-1])           # a second name: the bytes backwards
                        y = other.every(h)[::-1][:to - at]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(x), tid)), pa.array(np.arange(at, at + len(x))), pa.array(x.view(np.int64)),
                             pa.array(y.view(np.int64))], schema=_NAMES)
    return run


def _ranked(pairs: DataFrame, name: str) -> DataFrame:
    """(tid, pos, rank) of the positions whose pair (x, y) occurs more than once."""
    classes = pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    classes = materialize(classes.select("x", "y", F.monotonically_increasing_id().alias("rank")), f"{name}-classes")
    out = materialize(pairs.join(classes, ["x", "y"]).select("tid", "pos", "rank"), f"{name}-ranks")
    discard(classes)
    return out


def _islands(length: int):
    """Sorted (tid, pos) -> (tid, span) of the runs that windows at the positions cover."""
    def run(batches):
        at = None                                            # (tid, first, last position)
        for b in batches:
            out = []
            for tid, pos in zip(b.column("tid").to_pylist(), b.column("pos").to_pylist()):
                if at is not None and at[0] == tid and pos <= at[2] + length:
                    at = (tid, at[1], pos)
                else:
                    if at is not None:
                        out.append((at[0], at[1] << 32 | at[2] + length))
                    at = (tid, pos, pos)
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in out], pa.int64()), pa.array([s for _, s in out], pa.int64())],
                                             names=["tid", "span"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int64()), pa.array([at[1] << 32 | at[2] + length], pa.int64())],
                                             names=["tid", "span"])
    return run


def repeated(docs: DataFrame, length: int, seed: int, name: str) -> DataFrame:
    """(ok, th, spans) as ``_repeats.repeated`` has them, for strings of ``length`` bytes that start anywhere else too."""
    spark = docs.sparkSession
    steps = 3 if length % 8 == 0 else 2 if length % 4 == 0 else 1 if length % 2 == 0 else 0
    src = docs.where(F.octet_length("text") >= length).select("ok", "th", "text", F.md5(F.col("text").cast("binary")).alias("m"))
    same = src.groupBy("m").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("ok", "th")).alias("rep"))
    same = materialize(same.select(F.monotonically_increasing_id().alias("tid"), "*"), f"{name}-texts")
    one = src.join(same.select("tid", "m", "rep"), "m").where("ok = rep.ok and th = rep.th").select(
        "tid", pack(F.col("text")).alias("z"), "text").dropDuplicates(["tid"])
    one = materialize(one, f"{name}-distinct")
    spec = Spec(length, seed, False, (1,), False)
    runs = one.select(F.col("tid").alias("ok"), F.lit(0).cast("long").alias("th"), "text").mapInArrow(
        _find_runs(spec), "ok long, th long, a int, rlo int, rhi int, seed long, whole long").select(
        F.col("ok").alias("tid"), "a", "rlo", "rhi", "seed")
    twice = materialize(runs.groupBy("seed").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("seed"), f"{name}-seeds")
    spans = runs.join(twice, "seed").groupBy("tid").agg(F.collect_list(
        F.shiftleft((F.col("a") - F.col("rhi")).cast("long"), 32) + (F.col("a") - F.col("rlo"))).alias("spans"))
    h = length >> steps
    ranks = _ranked(one.select("tid", "z").join(spans, "tid").mapInArrow(
        _names(h, length - h), "tid long, pos long, x long, y long"), f"{name}-{h}")
    while h < length:
        ahead = ranks.select("tid", (F.col("pos") - h).alias("pos"), F.col("rank").alias("y"))
        before, ranks = ranks, _ranked(ranks.withColumnRenamed("rank", "x").join(ahead, ["tid", "pos"]), f"{name}-{2 * h}")
        discard(before)
        h *= 2
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = ranks.select("tid", "pos").repartition(n, "tid").sortWithinPartitions("tid", "pos").mapInArrow(
        _islands(length), "tid long, span long")
    found = materialize(found.groupBy("tid").agg(F.collect_list("span").alias("spans")), f"{name}-found")
    discard(one, twice, ranks)
    whole = F.array(F.octet_length("text").cast("long"))
    d = src.join(same.select("tid", "m", "copies"), "m").join(found, "tid", "left")
    return d.select("ok", "th", F.when(F.col("copies") > 1, whole).otherwise(F.col("spans")).alias("spans")).where(
        "spans is not null").dropDuplicates(["ok", "th"])
