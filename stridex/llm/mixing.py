"""Mixing sources to target weights by entropy balancing: DataFrame and SQL functions only.

Every document has base weight 1 and a size in words; the weights of a source must make its words add up to the
source's target. The solution nearest to the base weights in relative entropy, with at most ``CAP`` copies of a
document, is the exponential tilt ``min(CAP, exp(lambda * size / mean size))``. Its lambda is the root of the dual's
gradient: each Newton iteration is one join and one aggregate of the (source, size) counts for all sources together,
kept inside a shrinking bracket (the gradient is monotone), with the state written between iterations.

Rates become copies by carrying the rounding error from the largest size to the smallest: the copies given to all
documents of one (source, size) are their summed rates rounded up or down, whichever brings the words taken so far
nearer to the words wanted so far. Which documents of
a size get one copy more goes by the order of their id hash; that rank is taken in ``SALTS`` slices, so a size that a
third of all rows share is no hot key.

Defined results: null or empty text has size 0 and is taken 0 times; a null source is a source of its own, after all
others; an empty table gives an empty result; equal ids and repeated rows share a hash and stand next to each other;
further columns are ignored. Reruns agree, as the order depends on ids only.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import discard, materialize
from ._common import read

WEIGHTS = (5, 2, 1)
CAP = 3
SALTS = 256
MAX_ITERATIONS = 80
TOLERANCE = 1e-9
CHUNK = 256                  # entries that are gathered before they are appended
_ENTRIES = "array<struct<size:bigint,n:bigint,rate:double,m:bigint>>"


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources in code point order, null last, with their 0-based rank; no window over all of them."""
    spark = sources.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").asc_nulls_last()]
    s = sources.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("mid"))
    s = materialize(s.select("*", F.expr("mid - (cast(pid AS long) << 33)").alias("at")), "mix-sources")
    per = s.groupBy("pid").agg(F.count(F.lit(1)).alias("c"))       # one row per partition
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("pid", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("first"))
    return s.join(per, "pid").select("k", "source", "source_size", "n_docs", (F.col("first") + F.col("at")).alias("rank"))


def targets(sources: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(k, source, source_size, target): all words shared out by weight, no source above ``cap`` times its size."""
    w = F.expr("element_at(array(" + ", ".join(str(x) for x in weights) + f"), cast(rank % {len(weights)} AS int) + 1)")
    s = _numbered(sources).select("*", w.cast("long").alias("w"))
    s = materialize(s, "mix-weights")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    share, seen = 0.0, None
    while True:                       # ends: the set of capped sources only grows
        full = F.col("source_size") * cap <= F.col("w") * F.lit(share)
        r = s.agg(F.sum(F.when(full, F.col("source_size")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("w"))),
                  F.count(F.when(full, 1))).first()
        if seen is not None and r[2] == seen or not r[1]:
            break
        seen, share = r[2], (total - cap * r[0]) / r[1]
    t = F.least(F.col("source_size") * F.lit(float(cap)), F.col("w") * F.lit(float(share)))
    return s.select("k", "source", "source_size", "n_docs", "w", t.alias("target"))


def _rate(lam, z):
    return F.least(F.lit(float(CAP)), F.exp(F.least(F.lit(60.0), lam * z)))


def solve(counts: DataFrame, goal: DataFrame) -> DataFrame:
    """(k, lam) of every source with words: Newton on the dual, all sources in each iteration.

    ``counts``: (k, size, n); ``goal``: (k, target, mean). A step that leaves the bracket is replaced by its middle."""
    import math
    top = math.log(CAP)
    # at hi every document is at the cap; at lo the rates have vanished
    state = goal.select("k", "target", "mean", F.least(F.lit(top), F.log(F.col("target") / F.col("source_size"))).alias("lam"),
                        (-700.0 * F.col("mean")).alias("lo"), (F.lit(top) * F.col("mean")).alias("hi"),
                        F.lit(False).alias("done"))
    state = materialize(state, "mix-state")
    for _ in range(MAX_ITERATIONS):
        z = F.col("size") / F.col("mean")
        rate = _rate(F.col("lam"), z)
        words = F.col("n") * F.col("size") * rate
        g = (counts.join(state.where("not done").select("k", "lam", "mean"), "k").groupBy("k").agg(
            F.sum(words).alias("f"), F.sum(F.when(rate < CAP, words * z).otherwise(0.0)).alias("slope")))
        s = state.join(g, "k", "left")
        gap = F.col("f") - F.col("target")
        lo, hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo")), F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        near = F.abs(gap) <= F.col("target") * TOLERANCE
        s = s.select("*", lo.alias("lo1"), hi.alias("hi1"), near.alias("near"),
                     F.try_divide(gap, F.col("slope")).alias("step"))
        new = F.col("lam") - F.col("step")
        inside = F.col("step").isNotNull() & (new > F.col("lo1")) & (new < F.col("hi1"))
        moved = F.when(inside, new).otherwise((F.col("lo1") + F.col("hi1")) / 2)
        still = F.col("done") | F.col("near") | (F.col("hi1") - F.col("lo1") <= 1e-12 * (1 + F.abs(F.col("lam"))))
        before, state = state, materialize(s.select(
            "k", "target", "mean", F.when(still, F.col("lam")).otherwise(moved).alias("lam"), F.coalesce("lo1", "lo").alias("lo"),
            F.coalesce("hi1", "hi").alias("hi"), still.alias("done")), "mix-state")
        discard(before)
        if state.where("not done").isEmpty():
            break
    return state.select("k", "lam", "mean")


def copies(docs: DataFrame, size: str = "size", source: str = "source", key: str = "doc_id",
           order: Column | None = None) -> DataFrame:
    """(key, size, source_size, target, rate, copies) for rows that carry a word count and a source. ``order``: a hash
    that ranks the rows of one size (by default that of the key)."""
    d = docs.select(F.col(key).alias("id"), F.col(source).alias("source"), F.col(size).cast("long").alias("size"),
                    (F.xxhash64(key, F.lit("mix")) if order is None else order).alias("h"))
    d = d.select("*", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("k"))
    d = materialize(d.select("*", F.pmod("h", F.lit(SALTS)).alias("salt")), "mix-documents")
    counts = materialize(d.groupBy("k", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    sources = counts.groupBy("k", "source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"),
                                                F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("n_docs"))
    goal = materialize(targets(sources), "mix-targets")
    worded = counts.where("size > 0").select("k", "size", "n")
    tilt = solve(worded, goal.where("source_size > 0").select(
        "k", "target", "source_size", (F.col("source_size") / F.col("n_docs")).alias("mean")))
    rates = worded.join(tilt, "k").select("k", "size", "n", _rate(F.col("lam"), F.col("size") / F.col("mean")).alias("rate"))
    # (size, n, rate) of a source, largest first: as many entries as it has different sizes, so no more than its longest text
    # has words, whatever the number of rows. Results gather in chunks, which are appended whole: linear in the entries.
    per = rates.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("size", "n", "rate")), asc=False).alias("hist"))
    per = per.select("k", F.expr(f"""aggregate(hist, named_struct('want', 0D, 'got', 0L, 'out',
            cast(array() AS {_ENTRIES}), 'done', cast(array() AS array<{_ENTRIES}>)), (a, x) ->
          transform(array(least(cast(ceil(x.n * x.rate) AS bigint), greatest(cast(floor(x.n * x.rate) AS bigint),
              cast(round((a.want + x.n * x.size * x.rate - a.got) / x.size) AS bigint)))), m -> named_struct('want', a.want + x.n * x.size * x.rate, 'got', a.got + m * x.size,
              'out', concat(IF(size(a.out) < {CHUNK}, a.out, cast(array() AS {_ENTRIES})),
                            array(named_struct('size', x.size, 'n', x.n, 'rate', x.rate, 'm', m))),
              'done', IF(size(a.out) < {CHUNK}, a.done, concat(a.done, array(a.out)))))[0],
          a -> concat(flatten(a.done), a.out))""").alias("out")).select("k", F.explode("out").alias("o")).select(
        "k", "o.size", "o.rate", F.expr("o.m div o.n").alias("base"), F.expr("o.m % o.n").alias("extra"))
    # rank of a document among those of its source and size, slice by slice
    slices = d.groupBy("k", "size", "salt").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("k", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("k", "size", "salt", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("first"))
    slices = slices.join(per, ["k", "size"], "left").join(goal.select("k", "source_size", "target"), "k")
    own = Window.partitionBy("k", "size", "salt").orderBy("h", "id")
    r = d.select("id", "k", "size", "salt", F.row_number().over(own).alias("r")).join(slices, ["k", "size", "salt"])
    n = F.coalesce(F.col("base") + (F.col("first") + F.col("r") <= F.col("extra")).cast("long"), F.lit(0))
    return r.select(F.col("id").alias(key), "size", "source_size", "target", F.coalesce("rate", F.lit(1.0)).alias("rate"),
                    n.cast("long").alias("copies"))


def words(text: Column) -> Column:
    """Number of words of a text column; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes every document, in words."""
    docs = read(spark, sf_dir, "documents")
    c = copies(docs.select("doc_id", "source", words(F.col("text")).alias("size")))
    return c.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                    "copies", "rate")
