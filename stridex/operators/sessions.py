"""Consecutive differences, jumps and gap sessions.

A session of a key (user, activity) is a maximal run of samples whose neighbours differ by at most ``gap``
(a difference strictly over the gap starts a new session). Sessions are numbered 0, 1, ... per key in time order.

Plan shape. Without hot keys it is one window per key over one exchange of the samples. A hot key, one that holds more
samples than a task should scan, must be cut in time, so ``method="auto"``, the default,

1. finds the hot keys with a heavy-hitter sketch, one pass over the key columns without a shuffle (``hot_keys``);
2. if there are any, takes quantiles of their times (``quantile_cuts``) as the edges of their chunks: chunks hold about as
   many samples each, also where a burst holds most of a key's samples. Every other key is one chunk.

Chunks are scanned in levels: a window per (key, chunk) gives the local predecessor, the local jump flags and their running
count; one summary row per (key, chunk) (min, max, local jumps, last local session start) is scanned the same way, a window
per (key, ``FAN`` chunks) closing the gaps at the chunk edges and a window per key over those; the carry is added back.

The levels work with any ordered cut of a key's timeline. ``method="chunk"`` (or a ``chunk`` width) cuts every key at
multiples of a width, by default taken from the time span and row count. ``method="range"`` collapses exact copies of a
sample into one weighted row, range-partitions the distinct (key, timestamp) rows with sampled bounds and writes them once
to the shared folder; the partition id is the chunk. It needs no sketch and cuts every key, at two more shuffles.

Sessions of a table with hot keys are formed from distinct instants and their multiplicities, so a third of all rows at one
instant is no hot window either. Labels of single samples (differences, jumps, tiles) need the rows themselves: there the
copies of one instant of one key stay together.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import floor_div
from ..schema import DEFAULT_GAP, DEFAULT_WIDTH, KEYS

MIN_CHUNKS = 256
CHUNK_ROWS = 100_000
FAN = 256
HOT_SHARE, HOT_LEAST, HOT_ROWS = 256, 256, 1_000_000       # hot: over 1/256 of all rows (but 256 at least) or 1 M rows
HOT_KEYS, TRACKED = 8_192, 65_536                           # keys that are cut at most; items of the sketch
CUT_STEPS = 12                                              # a key has less than 2**12 cuts


def default_chunk(df: DataFrame) -> int:
    """Chunk width for the data: one pass over the timestamps (a single column, partial aggregates)."""
    r = df.agg(F.min("timestamp"), F.max("timestamp"), F.count("timestamp")).first()
    if not r[2]:
        return 1
    return (r[1] - r[0]) // (MIN_CHUNKS + r[2] // CHUNK_ROWS) + 1


def hot_limit(n: int) -> int:
    """Samples of one key from which a table of ``n`` cuts the key."""
    return max(HOT_LEAST, min(HOT_ROWS, n // HOT_SHARE))


def hot_keys(df: DataFrame, keys: list[str]) -> tuple[int, dict[int, int]]:
    """Samples that count as hot, and the hot keys: hash -> about its samples. One aggregate over a sketch of ``TRACKED``
    items: a key over the limit by more than the sketch's error (rows / ``TRACKED``, about) is found. Of more than
    ``HOT_KEYS`` such keys the largest are cut, so what stays whole has at most a ``HOT_KEYS``-th of the rows."""
    r = df.select(F.xxhash64(*keys).alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {HOT_KEYS}, {TRACKED})").alias("top")).first()
    limit = hot_limit(r["n"])
    return limit, {x["item"]: x["count"] for x in r["top"] or () if x["item"] is not None and x["count"] > limit}


def quantile_cuts(df: DataFrame, keys: list[str], limit: int, hot: dict[int, int]) -> DataFrame:
    """(_h, _cuts): ascending times that cut each hot key into chunks of about ``limit`` samples; in all at most the table's
    rows / ``limit`` plus one a key."""
    h = F.xxhash64(*keys)
    wanted = {k: min((1 << CUT_STEPS) - 1, -(-c // limit)) for k, c in hot.items()}
    rows = []
    for low, p in ((1, 8), (8, 64), (64, 512), (512, (1 << CUT_STEPS) - 1)):        # keys of like size together
        tier = [k for k, w in wanted.items() if low < w + (low == 1) and w <= p]
        if not tier:
            continue
        q = F.percentile_approx("timestamp", [i / (p + 1) for i in range(1, p + 1)], 10 * (p + 1))
        for r in df.where(h.isin(tier)).groupBy(h.alias("h")).agg(q.alias("q")).collect():
            rows.append((r["h"], sorted(set(r["q"][::max(1, p // wanted[r["h"]])]))))
    return df.sparkSession.createDataFrame(rows, "_h long, _cuts array<long>")


def _chunked(df: DataFrame, keys: list[str], cuts: DataFrame) -> DataFrame:
    """``df`` with ``_chunk``: the number of its key's cuts below its time, found by halving; 0 without cuts."""
    steps = ", ".join(str(1 << k) for k in reversed(range(CUT_STEPS)))
    below = (f"aggregate(array({steps}), 0, (p, s) -> IF(p + s <= size(_cuts) AND element_at(_cuts, least(p + s, size(_cuts))) "
             f"< timestamp, p + s, p))")
    d = df.select("*", F.xxhash64(*keys).alias("_h")).join(F.broadcast(cuts), "_h", "left")
    return d.select(*df.columns, F.expr(f"cast(IF(_cuts IS NULL, 0, {below}) AS long)").alias("_chunk"))


def _whole(df: DataFrame, gap: int, keys: list[str]) -> DataFrame:
    """The scan with one window per key."""
    t, w = F.col("timestamp"), Window.partitionBy(*keys).orderBy("timestamp")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    d = df.select("*", F.lag("timestamp").over(w).alias("prev_timestamp"))
    d = d.select("*", (t - F.col("prev_timestamp")).alias("diff"))
    d = d.select("*", F.coalesce(F.col("diff") > F.lit(int(gap)), F.lit(False)).alias("jump"))
    opens = F.col("jump") | F.col("prev_timestamp").isNull()
    return d.select("*", F.sum(F.col("jump").cast("int")).over(upto).cast("long").alias("session_id"),
                    F.max(F.when(opens, t)).over(upto).alias("session_start"))


def _edges(cs: DataFrame, part: list[str], order: str, gap: int, top: bool) -> DataFrame:
    """Summary rows (``_cmin, _cmax, _cj`` jumps inside, ``_clast`` last session start inside) of one ``part`` in
    ``order``, with what precedes each row inside the part: ``_prev`` (the part's last instant before it), ``_base`` (jumps
    before its first instant), ``_start0`` (start of the session its first instant belongs to; null: before the part),
    ``_edge`` and ``_last`` (as ``_clast``, edge included). ``top``: nothing precedes the part."""
    w = Window.partitionBy(*part).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    cs = cs.select("*", F.lag("_cmax").over(w).alias("_prev"))
    jump = F.coalesce((F.col("_cmin") - F.col("_prev")) > F.lit(int(gap)), F.lit(False))
    opens = jump | F.col("_prev").isNull() if top else jump
    cs = cs.select("*", jump.cast("int").alias("_edge"), F.when(opens, F.col("_cmin")).alias("_open"))
    cs = cs.select("*", F.coalesce("_clast", "_open").alias("_last"))
    return cs.select("*", (F.coalesce(F.sum(F.col("_cj") + F.col("_edge")).over(before), F.lit(0)) + F.col("_edge"))
                     .alias("_base"), F.coalesce("_open", F.last("_last", ignorenulls=True).over(before)).alias("_start0"))


def _carried(cs: DataFrame, gap: int, keys: list[str]) -> DataFrame:
    """``keys, _chunk, _prev_cmax, _base, _start0`` of every chunk summary: the scan over chunks, in two levels."""
    cs = cs.select("*", floor_div("_chunk", FAN).alias("_far"))
    near = _edges(cs, [*keys, "_far"], "_chunk", gap, top=False)
    far = near.groupBy(*keys, "_far").agg(F.min("_cmin").alias("_cmin"), F.max("_cmax").alias("_cmax"),
                                          F.sum(F.col("_cj") + F.col("_edge")).alias("_cj"),
                                          F.max("_last").alias("_clast"))     # session starts grow with time
    far = _edges(far, keys, "_far", gap, top=True).select(
        *keys, "_far", F.col("_prev").alias("_fprev"), F.col("_base").alias("_fbase"), F.col("_start0").alias("_fstart"),
        F.col("_edge").alias("_fedge"))
    j = near.join(far, [*keys, "_far"])
    return j.select(*keys, "_chunk", F.coalesce("_prev", "_fprev").alias("_prev_cmax"),
                    (F.col("_base") + F.col("_fbase")).alias("_base"), F.coalesce("_start0", "_fstart").alias("_start0"))


def _scan(r: DataFrame, gap: int, keys: list[str]) -> DataFrame:
    """The scan over rows that carry an ordered ``_chunk`` (rows of one key and chunk never interleave
    in time with another chunk of that key)."""
    gap_l = F.lit(int(gap))
    t = F.col("timestamp")
    wl = Window.partitionBy(*keys, "_chunk").orderBy("timestamp")
    upto = wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # level 1: inside a chunk. The null filters are the ones the join below would infer for this side only;
    # stated here, both uses of ``r`` keep identical plans and share one exchange of the samples.
    not_null = F.col("_chunk").isNotNull() & floor_div("_chunk", FAN).isNotNull()
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    r = r.where(not_null)
    r = r.select("*", F.lag("timestamp").over(wl).alias("_prev_local"))
    jl = F.coalesce(((t - F.col("_prev_local")) > gap_l).cast("int"), F.lit(0))
    r = r.select("*", jl.alias("_jl"), F.sum(jl).over(upto).alias("_run"),
                 F.max(F.when(jl == 1, t)).over(upto).alias("_start_local"))
    # level 2: one row per chunk, scanned in turn
    cs = r.groupBy(*keys, "_chunk").agg(
        F.min("timestamp").alias("_cmin"), F.max("timestamp").alias("_cmax"),
        F.sum("_jl").alias("_cj"), F.max(F.when(F.col("_jl") == 1, t)).alias("_clast"))
    cs = _carried(cs, gap, keys)
    # back to the rows: (key, chunk) is the rows' partitioning already, only the chunk table moves
    out = r.join(cs, [*keys, "_chunk"])
    prev = F.coalesce(F.col("_prev_local"), F.col("_prev_cmax"))
    drop = {"_chunk", "_prev_local", "_jl", "_run", "_start_local", "_prev_cmax", "_base", "_start0"}
    return out.select(
        *[c for c in out.columns if c not in drop],
        prev.alias("prev_timestamp"), (t - prev).alias("diff"),
        F.coalesce((t - prev) > gap_l, F.lit(False)).alias("jump"),
        (F.col("_base") + F.col("_run")).cast("long").alias("session_id"),
        F.coalesce(F.col("_start_local"), F.col("_start0")).alias("session_start"))


def _distinct_instants(df: DataFrame, keys: list[str], partitions: int | None) -> DataFrame:
    """One row per (key, timestamp) with its multiplicity ``_c``, range-partitioned on (key, timestamp); the
    partition id is the chunk.

    The partition id depends on sampled range bounds, and the scan uses these rows twice; Spark does not share an
    exchange under a non-deterministic expression, so each use could sample different bounds. The rows are
    therefore written once to the shared folder (eagerly, when this is called) and read back: from then on the
    chunk is data, identical for every use and after any executor loss.
    """
    from ..sources.tables import materialize

    d = df.groupBy(*keys, "timestamp").agg(F.count(F.lit(1)).alias("_c"))
    n = int(partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = d.repartitionByRange(n, *keys, "timestamp").select(
        "*", F.spark_partition_id().cast("long").alias("_chunk"))
    return materialize(ranged, "session-instants")


def label_sessions(df: DataFrame, gap: int = DEFAULT_GAP, keys: list[str] = KEYS, chunk: int | None = None,
                   method: str = "auto", partitions: int | None = None) -> DataFrame:
    """Every sample with ``prev_timestamp``, ``diff`` (W1), ``jump`` (W2), ``session_id`` and ``session_start``.

    ``method="range"``: copies of one instant share its labels (their ``diff`` is to the previous distinct
    instant); session ids and starts are the same as with time chunks.
    """
    if method == "auto" and chunk is None:
        limit, hot = hot_keys(df, keys)
        return _scan(_chunked(df, keys, quantile_cuts(df, keys, limit, hot)), gap, keys) if hot else _whole(df, gap, keys)
    if method in ("auto", "chunk"):
        chunk = int(chunk or default_chunk(df))
        return _scan(df.select("*", floor_div("timestamp", chunk).alias("_chunk")), gap, keys)
    if method != "range":
        raise ValueError(f"method must be 'auto', 'chunk' or 'range', not {method!r}")
    lab = _scan(_distinct_instants(df.select(*keys, "timestamp"), keys, partitions), gap, keys).drop("_c")
    # back to every sample, on a derived key so that a hot instant (many copies) can be split by AQE
    dk = F.xxhash64(*keys, "timestamp")
    rows = df.select("*", dk.alias("_dk"))
    return rows.join(lab.select("*", dk.alias("_dk")), ["_dk", *keys, "timestamp"]).drop("_dk")


def time_diffs(df: DataFrame, keys: list[str] = KEYS, chunk: int | None = None, gap: int = DEFAULT_GAP) -> DataFrame:
    """``diff = t - previous t`` of the same key (NULL for a key's first sample)."""
    s = label_sessions(df.select(*keys, "timestamp"), gap=gap, keys=keys, chunk=chunk)
    return s.select(*keys, "timestamp", "prev_timestamp", "diff")


def time_jumps(df: DataFrame, gap: int = DEFAULT_GAP, keys: list[str] = KEYS, chunk: int | None = None) -> DataFrame:
    """Neighbouring pairs whose difference is strictly over ``gap``."""
    s = label_sessions(df.select(*keys, "timestamp"), gap=gap, keys=keys, chunk=chunk)
    return s.where("jump").select(*keys, "prev_timestamp", "timestamp", "diff")


def sessions_from_labelled(labelled: DataFrame, width: int = DEFAULT_WIDTH, keys: list[str] = KEYS,
                           weight: str | None = None) -> DataFrame:
    """W3/W4 from labelled samples: bounds, sample count and ``intervals = (stop - start) div width``."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    s = labelled.groupBy(*keys, "session_id").agg(
        F.min("timestamp").alias("session_start"), F.max("timestamp").alias("session_stop"),
        n.cast("long").alias("n_samples"))
    return s.select("*", F.expr(f"(session_stop - session_start) div {int(width)}").alias("intervals"))


def _sessions_from_segments(r: DataFrame, gap: int, width: int, keys: list[str], weight: str | None) -> DataFrame:
    """Sessions without labelling every sample: each chunk's maximal runs (segments) are aggregated in place (no
    exchange: the samples are already partitioned by key and chunk), and the chunk table is joined to the segments
    instead of to every sample -- a dense sensor stream has far fewer segments than samples. (Both the chunk table
    and the join read the one shared exchange of the samples; Spark re-runs the level-1 window for each.)"""
    gap_l = F.lit(int(gap))
    t = F.col("timestamp")
    wl = Window.partitionBy(*keys, "_chunk").orderBy("timestamp")
    not_null = F.col("_chunk").isNotNull() & floor_div("_chunk", FAN).isNotNull()
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    r = r.where(not_null).select("*", F.lag("timestamp").over(wl).alias("_prev_local"))
    jl = F.coalesce(((t - F.col("_prev_local")) > gap_l).cast("int"), F.lit(0))
    r = r.select(*keys, "_chunk", "timestamp", *([weight] if weight else []),
                 F.sum(jl).over(wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_run"))
    seg = r.groupBy(*keys, "_chunk", "_run").agg(
        F.min("timestamp").alias("_smin"), F.max("timestamp").alias("_smax"),
        (F.sum(weight) if weight else F.count(F.lit(1))).cast("long").alias("_sn"))
    cs = seg.groupBy(*keys, "_chunk").agg(F.min("_smin").alias("_cmin"), F.max("_smax").alias("_cmax"),
                                          F.max("_run").alias("_cj"), F.lit(None).cast("long").alias("_clast"))
    cs = _carried(cs, gap, keys).select(*keys, "_chunk", "_base")
    out = seg.join(cs, [*keys, "_chunk"]).groupBy(*keys, (F.col("_base") + F.col("_run")).alias("session_id")).agg(
        F.min("_smin").alias("session_start"), F.max("_smax").alias("session_stop"),
        F.sum("_sn").cast("long").alias("n_samples"))
    return out.select(*keys, F.col("session_id").cast("long").alias("session_id"), "session_start", "session_stop",
                      "n_samples", F.expr(f"(session_stop - session_start) div {int(width)}").alias("intervals"))


def gap_sessions(df: DataFrame, gap: int = DEFAULT_GAP, width: int = DEFAULT_WIDTH, keys: list[str] = KEYS,
                 chunk: int | None = None, method: str = "auto", partitions: int | None = None) -> DataFrame:
    """Sessions of every key in one job, schema ``SESSION``."""
    if method == "auto" and chunk is None:
        limit, hot = hot_keys(df, keys)
        if not hot:
            return sessions_from_labelled(_whole(df.select(*keys, "timestamp"), gap, keys), width, keys)
        instants = df.groupBy(*keys, "timestamp").agg(F.count(F.lit(1)).alias("_c"))
        r = _chunked(instants, keys, quantile_cuts(df, keys, limit, hot))
        return _sessions_from_segments(r, gap, width, keys, weight="_c")
    if method == "range":   # sessions need only the distinct instants and their multiplicities
        r = _distinct_instants(df.select(*keys, "timestamp"), keys, partitions)
        return _sessions_from_segments(r, gap, width, keys, weight="_c")
    if method not in ("auto", "chunk"):
        raise ValueError(f"method must be 'auto', 'chunk' or 'range', not {method!r}")
    chunk = int(chunk or default_chunk(df))
    r = df.select(*keys, "timestamp", floor_div("timestamp", chunk).alias("_chunk"))
    return _sessions_from_segments(r, gap, width, keys, weight=None)
