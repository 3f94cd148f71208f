"""Grouped prefix join: Jaccard near duplicates over word n-grams, as connected components, exactly.

Tokens (n-gram hashes) get one global order, rare before common: by the load of a token's slot in a table of counts over
all documents, then by hash. Two sets of Jaccard ``percent`` or more share a token among the first
``n - ceil(percent * n / 100) + 1`` of each (their prefixes).

* Collapse: documents with equal sets form a class; classes with identical prefixes and size form a group. Only groups
  enter the join, so copies in any number cost one row.
* Filter: groups meet on prefix tokens, with bounds on sizes and on the overlap still possible after the first common
  token. All pairs of a bucket are never emitted at once: first every group is paired with the bucket's most central
  group (the one whose token stands nearest to the front), which merges nearly everything; then only pairs whose
  groups are still in different components follow. No pair that could join two components is left out, so the
  components are those of the complete link graph.
* Expand and verify: pairs of groups are expanded to their classes and verified on the whole sets.

Intermediate results are tables in the shared folder; labels spread by minimum with pointer jumping. The broadcast table
of counts has a size chosen from the corpus and never more than ``MAX_SLOTS`` bytes; it only orders the tokens, any size
is correct.

Defined results: a text with fewer than ``n`` words, but at least one, is one token; null and wordless texts are empty
sets, linked with nothing; repeated rows have equal sets and one component; a component is named by its smallest id, null
ids count as largest; long texts are read whole; an empty table gives no rows; further columns are ignored.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import discard, materialize
from ._common import read, ship_by_value, sub_batches
from ._hashing import mix, words_of
from ._repeats import LAST, keyed, pack, unpack

ship_by_value(__name__)

SIZE, PERCENT = 3, 90
MIN_SLOTS, MAX_SLOTS = 1 << 16, 1 << 24
TOKENS_PER_SLOT = 512
BLOCK = 256                  # counters to a row
_FULL = np.uint32((1 << 32) - 1)
_BLANKS = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class Shingles:
    """Sets of distinct word n-grams, words between ASCII blanks, A-Z in lower case."""
    size: int = SIZE

    def sets(self, raws: list[bytes]):
        """The sorted distinct tokens (64-bit) of every text."""
        for i, j in sub_batches(raws):
            h, start, _ = words_of(np.frombuffer(b" ".join(raws[i:j]).translate(_LOWER), np.uint8), _BLANKS)
            cut = np.searchsorted(start, np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws[i:j]])]))
            s = h.copy()
            for k in range(1, self.size):                       # gram starting at each word of the batch
                s[:len(h) - k] = mix(s[:len(h) - k] * np.uint64(0x2545F4914F6CDD1D) + h[k:])
            for k in range(j - i):
                b, e = cut[k], cut[k + 1]
                if e - b >= self.size:
                    yield np.unique(s[b:e - self.size + 1])
                elif e > b:
                    t = np.array([e - b], np.uint64)
                    for x in h[b:e]:
                        t = mix(t * np.uint64(0x2545F4914F6CDD1D) + x)
                    yield t
                else:
                    yield np.zeros(0, np.uint64)


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + 1 if n else 0


def slot_counts(texts: DataFrame, kernel, slots: int) -> np.ndarray:
    """Logarithm of the tokens per slot over all texts, in a byte. A task keeps ``slots`` counters of 4 bytes and emits them
    in rows of ``BLOCK``; the rows of a block meet in one task, which adds them up as they come."""
    shift = np.uint64(64 - slots.bit_length() + 1)

    def rows(total: dict[int, np.ndarray]):
        at = sorted(total)
        for i in range(0, len(at), 4096):
            part = at[i:i + 4096]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([total[k].tobytes() for k in part],
                                                                                   pa.binary())], names=["block", "n"])

    def count(batches):
        total = np.zeros(slots, np.uint32)
        for b in batches:
            raws = [t.encode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()]
            for s in kernel.sets(raws):
                slot, n = np.unique((s >> shift).astype(np.int64), return_counts=True)
                total[slot] += np.minimum(n, _FULL - total[slot]).astype(np.uint32)
        yield from rows({k: x for k, x in enumerate(total.reshape(-1, BLOCK)) if x.any()})

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column("block").to_pylist(), b.column("n").to_pylist()):
                x = np.frombuffer(x, np.uint32)
                total[k] = np.maximum(total[k] + x, x) if k in total else x           # an overflow leaves the larger part
        yield from rows(total)
    kinds = "block long, n binary"
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    got = texts.mapInArrow(count, kinds).repartition(parts, "block").mapInArrow(add, kinds).collect()
    out = np.zeros((slots // BLOCK, BLOCK), np.uint8)
    for r in got:
        out[r["block"]] = np.rint(7 * np.log2(np.frombuffer(bytes(r["n"]), np.uint32) + 1.0))
    return out.reshape(-1)


def _prefixes(kernel, percent: int, shared, slots: int):
    shift = np.uint64(64 - slots.bit_length() + 1)
    salt = np.uint64(0xA24BAED4963EE407)

    def name(x: np.ndarray, n: int) -> bytes:
        """128 bits of a set, whatever its order."""
        return np.array([mix(mix(x).sum(keepdims=True) + np.uint64(n))[0],
                         mix(mix(x ^ salt).sum(keepdims=True) + np.uint64(n))[0]], np.uint64).tobytes()

    def run(batches):
        load = shared.value
        for b in batches:
            raws = ["" if t is None else t for t in b.column("text").to_pylist()]
            n, k, g, first = [], [], [], []
            for s in kernel.sets([t.encode("utf-8", "surrogatepass") for t in raws]):
                n.append(len(s))
                if not len(s):
                    k.append(None), g.append(None), first.append(None)
                    continue
                order = np.lexsort((s, load[(s >> shift).astype(np.int64)]))
                p = s[order[:prefix_length(len(s), percent)]]
                k.append(name(s, len(s)))
                g.append(name(p, len(s)))
                first.append(p.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("ok"), b.column("th"), pa.array(n, pa.int32()), pa.array(k, pa.binary()),
                 pa.array(g, pa.binary()), pa.array(first, pa.list_(pa.int64()))],
                names=["doc_id", "ok", "th", "n", "k", "g", "prefix"])
    return run


def _verified(kernel, percent: int):
    """Whether the sets of two packed texts reach the threshold. Pairs arrive sorted by the second text's class, so each
    set is built once for a run of pairs."""
    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[bytes, np.ndarray] = {}

        def set_of(z: bytes) -> np.ndarray:
            if z not in known:
                if len(known) > 200:
                    known.clear()
                known[z] = next(iter(kernel.sets([unpack(z)])))
            return known[z]
        out = np.zeros(len(a), bool)
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            x, y = set_of(x), set_of(y)
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = np.sort(np.concatenate([x, y]))
                same = int((both[1:] == both[:-1]).sum())
                out[i] = 100 * same >= percent * (len(x) + len(y) - same)
        return pd.Series(out)
    return linked


def labels(edges: DataFrame, name: str) -> DataFrame:
    """(k, comp): the least node of every node's component, for the nodes of ``edges`` (a, b)."""
    both = materialize(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), name)
    at = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).withColumnRenamed("a", "k")
    at = materialize(at, f"{name}-labels")
    while True:
        near = both.join(at, both["b"] == at["k"]).groupBy("a").agg(F.min("comp").alias("seen"))
        new = at.join(near, at["k"] == near["a"]).select("k", F.least("comp", "seen").alias("to"), F.col("comp").alias("old"))
        up = at.select(F.col("k").alias("up"), F.col("comp").alias("top"))
        new = new.join(up, F.col("to") == F.col("up")).select("k", F.least("to", "top").alias("comp"), "old")
        new = materialize(new, f"{name}-labels")
        discard(at)
        if new.where("comp <> old").isEmpty():
            discard(both)
            return new.select("k", "comp")
        at = new


def near_duplicates(docs: DataFrame, kernel=None, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text",
                    name: str = "ngram") -> DataFrame:
    """One row per input row: doc_id, ok, th, n (set size), head and head_th (ok and th of the component's first row)."""
    kernel = kernel or Shingles()
    spark = docs.sparkSession
    d = keyed(docs, doc_id, text)
    texts = d.where("text is not null").select("text")
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    slots = min(MAX_SLOTS, max(MIN_SLOTS, 1 << int(chars // 6 // TOKENS_PER_SLOT).bit_length()))
    shared = spark.sparkContext.broadcast(slot_counts(texts, kernel, slots))
    rows = materialize(d.select("doc_id", "ok", "th", "text").mapInArrow(
        _prefixes(kernel, percent, shared, slots), "doc_id long, ok long, th long, n int, k binary, g binary, "
                                                   "prefix array<long>"), f"{name}-prefixes")
    shared.unpersist()
    classes = materialize(rows.where("n > 0").groupBy("k", "g", "n").agg(F.min(F.struct("ok", "th")).alias("rep")),
                          f"{name}-classes")
    groups = classes.groupBy("g", "n").agg(F.count(F.lit(1)).alias("members"), F.min("k").alias("lead"))
    groups = groups.join(rows.where("n > 0").groupBy("g").agg(F.first("prefix").alias("prefix")), "g")
    groups = materialize(groups.select(F.monotonically_increasing_id().alias("gid"), "*"), f"{name}-groups")
    tokens = groups.select("gid", "n", F.posexplode("prefix").alias("pos", "token"))
    # what is joined on a key that can be hot is written first: Spark can split a join between two plain shuffles
    shared_tokens = materialize(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token"),
                                f"{name}-tokens")
    index = materialize(tokens.join(shared_tokens, "token"), f"{name}-index")
    discard(shared_tokens)
    # packed texts of the classes that any pair may need: a third of the size of their sets
    met = index.select("gid").distinct()
    member = classes.join(groups.select("g", "gid", "members", "lead"), "g").select("k", "n", "rep", "gid", "members", "lead")
    needed = materialize(member.join(met.withColumn("met", F.lit(True)), "gid", "left")
                         .where("met or members > 1"), f"{name}-members")
    z = d.where("text is not null").select("ok", "th", pack(F.col("text")).alias("z")).dropDuplicates(["ok", "th"])
    packed = materialize(needed.select("k", "rep.ok", "rep.th").join(z, ["ok", "th"]).select("k", "z"), f"{name}-texts")
    linked = _verified(kernel, percent)

    def verify(pairs: DataFrame) -> DataFrame:
        p = pairs.join(packed.select(F.col("k").alias("a"), F.col("z").alias("za")), "a")
        p = p.join(packed.select(F.col("k").alias("b"), F.col("z").alias("zb")), "b")
        return p.where(linked("za", "zb")).select("a", "b")

    # 1. every group with the most central group of its buckets, every class with its group's first class
    sized = index.select("*", F.floor(F.log("n") / math.log(100 / percent)).alias("level"))
    central = materialize(sized.groupBy("token", "level").agg(F.min(F.struct("pos", "gid")).alias("top")), f"{name}-central")
    star = sized.join(central, ["token", "level"]).select("gid", F.col("top.gid").alias("to")).where("gid <> to").distinct()
    lead = groups.select("gid", "lead")
    star = star.join(lead.select("gid", F.col("lead").alias("a")), "gid").join(
        lead.select(F.col("gid").alias("to"), F.col("lead").alias("b")), "to").select("a", "b")
    inner = needed.where("members > 1 and k <> lead").select(F.col("k").alias("a"), F.col("lead").alias("b"))
    comp = labels(verify(star.unionByName(inner)), f"{name}-star")
    # 2. all other pairs that could join two components
    member = materialize(needed.join(comp, "k", "left").select("k", "n", "gid", F.coalesce("comp", "k").alias("comp")),
                         f"{name}-joined")
    discard(groups, central, needed)
    span = member.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    held = index.join(span, "gid")
    mixed = materialize(held.groupBy("token").agg(F.min("lo").alias("tlo"), F.max("hi").alias("thi"))
                        .where("tlo <> thi").select("token"), f"{name}-mixed")
    held = materialize(held.join(mixed, "token"), f"{name}-open")
    discard(index, mixed)
    x, y = (held.select("token", *[F.col(c).alias(c + s) for c in ("gid", "n", "pos", "lo", "hi")]) for s in "xy")
    y = y.where(F.expr(f"posy < ny - ceil({2 * percent} * ny / {100 + percent}) + 1"))
    able = F.expr(f"(nx > ny or nx = ny and gidx > gidy) and 100 * ny >= {percent} * nx and not (lox = hix and loy = hiy and "
                  f"lox = loy) and {100 + percent} * least(nx - posx, ny - posy) >= {percent} * (nx + ny)")
    cross = x.join(y, "token").where(able).select("gidx", "gidy").distinct()
    ka = member.select(F.col("gid").alias("gidx"), F.col("k").alias("a"), F.col("comp").alias("ca"))
    kb = member.select(F.col("gid").alias("gidy"), F.col("k").alias("b"), F.col("comp").alias("cb"))
    cross = cross.join(ka, "gidx").join(kb, "gidy").where("ca <> cb").select("a", "b")
    open_groups = member.join(span.where("lo <> hi").select("gid"), "gid")
    inside = open_groups.select("gid", F.col("k").alias("a"), F.col("comp").alias("ca")).join(
        open_groups.select("gid", F.col("k").alias("b"), F.col("comp").alias("cb")), "gid").where("a < b and ca <> cb").select(
        "a", "b")
    late = verify(cross.unionByName(inside))
    by = member.select("k", "comp")
    late = late.join(by.select(F.col("k").alias("a"), F.col("comp").alias("x")), "a").join(
        by.select(F.col("k").alias("b"), F.col("comp").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    joined = labels(late, f"{name}-late")
    discard(packed, held)
    final = by.join(joined.select(F.col("k").alias("comp"), F.col("comp").alias("top")), "comp", "left").select(
        "k", F.coalesce("top", "comp").alias("comp"))
    # 3. the first row of every component, back to the rows
    named = classes.select("k", "rep").join(final, "k", "left").select("k", "rep", F.coalesce("comp", "k").alias("comp"))
    named = materialize(named, f"{name}-named")
    heads = materialize(named.groupBy("comp").agg(F.min("rep").alias("head")), f"{name}-heads")
    named = named.join(heads, "comp").select("k", F.col("head.ok").alias("head"), F.col("head.th").alias("head_th"))
    return rows.select("doc_id", "ok", "th", "n", "k").join(named, "k", "left").select(
        "doc_id", "ok", "th", "n", F.coalesce("head", "ok").alias("head"), F.coalesce("head_th", "th").alias("head_th"))


def keep_first(docs: DataFrame, kernel=None, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text",
               name: str = "ngram") -> DataFrame:
    """The input without near duplicates: of each component the row with the smallest id stays (of equal rows, one);
    rows with an empty set all stay. All columns come back."""
    found = near_duplicates(docs, kernel, percent, doc_id, text, name)
    stay = found.where("n = 0 or ok = head and th <=> head_th").select(
        F.col("ok").alias("__ok"), F.coalesce("th", F.lit(0)).alias("__th"), (F.col("n") > 0).alias("__one")).distinct()
    d = docs.select(F.struct("*").alias("__doc"), F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("__ok"),
                    F.coalesce(F.xxhash64(text), F.lit(0)).alias("__th")).join(stay, ["__ok", "__th"])
    one = Window.partitionBy("__ok", "__th").orderBy("__one")
    return d.select("__doc", "__one", F.row_number().over(one).alias("__r")).where("not __one or __r = 1").select("__doc.*")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents over distinct 3-word shingles at Jaccard 0.9."""
    c = near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return c.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("head") < LAST, F.col("head")).alias("component_id"))


OP7_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
gram AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, k, k + 2), ' ') AS s
         FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM gram a JOIN gram b ON a.s = b.s AND a.doc_id < b.doc_id
         GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE 100 * c >= 90 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
low AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""
