"""SimHash near duplicates with pivot distance tables, as exact connected components.

Fingerprint: each 3-word shingle (repeats count) is hashed to 64 bits; a bit of the fingerprint is 1 if over half of the
hashes have it. Two documents link when their fingerprints differ in at most ``LIMIT`` bits.

* Collapse: documents with one fingerprint are one node, so copies in any number cost one row.
* Table: every fingerprint's Hamming distances to ``PIVOTS`` reference fingerprints. By the triangle inequality two
  fingerprints within ``LIMIT`` bits have distances to every pivot that differ by at most ``LIMIT``: a pair with a larger
  coordinate difference is discarded, survivors are verified on the fingerprints themselves.
* Where pairs meet: of ``b`` bands of the 64 bits, fingerprints within ``LIMIT`` agree on at least ``b - LIMIT``, so every
  choice of that many bands is one bucket key (``b`` grows with the number of fingerprints; any ``b`` gives the same links).
* No bucket emits all its pairs. First each fingerprint meets its bucket's head (the fingerprint of the most documents) and
  components are formed. Then, only in buckets that still hold several components, the members outside the bucket's
  largest component meet the rest on (bucket, cells of the first two pivot distances), so a hot bucket is dealt out by its
  pivot table; a pair inside one component is never verified again. No pair that could join two components is left out.

Defined results: null, empty and blank texts have fingerprint zero, which links like any other; a text with fewer words than
a shingle is one shingle as a whole; texts of any length are hashed in blocks of shingles; repeated rows share a fingerprint
and a component; a component is named by its smallest id, null ids count as largest; an empty table gives no rows; further
columns are ignored.
"""
from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import discard, materialize
from ._common import read, ship_by_value
from ._repeats import LAST
from .ngram_join import labels

ship_by_value(__name__)

SIZE, LIMIT, SEED = 3, 3, 42
PIVOTS = 16
CELL = 8                      # width of a pivot cell in the join key
PER_BUCKET = 0.25             # unrelated fingerprints that a bucket may hold on average: they should rarely meet
BLOCK = 255 * 256             # shingles hashed at a time
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _lanes() -> np.ndarray:
    """For each byte value its eight bits, one to a byte of a 64-bit word."""
    return np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprint(raw: bytes, lanes: np.ndarray, size: int = SIZE) -> int:
    """64-bit fingerprint, as a signed integer, of a UTF-8 text."""
    from xxhash import xxh64_digest
    words = raw.translate(_LOWER).split()                 # bytes.split() divides at space and \x09-\x0D
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, BLOCK):
        part = words[i:i + BLOCK + size - 1]
        line = b" ".join(part)
        stop = np.cumsum([len(w) + 1 for w in part]) - 1
        start = np.concatenate([[0], stop[:-1] + 1])
        if len(part) > size:
            k = len(part) - size + 1
            got = [xxh64_digest(line[a:b], SEED) for a, b in zip(start[:k].tolist(), stop[size - 1:].tolist())]
        else:
            got = [xxh64_digest(line, SEED)]
        h = np.frombuffer(b"".join(got), np.uint8).reshape(-1, 8)       # most significant byte first
        h = lanes[np.concatenate([h, np.zeros((-len(h) % 255, 8), np.uint8)])]
        sums = h.reshape(-1, 255, 8).sum(axis=1, dtype=np.uint64)       # a lane holds at most 255
        ones += sums.view(np.uint8).reshape(-1, 8, 8)[:, ::-1, :].reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """(doc_id, fp) of every row."""
    def run(batches):
        lanes = _lanes()
        for b in batches:
            fp = [fingerprint(t, lanes, size) for t in b.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp, pa.int64())], names=["doc_id", "fp"])
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))
    return d.mapInArrow(run, "doc_id long, fp long")


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints, far from each other: any set gives the same links."""
    return [int(x) for x in np.random.default_rng(64).integers(-(1 << 63), (1 << 63) - 1, n, dtype=np.int64)]


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def band_masks(bands: int, limit: int = LIMIT) -> list[int]:
    """Masks (signed) of every choice of ``bands - limit`` of the bands."""
    cut = [64 * k // bands for k in range(bands + 1)]
    band = [(1 << cut[k + 1]) - (1 << cut[k]) for k in range(bands)]
    full = [sum(band[k] for k in c) for c in combinations(range(bands), bands - limit)]
    return [m - (1 << 64) if m >> 63 else m for m in full]


def bands_for(n: int, limit: int = LIMIT) -> int:
    """The least number of bands whose keys hold ``PER_BUCKET`` unrelated fingerprints or fewer on average."""
    b = limit + 1
    while n > PER_BUCKET * 2.0 ** (64 * (b - limit) / b) and b < limit + 8:
        b += 1
    return b


def _keyed(fps: DataFrame, masks: list[int]) -> DataFrame:
    keys = F.array(*[F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for t, m in enumerate(masks)])
    return fps.select("*", F.explode(keys).alias("at")).select("*", "at.table", "at.key").drop("at")


def components(fps: DataFrame, limit: int = LIMIT, bands: int | None = None, star: bool = True,
               name: str = "simhash") -> DataFrame:
    """(fp, comp): the least fingerprint of each component, for distinct fingerprints ``fps`` (fp, n documents)."""
    refs = pivots()
    coords = [f"d{i}" for i in range(len(refs))]
    table = materialize(fps.select("fp", "n", *[distance(F.col("fp"), F.lit(p)).cast("tinyint").alias(c)
                                                for c, p in zip(coords, refs)]), f"{name}-pivots")
    masks = band_masks(bands or bands_for(table.count(), limit), limit)
    # 1. every fingerprint with the head of each of its buckets
    heads = _keyed(table.select("fp", "n"), masks).groupBy("table", "key").agg(
        F.max(F.struct("n", "fp")).alias("top"), F.count(F.lit(1)).alias("c")).where("c > 1")
    heads = materialize(heads.select("table", "key", F.col("top.fp").alias("head")), f"{name}-heads")
    links = _keyed(table.select("fp"), masks).join(heads, ["table", "key"]).where(
        (F.col("fp") != F.col("head")) & (distance(F.col("fp"), F.col("head")) <= limit))
    links = links.where(F.lit(star)).select(F.col("fp").alias("a"), F.col("head").alias("b")).distinct()
    comp = labels(links, f"{name}-star")
    # 2. what lies outside the largest component of a bucket with all that the bucket holds of other components
    member = materialize(table.join(comp.withColumnRenamed("k", "fp"), "fp", "left").select(
        "fp", F.coalesce("comp", "fp").alias("comp"), *coords), f"{name}-members")
    sizes = materialize(member.groupBy("comp").agg(F.count(F.lit(1)).alias("size")), f"{name}-sizes")
    sized = materialize(member.join(sizes, "comp"), f"{name}-sized")
    held = _keyed(sized.select("fp", "comp", "size"), masks).join(heads.select("table", "key"), ["table", "key"])
    open_ = materialize(held.groupBy("table", "key").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(F.struct("size", "comp")).alias("most"))
        .where("lo <> hi").select("table", "key", F.col("most.comp").alias("main")), f"{name}-open")
    rows = _keyed(sized.drop("size"), masks).join(open_, ["table", "key"])
    cells = [F.col(c).cast("int") for c in coords[:2]]
    home = rows.select("table", "key", *[F.floor(c / CELL).cast("int").alias(f"cell{i}") for i, c in enumerate(cells)],
                       *[F.col(c).alias(f"{c}y") for c in ("fp", "comp", "main", *coords)])
    away = rows.where("comp <> main").select("table", "key", *[F.col(c).alias(f"{c}x") for c in ("fp", "comp", *coords)])
    for i, c in enumerate(coords[:2]):
        lo, hi = (F.floor(F.greatest(F.lit(0), F.col(f"{c}x").cast("int") + d) / CELL).cast("int") for d in (-limit, limit))
        away = away.select("*", F.explode(F.sequence(lo, hi)).alias(f"cell{i}"))
    pairs = away.join(home, ["table", "key", "cell0", "cell1"]).where("compx <> compy and (compy = mainy or fpx < fpy)")
    for c in coords:
        pairs = pairs.where(F.abs(F.col(f"{c}x") - F.col(f"{c}y")) <= limit)
    late = pairs.where(distance(F.col("fpx"), F.col("fpy")) <= limit).select(
        F.col("compx").alias("a"), F.col("compy").alias("b")).distinct()
    top = labels(late, f"{name}-late")
    out = materialize(member.select("fp", "comp").join(top.select(F.col("k").alias("comp"), F.col("comp").alias("top")),
                                                       "comp", "left").select("fp", F.coalesce("top", "comp").alias("comp")),
                      f"{name}-components")
    discard(table, heads, comp, member, sizes, sized, open_, top)
    return out


def near_duplicates(docs: DataFrame, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
                    bands: int | None = None, star: bool = True, name: str = "simhash") -> DataFrame:
    """(doc_id, fp, component_id) of every row; ``component_id`` is null where the component has no id but null."""
    rows = materialize(fingerprints(docs, doc_id, text, size), f"{name}-rows")
    fps = materialize(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"),
                                             F.min(F.coalesce("doc_id", F.lit(LAST))).alias("first")), f"{name}-distinct")
    comp = components(fps, limit, bands, star, name)
    named = materialize(fps.select("fp", "first").join(comp, "fp"), f"{name}-named")
    least = materialize(named.groupBy("comp").agg(F.min("first").alias("head")), f"{name}-least")
    named = materialize(named.join(least, "comp").select("fp", F.when(F.col("head") < LAST, F.col("head"))
                                                         .alias("component_id")), f"{name}-of")
    discard(fps, comp, least)
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of all documents."""
    c = near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return c.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
