"""Windows of fixed length that repeat across (or inside) documents, exactly and without pairs.

A document is a sequence of symbols (bytes, or words as 64-bit hashes); a window is ``length`` consecutive symbols.
Each window is assigned to its anchor: the position in it whose next ``seed`` symbols hash lowest (the first of equals).
That choice depends on the window's content alone, so equal windows have equal seeds at equal distances from their
starts, and only anchors need to be compared: consecutive windows that share an anchor form one run, and there are
about ``2 / (length - seed)`` runs per symbol.

The distance from window start to anchor is ``r``. Runs (later blocks of a run) carry two names: ``core``, of what all
its windows have in common, and ``whole``, of everything they cover. In each step, by aggregates and joins only,

* a block whose core occurs once holds no repeat: it leaves;
* a block whose whole occurs again repeats in all its windows: it is settled, and only the first of each such class
  stays, as a partner for blocks that match a part of it;
* the rest is cut into smaller blocks, down to single windows, whose names decide.

Classes of any size (copies, boilerplate) meet as counts, never as pairs or lists. Every step writes its survivors to the
shared folder; names have 128 bits (seed and name). Texts longer than a slice are cut into overlapping slices, so the
memory of a task is bounded by the slice, not by the text.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import discard, materialize
from ._common import ship_by_value, sub_batches
from ._hashing import Hashes, mix, sliding_argmin, words_of

ship_by_value(__name__)

SLICE = 1_000_000
LAST = (1 << 63) - 1          # place of a null id in the order of documents
_BLANKS = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


@dataclass(frozen=True)
class Spec:
    length: int               # symbols of a window
    seed: int                 # symbols of a seed
    words: bool               # symbols are words between ASCII blanks; otherwise UTF-8 bytes
    blocks: tuple[int, ...]   # block sizes of the later steps, down to 1
    earlier: bool             # repeated means: also starts earlier; otherwise: also starts anywhere else


def pack(text: Column) -> Column:
    """Compressed text, for the shuffles that have to move it."""
    @F.pandas_udf("binary")
    def run(texts):
        import zstandard
        c = zstandard.ZstdCompressor(level=1)
        return texts.map(lambda t: None if t is None else c.compress(t.encode("utf-8", "surrogatepass")))
    return run(text)


def unpack(z: bytes | None) -> bytes:
    import zstandard
    return b"" if z is None else zstandard.ZstdDecompressor().decompress(z)


def split_words(raw: bytes) -> list[bytes]:
    return raw.split()        # bytes.split() divides at space and \x09-\x0D


def sequences(raws: list[bytes], words: bool):
    """The symbols of every text."""
    if not words:
        for r in raws:
            yield np.frombuffer(r, np.uint8)
        return
    for i, j in sub_batches(raws):
        if j - i == 1 and len(raws[i]) > 4 * SLICE:
            yield _long_words(raws[i])
            continue
        h, start, _ = words_of(np.frombuffer(b" ".join(raws[i:j]), np.uint8), _BLANKS)
        cut = np.searchsorted(start, np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws[i:j]])]))
        for k in range(j - i):
            yield h[cut[k]:cut[k + 1]]


def _long_words(raw: bytes) -> np.ndarray:
    buf, out, at = np.frombuffer(raw, np.uint8), [], 0
    while at < len(buf):
        to = min(len(buf), at + SLICE)
        while to < len(buf) and not _BLANKS[buf[to]]:
            to += 1
        out.append(words_of(buf[at:to], _BLANKS)[0])
        at = to
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def runs(seqs, spec: Spec):
    """Blocks of (sequence number, anchor, least r, largest r, seed name, whole name) for all windows of the sequences."""
    pieces, total = [], 0
    for k, s in enumerate(seqs):
        for at in range(0, max(len(s) - spec.length + 1, 0), SLICE):
            p = s[at:at + SLICE + spec.length - 1]
            if pieces and total + len(p) > SLICE:
                yield _runs(pieces, spec)
                pieces, total = [], 0
            pieces.append((k, at, p))
            total += len(p)
    if pieces:
        yield _runs(pieces, spec)


def _runs(pieces, spec: Spec):
    n, width = spec.length, spec.length - spec.seed + 1
    size = np.array([len(p) for _, _, p in pieces])
    first = np.cumsum(size) - size
    h = Hashes(np.concatenate([p for _, _, p in pieces]))
    seed = h.every(spec.seed)
    anchor = sliding_argmin(seed, width)
    ok = np.zeros(len(anchor), bool)
    for a, m in zip(first, size):
        ok[a:a + m - n + 1] = True
    start = np.flatnonzero(ok)
    anchor = anchor[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(new)
    lo, hi, a = start[at], start[np.append(at[1:], len(start)) - 1], anchor[at]
    piece = np.searchsorted(first, lo, side="right") - 1
    whole = mix(h.of(lo, hi + n) + (a - hi).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))
    doc, shift = np.array([k for k, _, _ in pieces]), np.array([o for _, o, _ in pieces])
    return doc[piece], a - first[piece] + shift[piece], a - hi, a - lo, seed[a], whole


_RUNS = pa.schema([("ok", pa.int64()), ("th", pa.int64()), ("a", pa.int32()), ("rlo", pa.int32()), ("rhi", pa.int32()),
                   ("seed", pa.int64()), ("whole", pa.int64())])


def _find_runs(spec: Spec):
    def run(batches):
        for b in batches:
            ok, th = b.column("ok").to_numpy(zero_copy_only=False), b.column("th").to_numpy(zero_copy_only=False)
            raws = [t.encode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()]
            for doc, a, rlo, rhi, seed, whole in runs(sequences(raws, spec.words), spec):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ok[doc]), pa.array(th[doc]), pa.array(a.astype(np.int32)), pa.array(rlo.astype(np.int32)),
                     pa.array(rhi.astype(np.int32)), pa.array(seed.view(np.int64)), pa.array(whole.view(np.int64))],
                    schema=_RUNS)
    return run


def _cut_contexts(spec: Spec):
    """Survivors of a document with its text -> survivors with the symbols they cover."""
    def run(batches):
        for b in batches:
            raws = [unpack(z) for z in b.column("z").to_pylist()]
            out = []
            for ok, th, picks, s in zip(b.column("ok").to_pylist(), b.column("th").to_pylist(),
                                        b.column("picks").to_pylist(), sequences(raws, spec.words)):
                for p in picks:
                    out.append((ok, th, p["a"], p["rlo"], p["rhi"], p["seed"],
                                s[p["a"] - p["rhi"]:p["a"] - p["rlo"] + spec.length].tobytes()))
                if len(out) >= 10_000:
                    yield _contexts(out)
                    out = []
            if out:
                yield _contexts(out)
    return run


def _contexts(rows):
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      names=["ok", "th", "a", "rlo", "rhi", "seed", "ctx"])


def _blocks(spec: Spec, size: int):
    """Survivors with their symbols -> their blocks of ``size`` distances, with both names."""
    def run(batches):
        for b in batches:
            if not len(b):
                continue
            rlo, rhi = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("rlo", "rhi"))
            ctx = b.column("ctx").to_pylist()
            seq = np.frombuffer(b"".join(ctx), np.uint64 if spec.words else np.uint8)
            n = np.array([len(c) for c in ctx]) // seq.itemsize
            h, origin = Hashes(seq), np.cumsum(n) - n + rhi                      # of r: origin - r
            t0 = rlo // size
            m = rhi // size - t0 + 1
            row = np.repeat(np.arange(len(rlo)), m)
            t = np.arange(len(row)) - np.repeat(np.cumsum(m) - m, m) + t0[row]
            lo, hi = np.maximum(t * size, rlo[row]), np.minimum(t * size + size - 1, rhi[row])
            x = origin[row]
            whole = mix(h.of(x - hi, x - lo + spec.length) + lo.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))
            core = mix(h.of(x - t * size, x - (t * size + size - 1) + spec.length)
                       + t.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            pick = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(pick) for c in ("id", "ok", "th", "a", "seed")), pa.array(lo.astype(np.int32)),
                 pa.array(hi.astype(np.int32)), pa.array(core.view(np.int64)), pa.array(whole.view(np.int64))],
                names=["id", "ok", "th", "a", "seed", "rlo", "rhi", "core", "whole"])
    return run


def _narrow(spec: Spec):
    """Survivors (a part of an earlier block) -> the symbols that this part covers."""
    def run(batches):
        unit = 8 if spec.words else 1
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("rlo", "rhi", "old", "ctx")))
            cut = [c[(old - hi) * unit:(old - lo + spec.length) * unit] for lo, hi, old, c in rows]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("ok", "th", "a", "rlo", "rhi", "seed")),
                                              pa.array(cut, pa.binary())],
                                             names=["ok", "th", "a", "rlo", "rhi", "seed", "ctx"])
    return run


def _judge(blocks: DataFrame, spec: Spec, core: list[str], name: str) -> DataFrame:
    """Blocks that are settled (``done``) or go on (``keep``); the rest, which hold no repeat, is gone."""
    # counts are written before they are joined: a join between two plain shuffles can be split at a hot name
    counts = materialize(blocks.groupBy(*core).agg(F.count(F.lit(1)).alias("c")).where("c > 1"), name + "-cores")
    alive = materialize(blocks.join(counts, core), name + "-alive")
    whole = materialize(alive.groupBy("seed", "whole").agg(F.count(F.lit(1)).alias("w"),
                                                           F.min(F.struct("ok", "a")).alias("first")), name + "-wholes")
    j = alive.join(whole, ["seed", "whole"])
    own = F.struct("ok", "a")
    done = own > F.col("first") if spec.earlier else F.col("w") > 1
    j = j.select("*", done.alias("done"), ((own == F.col("first")) & (F.col("c") > F.col("w"))).alias("keep"))
    j = materialize(j.where("done or keep").drop("first", "w", "c", "whole"), name)
    discard(counts, alive, whole)
    return j


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with their key: ``ok`` orders them (null last), ``th`` tells rows of one id apart by their text."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("ok"), F.xxhash64(text).alias("th"))


def repeated(docs: DataFrame, spec: Spec, name: str) -> DataFrame:
    """(ok, th, spans) of the documents (from ``keyed``) that have repeated windows: ``spans`` holds ``start << 32 | stop``
    in symbols, unordered and overlapping, and covers exactly those windows."""
    src = docs.where("text is not null").select("ok", "th", "text")
    found = src.mapInArrow(_find_runs(spec), "ok long, th long, a int, rlo int, rhi int, seed long, whole long")
    judged = _judge(found, spec, ["seed"], f"{name}-runs")
    settled = [judged.where("done")]
    picks = judged.where("keep").groupBy("ok", "th").agg(F.collect_list(F.struct("a", "rlo", "rhi", "seed")).alias("picks"))
    texts = docs.where("text is not null").select("ok", "th", pack(F.col("text")).alias("z")).dropDuplicates(["ok", "th"])
    kept = "ok long, th long, a int, rlo int, rhi int, seed long, ctx binary"
    rest = picks.join(texts, ["ok", "th"]).mapInArrow(_cut_contexts(spec), kept)
    before = None
    for size in spec.blocks:
        rest = materialize(rest.select(F.monotonically_increasing_id().alias("id"), "*"), f"{name}-rest")
        if before is not None:
            discard(before)
        before = rest
        blocks = rest.mapInArrow(_blocks(spec, size), "id long, ok long, th long, a int, seed long, rlo int, rhi int, "
                                                      "core long, whole long")
        judged = _judge(blocks, spec, ["seed", "core"], f"{name}-{size}")
        settled.append(judged.where("done"))
        again = judged.where("keep").select("id", "ok", "th", "a", "rlo", "rhi", "seed")
        rest = again.join(rest.select("id", F.col("rhi").alias("old"), "ctx"), "id").mapInArrow(_narrow(spec), kept)
    if before is not None:
        discard(before)
    spans = [s.select("ok", "th", (F.shiftleft((F.col("a") - F.col("rhi")).cast("long"), 32)
                                   + (F.col("a") - F.col("rlo") + spec.length)).alias("span")) for s in settled]
    every = spans[0]
    for s in spans[1:]:
        every = every.unionByName(s)
    return every.groupBy("ok", "th").agg(F.collect_set("span").alias("spans"))


def merged(spans, n: int) -> list[tuple[int, int]]:
    """Maximal covered runs, in order."""
    if spans is None or not len(spans):
        return []
    s = np.sort(np.asarray(spans, np.int64))
    b, e = s >> 32, np.maximum.accumulate(s & 0xFFFFFFFF)
    new = np.ones(len(b), bool)
    new[1:] = b[1:] > e[:-1]
    at = np.flatnonzero(new)
    return list(zip(b[at].tolist(), e[np.append(at[1:], len(b)) - 1].tolist()))


def with_spans(docs: DataFrame, spec: Spec, name: str) -> DataFrame:
    """(doc_id, z, spans) of every row: the compressed text and what ``repeated`` found in it."""
    spans = repeated(docs, spec, name)
    return docs.select("doc_id", "ok", "th", pack(F.col("text")).alias("z")).join(spans, ["ok", "th"], "left").select(
        "doc_id", "z", "spans")
