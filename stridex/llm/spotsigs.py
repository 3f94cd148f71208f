"""Document fingerprints from spot signatures, and near duplicates among them.

A spot is an anchor: a common word, or a word that one word in ``SAMPLED`` is by its hash, so that texts of any language and
kind have spots at a like density. Its signature is the anchor with the chain of the next ``CHAIN`` content words.
The set of a document's signatures is its fingerprint; fingerprints are compared by Jaccard.

Near duplicates (``near_duplicate_groups``), by sets in partitions of their length:

* Documents with one set are one class, so copies in any number cost one row.
* ``partitions`` cuts the lengths so that a set can be near only to sets of its own and the next partition. A class stands in
  the index of its own partition and as a guest in that of the next one; two guests never meet.
* A set's index entries are its rarest signatures only: two sets that share none of these differ in more signatures than
  the threshold allows. A pair is discarded by its lengths, and by how many signatures are left behind the shared one.
* No index list emits all its pairs. First every class meets the list's head and components are formed; then, only in
  lists that still hold several components, the classes outside the head's component meet the rest. A pair inside one
  component is never compared, and no pair that could join two components is left out.

Defined results: words are runs of letters and digits (any byte beyond ASCII counts as a letter), A-Z in lower case; a
text with words but no anchor followed by a content word takes each of its words as an anchor, so it still has a
fingerprint; a text without words has its hash as only signature (of nothing, for null or empty text). Equal texts have
equal fingerprints. Two equal sets have likeness 1. A null id sorts before all others; rows of one id follow each other by
text, null first, and the successor of an id's last row is the next id's first; a single row is its own successor; an empty
table gives no rows; long texts are read whole; further columns are ignored. A component is named by its smallest id, null
ids count as largest; null and empty texts are linked with nothing.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import discard, materialize
from ._common import read, ship_by_value, sub_batches
from ._hashing import mix, words_of
from ._repeats import keyed
from .ngram_join import labels, prefix_length

ship_by_value(__name__)

CHAIN = 3
SAMPLED = 4                   # one in so many words is an anchor whatever its language
PERCENT = 80                  # likeness of near duplicates
SLOTS = 1 << 16               # counters that order signatures by rarity (any number gives the same links)
# Anchors: common function words of four languages.
ANCHORS = ("the of and to in is that for it as with be by on not he are or this from was at have an which you "
           "de la le et les des en un du que au qui dans par sur pour avec est une ce "
           "der die das und von den zu mit ein ist nicht als auf dem im auch sich "
           "el los y del se las con una su para al lo como").split()
_LETTER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BLANK = np.array([b == 32 for b in range(256)])


def _anchor_hashes(anchors) -> np.ndarray:
    line = np.frombuffer(" ".join(anchors).encode().translate(_LETTER), np.uint8)
    return np.unique(words_of(line, _BLANK)[0]) if len(line) else np.zeros(0, np.uint64)


def is_anchor(word: str) -> bool:
    """Whether a lower-case word is an anchor."""
    return word in ANCHORS or int(_anchor_hashes([word])[0]) % SAMPLED == 0


def signatures(texts: list[str], anchors=ANCHORS, chain: int = CHAIN) -> list[np.ndarray]:
    """The sorted distinct 32-bit signatures of every text."""
    common = _anchor_hashes(anchors)
    out: list[np.ndarray] = []
    for i, j in sub_batches(texts):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts[i:j]]
        h, start, _ = words_of(np.frombuffer(b" ".join(raw).translate(_LETTER), np.uint8), _BLANK)
        edge = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
        cut = np.searchsorted(start, edge)
        spot = h % np.uint64(SAMPLED) == 0
        if len(common):
            spot |= common[np.minimum(np.searchsorted(common, h), len(common) - 1)] == h
        for k, r in enumerate(raw):
            out.append(_signatures(h[cut[k]:cut[k + 1]], spot[cut[k]:cut[k + 1]], chain, r))
    return out


def _signatures(h: np.ndarray, spot: np.ndarray, chain: int, raw: bytes) -> np.ndarray:
    if not len(h):
        return np.array([int.from_bytes(hashlib.sha256(raw).digest()[:4], "big")] if raw else [], np.uint32)
    content = h[~spot]
    at = np.flatnonzero(spot)
    nxt = at - np.arange(len(at))                      # content words before the anchor: the chain starts there
    at, nxt = at[nxt < len(content)], nxt[nxt < len(content)]
    if not len(at):                                    # no anchor with a chain: every word is one
        content, at, nxt = h, np.arange(len(h)), np.arange(len(h)) + 1
    s = h[at].copy()
    padded = np.concatenate([content, np.zeros(chain + 1, np.uint64)])
    for k in range(chain):
        s = mix(s * np.uint64(0x2545F4914F6CDD1D) + padded[np.minimum(nxt + k, len(content))])
    return np.unique((s >> np.uint64(32)).astype(np.uint32))


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two sorted signature sets; 0 at once if their lengths alone keep it under ``least``."""
    if len(a) == len(b) and np.array_equal(a, b):
        return 1.0
    small, large = sorted((len(a), len(b)))
    if not small or small < least * large:
        return 0.0
    both = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
    return both / (len(a) + len(b) - both)


def fingerprint(sig: np.ndarray) -> str:
    """The set as text: eight hex digits per signature, in order."""
    return sig.astype(">u4").tobytes().hex()


def signature_sets(text: Column) -> Column:
    """Array of the signatures of a text column, for set joins."""
    @F.pandas_udf("array<long>")
    def sets(texts):
        import pandas as pd
        return pd.Series([s.astype(np.int64) for s in signatures(["" if t is None else t for t in texts.tolist()])])
    return sets(text)


_NEXT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
         "near_next double, {0} long")
_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())


FOR_ID, FOR_TEXT, DOCUMENT = 0, 1, 2     # rows of an exchange: the component of an id's only text, of one text, a document


def _compare(batches):
    """Rows of whole buckets in order -> one row per document, compared with its edit and its successor."""
    held = None                                        # (bucket, id, text, signatures): waits for its successor
    named = None                                       # (id, text or any, component) of the documents that follow
    for batch in batches:
        cols = batch.to_pydict()
        docs = []
        for bucket, i, text, ghost, grp, kind in zip(*(cols[c] for c in ("bucket", "doc_id", "text", "ghost", "grp", "kind"))):
            if kind != DOCUMENT:
                named = (i, kind, text, grp)
                continue
            mine = named is not None and named[0] == i and (named[1] == FOR_ID or named[2] == text)
            docs.append((bucket, i, "" if text is None else text, ghost, named[3] if mine else i))
        sets = signatures([d[2] for d in docs])
        rows = [(*d[:3], s, *d[3:]) for d, s in zip(docs, sets)]
        pairs = []
        for r in rows:
            if held is not None and held[0] == r[0]:
                pairs.append((held, r))
            held = None if r[4] else r
        for i in range(0, len(pairs), 2000):
            part = pairs[i:i + 2000]
            cut = [(len(a[2]) // 3) for a, _ in part]
            edited = [a[2][:len(a[2]) - m] + b[2][:m] for (a, b), m in zip(part, cut)]
            sig = signatures(edited)
            out = ([a[1] for a, _ in part], [len(a[2]) for a, _ in part],
                   [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
                   [fingerprint(a[3]) for a, _ in part], [fingerprint(s) for s in sig],
                   [likeness(a[3], s) for (a, _), s in zip(part, sig)], [likeness(a[3], b[3]) for a, b in part],
                   [a[5] for a, _ in part])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _TYPES)],
                                             names=[f.split()[0] for f in _NEXT.format("grp").split(", ")])


def with_successor(docs: DataFrame, buckets: int | None = None, groups: DataFrame | None = None) -> DataFrame:
    """Every document in id order, descending, with its successor (of the last one: the first), compared.

    The ids are cut at quantiles that are ids themselves; a bucket gets its own documents and, as a ghost, the first
    document of the next bucket, so the texts move once and no task holds more than one bucket. ``groups`` (from
    ``near_duplicate_groups``) adds the column ``component_id``: its rows travel in the same exchange, just before their
    documents (``_named``), so no join moves the texts again."""
    spark = docs.sparkSession
    n = int(buckets or spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k")
    row = docs.select(key).agg(
        F.max("k"), F.percentile_approx("k", [(i + 1) / n for i in range(n - 1)] or [0.5], 100 * n)).first()
    cuts = np.unique(np.array([row[0], *(row[1] or [])], np.int64)) if row[0] is not None else np.zeros(0, np.int64)
    last = len(cuts) - 1

    @F.pandas_udf("struct<b:int,g:int>")
    def place(k):
        import pandas as pd
        k = k.to_numpy()
        at = np.searchsorted(cuts, k, side="left")
        low = np.minimum(at, max(last, 0))
        is_cut = cuts[low] == k if last >= 0 else np.zeros(len(k), bool)
        ghost = np.where(is_cut, np.where(low == last, last, last - low - 1), -1)
        return pd.DataFrame({"b": (last - at).astype(np.int32), "g": ghost.astype(np.int32)})

    d = docs.select("doc_id", "text", key, F.lit(None).cast("long").alias("grp"), F.lit(DOCUMENT).alias("kind"))
    if groups is not None:
        d = d.unionByName(_named(docs, groups).select("doc_id", "text", key, "grp", "kind"))
    d = d.select("*", place("k").alias("at"))
    d = d.select("doc_id", "text", "k", "grp", "kind", F.explode(F.expr(
        f"IF(at.g < 0 or kind < {DOCUMENT}, array(struct(at.b AS bucket, false AS ghost)), "
        "array(struct(at.b AS bucket, false AS ghost), struct(at.g AS bucket, true AS ghost)))")).alias("x"))
    d = d.select("x.bucket", "x.ghost", "doc_id", "text", "k", "grp", "kind").repartitionById(max(last + 1, 1), "bucket")
    d = d.sortWithinPartitions("bucket", "ghost", F.desc("k"), "text", "kind")
    out = d.select("bucket", "ghost", "doc_id", "text", "grp", "kind").mapInArrow(_compare, _NEXT.format("grp"))
    return out.drop("grp") if groups is None else out.withColumnRenamed("grp", "component_id")


def _named(docs: DataFrame, groups: DataFrame, name: str = "spots") -> DataFrame:
    """(doc_id, text, grp, kind): the components of documents that don't name their own. An id with one text needs the id
    only; of an id with several, each row has the text it is for, which puts it before that text's documents."""
    several = groups.select("ok", "th").distinct().groupBy("ok").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    several = materialize(several.select("ok"), f"{name}-several")
    moved = groups.where("head <> ok").select("doc_id", "ok", "th", F.col("head").alias("grp")).distinct()
    one = moved.join(several, "ok", "left_anti").select("doc_id", F.lit(None).cast("string").alias("text"), "grp",
                                                        F.lit(FOR_ID).alias("kind"))
    each = materialize(moved.join(several, "ok", "left_semi"), f"{name}-each")
    texts = keyed(docs).select("ok", "th", "text")
    each = each.join(texts, ["ok", "th"]).select("doc_id", "text", "grp", F.lit(FOR_TEXT).alias("kind"))
    return one.unionByName(each)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness and that to the next document, and the
    near-duplicate component (likeness 0.8 or more) of the fingerprint among those of all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return with_successor(docs, groups=near_duplicate_groups(docs))


def partitions(percent: int = PERCENT, longest: int = (1 << 31) - 1) -> np.ndarray:
    """The least length of every partition: the shortest set of one is too short for any set two partitions on."""
    least = [1]
    while least[-1] <= longest:
        least.append(100 * least[-1] // percent + 1)
    return np.array(least[:-1], np.int64)


def _sets(batches):
    """(ok, th, text) -> (ok, th, n, key, sigs): the key is a hash of the set."""
    for b in batches:
        sig = signatures(["" if t is None else t for t in b.column("text").to_pylist()])
        size = np.array([len(s) for s in sig], np.int32)
        edge = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        flat = np.concatenate([*sig, np.zeros(0, np.uint32)]).astype(np.uint32).view(np.int32)
        key = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sig]
        yield pa.RecordBatch.from_arrays([
            b.column("doc_id"), b.column("ok"), b.column("th"), pa.array(size), pa.array(key, pa.binary()),
            pa.ListArray.from_arrays(pa.array(edge), pa.array(flat))], names=["doc_id", "ok", "th", "n", "key", "sigs"])


def _entries(loads, percent: int):
    """(gid, sigs) -> (gid, n, part, rare): the partition of a set and its rarest signatures, rarest first."""
    least = partitions(percent)

    def run(batches):
        counts = loads.value
        for b in batches:
            n, part, rare = [], [], []
            for s in b.column("sigs"):
                s = s.values.to_numpy(zero_copy_only=False)
                order = np.lexsort((s, counts[s & (SLOTS - 1)]))
                n.append(len(s))
                part.append(int(np.searchsorted(least, len(s), side="right")) - 1)
                rare.append(s[order[:prefix_length(len(s), percent)]])
            yield pa.RecordBatch.from_arrays([b.column("gid"), pa.array(n, pa.int32()), pa.array(part, pa.int32()),
                                              pa.array(rare, pa.list_(pa.int32()))], names=["gid", "n", "part", "rare"])
    return run


def _loads(sets: DataFrame) -> np.ndarray:
    """How many sets hold a signature of each slot; ``SLOTS`` rows at most, whatever the input."""
    slot = F.col("sig").bitwiseAND(F.lit(SLOTS - 1)).alias("slot")
    got = sets.select(F.explode("sigs").alias("sig")).groupBy(slot).agg(F.count(F.lit(1)).alias("c")).toPandas()
    counts = np.zeros(SLOTS, np.int64)
    counts[got["slot"].to_numpy(np.int64)] = got["c"].to_numpy(np.int64)
    return counts


def near_duplicate_groups(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text",
                          star: bool = True, name: str = "spots") -> DataFrame:
    """(doc_id, ok, th, n, head) of every row: the size of its signature set and ``head``, the smallest ``ok`` (the id; of a
    null id the largest long) of its component of documents whose sets have Jaccard ``percent`` / 100 or more. ``th`` is
    the text's hash, which tells rows of one id apart. ``star=False`` leaves all pairs to the second phase."""
    spark = docs.sparkSession
    d = keyed(docs, doc_id, text).select(F.col("doc_id").cast("long").alias("doc_id"), "ok", "th", "text")
    sets = d.mapInArrow(_sets, "doc_id long, ok long, th long, n int, key binary, sigs array<int>")
    sets = materialize(sets.select(F.monotonically_increasing_id().alias("gid"), "*"), f"{name}-sets")
    # a class goes by its first row; the sets themselves stay where they are
    classes = materialize(sets.where("n > 0").groupBy("key").agg(F.min("gid").alias("gid"), F.min("ok").alias("first")),
                          f"{name}-classes")
    loads = spark.sparkContext.broadcast(_loads(sets))
    entries = sets.where("n > 0").select("gid", "sigs").mapInArrow(
        _entries(loads, percent), "gid long, n int, part int, rare array<int>")
    entries = materialize(entries.join(classes.select("gid"), "gid"), f"{name}-entries")
    loads.unpersist()
    tokens = entries.select("gid", "n", "part", F.posexplode("rare").alias("pos", "sig"))
    shared = materialize(tokens.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("sig"), f"{name}-shared")
    tokens = materialize(tokens.join(shared, "sig"), f"{name}-tokens")
    discard(entries, shared)
    index = tokens.select("gid", "n", "pos", "sig", F.explode(F.expr(
        "array(struct(part, true AS home), struct(part + 1 AS part, false AS home))")).alias("at"))
    index = index.select("gid", "n", "pos", "sig", "at.part", "at.home")
    # what is joined on a key that can be hot is written first: Spark can split a join between two plain shuffles
    heads = index.groupBy("part", "sig").agg(F.count(F.lit(1)).alias("c"), F.min(F.when(F.col("home"), F.struct(
        "pos", "gid", "n"))).alias("top")).where("c > 1 and top is not null")
    heads = materialize(heads.select("part", "sig", F.col("top.gid").alias("head"), F.col("top.n").alias("nh"),
                                     F.col("top.pos").alias("ph")), f"{name}-heads")
    index = materialize(index.join(heads, ["part", "sig"]), f"{name}-index")
    discard(tokens, heads)

    def able(nx: str, px: str, ny: str, py: str) -> Column:
        return F.expr(f"100 * least({nx}, {ny}) >= {percent} * greatest({nx}, {ny}) and "
                      f"{100 + percent} * least({nx} - {px}, {ny} - {py}) >= {percent} * ({nx} + {ny})")

    def near(pairs: DataFrame) -> DataFrame:
        p = pairs.join(sets.select(F.col("gid").alias("a"), F.col("sigs").alias("sa")), "a")
        p = p.join(sets.select(F.col("gid").alias("b"), F.col("sigs").alias("sb")), "b")
        p = p.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("both"),
                     (F.size("sa") + F.size("sb")).cast("long").alias("all"))
        return p.where(f"100L * both >= {percent} * (all - both)").select("a", "b")

    # 1. every class with the head of each of its lists
    links = index.where((F.col("gid") != F.col("head")) & able("n", "pos", "nh", "ph") & F.lit(star))
    links = links.select(F.greatest("gid", "head").alias("a"), F.least("gid", "head").alias("b")).distinct()
    comp = labels(near(links), f"{name}-star")
    # 2. what lies outside the component of a list's head with all that the list holds of other components
    member = materialize(classes.select("gid", "first").join(comp.withColumnRenamed("k", "gid"), "gid", "left").select(
        "gid", "first", F.coalesce("comp", "gid").alias("comp")), f"{name}-members")
    held = materialize(index.join(member.select("gid", "comp"), "gid"), f"{name}-held")
    discard(index, comp)
    open_ = materialize(held.groupBy("part", "sig").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(F.when(F.col("gid") == F.col("head"), F.col("comp")))
        .alias("main")).where("lo <> hi").select("part", "sig", "main"), f"{name}-open")
    held = held.join(open_, ["part", "sig"])
    x, y = (held.select("part", "sig", *[F.col(c).alias(c + s) for c in ("gid", "n", "pos", "home", "comp", "main")])
            for s in "xy")
    pairs = x.where("compx <> mainx").join(y, ["part", "sig"]).where(
        "compx <> compy and (homex or homey) and (compy = mainy or gidx < gidy)").where(able("nx", "posx", "ny", "posy"))
    pairs = pairs.select(F.greatest("gidx", "gidy").alias("a"), F.least("gidx", "gidy").alias("b")).distinct()
    by = member.select("gid", "comp")
    late = near(pairs).join(by.select(F.col("gid").alias("a"), F.col("comp").alias("ca")), "a").join(
        by.select(F.col("gid").alias("b"), F.col("comp").alias("cb")), "b")
    top = labels(late.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), f"{name}-late")
    # 3. the smallest id of every component, back to the rows
    final = materialize(member.join(top.select(F.col("k").alias("comp"), F.col("comp").alias("top")), "comp", "left").select(
        "gid", "first", F.coalesce("top", "comp").alias("comp")), f"{name}-components")
    least = materialize(final.groupBy("comp").agg(F.min("first").alias("head")), f"{name}-least")
    named = final.join(least, "comp").select("gid", "head").join(classes.select("gid", "key"), "gid").select("key", "head")
    of = sets.select("doc_id", "ok", "th", "n", "key").join(named, "key", "left").select(
        "doc_id", "ok", "th", "n", F.coalesce("head", "ok").alias("head"))
    of = materialize(of, f"{name}-groups")
    discard(sets, classes, held, open_, member, final, least)
    return of
