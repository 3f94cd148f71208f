"""Ranked lexical search: exact top-k inner products of sparse term vectors by ball trees.

A document is the sparse vector of its terms' impacts, ``(10**9 * tf) div (1000 * tf + 8 * m)`` with the length norm ``m``; an
item is the vector of its terms' weights times their repeats; the score is the inner product, in 64-bit integers.

1. One scan of the texts keeps, per document, its number of terms and the frequencies of those terms that any item of the
   block asks for (all others contribute nothing), as a table; number of documents, total length and document frequencies
   are counted over that table.
2. Tasks read their documents in chunks of at most ``CHUNK_DOCS`` documents or ``CHUNK_TERMS`` entries and build a ball
   tree of each: a node is a centroid and a radius, a split sends documents to the nearer of two far apart ones, half each.
3. For each item the tree is searched best first: no document of a ball can score above ``<q, c> + |q| r``. The bound is
   taken in doubles and rounded up by more than their error (all terms are at least 0, so that error is relative), so a
   subtree goes only if it can't reach the score of the item's k-th best document that the task has seen so far, over all
   its chunks. Leaves are scored in integers.
4. A task's k best documents of each item meet in one window per item.

Items are searched in blocks of about ``ITEM_CHARS`` characters, so what is broadcast has a bound however many items
there are; every block is searched in all documents.

Defined results: null texts and texts without a term have no terms and are not counted in N; items without a term, or whose
terms no document has, return nothing; rows of one item_id are one item; equal scores go by ascending id, null ids last;
repeated rows are documents of their own; long texts are read whole; empty tables give no rows; further columns are ignored.
"""
from __future__ import annotations

import heapq
import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import discard, materialize
from ._common import lower_ascii, read, ship_by_value
from ._repeats import LAST

ship_by_value(__name__)

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
ITEM_CHARS = 100_000
CHUNK_DOCS, CHUNK_TERMS = 2048, 1 << 20
LEAF = 8
GROUPS = 512                  # column groups with a radius of their own
# Byte map of the terms: A-Z to lower case, every other ASCII byte that is no letter or digit to a blank.
_MAP = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class BallTree:
    """Ball tree over sparse rows: row i holds ``value[ptr[i]:ptr[i + 1]]`` at the columns ``column[ptr[i]:ptr[i + 1]]``.

    ``scale`` is a positive factor per column: distances are taken between scaled rows, and a query is divided by it. Columns
    of similar scale share a radius, ``groups`` of them in all.
    Every row must hold at least one entry. ``order[start:stop]`` are a node's rows; the arrays are kept in that order."""

    def __init__(self, ptr, column, value, scale, leaf: int = LEAF, groups: int = GROUPS):
        self.scale, groups = scale, min(groups, len(scale))
        self.group = np.empty(len(scale), np.int64)
        self.group[np.argsort(scale, kind="stable")] = np.arange(len(scale)) * groups // len(scale)
        x = value * scale[column]
        length = np.diff(ptr)
        square = np.add.reduceat(x * x, ptr[:-1])
        width, n = len(scale), len(length)

        def entries(rows):
            m = length[rows]
            first = np.cumsum(m) - m
            at = np.repeat(ptr[rows] - first, m) + np.arange(int(m.sum()))
            return column[at], x[at], first

        def off(node, point, c, v, first):             # squared distances, never below the true ones
            cross = np.add.reduceat(v * point[c], first)
            norm = float(point @ point)
            return np.maximum(square[node] + norm - 2 * cross, 0) + 1e-9 * (square[node] + norm)

        def radii(mean, c, v, first):                  # largest distance in each group, never below the true one
            n, g = len(first), self.group[c]
            row = np.repeat(np.arange(n), np.diff(np.append(first, len(c)))) * groups
            still = np.bincount(self.group, weights=mean * mean, minlength=groups)
            moved = np.bincount(row + g, weights=(v - mean[c]) ** 2 - mean[c] ** 2, minlength=n * groups).reshape(n, groups)
            most = np.bincount(row + g, weights=v * v, minlength=n * groups).reshape(n, groups).max(axis=0)
            return np.sqrt(np.maximum(moved.max(axis=0) + still, 0) + 1e-9 * (most + still)) * (1 + 1e-9)

        def dense(row):
            p = np.zeros(width)
            p[column[ptr[row]:ptr[row + 1]]] = x[ptr[row]:ptr[row + 1]]
            return p

        self.order = np.arange(n)
        self.nodes, center, radius = [], [], []        # [start, stop, left or -1, right or -1]
        open_ = [(0, n, None, 0)]
        while open_:
            b, e, parent, side = open_.pop()
            rows = self.order[b:e]
            c, v, first = entries(rows)
            mean = np.bincount(c, weights=v, minlength=width) / (e - b)
            far = off(rows, mean, c, v, first)
            self.nodes.append([b, e, -1, -1])
            center.append(mean)
            radius.append(radii(mean, c, v, first))
            if parent is not None:
                self.nodes[parent][2 + side] = len(self.nodes) - 1
            if e - b > leaf:
                one = off(rows, dense(rows[int(far.argmax())]), c, v, first)
                two = off(rows, dense(rows[int(one.argmax())]), c, v, first)
                half = (e - b) // 2
                self.order[b:e] = rows[np.argpartition(one - two, half)]
                k = len(self.nodes) - 1
                open_ += [(b, b + half, k, 0), (b + half, e, k, 1)]
        self.center, self.radius = np.array(center), np.array(radius)
        m = length[self.order]
        self.ptr = np.concatenate([[0], np.cumsum(m)])
        at = np.repeat(ptr[self.order] - self.ptr[:-1], m) + np.arange(int(m.sum()))
        self.column, self.value = column[at], value[at]

    def bounds(self, columns, weights) -> np.ndarray:
        """Per node, a number that no inner product of its rows with the query exceeds (rows and query at least 0)."""
        q = weights / self.scale[columns]
        part = np.sqrt(np.bincount(self.group[columns], weights=q * q, minlength=self.radius.shape[1]))
        top = self.center[:, columns] @ q + self.radius @ part
        return top * (1 + 1e-9) + 1

    def search(self, columns, weights, k: int, best: list, ids) -> int:
        """Update ``best``, a heap of (score, -id) of at most ``k``, with this tree's rows; the number of leaves scored."""
        top = self.bounds(columns, weights).tolist()
        q = np.zeros(len(self.scale), np.int64)
        q[columns] = weights
        heap, leaves = [(-top[0], 0)], 0
        while heap:
            bound, node = heapq.heappop(heap)
            least = best[0][0] if len(best) == k else 1
            if -bound < least:
                break
            b, e, left, right = self.nodes[node]
            if left >= 0:
                heapq.heappush(heap, (-top[left], left))
                heapq.heappush(heap, (-top[right], right))
                continue
            leaves += 1
            part = slice(self.ptr[b], self.ptr[e])
            score = np.add.reduceat(self.value[part] * q[self.column[part]], self.ptr[b:e] - self.ptr[b])
            for i in np.flatnonzero(score >= least).tolist():
                found = (int(score[i]), -int(ids[self.order[b + i]]))
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return leaves


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term, c): the terms of every item and their repeats."""
    t = F.regexp_extract_all(lower_ascii(F.col(text)), F.lit(f"({TERM})"), F.lit(1))
    return items.select(F.col(item_id).alias("item_id"), F.explode(t).alias("term")).groupBy("item_id", "term").agg(
        F.count(F.lit(1)).alias("c"))


def term_vectors(docs: DataFrame, vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, ids, tf): number of terms of every document that has any, and frequencies of those in the vocabulary.
    ``vocabulary``: a broadcast dict of UTF-8 terms and their numbers."""
    def run(batches):
        number = vocabulary.value
        for b in batches:
            keep, n, ids, tfs = [], [], [], []
            for i, raw in enumerate(b.column("raw").to_pylist()):
                words = raw.translate(_MAP).split()
                if words:
                    count = Counter(filter(None, map(number.get, words)))      # numbers start at 1
                    keep.append(i), n.append(len(words))
                    ids.append(list(count)), tfs.append(list(count.values()))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()),
                 pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))], names=["doc_id", "n", "ids", "tf"])
    d = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"),
                                                   F.col(text).cast("binary").alias("raw"))
    return d.mapInArrow(run, "doc_id long, n long, ids array<int>, tf array<int>")


def _chunks(batches):
    """(ids or LAST, n, ptr, columns, tf) of chunks of documents that have a term of the vocabulary."""
    held, docs, entries = [], 0, 0
    for b in batches:
        size = pa.compute.list_value_length(b.column("ids")).to_numpy(zero_copy_only=False)
        b = b.filter(pa.array(size > 0))
        size, at = size[size > 0], 0
        while at < len(size):
            room = np.searchsorted(np.cumsum(size[at:]), CHUNK_TERMS - entries, "right")
            take = max(min(int(room), CHUNK_DOCS - docs), 0 if held else 1)
            if take:
                held.append(b.slice(at, take))
                docs, entries, at = docs + take, entries + int(size[at:at + take].sum()), at + take
            if at < len(size):
                yield _arrays(held)
                held, docs, entries = [], 0, 0
    if held:
        yield _arrays(held)


def _arrays(held):
    t = pa.Table.from_batches(held).combine_chunks()
    ids, tf = t.column("ids").combine_chunks(), t.column("tf").combine_chunks()
    size = pa.compute.list_value_length(ids).to_numpy(zero_copy_only=False)
    return (t.column("doc_id").fill_null(LAST).to_numpy(), t.column("n").to_numpy(),
            np.concatenate([[0], np.cumsum(size)]).astype(np.int64), ids.flatten().to_numpy(), tf.flatten().to_numpy())


def _searcher(shared, k: int):
    """Tasks search their documents for all items of the block: at most ``k`` rows (item, doc_id, score) of each item."""
    def run(batches):
        s = shared.value
        best = [[] for _ in s["queries"]]
        for ids, n, ptr, column, tf in _chunks(batches):
            m = np.array([25 + 75 * x * s["N"] // s["L"] for x in n.tolist()], np.int64)
            tf = tf.astype(np.int64)
            impact = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, np.diff(ptr)))
            # only the columns of this chunk, so that centroids are as narrow as they can be
            used, column = np.unique(column, return_inverse=True)
            place = np.full(len(s["weight"]), -1)
            place[used] = np.arange(len(used))
            tree = BallTree(ptr, column, impact, np.sqrt(np.maximum(s["weight"][used], 1)))
            for q, (columns, weights) in enumerate(s["queries"]):
                c = place[columns]
                if (c >= 0).any():
                    tree.search(c[c >= 0], weights[c >= 0], k, best[q], ids)
        rows = [(q, -d, x) for q, top in enumerate(best) for x, d in top]
        for i in range(0, len(rows), 100_000):
            q, d, x = zip(*rows[i:i + 100_000])
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(d, pa.int64()), pa.array(x, pa.int64())],
                                             names=["q", "doc_id", "score"])
    return run


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _search_block(docs: DataFrame, terms: list, k: int, doc_id: str, text: str) -> DataFrame:
    """(item_id, doc_id, score), at most ``k`` rows of each item and task, for the items of collected term rows."""
    spark = docs.sparkSession
    vocabulary = {t: i + 1 for i, t in enumerate(sorted({r["term"] for r in terms}))}
    by_item: dict = {}
    for r in terms:
        by_item.setdefault(r["item_id"], []).append((vocabulary[r["term"]], r["c"]))
    words = spark.sparkContext.broadcast({t.encode("utf-8"): i for t, i in vocabulary.items()})
    vectors = materialize(term_vectors(docs, words, doc_id, text), "search-vectors")
    words.unpersist()
    n, total = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r["t"]: r["c"] for r in vectors.select(F.explode("ids").alias("t")).groupBy("t").agg(
        F.count(F.lit(1)).alias("c")).collect()}                     # at most as many as the block has terms
    w = np.zeros(len(vocabulary) + 1, np.int64)
    for t, c in df.items():
        w[t] = weight(n, c)
    names, queries = list(by_item), []
    for name in names:
        columns, repeats = (np.array(x, np.int64) for x in zip(*sorted(by_item[name])))
        queries.append((columns, w[columns] * repeats))
    shared = spark.sparkContext.broadcast({"queries": queries, "weight": w, "N": n, "L": max(total, 1)})
    found = materialize(vectors.mapInArrow(_searcher(shared, k), "q int, doc_id long, score long"), "search-found")
    shared.unpersist()
    discard(vectors)
    of = spark.createDataFrame(list(enumerate(names)), "q int, item_id long")
    return found.join(F.broadcast(of), "q").select("item_id", F.when(F.col("doc_id") < LAST, F.col("doc_id")).alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, item_id: str = "item_id", doc_id: str = "doc_id",
           text: str = "text", limit: int = ITEM_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): every item's ``k`` highest-scoring documents."""
    chars = items.agg(F.sum(F.length(text))).first()[0] or 0
    blocks = max(1, -(-int(chars) // limit))
    terms = materialize(item_terms(items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
                                   .where("item_id is not null")), "search-items")
    found = []
    for b in range(blocks):
        part = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()      # about ``limit`` characters
        if part:
            found.append(_search_block(docs, part, k, doc_id, text))
    if not found:
        found = [docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")]
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return reduce(DataFrame.unionByName, found).select("*", F.row_number().over(best).alias("rank")).where(
        F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(read(spark, sf_dir, "documents").select("doc_id", "text"),
                  read(spark, sf_dir, "benchmark").select("item_id", "text"))


_TERMS_SQL = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS_SQL} AS w FROM documents WHERE text IS NOT NULL),
doc AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY ALL),
stat AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM doc),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
q AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest({_TERMS_SQL}) AS t FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, r, doc_id, sum(c * floor(1000 * ln((2 * nn + 2) / (2 * df + 1)))::BIGINT
             * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nn) // ll))))::BIGINT AS score
      FROM q JOIN df USING (t) JOIN tf USING (t) JOIN doc USING (r), stat GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""
