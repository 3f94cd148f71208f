"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of every labelled document in one pass: a task keeps a row of counts per language, at most
``TASK_LANGUAGES`` at a time, and emits them as one binary row per language, which the reducers add up as they come. The
log-probability matrix has at most ``MAX_MODEL_MB`` and is broadcast; scoring is a gather and a segmented sum per Arrow
batch. More languages than one matrix holds (a dirty column) are dealt into blocks by hash; the blocks are trained and
scored one after the other and the best language and the evidence of all blocks are put together per document.

Defined results: null text or text without a letter is ``und`` with score 0; rows with null or empty language teach
nothing; a tie goes to the first language in code point order; no learnable row at all makes every prediction ``und``.
Texts of any length are scored whole, in one sub-batch of their own if they are long; an empty table gives no rows. Rows are independent: repeated
rows get equal results, and further columns of the input pass through untouched.
"""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import materialize
from ._common import read, remainder, ship_by_value, sub_batches, worker_cache

ship_by_value(__name__)

BUCKETS = 1 << 15          # hashed n-gram space
ORDERS = (2, 3)            # n-gram lengths
ALPHA = 0.5                # additive smoothing
MAX_MODEL_MB = 256         # of a matrix; reached at 2,000 languages with the default space, which make a block
TASK_LANGUAGES = 256       # rows of counts that a task holds at a time


def _letters() -> np.ndarray:
    """Code point -> lower-case letter, or a blank for everything that is no letter."""
    cache = worker_cache()
    if "letters" not in cache:
        t = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                t[c] = ord(low) if len(low) == 1 else c
        cache["letters"] = t
    return cache["letters"]


def _grams(texts: list[str], orders: tuple[int, ...], buckets: int):
    """(bucket, document) of every n-gram, in document order for each n, and which documents have a letter.

    A document is its letters, lower case, each run of other characters (and either end) as one blank; n-grams do not
    cross documents."""
    table = _letters()
    raw = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    cp = table[raw]
    size = np.array([len(t) for t in texts])
    starts = np.concatenate([[0], np.cumsum(size + 1)])    # positions of the separating blanks
    blank = cp == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[starts] = True                                    # every separator stays: it opens a document
    new = np.cumsum(keep) - 1
    edge = new[starts]
    cp = cp[keep].astype(np.uint64)
    doc = np.zeros(len(cp), np.int32)
    doc[edge[1:-1]] = 1
    doc = np.cumsum(doc)
    has = np.add.reduceat((cp != 32).astype(np.int64), edge[:-1]) > 0
    out = []
    for n in orders:
        if len(cp) < n:
            continue
        h = np.zeros(len(cp) - n + 1, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x1F123BB5) + cp[k:len(cp) - n + 1 + k]
        h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        end = edge[1:][doc[:len(h)]]
        ok = np.arange(len(h)) + n - 1 <= end              # the closing blank belongs to the document too
        for k in range(n - 1):                             # a blank run before the closing blank is one with it
            ok &= ~((cp[k:k + len(h)] == 32) & (cp[k + 1:k + 1 + len(h)] == 32))
        out.append(((h % np.uint64(buckets)).astype(np.int64)[ok], doc[:len(h)][ok]))
    return out, has


@dataclass
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray = field(repr=False)      # (buckets, languages), float32
    log_prior: np.ndarray = field(repr=False)
    orders: tuple[int, ...] = ORDERS

    def predict(self, texts: list[str]):
        """(language or und, posterior of it) of every text."""
        n, names = len(self.languages), np.array([*self.languages, "und"], object)
        pick, score = np.full(len(texts), n), np.zeros(len(texts))
        for i, j in sub_batches(texts) if n else ():
            total, has = self._sums(texts[i:j])
            best = total.argmax(axis=1)
            post = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            pick[i:j], score[i:j] = np.where(has, best, n), np.where(has, post, 0.0)
        return names[pick], score

    def _sums(self, texts: list[str]):
        """Log probabilities (text, language), up to the text's own, and which texts have a letter."""
        grams, has = _grams(texts, self.orders, len(self.log_prob))
        total = np.tile(self.log_prior.astype(np.float64), (len(texts), 1))
        for bucket, doc in grams:
            if len(bucket):
                first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                total[doc[first]] += np.add.reduceat(np.take(self.log_prob, bucket, axis=0), first, axis=0, dtype=np.float64)
        return total, has

    def evidence(self, texts: list[str]):
        """(best language or None, its log probability, logarithm of the sum of all languages') of every text."""
        n = len(self.languages)
        pick, best, total = np.full(len(texts), n), np.full(len(texts), -np.inf), np.full(len(texts), -np.inf)
        for i, j in sub_batches(texts) if n else ():
            each, has = self._sums(texts[i:j])
            top = each.max(axis=1)
            pick[i:j], best[i:j] = np.where(has, each.argmax(axis=1), n), top
            total[i:j] = top + np.log(np.exp(each - top[:, None]).sum(axis=1))
        return np.array([*self.languages, None], object)[pick], best, total


def count_ngrams(labelled: DataFrame, text: str = "text", lang: str = "lang", orders=ORDERS,
                 buckets: int = BUCKETS) -> DataFrame:
    """(lang, docs, counts) over all labelled rows: the counts of all buckets as 64-bit integers in one binary value."""
    kinds = "lang string, docs long, counts binary"

    def emit(rows: dict[str, list]):
        for x, (n, cells) in rows.items():
            yield pd.DataFrame({"lang": [x], "docs": [n], "counts": [cells.tobytes()]})

    def count(frames):
        rows: dict[str, list] = {}
        for pdf in frames:
            texts, langs = pdf["t"].tolist(), pdf["l"].tolist()
            for i, j in sub_batches(texts):
                names = sorted(set(langs[i:j]))
                code = np.array([names.index(x) for x in langs[i:j]])
                if len(rows) + len(names) > TASK_LANGUAGES:
                    yield from emit(rows)
                    rows = {}
                grams = _grams(texts[i:j], orders, buckets)[0]
                for k in range(0, len(names), TASK_LANGUAGES):
                    some = names[k:k + TASK_LANGUAGES]
                    cells = np.zeros(len(some) * buckets, np.int64)
                    for bucket, doc in grams:
                        at = code[doc] - k
                        mine = (at >= 0) & (at < len(some))
                        cells += np.bincount(at[mine] * buckets + bucket[mine], minlength=len(cells))
                    for m, x in enumerate(some):
                        old = rows.get(x, (0, 0))
                        rows[x] = [old[0] + int((code == k + m).sum()), old[1] + cells[m * buckets:(m + 1) * buckets]]
                    if len(rows) > TASK_LANGUAGES:
                        yield from emit(rows)
                        rows = {}
        yield from emit(rows)

    def add(frames):                                       # rows come sorted by language
        held = None
        for pdf in frames:
            for x, n, raw in zip(pdf["lang"], pdf["docs"], pdf["counts"]):
                cells = np.frombuffer(raw, np.int64)
                if held is not None and held[0] == x:
                    held = [x, held[1] + n, held[2] + cells]
                else:
                    if held is not None:
                        yield from emit({held[0]: held[1:]})
                    held = [x, n, cells]
        if held is not None:
            yield from emit({held[0]: held[1:]})

    rows = labelled.select(F.col(text).alias("t"), F.col(lang).alias("l")).where("t is not null and l <> ''")
    return rows.mapInPandas(count, kinds).repartition("lang").sortWithinPartitions("lang").mapInPandas(add, kinds)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", orders=ORDERS, buckets: int = BUCKETS,
          alpha: float = ALPHA, block: int = 0, blocks: int = 1, rows: int | None = None) -> LanguageModel:
    """The model of all labelled rows, or of the languages of one of ``blocks`` blocks (then ``rows`` is the number of all
    labelled rows). What reaches the driver is one row of counts per language of the block."""
    if blocks > 1:
        labelled = labelled.where(F.pmod(F.xxhash64(lang), F.lit(blocks)) == block)
    got = sorted(count_ngrams(labelled, text, lang, orders, buckets).collect(), key=lambda r: r["lang"])
    docs = np.array([r["docs"] for r in got], float)
    cells = np.zeros((buckets, len(got)), np.float32)
    for i, r in enumerate(got):
        n = np.frombuffer(bytes(r["counts"]), np.int64)
        cells[:, i] = np.log((n + alpha) / (n.sum() + alpha * buckets))
    prior = np.log(docs / (docs.sum() if rows is None else rows)) if len(got) else docs
    return LanguageModel([r["lang"] for r in got], cells, prior, tuple(orders))


def identify(docs: DataFrame, labelled: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS,
             limit_mb: int = MAX_MODEL_MB) -> DataFrame:
    """(doc, p) of every row of ``docs``: the row as a struct and a struct (lang_pred, score), learned from ``labelled``."""
    spark = docs.sparkSession
    known = labelled.where(F.col(text).isNotNull() & (F.col(lang) != ""))
    languages, n = known.agg(F.countDistinct(lang), F.count(F.lit(1))).first()
    blocks = max(1, int(-(-languages * buckets * 4 // (limit_mb * 1_000_000))))
    if blocks == 1:
        return docs.select(F.struct("*").alias("doc"), predict(spark, train(known, text, lang, buckets=buckets), F.col(text)).alias("p"))
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "language-rows")
    found = None
    for b in range(blocks):
        shared = spark.sparkContext.broadcast(train(known, text, lang, buckets=buckets, block=b, blocks=blocks, rows=n))
        one = materialize(rows.select("row", _evidence(shared)(F.col(f"doc.`{text}`")).alias("e")).select("row", "e.*"), "language-evidence")
        shared.unpersist()
        found = one if found is None else found.unionByName(one)
    # the best of all blocks; equal ones go by the name's code points
    best = found.where("lang is not null").groupBy("row").agg(
        F.max(F.struct("best", F.concat(F.transform(F.split("lang", ""), lambda c: -F.ascii(c)), F.array(F.lit(1)))
                       .alias("first"), "lang")).alias("top"),
        F.max("total").alias("most"), F.collect_list("total").alias("totals"))                # a value per block
    best = best.select("row", F.struct(F.col("top.lang").alias("lang_pred"), F.expr(
        "exp(top.best - most) / aggregate(totals, 0D, (a, x) -> a + exp(x - most))").alias("score")).alias("p"))
    none = F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.join(best, "row", "left").select("doc", F.coalesce("p", none).alias("p"))


def _evidence(shared):
    @F.pandas_udf("lang string, best double, total double")
    def run(texts: pd.Series) -> pd.DataFrame:
        lang, best, total = shared.value.evidence(["" if t is None else t for t in texts.tolist()])
        return pd.DataFrame({"lang": lang, "best": best, "total": total})
    return run


def predict(spark: SparkSession, model: LanguageModel, text: Column) -> Column:
    """Struct (lang_pred, score) of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def score(texts: pd.Series) -> pd.DataFrame:
        names, post = shared.value.predict(["" if t is None else t for t in texts.tolist()])
        return pd.DataFrame({"lang_pred": names, "score": post})
    return score(text)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    docs = read(spark, sf_dir, "documents")
    held = remainder(F.col("doc_id"), 3)
    got = identify(docs.select("doc_id", "text"), docs.where((held != 1) & (held >= 0)).select("text", "lang"))
    return got.select("doc.doc_id", (remainder(F.col("doc.doc_id"), 3) == 1).alias("held_out"), "p.lang_pred", "p.score")
