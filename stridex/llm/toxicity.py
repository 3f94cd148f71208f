"""Toxicity: a linear-chain conditional random field tags toxic words; its marginals make document scores.

Learning uses a bounded sample (``MAX_TRAIN_DOCS`` labelled documents by hash of their id, none longer than
``MAX_TRAIN_CHARS``, at most ``MAX_TRAIN_TEXTS`` of one id; those bounds touch the fit only). Labels are given per document, so words are labelled first: a
word of a toxic document is toxic if it is significantly more frequent in toxic than in clean sample texts (likelihood
ratio). The two-state chain is then fitted to these labelled words by gradient ascent on its likelihood, where the
gradient needs the forward-backward marginals. A logistic curve over a document's tagged words (the sum of their
marginals) and its largest marginal, fitted on the same sample, gives scores from 0 to 1.

Scoring is distributed: each Arrow batch is one long chain whose documents are kept apart by the start potentials.
It is cut into lanes; the products of the lanes' step matrices join them exactly, so numpy works on all lanes at once
and a very long text costs no more per word than a short one.

Defined results: null or wordless text gets the score of a document without a toxic word; a document with several
labels counts as toxic if one of them says so; without labelled rows of both kinds the score is the share of toxic
ones (0 without any). Rows are independent, repeated rows get equal results, other columns pass through.
"""
from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import read, remainder, ship_by_value, sub_batches

ship_by_value(__name__)

MAX_TRAIN_DOCS = 4000
MAX_TRAIN_CHARS = 20_000
MAX_TRAIN_TEXTS = 4          # different texts of one id
MAX_VOCABULARY = 1 << 16
MIN_RATIO_STAT = 16.0        # likelihood-ratio statistic from which a word counts as toxic
STEPS, RATE, PRIOR = 60, 0.3, 0.02
TAGGED = 0.5                 # marginal from which a word counts as tagged; lesser ones must not add up over long texts
LANE = 256                   # steps of a lane
_WORD = re.compile(r"[^\W\d_]+")


def _lanes(x: np.ndarray, fill: float) -> np.ndarray:
    """A chain of any length as (LANE, lanes), padded."""
    n = -(-len(x) // LANE)
    out = np.full(n * LANE, fill)
    out[:len(x)] = x
    return np.ascontiguousarray(out.reshape(n, LANE).T)


def marginals(weight: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray, pairs: bool = False):
    """P(state 1) of every position of the concatenated chains; with ``pairs`` the expected transition counts too.

    ``weight``: log potential of state 1 against state 0; ``first``: where a chain begins; ``trans``, ``start``: log
    potentials."""
    n = len(weight)
    a, p = np.exp(trans), np.exp(start)
    e = np.exp(np.clip(weight, -30, 30))
    m00, m10 = _lanes(np.where(first, p[0], a[0, 0]), 1.0), _lanes(np.where(first, p[0], a[1, 0]), 0.0)
    m01, m11 = _lanes(np.where(first, p[1], a[0, 1]) * e, 0.0), _lanes(np.where(first, p[1], a[1, 1]) * e, 1.0)
    lanes = m00.shape[1]
    q00, q01, q10, q11 = np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)
    for t in range(LANE):                                   # product of each lane's step matrices
        r00, r01 = q00 * m00[t] + q01 * m10[t], q00 * m01[t] + q01 * m11[t]
        r10, r11 = q10 * m00[t] + q11 * m10[t], q10 * m01[t] + q11 * m11[t]
        s = r00 + r01 + r10 + r11
        q00, q01, q10, q11 = r00 / s, r01 / s, r10 / s, r11 / s
    fwd, bwd = np.empty((lanes, 2)), np.empty((lanes, 2))   # state before a lane, potential after it
    v = (0.5, 0.5)
    for k, (x00, x01, x10, x11) in enumerate(zip(q00.tolist(), q01.tolist(), q10.tolist(), q11.tolist())):
        fwd[k] = v
        v0, v1 = v[0] * x00 + v[1] * x10, v[0] * x01 + v[1] * x11
        v = (v0 / (v0 + v1), v1 / (v0 + v1))
    v = (0.5, 0.5)
    for k in range(lanes - 1, -1, -1):
        bwd[k] = v
        v0, v1 = q00[k] * v[0] + q01[k] * v[1], q10[k] * v[0] + q11[k] * v[1]
        v = (v0 / (v0 + v1), v1 / (v0 + v1))
    f0, f1 = np.empty((LANE + 1, lanes)), np.empty((LANE + 1, lanes))
    f0[0], f1[0] = fwd[:, 0], fwd[:, 1]
    for t in range(LANE):
        x0, x1 = f0[t] * m00[t] + f1[t] * m10[t], f0[t] * m01[t] + f1[t] * m11[t]
        s = x0 + x1
        f0[t + 1], f1[t + 1] = x0 / s, x1 / s
    b0, b1 = bwd[:, 0].copy(), bwd[:, 1].copy()
    out = np.empty((LANE, lanes))
    moved = np.zeros((2, 2))
    inner = _lanes(np.where(first, 0.0, 1.0), 0.0) if pairs else None
    for t in range(LANE - 1, -1, -1):
        x1 = f1[t + 1] * b1
        out[t] = x1 / (x1 + f0[t + 1] * b0)
        y00, y01, y10, y11 = m00[t] * b0, m01[t] * b1, m10[t] * b0, m11[t] * b1
        if pairs:
            z = np.array([[f0[t] * y00, f0[t] * y01], [f1[t] * y10, f1[t] * y11]])
            moved += (z * (inner[t] / z.sum(axis=(0, 1)))).sum(axis=2)
        b0, b1 = y00 + y01, y10 + y11
        s = b0 + b1
        b0, b1 = b0 / s, b1 / s
    p1 = out.T.reshape(-1)[:n]
    return (p1, moved) if pairs else p1


@dataclass
class ToxicityModel:
    vocabulary: dict[str, int] = field(repr=False, default_factory=dict)     # word -> position in ``weight``, from 1
    weight: np.ndarray = field(repr=False, default_factory=lambda: np.zeros(1))
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    curve: np.ndarray = field(default_factory=lambda: np.array([-50.0, 0.0, 0.0]))

    def encode(self, texts: list[str]):
        """(word ids of all texts, first-word flags, words of each text)."""
        get, ids, n = self.vocabulary.get, [], []
        for t in texts:
            ws = [get(w, 0) for w in map(str.lower, _WORD.findall(t))]
            ids.extend(ws)
            n.append(len(ws))
        n = np.array(n, np.int64)
        first = np.zeros(len(ids), bool)
        first[(np.cumsum(n) - n)[n > 0]] = True
        return np.array(ids, np.int64), first, n

    def tag(self, texts: list[str]):
        """P(toxic) of every word, and the words of each text."""
        ids, first, n = self.encode(texts)
        p = marginals(self.weight[ids], first, self.trans, self.start) if len(ids) else np.zeros(0)
        return p, n

    def _features(self, p: np.ndarray, n: np.ndarray) -> np.ndarray:
        x = np.zeros((len(n), 3))
        x[:, 0] = 1
        at = (np.cumsum(n) - n)[n > 0]
        if len(at):
            x[n > 0, 1] = np.log1p(np.add.reduceat(np.where(p >= TAGGED, p, 0.0), at))
            x[n > 0, 2] = np.maximum.reduceat(p, at)
        return x

    def scores(self, texts: list[str]):
        """(document scores, word marginals, words of each text)."""
        p, n = self.tag(texts)
        return 1 / (1 + np.exp(-np.clip(self._features(p, n) @ self.curve, -40, 40))), p, n


def spans(text: str, p: np.ndarray, threshold: float = TAGGED) -> list[tuple[int, int, float]]:
    """(start, stop, largest marginal) of the runs of words whose marginal reaches the threshold."""
    out = []
    hot = p >= threshold
    if hot.any():
        for k, m in enumerate(_WORD.finditer(text)):
            if hot[k]:
                if out and out[-1][3] == k - 1:
                    out[-1] = (out[-1][0], m.end(), max(out[-1][2], float(p[k])), k)
                else:
                    out.append((m.start(), m.end(), float(p[k]), k))
    return [x[:3] for x in out]


def toxic_words(texts: list[str], toxic: np.ndarray) -> set[str]:
    """Words significantly more frequent in toxic than in clean texts (by texts that have them)."""
    seen = [Counter(), Counter()]
    for t, y in zip(texts, toxic):
        seen[int(y)].update(set(map(str.lower, _WORD.findall(t))))
    n1, n0 = float(toxic.sum()), float((~toxic).sum())
    out = set()
    for w, a in seen[1].items():
        b = seen[0][w]
        if a / n1 > b / n0:
            rate = (a + b) / (n1 + n0)
            g = 2 * (a * np.log(a / (n1 * rate)) + (b * np.log(b / (n0 * rate)) if b else 0.0))
            if g >= MIN_RATIO_STAT:
                out.add(w)
    return out


def fit(texts: list[str], toxic: list[bool]) -> ToxicityModel:
    """The model of labelled texts (a bounded sample); equal texts count once."""
    by: dict[str, bool] = {}
    for t, y in zip(texts, toxic):
        by[t] = by.get(t, False) or bool(y)
    texts, y = list(by), np.array(list(by.values()), bool)
    if not y.any() or y.all():
        share = y.mean() if len(y) else 0.0
        return ToxicityModel(curve=np.array([50.0 if share else -50.0, 0.0, 0.0]))
    bad = toxic_words(texts, y)
    df = Counter(w for t in texts for w in set(map(str.lower, _WORD.findall(t))))
    words = sorted((w for w, c in df.items() if c > 1 or w in bad), key=lambda w: (w not in bad, -df[w], w))
    model = ToxicityModel({w: i + 1 for i, w in enumerate(words[:MAX_VOCABULARY - 1])})
    ids, first, n = model.encode(texts)
    size = len(model.vocabulary) + 1
    is_bad = np.zeros(size, bool)
    is_bad[[model.vocabulary[w] for w in bad if w in model.vocabulary]] = True
    label = is_bad[ids] & np.repeat(y, n)
    prev, cur = label[:-1][~first[1:]], label[1:][~first[1:]]
    seen = np.array([[(~prev & ~cur).sum(), (~prev & cur).sum()], [(prev & ~cur).sum(), (prev & cur).sum()]], float)
    begun = np.array([(~label[first]).sum(), label[first].sum()], float)
    weight, trans, start = np.zeros(size), np.zeros((2, 2)), np.zeros(2)
    params = [weight, trans, start]
    first_moment, second = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
    hits = np.bincount(ids, label, size)
    for k in range(1, STEPS + 1):
        p, moved = marginals(weight[ids], first, trans, start, pairs=True)
        q = np.array([(1 - p[first]).sum(), p[first].sum()])
        for x, g, m1, m2 in zip(params, (hits - np.bincount(ids, p, size), seen - moved, begun - q), first_moment, second):
            g = g - PRIOR * x
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            x += RATE * (m1 / (1 - 0.9 ** k)) / (np.sqrt(m2 / (1 - 0.99 ** k)) + 1e-6)
    model.weight, model.trans, model.start = weight, trans, start
    x = model._features(marginals(weight[ids], first, trans, start), n)
    curve = np.zeros(3)
    ridge = np.diag([1e-6, 0.1, 0.1])
    for _ in range(30):                                     # Newton steps of the logistic curve
        q = 1 / (1 + np.exp(-np.clip(x @ curve, -40, 40)))
        step = np.linalg.solve((x.T * (q * (1 - q) + 1e-9)) @ x + ridge, x.T @ (y - q) - ridge @ curve)
        curve = curve + np.clip(step, -4, 4)
    model.curve = curve
    return model


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN_DOCS, chars: int = MAX_TRAIN_CHARS,
          texts: int = MAX_TRAIN_TEXTS) -> ToxicityModel:
    """Fit on at most ``limit`` labelled documents of at most ``chars`` characters, by hash of the id. Repeated rows count
    once; of an id with several texts at most ``texts`` are used, the further ones after all ids' first."""
    y = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    d = docs.where(F.col("text").isNotNull() & (F.length("text") <= chars))
    ids = d.select("doc_id").join(y, "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = d.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "toxic").distinct()
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text"))
    rows = rows.withColumn("nth", nth).where(F.col("nth") <= texts)
    rows = rows.orderBy("nth", F.xxhash64("doc_id"), "doc_id").limit(limit).toPandas().sort_values(["doc_id", "text"])
    return fit(rows["text"].tolist(), (rows["toxic"] > 0).tolist())


def toxicity(spark: SparkSession, model: ToxicityModel, text: Column, with_spans: bool = True) -> Column:
    """Struct (score, spans array of (start, stop, p)) of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("score double, spans array<struct<start:int,stop:int,p:double>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        ts = ["" if t is None else t for t in texts.tolist()]
        score, found = np.zeros(len(ts)), [[] for _ in ts]
        for i, j in sub_batches(ts):
            score[i:j], p, n = shared.value.scores(ts[i:j])
            if with_spans:
                end = np.cumsum(n)
                for k in np.flatnonzero(np.add.reduceat(p >= TAGGED, (end - n)[n > 0]) > 0) if len(p) else ():
                    k = int(np.flatnonzero(n > 0)[k])
                    found[i + k] = [dict(zip(("start", "stop", "p"), s))
                                    for s in spans(ts[i + k], p[end[k] - n[k]:end[k]])]
        return pd.DataFrame({"score": score, "spans": found})
    return run(text)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labelled documents that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    part = remainder(F.col("doc_id"), 5)
    model = train(docs.where(part > 0), read(spark, sf_dir, "labels").where(part > 0).select("doc_id", "toxic"))
    t = docs.select("doc_id", (part == 0).alias("held_out"),
                    toxicity(spark, model, F.col("text")).alias("t"))
    return t.select("doc_id", "held_out", "t.score", (F.col("t.score") >= 0.5).cast("int").alias("predicted"),
                    F.size("t.spans").alias("n_spans"))
