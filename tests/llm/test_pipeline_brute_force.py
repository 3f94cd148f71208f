"""The pipeline, stage by stage on its predecessor's rows, against plain Python."""
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from helpers import base_spans, brute_components, lower, odd_rows, sentence, write
from test_documents import brute_targets
from test_text_models import bench_rows, toxic_rows

import corpus_pipeline as P
from stridex.llm import toxicity as X
from stridex.llm._common import read, remainder
from stridex.llm.secrets import MAX_OWNERS, PLACEHOLDER
from pyspark.sql import functions as F


def brute_score(model, text):
    """Features and curve of one text from the plain forward and backward recursions of its own chain."""
    words = [w.lower() for w in X._WORD.findall(text or "")]
    p = []
    if words:
        emit = [np.exp(np.array([0.0, np.clip(model.weight[model.vocabulary.get(w, 0)], -30, 30)])) for w in words]
        a, f = np.exp(model.trans), [np.exp(model.start) * emit[0]]
        for e in emit[1:]:
            f.append((f[-1] / f[-1].sum()) @ a * e)
        b = np.ones(2)
        for t in range(len(words) - 1, -1, -1):
            g = f[t] * b
            p.append(g[1] / g.sum())
            b = a @ (emit[t] * b)
            b /= b.sum()
    x = np.array([1.0, math.log1p(sum(y for y in p if y >= X.TAGGED)), max(p, default=0.0)])
    return 1 / (1 + math.exp(-float(x @ model.curve)))


def brute_decontaminated(rows, bench):
    pat = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = set()
    for i, t in bench:
        w = pat.findall(lower(t or ""))
        if i is not None and w:
            wins |= {tuple(w[k:k + 10]) for k in range(max(len(w) - 10, 0) + 1)}
    sizes, out = {len(x) for x in wins}, []
    for r in rows:
        at = [m.span() for m in pat.finditer(lower(r[1] or ""))]
        w = pat.findall(lower(r[1] or ""))
        hit = [False] * len(w)
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit[k:k + n] = [True] * n
        if sum(hit) > P.MAX_HIT_SHARE * len(w):
            continue
        t, k = r[1], len(w) - 1
        while k >= 0:                                    # runs of hit words go, from the last to the first
            if hit[k]:
                e = at[k][1]
                while k > 0 and hit[k - 1]:
                    k -= 1
                t = t[:at[k][0]] + t[e:]
            k -= 1
        out.append((r[0], t, *r[2:]))
    return out


def brute_masked(rows):
    owners = defaultdict(set)
    for r in rows:
        for *_, v in base_spans(r[1]):
            owners[v].add((r[3] or "").split("/")[0])
    live = {v for v, o in owners.items() if len(o) <= MAX_OWNERS and re.search("[0-9]", v) and re.search("[A-Za-z]", v)
            and not re.search(PLACEHOLDER, v)}
    out = []
    for r in rows:
        t, base = r[1] or "", base_spans(r[1])
        cuts = [(e - len(v), e) for _, _, e, v in base if v in live]
        for m in re.finditer(r"[A-Za-z0-9+/_.=-]{12,}", t):
            if m[0] in live and re.search("[0-9]", m[0]) and not any(b < m.end() and m.start() < e for b, _, e, _ in base):
                cuts.append(m.span())
        done, at = "", 0
        for a, b in sorted(cuts):
            if b > at:
                done, at = done + t[at:max(a, at)] + "[secret]", b
        out.append((r[0], r[1] if not cuts else done + t[at:], *r[2:]))
    return out


def brute_rates(sizes, target):
    """Copies per size of one source: the tilt min(3, exp(lam z)) that meets the target, by halving."""
    z = {s: s * sum(n for s, n in sizes.items() if s) / sum(s * n for s, n in sizes.items()) for s in sizes}
    rate = lambda lam: {s: min(3.0, math.exp(min(60.0, lam * z[s]))) for s in sizes}
    lo, hi = -700.0, 2000.0
    for _ in range(300):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(s * n * rate(mid)[s] for s, n in sizes.items()) < target else (lo, mid)
    return rate(lo)


def test_every_stage(spark, tmp_path):
    rows, labels = toxic_rows()
    rng = random.Random(12)
    near = sentence(60, rng).split()
    for i in range(500, 520):                            # a family of near copies, some linked only through others
        near[rng.randrange(60)] = "w%d" % i
        rows.append((i, " ".join(near), "en", "n/1"))
    rows += [(600 + i, f"key {i} token=shared1shared1 and secret: only{i}only{i}xyz", "en", f"o{i}/r") for i in range(4)]
    bench = bench_rows(rows)
    path = write(spark, str(tmp_path), rows, labels, bench)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    take = lambda d: [(r.doc_id, r.text, r.lang, r.source) for r in d.collect()]
    order = lambda rs: sorted(rs, key=repr)
    for k, (name, stage) in enumerate(P.STAGES):
        before = take(docs)
        if name == "toxicity":
            known = read(spark, path, "labels").where(remainder(F.col("doc_id"), 5) > 0).select("doc_id", "toxic")
            model = X.train(docs.select("doc_id", "text"), known)
            want = [r for r in before if brute_score(model, r[1]) < P.REJECT_TOXIC]
            assert 0 < len(want) < len(before)
        elif name == "ngram_jaccard_join":
            want, seen = [], set()
            for r, (_, n, c) in sorted(zip(before, brute_components(before, P.SHINGLE_WORDS, P.NEAR_PERCENT)),
                                       key=lambda x: (x[0][0] is None, x[0][0] or 0)):
                if n == 0 or c not in seen or c is None:
                    want.append(r)
                seen.add(c if n else "no words")
            assert len(want) < len(before) - 5
        elif name == "benchmark_decontamination":
            want = brute_decontaminated(before, bench)
            assert len(want) < len(before) and Counter(x[1] for x in want) != Counter(x[1] for x in before)
        elif name == "secret_scan":
            want = brute_masked(before)
            assert sum("[secret]" in (x[1] or "") for x in want) >= 5
        out = stage(spark, docs, path)
        out.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        if name != "mixing":
            assert order(take(docs)) == order(want), name
    got = docs.collect()
    sizes = defaultdict(Counter)
    for r in got:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) and r.taken == r.copies * r.size
        sizes[r.source][r.size] += 1
    goal = brute_targets({s: sum(a * n for a, n in c.items()) for s, c in sizes.items()})
    assert order(take(docs)) == order(before)
    for s, c in sizes.items():
        if not sum(a * n for a, n in c.items()):
            continue
        rate = brute_rates(c, goal[s])
        mine = [r for r in got if r.source == s]
        assert all(math.floor(rate[r.size] - 1e-6) <= r.copies <= math.ceil(rate[r.size] + 1e-6) for r in mine if r.size), s
        assert abs(sum(r.taken for r in mine) - goal[s]) <= max(c), s
        for a, n in c.items():                           # all documents of a size: their summed rates, rounded up or down
            m = sum(r.copies for r in mine if r.size == a)
            assert not a or math.floor(n * rate[a] - 1e-6) <= m <= math.ceil(n * rate[a] + 1e-6)


def test_odd_rows_pass_all_stages(spark, tmp_path):
    """Nulls, blanks and repeats alone, without labels and benchmark: every row that must stay is there at the end."""
    rows = odd_rows()
    path = write(spark, str(tmp_path), rows)
    ids = {r.doc_id for r in P.run(spark, path).collect()}
    assert {0, 1, 2, 3, 8, 11, 13, 14, 16, 17, 18, 22} <= ids and not ids & {9, 12}
