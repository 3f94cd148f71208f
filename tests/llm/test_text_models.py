"""op1 and op10: learned models; op3 and op6: matchers."""
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import brute_contamination, collected, odd_rows, sentence, write

from stridex.llm import decontaminate as D
from stridex.llm import language_id as L
from stridex.llm import licenses as C
from stridex.llm import toxicity as X

SF = "/root/testdata/sf0.01"


# --- op1

def test_language_accuracy_on_held_out(spark):
    got = L.op1_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97


def test_language_odd_table(spark, tmp_path):
    rows = odd_rows()
    got = {}
    for r in L.op1_language_id(spark, write(spark, str(tmp_path), rows)).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score, r.held_out))
    assert sum(map(len, got.values())) == len(rows)
    for i in (0, 1, 2, 3):
        assert got[i][0][:2] == ("und", 0.0)
    assert got[4][0][0] in ("en", "fr", "de") and got[9][0] == got[9][1]
    assert not any(h for _, _, h in got[None])


def test_language_ignores_held_out_labels(spark, tmp_path):
    rows = [(i, sentence(20, random.Random(i)), "en" if i % 2 else "fr", "s") for i in range(60)]
    lie = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, s) for i, t, lang, s in rows]
    a = collected(L.op1_language_id(spark, write(spark, str(tmp_path / "a"), rows)))
    b = collected(L.op1_language_id(spark, write(spark, str(tmp_path / "b"), lie)))
    assert a == b


def brute_language(train, texts):
    """Multinomial naive Bayes over the same hashed 2- and 3-grams, in plain Python."""
    def grams(t):
        norm = " " + re.sub(r" +", " ", "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in t)).strip() + " "
        return [norm[i:i + n] for n in (2, 3) for i in range(len(norm) - n + 1) if norm[i:i + n].strip()] if norm.strip() else []

    def bucket(g):
        h = 0
        for c in g:
            h = (h * 0x1F123BB5 + ord(c)) % (1 << 64)
        return (h * 0x9E3779B97F4A7C15 % (1 << 64) >> 40) % L.BUCKETS
    count, docs = {}, Counter()
    for t, lang in train:
        if t is not None and lang:
            docs[lang] += 1
            count.setdefault(lang, Counter()).update(map(bucket, grams(t)))
    total = {x: sum(c.values()) + L.ALPHA * L.BUCKETS for x, c in count.items()}
    out = []
    for t in texts:
        b = Counter(map(bucket, grams(t or "")))
        if not b or not docs:
            out.append(("und", 0.0))
            continue
        s = {x: math.log(docs[x] / sum(docs.values())) + sum(k * math.log((count[x][g] + L.ALPHA) / total[x]) for g, k in b.items())
             for x in sorted(docs)}
        top = max(s.values())
        out.append((max(sorted(s), key=s.get), 1 / sum(math.exp(v - top) for v in s.values())))
    return out


def test_language_against_plain_python(spark, tmp_path):
    """Every prediction and score of the whole table, in one matrix and in blocks of one and two languages."""
    rng = random.Random(5)
    rows = odd_rows() + [(100 + i, sentence(rng.randint(1, 30), rng), f"l{i % 7}", "s") for i in range(80)]
    rows = [r for r in rows if len(r[1] or "") < 20_000]
    train = [(t, lang) for i, t, lang, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    want = sorted(((r[0], *x) for r, x in zip(rows, brute_language(train, [r[1] for r in rows]))), key=repr)
    docs = spark.read.parquet(write(spark, str(tmp_path), rows) + "/documents.parquet")
    labelled = spark.createDataFrame(train, "text string, lang string")
    for limit in (256, 0.3, 0.14):
        got = sorted((tuple(r) for r in L.identify(docs, labelled, limit_mb=limit).select("doc.doc_id", "p.lang_pred", "p.score")
                      .collect()), key=repr)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        bad = [(g, w) for g, w in zip(got, want) if abs(g[2] - w[2]) >= 1e-3]
        assert not bad


def test_language_more_languages_than_a_task_holds(spark, monkeypatch):
    """A dirty label column: counts leave the task in parts, predictions stay."""
    rng = random.Random(6)
    rows = [(sentence(12, rng), f"x{i}") for i in range(40)] + [(sentence(12, rng), "x1") for _ in range(10)]
    df = spark.createDataFrame(rows, "text string, lang string")
    want = collected(L.identify(df, df, buckets=512).select("doc.lang", "p"))
    monkeypatch.setattr(L, "TASK_LANGUAGES", 3)
    assert collected(L.identify(df, df, buckets=512).select("doc.lang", "p")) == want
    blocks = L.identify(df, df, buckets=512, limit_mb=0.01).select("doc.lang", "p.lang_pred").collect()
    assert sorted(map(tuple, blocks)) == sorted((a, p[0]) for a, p in want)


def test_language_counts_and_empty(spark, tmp_path):
    """The matrix against counts by hand; an empty table."""
    texts = ["Ab a", "b"]
    grams, has = L._grams(texts + ["1 2", ""], (2,), 1 << 15)
    bucket, doc = grams[0]
    norm = [" ab a ", " b ", " ", " "]
    want = [(d, t[i:i + 2]) for d, t in enumerate(norm) for i in range(len(t) - 1) if t[i:i + 2].strip()]
    assert doc.tolist() == [d for d, _ in want] and has.tolist() == [True, True, False, False]
    by = {}
    for b, (_, g) in zip(bucket.tolist(), want):
        assert by.setdefault(g, b) == b
    path = write(spark, str(tmp_path), [])
    assert L.op1_language_id(spark, path).count() == 0


# --- op10

def test_marginals_against_plain_recursion():
    rng = np.random.default_rng(0)
    w, tr, st = rng.normal(size=700) * 3, rng.normal(size=(2, 2)), rng.normal(size=2)
    first = np.zeros(700, bool)
    first[[0, 5, 6, 300]] = True
    p, moved = X.marginals(w, first, tr, st, pairs=True)
    cut, want, pairs = [*np.flatnonzero(first), 700], [], np.zeros((2, 2))
    for s, e in zip(cut, cut[1:]):
        n, emit, a = e - s, np.exp(np.c_[np.zeros(e - s), w[s:e]]), np.exp(tr)
        f, b = np.zeros((n, 2)), np.ones((n, 2))
        f[0] = np.exp(st) * emit[0] / (np.exp(st) * emit[0]).sum()
        for t in range(1, n):
            f[t] = (f[t - 1] @ a) * emit[t]
            f[t] /= f[t].sum()
        for t in range(n - 2, -1, -1):
            b[t] = a @ (emit[t + 1] * b[t + 1])
            b[t] /= b[t].sum()
        g = f * b
        want += list(g[:, 1] / g.sum(axis=1))
        for t in range(1, n):
            z = f[t - 1][:, None] * a * (emit[t] * b[t])[None]
            pairs += z / z.sum()
    assert np.allclose(p, want) and np.allclose(moved, pairs)


def test_toxicity_on_held_out(spark):
    got = X.op10_toxicity(spark, "/root/testdata/sf0.1")
    lab = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = got.where("held_out").join(lab, "doc_id").collect()
    s, y = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    assert len(rows) > 500 and s.min() >= 0 and s.max() <= 1
    assert s[y == 1].mean() > 0.7 and (y[s >= 0.5] == 1).mean() > 0.95 and (s[y == 1] >= 0.5).mean() > 0.8
    assert all(r.predicted == (r.score >= 0.5) for r in rows)


def toxic_rows():
    rng = random.Random(2)
    rows, labels = odd_rows(), []
    for i in range(100, 400):
        bad = i % 4 == 0
        t = sentence(40, rng).split()
        if bad:
            for w in rng.sample(["vileword", "nastyword", "foulword"], 2):
                t.insert(rng.randrange(len(t)), w)
        rows.append((i, " ".join(t), "en", "s"))
        labels.append((i, 1, int(bad)))
    return rows, labels + [(100, 0, 1), (5, None, None), (None, 1, 1), (99999, 1, 1)]


def test_toxicity_odd_table_and_held_out_labels(spark, tmp_path):
    rows, labels = toxic_rows()
    got = X.op10_toxicity(spark, write(spark, str(tmp_path / "a"), rows, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in got if r.doc_id is not None and r.doc_id >= 100)
    empty = {r.score for r in got if r.doc_id in (0, 1, 2)}
    assert len(empty) == 1 and empty.pop() < 0.5
    lie = [(i, q, 1 - t if t is not None and i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else t)
           for i, q, t in labels]
    again = X.op10_toxicity(spark, write(spark, str(tmp_path / "b"), rows, lie))
    assert sorted(map(repr, got)) == sorted(map(repr, again.collect()))


@pytest.mark.parametrize("labels", [[], [(8, 1, 0), (9, 1, 0)], [(8, 1, 1), (9, 1, 1)]])
def test_toxicity_without_both_labels(spark, tmp_path, labels):
    got = X.op10_toxicity(spark, write(spark, str(tmp_path), odd_rows(), labels)).collect()
    assert len(got) == len(odd_rows()) and {r.score >= 0.5 for r in got} == {bool(labels) and labels[0][2] == 1}
    path = write(spark, str(tmp_path / "empty"), [], labels)
    assert X.op10_toxicity(spark, path).count() == 0


def test_toxic_spans():
    m = X.fit(["a vileword b"] * 1 + [f"{c} vileword {c}x" for c in "cdefghijklmn"] + [f"{c} x{c} y" for c in "abcdefghijklmnopqrst"],
              [True] * 13 + [False] * 20)
    t = "Hello, VileWord! calm words"
    score, p, n = m.scores([t, ""])
    assert n.tolist() == [4, 0] and score[0] > score[1]
    assert [t[b:e] for b, e, _ in X.spans(t, p)] == ["VileWord"]


# --- op3

def bench_rows(rows):
    long = next(t for i, t, *_ in rows if i == 14).split()
    return [(1, " ".join(long[100:125])), (2, "one, TWO!"), (3, " ".join(long[110:140])), (4, ""), (5, None), (None, "one"),
            (6, "..."), (7, " ".join(long[8990:])), (7, "one"), (8, "naïve"), (9, next(t for i, t, *_ in rows if i == 5)), (10, "a" * 5000)]


def test_contamination_odd_table(spark, tmp_path):
    rows = odd_rows()
    bench = bench_rows(rows)
    path = write(spark, str(tmp_path), rows, bench=bench)
    want = sorted(brute_contamination(rows, bench), key=repr)
    assert collected(D.op3_decontamination(spark, path)) == want


def test_contamination_in_blocks(spark, tmp_path):
    """A pattern limit far below the benchmark's size deals the windows into blocks; the result is the same."""
    rows = odd_rows()
    path = write(spark, str(tmp_path), rows, bench=bench_rows(rows))
    docs, bench = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "benchmark"))
    cols = [D.contamination(docs, bench.select("item_id", "text"), limit=n, with_offsets=True).select("doc.doc_id", "c")
            for n in (10 ** 9, 30_000, 2_000)]
    assert collected(cols[0]) == collected(cols[1]) == collected(cols[2])


def test_contamination_runs_once(spark, tmp_path):
    """A filter on the result doesn't run the scan a second time: one Python step in the plan."""
    path = write(spark, str(tmp_path), odd_rows(), bench=bench_rows(odd_rows()))
    docs, bench = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "benchmark"))
    d = D.contamination(docs, bench.select("item_id", "text"), with_offsets=True).where("c.n_hit <= c.n_words / 2")
    plan = d.select("doc.doc_id", "c.kept")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_contamination_offsets():
    a = D.automaton(["b c"])
    n, hits, items = D.scan("A, B--c! d b C", a, [["x"]])
    assert (n, hits, items) == (6, [[1, 3], [4, 6]], ["x"])
    assert [("A, B--c! d b C")[b:e] for b, e in D.offsets("A, B--c! d b C", hits)] == ["B--c", "b C"]


def test_contamination_empty(spark, tmp_path):
    path = write(spark, str(tmp_path / "a"), odd_rows())
    assert not any(r.contaminated for r in D.op3_decontamination(spark, path).collect())
    path = write(spark, str(tmp_path / "b"), [], bench=[(1, "x")])
    assert D.op3_decontamination(spark, path).count() == 0


def test_toxicity_sample_takes_ids(spark, monkeypatch):
    """Repeated rows of an id don't crowd out other ids, and an id of many texts gives a bounded number."""
    used = []
    monkeypatch.setattr(X, "fit", lambda texts, toxic: used.append((texts, toxic)))
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(9) for _ in range(5)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id long, toxic int")
    X.train(docs, labels, limit=9)
    assert used.pop() == ([f"text {i}" for i in range(9)], [i % 2 > 0 for i in range(9)])
    more = docs.union(spark.createDataFrame([(3, f"other {k}") for k in range(50)], docs.schema))
    X.train(more, labels, limit=100)
    texts, _ = used.pop()
    assert len(texts) == 8 + X.MAX_TRAIN_TEXTS and {f"text {i}" for i in range(9) if i != 3} <= set(texts)
    X.train(more, labels, limit=9)
    assert len(used[0][0]) == 9 and len({t for t in used.pop()[0] if not t.startswith("other") and t != "text 3"}) == 8


# --- op6

def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_patience_is_a_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 14))] for _ in range(2))
        got = C.patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x < y and u < v for (x, u), (y, v) in zip(got, got[1:]))
        assert len(got) <= lcs(a, b)
        if len(set(a)) == len(a) and len(set(b)) == len(b):     # all words unique: the longest one
            assert len(got) == lcs(a, b)


def test_licenses_odd_table(spark, tmp_path):
    got = {}
    for r in C.op6_license_scan(spark, write(spark, str(tmp_path), odd_rows())).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert got[15][0].licenses == "Apache-2.0" and got[15][0].spans == "Apache-2.0:0:46" and got[15][0].coverage == 1.0
    assert all(r.n_notices == 0 and r.coverage == 0.0 for i, rs in got.items() if i != 15 for r in rs)
    assert C.op6_license_scan(spark, write(spark, str(tmp_path / "e"), [])).count() == 0


def test_licenses_edited_repeated_and_long():
    s = C.Scanner()
    filler = sentence(3000, random.Random(4))
    for name, t in C.TEMPLATES:
        found = s.scan(filler + "\n" + t + "\n" + filler + " " + t.upper())
        assert [x[0] for x in found] == [name, name], (name, found)
    grant = dict(C.TEMPLATES)["MIT-grant"].replace("hereby", "herewith").replace("obtaining", "getting")
    assert [x[0] for x in s.scan(grant)] == ["MIT-grant"]
    assert s.scan("the license of the version is under the public work, all in all " * 50) == []
    assert s.scan(None) == [] and C.Scanner([("x", "...")]).scan("anything") == []


@pytest.mark.parametrize("name, t", C.TEMPLATES)
def test_licenses_in_a_row(name, t):
    """Every copy is found, with its own span, however close the copies stand."""
    s = C.Scanner()
    edited = " ".join(["edited" if k == 9 else w for k, w in enumerate(t.split())])
    inserted = " ".join([w + " inserted" if k == 9 else w for k, w in enumerate(t.split())])
    for n in {t, edited, inserted}:
        one = s.scan(n)
        assert len(one) == 1 and one[0][0] == name
        for before, between, after, copies in (("", " ", "", 2), ("foo ", " ", " bar", 2), ("foo ", " foo ", " bar", 2),
                                               ("", " foo ", "", 3), ("License ", "\n", "", 3), ("", "\n", "\n", 1000)):
            got = s.scan(before + between.join([n] * copies) + after)
            at = [len(before) + k * len(n + between) for k in range(copies)]
            assert got == [(name, one[0][1], b + one[0][2], b + one[0][3]) for b in at], (n, before, between, copies)


@pytest.mark.parametrize("name, t", C.TEMPLATES)
def test_licenses_reworded(name, t):
    """As many words as the coverage allows are replaced, the rarer ones first, at either end, or anywhere."""
    words = [w for w, _, _ in C.tokens(t)]
    spare = int(len(words) * 2 + 1e-9) // 10
    keys = [k for k, w in enumerate(words) if w not in C.COMMON]
    rng = random.Random(5)
    picks = [keys[:spare], keys[len(keys) - spare:], keys[1:-1][:spare]] + [rng.sample(keys, spare) for _ in range(20)]
    for gone in picks:
        text = " ".join(f"reworded{k}" if k in gone else w for k, w in enumerate(words))
        got = C.Scanner([(name, t)]).scan(f"some text before {text} and after")
        assert [x[0] for x in got] == [name] and got[0][1] >= C.COVERAGE, (gone, got)


def test_whole_licenses():
    """Each license as itself, whole, edited, twice in a row and shouted; no opening clause stands for another license."""
    s, rng = C.Scanner(), random.Random(6)
    texts = dict(C.whole_texts())
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0",
            "Unlicense"} <= set(texts)
    for name, t in texts.items():
        t = t.strip()
        words = t.split()
        edited = " ".join(f"edited{k}" if rng.random() < 0.02 else w for k, w in enumerate(words))
        for text, n in ((f"some {t} text", 1), (edited, 1), (t + "\n" + t.upper(), 2)):
            got = s.scan(text)
            assert [x[0] for x in got] == [name] * n and all(x[1] > 0.9 for x in got), (name, [x[:2] for x in got])
    half = texts["MIT"][:len(texts["MIT"]) // 2]
    assert [x[0] for x in s.scan(half)] == ["MIT-grant"]
    notice = dict(C.TEMPLATES)
    for t, name in ((notice["GPL-3.0-header"].replace("GNU", "GNU Affero"), "AGPL-3.0-header"),
                    (notice["GPL-3.0-header"].replace("version 3", "version 2"), "GPL-2.0-header"),
                    (notice["GPL-3.0-header"].replace("GNU", "GNU Lesser").replace("program", "library"), "LGPL-3.0-header"),
                    ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0")):
        assert [x[:2] for x in s.scan(t)] == [(name, 1.0)]


def brute_notices(scanner, name, toks, words):
    """Whether any window at any start, of one template length or the longer ones, reaches the coverage."""
    seq, size = [w for w, _, _ in toks], len(words)
    for n in (size, int(size / scanner.coverage), 2 * size):
        for b in range(max(1, len(seq) - n // 2)):
            hit = C.patience(words, seq[b:b + n])
            if hit and len(hit) >= scanner.coverage * size and len(hit) >= scanner.coverage * (hit[-1][1] - hit[0][1] + 1):
                return True
    return False


@pytest.mark.parametrize("seed", range(4))
def test_licenses_against_all_windows(seed):
    """Long and short notices with words replaced, dropped and inserted all over, around the coverage, in running text: what all
    windows at all starts find is found, and nothing else."""
    rng = random.Random(seed)
    names = ["MIT", "BSD-3-Clause", "ISC"]
    whole = [(n, " ".join(t.split()[:160])) for n, t in C.whole_texts() if n in names]
    assert len(whole) >= 2
    for name, text in [*whole, *[t for t in C.TEMPLATES if t[0] in ("Apache-2.0-header", "MIT-grant", "CC-BY-4.0")]]:
        one = C.Scanner([(name, text)])
        for share in (0.0, 0.08, 0.14, 0.2, 0.3):
            w = []
            for x in text.split():
                r = rng.random()
                w += [] if r < share / 3 else [x, "inserted"] if r < share * 2 / 3 else ["replaced"] if r < share else [x]
            body = " ".join([sentence(25, rng), *w, sentence(25, rng)])
            found = one.scan(body)
            assert bool(found) == brute_notices(one, name, C.tokens(body), one.templates[0][1]), (name, share)


def test_licenses_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "All rights reserved.": "Proprietary"}
    got = {r.doc_id: r.licenses for r in C.op6_license_scan(spark, SF).collect()}
    for r in docs:
        assert got[r.doc_id] == ",".join(sorted({v for k, v in lines.items() if re.search(re.escape(k), r.text)}))
