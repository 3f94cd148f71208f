"""op5, op8, op9, the pipeline and the registry."""
import functools
import random
import re

import numpy as np
import pytest
from helpers import base_spans, collected, key, odd_rows, sentence, sha, span_text, write
from test_text_models import bench_rows, toxic_rows

import __spark_entry__ as E
import corpus_pipeline as P
from stridex.llm import LLM_ORACLE, LLM_QUERIES
from stridex.llm import mixing as M
from stridex.llm import secrets as S
from stridex.llm import spotsigs as G
from stridex.llm._repeats import LAST

SF = "/root/testdata/sf0.01"


def test_registry():
    q = E.queries()
    assert {int(k[2:].split("_")[0]) for k in q if re.match(r"op\d+_", k)} == set(range(1, 14))
    assert "pipeline" in q and set(LLM_QUERIES) <= set(q) and set(LLM_ORACLE) <= set(E.oracle_sql()) <= set(q)


# --- op5

anchor = functools.cache(G.is_anchor)


def brute_signatures(text):
    words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in text))
    if not words:
        return {text} if text else set()
    out = set()
    for i, w in enumerate(words):
        if anchor(w):
            chain = [x for x in words[i + 1:] if not anchor(x)][:G.CHAIN]
            if chain:
                out.add((w, *chain))
    return out or {(w, *words[i + 1:i + 1 + G.CHAIN]) for i, w in enumerate(words)}


def jaccard(a, b):
    return 1.0 if a == b else len(a & b) / len(a | b)


def spotted(rows):
    rng = random.Random(8)
    return [(i, t if not t or rng.random() < 0.3 else re.sub(" ", lambda _: rng.choice([" the ", " ", " of "]), t), *r)
            for i, t, *r in rows]


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_fingerprints_odd_table(spark, tmp_path, buckets):
    rows = [r for r in spotted(odd_rows())]
    path = write(spark, str(tmp_path), rows)
    got = G.with_successor(spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text"), buckets).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    assert len(got) == len(rows)
    want = []
    for a, b in zip(order, order[1:] + order[:1]):
        first = min((r for r in rows if r[0] == b[0]), key=lambda r: (r[1] is not None, r[1] or ""))
        b = b if a[0] == b[0] else first
        t, u = a[1] or "", b[1] or ""
        m = len(t) // 3
        e = t[:len(t) - m] + u[:m]
        s = [brute_signatures(x) for x in (t, e, u)]
        want.append((a[0], len(t), sha(e), len(s[0]) * 8, len(s[1]) * 8, round(jaccard(s[0], s[1]), 9),
                     round(jaccard(s[0], s[2]), 9)))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, len(r.fingerprint), len(r.edited_fingerprint),
                    round(r.near_edited, 9), round(r.near_next, 9)) for r in got), key=repr) == sorted(want, key=repr)


def test_fingerprints_equal_and_empty(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(["the cat sat on the mat and ran", "x", "the cat sat on the mat and ran", None, ""])]
    got = {r.doc_id: r for r in G.op5_fingerprints(spark, write(spark, str(tmp_path / "a"), rows)).collect()}
    assert got[0].fingerprint == got[2].fingerprint != got[1].fingerprint and got[3].fingerprint == got[4].fingerprint == ""
    one = G.op5_fingerprints(spark, write(spark, str(tmp_path / "b"), rows[:1])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert G.op5_fingerprints(spark, write(spark, str(tmp_path / "c"), [])).count() == 0


def brute_groups(rows, percent=80):
    """(id, set size, smallest id of the component) of every row, by all pairs of sets."""
    sets = [brute_signatures(t or "") for _, t, *_ in rows]
    ids = [LAST if r[0] is None else r[0] for r in rows]
    least = list(ids)
    link = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i])
            if a and b and 100 * len(a & b) >= percent * len(a | b)]
    while True:
        old = list(least)
        for i, j in link:
            least[i] = least[j] = min(least[i], least[j])
        if old == least:
            return sorted(zip(ids, map(len, sets), least))


def spot_groups(df, **more):
    return sorted((r.ok, r.n, r.head) for r in G.near_duplicate_groups(df, **more).collect())


@pytest.mark.parametrize("percent", [50, 60, 80, 90])
def test_partitions_let_near_lengths_meet(percent):
    """Two lengths within the threshold are in one partition or in neighbours, at every length."""
    least = G.partitions(percent, 100_000)
    assert least[0] == 1 and (np.diff(least) > 0).all()
    n = np.arange(1, 50_000)
    most = 100 * n // percent                         # the longest set that a set of n can be near to
    gap = np.searchsorted(least, most, side="right") - np.searchsorted(least, n, side="right")
    assert gap.min() >= 0 and gap.max() == 1


@pytest.mark.parametrize("star", [True, False])
def test_spot_components_odd_table(spark, tmp_path, star):
    rows = spotted(odd_rows())
    df = spark.read.parquet(write(spark, str(tmp_path), rows) + "/documents.parquet")
    want = brute_groups(rows)
    assert spot_groups(df, star=star) == want
    got = G.with_successor(df.select("doc_id", "text"), 3, G.near_duplicate_groups(df, star=star)).collect()
    assert sorted((LAST if r.doc_id is None else r.doc_id, len(r.fingerprint) // 8,
                   LAST if r.component_id is None else r.component_id) for r in got) == want


@pytest.mark.parametrize("percent,star", [(80, True), (80, False), (60, True)])
def test_spot_components_chains(spark, percent, star):
    """Chains of edits that are linked step by step only, a passage that all share, copies, growing texts that stand in
    neighbouring partitions."""
    rng = random.Random(3)
    line, rows, edits = sentence(20, rng), [], 0
    for _ in range(5):
        w = sentence(70, rng).split()
        for step in range(8):
            rows.append((len(rows), " ".join(w) + " " + line))
            for _ in range(rng.randint(1, 3)):
                edits += 1
                w[rng.randrange(len(w))] = f"edit{edits}"
            w += sentence(rng.choice([0, 0, 4, 12]), rng).split()
        rows += [(len(rows) + k, rows[-1][1]) for k in range(3)]
    rng.shuffle(rows)
    want = brute_groups(rows, percent)
    assert len({h for _, _, h in want}) < len(rows) - 15        # there is something to find
    assert spot_groups(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent, star=star) == want


def test_query_names_components(spark, tmp_path):
    """The query's column over copies, an edited copy, equal rows, repeated and null ids."""
    rng = random.Random(4)
    base = sentence(120, rng)
    rows = [(5, base), (5, base), (9, base + " and more"), (7, sentence(80, rng)), (None, base.upper()), (None, "zz yy xx ww"),
            (2, None), (3, "")]
    got = G.op5_fingerprints(spark, write(spark, str(tmp_path), rows)).collect()
    assert len(got) == len(rows)
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == sorted(
        [(5, 5), (5, 5), (9, 5), (7, 7), (None, 5), (None, None), (2, 2), (3, 3)], key=repr)


def test_an_edited_third_leaves_a_likeness(spark):
    """Whatever its language, a text of 50 different words and its edit, of which two thirds are the same, share signatures;
    of texts of 50 words that repeat fewer ones (junk of one word hundreds of times) few share none."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    got = G.with_successor(docs).join(docs.selectExpr(
        "doc_id", "size(split(text, ' ')) AS n", "size(array_distinct(split(text, ' '))) AS d"), "doc_id")
    assert got.where("d >= 50 and near_edited = 0").count() == 0
    assert got.where("n >= 50 and near_edited = 0").count() < 50


# --- op8

def test_secrets_odd_table(spark, tmp_path):
    rows = odd_rows()
    got = collected(S.op8_secret_scan(spark, write(spark, str(tmp_path), rows)).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256"))
    want = []
    for r in rows:
        b = base_spans(r[1])
        want.append((r[0], *[sum(k == x[1] for x in b) for k in range(3)], sha(span_text(b))))
    assert got == sorted(want, key=repr)


def test_ownership(spark, tmp_path):
    rows = odd_rows() + [(100 + i, "token=copiedcopied1234", "en", f"owner{i}/r") for i in range(4)] + [
        (200, "token=minemine5678minem", "en", "me/a"), (201, "token=minemine5678minem minemine5678minem", "en", "me/b")]
    got = {r.doc_id: r for r in S.op8_secret_scan(spark, write(spark, str(tmp_path), rows)).collect()}
    assert all((got[100 + i].n_live, got[100 + i].n_example) == (0, 1) for i in range(4))
    assert (got[200].n_live, got[200].n_example) == (1, 0)
    assert got[201].spans == "assign:0:23,reuse:24:41"
    assert got[18].n_live == 0                                   # a placeholder
    t = next(r[1] for r in rows if r[0] == 17)
    at = t.index("qwerty")
    assert f"reuse:{at}:{at + 16}" in got[17].spans


def test_redaction(spark, tmp_path):
    rows = odd_rows() + [(100 + i, "token=copiedcopied1234", "en", f"owner{i}/r") for i in range(4)]
    path = write(spark, str(tmp_path), rows)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = S.redact(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    text = {r.doc_id: r.text for r in out.collect() if r.doc_id not in (None, 9, 10)}
    assert text[16] == 'password = "[secret]" token: abc secret=[secret]'
    assert text[17] == "see [secret] and [secret] [secret]"
    for i, t, *_ in rows:
        if i not in (None, 9, 10, 16, 17):
            assert text[i] == t
    empty = write(spark, str(tmp_path / "e"), [])
    assert S.op8_secret_scan(spark, empty).count() == 0
    assert S.redact(spark.read.parquet(f"{empty}/documents.parquet")).count() == 0


def test_secrets_dense_long_text(spark):
    """Thousands of matches in one text: spans and masking as by brute force, and time in proportion to the length."""
    import time
    rng = random.Random(4)
    lines = [rng.choice(["token=abc%020dxyz " % i, "%032x," % (i * 7919 + (1 << 120)), "é\U0001f600 plain text;"]) for i in range(3000)]
    t = "".join(lines)
    got = S.secret_spans(spark.createDataFrame([(1, t, "me/a")], "doc_id long, text string, source string")).first()
    assert [(s.start, s.kind - 1, s.stop, s.value) for s in got.base] == base_spans(t)
    masked = S.redact(spark.createDataFrame([(1, t, "me/a")], "doc_id long, text string, source string")).first().text
    cuts, want, at = sorted((b[2] - len(b[3]), b[2]) for b in base_spans(t) if re.search("[0-9]", b[3]) and re.search("[A-Za-z]", b[3])), "", 0
    for a, b in cuts:
        if b > at:
            want, at = want + t[at:max(a, at)] + "[secret]", b
    assert masked == want + t[at:]
    spent = []
    for n in (4_000, 40_000):                                   # 132 KB and 1.3 MB
        long = "".join("%032x " % (i * 7919 + (1 << 120)) for i in range(n))
        df = spark.createDataFrame([(1, long, "me/a")], "doc_id long, text string, source string")
        start = time.perf_counter()
        assert S.candidates(df).selectExpr("size(base)").first()[0] == n
        spent.append(time.perf_counter() - start)
    assert spent[1] < 10 * spent[0] + 5


# --- op9

def brute_targets(sizes):
    """sizes: source -> words; the shares filled step by step."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and weight[s] * rest / w >= 3 * sizes[s]} if w else set()
        if not over:
            return {s: 3.0 * sizes[s] if s in full else weight[s] * rest / w for s in names}
        full |= over


@pytest.mark.parametrize("which", ["odd", "sf", "even"])
def test_mixing(spark, tmp_path, which):
    if which == "sf":
        path = SF
        rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    else:
        rng = random.Random(6)
        rows = odd_rows() if which == "odd" else [(i, sentence(30, rng), "en", ("p", "q", None)[i % 3]) for i in range(900)]
        path = write(spark, str(tmp_path), rows)
    got = M.op9_mixing(spark, path).collect()
    size = {}
    for _, t, _, s in rows:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = brute_targets(size)
    assert sorted(((r.doc_id, r.size) for r in got), key=repr) == sorted(
        ((r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in rows), key=repr)
    assert {(r.source_size, round(r.target, 6)) for r in got} == {(size[s], round(want[s], 6)) for s in size}
    assert all(0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in got)
    taken = {}
    for r in got:
        taken[r.target] = taken.get(r.target, 0) + r.taken
    largest = max(r.size for r in got)
    for t, n in taken.items():
        same = [s for s in want if abs(want[s] - t) < 1e-6]
        assert abs(n - t * len(same)) <= max(0.01 * t, largest if which == "odd" else 0.01 * t), (same, t, n)
    assert collected(M.op9_mixing(spark, path)) == sorted((tuple(r) for r in got), key=repr)


def test_mixing_many_sizes(spark):
    """Every size once: rounding in chunks carries its error over all of them, in proportion to their number."""
    import time
    spent = []
    for n in (3_000, 30_000):
        df = spark.range(1, n + 1).selectExpr("id AS doc_id", "id AS size", "IF(id % 2 = 0, 'a', 'b') AS source")
        start = time.perf_counter()
        got = M.copies(df).groupBy("source_size", "target").count().collect()
        spent.append(time.perf_counter() - start)
        words = {r.target: r.w for r in M.copies(df).selectExpr("target", "copies * size AS w").groupBy("target").agg(
            {"w": "sum"}).withColumnRenamed("sum(w)", "w").collect()}
        assert len(got) == 2 and all(abs(w - t) < 1e-4 * t for t, w in words.items())
    assert spent[1] < 6 * spent[0] + 5


def test_mixing_empty(spark, tmp_path):
    assert M.op9_mixing(spark, write(spark, str(tmp_path / "a"), [])).count() == 0
    got = M.op9_mixing(spark, write(spark, str(tmp_path / "b"), [(1, None, None, "a"), (2, " ", None, None)])).collect()
    assert [(r.size, r.taken, r.target) for r in got] == [(0, 0, 0.0)] * 2


# --- pipeline

def test_pipeline_stages(spark, tmp_path):
    rows, labels = toxic_rows()
    rows += [(900, sentence(40, random.Random(1)) + " vileword nastyword foulword", "en", "s")]
    bench = bench_rows(rows)
    path = write(spark, str(tmp_path), rows, labels, bench)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "mixing"]
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, path)
        out.write.parquet(f"{tmp_path}/out{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/out{k}")
        ids = {r.doc_id: r for r in docs.collect()}
        if k < 4:
            assert docs.columns == columns
        if name == "toxicity":
            assert 900 not in ids and not any(i is not None and i >= 100 and i % 4 == 0 for i in ids)
            assert docs.count() == sum(1 for i, *_ in rows if i is None or i < 100 or i < 400 and i % 4)
        if name == "ngram_jaccard_join":
            assert docs.where("doc_id = 9").count() == 0 and docs.where("doc_id = 8").count() == 1
            assert {0, 1, 2, 14} <= set(ids)
        if name == "benchmark_decontamination":
            long = next(t for i, t, *_ in rows if i == 14)
            assert " ".join(long.split()[100:140]) not in ids[14].text and len(ids[14].text) > 0.9 * len(long)
            assert 5 not in ids and 19 not in ids and {0, 1, 2, 16} <= set(ids)
        if name == "secret_scan":
            assert docs.count() == before.count() and "[secret]" in ids[16].text and "[secret]" in ids[17].text
        if name == "mixing":
            assert docs.count() == before.count() and all(r.taken == r.copies * r.size for r in docs.collect())
            assert {r.doc_copies for r in docs.collect()} == {"x"} and set(columns) - set(docs.columns) == set()


def test_decontamination_keeps_the_clean_text(spark, tmp_path):
    """Only hit words leave a document that is not mostly benchmark, for short items too."""
    item = "p q r s t u v w x y"
    rows = [(1, f"Left, é\U0001f600 side. {item}! And the right one is a lot longer"), (2, f"{item} z"), (3, None), (4, "\n"),
            (5, "no hit at all"), (6, "much text uses MAGIC words, magic ones"), (7, f"a{item}"),
            (8, f"a b c d e f {item} g h i j k l"), (9, item + " 1" * 10)]
    path = write(spark, str(tmp_path), rows, bench=[(1, item), (2, "magic")])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = P.decontaminated(spark, docs, path)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        1: "Left, é\U0001f600 side. ! And the right one is a lot longer", 3: None, 4: "\n", 5: "no hit at all",
        6: "much text uses  words,  ones", 7: f"a{item}", 8: "a b c d e f  g h i j k l", 9: " 1" * 10}


def test_pipeline_run_and_empty(spark, tmp_path):
    got = P.run(spark, "/root/testdata/sf0.001")
    assert 0 < got.count() < 200
    assert P.run(spark, write(spark, str(tmp_path), [])).count() == 0


def test_numbering_null_last(spark):
    df = spark.createDataFrame([("n", None, 4, 1), ("sb", "b", 1, 1), ("sa", "a", 2, 1), ("s", "", 3, 1)],
                               "k string, source string, source_size long, n_docs long")
    assert {r.source: r["rank"] for r in M._numbered(df).collect()} == {"": 0, "a": 1, "b": 2, None: 3}
    assert key(None) == float("inf")
