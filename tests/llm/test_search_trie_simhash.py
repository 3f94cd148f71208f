"""op11, op12 and op13 against brute force."""
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from helpers import WORDS, collected, key, odd_rows, sentence, sha, write
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridex.llm import conversation_trie as C
from stridex.llm import lexical_search as L
from stridex.llm import simhash as S

# ---- op11

_TERM = re.compile(L.TERM)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_search(docs, items, k=10):
    words = [(r[0], _TERM.findall(lower(r[1] or ""))) for r in docs]
    words = [(i, Counter(w), len(w)) for i, w in words if w]
    n, total = len(words), sum(x for *_, x in words)
    df = Counter(t for _, c, _ in words for t in c)
    wanted = defaultdict(Counter)
    for i, t in items:
        if i is not None:
            wanted[i].update(_TERM.findall(lower(t or "")))
    out = []
    for item, q in wanted.items():
        found = []
        for i, tf, length in words:
            m = 25 + 75 * length * n // total
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                    for t, c in q.items() if tf[t])
            if s > 0:
                found.append((-s, key(i)))
        out += [(item, r + 1, None if i == float("inf") else i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def odd_items():
    rng = random.Random(3)
    return [(1, sentence(12, rng)), (2, None), (3, ""), (4, "..."), (5, "ONE one Two"), (6, "été été naïve İstanbul \U0001f600"),
            (None, "one two"), (7, "x"), (7, "Y y"), (8, sentence(40, rng)), (9, "nowhereatall"), (10, WORDS[3])]


def test_search_odd_tables(spark, tmp_path):
    rows, items = odd_rows(), odd_items()
    path = write(spark, str(tmp_path), rows, bench=items)
    assert collected(L.op11_lexical_search(spark, path)) == brute_search(rows, items)


def test_search_in_blocks_and_chunks(spark, tmp_path, monkeypatch):
    """Many small item blocks and chunks of documents give the same rows; ties at the tenth place."""
    rng = random.Random(8)
    rows = [(i, sentence(rng.randint(1, 60), rng)) for i in range(300)] + [(1000 + i, "one two three") for i in range(30)]
    rows += [(i, WORDS[5] + " " + sentence(3000, rng)) for i in range(2000, 2003)]
    items = odd_items() + [(50 + i, sentence(8, rng)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(L, "CHUNK_DOCS", 37)
    monkeypatch.setattr(L, "CHUNK_TERMS", 900)
    assert collected(L.search(docs, bench, limit=400)) == brute_search(rows, items)
    assert collected(L.search(docs, bench, k=3)) == brute_search(rows, items, 3)


def test_search_empty(spark, tmp_path):
    path = write(spark, str(tmp_path), [], bench=odd_items())
    assert L.op11_lexical_search(spark, path).count() == 0
    path = write(spark, str(tmp_path / "b"), odd_rows(), bench=[])
    assert L.op11_lexical_search(spark, path).count() == 0


def test_ball_tree_bounds_and_pruning():
    """No row scores above the bound of any ball it lies in; topical rows are pruned; extreme values stay safe."""
    rng = np.random.default_rng(4)
    topics, ptr, column, value = 30, [0], [], []
    for i in range(1500):
        c = rng.choice(20, 8, replace=False) + 20 * (i % topics)
        column.append(c), value.append(rng.integers(1, 10**6, 8)), ptr.append(ptr[-1] + 8)
    ptr, column, value = np.array(ptr), np.concatenate(column), np.concatenate(value)
    for scale in (np.ones(20 * topics), rng.uniform(1e-3, 1e3, 20 * topics)):
        tree = L.BallTree(ptr, column, value, scale)
        columns, weights = np.arange(45, 55), rng.integers(1, 30_000, 10)
        q = np.zeros(20 * topics, np.int64)
        q[columns] = weights
        score = np.add.reduceat(value * q[column], ptr[:-1])
        top = tree.bounds(columns, weights)
        for (b, e, *_), bound in zip(tree.nodes, top):
            assert score[tree.order[b:e]].max() <= bound
        one = L.BallTree(ptr, column, value, scale, groups=1)
        assert all(score[one.order[b:e]].max() <= x for (b, e, *_), x in zip(one.nodes, one.bounds(columns, weights)))
        best = []
        leaves = tree.search(columns, weights, 10, best, np.arange(1500))
        assert sorted(best, reverse=True) == sorted(((int(s), -i) for i, s in enumerate(score)), reverse=True)[:10]
        assert leaves < sum(n[2] < 0 for n in tree.nodes) / 4


# ---- op12

CONV = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                     *[T.StructField(c, T.StringType()) for c in ("pos", "at", "pid", "blk", "n", "depth", "a", "len", "base", "h")]])


def write_conversations(spark, path, rows):
    spark.createDataFrame([tuple(r) + ("x",) * (len(CONV) - 4) for r in rows], CONV).repartition(3).write.parquet(
        f"{path}/conversations.parquet")
    return path


def brute_trie(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = __import__("hashlib").md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((t is not None, t or 0), digest, (role, text)))
    own = {c: [x for *_, x in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = turns if c == base else own.get(base, [])[:h] + turns[h:]
    return brute_nodes(full)


def brute_nodes(full):
    members = defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[tuple(full[c][:d])].append(c)
    kids, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        w = (len(m) - 1) * len(re.findall(C.WORD, p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += w
    return sorted(((m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
                    sha(",".join(str(c) for c in m if len(full[c]) == len(p)))) for p, m in members.items()), key=repr)


def odd_conversations():
    rng = random.Random(2)
    rows = [(None, 0, "user", "lost"), (20, None, "user", "first of all"), (20, 1, None, None), (20, 1, "user", "tie b"),
            (20, 1, "user", "tie a"), (20, 2, "assistant", "x" * 200_000 + " y"), (41, 0, "user", "no base"), (0, 5, "u", "a b"),
            (-3, 0, "u", "minus"), (-20, 0, "u", "minus base"), (-20, 1, "u", "second"), (3, 7, "u", "late"), (3, 7, "u", "late")]
    for c in range(1, 20):
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["yes", "no it is", ""])) for t in range(rng.randint(1, 7))]
    for c in range(60, 100):                                    # copies, prefixes of each other, late divergence
        k = rng.randint(1, 14)
        rows += [(c, t, "user", f"turn {t}" if t < k - 1 or c % 3 else f"own {c % 5}") for t in range(k)]
    return rows


def test_trie_odd_table(spark, tmp_path):
    rows = odd_conversations()
    path = write_conversations(spark, str(tmp_path), rows)
    assert collected(C.op12_conversation_trie(spark, path)) == brute_trie(rows)


def test_trie_empty(spark, tmp_path):
    path = write_conversations(spark, str(tmp_path), [])
    assert C.op12_conversation_trie(spark, path).count() == 0
    path = write_conversations(spark, str(tmp_path / "n"), [(None, 0, "a", "b")])
    assert C.op12_conversation_trie(spark, path).count() == 0


@pytest.mark.parametrize("block", [1, 3, 4])
def test_trie_block_sizes_and_levels(spark, monkeypatch, block):
    """A long conversation over several window levels, its prefixes and copies, turnless ones; any block size."""
    monkeypatch.setattr(C, "FAN", 3)
    monkeypatch.setattr(C, "PIECE", 4)
    rng = random.Random(block)
    long = [("user", f"word {rng.randint(0, 3)} of {i}") for i in range(70)]
    full = {c: list(long[:rng.choice([3, 4, 16, 17, 40, 70])]) for c in range(30)}
    for c in range(30, 60):
        k = rng.randint(0, 60)
        full[c] = long[:k] + [("user", rng.choice("ab"))] * rng.randint(0, 3)
    full[77], full[-5] = [], []
    turns = [(c, i + 1, f"{r}:{t}", len(t.split())) for c, x in full.items() for i, (r, t) in enumerate(x)]
    t = spark.createDataFrame(turns, "conv_id long, pos long, digest string, words long")
    n = spark.createDataFrame([(c, len(x)) for c, x in full.items()], "conv_id long, len long")
    assert collected(C.trie(t, n, block)) == brute_nodes(full)


def test_trie_refines_only_where_siblings_diverge(spark, monkeypatch):
    """A hundred copies of a conversation with one late edit: the turns of one copy stand for all shared blocks."""
    seen = {}
    keep = C.materialize
    monkeypatch.setattr(C, "materialize", lambda df, name: seen.setdefault(name, keep(df, name)))
    monkeypatch.setattr(C, "discard", lambda *t: None)
    rows = [(c, p, "same" if p < 37 or c else "edited", 1) for c in range(100) for p in range(1, 41)]
    t = spark.createDataFrame(rows, "conv_id long, pos long, digest string, words long")
    n = spark.createDataFrame([(c, 40) for c in range(100)], "conv_id long, len long")
    C.trie(t, n)
    assert seen["trie-fine"].count() == 36 + 100 * 4


# ---- op13

def brute_simhash(rows, limit=3):
    fps = []
    for _, t in rows:
        w = lower(t or "").encode()
        w = re.findall(rb"[^\x20\x09-\x0D]+", w)
        sh = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    head = list(range(len(rows)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= limit:
                a, b = find(i), find(j)
                head[a] = b
    least = defaultdict(lambda: float("inf"))
    for i, r in enumerate(rows):
        least[find(i)] = min(least[find(i)], key(r[0]))
    got = [least[find(i)] for i in range(len(rows))]
    return sorted(((r[0], f"{f:016x}", None if g == float("inf") else g) for r, f, g in zip(rows, fps, got)), key=repr)


def test_simhash_odd_table(spark, tmp_path, monkeypatch):
    rows = odd_rows()
    path = write(spark, str(tmp_path), rows)
    want = brute_simhash([r[:2] for r in rows])
    assert collected(S.op13_simhash(spark, path)) == want
    monkeypatch.setattr(S, "BLOCK", 255)                        # long texts in many blocks
    assert collected(S.op13_simhash(spark, path)) == want


def test_simhash_empty(spark, tmp_path):
    assert S.op13_simhash(spark, write(spark, str(tmp_path), [])).count() == 0


def test_band_masks_cover_every_close_pair():
    rng = random.Random(1)
    for bands in (4, 5, 6):
        masks = S.band_masks(bands)
        for _ in range(300):
            x = sum(1 << b for b in rng.sample(range(64), 3))
            assert any(x & (m & (1 << 64) - 1) == 0 for m in masks)
    assert [S.bands_for(n) for n in (10, 10**6, 10**9, 10**11)] == [4, 5, 6, 8]


@pytest.mark.parametrize("bands,star", [(4, True), (5, True), (4, False), (6, False)])
def test_components_of_dense_clusters(spark, bands, star):
    """Random walks of bit flips, shells around a point and strangers, with and without the star phase."""
    rng = random.Random(bands)
    fps = set()
    for _ in range(4):
        at = rng.getrandbits(64)
        for _ in range(40):
            fps.add(at)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                at ^= 1 << b
    center = rng.getrandbits(64)
    for _ in range(150):
        x = center
        for b in rng.sample(range(64), rng.randint(2, 6)):
            x ^= 1 << b
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(100)} | {0, (1 << 64) - 1, 1 << 63}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x, 1 + x % 3) for x in signed], "fp long, n long")
    got = {r.fp: r.comp for r in S.components(df, bands=bands, star=star).collect()}
    comp = {x: x for x in signed}
    changed = True
    near = {x: [y for y in signed if ((x ^ y) & (1 << 64) - 1).bit_count() <= 3] for x in signed}
    while changed:
        changed = False
        for x in signed:
            m = min(comp[y] for y in near[x])
            changed |= m < comp[x]
            comp[x] = min(m, comp[x])
    assert got == comp


def test_pivot_differences_bound_distances(spark):
    rng = random.Random(6)
    a = [rng.getrandbits(63) for _ in range(50)]
    df = spark.createDataFrame([(x, x ^ (7 << rng.randint(0, 59))) for x in a], "x long, y long")
    for p in S.pivots():
        gap = F.abs(S.distance(F.col("x"), F.lit(p)) - S.distance(F.col("y"), F.lit(p)))
        assert df.where(gap > S.LIMIT).isEmpty()
