"""op7 against brute force; keep_first; the star phase's remainder."""
import random

from helpers import brute_components, collected, odd_rows, sentence, write

from stridex.llm import ngram_join as N
from stridex.llm.spotsigs import near_duplicate_groups


def test_components_odd_table(spark, tmp_path):
    rows = odd_rows()
    path = write(spark, str(tmp_path), rows)
    got = collected(N.op7_ngram_join(spark, path))
    assert got == sorted(brute_components(rows), key=repr)
    kept = collected(N.keep_first(spark.read.parquet(f"{path}/documents.parquet"), N.Shingles(3), 90))
    comp = brute_components(rows)
    assert len(kept) == len({c for _, n, c in comp if n}) + sum(n == 0 for _, n, _ in comp)
    assert all(len(r) == len(spark.read.parquet(f"{path}/documents.parquet").columns) for r in kept)


def test_empty_table(spark, tmp_path):
    path = write(spark, str(tmp_path), [])
    assert N.op7_ngram_join(spark, path).count() == 0
    assert N.keep_first(spark.read.parquet(f"{path}/documents.parquet")).count() == 0


def test_chains_and_boilerplate(spark):
    """Chains of edits (linked only step by step), a line that all documents share, many copies."""
    rng = random.Random(5)
    line = sentence(15, rng)
    rows, i = [], 0
    for _ in range(6):
        w = sentence(90, rng).split()
        for step in range(8):
            rows.append((i, " ".join(w) + " " + line))
            i += 1
            for _ in range(rng.randint(1, 3)):
                w[rng.randrange(len(w))] = "".join(rng.choice("klmnop") for _ in range(5))
        rows += [(i + k, rows[-1][1]) for k in range(3)]
        i += 3
    rows += [(i + k, line) for k in range(4)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for n, percent in ((3, 90), (5, 80)):
        got = sorted((r.doc_id, r.n, r.head) for r in N.near_duplicates(df, N.Shingles(n), percent).collect())
        assert got == sorted(brute_components(rows, n, percent))


def test_second_phase_finds_what_the_star_misses(spark, monkeypatch):
    """Without any star pair the remaining pairs alone give the same components."""
    rows = [(i, t) for i, t in enumerate(["a b c d e f g h i j k l m n o p q r s t u v w x y z"] * 2)]
    w = rows[0][1].split()
    for i in range(2, 12):
        v = w.copy()
        v[i * 2] = "q%d" % i
        rows.append((i, " ".join(v + ["tail%d" % (i // 2)] * 60)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n, r.head) for r in N.near_duplicates(df, N.Shingles(3), 60).collect())
    assert got == sorted(brute_components(rows, 3, 60))


def test_prefix_length():
    for p in (60, 80, 90):
        for n in range(1, 300):
            assert N.prefix_length(n, p) == n - -(-p * n // 100) + 1


def test_spot_signature_groups(spark):
    rng = random.Random(9)
    base = " ".join(x + " the " + y for x, y in zip(sentence(80, rng).split(), sentence(80, rng).split()))
    rows = [(1, base), (2, base + " extra words"), (3, base.upper()), (4, sentence(60, rng)), (5, None), (6, "")]
    got = {r.doc_id: r.head for r in near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6}
