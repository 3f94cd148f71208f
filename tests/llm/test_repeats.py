"""op2 and op4 against brute force: odd tables, empty tables, random sequences, long texts in slices."""
import random

import numpy as np
import pytest
from helpers import brute_substring, brute_suffix, collected, odd_rows, repeats, write

from stridex.llm import _repeats as R
from stridex.llm import _hashing as H
from stridex.llm.substring_dedup import cut_passages, op4_substring_dedup
from stridex.llm.suffix_dedup import cut_repeats, op2_suffix_dedup


def test_suffix_odd_table(spark, tmp_path):
    rows = odd_rows()
    got = collected(op2_suffix_dedup(spark, write(spark, str(tmp_path), rows)))
    assert got == sorted(brute_suffix(rows), key=repr)


def test_doubling_odd_table(spark, tmp_path):
    """Ranks of byte positions give the rows of the anchors, for two lengths; an empty table gives none."""
    docs = spark.read.parquet(write(spark, str(tmp_path), odd_rows()) + "/documents.parquet")
    for length in (200, 48):
        a, b = (collected(cut_repeats(docs, length, method=m)) for m in ("anchors", "doubling"))
        assert a == b
    assert cut_repeats(docs.where("false"), method="doubling").count() == 0


def test_substring_odd_table(spark, tmp_path):
    rows = odd_rows()
    got = collected(op4_substring_dedup(spark, write(spark, str(tmp_path), rows)))
    assert got == sorted(brute_substring(rows), key=repr)


def test_empty_tables(spark, tmp_path):
    path = write(spark, str(tmp_path), [])
    assert op2_suffix_dedup(spark, path).count() == 0
    assert op4_substring_dedup(spark, path).count() == 0


@pytest.mark.parametrize("seed,letters,length", [(1, 2, 12), (2, 3, 9), (3, 4, 20)])
def test_random_sequences(spark, seed, letters, length):
    """Few letters: chance repeats of all lengths around the threshold, ties of seeds, runs of one symbol."""
    rng = random.Random(seed)
    texts = ["".join(rng.choice("abcd"[:letters]) for _ in range(rng.randint(0, 120))) for _ in range(25)]
    texts += ["a" * 60, texts[0] + texts[1], texts[2], "ab" * 40]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in cut_repeats(df, length, blocks=(4, 1)).collect()}
    want = repeats([(i, t.encode()) for i, t in enumerate(texts)], length)
    assert got == {i: bytes(c for c, y in zip(t.encode(), m) if not y) for i, (t, (m, _)) in enumerate(zip(texts, want))}
    ranked = {r.doc_id: bytes(r.kept) for r in cut_repeats(df, length, method="doubling").collect()}
    assert ranked == got
    spaced = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in cut_passages(spaced, length, blocks=(3, 1)).collect()}
    assert got == {i: " ".join(c for c, y in zip(t, m) if not y).encode() for i, (t, (_, m)) in enumerate(zip(texts, want))}


def test_slices_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(R, "SLICE", 500)
    spec = R.Spec(20, 5, False, (4, 1), False)
    seqs = [np.frombuffer(random.Random(i).randbytes(n), np.uint8) for i, n in enumerate((3000, 0, 19, 20, 480))]
    seen = []
    for doc, a, rlo, rhi, seed, whole in R.runs(iter(seqs), spec):
        for d, x, lo, hi in zip(doc, a, rlo, rhi):
            seen += [(int(d), int(x - r)) for r in range(lo, hi + 1)]
    assert sorted(seen) == [(d, p) for d, s in enumerate(seqs) for p in range(len(s) - 19)]


def test_equal_windows_have_equal_anchors():
    """A window's anchor depends on its content only, wherever it stands."""
    spec = R.Spec(30, 6, False, (1,), False)
    rng = random.Random(3)
    core = rng.randbytes(200)
    seqs = [np.frombuffer(rng.randbytes(n) + core + rng.randbytes(50), np.uint8) for n in (0, 17, 333)]
    at = [{} for _ in seqs]
    for doc, a, rlo, rhi, _, _ in R.runs(iter(seqs), spec):
        for d, x, lo, hi in zip(doc, a, rlo, rhi):
            for r in range(lo, hi + 1):
                at[d][int(x - r)] = int(r)
    for p in range(171):
        assert len({at[d][p + n] for d, n in enumerate((0, 17, 333))}) == 1


def test_hashes_are_positional_free():
    s = np.frombuffer(b"abcabcabdabc", np.uint8)
    h = H.Hashes(s)
    e = h.every(3)
    assert e[0] == e[3] == e[9] != e[6]
    assert e[0] == h.of(np.array([3]), np.array([6]))[0]


def test_long_words_in_pieces(monkeypatch):
    monkeypatch.setattr(R, "SLICE", 64)
    raw = b" ".join(bytes([97 + i % 26]) * (i % 90 + 1) for i in range(200))
    whole = H.words_of(np.frombuffer(raw, np.uint8), R._BLANKS)[0]
    assert (R._long_words(raw) == whole).all()
