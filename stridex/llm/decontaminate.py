"""Benchmark decontamination: one Aho-Corasick automaton over the normalised windows of the benchmark items.

Text is normalised to lower-case words between single blanks, and each window of 10 item words (a shorter item is one
window) is a pattern with a blank at either end, so that a match always covers whole words. Each document is scanned
once; match ends map back to word numbers and, for the documents that match, to offsets of the original text.

The automaton is broadcast and built once per worker. Its size is bounded by ``MAX_PATTERN_BYTES`` of patterns (an automaton
takes about 50 times its patterns): a benchmark beyond that is dealt into blocks by window hash, scanned one after the
other, each writing the hits it finds; a document's hits are the union over the blocks. Nothing is left out either way.

Defined results: null or wordless texts have no words and no hits; items without a word match nothing; windows that
several items share count for each of them; repeated rows get equal results; all columns of the input pass through, inside
a struct, so that no name clashes; an empty table gives no rows, an empty benchmark no hits; long texts are scanned whole.
"""
from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import discard, materialize
from ._common import lower_ascii, read, ship_by_value

ship_by_value(__name__)

WINDOW = 10
MAX_PATTERN_BYTES = 2_000_000        # of one automaton, which takes about 50 times as much
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"     # after lower-casing A-Z
# Byte map of the normalisation: A-Z to lower case, every other ASCII byte that is no letter or digit to a blank.
_MAP = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_RAW_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_MAP).split(b" ")


def automaton(patterns: list[str]):
    """Automaton whose values are (pattern number, words of the pattern)."""
    import ahocorasick
    a = ahocorasick.Automaton()
    for i, p in enumerate(patterns):
        a.add_word(" " + p.encode("utf-8").decode("latin-1") + " ", (i, p.count(" ") + 1))
    a.make_automaton()
    return a


def scan(text: str | None, machine, owners: list[list[str]]):
    """(number of words, merged word intervals [b, e) that are hit, ids of the items found)."""
    words = [w for w in _words(text) if w] if text else []
    if not words or not len(machine):
        return len(words), [], []
    line = b" " + b" ".join(words) + b" "
    found = list(machine.iter(line.decode("latin-1")))
    if not found:
        return len(words), [], []
    ends = np.cumsum([len(w) + 1 for w in words])        # line index of the blank after each word
    at = np.searchsorted(ends, [e for e, _ in found]) + 1
    hits, items = [], set()
    for e, (_, (i, n)) in zip(at.tolist(), found):
        hits.append((e - n, e))
        items.update(owners[i])
    return len(words), merged(hits), sorted(items)


def merged(intervals) -> list[list[int]]:
    """The union of intervals [b, e) as maximal runs, in order."""
    runs: list[list[int]] = []
    for b, e in sorted(intervals):
        if runs and b <= runs[-1][1]:
            runs[-1][1] = max(e, runs[-1][1])
        else:
            runs.append([b, e])
    return runs


def offsets(text: str, intervals) -> list[tuple[int, int]]:
    """Code point offsets in the original text of word intervals."""
    spans = [m.span() for m in _RAW_WORD.finditer(text)]
    return [(spans[b][0], spans[e - 1][1]) for b, e in intervals]


def windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """(window, items): the distinct word windows of the benchmark and the ids, as strings, that have them."""
    w = F.regexp_extract_all(lower_ascii(F.col(text)), F.lit(f"({WORD})"), F.lit(1))
    b = benchmark.select(F.col(item_id).cast("string").alias("i"), w.alias("w")).where("i is not null and size(w) > 0")
    b = b.select("i", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))).alias("k"))
    b = b.select("i", F.concat_ws(" ", F.slice("w", F.col("k"), size)).alias("window"))
    return b.groupBy("window").agg(F.sort_array(F.collect_set("i")).alias("items"))


FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<start:int,stop:int>>, kept string"
_NAMES = ["n_words", "n_hit", "items", "spans", "kept"]


def _found(text: str | None, words: int, runs, items, with_offsets: bool):
    at = offsets(text, runs) if with_offsets and runs else []
    kept = "".join(text[b:e] for b, e in zip([0, *[e for _, e in at]], [*[b for b, _ in at], len(text)])) if at else text
    return words, sum(e - b for b, e in runs), items, [{"start": b, "stop": e} for b, e in at], kept if with_offsets else None


def _machine(shared):
    block = shared.value
    if "machine" not in block:                             # built once per worker
        block["machine"] = automaton(block["patterns"])
    return block["machine"], block["owners"]


def _scan_all(shared, with_offsets: bool):
    """A text's result from one automaton. Nondeterministic for the optimizer, which else runs it again in a filter."""
    @F.pandas_udf(FOUND)
    def run(texts: pd.Series) -> pd.DataFrame:
        machine, owners = _machine(shared)
        return pd.DataFrame([_found(t, *scan(t, machine, owners), with_offsets) for t in texts.tolist()],
                            columns=_NAMES)
    return run.asNondeterministic()


def _scan_block(shared):
    @F.pandas_udf("hits array<array<int>>, items array<string>")
    def run(texts: pd.Series) -> pd.DataFrame:
        machine, owners = _machine(shared)
        return pd.DataFrame([scan(t, machine, owners)[1:] for t in texts.tolist()], columns=["hits", "items"])
    return run.asNondeterministic()


def _union(with_offsets: bool):
    @F.pandas_udf(FOUND)
    def run(texts: pd.Series, hits: pd.Series, items: pd.Series) -> pd.DataFrame:
        rows = []
        for t, h, i in zip(texts.tolist(), hits.tolist(), items.tolist()):
            n = sum(1 for w in _words(t) if w) if t else 0
            rows.append(_found(t, n, merged(tuple(x) for x in h) if h is not None else [],
                               sorted(set(i)) if i is not None else [], with_offsets))
        return pd.DataFrame(rows, columns=_NAMES)
    return run.asNondeterministic()


def contamination(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW,
                  limit: int = MAX_PATTERN_BYTES, with_offsets: bool = False, doc_text: str = "text") -> DataFrame:
    """(doc, c) of every row: the row as a struct and a struct (n_words, n_hit, items) of its text ``doc_text``, with
    ``with_offsets`` also its spans, as code point offsets, and the text without them (``kept``)."""
    spark = docs.sparkSession
    table = materialize(windows(benchmark, item_id, text, size), "decontaminate-windows")
    total = table.agg(F.sum(F.octet_length("window"))).first()[0] or 0
    blocks = max(1, -(-int(total) // limit))

    def block(k: int):
        part = table if blocks == 1 else table.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k)
        rows = part.orderBy("window").collect()            # about ``limit`` bytes of patterns
        return spark.sparkContext.broadcast({"patterns": [r[0] for r in rows], "owners": [list(r[1]) for r in rows]})
    if blocks == 1:
        out = docs.select(F.struct("*").alias("doc"), _scan_all(block(0), with_offsets)(F.col(doc_text)).alias("c"))
        discard(table)
        return out
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")),
                       "decontaminate-rows")
    said, found = f"doc.`{doc_text}`", None
    for k in range(blocks):
        shared = block(k)
        one = rows.where(f"{said} is not null").select("row", _scan_block(shared)(F.col(said)).alias("s"))
        one = materialize(one.where("size(s.hits) > 0").select("row", "s.hits", "s.items"), "decontaminate-hits")
        shared.unpersist()
        found = one if found is None else found.unionByName(one)
    discard(table)
    per = found.groupBy("row").agg(F.flatten(F.collect_list("hits")).alias("hits"),
                                   F.flatten(F.collect_list("items")).alias("items"))      # a list per block
    d = rows.join(per, "row", "left")
    return d.select("doc", _union(with_offsets)(F.col(said), "hits", "items").alias("c"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a benchmark window, and the items they come from."""
    d = contamination(read(spark, sf_dir, "documents").select("doc_id", "text"),
                      read(spark, sf_dir, "benchmark").select("item_id", "text"))
    return d.select("doc.doc_id", "c.n_words", "c.n_hit", F.size("c.items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "c.items"), 256).alias("items_sha256"),
                    (F.col("c.n_hit") > 0).alias("contaminated"))


# Lower case of A-Z only; the word pattern is the one above in RE2 notation.
OP3_SQL = r"""
WITH b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, k, k + 9), ' ') AS win
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
lens AS (SELECT DISTINCT n FROM win),
occ AS (SELECT doc_id, n, k, array_to_string(list_slice(w, k, k + n - 1), ' ') AS win
        FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS k FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT occ.doc_id, occ.k, occ.n, win.item_id FROM occ JOIN win USING (n, win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""
