"""Substring deduplication by seed and extend: repeated passages keep their first occurrence only.

Seeds are the winnowed anchors of ``_repeats`` over words. Documents meet on equal seeds; a seed's match is extended
both ways to the full reach of the windows it stands for. The extension is compared by the name of the extended stretch
with all other occurrences at once, as an aggregate: pairwise extension is quadratic in the number of copies. Where a
stretch matches only in part, it is cut into blocks and then windows, which give the exact ends of the match; maximal
repeats of at least ``WORDS`` words remain, as merged runs.

Defined results: null text has no words; documents are ordered by id, null ids last; rows of one id count as the same
document, and of equal rows each keeps its words or loses them alike; texts longer than a slice are cut into overlapping
slices, so their length doesn't matter; an empty table gives no rows; further columns are ignored.
"""
from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import read, ship_by_value
from ._repeats import Spec, keyed, merged, split_words, unpack, with_spans

ship_by_value(__name__)

WORDS = 20
SEED = 6
BLOCKS = (4, 1)


def cut_passages(docs: DataFrame, words: int = WORDS, seed: int | None = None, blocks=BLOCKS,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) for every row: words covered by a window of ``words`` words that starts
    earlier too are removed; ``spans`` are the maximal removed runs, ``kept`` the rest joined by one blank."""
    spec = Spec(words, seed or max(1, min(SEED, words // 3)), True, blocks, True)

    @F.pandas_udf("n_words long, n_removed long, spans array<struct<start:long,stop:long>>, kept binary")
    def cut(zs: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for z, s in zip(zs.tolist(), spans.tolist()):
            ws = split_words(unpack(z))
            runs = merged(s, len(ws))
            at, keep = 0, []
            for b, e in runs:
                keep += ws[at:b]
                at = e
            keep += ws[at:]
            out.append((len(ws), sum(e - b for b, e in runs), [{"start": b, "stop": e} for b, e in runs], b" ".join(keep)))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "spans", "kept"])

    d = with_spans(keyed(docs, doc_id, text), spec, "substring").select("doc_id", cut("z", "spans").alias("c"))
    return d.select("doc_id", "c.*")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that belong to a 20-word passage found earlier."""
    c = cut_passages(read(spark, sf_dir, "documents"))
    return c.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, k, md5(array_to_string(list_slice(w, k, k + 19), ' ')) AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS k FROM d WHERE len(w) >= 20)),
dup AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY s ORDER BY doc_id, k) AS r FROM win)
        WHERE r > 1),
hit AS (SELECT DISTINCT doc_id, unnest(range(k, k + 20)) AS p FROM dup),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS c FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(c, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""
