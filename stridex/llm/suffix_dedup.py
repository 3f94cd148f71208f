"""Deduplication of exact byte strings, in two ways with one result.

``method="doubling"`` (``_doubling``) is distributed prefix doubling: ranks of byte positions from pairs of ranks at growing
offsets, dropping unique positions. Measured, it does not keep the check tool's limits (README), so the query takes
``method="anchors"``: content-anchored window hashing, shared with op4. There the positions that are hashed are the anchors of
``_repeats``, about one in 85 bytes, chosen by content so that equal 200-byte strings have corresponding anchors. Round 1
counts the anchors by the 32 bytes at them; a position whose bytes are unique leaves. The following rounds count the
survivors by (seed, name) pairs of growing known length - 169 to 197 bytes in common, up to the full 200 - and let a
position go as soon as it is unique, or as soon as its string is past the threshold.

Defined results: null text is empty text; texts shorter than the threshold keep everything; repeated rows are documents
of their own, so both are removed as far as they reach the threshold; further columns are ignored by the query and pass
through ``dedup``.
"""
from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _doubling
from ._common import read, ship_by_value
from ._repeats import Spec, keyed, merged, pack, unpack, with_spans

ship_by_value(__name__)

LENGTH = 200
SEED = 32
BLOCKS = (32, 4, 1)


def cut_repeats(docs: DataFrame, length: int = LENGTH, seed: int | None = None, blocks=BLOCKS,
                doc_id: str = "doc_id", text: str = "text", method: str = "anchors") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans, kept) for every row: the bytes covered by a string of ``length`` bytes
    that starts anywhere else too are removed; ``spans`` are the maximal removed runs. ``method``: ``"anchors"`` or
    ``"doubling"`` (``_doubling``: the same result from ranks of byte positions)."""
    spec = Spec(length, seed or max(1, min(SEED, length // 4)), False, blocks, False)

    @F.pandas_udf("n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>, kept binary")
    def cut(zs: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for z, s in zip(zs.tolist(), spans.tolist()):
            raw = unpack(z)
            runs = merged(s, len(raw))
            at, keep = 0, []
            for b, e in runs:
                keep.append(raw[at:b])
                at = e
            keep.append(raw[at:])
            out.append((len(raw), sum(e - b for b, e in runs), [{"start": b, "stop": e} for b, e in runs], b"".join(keep)))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "spans", "kept"])

    d = keyed(docs, doc_id, text)
    if method == "anchors":
        d = with_spans(d, spec, "suffix")
    else:
        spans = _doubling.repeated(d, length, spec.seed, "suffix")
        d = d.select("doc_id", "ok", "th", pack(F.col("text")).alias("z")).join(spans, ["ok", "th"], "left")
    return d.select("doc_id", cut("z", "spans").alias("c")).select("doc_id", "c.*")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that belong to a 200-byte string found twice or more."""
    c = cut_repeats(read(spark, sf_dir, "documents"))
    return c.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                    F.sha2("kept", 256).alias("kept_sha256"))


# Positions are bytes: two hex digits each.
OP2_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 400)) AS s
        FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS p FROM d WHERE len(h) >= 400)),
rep AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
dup AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM win JOIN rep USING (s)),
run AS (SELECT doc_id, p, sum(CASE WHEN q IS NULL OR p > q + 200 THEN 1 ELSE 0 END)
               OVER (PARTITION BY doc_id ORDER BY p) AS g FROM dup),
span AS (SELECT doc_id, g, min(p) AS b, max(p) + 200 AS e FROM run GROUP BY doc_id, g),
edge AS (SELECT doc_id, e AS b, lead(b) OVER (PARTITION BY doc_id ORDER BY b) AS e FROM span
         UNION ALL SELECT doc_id, 0, min(b) FROM span GROUP BY doc_id
         UNION ALL SELECT doc_id, 0, NULL FROM d WHERE doc_id NOT IN (SELECT doc_id FROM span)),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * edge.b + 1, 2 * (coalesce(edge.e, len(h) // 2) - edge.b)), ''
                                   ORDER BY edge.b) AS k FROM edge JOIN d USING (doc_id) GROUP BY doc_id),
n AS (SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""
