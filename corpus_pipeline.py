"""A corpus pipeline of five stages over ``documents``.

toxicity (rejected documents go) -> n-gram near duplicates (one document of each group stays) -> benchmark
decontamination (hit passages are cut, mostly hit documents go) -> secret scan (live credentials are masked) -> mixing
sources to target weights (each document with its number of copies).

Every stage takes (spark, docs, sf_dir), reads all of what its predecessor kept and returns a DataFrame; ``run`` writes
each result as Parquet and reads it again for the next one. All but the last return the columns of their input.

Defined results: a null or empty text is not toxic, has no near duplicate, no benchmark word and no secret, and stays to the
end with size 0 and as many copies as its source's rate of 1 gives (taken 0); a null doc_id is a document like any other,
the last of its group of near duplicates; of rows with equal id and text one stays, unless they have no words; a null
source is a source of its own; ties go by the smallest id; very long texts are read whole in every stage; an empty table
gives an empty result; further columns of any name pass through.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridex.config import apply_recommended
from stridex.llm import decontaminate, mixing, ngram_join, secrets, toxicity
from stridex.llm._common import read, remainder
from stridex.sources.tables import discard, materialize

REJECT_TOXIC = 0.5           # score from which a document goes
SHINGLE_WORDS = 5            # near duplicates: words of a shingle, and Jaccard in percent
NEAR_PERCENT = 80
MAX_HIT_SHARE = 0.5          # documents with a larger share of benchmark words go; of others the hit text is cut


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below ``REJECT_TOXIC`` by the model of the labelled rows."""
    apply_recommended(spark)
    labels = read(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 5) > 0).select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    scored = docs.select(F.struct("*").alias("__doc"), toxicity.toxicity(spark, model, F.col("text"), False).alias("__t"))
    return scored.where(F.col("__t.score") < REJECT_TOXIC).select("__doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of every near-duplicate component."""
    return ngram_join.keep_first(docs, ngram_join.Shingles(SHINGLE_WORDS), NEAR_PERCENT, name="pipeline-near")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of benchmark windows; documents that are mostly benchmark go."""
    d = decontaminate.contamination(docs, read(spark, sf_dir, "benchmark").select("item_id", "text"), with_offsets=True)
    d = d.where(F.col("c.n_hit") <= MAX_HIT_SHARE * F.col("c.n_words"))
    return d.select(*[F.col("c.kept").alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns])


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live credentials masked."""
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their size in words, copies and words taken by the mix (0 copies: the mix leaves it out).
    Columns of the input that are called like one of these come back as ``doc_<name>``."""
    d = materialize(docs.select(F.monotonically_increasing_id().alias("__id"), F.struct("*").alias("__doc"), "source",
                                mixing.words(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("__h")),
                    "pipeline-mix")
    c = mixing.copies(d.select("__id", "source", "size", "__h"), key="__id", order=F.col("__h"))
    mine = ("size", "copies", "taken")
    return d.select("__id", "__doc").join(c.select("__id", "size", "copies"), "__id").select(
        *[F.col("__doc").getField(x).alias(f"doc_{x}" if x in mine else x) for x in docs.columns],
        "size", "copies", (F.col("copies") * F.col("size")).alias("taken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("secret_scan", masked_secrets),
    ("mixing", mixed),
]

# The first stage's model can't be stated in SQL; the stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)
    return docs
