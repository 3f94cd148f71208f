"""Prefix trie of conversations by fixed-length block hashing.

A conversation is a sequence of turns; a node is a distinct sequence of first ``d`` turns, the root has none. Turns are
hashed with their position, and a prefix is named by the exclusive or of its turns' hashes (128 bits), so the names of
prefixes of any length come from running aggregates and a name can be taken back by one turn.

1. Blocks first: each conversation is cut into blocks of ``BLOCK`` turns, hashed as a whole. Conversations that agree on all
   earlier blocks form a group.
2. Refinement: only in groups whose next blocks differ (other turns, or fewer) are single turn boundaries hashed for every
   member. Where all members continue with the same block, one of them stands for all.
3. A node belongs to its smallest conversation, and what a conversation owns is a suffix of its path. So a sum over a
   node's subtree is the sum, over its members, of what each owns from that depth on: running sums from each
   conversation's end, at block level for blocks that don't diverge, and one aggregate per node. Nothing walks the tree
   level by level or from parent to child.

Hot keys: turns are numbered through a range exchange over (conversation, turn, row), so a conversation with a third of all
rows is cut between tasks; running values go through two levels (``FAN`` blocks to a window); groups meet in partial
aggregates and in joins between written tables, which Spark can split. The digest of the conversations that end at a node is
one running SHA-256 over its sorted ids, which can't be divided: ids are packed into pieces of neighbouring ids first and
the pieces of a node stream through one task, with the memory of one piece.

Defined results: null roles and texts are empty; a null turn comes first; rows of one conversation with equal turns stand in
the order of the MD5 of (role, text); rows without a conv_id belong to no conversation; a conversation left without turns is
a member of the root only; an empty table has no nodes; texts of any length enter as their MD5; further columns are ignored.
"""
from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import discard, materialize
from ._common import read, ship_by_value

ship_by_value(__name__)

BLOCK = 4                     # turns of a block
FAN = 1024                    # blocks that one window scans
GROUP, TAKEN = 20, 4          # a conversation starts like the first of its twenty, for less than four turns
PIECE = 4096                  # neighbouring ids of a piece
WORD = r"[^\x20\x09-\x0D]+"


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pid, at, digest, words) per row with a conv_id, in order within ``pid``; and per (conv_id, pid) its first
    ``at``, its number of rows and the rows of the conversation before it."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    d = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("nth"))
    order = ["conv_id", F.asc_nulls_first("turn"), "digest", "nth"]
    n = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = d.repartitionByRange(n, *order).sortWithinPartitions(*order)
    d = materialize(d.select("conv_id", "digest", "words", F.spark_partition_id().alias("pid"),
                             F.monotonically_increasing_id().alias("at")), "trie-ordered")
    per = d.groupBy("conv_id", "pid").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("*", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    return d, materialize(per, "trie-parts")


def rebuilt(conversations: DataFrame, group: int = GROUP, taken: int = TAKEN) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, pos from 1, digest, words) and conversations (conv_id, len) after each conversation c got the first
    ``crc32(c) % taken`` turns of conversation ``c - c % group`` in place of as many of its own."""
    rows, per = numbered(conversations)
    own = per.groupBy("conv_id").agg(F.sum("c").alias("n")).select(
        "*", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % taken).alias("h"))
    own = materialize(own, "trie-conversations")
    first = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    info = own.join(first, "base", "left").select(
        "conv_id", "base", "n", F.when(F.col("conv_id") == F.col("base"), 0).otherwise(F.least("h", "n")).alias("dropped"),
        F.when(F.col("conv_id") == F.col("base"), 0).otherwise(F.least("h", F.coalesce("base_n", F.lit(0)))).alias("got"))
    info = materialize(info, "trie-plan")
    part = per.join(info.select("conv_id", "dropped", "got"), "conv_id")
    pos = F.col("at") - F.col("first") + F.col("before") + 1
    mine = rows.join(part, ["conv_id", "pid"]).select("conv_id", pos.alias("p"), "dropped", "got", "digest", "words")
    kept = mine.where("p > dropped").select("conv_id", (F.col("p") - F.col("dropped") + F.col("got")).alias("pos"), "digest", "words")
    donor = mine.where((F.col("p") < taken) & (F.col("conv_id") % group == 0)).select(
        F.col("conv_id").alias("base"), F.col("p").alias("pos"), "digest", "words")
    lent = donor.join(info.where("got > 0").select("conv_id", "base", "got"), "base").where("pos <= got").select(
        "conv_id", "pos", "digest", "words")
    turns = materialize(kept.unionByName(lent), "trie-turns")
    convs = materialize(info.select("conv_id", (F.col("n") - F.col("dropped") + F.col("got")).alias("len")), "trie-lengths")
    discard(rows, per, own, info)
    return turns, convs


def _running(df: DataFrame, values: list[str], combine, from_end: bool = False) -> DataFrame:
    """``df`` (conv_id, blk, ...) with ``to_<v>``: ``combine`` of ``v`` over the conversation's blocks up to this one (from the
    last one down to it with ``from_end``). Two levels: ``FAN`` blocks to a window, then their totals."""
    order = F.desc("blk") if from_end else F.asc("blk")
    d = df.select("*", F.expr(f"blk div {FAN}").alias("far"))
    near = Window.partitionBy("conv_id", "far").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.select("*", *[combine(F.col(v)).over(near).alias(f"near_{v}") for v in values])
    total = df.groupBy("conv_id", F.expr(f"blk div {FAN}").alias("far")).agg(*[combine(F.col(v)).alias(v) for v in values])
    over = Window.partitionBy("conv_id").orderBy(F.desc("far") if from_end else F.asc("far")).rowsBetween(
        Window.unboundedPreceding, -1)
    total = total.select("conv_id", "far", *[F.coalesce(combine(F.col(v)).over(over), F.lit(0)).alias(f"far_{v}") for v in values])
    d = d.join(total, ["conv_id", "far"])
    both = (lambda a, b: a.bitwiseXOR(b)) if combine is F.bit_xor else (lambda a, b: a + b)
    return d.select(*df.columns, *[both(F.col(f"near_{v}"), F.col(f"far_{v}")).alias(f"to_{v}") for v in values])


def _xor(a: str, b: str) -> Column:
    return F.col(a).bitwiseXOR(F.col(b))


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): SHA-256 of the sorted ids of the conversations (conv_id) that end at each node."""
    node = ["depth", "a", "b"]
    pieces = ends.groupBy(*node, F.expr(f"conv_id div {PIECE}").alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    pieces = materialize(pieces, "trie-pieces")
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = "depth long, a long, b long, ends_sha256 string"

    def run(batches):
        at, h = None, None
        for batch in batches:
            rows = list(zip(*[batch.column(c).to_pylist() for c in (*node, "ids")]))
            out = []
            for *key, ids in rows:
                if key != at:
                    if at is not None:
                        out.append((*at, h.hexdigest()))
                    at, h = key, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip([*node, "ends_sha256"], r)) for r in out], schema=schema)
        if at is not None:
            yield pa.RecordBatch.from_pylist([dict(zip([*node, "ends_sha256"], (*at, h.hexdigest())))], schema=schema)
    schema = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])
    done = materialize(pieces.select(F.col("depth").cast("long").alias("depth"), "a", "b", "piece", "ids").repartition(n, *node)
                       .sortWithinPartitions(*node, "piece").drop("piece").mapInArrow(run, kinds), "trie-ends")
    discard(pieces)
    return done


def trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, pos from 1 without gaps, digest, words); ``convs`` (conv_id, len)
    names every conversation, turnless ones too. Columns as in ``op12_conversation_trie``."""
    rows = turns.select("conv_id", F.col("pos").cast("long").alias("pos"), "words",
                        F.expr(f"cast((pos - 1) div {block} AS long)").alias("blk"),
                        F.xxhash64(F.lit(1), F.col("pos").cast("long"), "digest").alias("x"),
                        F.xxhash64(F.lit(2), F.col("pos").cast("long"), "digest").alias("y"))
    # 1. blocks, named by the prefix before (p, q) and after (to_x, to_y) them
    blocks = rows.groupBy("conv_id", "blk").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    blocks = _running(materialize(blocks, "trie-blocks"), ["x", "y"], F.bit_xor)
    blocks = materialize(blocks.select("conv_id", "blk", _xor("to_x", "x").alias("p"), _xor("to_y", "y").alias("q"),
                                       "to_x", "to_y"), "trie-named")
    after = F.struct("to_x", "to_y")
    groups = blocks.groupBy("blk", "p", "q").agg(F.min(after).alias("lo"), F.max(after).alias("hi"),
                                                 F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("rep"))
    groups = materialize(groups.select("blk", "p", "q", "members", "rep", (F.col("lo") != F.col("hi")).alias("split")),
                         "trie-groups")
    # 2. single turns: of every member where blocks diverge, else of the group's smallest conversation
    kept = materialize(blocks.join(groups, ["blk", "p", "q"]).where("split or conv_id = rep").select(
        "conv_id", "blk", "p", "q", "split", F.when(F.col("split"), 1).otherwise(F.col("members")).alias("weight")), "trie-kept")
    inside = Window.partitionBy("conv_id", "blk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    fine = rows.join(kept, ["conv_id", "blk"]).select(
        "conv_id", "blk", "pos", "words", "weight", "split", "x", "y",
        F.col("p").bitwiseXOR(F.bit_xor("x").over(inside)).alias("a"), F.col("q").bitwiseXOR(F.bit_xor("y").over(inside)).alias("b"))
    fine = materialize(fine.select("*", _xor("a", "x").alias("up_a"), _xor("b", "y").alias("up_b")).drop("x", "y"), "trie-fine")
    nodes = fine.groupBy(F.col("pos").alias("depth"), "a", "b").agg(
        F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
        F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"))
    top = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "n_convs",
        "conv_id", F.lit(0).cast("long").alias("words"), F.lit(None).cast("long").alias("up_a"), F.lit(None).cast("long").alias("up_b"))
    nodes = materialize(nodes.unionByName(top), "trie-nodes")
    up = (F.col("depth") - 1).alias("depth")
    kids = materialize(nodes.where("depth > 0").groupBy(up, F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(
        F.count(F.lit(1)).alias("n_children")), "trie-children")
    nodes = nodes.join(kids, ["depth", "a", "b"], "left").select(*nodes.columns, F.coalesce("n_children", F.lit(0)).alias("n_children"))
    nodes = materialize(nodes.select("*", ((F.col("n_convs") - 1) * F.col("words")).alias("saves"),
                                     (F.col("n_children") == 0).cast("long").alias("leaf")), "trie-weighed")
    # 3. what every conversation owns from a block's end on, summed over the members of a block that doesn't diverge
    owned = nodes.where("depth > 0").groupBy("conv_id", F.expr(f"cast((depth - 1) div {block} AS long)").alias("blk")).agg(
        F.sum("saves").alias("saves"), F.sum("leaf").alias("leaf"))
    path = blocks.select("conv_id", "blk", "p", "q").join(owned, ["conv_id", "blk"], "left").select(
        "conv_id", "blk", "p", "q", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("saves", "leaf")])
    path = _running(materialize(path, "trie-owned"), ["saves", "leaf"], F.sum, from_end=True)
    path = materialize(path.select("conv_id", "blk", "p", "q", (F.col("to_saves") - F.col("saves")).alias("s"),
                                   (F.col("to_leaf") - F.col("leaf")).alias("f")), "trie-later")
    whole = path.groupBy("blk", "p", "q").agg(F.sum("s").alias("s"), F.sum("f").alias("f"))
    tails = kept.where("split").select("conv_id", "blk").join(path.select("conv_id", "blk", "s", "f"), ["conv_id", "blk"])
    tails = tails.unionByName(kept.where("not split").join(whole, ["blk", "p", "q"]).select("conv_id", "blk", "s", "f"))
    own = nodes.where("depth > 0").select("conv_id", F.col("depth").alias("pos"), "saves", "leaf")
    sums = fine.select("conv_id", "blk", "pos", "a", "b").join(own, ["conv_id", "pos"], "left").join(tails, ["conv_id", "blk"])
    rest = Window.partitionBy("conv_id", "blk").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.select(F.col("pos").alias("depth"), "a", "b",
                       (F.coalesce(F.sum("saves").over(rest), F.lit(0)) + F.col("s")).alias("s"),
                       (F.coalesce(F.sum("leaf").over(rest), F.lit(0)) + F.col("f")).alias("f"))
    sums = sums.groupBy("depth", "a", "b").agg(F.sum("s").alias("saved_tokens"), F.sum("f").alias("n_leaves"))
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "a", "b")]
    all_ = nodes.agg(F.sum("saves").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    sums = materialize(sums.unionByName(all_.where("n_leaves is not null").select(*zero, "saved_tokens", "n_leaves")), "trie-sums")
    # where conversations end
    last = blocks.groupBy("conv_id").agg(F.max(F.struct("blk", "to_x", "to_y")).alias("e"))
    ends = convs.select("conv_id", F.col("len").cast("long").alias("depth")).join(last, "conv_id", "left").select(
        "depth", F.coalesce("e.to_x", F.lit(0)).alias("a"), F.coalesce("e.to_y", F.lit(0)).alias("b"), "conv_id")
    ends = ends_digest(ends)
    named = nodes.select("depth", "a", "b", F.col("conv_id").alias("parent_conv_id")).select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), "parent_conv_id")
    out = nodes.join(sums, ["depth", "a", "b"]).join(ends, ["depth", "a", "b"], "left")
    out = materialize(out.join(named, ["depth", "up_a", "up_b"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")), "trie")
    discard(blocks, groups, kept, fine, kids, nodes, path, sums, ends)
    return out


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations."""
    turns, convs = rebuilt(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    out = trie(turns, convs)
    discard(turns, convs)
    return out


# crc32 by its table; prefixes are named by the MD5 of their turns' digests.
OP12_SQL = r"""
WITH RECURSIVE tab AS (SELECT i::BIGINT AS i, 0 AS k, i::BIGINT AS v FROM range(256) r(i) UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM tab WHERE k < 8),
own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
  ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS base FROM own GROUP BY ALL),
crc AS (SELECT conv_id, conv_id::VARCHAR AS s, 4294967295::BIGINT AS c FROM n UNION ALL
  SELECT conv_id, s[2:], xor(c >> 8, v) FROM crc JOIN tab ON k = 8 AND i = xor(c, ascii(s)::BIGINT) & 255 WHERE s <> ''),
plan AS (SELECT n.conv_id, n.base, CASE WHEN n.conv_id = n.base THEN 0 ELSE xor(c, 4294967295) % 4 END AS h,
  coalesce(f.n, 0) AS base_n FROM n JOIN crc ON crc.conv_id = n.conv_id AND s = '' LEFT JOIN n f ON f.conv_id = n.base),
turns AS (SELECT conv_id, p - h + least(h, base_n) AS pos, role, text FROM own JOIN plan USING (conv_id) WHERE p > h
  UNION ALL SELECT plan.conv_id, p, role, text FROM plan JOIN own ON own.conv_id = base AND p <= h),
named AS (SELECT conv_id, pos AS depth, md5(string_agg(md5(length(role) || ':' || role || text), ',' ORDER BY pos)
  OVER (PARTITION BY conv_id ORDER BY pos)) AS name, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM turns
  UNION ALL SELECT conv_id, 0, 'root', 0 FROM n),
node AS (SELECT depth, name, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) * (count(*) - 1) AS saves
  FROM named GROUP BY ALL),
edge AS (SELECT DISTINCT a.depth, a.name, b.name AS up FROM named a JOIN named b ON a.conv_id = b.conv_id AND a.depth = b.depth + 1),
kids AS (SELECT depth - 1 AS depth, up AS name, count(*) AS n_children FROM edge GROUP BY ALL),
below AS (SELECT DISTINCT a.depth, a.name, b.depth AS d, b.name AS x FROM named a JOIN named b ON a.conv_id = b.conv_id
  AND b.depth >= a.depth),
subtree AS (SELECT below.depth, below.name, sum(saves) AS saved_tokens, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves
  FROM below JOIN node ON node.depth = d AND node.name = x LEFT JOIN kids ON kids.depth = d AND kids.name = x GROUP BY ALL),
x AS (SELECT depth, name, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM (SELECT *, max(depth) OVER
  (PARTITION BY conv_id) AS m FROM named) WHERE depth = m GROUP BY ALL)
SELECT node.conv_id, node.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, node.n_convs::BIGINT AS n_convs,
  coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM node JOIN subtree USING (depth, name) LEFT JOIN kids USING (depth, name) LEFT JOIN x USING (depth, name)
LEFT JOIN edge ON edge.depth = node.depth AND edge.name = node.name
LEFT JOIN node p ON p.depth = node.depth - 1 AND p.name = edge.up
"""
