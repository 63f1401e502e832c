"""Prefix trie of conversations; subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns.  It is recognised by its depth and two
exclusive-ors of position-salted turn hashes, which are running totals along a
conversation, and named by (smallest member, depth).

Totals come from a contraction in join rounds.  Rake: every leaf gives its total to its
parent and leaves.  Compress: of the nodes with a single child (chains) an independent
set is spliced out, what they hold moving onto the edge above their child.  Each
round removes all leaves and a part of every chain, so the rounds grow with the
logarithm of the tree, not with its depth.  Re-expansion takes the spliced nodes back in
reverse: a node's total is what it held plus the total of the child it had.

Sums over children are aggregated before they are shuffled, and the joins are on keys
that are unique on one side, so a node with very many children or members is no
single task's burden.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from reelframe.llm.common import WORD, settle, stored, table

GROUP = 20  # conversations that share their first turns
SHARED = 4  # by 0 to 3 turns
BLOCK = 1024  # turns of a conversation that one running total takes at once
ID_BITS = 12  # ids of a range of 4096 are joined before they are shuffled
SUMS = ["n_leaves", "saved_tokens"]


# ---- rebuilt conversations -------------------------------------------------------

def _placed(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text, ...) with ``pos``, their place in the
    conversation from 0.  Sorted by ranges, so a long conversation is many tasks'
    work: a row's place is its place in its task plus the turns of earlier tasks."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "salt"]
    d = turns.withColumn("salt", F.monotonically_increasing_id() % 1024)  # splits equal rows
    d = d.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    d = d.select("conv_id", "h1", "h2", "words", F.spark_partition_id().alias("task"),
                 F.monotonically_increasing_id().alias("row"))
    d = stored(d, "trie-sorted")
    pieces = d.groupBy("conv_id", "task").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = W.partitionBy("conv_id").orderBy("task").rowsBetween(W.unboundedPreceding, -1)  # one row per task
    pieces = pieces.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0)))
    d = d.join(pieces.drop("n"), ["conv_id", "task"])
    return d.select("conv_id", (F.col("row") - F.col("first") + F.col("skip")).alias("pos"), "h1", "h2", "words")


def rebuilt(conversations: DataFrame, group: int = GROUP, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """(conv_id) of all conversations, and (conv_id, pos, h1, h2, words) of their
    rebuilt turns: the first ones of the group's first conversation, then their own."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    t = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    t = t.select("*", F.xxhash64(F.lit(17), "role", "text").alias("h1"), F.xxhash64(F.lit(31), "role", "text").alias("h2"),
                 F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    own = stored(_placed(t), "trie-placed")
    convs = stored(own.groupBy("conv_id").agg(F.count("*").alias("size")).select(
        "conv_id", "size", (F.col("conv_id") - F.pmod("conv_id", F.lit(group))).alias("donor"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).alias("h")), "trie-conversations")
    donors = convs.select(F.col("conv_id").alias("donor"), F.col("size").alias("donor_size"))
    plan = convs.join(donors, "donor", "left").select(
        "conv_id", "donor", "h", F.least("h", F.coalesce("donor_size", F.lit(0))).alias("taken"))
    first = own.where(F.col("pos") < shared - 1).withColumnRenamed("conv_id", "donor")
    lent = plan.where("taken > 0").join(first, "donor").where("pos < h").select("conv_id", "pos", "h1", "h2", "words")
    kept = own.join(plan, "conv_id").where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "h1", "h2", "words")
    return convs.select("conv_id"), lent.union(kept)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, g1, g2, p1, p2, words) of (conv_id, pos, h1, h2, words): keys
    of the first ``depth`` turns and of one turn less.  Running totals inside blocks of
    a conversation, then over the blocks."""
    salted = turns.select("conv_id", "pos", F.floor(F.col("pos") / BLOCK).alias("block"), "words",
                          F.xxhash64(F.lit(3), "pos", "h1").alias("s1"), F.xxhash64(F.lit(5), "pos", "h2").alias("s2"))
    inside = W.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    d = salted.select("*", F.bit_xor("s1").over(inside).alias("i1"), F.bit_xor("s2").over(inside).alias("i2"))
    blocks = salted.groupBy("conv_id", "block").agg(F.bit_xor("s1").alias("b1"), F.bit_xor("s2").alias("b2"))
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(c)
                                                 for c in ("b1", "b2")])
    d = d.join(blocks, ["conv_id", "block"])
    g1, g2 = F.col("i1").bitwiseXOR(F.col("b1")), F.col("i2").bitwiseXOR(F.col("b2"))
    return d.select("conv_id", (F.col("pos") + 1).alias("depth"), g1.alias("g1"), g2.alias("g2"),
                    g1.bitwiseXOR(F.col("s1")).alias("p1"), g2.bitwiseXOR(F.col("s2")).alias("p2"), "words")


# ---- tree contraction ------------------------------------------------------------

def _rake(tree: DataFrame, sums: list[str]) -> DataFrame:
    """``tree`` without its leaves.  Columns: node, parent, kids (number of children),
    what the node holds, and what lies on the edge above it (``on_...``)."""
    given = tree.where("kids = 0 AND parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("raked"), *[F.sum(F.col(c) + F.col(f"on_{c}")).alias(f"new_{c}") for c in sums])
    rest = tree.where("kids > 0").join(given, "node", "left")
    return rest.select("node", "parent", (F.col("kids") - F.coalesce("raked", F.lit(0))).alias("kids"),
                       *[(F.col(c) + F.coalesce(f"new_{c}", F.lit(0))).alias(c) for c in sums],
                       *[f"on_{c}" for c in sums])


def _chains(tree: DataFrame, sums: list[str], salt: int) -> DataFrame:
    """The nodes to splice out: they have a parent and one child, their coin shows
    heads, and their child's does not or it is no such node.  (node, kid, parent, what
    the child's edge gains, and what the node's total has besides the child's)."""
    chain = (F.col("kids") == 1) & F.col("parent").isNotNull()
    heads = chain & (F.xxhash64(F.lit(salt), "node") % 2 == 0)
    only = tree.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("n"), F.min("node").alias("kid")).where("n = 1").drop("n")
    below = tree.select(F.col("node").alias("kid"), heads.alias("next"), *[F.col(f"on_{c}").alias(f"edge_{c}") for c in sums])
    gone = tree.where(heads).join(only, "node").join(below, "kid").where("NOT next")
    return gone.select("node", "kid", "parent", *[(F.col(c) + F.col(f"on_{c}")).alias(f"gain_{c}") for c in sums],
                       *[(F.col(c) + F.col(f"edge_{c}")).alias(c) for c in sums])


def _spliced(tree: DataFrame, gone: DataFrame, sums: list[str]) -> DataFrame:
    moved = gone.select(F.col("kid").alias("node"), F.col("parent").alias("above"), *[f"gain_{c}" for c in sums])
    rest = tree.join(gone.select("node"), "node", "left_anti").join(moved, "node", "left")
    return rest.select("node", F.coalesce("above", "parent").alias("parent"), "kids", *sums,
                       *[(F.col(f"on_{c}") + F.coalesce(f"gain_{c}", F.lit(0))).alias(f"on_{c}") for c in sums])


def subtree_sums(tree: DataFrame, sums: list[str]) -> DataFrame:
    """(node, sums) over each node's subtree, of (node, parent, kids, sums): a forest
    whose roots have no parent; kids is the number of children; nodes are distinct
    and not null.  An empty table gives no rows.  The driver sees two row counts a
    round."""
    live = stored(tree.select("node", "parent", F.col("kids").cast("long").alias("kids"),
                              *[F.col(c).cast("long").alias(c) for c in sums],
                              *[F.lit(0).cast("long").alias(f"on_{c}") for c in sums]), "trie-tree")
    if not live.count():
        return live.select("node", *sums)
    rounds: list[tuple[DataFrame, DataFrame | None]] = []
    while live.count():
        leaves = live.where("kids = 0").select("node", *sums)  # their totals are known
        live = stored(_rake(live, sums), "trie-raked")
        gone = stored(_chains(live, sums, len(rounds)), "trie-chains")
        if gone.count():
            live = stored(_spliced(live, gone, sums), "trie-spliced")
            rounds.append((leaves, gone))
        else:
            rounds.append((leaves, None))
    # the child of a spliced node left in a later round or came back before it
    known: DataFrame | None = None
    for leaves, gone in reversed(rounds):
        if gone is not None:
            totals = known.select(F.col("node").alias("kid"), *[F.col(c).alias(f"kid_{c}") for c in sums])
            back = gone.join(totals, "kid").select("node", *[(F.col(c) + F.col(f"kid_{c}")).alias(c) for c in sums])
            known = known.union(stored(back, "trie-back"))
        known = leaves if known is None else known.union(leaves)
    return known


# ---- the trie --------------------------------------------------------------------

def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, depth, ids), sorted: SHA-256 over a node's ids, one after another."""
    last, digest = None, None
    out: list[tuple[int, int, str]] = []
    for batch in batches:
        for conv, depth, ids in zip(*[c.to_pylist() for c in batch.columns[:3]]):
            if (conv, depth) != last:
                if last is not None:
                    out.append((*last, digest.hexdigest()))
                last, digest = (conv, depth), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["conv_id", "depth", "ends_sha256"])
            out = []
    if last is not None:
        out.append((*last, digest.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["conv_id", "depth", "ends_sha256"])


def _ends(members: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of (conv_id, depth, member): ids are joined in
    ranges of at most 4096 before they are shuffled, then hashed as they stream by."""
    ranges = members.groupBy("conv_id", "depth", F.shiftright("member", ID_BITS).alias("range")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("member")), lambda c: c.cast("string")), ",").alias("ids"))
    d = ranges.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "range")
    return d.select("conv_id", "depth", "ids").mapInArrow(_hash_runs, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256) of every node of the trie of rebuilt ``conversations`` (conv_id, turn,
    role, text).

    Turns go by ``turn`` (null first), then role and text; a null role or text is
    empty; repeated rows are turns of their own.  Rows without an id are no
    conversation.  A conversation that has fewer turns than it would share may end up
    without any: it is a member of the root alone.  An empty table has no trie.
    Other columns are ignored.
    """
    def build() -> DataFrame:
        convs, turns = rebuilt(conversations, group, shared)
        p = stored(prefixes(turns), "trie-prefixes")
        # key of the node that a conversation ends in, the root's being 0, 0
        ends = p.groupBy("conv_id").agg(F.max_by(F.struct("depth", "g1", "g2"), "depth").alias("e"))
        zero = F.lit(0).cast("long")
        ends = convs.join(ends, "conv_id", "left").select(
            F.col("conv_id").alias("member"), *[F.coalesce(F.col(f"e.{c}"), zero).alias(c) for c in ("depth", "g1", "g2")])
        root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
            "conv_id", zero.alias("depth"), zero.alias("g1"), zero.alias("g2"), zero.alias("p1"), zero.alias("p2"),
            "n_convs", zero.alias("words"))
        nodes = p.groupBy("depth", "g1", "g2").agg(
            F.min("conv_id").alias("conv_id"), F.first("p1").alias("p1"), F.first("p2").alias("p2"),
            F.count("*").alias("n_convs"), F.first("words").alias("words"))
        nodes = stored(root.union(nodes.select(*root.columns)), "trie-nodes")
        above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("g1").alias("p1"), F.col("g2").alias("p2"),
                             F.col("conv_id").alias("parent_conv_id"))
        nodes = stored(nodes.join(above, ["depth", "p1", "p2"], "left").select(
            "conv_id", "depth", "g1", "g2", "parent_conv_id", "n_convs", "words"), "trie-nodes")
        kids = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias(
            "depth")).agg(F.count("*").alias("n_children"))
        nodes = stored(nodes.join(kids, ["conv_id", "depth"], "left").withColumn(
            "n_children", F.coalesce("n_children", zero)), "trie-nodes")

        def name(conv: str, depth: Column) -> Column:
            return F.when(F.col(conv).isNotNull(), F.struct(F.col(conv).alias("conv_id"), depth.alias("depth")))

        sums = subtree_sums(nodes.select(
            F.struct("conv_id", "depth").alias("node"), name("parent_conv_id", F.col("depth") - 1).alias("parent"),
            F.col("n_children").alias("kids"), (F.col("n_children") == 0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), SUMS)
        sums = sums.select("node.conv_id", "node.depth", *SUMS)
        members = ends.join(nodes.select("depth", "g1", "g2", "conv_id"), ["depth", "g1", "g2"])
        hashed = _ends(members.select("conv_id", "depth", "member"))
        out = nodes.join(sums, ["conv_id", "depth"]).join(hashed, ["conv_id", "depth"], "left")
        return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *SUMS,
                          F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
    return settle(conversations.sparkSession, "trie", build)


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
