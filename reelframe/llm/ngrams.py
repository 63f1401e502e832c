"""N-gram Jaccard join by T-occurrence search.

1. Every document's set of word-shingle hashes gives a digest, and signatures
   that two linked documents must share: two sets that differ in at most ``d``
   shingles, hashed into ``d + 1`` parts or more, agree on a whole part.  Sizes are
   classed so that linked documents use the same number of parts.
2. Equal sets are one class.  Classes that share a signature meet at the smallest
   of them, the centre of a star; every linked pair lies in one star.
3. A star is cut into blocks that each hold the centre.  In a block the linked
   documents are found by T-occurrence search on inverted lists (DivideSkip: the
   short lists are merged by a heap, the long ones are probed by binary search),
   the centre first, then every document outside the largest component, so a
   block of near copies costs one search.  Members of other blocks that did not
   reach the centre are searched against the remaining blocks.
4. The links, a spanning set rather than all pairs, go to connected components.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from reelframe.llm.common import join_checked, per_worker, runs, settle, stored, table
from reelframe.llm.components import connected_components

BLOCK_DOCS = 256
BLOCK_SHINGLES = 1_000_000
ROUNDS = 6  # partitions tried while a document has too many empty parts
MEMO_WORDS = 150_000
MU = 0.01  # DivideSkip's balance between merging and probing
SETS = "doc_id long, n_shingles long, d1 long, d2 long, sigs array<long>"


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (public constants of splitmix64)."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word to 64-bit hash, bounded."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Ascending distinct hashes of the ``k``-word shingles of the text, lower-cased
    in A-Z.  Words are split at ASCII white space; fewer than ``k`` words are one
    shingle; no words: an empty set."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    memo = per_worker("word_hashes", WordHashes)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
    if n < k:
        s = mix(np.array([n], np.uint64), 7)
        for x in h:
            s = mix(s + x, 3)
        return s
    s = mix(h[:n - k + 1], 1)
    for i in range(1, k):
        s = mix(s + h[i:n - k + 1 + i], 1)
    return np.unique(s)


class Scheme:
    """Size classes and part counts for a threshold num/den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.bounds = [1, 2]
        self.parts: dict[int, tuple[int, int]] = {}

    def most_apart(self, size: int) -> int:
        """Largest symmetric difference of linked sets, the smaller of which has ``size``."""
        return size * (self.den - self.num) // self.num

    def class_of(self, size: int) -> int:
        while self.bounds[-1] <= size:
            self.bounds.append(self.bounds[-1] * self.den // self.num + 1)
        return int(np.searchsorted(self.bounds, size, side="right")) - 1

    def plan(self, c: int) -> tuple[int, int]:
        """(d, parts) for pairs whose smaller set is in class ``c``.  Some spare
        parts make up for the parts that stay empty."""
        if c not in self.parts:
            d = self.most_apart(self.bounds[c + 1] - 1)
            p = d + 1
            for _ in range(20):
                empty = p * np.exp(-self.bounds[c] / p)
                p = min(d + 1 + int(empty + 1.5 * np.sqrt(empty)), d + 1 + (d + 1) // 8)
            self.parts[c] = d, p
        return self.parts[c]

    def signatures(self, s: np.ndarray) -> np.ndarray:
        """Keys of which two linked, different sets share at least one.

        A set with so many empty parts that equal parts might all be empty goes
        through further partitions (both sets of such a pair do), and in the end
        to one key of its class."""
        c = self.class_of(len(s))
        out = []
        for scheme in (c, c - 1):
            if scheme < 0:
                continue
            d, p = self.plan(scheme)
            if not d:
                continue  # only equal sets link
            for turn in range(ROUNDS):
                part = (mix(s, 101 + turn) % np.uint64(p)).astype(np.int64)
                count = np.bincount(part, minlength=p)
                total = np.zeros(p, np.uint64)
                np.add.at(total, part, mix(s, 211 + turn))
                full = np.flatnonzero(count)
                tag = np.uint64((scheme * ROUNDS + turn) << 32)
                out.append(mix(total[full] + mix(full.astype(np.uint64) + tag, 5), 9))
                if p - len(full) < p - d:
                    break
            else:
                out.append(mix(np.array([scheme], np.uint64), 977))
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _sets(k: int, num: int, den: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheme = Scheme(num, den)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                n, d1, d2, sigs = [], [], [], []
                for x in part.column(1):
                    s = shingle_set(x.as_py(), k)
                    n.append(len(s))
                    d1.append(mix(s, 31).sum())
                    d2.append(mix(s, 37).sum())
                    sigs.append(scheme.signatures(s) if len(s) else s)
                ends = np.cumsum([0] + [len(x) for x in sigs]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(np.array(d1, np.uint64).view(np.int64)),
                     pa.array(np.array(d2, np.uint64).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sigs).view(np.int64)))],
                    names=["doc_id", "n_shingles", "d1", "d2", "sigs"])
    return build


class Block:
    """Inverted lists over the shingle sets of a block."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int):
        self.sets, self.num, self.den = sets, num, den
        self.size = np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(every, kind="stable")
        self.tokens, first = np.unique(every[order], return_index=True)
        self.owner = owner[order]
        self.ends = np.append(first, len(every))

    def search(self, q: int) -> np.ndarray:
        """Documents linked to ``q``: those on at least the required number of
        its inverted lists."""
        at = np.searchsorted(self.tokens, self.sets[q])
        begin, end = self.ends[at], self.ends[at + 1]
        order = np.argsort(end - begin, kind="stable")
        begin, end = begin[order], end[order]
        need = -(-self.num * len(at) // self.den)  # any linked set holds that many of q's shingles
        longest = int(end[-1] - begin[-1])
        n_long = min(need - 1, int(need / (MU * np.log2(max(longest, 2)) + 1)))
        cut = len(at) - n_long
        short = [self.owner[b:e].tolist() for b, e in zip(begin[:cut], end[:cut])]
        found, seen = [], []
        for doc, hits in groupby(heapq.merge(*short)):
            count = sum(1 for _ in hits)
            if count >= need - n_long and doc != q:
                found.append(doc)
                seen.append(count)
        docs, counts = np.array(found, np.int64), np.array(seen, np.int64)
        if not len(docs):
            return docs
        # overlap that the pair's own sizes ask for
        asked = -(-self.num * (len(at) + self.size[docs]) // (self.num + self.den))
        for done, (b, e) in enumerate(zip(begin[cut:], end[cut:])):
            part = self.owner[b:e]
            place = np.searchsorted(part, docs)
            counts += part[np.minimum(place, len(part) - 1)] == docs
            if done % 32 == 31:  # drop those that can't reach it any more
                alive = counts + (n_long - done - 1) >= asked
                docs, counts, asked = docs[alive], counts[alive], asked[alive]
                if not len(docs):
                    return docs
        return docs[counts >= asked]


def link_block(sets: list[np.ndarray], queries: list[int] | None, num: int, den: int) -> np.ndarray:
    """Component label (smallest index) of each set in the block.  ``queries``:
    only links of these are wanted; None: all links."""
    label = np.arange(len(sets))
    block = Block(sets, num, den)

    def search(q: int) -> None:
        joined = np.unique(label[np.append(block.search(q), q)])
        label[np.isin(label, joined)] = joined[0]

    if queries is not None:
        for q in queries:
            search(q)
        return label
    asked = {0}
    search(0)
    while True:
        names, counts = np.unique(label, return_counts=True)
        outside = [q for q in np.flatnonzero(label != names[counts.argmax()]).tolist() if q not in asked]
        if not outside:
            return label
        asked.add(outside[0])
        search(outside[0])


def _searcher(k: int, num: int, den: int):
    """Rows (lo, block, part, role, id, text), sorted; role 0 is the centre, 1 a member,
    2 a loose member of another block that is to be searched here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["lo", "block", "part"]):
            role, ids = t.column("role").to_numpy(), t.column("id").to_numpy()
            order = np.argsort(role, kind="stable")
            role, ids = role[order], ids[order]
            texts = t.column("text").combine_chunks()
            sets = [shingle_set(texts[int(i)].as_py(), k) for i in order]
            keep = [i for i, s in enumerate(sets) if len(s)]
            role, ids, sets = role[keep], ids[keep], [sets[i] for i in keep]
            if len(sets) < 2:
                continue
            loose = np.flatnonzero(role == 2).tolist()
            label = link_block(sets, loose or None, num, den)
            # what did not reach the centre's component
            apart = (label != label[0]) if role[0] == 0 else np.ones(len(ids), bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), t.column("lo")[0].as_py())),
                 pa.array(np.full(len(ids), t.column("block")[0].as_py(), np.int32)),
                 pa.array(role.astype(np.int32)), pa.array(ids), pa.array(ids[label]), pa.array(apart),
                 pa.array(np.array([len(s) for s in sets], np.int32))],
                names=["lo", "block", "role", "id", "near", "apart", "n"])
    return run


FOUND = "lo long, block int, role int, id long, near long, apart boolean, n int"


def _search(texts: DataFrame, work: DataFrame, k: int, num: int, den: int) -> DataFrame:
    rows = join_checked(texts, work, ["id"]).select("lo", "block", "part", "role", "id", "text")
    run = ["lo", "block", "part"]
    rows = rows.repartition(*run).sortWithinPartitions(*run)
    return stored(rows.mapInArrow(_searcher(k, num, den), FOUND), "found")


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100,
                       block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of (doc_id, text).

    Two documents link when den * |A n B| >= num * |A u B| for their sets of
    ``k``-word shingles.  Null, empty and blank texts have empty sets and link with
    nothing.  Rows without an id take the component of an equal set that has one
    and are otherwise null; rows that share an id share its component; repeated
    rows give repeated results.  Other columns are ignored.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return settle(docs.sparkSession, "jaccard", lambda: _components(d, k, num, den, block_docs))


def _components(d: DataFrame, k: int, num: int, den: int, block_docs: int) -> DataFrame:
    sets = stored(d.mapInArrow(_sets(k, num, den), SETS), "sets")
    named = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    ids = stored(named.groupBy("d1", "d2", "doc_id").agg(F.count("*").alias("held")), "ids")
    classes = stored(ids.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")), "classes")
    # signatures are most of the volume: they stay with the sets, and only rows that are
    # no class of their own are looked up
    key = ["d1", "d2", "doc_id"]
    aside = stored(ids.join(classes, ["d1", "d2"]).where("doc_id != rep OR held > 1"), "aside")
    again = join_checked(named, aside.where("doc_id = rep").select(key), key, "left_semi").dropDuplicates(key)
    single = join_checked(named, aside.select(key), key, "left_anti")
    keyed = single.select(*sets.columns).union(again.select(*sets.columns)).select(
        "n_shingles", F.col("doc_id").alias("id"), F.explode("sigs").alias("key"))
    # the smallest id of a signature is the star's centre; one shuffle finds it and
    # hands it to the others
    least = F.first("id").over(W.partitionBy("key").orderBy("id").rowsBetween(W.unboundedPreceding, 0))
    stars = keyed.withColumn("lo", least).where("id != lo")
    stars = stored(stars.select("lo", "id", F.col("n_shingles").alias("n")).distinct(), "stars")
    parts = F.greatest(F.ceil(F.count("*") / block_docs), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    size = stars.groupBy("lo").agg(parts.alias("blocks"))
    # written, so that the join below may split the members of a very large star
    size = stored(size, "star-sizes")
    members = stars.join(size, "lo").select(
        "lo", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("role"), "id")
    centres = size.select("lo", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                          F.lit(0).alias("role"), F.col("lo").alias("id"))
    texts = d.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), "text")
    work = stored(members.union(centres).withColumn("part", F.lit(0)), "work")
    found = _search(texts, work, k, num, den)
    links = found.select(F.col("id").alias("a"), F.col("near").alias("b")).where("a != b")
    # members that missed the centre meet the other blocks of their star, in parts no
    # larger than a block
    wide = size.where("blocks > 1")
    loose = stored(found.where("apart AND role = 1").join(wide, "lo").select("lo", "block", "id", "n", "blocks")
                   .distinct(), "loose")
    if loose.count():
        guests = stored(loose.groupBy("lo").agg(parts.alias("parts")), "guests")
        visits = (loose.join(guests, "lo")
                  .withColumn("part", F.pmod(F.xxhash64(F.lit(3), "id"), F.col("parts")).cast("int"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("other != block")
                  .select("lo", F.col("other").alias("block"), F.lit(2).alias("role"), "id", "part"))
        met = visits.select("lo", "block", "part").distinct()
        hosts = work.where("role = 1").drop("part").join(met, ["lo", "block"]).select(*visits.columns)
        again = _search(texts, stored(hosts.union(visits), "visits"), k, num, den)
        links = links.union(again.select(F.col("id").alias("a"), F.col("near").alias("b")).where("a != b"))
    labels = connected_components(links)
    # written, so that the join below may split the rows of a class with very many copies
    named_classes = stored(classes.select("d1", "d2", "rep").join(labels, F.col("rep") == F.col("node"), "left").select(
        "d1", "d2", F.coalesce("component", "rep").alias("component")), "components")
    out = sets.select("doc_id", "n_shingles", "d1", "d2").join(named_classes, ["d1", "d2"], "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"), 3, 90, 100)
