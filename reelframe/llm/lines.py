"""Line dedup: a deletion-neighbourhood join over all lines, within a bound of one
edited word.

Equal lines, of any length, are one class, named by a 128-bit digest of the words.
A class of at least ``near_words`` words emits hashed keys of all its variants within the edit
bound (each word deleted, and the line itself).  Equal variants meet: two lines
that lose the same place are one substitution apart, a line that equals another's
variant is one deletion apart.  Groups of equal variants are reduced to their
earliest member (never to pairs), the claim is verified on the words, and a line
is dropped if an earlier line is within the bound (also if that one is dropped).

Only classes that can have such a neighbour emit variants: two sequences one edit
apart share the first or the last half of their words, so a class whose halves
nobody shares is out.  A variant's key is the exclusive-or of position-salted word
hashes, read off two running totals, so even a line of a million words costs a
constant amount per variant.  One claim a line is verified, that of its earliest
partner: a clash of two 64-bit keys there would keep a line.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from reelframe.llm.common import join_checked, row_digest, settle, stored, table
from reelframe.llm.fingerprints import words

NEAR_WORDS = 5  # one edited word leaves four fifths of such a line, less of a shorter one


def _place() -> Column:
    """Sort key of an occurrence: earlier rows first, nulls last."""
    return F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "k1", "k2", "line_no")


def _halves(ws: str, n: str, near_words: int) -> Column:
    """Keys of the first and last halves, for partners as long and one word longer
    or shorter."""
    w = F.col(ws)

    def keys(h: Column) -> list[Column]:
        return [F.xxhash64(F.lit(1), h, F.slice(w, F.lit(1), h)),
                F.xxhash64(F.lit(2), h, F.slice(w, F.col(n) - h + 1, h))]

    both = F.floor(F.col(n) / 2).cast("int")
    less = F.floor((F.col(n) - 1) / 2).cast("int")
    return (F.when(F.col(n) < near_words, F.array().cast("array<bigint>"))
            .when(both == less, F.array(*keys(both))).otherwise(F.array(*keys(both), *keys(less))))


def line_table(docs: DataFrame, near_words: int) -> DataFrame:
    """(k1, k2, doc_id, line_no, h1, h2, n, halves) per line that has words."""
    d = docs.where(F.col("text").isNotNull()).select("doc_id", "k1", "k2",
                                                     F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    d = d.withColumn("ws", words(F.col("line"))).withColumn("n", F.size("ws")).where("n > 0")
    return d.select("k1", "k2", "doc_id", "line_no", F.xxhash64(F.lit(5), "ws").alias("h1"),
                    F.xxhash64(F.lit(6), "ws").alias("h2"), "n", _halves("ws", "n", near_words).alias("halves"))


def _candidates(classes: DataFrame) -> DataFrame:
    """Classes (h1, h2) one of whose halves another class shares."""
    halves = classes.select("h1", "h2", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b"),
                                        F.min("h2").alias("c"), F.max("h2").alias("d"))
    shared = shared.where("a != b OR c != d").select("half")
    return halves.join(shared, "half").select("h1", "h2").distinct()


def _variants(lines: DataFrame) -> DataFrame:
    """(h1, h2, place, n, pos, key) for every deletion (pos > 0) and the line itself
    (pos 0) of (h1, h2, place, n, ws)."""
    w = lines.select("h1", "h2", "place", "n", F.posexplode("ws").alias("i", "w"))
    w = w.select("h1", "h2", "place", "n", "i", F.xxhash64("i", "w").alias("p"),
                 F.xxhash64(F.col("i") - 1, F.col("w")).alias("q"))
    line = W.partitionBy("h1", "h2")
    upto = line.orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    w = w.withColumn("ps", F.bit_xor("p").over(upto)).withColumn("qs", F.bit_xor("q").over(upto))
    w = w.withColumn("qt", F.bit_xor("q").over(line))
    deletion = (F.col("ps").bitwiseXOR(F.col("p"))).bitwiseXOR(F.col("qt").bitwiseXOR(F.col("qs")))
    rows = F.array(F.struct((F.col("i") + 1).alias("pos"), F.xxhash64(F.col("n") - 1, deletion).alias("key")))
    last = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64("n", "ps").alias("key")))
    rows = F.when(F.col("i") == F.col("n") - 1, F.concat(rows, last)).otherwise(rows)
    return w.select("h1", "h2", "place", "n", F.explode(rows).alias("v")).select("h1", "h2", "place", "n", "v.*")


def _earlier(variants: DataFrame) -> DataFrame:
    """(h1, h2, pos, kept, from) of every line that meets an earlier one: the
    earliest such line and how the two differ (sub, del: the line is longer, ins)."""
    v = variants.withColumn("me", F.struct("place", "h1", "h2"))
    both = v.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b"), F.min("h2").alias("c"),
                                F.max("h2").alias("d")).where("a != b OR c != d").select("key")
    v = stored(v.join(both, "key"), "variants")
    same = v.where("pos > 0").groupBy("key", "pos").agg(F.min("me").alias("other"))
    whole = v.where("pos = 0").groupBy("key").agg(F.min("me").alias("other"))
    cut = v.where("pos > 0").groupBy("key").agg(F.min(F.struct("me", "pos")).alias("m")).select(
        "key", F.col("m.me").alias("other"), F.col("m.pos").alias("at"))
    claims = [v.where("pos > 0").join(same, ["key", "pos"]).select("me", "other", "pos", F.lit("sub").alias("how")),
              v.where("pos > 0").join(whole, "key").select("me", "other", "pos", F.lit("del").alias("how")),
              v.where("pos = 0").join(cut, "key").select("me", "other", F.col("at").alias("pos"),
                                                          F.lit("ins").alias("how"))]
    found = claims[0].union(claims[1]).union(claims[2]).where("other.place < me.place")
    best = found.groupBy("me").agg(F.min(F.struct("other", "how", "pos")).alias("b"))
    return best.select("me.h1", "me.h2", F.col("b.other.h1").alias("o1"), F.col("b.other.h2").alias("o2"),
                       "b.how", "b.pos")


def _verified(claims: DataFrame, lines: DataFrame) -> DataFrame:
    """Claims whose words really are one edit apart."""
    mine = lines.select("h1", "h2", F.col("ws").alias("x"))
    theirs = lines.select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("ws").alias("y"))
    c = claims.join(mine, ["h1", "h2"]).join(theirs, ["o1", "o2"])
    part = lambda col, start: F.slice(col, start, F.greatest(F.size(col), F.lit(1)))
    p = F.col("pos")
    front = F.slice("x", F.lit(1), p - 1) == F.slice("y", F.lit(1), p - 1)
    back = (F.when(F.col("how") == "sub", part("x", p + 1) == part("y", p + 1))
            .when(F.col("how") == "del", part("x", p + 1) == part("y", p))
            .otherwise(part("x", p) == part("y", p + 1)))
    size = F.size("x") - F.size("y") == F.when(F.col("how") == "sub", 0).when(F.col("how") == "del", 1).otherwise(-1)
    return c.where(front & back & size).select("h1", "h2")


def dropped_lines(docs: DataFrame, near_words: int = NEAR_WORDS) -> DataFrame:
    """(k1, k2, near, exact: arrays of line numbers) of the documents (doc_id, text,
    k1, k2) that lose lines."""
    lines = stored(line_table(docs, near_words), "lines")
    classes = lines.groupBy("h1", "h2").agg(F.min(_place()).alias("place"), F.first("n").alias("n"),
                                            F.first("halves").alias("halves"), F.count("*").alias("copies"))
    classes = stored(classes, "classes")
    candidates = stored(classes.join(_candidates(classes), ["h1", "h2"]).select("h1", "h2", "place", "n"), "candidates")
    # the words of the candidates, from their earliest occurrence
    homes = candidates.groupBy("place.k1", "place.k2").agg(
        F.collect_list(F.struct("place.line_no", "h1", "h2", "place", "n")).alias("wanted"))
    homes = homes.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "wanted")
    texts = docs.where(F.col("text").isNotNull()).select("k1", "k2", F.split("text", "\n").alias("parts"))
    found = join_checked(texts, homes, (texts.k1 == homes.c1) & (texts.k2 == homes.c2),
                         elements="wanted").select(
        F.explode(F.transform("wanted", lambda c: F.struct(
            c.h1.alias("h1"), c.h2.alias("h2"), c.place.alias("place"), c.n.alias("n"),
            words(F.get("parts", c.line_no)).alias("ws")))).alias("l"))
    found = stored(found.select("l.*").dropDuplicates(["h1", "h2"]), "candidate-words")
    near = _verified(_earlier(_variants(found)), found).withColumn("near", F.lit(True))
    # what every later copy, and every near copy, loses
    losing = classes.join(near, ["h1", "h2"], "left").where("copies > 1 OR near").select(
        "h1", "h2", "place", F.coalesce("near", F.lit(False)).alias("near"))
    # written, so that the join below may split the rows of a line with very many copies
    losing = stored(losing, "losing")
    lost = lines.select("h1", "h2", "k1", "k2", "doc_id", "line_no").join(losing, ["h1", "h2"])
    lost = lost.where(F.col("near") | (_place() != F.col("place")))
    kinds = {"near": F.col("near"), "exact": ~F.col("near")}
    return lost.groupBy("k1", "k2").agg(*[F.collect_set(F.when(is_kind, F.col("line_no"))).alias(name)
                                          for name, is_kind in kinds.items()])


def dedup_lines(docs: DataFrame, near_words: int = NEAR_WORDS) -> DataFrame:
    """``docs`` without the lines that repeat an earlier line or are one word away
    from one; adds n_lines, n_exact and n_near (lines before, and those dropped).

    Lines are separated by a line feed and compared by their words.  Earlier means
    smaller doc_id (nulls last), then line.  Equal lines go at any length.  The edit
    bound follows from the length: one word if both lines have ``near_words`` words,
    else none.  Lines without words stay.  A null text stays null; a document that
    loses every line has an empty text.  Rows equal in id and text are one document
    and get the same result.  Other columns pass through; those named like the added
    ones are replaced.
    """
    added = ["n_lines", "n_exact", "n_near"]
    rest = [c for c in docs.columns if c not in added]
    others = [docs[c] for c in rest if c != "text"]
    keyed = docs.select(docs["doc_id"], docs["text"], *row_digest(docs), F.struct(*others).alias("row"))
    lost = settle(docs.sparkSession, "lost-lines", lambda: dropped_lines(
        keyed.select("doc_id", "text", "k1", "k2"), near_words))
    d = keyed.select("row", "k1", "k2", F.split("text", "\n").alias("parts")).join(lost, ["k1", "k2"], "left")
    d = d.withColumn("gone", F.array_union("near", "exact"))
    left = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), "gone")
    kept = F.transform(left, lambda i: F.get("parts", i))
    text = F.array_join(F.when(F.col("gone").isNull(), F.col("parts")).otherwise(kept), "\n")
    numbers = [F.coalesce(F.array_size(c), F.lit(0)).cast("long") for c in ("parts", "exact", "near")]
    return d.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in rest],
                    *[x.alias(c) for x, c in zip(numbers, added)])


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_exact", "n_near", F.length("text").cast("long").alias("kept_chars"),
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
