"""Secret scans: base patterns plus sliding-window entropy.

Matches are found by ``regexp_extract_all`` and placed by the lengths of the
pieces that ``split`` leaves between them, summed in a window over the document's
hits.  Candidate strings are scanned per character class: the Shannon entropy of
a sliding window follows from incremental counts (what the entering and the
leaving character add to and take from the sum of c log c), so each character
costs the same however long the window is.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from reelframe.llm.common import row_digest, table

# Fixed patterns of the base kinds: (kind, pattern, group whose length counts, least length).
NAMES = ("[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
         "[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]")
BASE = (
    ("assign", r"""(?=[PpSsTtAa])(""" + NAMES + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 20),
    ("hex", r"(?<![0-9a-f])([0-9a-f]{24,})", 1, 24),
)
# Entropy classes: (kind, candidate pattern, what the string must also match, window, least bits).
CLASSES = (
    ("entropy_hex", r"(?<![0-9A-Fa-f])([0-9A-Fa-f]{20,})", "(?=.*[0-9])(?=.*[A-Fa-f])", 20, 2.9),
    ("entropy_base64", r"(?<![A-Za-z0-9+/_=-])([A-Za-z0-9+/_=-]{20,})", "(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])",
     20, 3.6),
)
# Allow list: identifiers that are no secrets, and placeholders.
ALLOW = (r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$", r"(?i)example|placeholder|changeme|x{6,}|0{8,}",
         r"(?i)^sha(256|384|512)-")


def _hits(docs: DataFrame, kind: str, pattern: str, group: int, least: int, also: str = "") -> DataFrame:
    """(k1, k2, kind, start, stop, hit) of a pattern; one row per match."""
    text = F.col("text")
    lengths = lambda a: F.transform(a, lambda x: F.length(x))
    found = docs.where(text.rlike(pattern)).select(
        "k1", "k2", lengths(F.split(text, pattern, -1)).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    rows = found.select("k1", "k2", F.posexplode(F.arrays_zip("gap", "hit", "value")).alias("pos", "m"))
    rows = rows.where("m.hit IS NOT NULL").select("k1", "k2", "pos", "m.*").dropDuplicates(["k1", "k2", "pos"])
    before = W.partitionBy("k1", "k2").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("stop", F.sum(F.col("gap") + F.length("hit")).over(before))
    rows = rows.where(F.length("value") >= least)
    if also:
        rows = rows.where(F.col("value").rlike(also))
    return rows.select("k1", "k2", F.lit(kind).alias("kind"), (F.col("stop") - F.length("hit")).alias("start"),
                       "stop", "hit")


def _gain(count: Column) -> Column:
    """What the ``count + 1``-th equal character adds to the sum of c log2 c."""
    clog = lambda c: F.when(c > 0, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))
    return clog(count + 1) - clog(count)


def _entropy(candidates: DataFrame, window: int, bits: float) -> DataFrame:
    """Candidates some window of which reaches ``bits`` bits a character."""
    c = candidates
    for pattern in ALLOW:
        c = c.where(~F.col("hit").rlike(pattern))
    chars = c.select("k1", "k2", "kind", "start", "stop", F.posexplode(F.split("hit", "")).alias("i", "ch"))
    chars = chars.where("ch != ''")
    same = W.partitionBy("k1", "k2", "kind", "start", "ch").orderBy("i")
    entering = _gain(F.count("*").over(same.rangeBetween(-(window - 1), -1)))
    leaving = _gain(F.count("*").over(same.rangeBetween(1, window - 1)))
    chars = chars.withColumn("entering", entering).withColumn("leaving", leaving)
    along = W.partitionBy("k1", "k2", "kind", "start").orderBy("i")
    held = (F.sum("entering").over(along.rowsBetween(W.unboundedPreceding, W.currentRow))
            - F.coalesce(F.sum("leaving").over(along.rowsBetween(W.unboundedPreceding, -window)), F.lit(0.0)))
    chars = chars.withColumn("bits", F.when(F.col("i") >= window - 1,
                                            F.log2(F.lit(float(window))) - held / window))
    return (chars.groupBy("k1", "k2", "kind", "start", "stop").agg(F.max("bits").alias("bits"))
            .where(F.col("bits") >= bits).drop("bits"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """(k1, k2, kind, rank, start, stop) of all spans in ``docs`` (doc_id, text):
    the base kinds, and entropy spans that overlap no base span or earlier class.

    Offsets are code points, the end exclusive.  (k1, k2) is the key of id and
    text (``common.row_digest``); equal rows share their spans; a null text has
    none; other columns are ignored.  Documents without spans have no row.
    """
    d = docs.select(*row_digest(docs), F.coalesce("text", F.lit("")).alias("text"))
    spans = None
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        part = _hits(d, kind, pattern, group, least).select("k1", "k2", "kind", F.lit(rank).alias("rank"),
                                                            "start", "stop")
        spans = part if spans is None else spans.union(part)
    for rank, (kind, pattern, also, window, bits) in enumerate(CLASSES, len(BASE)):
        found = _entropy(_hits(d, kind, pattern, 1, window, also), window, bits)
        spans = spans.union(found.select("k1", "k2", "kind", F.lit(rank).alias("rank"), "start", "stop"))
    # an entropy span yields to a span of lower rank that it overlaps
    doc = W.partitionBy("k1", "k2")
    out = spans
    for rank in range(len(BASE), len(BASE) + len(CLASSES)):
        lower = F.col("rank") < rank
        ends = F.max(F.when(lower, F.col("stop"))).over(
            doc.orderBy("start", "rank").rowsBetween(W.unboundedPreceding, W.currentRow))
        begins = F.min(F.when(lower, F.col("start"))).over(
            doc.orderBy(F.col("start"), F.col("rank").desc()).rowsBetween(W.currentRow, W.unboundedFollowing))
        out = out.withColumn("ends", ends).withColumn("begins", begins)
        clash = (F.col("rank") == rank) & (F.coalesce(F.col("ends") > F.col("start"), F.lit(False))
                                           | F.coalesce(F.col("begins") < F.col("stop"), F.lit(False)))
        out = out.where(~clash).drop("ends", "begins")
    return out


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = find_secrets(docs)
    said = F.concat_ws(":", "kind", "start", "stop")
    per = spans.groupBy("k1", "k2").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k, *_ in BASE],
        F.sort_array(F.collect_list(F.struct("start", "rank", said.alias("said")))).alias("all"))
    joined = lambda a: F.array_join(F.transform(a, lambda s: s.said), ",")
    base = F.filter("all", lambda s: s["rank"] < len(BASE))
    per = per.select("k1", "k2", *[f"n_{k}" for k, *_ in BASE], joined(base).alias("base"),
                     joined(F.col("all")).alias("spans"))
    ids = docs.select("doc_id", *row_digest(docs))
    out = ids.join(per, ["k1", "k2"], "left")
    return out.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k, *_ in BASE],
                      F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"))
