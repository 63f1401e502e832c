"""Language identification by interpolated Kneser-Ney character models.

A text is read as lower-case letters (and combining marks) in UTF-16 units, every
run of other characters as one blank.  Four units are one 64-bit key, so a window
of four is counted as a number and its prefix, suffix and context are shifts.

Tasks count the windows of their texts per language; Spark adds the counts, and
derives the continuation counts of the shorter windows, the discounts from the
counts of counts, the context weights and the interpolated probabilities by joins
on (language, key).  What scoring needs is then folded to at most ``SLOTS`` hash
slots for each order, which bounds the arrays that are sent to the tasks: sorted slots,
and a log probability and a back-off weight for each language.  Languages beyond
``LANGS_PER_PASS`` are scored in further passes over the texts.

A text takes the language of the lowest cross-entropy per unit.  A calibration
fold of the learning rows, left out of the counts, says how likely that choice is
right at a given lead over the next language, and which cross-entropies are usual
for a language: beyond them, or at a likelihood below one half, it is rejected.
"""

from __future__ import annotations

import dataclasses
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.llm.common import settle, stored, table

ORDER = 4
SLOTS = 1_000_003  # hash slots of an order
LANGS_PER_PASS = 8
SEGMENT = 1 << 20  # characters folded at once; a longer text is read in such segments
HELD = 1 << 20  # counts a task holds before it passes them on
USUAL, SLACK = 0.995, 1.1  # cross-entropies up to this quantile, times this, are usual
BLANK = 32
UNDETERMINED = "und"
STATE = "text string, lang string, units long, letters boolean, first double, second double"


def crc(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def held_out() -> Column:
    return F.coalesce(crc() % 4 == 2, F.lit(False))


# ---- texts to keys -------------------------------------------------------------

def fold_tables() -> tuple[np.ndarray, np.ndarray]:
    """UTF-16 unit -> its lower-case letter or mark, else a blank; and is it a letter."""
    fold = np.full(1 << 16, BLANK, np.uint16)
    letter = np.zeros(1 << 16, bool)
    for cp in range(1 << 16):
        c = chr(cp)
        kind = unicodedata.category(c)
        if kind[0] in "LM":
            low = c.lower()
            fold[cp] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else cp
            letter[cp] = kind[0] == "L"
    fold[0xD800:0xE000] = np.arange(0xD800, 0xE000)
    return fold, letter


def fold_texts(texts: list[str], fold: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key of the window that ends at each unit, its text's number, has the text a
    letter).  Before its first unit a text has blanks."""
    joined = "".join(texts)
    raw = np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), np.uint16)
    sizes = np.array([len(t) for t in texts], np.int64)
    if len(raw) != len(joined):
        sizes = np.array([len(t.encode("utf-16-le", "surrogatepass")) // 2 for t in texts], np.int64)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    x, is_letter = fold[raw], letter[raw]
    for at in np.flatnonzero((x[:-1] >> 10 == 0x36) & (x[1:] >> 10 == 0x37)):
        c = chr(0x10000 + ((int(x[at]) & 0x3FF) << 10) + (int(x[at + 1]) & 0x3FF))
        kind = unicodedata.category(c)[0]
        is_letter[at] = kind == "L"
        if kind not in "LM":
            x[at:at + 2] = BLANK
    letters = np.zeros(len(texts), bool)
    letters[text[is_letter]] = True
    before = np.full(len(x), BLANK, np.uint16)
    before[1:] = x[:-1]
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    before[starts] = BLANK
    kept = (x != BLANK) | (before != BLANK)
    x, text = x[kept], text[kept]
    padded = np.full(len(x) + (ORDER - 1) * len(texts), BLANK, np.uint64)
    at = np.arange(len(x)) + (ORDER - 1) * (text.astype(np.int64) + 1)
    padded[at] = x
    keys = padded[at]
    for back in range(1, ORDER):
        keys |= padded[at - back] << np.uint64(16 * back)
    return keys.view(np.int64), text, letters


def pieces(column: pa.Array, segment: int) -> Iterator[tuple[list[int], list[str]]]:
    """(rows, texts) of about ``segment`` characters; longer texts come in segments."""
    rows: list[int] = []
    texts: list[str] = []
    size = 0
    for row, value in enumerate(column):
        text = value.as_py() or ""
        for start in range(0, max(len(text), 1), segment):
            part = text[start:start + segment]
            if size + len(part) > segment and rows:
                yield rows, texts
                rows, texts, size = [], [], 0
            rows.append(row)
            texts.append(part)
            size += len(part)
    if rows:
        yield rows, texts


def _counter(segment: int):
    """(lang, text) -> (lang, key, n), summed as far as a task may hold them."""
    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

    def passed_on(held: dict[str, list]) -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            keys, n = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n)],
                                             names=["lang", "key", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = fold_tables()
        held: dict[str, list] = {}
        size = 0
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for rows, texts in pieces(batch.column(1), segment):
                keys, text, _ = fold_texts(texts, *tables)
                of = langs[rows]
                for lang in sorted(set(of)):
                    found, n = np.unique(keys[(of == lang)[text]], return_counts=True)
                    held.setdefault(lang, []).append((found, n))
                    size += len(found)
                if size > HELD:
                    held = {lang: [merged(parts)] for lang, parts in held.items()}
                    size = sum(len(parts[0][0]) for parts in held.values())
                    if size > HELD // 2:
                        yield from passed_on(held)
                        held, size = {}, 0
        yield from passed_on(held)
    return count


# ---- the models ----------------------------------------------------------------

def _suffix(order: int) -> Column:
    return F.col("key").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1))


def _levels(rows: DataFrame, segment: int) -> dict[int, DataFrame]:
    """order -> (lang, key, c): counts of the longest windows, and for the others
    how many different units precede them."""
    counted = rows.mapInArrow(_counter(segment), "lang string, key long, n long")
    levels = {ORDER: stored(counted.groupBy("lang", "key").agg(F.sum("n").alias("c")), "langid-windows")}
    for order in range(ORDER - 1, 0, -1):
        longer = levels[order + 1].select("lang", _suffix(order + 1).alias("key"))
        levels[order] = stored(longer.groupBy("lang", "key").agg(F.count("*").alias("c")), "langid-windows")
    return levels


def kneser_ney(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(ord, key, lang, logp, bow) from the learning rows (lang, text): interpolated
    Kneser-Ney log probabilities of the seen windows, and the weight of the shorter
    windows after them (a window that only ever precedes others has no logp).  At
    order 0, bow is the log probability of a unit that the language never had."""
    levels = _levels(rows, segment)
    # one row for a language and order
    sums = None
    for order, level in levels.items():
        s = level.groupBy("lang").agg(F.sum("c").alias("all"), F.count("*").alias("kinds"),
                                      F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2"))
        s = s.select("lang", F.lit(order).alias("ord"), "all", "kinds", F.greatest(F.lit(0.1), F.least(
            F.lit(0.9), F.coalesce(F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")), F.lit(0.1)))).alias("d"))
        sums = s if sums is None else sums.union(s)
    sums = stored(sums, "langid-sums")
    units = levels[1].select("key").distinct().count() + 1  # all languages share the rare units
    of = lambda order: sums.where(F.col("ord") == order).select("lang", "all", "kinds", "d")
    first = of(1).withColumn("bow", F.col("d") * F.col("kinds") / F.col("all"))
    out = [first.select(F.lit(0).alias("ord"), F.lit(0).cast("long").alias("key"), "lang",
                        F.lit(None).cast("double").alias("logp"), F.log(F.col("bow") / units).alias("bow"))]
    p = levels[1].join(first, "lang").select(
        "lang", "key", ((F.col("c") - F.col("d")) / F.col("all") + F.col("bow") / units).alias("p"))
    for order in range(2, ORDER + 1):
        level = levels[order].join(of(order).select("lang", "d"), "lang")
        level = level.withColumn("ctx", F.shiftrightunsigned("key", 16)).withColumn("suffix", _suffix(order))
        ctx = level.groupBy("lang", "ctx").agg(F.sum("c").alias("n"), (F.first("d") * F.count("*")).alias("free"))
        ctx = ctx.select("lang", "ctx", "n", (F.col("free") / F.col("n")).alias("bow"))
        p = stored(p, "langid-order")
        shorter = p.join(ctx.select("lang", F.col("ctx").alias("key"), "bow"), ["lang", "key"], "full")
        out.append(shorter.select(F.lit(order - 1).alias("ord"), "key", "lang", F.log("p").alias("logp"),
                                  F.log("bow").alias("bow")))
        p = (level.join(ctx, ["lang", "ctx"]).join(p.select("lang", F.col("key").alias("suffix"), F.col("p").alias("q")),
                                                   ["lang", "suffix"])
             .select("lang", "key", ((F.col("c") - F.col("d")) / F.col("n") + F.col("bow") * F.col("q")).alias("p")))
    out.append(p.select(F.lit(ORDER).alias("ord"), "key", "lang", F.log("p").alias("logp"),
                        F.lit(None).cast("double").alias("bow")))
    model = out[0]
    for part in out[1:]:
        model = model.union(part)
    return model


@dataclasses.dataclass(frozen=True)
class Level:
    slots: np.ndarray  # ascending
    logp: np.ndarray  # slot x language
    bow: np.ndarray


@dataclasses.dataclass(frozen=True)
class Models:
    """Sorted hash arrays of some languages."""
    langs: tuple[str, ...]
    levels: tuple[Level, ...]  # of orders 1, 2, ...
    unseen: np.ndarray
    slots: int

    def _at(self, order: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        level = self.levels[order - 1]
        slot = keys % self.slots
        at = np.minimum(np.searchsorted(level.slots, slot), len(level.slots) - 1)
        return at, level.slots[at] == slot

    def log_probability(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Of the windows ``keys``, for each language."""
        if order == 0:
            return np.broadcast_to(self.unseen, (len(keys), len(self.langs)))
        at, found = self._at(order, keys)
        out = self.levels[order - 1].logp[at]
        if not found.all():
            out[~found] = self._shorter(keys[~found], order)
        return out

    def _shorter(self, keys: np.ndarray, order: int) -> np.ndarray:
        out = self.log_probability(keys & ((1 << 16 * (order - 1)) - 1), order - 1).copy()
        if order > 1:
            at, found = self._at(order - 1, (keys.view(np.uint64) >> np.uint64(16)).view(np.int64))
            out[found] += self.levels[order - 2].bow[at[found]]
        return out


def sorted_arrays(rows: pa.Table, langs: list[str], slots: int) -> Models:
    """``Models`` from (ord, slot, key, lang, logp, bow), one row for a slot and
    language.  A language that never had a window gets its back-off value."""
    models = Models(tuple(langs), (), np.zeros(len(langs), np.float32), slots)
    number = {lang: i for i, lang in enumerate(langs)}
    order_of = rows.column("ord").to_numpy()
    lang_of = np.array([number[x] for x in rows.column("lang").to_pylist()], np.int64)
    cols = {c: rows.column(c).to_numpy() for c in ("slot", "key", "logp", "bow")}
    base = order_of == 0
    models.unseen[lang_of[base]] = cols["bow"][base]
    for order in range(1, ORDER + 1):
        here = order_of == order
        found, first, at = np.unique(cols["slot"][here], return_index=True, return_inverse=True)
        key = cols["key"][here][first]
        logp = np.full((len(found), len(langs)), np.nan, np.float32)
        bow = np.zeros((len(found), len(langs)), np.float32)
        logp[at, lang_of[here]] = cols["logp"][here]
        bow[at, lang_of[here]] = np.nan_to_num(cols["bow"][here])
        if not len(found):  # no text to learn from but blanks
            found, key = np.array([-1]), np.array([0])
            logp, bow = np.full((1, len(langs)), np.nan, np.float32), np.zeros((1, len(langs)), np.float32)
        gaps = np.isnan(logp)
        if gaps.any():
            logp[gaps] = models._shorter(key, order)[gaps]
        models = dataclasses.replace(models, levels=(*models.levels, Level(found, logp, bow)))
    return models


def fit(rows: DataFrame, slots: int = SLOTS, per_pass: int = LANGS_PER_PASS, segment: int = SEGMENT) -> list[Models]:
    """Models of all languages of the learning rows (lang, text), ``per_pass`` at a
    time.  At most ``ORDER * slots * per_pass`` numbers of each kind reach the
    driver for one of them.  Windows that share a slot count as the likelier one."""
    spark = rows.sparkSession
    model = settle(spark, "langid-model", lambda: kneser_ney(rows, segment))
    langs = sorted(r.lang for r in model.where("ord = 0").select("lang").collect())
    folded = model.withColumn("slot", F.pmod("key", F.lit(slots))).groupBy("ord", "slot", "lang").agg(
        F.min("key").alias("key"), F.max("logp").cast("float").alias("logp"), F.max("bow").cast("float").alias("bow"))
    out = []
    for start in range(0, len(langs), per_pass):
        group = langs[start:start + per_pass]
        out.append(sorted_arrays(folded.where(F.col("lang").isin(group)).toArrow(), group, slots))
    return out


# ---- scoring -------------------------------------------------------------------

def _scorer(shared, segment: int):
    """Rows with (text, lang, units, letters, first, second) as first columns: the
    languages of one pass against the best ones so far."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = fold_tables()
        models = shared.value
        for batch in batches:
            n = batch.num_rows
            total = np.zeros((n, len(models.langs)))
            units = np.zeros(n, np.int64)
            letters = np.zeros(n, bool)
            for rows, texts in pieces(batch.column(0), segment):
                keys, text, has = fold_texts(texts, *tables)
                rows = np.array(rows)
                letters[rows[has]] = True
                found, at = np.unique(keys, return_inverse=True)
                logp = models.log_probability(found)
                np.add.at(units, rows, np.bincount(text, minlength=len(rows)))
                for i in range(len(models.langs)):
                    np.add.at(total[:, i], rows, np.bincount(text, logp[at, i], len(rows)))
            entropy = -total / np.maximum(units, 1)[:, None]
            best = entropy.argmin(axis=1)
            e1 = entropy[np.arange(n), best]
            e2 = np.partition(entropy, 1, axis=1)[:, 1] if entropy.shape[1] > 1 else np.full(n, np.inf)
            f1, f2 = (batch.column(c).to_numpy() for c in (4, 5))
            lang = [models.langs[b] if x < f else old for b, x, f, old in
                    zip(best, e1, f1, batch.column(1).to_pylist())]
            first, second = np.minimum(e1, f1), np.minimum(np.maximum(e1, f1), np.minimum(e2, f2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(units), pa.array(letters), pa.array(first),
                 pa.array(second), *batch.columns[6:]], names=batch.schema.names)
    return score


def score_languages(docs: DataFrame, fitted: list[Models], segment: int = SEGMENT) -> DataFrame:
    """(row, lang, units, letters, first, second) of ``docs`` (text, ...): the
    language of the lowest cross-entropy, the two lowest ones, and all of the
    row but its text."""
    spark = docs.sparkSession
    rest = [docs[c] for c in docs.columns if c != "text"]
    d = docs.select(docs["text"], F.lit(None).cast("string").alias("lang"), F.lit(0).cast("long").alias("units"),
                    F.lit(False).alias("letters"), F.lit(float("inf")).alias("first"),
                    F.lit(float("inf")).alias("second"), F.struct(*rest).alias("row"))
    schema = f"{STATE}, row {d.schema['row'].dataType.simpleString()}"
    for i, models in enumerate(fitted):
        if i:  # one pass's arrays at a time
            d = stored(d, "langid-pass")
        d = d.mapInArrow(_scorer(spark.sparkContext.broadcast(models), segment), schema)
    return d.drop("text")


@dataclasses.dataclass(frozen=True)
class Calibration:
    intercept: float = 0.0
    slope: float = 1.0
    usual: tuple[tuple[str, float], ...] = ()


def lead() -> Column:
    """Of the best language over the next one: it counts more in longer texts."""
    lead = (F.col("second") - F.col("first")) * F.sqrt("units")
    return F.log1p(F.least(F.when(F.isnan(lead), F.lit(0.0)).otherwise(lead), F.lit(1e4)))


def calibrate(scored: DataFrame, languages: int) -> Calibration:
    """Logistic curve of being right over ``lead`` (in steps of 1/16, so at most 150
    rows reach the driver) and each language's usual cross-entropy.  One imagined
    text without a lead is right in 1 of ``languages`` cases."""
    s = scored.where("letters").withColumn("right", F.col("lang") == F.col("row.lang"))
    bins = s.groupBy(F.floor(lead() * 16).alias("bin")).agg(F.count("*").alias("n"), F.count_if("right").alias("k")).collect()
    x = np.array([0.0] + [(r.bin + 0.5) / 16 for r in bins])
    n = np.array([1.0] + [r.n for r in bins])
    k = np.array([1.0 / max(languages, 1)] + [r.k for r in bins])
    design, w = np.stack([np.ones_like(x), x], axis=1), np.array([0.0, 1.0])
    ridge, prior = np.diag([0.1, 0.1]), np.array([0.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + ridge,
                               design.T @ (n * p - k) + ridge @ (w - prior))
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    usual = s.where("right").groupBy("lang").agg(F.percentile_approx("first", USUAL, 10_000).alias("most")).collect()
    return Calibration(float(w[0]), max(float(w[1]), 0.0), tuple(sorted((r.lang, r.most) for r in usual)))


def predictions(scored: DataFrame, cal: Calibration) -> DataFrame:
    """(row, lang_pred, score, cross_entropy, accepted)."""
    known = F.col("letters") & F.col("lang").isNotNull()
    likely = 1 / (1 + F.exp(-(F.lit(cal.intercept) + F.lit(cal.slope) * lead())))
    score = F.when(known, likely).otherwise(F.lit(0.0))
    usual = F.lit(True)
    if cal.usual:
        most = F.create_map(*[F.lit(x) for pair in cal.usual for x in pair])
        usual = F.coalesce(F.col("first") <= SLACK * F.try_element_at(most, F.col("lang")), F.lit(True))
    return scored.select("row", F.when(known, F.col("lang")).otherwise(UNDETERMINED).alias("lang_pred"),
                         score.alias("score"), F.when(known, F.col("first")).alias("cross_entropy"),
                         (known & usual & (score >= 0.5)).alias("accepted"))


def identify_languages(docs: DataFrame, learn: Column, slots: int = SLOTS, per_pass: int = LANGS_PER_PASS,
                       segment: int = SEGMENT) -> DataFrame:
    """``docs`` (doc_id, text, lang, ...) without their texts, with lang_pred, score
    (likelihood of being right, 0 to 1), cross_entropy and accepted (columns so
    named are replaced).

    The models learn from the rows where ``learn`` holds and neither text nor lang
    is null; one in twelve or so of them, by the checksum of the id, calibrates.
    Every row counts, repeated ones as often as they occur.  A null text or one
    without a letter is ``und`` with score 0; so is every text if there is nothing to
    learn from.  Languages that tie go by code point.  A text of over ``segment``
    characters is read in segments, each begun with blanks.  Predictions depend on
    nothing but the text.  A language that only calibrating rows have is not learned.
    """
    spark = docs.sparkSession
    rows = docs.where(F.coalesce(learn, F.lit(False)) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    apart = F.coalesce(crc() % 16 == 1, F.lit(False))
    fitted = fit(rows.where(~apart).select("lang", "text"), slots, per_pass, segment)
    cal = Calibration()
    if fitted:
        scored = score_languages(rows.where(apart).select("text", "lang"), fitted, segment)
        cal = calibrate(stored(scored, "langid-calibration"), sum(len(m.langs) for m in fitted))
    added = ["lang_pred", "score", "cross_entropy", "accepted"]
    rest = [c for c in docs.columns if c not in added]
    out = predictions(score_languages(docs.select(*rest), fitted, segment), cal)
    return out.select(*[F.col("row")[c].alias(c) for c in rest if c != "text"], *added)


def op13_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = identify_languages(docs, ~held_out())
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "cross_entropy", "accepted")
