"""Compression quality classifier.

Two zstandard dictionaries are built from good and from bad labelled text.  A
text is compressed with either, in blocks so that long texts keep depending on
the dictionaries; the difference of the two sizes, normalised by their sum,
together with the compression ratio and the log length, goes through a logistic
calibration into a score from 0 to 1.

Training uses a bounded sample: at most ``per_class`` labelled rows of each
class, in hash order, of at most ``max_chars`` characters.  One half of it builds
the dictionaries, the other half fits the calibration (ten numbers), so the
scores are not calibrated on text the dictionaries hold.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.llm.common import per_worker, table

PER_CLASS = 1500
MAX_CHARS = 20_000
DICT_BYTES = 112_640
BLOCK = 2048
LEVEL = 3
KEEP = 0.3


@dataclasses.dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...] | None  # None: a class has no labelled text
    # range of the features in the calibration sample; beyond it its ends count
    low: tuple[float, ...] = ()
    high: tuple[float, ...] = ()

    def score(self, f: np.ndarray) -> np.ndarray:
        if not len(f):
            return np.zeros(0)
        return 1 / (1 + np.exp(-design(np.clip(f, self.low, self.high)) @ np.array(self.weights)))

    def compressors(self):
        import zstandard

        out = []
        for raw in (self.good, self.bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                                write_checksum=False, write_dict_id=False))
        return out


def blocks(data: bytes) -> list[bytes]:
    return [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]


def dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary.  Where the library finds too little text to train on, the
    text itself is the dictionary (its last bytes, as content without tables)."""
    import zstandard

    parts = [b for t in texts for b in blocks(t)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICT_BYTES:] or b"\n"


def features(data: bytes, good, bad) -> tuple[float, float, float]:
    """Normalised size difference, compression ratio, log length."""
    g = b = 0
    for part in blocks(data):
        g += len(good.compress(part))
        b += len(bad.compress(part))
    n = len(data)
    return ((b - g) / (b + g) if n else 0.0), (min(g, b) / n if n else 1.0), float(np.log1p(n))


def design(f: np.ndarray) -> np.ndarray:
    d, r, n = f[:, 0] * 10, np.minimum(f[:, 1], 1.5) * 3, f[:, 2] / 5
    return np.stack([np.ones_like(d), d, r, n, d * d, r * r, n * n, d * r, d * n, r * n], axis=1)


def calibrate(f: np.ndarray, y: np.ndarray, base_rate: float) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps, classes weighted to the base rate.
    The fewer examples, the stronger the pull to the base rate, and of the quadratic
    terms more than of the others."""
    x = design(f)
    few = min((y == 1).sum(), (y == 0).sum())
    ridge = np.diag([1e-3] + [1 + 40 / few] * 3 + [1 + 100 / few] * (x.shape[1] - 4))
    weight = np.where(y == 1, base_rate / y.mean(), (1 - base_rate) / (1 - y.mean()))
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ w))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(h, x.T @ (weight * (p - y)) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def held_out(doc_id: str = "doc_id") -> Column:
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
          max_chars: int = MAX_CHARS) -> CompressionModel:
    """Fit on labelled rows outside the held-out fold.  Rows without a label or
    a text are no examples; at most ``2 * per_class`` texts reach the driver.

    Every second text of a class goes into its dictionary, the others calibrate; the
    only text of a class is halved for that.  Without texts of both classes nothing can
    be told apart: the model has no weights and every score is 0.5.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    counts = known.agg(F.count("*").alias("n"), F.sum("quality").alias("good")).first()
    base = min(max((counts.good or 0) / counts.n, 0.01), 0.99) if counts.n else 0.5
    known = known.select("doc_id", "quality").distinct().withColumn("h", F.xxhash64("doc_id"))
    texts = docs.select("doc_id", "text").where(F.length("text").between(1, max_chars))
    sample: dict[int, list[bytes]] = {}
    for quality in (0, 1):
        ids = known.where(F.col("quality") == quality).orderBy("h", "doc_id").limit(per_class)
        # bounded: at most per_class ids
        rows = (texts.join(F.broadcast(ids), "doc_id").select("h", "text")
                .orderBy("h", "text").limit(per_class).collect())
        sample[quality] = [r.text.encode() for r in rows]
    if not all(sample.values()):
        return CompressionModel(b"", b"", None)
    for quality, known_texts in sample.items():
        if len(known_texts) == 1:
            only, = known_texts
            sample[quality] = [only[:(len(only) + 1) // 2], only[len(only) // 2:]]
    model = CompressionModel(dictionary(sample[1][0::2]), dictionary(sample[0][0::2]), None)
    good, bad = model.compressors()
    rest = [(t, q) for q in (0, 1) for t in sample[q][1::2]]
    f = np.array([features(t, good, bad) for t, _ in rest])
    weights = calibrate(f, np.array([q for _, q in rest]), base)
    low, high = (tuple(float(v) for v in x) for x in (f.min(axis=0), f.max(axis=0)))
    return dataclasses.replace(model, weights=weights, low=low, high=high)


def score_texts(docs: DataFrame, model: CompressionModel, name: str = "score") -> DataFrame:
    """``docs`` with a score column (replacing one of that name).

    The whole text is compressed, however long.  Null and empty texts get the
    calibration's value at length 0; without a fitted model every score is 0.5.
    Rows are independent, so repeated rows and ids are kept as they are.
    """
    rest = [f for f in docs.schema.fields if f.name != name]
    if model.weights is None:
        return docs.select(*[docs[f.name] for f in rest], F.lit(0.5).alias(name))
    frame = docs.select(*[docs[f.name] for f in rest])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + [f"`{name}` double"])
    shared = docs.sparkSession.sparkContext.broadcast(dataclasses.astuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = shared.value
        fitted = CompressionModel(*raw)
        good, bad = per_worker(f"zstd_{hash(raw)}", fitted.compressors)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            f = np.array([features((x.as_py() or "").encode(), good, bad) for x in batch.column(at)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fitted.score(f), pa.float64())],
                                             names=[*batch.schema.names, name])

    return frame.mapInArrow(run, schema)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_texts(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= KEEP).cast("int").alias("predicted"))
