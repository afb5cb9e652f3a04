"""Quality by compression: a text that compresses better with a dictionary of good text than with one of bad text is good.

Two zstandard dictionaries are built from labelled rows of the training folds, one of quality 1 and one of
quality 0. A text is cut into blocks, each compressed with both. The difference of the compressed sizes,
normalised by the text's length and by the sizes themselves, is calibrated by a logistic curve on labelled rows
that the dictionaries haven't seen; the curve also takes the sizes over the length, since text that repeats
itself is small with either dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptally.llm.common import fold, map_arrow, read, slices

#: Folds of doc_id; fold 0 is held out.
FOLDS = 5
#: Bounds of the sample that is fitted on: rows a class (for dictionaries, and again for calibration), and characters of a row.
SAMPLE_ROWS, SAMPLE_CHARS = 1200, 20_000
DICTIONARY_BYTES, LEVEL = 65_536, 3
#: Texts are compressed in blocks of so many bytes, so that the dictionary counts in all of a long text.
BLOCK = 256
PREDICT_FROM = 0.3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]


@cache
def _compressors(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    out = []
    for raw in (good, bad):
        d = zstandard.ZstdCompressionDict(raw)
        d.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))
    return out


def features(model: Model, texts: list[bytes]) -> np.ndarray:
    """Of each text: the difference of its sizes over its length and over their sum, that sum over the length, its square, and 1.

    All but the 1 are 0 for an empty text."""
    good, bad = _compressors(model.good, model.bad)
    sizes = np.zeros((len(texts), 3))
    for i, text in enumerate(texts):
        view = memoryview(text)
        blocks = [view[k : k + BLOCK] for k in range(0, len(text), BLOCK)]
        sizes[i] = sum(len(bad.compress(b)) for b in blocks), sum(len(good.compress(b)) for b in blocks), len(text)
    some = sizes[:, 2] > 0
    difference, total = sizes[:, 0] - sizes[:, 1], np.where(some, sizes[:, 0] + sizes[:, 1], 1)
    length = np.where(some, sizes[:, 2], 1)
    ratio = np.where(some, total / length, 0)
    return np.stack([difference / length, difference / total, ratio, ratio**2, np.ones(len(texts))], 1)


def _dictionary(texts: list[bytes]) -> bytes:
    samples = [t[k : k + BLOCK] for t in texts for k in range(0, len(t), BLOCK)]
    samples = [x for x in samples if len(x) >= 8]
    raw = b"".join(samples)
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, len(raw) // 8)), samples).as_bytes()
    except zstandard.ZstdError:  # too little text to pick from: its end serves as a dictionary of raw content
        return raw[-DICTIONARY_BYTES:] or b"\n" * 8


def _logistic(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton's method with a small ridge; classes as they come, so that scores are calibrated."""
    w, ridge = np.zeros(z.shape[1]), 1e-3 * np.eye(z.shape[1])
    for _ in range(60):
        p = _curve(z @ w)
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _curve(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on labelled rows outside the held-out fold.

    At most 2 * SAMPLE_ROWS rows of each class, those of the smallest hash of doc_id, and of rows of at most
    SAMPLE_CHARS characters: that bounds what reaches the driver. A doc_id with both labels is left out."""
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", FOLDS) != 0))
    marked = marked.groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("most")).where("y = most").select("doc_id", "y")
    texts = docs.select("doc_id", "text").where((F.length("text") <= SAMPLE_CHARS) & (F.length("text") > 0))
    lengths = texts.select("doc_id").distinct().join(marked, "doc_id").withColumn("turn", F.xxhash64("doc_id"))
    chosen = [lengths.where(F.col("y") == y).orderBy("turn", "doc_id").limit(2 * SAMPLE_ROWS) for y in (0, 1)]
    share = {r["y"]: r["n"] for r in lengths.groupBy("y").agg(F.count("*").alias("n")).collect()}
    sample = chosen[0].unionByName(chosen[1])
    rows = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text", "turn").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: (r["turn"], r["doc_id"]))
    by = {y: [r["text"].encode() for r in rows if r["y"] == y] for y in (0, 1)}
    model = Model(_dictionary(by[1][::2]), _dictionary(by[0][::2]), ())
    x = {y: features(model, by[y][1::2]) for y in (0, 1)}
    if not len(x[0]) or not len(x[1]):  # nothing to calibrate on: the prior alone
        total = sum(share.values())
        p = (share.get(1, 0) + 1) / (total + 2)
        return Model(model.good, model.bad, (0.0, 0.0, 0.0, 0.0, float(np.log(p / (1 - p)))))
    weights = _logistic(np.concatenate([x[0], x[1]]), np.repeat([0.0, 1.0], [len(x[0]), len(x[1])]))
    # the sample holds the classes in other shares than the labels do
    weights[-1] += np.log(share[1] / share[0]) - np.log(len(x[1]) / len(x[0]))
    return Model(model.good, model.bad, tuple(weights.tolist()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    A null text is scored as an empty one, which gets the score of no bytes at all. Repeated rows each get their
    own row; a null doc_id counts as the empty text in the fold. Only the text is read to score a row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            p = _curve(features(m, texts) @ np.array(m.weights))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= PREDICT_FROM).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    wide = docs.select("doc_id", F.col("text").cast("string"), (fold("doc_id", FOLDS) == 0).alias("held_out"))
    return map_arrow(wide, run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score(docs, fit(docs, read(spark, sf_dir, "labels")))
