"""Mixing to target weights by soft membership.

A softmax classifier, fitted on a bounded sample of the labelled table, gives each document a posterior over
domains. Rates r >= 0 minimise |t - w|^2 / 2 + RIDGE / 2 * sum_i n_i / T * (r_i - 1)^2, where n_i are tokens, p_i posteriors, T all
tokens, t = sum_i r_i n_i p_i / T the domain totals and w the targets.

By projected gradient, scaled: plain steps r_i - step * (p_i . (t - w) + RIDGE * (r_i - 1)), cut off at 0, need hundreds of passes
over the documents where posteriors of a scarce domain overlap (measured: totals still 0.004 off after 300), so
gradients are multiplied by the inverse Hessian of the documents that aren't at their bound. That Hessian is RIDGE plus
P'P of three columns, whose inverse leaves r_i = max(0, 1 + p_i . y): a step is one of y, by the domain totals and the
Gram matrix of those documents. Spark sums these over all documents, and the driver only ever sees those few
numbers. Where (t - w) + RIDGE * y = 0 the rates meet the conditions of the minimum, which is the only one and so
that of plain steps too; a warning says by how much they miss it if ROUNDS don't suffice.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptally.llm.common import map_arrow, read, row_key, slices, words_of, written

DOMAINS = ("clean", "low", "toxic")
TARGETS = {"clean": 0.90, "low": 0.07, "toxic": 0.03}
#: Bounds of the fitted sample: rows of a domain, and characters of a row.
SAMPLE_ROWS, SAMPLE_CHARS = 1500, 20_000
BUCKETS = 1 << 16
#: A bucket is a feature if so many sampled texts hold it, and if in some domain they are so many standard
#: deviations more or fewer than in all domains together.
LEAST_TEXTS, LEAST_DEVIATION = 5, 4.0
RIDGE, ROUNDS, CLOSE = 1e-4, 25, 1e-7


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # BUCKETS x domains
    shape: np.ndarray  # of the three shape features and the constant, x domains
    heat: float


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of the distinct words of each text, its shape features, and its words.

    Words count without case and without marks at their ends; shape: shares of distinct words, of words in
    capitals and of words with symbols."""
    w = words_of(texts)
    coded = w.array.dictionary_encode()
    kinds = coded.dictionary.to_pylist()
    bare = [x.strip("#*$%&|<>!?.,;:\"'()[]").lower() for x in kinds]
    bucket = np.fromiter((xxhash.xxh3_64_intdigest(x) % BUCKETS for x in bare), np.int64, len(kinds))
    loud = np.fromiter((x.isupper() and len(x) > 1 for x in kinds), bool, len(kinds))
    marked = np.fromiter((len(x) - len(y) > 1 or not y for x, y in zip(kinds, bare, strict=True)), bool, len(kinds))
    ids, text, n = coded.indices.to_numpy(zero_copy_only=False), w.text_of, w.counts
    pairs = np.unique(text * BUCKETS + bucket[ids])
    owner = pairs // BUCKETS
    most = np.maximum(n, 1)
    shares = [np.bincount(owner, minlength=len(n)) / most, np.bincount(text, loud[ids], len(n)) / most, np.bincount(text, marked[ids], len(n)) / most]
    return owner, pairs % BUCKETS, np.stack([*shares, np.ones(len(n))], 1), n


def _in_runs(texts: list[str], most: int = 2 << 20) -> Iterator[pa.Array]:
    """The texts in runs of about so many characters, to bound what their words take at once."""
    run, held = [], 0
    for text in texts:
        run.append(text)
        held += len(text)
        if held >= most:
            yield pa.array(run)
            run, held = [], 0
    if run:
        yield pa.array(run)


def _all_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owners, buckets and shapes of all texts."""
    owners, buckets, shapes, at = [], [], [], 0
    for run in _in_runs(texts):
        owner, bucket, shape, n = features(run)
        owners.append((owner + at).astype(np.int32))
        buckets.append(bucket.astype(np.int32))
        shapes.append(shape)
        at += len(n)
    return np.concatenate(owners), np.concatenate(buckets), np.concatenate(shapes)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def logits(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    owner, bucket, shape, n = features(texts)
    z = shape @ model.shape
    for d in range(z.shape[1]):
        z[:, d] += np.bincount(owner, model.weights[bucket, d], len(n))
    return z, n


def labelled(labels: DataFrame) -> DataFrame:
    """doc_id and its domain as a number: toxic before low before clean; rows without a doc_id or both labels go."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 0)
    return labels.where("doc_id is not null").select("doc_id", domain.alias("y")).where("y is not null").groupBy("doc_id").agg(F.max("y").alias("y"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Adagrad on half of a sample of at most 2 * SAMPLE_ROWS rows a domain, a temperature on the other half."""
    marked = labelled(labels).withColumn("turn", F.xxhash64("doc_id"))
    texts = docs.select("doc_id", "text").where(F.length("text").between(1, SAMPLE_CHARS))
    have = marked.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    sample = None
    for y in range(len(DOMAINS)):
        some = have.where(F.col("y") == y).orderBy("turn", "doc_id").limit(2 * SAMPLE_ROWS)
        sample = some if sample is None else sample.unionByName(some)
    rows = texts.join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: (r["turn"], r["doc_id"]))
    share = {r["y"]: r["n"] for r in have.groupBy("y").agg(F.count("*").alias("n")).collect()}
    model = Model(np.zeros((BUCKETS, len(DOMAINS))), np.zeros((4, len(DOMAINS))), 1.0)
    total = sum(share.values())
    prior = np.log([(share.get(d, 0) + 1) / (total + len(DOMAINS)) for d in range(len(DOMAINS))])
    if len({r["y"] for r in rows}) < 2:  # nothing to tell apart: the prior
        model.shape[3] = prior
        return model
    half = [rows[::2], rows[1::2] or rows[::2]]
    owner, bucket, shape = _all_features([r["text"] for r in half[0]])
    y = np.eye(len(DOMAINS))[[r["y"] for r in half[0]]]
    held = np.stack([np.bincount(bucket, y[owner, d], BUCKETS) for d in range(len(DOMAINS))], 1)
    expected = held.sum(1, keepdims=True) * y.mean(0)
    telling = (held.sum(1) >= LEAST_TEXTS) & (np.abs(held - expected) >= LEAST_DEVIATION * np.sqrt(np.maximum(expected, 0.5))).any(1)
    owner, bucket = owner[telling[bucket]], bucket[telling[bucket]]
    squares, squared = np.full_like(model.weights, 1e-9), np.full_like(model.shape, 1e-9)
    for _ in range(200):
        z = shape @ model.shape
        for d in range(len(DOMAINS)):
            z[:, d] += np.bincount(owner, model.weights[bucket, d], len(y))
        wrong = (_softmax(z) - y) / len(y)
        slope = np.stack([np.bincount(bucket, wrong[owner, d], BUCKETS) for d in range(len(DOMAINS))], 1) + 1e-5 * model.weights
        squares += slope**2
        model.weights[:] -= 0.3 * slope / np.sqrt(squares)
        slope = shape.T @ wrong
        squared += slope**2
        model.shape[:] -= 0.3 * slope / np.sqrt(squared)
    z = np.concatenate([logits(model, run)[0] for run in _in_runs([r["text"] for r in half[1]])])
    y = np.array([r["y"] for r in half[1]])
    heats = np.geomspace(0.05, 5, 60)
    best = min(heats, key=lambda h: -np.log(np.maximum(_softmax(z * h)[np.arange(len(y)), y], 1e-300)).mean())
    counts = np.bincount([r["y"] for r in rows], minlength=len(DOMAINS))
    model.weights[:] *= best
    model.shape[:] *= best
    # the sample holds the domains in other shares than the labels do
    model.shape[3] += prior - np.log((counts + 1) / (counts.sum() + len(DOMAINS)))
    return Model(model.weights, model.shape, float(best))


def memberships(docs: DataFrame, model: Model) -> DataFrame:
    """_id, _h (as row_key has them), doc_id, n_tokens and p, the posterior over DOMAINS, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            z, n = logits(shared.value, batch.column("text"))
            p = pa.FixedSizeListArray.from_arrays(pa.array(_softmax(z).ravel()), len(DOMAINS)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("_id", "_h", "doc_id")), pa.array(n.astype(np.int64)), p], ["_id", "_h", "doc_id", "n_tokens", "p"])

    kind = dict(docs.dtypes)["doc_id"]
    keyed = row_key(docs.select("doc_id", F.col("text").cast("string")))
    return map_arrow(keyed.select("_id", "_h", "doc_id", "text"), run, f"_id long, _h long, doc_id {kind}, n_tokens long, p array<double>")


def within(members: DataFrame, ceilings: dict[str, float]) -> dict[str, float]:
    """Targets that rates can meet: the domain totals if documents of a likeliest domain with a ceiling are thinned evenly to it
    and all others fill what that frees. Posteriors are soft, so that clean documents hold some of the other totals."""
    likeliest = F.array_position("p", F.array_max("p"))
    sums = members.groupBy(likeliest.alias("k")).agg(*(F.sum(F.col("n_tokens") * F.col("p")[d]).alias(f"s{d}") for d in range(len(DOMAINS)))).collect()
    held = np.zeros((len(DOMAINS), len(DOMAINS)))
    for r in sums:
        held[r["k"] - 1] = [r[f"s{d}"] for d in range(len(DOMAINS))]
    held /= held.sum() or 1
    share, capped = held.sum(1), np.array([d in ceilings for d in DOMAINS])
    rate = np.array([min(1.0, ceilings.get(d, 1.0) / max(s, 1e-12)) for d, s in zip(DOMAINS, share, strict=True)])
    if rest := share[~capped].sum():
        rate[~capped] = 1 + (share * (1 - rate))[capped].sum() / rest
    else:
        rate[:] = 1  # nothing to fill it with
    return {d: float(x) for d, x in zip(DOMAINS, rate @ held if held.sum() else 1 / len(DOMAINS) + np.zeros(len(DOMAINS)), strict=True)}


def rates(members: DataFrame, targets: dict[str, float], ceilings: dict[str, float] | None = None) -> tuple[DataFrame, np.ndarray]:
    """members with rate, and the domain totals that the rates give, as shares of all tokens.

    With ceilings a document's likeliest domain bounds its rate too: 1 at most if that has a ceiling, else 1 at least."""
    size = len(DOMAINS)
    w = np.array([targets[d] for d in DOMAINS])
    w = w / w.sum()
    n = F.col("n_tokens")
    total = float(members.agg(F.sum("n_tokens")).first()[0] or 0)
    y = np.zeros(size)

    low, high = F.lit(0.0), None
    if ceilings:
        kept = F.greatest(*(F.col("p")[d] for d, x in enumerate(DOMAINS) if x not in ceilings), F.lit(0.0)) >= F.array_max("p")
        low, high = F.when(kept, 1.0).otherwise(0.0), F.when(kept, float("inf")).otherwise(1.0)

    def free(y: np.ndarray) -> F.Column:
        return F.lit(1.0) + sum((F.col("p")[d] * float(y[d]) for d in range(size)), F.lit(0.0))

    def rate(y: np.ndarray) -> F.Column:
        return F.greatest(low, free(y) if high is None else F.least(high, free(y)))

    def totals(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = members.withColumn("r", rate(y))
        # at the start all stand at their bound, and may leave it
        inside = F.col("r") > 0 if high is None else free(y).between(low, high)
        sums = [F.sum(F.col("r") * n * F.col("p")[d]) for d in range(size)]
        gram = [F.sum(F.when(inside, n * F.col("p")[a] * F.col("p")[b]).otherwise(0.0)) for a in range(size) for b in range(size)]
        got = np.array(rows.agg(*sums, *gram).first(), float) / total
        return got[:size], got[size:].reshape(size, size)

    if total:
        got, gram = totals(y)
        for _ in range(ROUNDS):
            off = got - w + RIDGE * y
            if np.abs(off).max() < CLOSE:
                break
            step, scale = np.linalg.solve(gram + RIDGE * np.eye(size), off), 1.0
            while True:  # a shorter step if the whole one makes it worse
                then, next_gram = totals(y - scale * step)
                if np.linalg.norm(then - w + RIDGE * (y - scale * step)) < np.linalg.norm(off) or scale < 1e-3:
                    break
                scale /= 2
            y, got, gram = y - scale * step, then, next_gram
        else:
            warnings.warn(f"domain totals {got.tolist()} after {ROUNDS} steps, {np.abs(got - w + RIDGE * y).max():.1e} from the least squares' minimum", stacklevel=2)
    else:
        got = np.zeros(size)
    return members.withColumn("rate", rate(y)), got


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, ceilings: dict[str, float] | None = None) -> DataFrame:
    """doc_id, n_tokens, p_<domain>, rate and copies of every row of docs.

    Labels without a doc_id or a label don't count; of contradictory ones toxic counts before low, low before clean.
    copies is rate rounded down or up, by a number that a hash of doc_id and text draws, so that it is rate on
    average. A null text has no tokens and the posterior of an empty text; repeated rows have the same numbers.
    With ceilings the targets are those of `within`, and no document of a domain without a ceiling has fewer than one copy.
    Without labels the posterior is even; without documents there are no rows. Other columns are ignored."""
    members = written(memberships(docs, fit(docs, labels)))
    rated, _ = rates(members, within(members, ceilings) if ceilings else targets or TARGETS, ceilings)
    draw = F.pmod(F.xxhash64(F.lit("mix"), "_id", "_h"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = (F.floor("rate") + F.when(draw < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("int")
    return rated.select("doc_id", "n_tokens", *(F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(DOMAINS)), "rate", copies.alias("copies"), "_id", "_h")


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, ceilings: dict[str, float] | None = None) -> DataFrame:
    """The rows of docs, each as often as its copies say; all columns of docs, no others."""
    copies = mix(docs, labels, targets, ceilings).where("copies > 0").select("_id", "_h", "copies").dropDuplicates(["_id", "_h"])
    return row_key(docs).join(copies, ["_id", "_h"]).withColumn("_turn", F.explode(F.sequence(F.lit(1), "copies"))).select(*docs.columns)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("_id", "_h")
