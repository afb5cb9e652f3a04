"""A hashed maximum-entropy language model, trained by distributed gradient updates.

The vocabulary is a tree of classes: its leaves are the end, the TABLE commonest words and some tails, in the order of the
words read backwards, cut into at most WIDTH classes of about the same count, these again, and so on down to single
leaves. P(word | history) is the product of P(class | class above, history) along the word's path, each a softmax over
sums of hashed features of the history: the last word, the last two, and skips over one and two words. So every word of
the table has its own features. All other words fall in a tail by their last two bytes, and within it follow their
smoothed counts: the model covers every word and is a distribution over the vocabulary.

Counts come from all training texts. Training goes through all of them once, in ROUNDS: each task starts from the model so
far, makes gradient steps on its share, and its changes are averaged with those of the others, row by row with the row's use
as weight; so what a round learns depends a little on how rows fall to tasks. The rows of weights grow with the distinct
words of the corpus, up to MOST_ROWS (64 MB: what executors hold at once). The table (a bound by count, not by the
corpus) is broadcast for scoring; all other words meet their counts in a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptally.llm.common import fold, map_arrow, mixed, read, slices, words_of, written

FOLDS = 10
ALPHA = 0.1
#: Words that are broadcast, and their most bytes.
TABLE, TABLE_BYTES = 1 << 18, 64
#: Classes of a class, and tails.
WIDTH, TAILS = 8, 256
#: Rows of weights: one to so many distinct words, within bounds; rows that travel together.
WORDS_A_ROW, LEAST_ROWS, MOST_ROWS, SHARE = 8, 1 << 13, 1 << 21, 256
ROUNDS, STEP, RATE = 2, 4096, 0.4
#: Tokens that are scored at once.
SCORED = 1 << 15
#: Features by how deep a class is, as rows of history: all four at the root, the last word and the word before it at all levels below.
FEATURES = ((0, 1, 2, 3), (0, 2))
#: Bytes of text that a task works on at once.
AT_ONCE = 6 << 20
LN10 = float(np.log(10))
#: The bias of a class that a node doesn't have.
NEVER = -1e4

_ODD, _SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that words lie in, and where each starts (and the end)."""
    words = words.cast(pa.large_string())
    data = words.buffers()[2] if len(words) else None
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(1, np.uint8)
    return buf, np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)


def _hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word (none is empty): the sum of those of its bytes at their places."""
    buf, at = _bytes(words)
    if len(at) < 2:
        return np.zeros(0, np.uint64)
    own = buf[at[0] : at[-1]].astype(np.uint64)
    own += (np.arange(len(own)) - np.repeat(at[:-1] - at[0], np.diff(at))).astype(np.uint64) << np.uint64(8)
    return np.add.reduceat(mixed(own + np.uint64(1)), at[:-1] - at[0])


def _endings(words: pa.Array) -> np.ndarray:
    """The last byte of each word times 256, and the one before it (0 if there is none)."""
    buf, at = _bytes(words)
    out = np.zeros(len(words), np.int64)
    for k, weight in ((1, 256), (2, 1)):
        place = at[1:] - k
        out += np.where(place >= at[:-1], buf[np.maximum(place, 0)], 0).astype(np.int64) * weight
    return out


@dataclass
class Vocabulary:
    words: pa.Array  # the table, in the order of the words read backwards
    count: np.ndarray
    ends: int  # training texts
    tokens: int
    distinct: int  # with the end
    tail_from: np.ndarray  # of each tail, its first ending; the first tail's is 0
    tail_tokens: np.ndarray
    tail_distinct: np.ndarray
    leaf: np.ndarray = field(init=False)  # of the end, of each word of the table, of each tail: its place among the leaves
    depth: np.ndarray = field(init=False)  # of each leaf
    node: list[np.ndarray] = field(init=False)  # for each depth: of each leaf, the class above it
    child: list[np.ndarray] = field(init=False)  # and which class of that one it is or lies in
    bias: np.ndarray = field(init=False)  # nodes x WIDTH: ln of the share of each class, as counted

    def __post_init__(self) -> None:
        n, tails = len(self.words), len(self.tail_from)
        mass = np.concatenate([[self.ends], self.count, self.tail_tokens]).astype(float) + ALPHA
        among = np.concatenate([[-1], np.arange(n), np.searchsorted(_endings(self.words), self.tail_from) - 0.5])
        order = np.argsort(among, kind="stable")
        self.leaf = np.empty(1 + n + tails, np.int64)
        self.leaf[order] = np.arange(len(order))
        mass = mass[order]
        total = np.concatenate([[0], np.cumsum(mass)])
        middle = total[:-1] + mass / 2
        low, high = np.zeros(1, np.int64), np.array([len(mass)])  # the classes of this depth that have several leaves
        self.depth, self.node, self.child, biases, nodes = np.zeros(len(mass), np.int64), [], [], [], 0
        while len(low):
            size = high - low
            of, inside = np.repeat(np.arange(len(low)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            leaf = low[of] + inside
            share = ((middle[leaf] - total[low][of]) / (total[high] - total[low])[of] * WIDTH).astype(np.int64)
            child = np.where(size[of] <= WIDTH, inside, np.minimum(share, WIDTH - 1))
            self.node.append(np.zeros(len(mass), np.int64))
            self.child.append(np.zeros(len(mass), np.int64))
            self.node[-1][leaf], self.child[-1][leaf] = nodes + of, child
            self.depth[leaf] += 1
            held = np.bincount(of * WIDTH + child, mass[leaf], len(low) * WIDTH).reshape(-1, WIDTH)
            there = np.bincount(of * WIDTH + child, minlength=len(low) * WIDTH).reshape(-1, WIDTH)
            biases.append(np.where(there > 0, np.log(np.maximum(held, 1e-300) / held.sum(1, keepdims=True)), NEVER))
            first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (child[1:] != child[:-1])]))
            last = np.append(first[1:], len(of))
            low, high = (leaf[first], leaf[last - 1] + 1)
            low, high, nodes = low[last - first > 1], high[last - first > 1], nodes + len(size)
        self.bias = np.concatenate(biases).astype(np.float32)


@dataclass
class Batch:
    """The tokens of some texts."""

    code: np.ndarray  # 0 the end, word k of the table k + 1, other words beyond by their tail
    known: np.ndarray  # a hash of each token, for the history
    at: np.ndarray  # where each text's tokens start, and the end
    tail: np.ndarray  # positions of words outside the table
    words: pa.Array  # those words


def tokens(v: Vocabulary, texts: pa.Array) -> Batch:
    w = words_of(texts, lower=True)
    coded = w.array.dictionary_encode()
    kinds = coded.dictionary
    place = pc.index_in(kinds, v.words)
    out = place.is_null().to_numpy(zero_copy_only=False)
    code = place.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    code[out] = len(v.words) + np.searchsorted(v.tail_from, _endings(kinds.filter(pa.array(out))), "right")
    hashes = _hashes(kinds)
    of = coded.indices.to_numpy(zero_copy_only=False)
    n = len(w.counts)
    at = w.first + np.arange(n + 1)
    inside = np.ones(at[-1], bool)
    inside[at[1:] - 1] = False
    codes, known = np.zeros(at[-1], np.int64), np.zeros(at[-1], np.uint64)
    codes[inside], known[inside] = code[of], hashes[of]
    outside = np.flatnonzero(out[of])
    return Batch(codes, known, at, np.flatnonzero(inside)[outside], kinds.take(pa.array(of[outside])))


def history(b: Batch) -> np.ndarray:
    """Four hashed features of each token's history: last word, last two, and the words one and two further back."""
    place = np.arange(len(b.known)) - np.repeat(b.at[:-1], np.diff(b.at))
    past = []
    for k in (1, 2, 3):
        x = np.full(len(b.known), 7, np.uint64)  # before the text
        x[k:] = b.known[:-k] if len(x) > k else b.known[:0]
        x[place < k] = 7
        past.append(x)
    one, two, three = past
    return np.stack([mixed(x + np.uint64(k)) for k, x in enumerate((one, one * _ODD + two, two, three))])


def rows_of(feature: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    """The rows of weights of features at nodes."""
    x = (feature + node.astype(np.uint64) * _SALT) * _ODD
    x ^= x >> np.uint64(32)
    x *= _SALT
    return (x >> np.uint64(64 - bits)).astype(np.int64)


_ONES = np.ones(WIDTH, np.float32)


def _levels(v: Vocabulary, weights: np.ndarray, leaf: np.ndarray, past: np.ndarray) -> Iterator[tuple]:
    """For each depth: which tokens have a class there, rows of their features, place of the class in the flat z, z and exp(z)."""
    bits = len(weights).bit_length() - 1
    depth, some = v.depth.take(leaf), None
    for level in range(int(depth.max())):
        if level:
            some = np.flatnonzero(depth > level)
        mine = leaf if some is None else leaf.take(some)
        node = v.node[level].take(mine)
        z, rows = v.bias.take(node, axis=0), []
        for k in FEATURES[min(level, len(FEATURES) - 1)]:
            rows.append(rows_of(past[k] if some is None else past[k].take(some), node, bits))
            z += weights.take(rows[-1], axis=0)
        np.minimum(z, 60, out=z)
        yield some, rows, np.arange(0, len(mine) * WIDTH, WIDTH) + v.child[level].take(mine), z, np.exp(z)


def log_prob(weights: np.ndarray, v: Vocabulary, b: Batch) -> np.ndarray:
    """Of each token, ln of the chance of its leaf."""
    out, past, leaf = np.zeros(len(b.code)), history(b), v.leaf.take(b.code)
    for low in range(0, len(leaf), SCORED):
        part = slice(low, low + SCORED)
        sums = out[part]
        for some, _, at, z, e in _levels(v, weights, leaf[part], past[:, part]):
            found = z.reshape(-1).take(at) - np.log(e @ _ONES)
            if some is None:
                sums += found
            else:
                sums[some] += found
    return out


class Trainer:
    """Gradient steps on a copy of the weights; the more often a row was used, the smaller its steps."""

    def __init__(self, weights: np.ndarray):
        self.start, self.weights = weights, weights.copy()
        self.used = np.zeros(len(weights), np.float32)

    def learn(self, v: Vocabulary, b: Batch) -> None:
        past, leaf = history(b), v.leaf.take(b.code)
        pairs = self.weights.reshape(-1).view(np.complex64)  # two weights are added at once
        ahead = np.arange(WIDTH // 2)
        for low in range(0, len(leaf), STEP):
            part = slice(low, low + STEP)
            for _, rows, at, _, e in _levels(v, self.weights, leaf[part], past[:, part]):
                e /= -(e @ _ONES)[:, None]
                e.reshape(-1)[at] += 1  # uphill
                for r in rows:
                    np.add.at(self.used, r, np.float32(1))
                    step = e * (RATE / np.sqrt(self.used.take(r)))[:, None]
                    np.add.at(pairs, ((r * (WIDTH // 2))[:, None] + ahead).reshape(-1), step.reshape(-1).view(np.complex64))

    def changes(self) -> pa.RecordBatch:
        """Runs of SHARE rows that were used: which, their use, and their change."""
        change, used = (self.weights - self.start).astype(np.float16).reshape(-1, SHARE * WIDTH), self.used.reshape(-1, SHARE)
        some = np.flatnonzero(used.any(1))
        columns = [pa.array(some.astype(np.int32)), *(pa.array([x[k].tobytes() for k in some], pa.binary()) for x in (used, change))]
        return pa.RecordBatch.from_arrays(columns, ["share", "used", "change"])


_CHANGES = "share int, used binary, change binary"


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean change of each row by its use; a task holds the shares that fall to it, a bounded number."""
    total: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for share, used, change in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            use = np.frombuffer(used, np.float32)
            x = [use.astype(np.float64), np.frombuffer(change, np.float16).reshape(SHARE, WIDTH) * use.astype(np.float64)[:, None]]
            total[share] = [a + b for a, b in zip(total[share], x, strict=True)] if share in total else x
    if total:
        mean = [(c / np.maximum(u, 1)[:, None]).astype(np.float16).tobytes() for u, c in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(mean, pa.binary())], ["share", "change"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about AT_ONCE bytes of text: the table of words is looked through once for each."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= AT_ONCE:
            yield from _whole(held)
            held, size = [], 0
    if held:
        yield from _whole(held)


def _whole(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return slices(iter(pa.Table.from_batches(held).combine_chunks().to_batches()), "text", AT_ONCE)


def word_counts(texts: DataFrame) -> DataFrame:
    """word, n of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in _gathered(batches):
            found = words_of(batch.column("text"), lower=True).array.value_counts()
            held.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
            if len(held) == 4:
                yield from _merged(held)
                held = []
        if held:
            yield from _merged(held)

    return map_arrow(texts.select("text"), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _merged(tables: list[pa.Table]) -> list[pa.RecordBatch]:
    both = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
    return pa.table({"word": both["word"].cast(pa.string()), "n": both["n_sum"]}).to_batches(max_chunksize=50_000)


def vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    bin_ = F.floor(F.log2("n") * 64).cast("int")
    short = F.octet_length("word") <= TABLE_BYTES
    bins = counts.where(short).groupBy(bin_.alias("bin")).agg(F.count("*").alias("words")).orderBy(F.desc("bin")).collect()  # 64 rows a doubling
    room, least = TABLE, 1 << 20
    for r in bins:
        room -= r["words"]
        if room < 0:
            break
        least = r["bin"]
    tabled = short & (bin_ >= least)
    table = counts.where(tabled).select("word", "n").toArrow().combine_chunks()
    words = table["word"].combine_chunks() if table.num_rows else pa.array([], pa.string())
    order = np.array(sorted(range(len(words)), key=[x[::-1] for x in words.cast(pa.binary()).to_pylist()].__getitem__), np.int64)
    words, n = words.cast(pa.large_string()).take(pa.array(order)), table["n"].to_numpy().astype(np.int64)[order]

    def endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 << 16), np.int64)
        for batch in batches:
            key = _endings(batch.column("word"))
            sums[0] += np.bincount(key, batch.column("n").to_numpy(zero_copy_only=False), 1 << 16).astype(np.int64)
            sums[1] += np.bincount(key, minlength=1 << 16)
        some = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(sums[0, some]), pa.array(sums[1, some])], ["ending", "n", "words"])

    rest = map_arrow(counts.where(~tabled), endings, "ending int, n long, words long").groupBy("ending").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    found = np.zeros((2, 1 << 16), np.int64)
    for r in rest.collect():  # 65,536 rows at most
        found[:, r["ending"]] = r["n"], r["words"]
    total = found[0].cumsum()
    tail = np.minimum((total - found[0] / 2) / max(total[-1], 1) * TAILS, TAILS - 1).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], tail[1:] != tail[:-1]]))
    tails = np.add.reduceat(found, first, axis=1)
    return Vocabulary(words, n, texts, int(n.sum() + total[-1]) + texts, int(len(n) + found[1].sum()) + (texts > 0), first, tails[0], tails[1])


def initial(v: Vocabulary) -> np.ndarray:
    """No weights: words as counted."""
    rows = min(max(LEAST_ROWS, v.distinct // WORDS_A_ROW), MOST_ROWS)
    return np.zeros((1 << (rows - 1).bit_length(), WIDTH), np.float32)


def fit(train: DataFrame, v: Vocabulary) -> np.ndarray:
    """One pass over all rows of train, in ROUNDS: the weights."""
    sc, weights = train.sparkSession.sparkContext, initial(v)
    n = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    vocab = sc.broadcast(v)
    for turn in range(ROUNDS):
        now = sc.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(now.value)
            for batch in _gathered(batches):
                trainer.learn(vocab.value, tokens(vocab.value, batch.column("text")))
            yield trainer.changes()

        mine = train.where(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == turn).select("text")
        changes = map_arrow(map_arrow(mine, run, _CHANGES).repartition(n, "share"), _averaged, "share int, change binary")
        weights = weights.copy()
        for r in changes.toLocalIterator():  # the size of the weights at most
            weights[r["share"] * SHARE : (r["share"] + 1) * SHARE] += np.frombuffer(r["change"], np.float16).reshape(SHARE, WIDTH)
        now.unpersist()
    return weights


def lm_score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of docs.

    Rows whose crc32 of doc_id (a null as empty text) modulo FOLDS is 0 are held out, all others are trained on. A
    null text is empty: it has the end token alone. Repeated rows count, and are scored, each for itself. If there
    is nothing to train on, every token is unknown. Other columns are ignored; no rows give no rows."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    docs = docs.select("doc_id", text, (fold("doc_id", FOLDS) == 0).alias("held_out"))
    train = docs.where("not held_out")
    counts = written(word_counts(train))
    v = vocabulary(counts, train.count())
    sc = docs.sparkSession.sparkContext
    shared, vocab = sc.broadcast(fit(train, v)), sc.broadcast(v)
    below = v.tokens + ALPHA * (v.distinct + 1)
    within = v.tail_tokens + ALPHA * (v.tail_distinct + 1)
    starts = v.tail_from

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, row = vocab.value, TaskContext.get().partitionId() << 40
        base = np.log(np.concatenate([[v.ends], v.count, np.zeros(len(v.tail_from))]) + ALPHA) - np.log(below)
        base[1 + len(v.words) :] = 0
        for batch in _gathered(batches):
            b = tokens(v, batch.column("text"))
            n = np.diff(b.at)
            of = np.repeat(np.arange(len(n)), n)
            score = np.bincount(of, log_prob(shared.value, v, b), len(n))
            sums = np.bincount(of, base.take(b.code), len(n))
            seen = np.bincount(of, (b.code <= len(v.words)) & ((b.code > 0) | (v.ends > 0)), len(n)).astype(np.int64)
            ends = np.searchsorted(b.tail, b.at)
            tail = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), b.words.cast(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(len(n))), batch.column("doc_id"), batch.column("held_out"), pa.array(n.astype(np.int64)), pa.array(seen), pa.array(sums), pa.array(score), tail],
                ["row", "doc_id", "held_out", "n_tokens", "seen", "base", "found", "tail"],
            )
            row += len(n)

    kind = dict(docs.dtypes)["doc_id"]
    scored = written(map_arrow(docs, run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, seen long, base double, found double, tail array<string>"))
    own = scored.select("row", F.explode("tail").alias("word")).join(counts, "word", "left")

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").fill_null(0).to_numpy(zero_copy_only=False)
            logs = np.log(n + ALPHA)
            of_tail = np.searchsorted(starts, _endings(batch.column("word")), "right") - 1
            rows, of = np.unique(batch.column("row").to_numpy(zero_copy_only=False), return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array(np.bincount(of, n > 0).astype(np.int64)), pa.array(np.bincount(of, logs - np.log(below))), pa.array(np.bincount(of, logs - np.log(within)[of_tail]))],
                ["row", "seen", "base", "found"],
            )

    more = map_arrow(own.select("row", "word", "n"), tails, "row long, seen long, base double, found double")
    more = more.groupBy("row").agg(*(F.sum(x).alias(f"more_{x}") for x in ("seen", "base", "found")))
    both = scored.drop("tail").join(more, "row", "left")
    whole = lambda x: F.col(x) + F.coalesce(f"more_{x}", F.lit(0))
    return both.select(
        "doc_id", "held_out", "n_tokens", whole("seen").alias("n_known"), F.lit(v.tokens).cast("long").alias("train_tokens"),
        (whole("base") / LN10).alias("base_score"), (whole("found") / LN10).alias("score"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(read(spark, sf_dir, "documents"))
