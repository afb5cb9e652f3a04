"""Vector code compression: codebooks of the parts of vectors, fitted with metric trees of an anchors hierarchy.

Vectors are cut into PARTS equal parts, and each part position has a codebook of ENTRIES entries that ROUNDS rounds of exact
means refine, over all vectors. The vectors stay where they were read, in chunks; of each chunk and part position a metric tree is
built once and written out. It is built middle-out: anchors are added one after the other at the point farthest from its own
anchor, each taking the points that are nearer to it (anchors too far off to lose any aren't looked at), until there are about the
root of the number of points; then balls are merged from the middle up, always the two whose union has the least radius, and each
anchor's points are split the same way from the middle down. Every ball caches the sum and the count of its points.

A round walks the trees level by level. A ball inherits from its parent the list of entries that may own some of its points, and
drops those that a better one beats throughout the ball: for entries a and b the difference of squared distances is linear, so
its least value over a ball of centre c and radius r is that at c less 2 r |a - b|. A ball with one entry left gives it its cached
sum and count; leaves that aren't owned compare their points with the entries on their list. All sums are of whole numbers. What
leaves a round's tasks are PARTS * ENTRIES sums each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptally.llm.common import map_arrow, read, written

#: Fixed values of the contract.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors to a chunk, and points of a ball that isn't split.
CHUNK, LEAF = 2048, 24
#: Bytes of chunks that are read at once.
ROW_GROUP = 16 << 20
#: Components end here: beyond it (vectors of components over 4096) sums of squares might not be whole numbers of 64 bits.
LIMIT = 1 << 24
#: Whole numbers up to here are exact in doubles.
EXACT = 2.0**53
LAST = 2**63 - 1

#: A tree as columns: its balls (children after parents; left is -1 for a leaf), and the points in the order of the leaves.
TREE = "order array<int>, begin array<int>, end array<int>, left array<int>, right array<int>, centre array<double>, radius array<double>, total array<long>"
CHUNKS = f"ids array<long>, labels array<{{label}}>, points array<int>, trees array<struct<{TREE.replace(' array', ': array')}>>"


def _anchors(x: np.ndarray, most: int) -> list[np.ndarray]:
    """The points of each of up to `most` anchors, every point with its nearest anchor; fewer if points coincide."""
    first = x[0]
    far = np.sqrt(((x - first) ** 2).sum(1))
    owner = np.zeros(len(x), np.int64)
    pivots = [first]
    while len(pivots) < most:
        new = int(far.argmax())
        if far[new] == 0:
            break
        apart = np.sqrt(((np.array(pivots) - x[new]) ** 2).sum(1))
        radius = np.zeros(len(pivots))
        np.maximum.at(radius, owner, far)
        at = np.flatnonzero((apart < 2 * radius)[owner])  # an anchor farther off than that loses no point
        at = at[far[at] * 2 > apart[owner[at]]]  # nor does a point that is so near to its anchor
        d = np.sqrt(((x[at] - x[new]) ** 2).sum(1))
        taken = d < far[at]
        at, d = at[taken], d[taken]
        owner[at], far[at] = len(pivots), d
        pivots.append(x[new])
    order = np.argsort(owner, kind="stable")
    groups = np.split(order, np.searchsorted(owner[order], np.arange(1, len(pivots))))
    return [g for g in groups if len(g)]


class Tree:
    """The metric tree of the points of one part position in a chunk."""

    def __init__(self, x: np.ndarray):
        self.x = x.astype(np.float64)
        self.balls: list[tuple[int, int, int, int]] = []  # begin, end, left, right; children before parents
        self.order: list[np.ndarray] = []
        self.filled = 0
        if len(x):
            self._split(np.arange(len(x)))

    def _leaf(self, at: np.ndarray) -> int:
        self.order.append(at)
        self.balls.append((self.filled, self.filled + len(at), -1, -1))
        self.filled += len(at)
        return len(self.balls) - 1

    def _split(self, at: np.ndarray) -> int:
        groups = _anchors(self.x[at], max(2, int(np.sqrt(len(at))))) if len(at) > LEAF else []
        if len(groups) < 2:
            return self._leaf(at)
        # from the middle up: a plan of merges, by centres and radii of the unions
        n = len(groups)
        count = np.array([len(g) for g in groups], float)
        centre = np.array([self.x[at[g]].mean(0) for g in groups])
        radius = np.array([np.sqrt(((self.x[at[g]] - c) ** 2).sum(1)).max() for g, c in zip(groups, centre, strict=True)])
        plan: list = [at[g] for g in groups]
        apart = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(2))
        union = (apart + radius[:, None] + radius[None]) / 2
        np.fill_diagonal(union, np.inf)
        for _ in range(n - 1):
            i, j = np.unravel_index(int(union.argmin()), union.shape)
            both = count[i] + count[j]
            middle = (centre[i] * count[i] + centre[j] * count[j]) / both
            radius[i] = max(np.sqrt(((centre[k] - middle) ** 2).sum()) + radius[k] for k in (i, j))
            centre[i], count[i], plan[i], plan[j] = middle, both, (plan[i], plan[j]), None
            union[j, :] = union[:, j] = np.inf
            rest = np.flatnonzero(np.isfinite(union[i]))
            union[i, rest] = union[rest, i] = (np.sqrt(((centre[rest] - middle) ** 2).sum(1)) + radius[i] + radius[rest]) / 2
        root = plan[i]
        # the merges, children first, without recursion over a long chain
        made: dict[int, int] = {}
        stack = [root]
        while stack:
            node = stack[-1]
            if not isinstance(node, tuple):
                made[id(node)] = self._split(node)
                stack.pop()
            elif todo := [k for k in node if id(k) not in made]:
                stack.extend(reversed(todo))
            else:
                left, right = (made[id(k)] for k in node)
                self.balls.append((self.balls[left][0], self.balls[right][1], left, right))
                made[id(node)] = len(self.balls) - 1
                stack.pop()
        return made[id(root)]

    def columns(self) -> dict[str, np.ndarray]:
        """As TREE: the root comes first."""
        n = len(self.balls)
        begin, end, left, right = (np.array([b[k] for b in self.balls], np.int32)[::-1] for k in range(4))
        left, right = (np.where(x < 0, -1, n - 1 - x).astype(np.int32) for x in (left, right))
        order = np.concatenate(self.order).astype(np.int32) if self.order else np.zeros(0, np.int32)
        sorted_x = self.x[order]
        upto = np.concatenate([np.zeros((1, self.x.shape[1])), np.cumsum(sorted_x, axis=0)])
        total = upto[end] - upto[begin]
        centre = total / np.maximum(end - begin, 1)[:, None]
        radius = np.array([np.sqrt(((sorted_x[b:e] - c) ** 2).sum(1).max()) for b, e, c in zip(begin, end, centre, strict=True)])
        return {"order": order, "begin": begin, "end": end, "left": left, "right": right, "centre": centre.ravel(), "radius": radius, "total": total.astype(np.int64).ravel()}


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (id, label, v: array<double>, all of one length) in chunks, with the trees of their parts."""
    waiting: list[pa.RecordBatch] = []

    def chunk(rows: pa.Table) -> pa.RecordBatch:
        v = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
        v = np.clip(np.floor(SCALE * v), -LIMIT, LIMIT)
        width = v.shape[1] // PARTS
        trees = [Tree(v[:, p * width : (p + 1) * width]).columns() for p in range(PARTS)]
        one = lambda values, kind=None: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind) if kind else pa.array(values))
        columns = {k: pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(t[k]) for t in trees)]), pa.int32()), pa.array(np.concatenate([t[k] for t in trees]))) for k in trees[0]}
        struct = pa.StructArray.from_arrays(list(columns.values()), list(columns))
        lists = [pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(x).combine_chunks()) for x in ("id", "label")]
        return pa.RecordBatch.from_arrays([*lists, one(v.astype(np.int32).ravel()), pa.ListArray.from_arrays(pa.array([0, PARTS], pa.int32()), struct)], ["ids", "labels", "points", "trees"])

    have = 0
    for batch in batches:
        waiting.append(batch)
        have += batch.num_rows
        while have >= CHUNK:
            rows = pa.Table.from_batches(waiting)
            yield chunk(rows.slice(0, CHUNK))
            rest = rows.slice(CHUNK)
            waiting, have = rest.to_batches(), rest.num_rows
    if have:
        yield chunk(pa.Table.from_batches(waiting))


class _Chunk:
    """A row of chunks, as arrays."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        get = lambda x: batch.column(x)[row].values
        self.ids, self.labels = get("ids"), get("labels")
        points = get("points").to_numpy(zero_copy_only=False)
        self.points = points.reshape(len(self.ids), -1)
        trees = get("trees")
        width = self.points.shape[1] // PARTS
        self.trees = []
        for p in range(PARTS):
            t = {k: trees.field(k)[p].values.to_numpy(zero_copy_only=False) for k in (x.split()[0] for x in TREE.split(", "))}
            t["centre"], t["total"] = t["centre"].reshape(-1, width), t["total"].reshape(-1, width)
            t["x"] = self.points[:, p * width : (p + 1) * width][t["order"]]
            self.trees.append(t)


def _kind(points: np.ndarray, book: np.ndarray) -> type:
    """Doubles where all sums of squares are exact in them, else whole numbers."""
    most = max(np.abs(points).max(initial=0), np.abs(book).max(initial=0))
    return np.float64 if 4.0 * float(most) ** 2 * max(1, points.shape[1]) < EXACT else np.int64


def _nearest(x: np.ndarray, book: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each point its nearest allowed entry, the lowest among ties, and the squared distance; both exact."""
    kind = _kind(x, book)
    x, book = x.astype(kind), book.astype(kind)
    far = (x**2).sum(1)[:, None] - 2 * (x @ book.T) + (book**2).sum(1)[None]
    held = np.where(allowed, far, np.inf if kind is np.float64 else LAST)
    at = held.argmin(1)
    return at, far[np.arange(len(x)), at].astype(np.int64)


def owned(tree: dict[str, np.ndarray], book: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """(balls, entries, None) of balls that an entry owns whole, and (leaves, all -1, lists) of leaves with several entries on their
    list: walked level by level, a ball's list being what is left of its parent's."""
    n = len(book)
    balls = np.zeros(min(1, len(tree["begin"])), np.int64)
    entries = book.astype(np.float64)
    between = np.sqrt(((entries[:, None] - entries[None]) ** 2).sum(2))
    lists = np.tile(~np.tril(between == 0, -1).any(1), (len(balls), 1))  # one that equals a lower one never owns a point
    squares = (entries**2).sum(1)
    while len(balls):
        c, r = tree["centre"][balls], tree["radius"][balls]
        far = (c**2).sum(1)[:, None] - 2 * (c @ entries.T) + squares
        best = np.where(lists, far, np.inf).argmin(1)
        rows = np.arange(len(balls))
        gain = far - far[rows, best][:, None] - 2 * r[:, None] * between[best]  # least lead of the best over each, in the ball
        slack = 1e-9 * ((c**2).sum(1)[:, None] + squares + squares[best][:, None] + r[:, None] ** 2) + 1e-6
        lists &= ~(gain > slack)
        lists[rows, best] = True
        alone = lists.sum(1) == 1
        if alone.any():
            yield balls[alone], best[alone], None
        leaf = (tree["left"][balls] < 0) & ~alone
        if leaf.any():
            yield balls[leaf], np.full(int(leaf.sum()), -1), lists[leaf]
        inner = ~alone & ~leaf
        balls, lists = np.concatenate([tree["left"][balls[inner]], tree["right"][balls[inner]]]).astype(np.int64), np.concatenate([lists[inner]] * 2)


def _spans(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers from begin[i] to end[i], one range after the other."""
    n = end - begin
    return np.repeat(begin - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)


def _summed(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """part, entry, count and the sums of its points, over all chunks of the task."""
    width, n = books[0].shape[1], len(books[0])
    count, total = np.zeros((PARTS, n), np.int64), np.zeros((PARTS, n, width), np.int64)
    for batch in batches:
        for row in range(batch.num_rows):
            for p, tree in enumerate(_Chunk(batch, row).trees):
                for balls, entry, lists in owned(tree, books[p]):
                    if lists is None:
                        np.add.at(count[p], entry, tree["end"][balls] - tree["begin"][balls])
                        np.add.at(total[p], entry, tree["total"][balls])
                        continue
                    begin, end = tree["begin"][balls], tree["end"][balls]
                    x = tree["x"][_spans(begin, end)]
                    at, _ = _nearest(x, books[p], np.repeat(lists, end - begin, axis=0))
                    count[p] += np.bincount(at, minlength=n)
                    np.add.at(total[p], at, x.astype(np.int64))
    part, entry = np.nonzero(count)
    sums = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(total[part, entry].ravel()))
    yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]), sums], ["part", "entry", "n", "total"])


def _coded(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """id, label, code and error of every vector."""
    for batch in batches:
        for row in range(batch.num_rows):
            chunk = _Chunk(batch, row)
            codes, error = np.zeros((len(chunk.ids), PARTS), np.int64), np.zeros(len(chunk.ids), np.int64)
            for p, tree in enumerate(chunk.trees):
                for balls, entry, lists in owned(tree, books[p]):
                    begin, end = tree["begin"][balls], tree["end"][balls]
                    at = _spans(begin, end)
                    x = tree["x"][at]
                    if lists is None:
                        lists = np.arange(len(books[p]))[None] == entry[:, None]
                    found, far = _nearest(x, books[p], np.repeat(lists, end - begin, axis=0))
                    codes[tree["order"][at], p] = found
                    error[tree["order"][at]] += far
            code = ["".join(f"{k:02x}" for k in r) for r in codes.tolist()]
            yield pa.RecordBatch.from_arrays([chunk.ids, chunk.labels, pa.array(code, pa.string()), pa.array(error)], ["id", "label", "code", "error"])


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """id, label, v of the rows that take part: with a vector without null or non-finite components, of the commonest length that can
    be cut into PARTS equal parts (the longer one among ties)."""
    v = F.col("embedding")
    sound = v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False)) & (F.size(v) > 0) & (F.size(v) % PARTS == 0)
    rows = vectors.where(sound)
    common = rows.groupBy(F.size(v).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    rows = rows.where(F.size(v) == (common["size"] if common else 0))
    return rows.select(F.col("vec_id").cast("long").alias("id"), F.col("label"), v.cast("array<double>").alias("v"))


def first_books(rows: DataFrame) -> list[np.ndarray]:
    """Of each part position, that part of the ENTRIES vectors of the smallest ids (a null one last, the vector among ties)."""
    first = rows.orderBy(F.asc_nulls_last("id"), "v").limit(ENTRIES).collect()
    whole = np.clip(np.floor(SCALE * np.array([r["v"] for r in first])), -LIMIT, LIMIT).astype(np.int64)
    return np.split(whole, PARTS, axis=1) if first else []


def refined(chunks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round over all chunks."""
    width = books[0].shape[1]
    partial = map_arrow(chunks, lambda b: _summed(b, books), "part int, entry int, n long, total array<long>")
    sums = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("total")[k].cast("decimal(38,0)")).alias(f"t{k}") for k in range(width)))
    out = [b.copy() for b in books]
    for r in sums.collect():  # PARTS * ENTRIES rows at most
        out[r["part"]][r["entry"]] = [int(r[f"t{k}"]) // r["n"] for k in range(width)]
    return out


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, code, error of every kept vector; the codebooks).

    vectors: vec_id, embedding, label. Rows are told apart, so repeated rows count each for itself; a null label or id stays as it
    is. Components are taken between -4096 and 4096. With fewer than ENTRIES vectors the codebooks are as short; no vectors give no rows
    and no codebooks. Other columns are ignored, whatever their names."""
    rows = kept_vectors(vectors)
    label = dict(rows.dtypes)["label"]
    books = first_books(rows)
    if not books:
        return rows.limit(0).select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    chunks = written(map_arrow(rows, _chunked, CHUNKS.format(label=label)), row_group=ROW_GROUP)
    for _ in range(rounds):
        books = refined(chunks, books)
    return map_arrow(chunks, lambda b: _coded(b, books), f"id long, label {label}, code string, error long"), books


def vector_codes(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept vector; rows as in compress()."""
    coded, books = compress(vectors)
    coded = written(coded)
    by_label = written(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total")))
    whole = by_label.select(F.col("label").alias("of"), F.least("total", F.lit(LAST)).cast("long").alias("label_error"))
    out = coded.join(whole, F.col("label").eqNullSafe(F.col("of")))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(read(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The rounds one after the other, for tables whose vectors are of one length and whose ids stand once, as the given ones."""
    nearest = (
        f"SELECT v.vec_id, v.part, min(CAST(list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, b.x) + list_inner_product(b.x, b.x) AS BIGINT) * {ENTRIES} + b.entry) best"
        " FROM p v JOIN {book} b ON b.part = v.part GROUP BY v.vec_id, v.part"
    )
    steps = [
        f"""WITH e AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda y: floor({SCALE} * y::DOUBLE)) x FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0)""",
        f"p AS MATERIALIZED (SELECT vec_id, part, x[part * (len(x) // {PARTS}) + 1 : (part + 1) * (len(x) // {PARTS})] x FROM e, (SELECT unnest(range({PARTS})) part))",
        f"b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 entry, x FROM p QUALIFY entry < {ENTRIES})",
    ]
    for k in range(ROUNDS):
        steps += [
            f"a{k} AS MATERIALIZED ({nearest.format(book=f'b{k}')})",
            f"s{k} AS (SELECT a.part, a.best % {ENTRIES} entry, i, floor(sum(v.x[i]) / count(*)) m FROM a{k} a JOIN p v ON v.vec_id = a.vec_id AND v.part = a.part,"
            " (SELECT unnest(range(1, (SELECT max(len(x)) FROM p) + 1)) i) GROUP BY ALL)",
            f"b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(n.x, b.x) x FROM b{k} b LEFT JOIN (SELECT part, entry, list(m ORDER BY i) x FROM s{k} GROUP BY ALL) n"
            " ON n.part = b.part AND n.entry = b.entry)",
        ]
    last = f"b{ROUNDS}"
    return ", ".join(steps) + f""", f AS MATERIALIZED ({nearest.format(book=last)}),
    c AS (SELECT vec_id, string_agg(printf('%02x', CAST(best % {ENTRIES} AS INTEGER)), '' ORDER BY part) code, CAST(sum(best // {ENTRIES}) AS BIGINT) error FROM f GROUP BY vec_id)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) label_error,
      (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: CAST(y AS BIGINT)), ','), ',' ORDER BY part, entry)) FROM {last}) codebooks_sha256 FROM c JOIN e USING (vec_id)"""


OP12_SQL = _sql()
