import hashlib

import numpy as np
import pytest

from hoptally.llm import codes
from hoptally.llm.codes import vector_codes


def brute(rows):
    """The contract with Python's whole numbers."""
    sound = [(i, v, c) for i, v, c in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)]
    sizes = [len(v) for _, v, _ in sound if len(v) % 8 == 0]
    size = max(sizes, key=lambda n: (sizes.count(n), n)) if sizes else 0
    kept = [(i, [max(-(1 << 24), min(1 << 24, int(np.floor(4096.0 * x)))) for x in v], c) for i, v, c in sound if len(v) == size and size]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = size // 8
    books, where = [], []
    for p in range(8 if kept else 0):
        x = [v[p * width : (p + 1) * width] for _, v, _ in kept]
        book = x[:16]

        def nearest(y, book):
            d = [sum((a - b) ** 2 for a, b in zip(y, e, strict=True)) for e in book]
            return min(range(len(d)), key=lambda k: d[k]), min(d)

        for _ in range(6):
            at = [nearest(y, book)[0] for y in x]
            book = [[sum(c) // len(mine) for c in zip(*mine, strict=True)] if (mine := [y for y, a in zip(x, at, strict=True) if a == k]) else e for k, e in enumerate(book)]
        books += book
        where.append([nearest(y, book) for y in x])
    digest = hashlib.sha256(",".join(str(a) for e in books for a in e).encode()).hexdigest()
    error = [sum(w[k][1] for w in where) for k in range(len(kept))]
    by = {}
    for (_, _, c), e in zip(kept, error, strict=True):
        by[c] = by.get(c, 0) + e
    return sorted(((i, "".join(f"{w[k][0]:02x}" for w in where), error[k], by[c], digest) for k, (i, _, c) in enumerate(kept)), key=repr)


def got(spark, rows, kind="double"):
    frame = spark.createDataFrame([(*r, 1) for r in rows], f"vec_id long, embedding array<{kind}>, label int, error int").repartition(3)
    out = vector_codes(frame)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def clustered(rng, n, size):
    centres = rng.normal(size=(30, size))
    return [[float(x) for x in r] for r in centres[rng.integers(30, size=n)] + 0.05 * rng.normal(size=(n, size))]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(codes, "CHUNK", 150)
    rng = np.random.default_rng(1)
    n = 700
    rows = [(int(i), v, None if k % 9 == 0 else k % 4) for k, (i, v) in enumerate(zip(rng.permutation(n) - 20, clustered(rng, n, 32), strict=True))]
    assert got(spark, rows) == brute(rows)


def test_plain_floats(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=16).astype(np.float32)], i % 3) for i in range(400)]
    assert got(spark, rows, "float") == brute(rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    v = clustered(rng, 40, 8)
    rows = [(k, v[k], None) for k in range(20)] + [(k, v[0], 1) for k in (-3, 3, 3, 3)] + [(None, v[5], 2), (None, v[6], 2)]
    rows += [(50, None, 1), (51, [None] * 8, 1), (52, [float("nan")] * 8, 1), (53, [float("inf")] * 8, 1), (54, [], 1), (55, [1.0] * 7, 1), (56, [1.0] * 16, 1)]
    rows += [(60, [1e300, -1e300, 5000.0, 0.0, 1.0, 2.0, 3.0, 4.0], 7), (61, [-0.0] * 8, 7)]
    assert got(spark, rows) == brute(rows)
    same = [(k, [0.25] * 8, 1) for k in range(60)]
    assert got(spark, same) == brute(same)
    few = [(k, v[k], 1) for k in range(5)]
    assert got(spark, few) == brute(few)
    assert got(spark, []) == [] and got(spark, [(1, None, 1), (2, [1.0], None)]) == []


@pytest.mark.parametrize("spread", [0.0, 0.02, 1.0])
def test_trees(spread):
    """Each point lies in one leaf, balls hold their points, caches are right, and what an entry owns is nearest to it."""
    rng = np.random.default_rng(4)
    x = np.floor(4096 * (rng.normal(size=(12, 6))[rng.integers(12, size=1500)] + spread * rng.normal(size=(1500, 6))))
    t = codes.Tree(x).columns()
    assert sorted(t["order"]) == list(range(1500))
    leaf = t["left"] < 0
    covered = np.concatenate([np.arange(b, e) for b, e in zip(t["begin"][leaf], t["end"][leaf], strict=True)])
    assert sorted(covered) == list(range(1500)) and t["begin"][0] == 0 and t["end"][0] == 1500
    centre, total = t["centre"].reshape(-1, 6), t["total"].reshape(-1, 6)
    for k, (b, e) in enumerate(zip(t["begin"], t["end"], strict=True)):
        points = x[t["order"][b:e]]
        assert (points.sum(0) == total[k]).all() and (np.sqrt(((points - centre[k]) ** 2).sum(1)) <= t["radius"][k] + 1e-6).all()
        if not leaf[k]:
            left, right = t["left"][k], t["right"][k]
            assert (t["begin"][left], t["end"][left], t["end"][right]) == (b, t["begin"][right], e)
    book = np.concatenate([x[:15], x[:1]]).astype(np.int64)
    far = ((x[:, None] - book[None]) ** 2).sum(2)
    tree = t | {"centre": centre, "total": total}
    seen, alone = 0, 0
    for balls, entry, lists in codes.owned(tree, book):
        for j, k in enumerate(balls):
            points = t["order"][t["begin"][k] : t["end"][k]]
            seen += len(points)
            if lists is None:
                alone += len(points)
                assert (far[points].argmin(1) == entry[j]).all()
            else:
                assert lists[j][far[points].argmin(1)].all()
    assert seen == 1500
    print(f"spread {spread}: {alone} of 1500 points by cached sums, {len(centre)} balls")
    assert alone > (1000 if spread == 0 else 500 if spread < 1 else -1)  # entries that share a cluster split it
