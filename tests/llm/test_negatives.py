import numpy as np

from hoptally.llm import negatives
from hoptally.llm.negatives import hard_negatives


def brute(rows):
    """The contract, pair by pair, in whole numbers of any size."""
    sound = []
    for i, v, c in rows:
        if c is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        sound.append((i, (c + 1) % 10 if i is not None and i % 7 == 0 else c, [int(np.floor(256.0 * x)) for x in v]))
    last = 2**63 - 1
    out = []
    for a, (i, c, v) in enumerate(sound):
        if i is None or i % 100:
            continue
        score = [(-max(-last, min(last, sum(x * y for x, y in zip(v, w, strict=True)))), last if j is None else j, d) for b, (j, d, w) in enumerate(sound) if b != a and len(w) == len(v)]
        for s, j, _ in sorted(x for x in score if x[2] == c)[:5]:
            fits = sorted(x for x in score if x[2] != c and 30 * -s <= 100 * -x[0] <= 90 * -s)[:10]
            out += [(i, None if j == last else j, k, None if n == last else n, -s, -t) for k, (t, n, _) in enumerate(fits, 1)]
    return sorted(out, key=repr)


def got(spark, rows, kind="double"):
    frame = spark.createDataFrame([(*r, "x") for r in rows], f"vec_id long, embedding array<{kind}>, label int, uid string")
    out = hard_negatives(frame)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def vectors(rng, n, size, spread=1.0):
    centres = rng.normal(size=(6, size)) * 0.5 + rng.normal(size=(6, 1)) * spread
    return [[float(x) for x in r] for r in centres[rng.integers(6, size=n)] + 0.3 * rng.normal(size=(n, size))]


def test_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(negatives, "CHUNK", 64)
    monkeypatch.setattr(negatives, "BLOCK", 3)
    monkeypatch.setattr(negatives, "LEAST_CHUNK", 64)
    monkeypatch.setattr(negatives, "AT_ONCE", 1 << 12)
    n = 900
    ids = rng.permutation(np.arange(-50, n - 50)).tolist()
    rows = [(i, v, int(c)) for i, v, c in zip(ids, vectors(rng, n, 40), np.minimum(rng.integers(14, size=n), 9), strict=True)]
    want = brute(rows)
    assert len(want) > 200 and got(spark, rows) == want


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    v = vectors(rng, 60, 5)
    rows = [(100 * k, v[k], k % 3) for k in range(20)] + [(100 * (k % 20) + k, v[k], k % 4) for k in range(20, 50)]
    rows += [(100, v[1], 1), (100, v[1], 1), (None, v[2], 0), (None, v[2], 0), (None, v[3], 1)]  # repeats, no id
    rows += [(5, None, 1), (6, [None, 1.0, 1.0, 1.0, 1.0], 1), (8, [float("nan")] * 5, 1), (9, [float("inf"), 0.0, 0.0, 0.0, 0.0], 1), (10, v[5], None), (700, v[5], None)]
    rows += [(3000, [1.0, 2.0], 1), (3001, [1.0, 2.0], 1), (3002, [1.0, 1.0], 2), (4000, [], 1), (4001, [], 1), (4002, [], 2)]  # other lengths
    rows += [(5000, [1e300, 1.0, 1.0], 1), (5001, [1e7, 1.0, -1.0], 1), (5002, [1e6, 1.0, 2.0], 2), (5003, [3e6, 3.0, 2.0], 1), (5004, [5e6, 5.0, 2.0], 2), (5100, [4e6, 3.0, 2.0], 1)]
    rows += [(6000, [0.0] * 4, 1), (6001, [0.0] * 4, 1), (6002, [0.0] * 4, 2), (6003, [0.5] * 4, 2)]
    want = brute(rows)
    assert {r[0] for r in want} >= {100, 3000, 4000, 5100, 6000}
    assert got(spark, rows) == want
    assert got(spark, []) == [] and got(spark, rows[1:2]) == []


def test_ties_and_floats(spark):
    v = [1.0, 0.5, 0.25, 0.125] * 4
    rows = [(i, [float(np.float32(x * (1 if i % 2 else 0.8))) for x in v], i % 2) for i in range(300)]
    assert got(spark, rows, "float") == brute(rows)


def test_bounds_hold_and_rule_out():
    """Scores lie within the bounds at every level, finer bounds are no wider, and vectors with telling means are mostly ruled out."""
    rng = np.random.default_rng(3)
    for size in (7, 16, 33, 64):
        v = np.floor(256 * np.array(vectors(rng, 50, size)))
        mean, dev = negatives.summaries(v)
        wide = np.inf
        for segments in negatives.LEVELS:
            m, d = negatives.folded(mean, dev, size, segments)
            assert (np.abs(v @ v.T - m @ m.T) <= d @ d.T + 1e-6 * size * np.abs(v).max() ** 2).all()
            give = (d @ d.T).sum()
            assert give <= wide * (1 + 1e-9)
            wide = give
    steps = np.repeat(rng.normal(size=(3000, 16)), 4, axis=1) + 0.05 * rng.normal(size=(3000, 64))
    v = np.floor(256 * steps)
    mean, dev = negatives.summaries(v)
    ids = np.arange(3000)
    side = negatives.Side(ids, ids, ids % 5, v, [negatives.folded(mean, dev, 64, s) for s in negatives.LEVELS], np.sqrt((v**2).sum(1)))
    some = side.rows(ids[::100])
    n = len(some.ids)
    miner = negatives.Miner(some, np.arange(n), np.full(n, -negatives.LAST), np.full(n, negatives.LAST), 10, False)
    miner.meet(side)
    score = v[::100] @ v.T
    best = {int(r): [] for r in range(n)}
    for r, s, i in zip(*(np.concatenate(x) for x in zip(*miner.best.values(), strict=True)), strict=True):
        best[int(r)].append((-int(s), int(i)))
    for k in range(n):
        other = [j for j in range(3000) if j % 5 != some.label[k]]
        assert sorted(best[k]) == sorted((-int(score[k, j]), j) for j in other)[:10]
    print(f"scored {miner.scored / miner.pairs:.3f} of the pairs")
    assert miner.scored < 0.5 * miner.pairs
