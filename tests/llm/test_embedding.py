import numpy as np

from hoptally.llm.embedding import embedding_near_dedup


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 64))
    near = base[rng.integers(40, size=150)] + rng.normal(size=(150, 64)) * rng.uniform(0.05, 0.5, (150, 1))
    v = np.concatenate([base, near, base[:20], 3 * base[:5]]).astype(np.float32)
    label = np.concatenate([np.arange(150) % 3, np.arange(150) % 3, np.arange(20) % 3, np.arange(5) % 3])
    rows = [(int(i), [float(x) for x in r], int(c), "x") for i, (r, c) in enumerate(zip(v, label, strict=True))]
    odd = [(1000, None, 1), (1001, [0.0] * 64, 1), (1002, [float("nan")] * 64, 1), (1003, [float("inf")] + [0.0] * 63, 1), (1004, rows[0][1], None), (1005, [None] + [1.0] * 63, 1), (1006, [1.0, 2.0], 1), (1007, [1.0, 2.0], 1), (1008, [], 1)]
    df = spark.createDataFrame(rows + [(*r, "x") for r in odd], "vec_id long, embedding array<float>, label int, links string")
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    link = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    least = np.arange(len(v))
    for _ in range(len(v)):
        least = np.minimum(least, np.where(link, least[None, :], len(v)).min(1))
    out = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_near_dedup(df).collect()}
    for i in range(len(v)):
        assert out[i] == (link[i].sum(), least[i], least[i] == i)
    for i in (1000, 1001, 1002, 1003, 1004, 1005, 1008):
        assert out[i] == (0, i, True)
    assert out[1006] == (1, 1006, True) and out[1007] == (1, 1006, False)
    assert embedding_near_dedup(df.limit(0)).count() == 0


def test_hot_cells_are_dealt_out(spark, monkeypatch):
    import hoptally.llm.embedding as module

    monkeypatch.setattr(module, "CHUNK", 16)
    rng = np.random.default_rng(4)
    v = (rng.normal(size=64) + 0.1 * rng.normal(size=(80, 64))).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in r], 0) for i, r in enumerate(v)], "vec_id long, embedding array<float>, label int")
    out = embedding_near_dedup(df).collect()
    assert all(r["n_links"] == 79 and r["component_id"] == 0 for r in out)


def unit_links(v, label, cosine=0.93):
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    link = (unit @ unit.T >= cosine) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    return link


def test_many_cells_and_chunks(spark, monkeypatch):
    import hoptally.llm.embedding as module

    monkeypatch.setattr(module, "CELL", 8)
    monkeypatch.setattr(module, "CHUNK", 8)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(120, 40))
    v = np.concatenate([base + rng.normal(size=base.shape) * s for s in (0, 0.1, 0.25, 0.35)])
    label = np.arange(len(v)) % 2
    link = unit_links(v, label)
    assert link.sum() > 100
    df = spark.createDataFrame([(i, x.tolist(), int(c)) for i, (x, c) in enumerate(zip(v, label, strict=True))], "vec_id long, embedding array<double>, label int")
    assert {r["vec_id"]: r["n_links"] for r in embedding_near_dedup(df).collect()} == {i: n for i, n in enumerate(link.sum(1).tolist())}


def test_ids_that_are_null_repeated_or_negative(spark):
    rng = np.random.default_rng(6)
    u, w, x, y = ([float(a) for a in r] for r in rng.normal(size=(4, 64)))
    rows = [(7, u, 1), (None, u, 1), (-5, w, 1), (9, w, 1), (None, x, 1), (3, y, 1), (3, y, 1), (3, u, 2), (None, None, 1), (4, None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in embedding_near_dedup(df).collect())
    assert got == sorted(
        [("7", 1, 7, True), ("None", 1, 7, False), ("-5", 1, -5, True), ("9", 1, -5, False), ("None", 0, None, True), ("3", 1, 3, True), ("3", 1, 3, True), ("3", 0, 3, True), ("None", 0, None, True), ("4", 0, 4, True)], key=lambda r: tuple(map(str, r))
    )


def test_doubles_keep_their_precision(spark):
    a = np.zeros(64)
    a[0] = 1
    pairs = []
    for k, c in enumerate((0.93 + 1e-12, 0.93 - 1e-12)):
        b = np.zeros(64)
        b[0], b[1] = c, np.sqrt(1 - c * c)
        pairs += [(2 * k, a.tolist(), k), (2 * k + 1, b.tolist(), k)]
    df = spark.createDataFrame(pairs, "vec_id long, embedding array<double>, label int")
    assert [r["n_links"] for r in embedding_near_dedup(df).orderBy("vec_id").collect()] == [1, 1, 0, 0]


def test_few_pairs_are_compared_whole(spark):
    """On the larger table less than a fifth of the pairs of a label, over all blocks, are compared beyond half of a block."""
    import pyarrow as pa

    import hoptally.llm.embedding as module

    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("label = 2").collect()
    v = pa.array([r["embedding"] for r in rows], pa.list_(pa.float32()))
    ids = np.arange(len(rows))
    met = compared = 0
    for k in range(4):
        homes = module._Homes(2, (64 * 4096 + k) << 16, module.COSINE)
        homes.add(ids, np.ones(len(ids), np.int64), v)
        list(homes.close())
        met, compared = met + homes.met, compared + homes.compared
    pairs = len(ids) * (len(ids) - 1) // 2
    print(f"compared {compared / pairs:.3f} of all pairs")
    assert compared < 0.2 * pairs
