import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from hoptally.llm import minhash
from hoptally.llm.common import components, nearer_stars
from hoptally.llm.minhash import alike, deduplicated, edit_distance_within, near_dedup


def distance(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


@settings(max_examples=500, deadline=None)
@given(st.text("abc", max_size=14), st.text("abc", max_size=14), st.integers(0, 15))
def test_banded_alignment(a, b, most):
    assert edit_distance_within(list(a), list(b), most) == min(distance(a, b), most + 1)


def text(rng, n=120):
    return [rng.choice("abcdefghijklmnop") * rng.randint(1, 4) + str(rng.randint(0, 400)) for _ in range(n)]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randint(0, 9**6)}"
    return words


def classes(rows):
    by = defaultdict(set)
    for r in rows:
        by[r["class_id"]].add(r["doc_id"])
    return {frozenset(x) for x in by.values()}


def test_against_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(25):
        base = text(rng)
        texts += [base, *(edited(rng, base, rng.randint(0, 5)) for _ in range(rng.randint(0, 4)))]
    shared = text(rng, 60)
    texts += [text(rng, 60) + shared for _ in range(10)]  # a passage in common doesn't make copies
    rng.shuffle(texts)
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if alike(rows[i][1], rows[j][1]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    want = defaultdict(set)
    for k in range(len(rows)):
        want[root(k)].add(k)
    found = near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert classes(found) == {frozenset(x) for x in want.values()}
    assert sum(r["kept"] for r in found) == len(want)


def test_odd_rows(spark):
    rng = random.Random(6)
    one, other = " ".join(text(rng)), " ".join(text(rng, 30_000))
    rows = [(1, one, 0), (2, one, 0), (2, one, 0), (None, one, 0), (3, None, 0), (4, "", 0), (5, "a b", 0), (6, "a b", 0), (7, other, 0), (8, other + " more", 0), (None, "alone " + other[:300], 0), (9, "c d", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, band int")
    out = near_dedup(docs).collect()
    got = {(r["doc_id"], r["class_id"]) for r in out}
    assert got == {(1, 1), (2, 1), (None, 1), (3, 3), (4, 3), (5, 5), (6, 5), (7, 7), (8, 7), (None, None), (9, 9)}
    left = deduplicated(docs)
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["1", "3", "5", "7", "9", "None"]
    assert near_dedup(docs.limit(0)).count() == deduplicated(docs.limit(0)).count() == 0


def test_all_that_share_a_sketch_are_compared(spark):
    """Versions near an original but not near each other: the classes are those of all pairs that share a sketch."""
    rng = random.Random(7)
    base = text(rng, 200)
    versions = []
    for _ in range(150):
        at = set(rng.sample(range(200), 28))
        versions.append([f"v{rng.randint(0, 9**8)}" if k in at else w for k, w in enumerate(base)])
    rows = [(k, " ".join(t)) for k, t in enumerate([*versions[:75], base, *versions[75:]])]
    buckets = defaultdict(list)
    for k, keys in enumerate(minhash.keys_of(pa.array([t for _, t in rows]))[0][:, : minhash.SKETCHES + minhash.SINGLES]):
        for band, key in enumerate(keys):
            buckets[band, key].append(k)
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, j in {(i, j) for x in buckets.values() for i in x for j in x if i > j}:
        if alike(rows[i][1], rows[j][1]):
            a, b = sorted((root(i), root(j)))
            up[b] = a
    want = defaultdict(set)
    for k in range(len(rows)):
        want[root(k)].add(k)
    assert max(map(len, want.values())) > 120
    found = near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert classes(found) == {frozenset(x) for x in want.values()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=40), st.lists(st.sampled_from("abcdefgh"), max_size=40))
def test_bags_never_rule_out_a_near_pair(a, b):
    x, y = (np.frombuffer(v, np.uint8).astype(int) for v in minhash.bags(pa.array([" ".join(a), " ".join(b)])))
    assert np.abs(x - y).sum() <= 2 * distance(a, b)


def test_pairs_at_the_bound_are_found(spark):
    """Pairs of edit similarity 0.80 to 0.90 with the edits at random places, of 15 to 200 words."""
    rng = random.Random(8)
    rows = []
    for k in range(300):
        n = rng.choice([15, 30, 60, 120, 200])
        base = [f"{k}w{rng.randint(0, 400)}" for _ in range(n)]
        other = list(base)
        for at in rng.sample(range(n), int(n * rng.choice([0.2, 0.2, 0.15, 0.1]) + 1e-9)):
            other[at] = f"{k}x{rng.randint(0, 9**9)}"
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    found = near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).where("class_rows = 2").count()
    assert found >= 0.99 * len(rows)


def test_repeated_rows_are_compared_once(spark):
    rng = random.Random(9)
    base = text(rng)
    docs = spark.createDataFrame([(1, " ".join(base))] * 40 + [(2, " ".join(edited(rng, base, 3)))] * 40, "doc_id long, text string")
    assert minhash.links(docs).distinct().count() == minhash.links(docs).count() == 1
    out = near_dedup(docs).collect()
    assert len(out) == 80 and {r["class_rows"] for r in out} == {80} and sum(r["kept"] for r in out) == 1


def test_recall_on_the_given_documents(spark):
    """Classes against those of all pairs that are alike, of the texts of a table whose lengths and bags allow it."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted({(r["doc_id"], r["text"] or "") for r in docs.collect()})
    bags = np.stack([np.frombuffer(x, np.uint8) for x in minhash.bags(pa.array([t for _, t in rows]))]).astype(np.int16)
    n = np.array([len(t.encode().split()) for _, t in rows])
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i in range(len(rows)):
        could = np.flatnonzero((np.abs(bags[:i] - bags[i]).sum(1) <= 2 * np.floor(0.2 * np.maximum(n[:i], n[i]) + 1e-9)) & (n[:i] > 0) & (n[i] > 0))
        for j in could.tolist():
            if root(i) != root(j) and alike(rows[i][1], rows[j][1]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    want = defaultdict(set)
    for k, (d, t) in enumerate(rows):
        if t.split():
            want[root(k)].add(d)
    whole = {frozenset(x) for x in want.values()}
    assert sum(len(x) > 1 for x in whole) > 30
    found = classes(r for r in near_dedup(docs).collect())
    assert len(whole - found) <= 0.01 * len(whole)


def test_signatures_of_long_texts():
    """Pairs at the bound pass; texts that only have their commonest words in common don't."""
    rng = random.Random(10)
    common = [f"c{k}" for k in range(60)]
    prose = lambda n: [rng.choice(common) if rng.random() < 0.5 else f"w{rng.randint(0, 5000)}" for _ in range(n)]
    near, far = [], []
    for n in (450, 1000, 4000):
        for _ in range(20):
            base = prose(n)
            other = list(base)
            for at in rng.sample(range(n), n // 5):
                other[at] = f"x{rng.randint(0, 9**9)}"
            near.append((" ".join(base), " ".join(other)))
            far.append((" ".join(base), " ".join(prose(n))))
    for pairs, want in ((near, True), (far, False)):
        n = np.array([len(x.split()) for x, _ in pairs])
        x, y = (np.stack([np.frombuffer(v, np.uint8) for v in minhash.outlines(pa.array(side), n).to_pylist()]) for side in zip(*pairs, strict=True))
        assert (minhash.could_be(x, y, n, n) == want).all()


def test_chunks_by_length_lose_nothing(spark, monkeypatch):
    """The same pairs, whether a bucket's texts meet all at once, in chunks, or in chunks by length."""
    rng = random.Random(12)
    core = [f"core{k}" for k in range(60)]
    rows = []
    for i in range(260):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([2, 8, 15, 40, 90, 200]))]
        rows.append((i, " ".join(core + own)))
        if i % 5 == 0:
            rows.append((1000 + i, " ".join(core + [w if rng.random() > 0.05 else "x" for w in own])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for chunk, banded in ((4096, 3), (32, 100), (8, 1), (32, 0)):
        monkeypatch.setattr(minhash, "CHUNK", chunk)
        monkeypatch.setattr(minhash, "BANDED", banded)
        found.append(sorted(map(tuple, minhash.near_dedup(docs).collect())))
    assert found[0] == found[1] == found[2] == found[3]
    assert len({r for r in found[0]}) == len(rows)


def test_outlines_around_the_length_of_signatures():
    """Texts of just under and over LONG words: near pairs pass, and those that only share a core of 70 % don't."""
    rng = random.Random(13)
    words = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    near, far = [], []
    for _ in range(60):
        base = words(rng.randrange(330, 480))
        other = list(base)
        for _ in range(len(base) // 6):
            k = rng.randrange(len(other))
            other[k : k + rng.randrange(2)] = words(rng.randrange(2))
        near.append((base, other))
        far.append((base[:280] + words(rng.choice([110, 130])), base[:280] + words(rng.choice([110, 130]))))
    for pairs, least, most in ((near, 1, 1), (far, 0, 0.3)):
        n, m = (np.array([len(x) for x in side]) for side in zip(*pairs, strict=True))
        x, y = (minhash._matrix(minhash.outlines(pa.array([" ".join(t) for t in side]), k), k) for side, k in zip(zip(*pairs, strict=True), (n, m), strict=True))
        assert ((n >= minhash.LONG) != (m >= minhash.LONG)).any()
        assert least <= minhash.could_be(x, y, n, m).mean() <= most
    assert all(minhash.alike(" ".join(a), " ".join(b)) for a, b in near)


def test_a_pair_leaves_one_bucket(spark, monkeypatch):
    """Versions near an original but not near each other share many buckets: each pair is met in one of them, and none is lost."""
    rng = random.Random(14)
    base = text(rng, 150)
    rows = []
    for k in range(30):
        at = set(rng.sample(range(150), 20))
        rows.append((k, " ".join(f"v{rng.randint(0, 9**8)}" if j in at else w for j, w in enumerate(base))))
    texts = pa.array([t for _, t in rows])
    keys, has, n = minhash.keys_of(texts)
    held = [sorted(keys[k][has[k]].astype(np.int64).tolist()) for k in range(30)]
    bag = minhash.outlines(texts, n).to_pylist()
    share = {(b, a) for a in range(30) for b in range(a + 1, 30) if set(held[a]) & set(held[b])}
    size = lambda key: sum(key in h for h in held)
    rows = [(key, [x for x in held[k] if x < key], k, int(n[k]), k, size(key), bag[k]) for k in range(30) for key in held[k]]
    members = spark.createDataFrame(rows, "key long, before array<long>, id long, n long, class long, size long, bag binary")
    made = []
    monkeypatch.setattr(minhash, "map_arrow", lambda df, run, schema: made.append(df.mapInArrow(run, schema)) or made[-1])
    got = sorted(map(tuple, minhash._among(members, 4).collect()))
    assert made[0].count() == len(got)  # not once a bucket
    outlines = minhash._matrix(pa.chunked_array([pa.array(bag)]), n)
    could = {(b, a) for b, a in share if minhash.could_be(outlines[[a]], outlines[[b]], n[[a]], n[[b]])[0]}
    assert set(got) == could
    assert len(got) > 50


def test_a_bucket_of_long_texts_takes_little_memory(spark, monkeypatch):
    """Outlines of a large bucket's pairs are copied a few thousand at a time, and the pairs of near copies aren't held at once."""
    rng = np.random.default_rng(15)
    many = 1000
    bag = [x.tobytes() for x in np.concatenate([np.full((many, 256), 7), rng.integers(0, 4, (many, 512))], axis=1).astype(np.uint8)]
    members = spark.createDataFrame([], "key long, before array<long>, id long, n long, class long, size long, bag binary")
    for only, like in (("", False), ("likeliest", False), ("hub", True)):
        runs = []
        monkeypatch.setattr(minhash, "map_arrow", lambda df, run, schema, runs=runs: runs.append(run) or spark.createDataFrame([], schema))
        minhash._among(members, 4, only)
        one = pa.array([1] * many)
        ids, n = pa.array(range(many)), pa.array([1000] * many)
        held = pa.array(bag[:1] * many if like else bag, pa.binary())
        batch = pa.RecordBatch.from_arrays([one, one, one, one, ids, n, ids, held, pa.array([[]] * many, pa.list_(pa.int64()))], ["key", "lo", "hi", "chunk", "id", "n", "class", "bag", "before"])
        tracemalloc.start()
        try:
            made = sum(b.num_rows for b in runs[0](iter([batch])))
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert made == (many - 1 if like else 0)
        assert peak < 100e6


def test_an_id_with_a_short_and_a_long_text(spark):
    """Each of an id's texts meets others by its own outline."""
    rng = random.Random(16)
    short, long = text(rng, 120), text(rng, 600)
    rows = [(1, " ".join(short)), (1, " ".join(long)), (2, " ".join(edited(rng, short, 2))), (3, " ".join(edited(rng, long, 5))), (4, " ".join(text(rng, 120)))]
    found = near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert classes(found) == {frozenset({1, 2, 3}), frozenset({4})}


def first_meeting(spark, monkeypatch, bag, keys):
    """What the first comparison lets out of a task that has these outlines of texts of 100 words, in buckets of these keys, and how many pairs it looks at."""
    runs, looked, could_be = [], [], minhash.could_be
    monkeypatch.setattr(minhash, "map_arrow", lambda df, run, schema: runs.append(run) or spark.createDataFrame([], schema))
    monkeypatch.setattr(minhash, "could_be", lambda x, y, n, m: looked.append(len(x)) or could_be(x, y, n, m))
    minhash._among(spark.createDataFrame([], "key long, before array<long>, id long, n long, class long, size long, bag binary"), 4, "hub")
    many = len(bag)
    one, ids, n = pa.array([0] * many), pa.array(range(many)), pa.array([100] * many)
    batch = pa.RecordBatch.from_arrays([pa.array(keys), one, one, one, ids, n, ids, pa.array(bag, pa.binary()), pa.array([[]] * many, pa.list_(pa.int64()))], ["key", "lo", "hi", "chunk", "id", "n", "class", "bag", "before"])
    out = pa.Table.from_batches(list(runs[0](iter([batch]))))
    pairs = {(a, b) for a, b in zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True) if a is not None}
    return pairs, set(out["key"].to_pylist()) - {None}, sum(looked)


def test_a_large_bucket_of_near_copies_takes_time_in_proportion(spark, monkeypatch):
    many = 2000
    pairs, open_, looked = first_meeting(spark, monkeypatch, [bytes([1] * 100 + [0] * 156)] * many, [1] * many)
    assert len(pairs) == many - 1 and open_ == {1}
    assert looked <= 100 * many


def test_a_bucket_of_few_near_pairs_is_done_with_at_once(spark, monkeypatch):
    """All pairs that may be near leave a bucket of few; what has more comes back."""
    rng = np.random.default_rng(17)
    far = [bytes(x) for x in rng.integers(0, 9, (6, 256), np.uint8)]
    bag = [far[0], far[0], far[1], far[2], far[2], far[3], *[far[4]] * 5]
    pairs, open_, _ = first_meeting(spark, monkeypatch, bag, [1] * 6 + [2] * 5)
    assert {(1, 0), (4, 3)} <= pairs and open_ == {2}
    assert len(pairs) == 6


def test_packed_outlines_never_rule_out_more_than_edits():
    rng = random.Random(18)
    texts = [["a"] * 40 + text(rng, rng.randint(300, 395)) for _ in range(40)]
    others = [[*x, *text(rng, 60)] for x in texts]
    n, m = (np.array([len(x) for x in side]) for side in (texts, others))
    x, y = (minhash._matrix(minhash.packed(minhash.outlines(pa.array([" ".join(t) for t in side]), k), k), k) for side, k in ((texts, n), (others, m)))
    assert ((n < minhash.LONG) & (m >= minhash.LONG)).any()
    width = max(x.shape[1], y.shape[1])
    x, y = (np.pad(z, ((0, 0), (0, width - z.shape[1]))) for z in (x, y))
    assert (minhash.apart(x, y, n, m) <= 60).all()


def test_a_large_bucket_of_few_near_pairs_is_done_with_at_once(spark, monkeypatch):
    rng = np.random.default_rng(19)
    bag = [bytes(x) for x in rng.integers(0, 9, (300, 256), np.uint8)]
    bag[299] = bag[7]
    pairs, open_, _ = first_meeting(spark, monkeypatch, bag, [1] * 300)
    assert pairs == {(299, 7)} and open_ == set()


def test_buckets_of_the_same_members_meet_once(spark, monkeypatch):
    """Two near copies share many sketches, which no other text has: one bucket of them is dealt out. Other sets of members all are."""
    rng = random.Random(20)
    base = text(rng)
    dealt, among = [], minhash._among
    monkeypatch.setattr(minhash, "_among", lambda members, parts, only="": dealt.append(members.count()) or among(members, parts, only))
    out = near_dedup(spark.createDataFrame([(1, " ".join(base)), (2, " ".join(edited(rng, base, 1)))], "doc_id long, text string"))
    assert {r["class_rows"] for r in out.collect()} == {2} and dealt[0] == 2
    rows = [(x, 50, key) for key, ids in ((1, (1, 2)), (2, (2, 1)), (3, (1, 2, 3)), (4, (1, 3)), (5, (4, 4, 1)), (6, (5, 5, 1))) for x in ids]
    left = minhash._unlike(spark.createDataFrame(rows, "id long, n long, key long")).collect()
    assert sorted((r["key"], r["id"]) for r in left) == [(1, 1), (1, 2), (3, 1), (3, 2), (3, 3), (4, 1), (4, 3), (5, 1), (5, 4), (5, 4), (6, 1), (6, 5), (6, 5)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=14), st.lists(st.sampled_from("abc"), max_size=14))
def test_alike_is_the_edit_distance(a, b):
    assert alike(" ".join(a), " ".join(b)) == (distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9))


def test_coarse_bags_never_rule_out_more_than_edits():
    rng = random.Random(21)
    texts = [["a"] * 40 + text(rng, rng.randint(60, 420)) for _ in range(80)]
    others = [[*edited(rng, x, 30), *text(rng, 20)] for x in texts]
    n, m = (np.array([len(x) for x in side]) for side in (texts, others))
    sides = []
    for side, k in ((texts, n), (others, m)):
        bag = minhash.packed(minhash.outlines(pa.array([" ".join(t) for t in side]), k), k)
        sides.append(minhash.coarse(minhash._matrix(bag, k), k).astype(int))
    assert ((n < minhash.LONG) & (m >= minhash.LONG)).any() and (n >= minhash.LONG).any()
    assert (np.abs(sides[0] - sides[1]).sum(1) + m - n <= 2 * 50).all()


def test_nearer_stars_keep_components(spark):
    rng = random.Random(22)
    edges = sorted({(max(x), min(x)) for x in (rng.sample(range(150), 2) for _ in range(110))})
    want = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long"), spark).collect()}
    once = nearer_stars(spark.createDataFrame(edges, "a long, b long"))
    assert once.where("a <= b").isEmpty()
    assert {tuple(r) for r in components(once, spark).collect()} == want
