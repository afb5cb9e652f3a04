"""The fitted operators: held-out figures, exact bases, odd rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hoptally.llm import classifier, html, lm, mixing
from hoptally.llm.common import components

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_classifier_by_the_difference_alone(spark):
    """The normalised difference of the sizes, without the other features, tells the classes apart on held-out rows (of the larger table)."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("documents", "labels"))
    model = classifier.fit(docs, labels)
    rows = docs.join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).where("quality is not null").select("text", "quality").collect()
    x = classifier.features(model, [(r["text"] or "").encode() for r in rows])[:, 0]
    y = np.array([r["quality"] for r in rows])
    pairs = (x[y == 1][:, None] > x[y == 0][None, :]).mean() + 0.5 * (x[y == 1][:, None] == x[y == 0][None, :]).mean()
    assert min((y == 0).sum(), (y == 1).sum()) > 50 and pairs > 0.95


def test_classifier_with_odd_labels(spark, docs, labels):
    """Null labels and ids, repeated rows and rows with both labels change nothing."""
    odd_labels = spark.createDataFrame([(None, 1, 0), (3, None, None), (10**6, 1, 0)], "doc_id long, quality int, toxic int")
    both = labels.limit(20).select("doc_id", F.lit(0).cast("int").alias("quality"), "toxic").unionByName(labels.limit(20).select("doc_id", F.lit(1).cast("int").alias("quality"), "toxic"))
    some = labels.join(both.select("doc_id").distinct(), "doc_id", "left_anti")
    plain = classifier.fit(docs, some)
    assert classifier.fit(docs, some.unionByName(some).unionByName(odd_labels).unionByName(both)) == plain


ODD = [(None, None), (-1, ""), (-2, " \n\t "), (-2, " \n\t "), (-3, "ÀÉ ß  x " * 20_000), (-4, "z" * 100_000)]


def odd(spark):
    return spark.createDataFrame([(i, t, 1.0, "y") for i, t in ODD], "doc_id long, text string, score double, row string")


def test_classifier(spark, docs, labels):
    model = classifier.fit(docs, labels)
    got = classifier.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.85
    rows = classifier.score(odd(spark), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (None, -1)}) == 1
    none = classifier.fit(docs, labels.limit(0))
    assert classifier.score(docs.limit(5), none).first()["score"] == pytest.approx(0.5)
    assert classifier.score(docs.limit(0), model).count() == 0


def test_lm(spark, docs):
    rows = lm.lm_score(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    words = lambda t: [*(t or "").encode().lower().split(), None]
    counts = Counter(w for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 10 for w in words(r["text"]))
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        own = words(r["text"])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), rel=1e-9)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def small_lm(spark, docs, monkeypatch):
    """A model of some texts, with a table of so few words that there are tails."""
    monkeypatch.setattr(lm, "TABLE", 900)
    train = docs.limit(60).select("text")
    v = lm.vocabulary(lm.word_counts(train), 60)
    assert len(v.words) < 900 < v.distinct and len(v.tail_from) > 50
    return v, lm.fit(train, v)


def test_lm_is_a_distribution(spark, docs, monkeypatch):
    """Over the end, all words of the table, and within each tail its words and the unknown, after some histories."""
    import pyarrow as pa

    v, weights = small_lm(spark, docs, monkeypatch)
    assert np.abs(weights).max() > 0.1
    within = v.tail_tokens + lm.ALPHA * (v.tail_distinct + 1)
    assert (v.tail_tokens + lm.ALPHA * v.tail_distinct + lm.ALPHA) == pytest.approx(within)
    leaves = 1 + len(v.words) + len(v.tail_from)
    for past in ([], [3], [700, 2, 5]):
        code = np.concatenate([np.append(past, k) for k in range(leaves)]).astype(np.int64)
        at = np.arange(leaves + 1) * (len(past) + 1)
        b = lm.Batch(code, code.astype(np.uint64) * np.uint64(77), at, np.zeros(0, int), pa.array([]))
        assert np.exp(lm.log_prob(weights, v, b)[at[1:] - 1]).sum() == pytest.approx(1, abs=1e-4)


def test_lm_score_against_plain_steps(spark, docs, monkeypatch):
    """score, from the weights, the tree and the counts by one step after the other."""
    import pyarrow as pa

    rows = docs.limit(80)
    own = [(r["doc_id"], (r["text"] or "")[:3000]) for r in rows.collect()] + [(10**6, "never seen-before words"), (10**6 + 10, None)]
    frame = spark.createDataFrame(own, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(lm, "TABLE", 900)
    kept = {}
    monkeypatch.setattr(lm, "fit", lambda train, v, fit=lm.fit: kept.setdefault("model", (v, fit(train, v)))[1])
    got = {r["doc_id"]: r["score"] for r in lm.lm_score(frame).collect()}
    v, weights = kept["model"]
    counts = Counter(w for i, t in own if zlib.crc32(str(i).encode()) % 10 for w in (t or "").encode().lower().split())
    table = {w: k for k, w in enumerate(v.words.cast(pa.binary()).to_pylist())}
    top, bits = 2**64 - 1, len(weights).bit_length() - 1
    mix = lambda x: int(lm.mixed(np.array([x & top], np.uint64))[0])
    known = lambda w: sum(mix((c | k << 8) + 1) for k, c in enumerate(w)) & top
    odd, salt = int(lm._ODD), int(lm._SALT)
    for i, t in own:
        words, total = (t or "").encode().lower().split(), 0.0
        for k, w in enumerate([*words, None]):
            past = [known(words[k - d]) if k >= d else 7 for d in (1, 2, 3)]
            features = [mix(x + j) for j, x in enumerate((past[0], past[0] * odd + past[1], past[1], past[2]))]
            if w is None:
                code = 0
            elif w in table:
                code = 1 + table[w]
            else:
                ending = w[-1] * 256 + (w[-2] if len(w) > 1 else 0)
                tail = max(j for j, x in enumerate(v.tail_from) if x <= ending)
                code = 1 + len(table) + tail
                total += math.log((counts[w] + 0.1) / (v.tail_tokens[tail] + 0.1 * (v.tail_distinct[tail] + 1)))
            leaf = v.leaf[code]
            for level in range(v.depth[leaf]):
                node = int(v.node[level][leaf])
                z = v.bias[node].astype(float)
                for j in lm.FEATURES[min(level, len(lm.FEATURES) - 1)]:
                    x = (features[j] + node * salt) * odd & top
                    x = (x ^ x >> 32) * salt & top
                    z = z + weights[x >> (64 - bits)]
                total += z[v.child[level][leaf]] - math.log(np.exp(z).sum())
        assert got[i] == pytest.approx(total / math.log(10), rel=1e-4)


def test_lm_learns_more_than_counts(spark, docs):
    """Held out the features gain on the counts (0.09 decades a token on these few texts), and more words give more rows."""
    rows = [r for r in lm.lm_score(docs).collect() if r["held_out"]]
    n = sum(r["n_tokens"] for r in rows)
    assert sum(r["score"] - r["base_score"] for r in rows) / n > 0.05
    few = lm.vocabulary(spark.createDataFrame([("a", 3), ("b", 1)], "word string, n long"), 1)
    many = lm.vocabulary(spark.range(200_000).selectExpr("cast(id as string) word", "id % 7 + 1 n"), 1)
    assert len(lm.initial(few)) < len(lm.initial(many))
    assert few.depth.max() == 1 and many.depth.max() < 12


def test_lm_odd_rows(spark):
    rows = lm.lm_score(odd(spark)).collect()
    assert len(rows) == len(ODD) and all(np.isfinite([r["base_score"], r["score"]]).all() for r in rows)
    assert lm.lm_score(odd(spark).limit(0)).count() == 0
    only = spark.createDataFrame([(int(next(i for i in range(99) if zlib.crc32(str(i).encode()) % 10 == 0)), "a b")], "doc_id long, text string")
    assert lm.lm_score(only).first()["n_known"] == 0  # nothing to train on


def test_mixing(spark, docs, labels):
    out = mixing.mix(docs, labels).collect()
    tokens = np.array([r["n_tokens"] for r in out], float)
    p = np.array([[r[f"p_{d}"] for d in mixing.DOMAINS] for r in out])
    rate = np.array([r["rate"] for r in out])
    assert (rate >= 0).all()
    want = np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])
    assert np.abs((p * (tokens * rate)[:, None]).sum(0) / tokens.sum() - want).max() < 0.01
    # against a plain solution of the same problem: no document would gain by another rate
    residual = (p * (tokens * rate)[:, None]).sum(0) / tokens.sum() - want
    slope = p @ residual + mixing.RIDGE * (rate - 1)
    assert np.abs(slope[rate > 0]).max() < 1e-5 and (slope[rate == 0] > -1e-5).all()
    # and against projected gradient steps on the rates themselves, from 1 on, with momentum that starts anew where it overshoots
    by, step = tokens / tokens.sum(), 1 / ((p * tokens[:, None] / tokens.sum()).T @ p).trace()
    r = v = np.ones(len(p))
    turn = 1.0
    for _ in range(20_000):
        then = np.maximum(0, v - step * (p @ ((p * (by * v)[:, None]).sum(0) - want) + mixing.RIDGE * (v - 1)))
        if ((v - then) * by) @ (then - r) > 0:
            turn = 1.0
        after = (1 + np.sqrt(1 + 4 * turn * turn)) / 2
        r, v, turn = then, then + (turn - 1) / after * (then - r), after
    assert np.abs(np.ones(len(p)) - rate).max() > 0.1 and np.abs(r - rate).max() < 1e-3
    assert len(mixing.mix(odd(spark), labels).collect()) == len(ODD)
    some = labels.limit(0).unionByName(spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 0), (3, 1, None)], labels.schema), allowMissingColumns=True)
    assert mixing.labelled(some).collect() == [(1, 2)]  # toxic before the rest; rows without an id or both labels go
    assert mixing.mix(docs.limit(0), labels).count() == 0
    assert mixing.mixed(odd(spark), labels).columns == odd(spark).columns


@pytest.mark.parametrize("shares", [(0.98, 0.01, 0.01), (0.999, 0.0, 0.001), (0.5, 0.3, 0.2), (0.0, 0.5, 0.5), (1.0, 0.0, 0.0), (0.9, 0.0, 0.1)])
def test_pipeline_mixing_keeps_clean_documents(spark, shares):
    """Whatever the shares of the domains: clean documents stay, and no others are multiplied."""
    import corpus_pipeline

    rng = np.random.default_rng(3)
    own = rng.choice(3, 800, p=shares)
    p = 0.05 * rng.dirichlet([1, 1, 1], 800) + 0.95 * np.eye(3)[own]
    n = rng.integers(5, 400, 800)
    members = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p, strict=True)], "n_tokens long, p array<double>")
    targets = mixing.within(members, corpus_pipeline.CEILINGS)
    rated, got = mixing.rates(members, targets, corpus_pipeline.CEILINGS)
    rows = rated.collect()
    rate, clean = np.array([r["rate"] for r in rows]), np.array([np.argmax(r["p"]) == 0 for r in rows])
    assert (rate[clean] >= 1).all() and (rate[~clean] <= 1).all() and (rate >= 0).all()
    # the ceilings are met without dropping whole domains
    assert np.abs(got - np.array([targets[d] for d in mixing.DOMAINS])).max() < 1e-3
    for d, ceiling in enumerate([None, *corpus_pipeline.CEILINGS.values()]):
        if d and clean.any() and (own == d).any():
            held = (rate * [r["n_tokens"] for r in rows])[[np.argmax(r["p"]) == d for r in rows]].sum() / n.sum()
            assert 0 < held <= ceiling + 0.01
    assert sum(targets.values()) == pytest.approx(1)


def test_html(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    forest = html.train(pages)
    exact = 0
    rows = html.extract(pages, forest).join(pages.select("page_id", "html"), "page_id").collect()
    for r in rows:
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = [" ".join(__import__("html").unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?p>|</?h1>|<br>", body)]
        exact += r["text"] == "\n\n".join(x for x in blocks if x)
    assert exact / len(rows) > 0.95
    odd_pages = [(1, None, None), (None, "u", ""), (2, "u", "<p>"), (2, "u", "<p>"), (3, "u", "<article><p>" + "A fine sentence, and more of it. " * 20_000), (4, "u", "</div></p><b>x</b><<>>&amp;&#0;&bogus;<!-- "), (5, "u", "<ul><li>a<li>b</ul>" * 300)]
    got = html.extract(spark.createDataFrame([(*r, 1) for r in odd_pages], "page_id long, url string, html string, n_chars int"), forest).collect()
    assert len(got) == len(odd_pages) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert html.extract(pages.limit(0), forest).count() == 0


def test_html_in_disguise(spark):
    """Pages that the trees haven't seen, with article and main renamed and attributes taken off or dealt to other elements."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    forest = html.train(pages)
    seen = {r["page_id"] for r in html.sampled(pages).select("page_id").collect()}
    rng = np.random.default_rng(5)
    right = got = want = 0
    rows = [r for r in pages.select("page_id", "html").collect() if r["page_id"] not in seen and r["html"] and "<article" in r["html"]]
    assert len(rows) > 50
    for r in rows:
        truth = html.Page(html.marked(r["html"]))
        mark = html.labels(truth)
        whole = Counter({t: n for t, n in Counter(t for at, t in truth.blocks if mark[at]).items()})
        page = html.disguised(rng, r["html"])
        assert "<article" not in page and "<main" not in page
        found = Counter(html.extracted([page], forest)[0].split("\n\n"))
        size = lambda c: sum(len(t) * n for t, n in c.items())
        right, got, want = right + size(whole & found), got + size(found), want + size(whole)
    print(f"precision {right / got:.3f}, recall {right / want:.3f} by characters over {len(rows)} pages")
    assert right / got > 0.95 and right / want > 0.95


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>a</p><select><option>A<option>B</select><p>b</p><p>c</p>", "a b c"),
        ("<p>a</p><select><optgroup><option>A</option><option>B</select><p>b</p>", "a b"),
        ("<div><p>a</p><button>Buy</div><p>b</p>", "a b"),
        ("<div><button>One<button>Two</button><p>b</p></div>", "b"),
        ("<datalist><option>A<option>B</datalist><p>b</p>", "b"),
        ("<html><head><title>T</title><meta charset=x><p>a</p><p>b</p>", "a b"),
        ("<html><head><title>T</title>a<p>b</p>", "a b"),
        ("<head><noscript><p>none</p></noscript><title>T</title></head><body><p>a</p></body>", "a"),
        ("<p>a</p><button><div>Buy</div> now</button><p>b</p>", "a b"),
        ("<template><template>x</template>y</template><svg><g><text>z</text></g></svg><p>b</p>", "b"),
    ],
)
def test_skipped_elements_end(page, want):
    assert " ".join(t for _, t in html.Page(page).blocks) == want


def test_no_node_contradicts_another():
    rng = np.random.default_rng(1)
    page = html.Page("<div><p>a</p><div><p>b</p><ul><li>c<li>d</ul></div></div><p>e</p>")
    n = len(page.nodes)
    parent = np.array([x.parent for x in page.nodes])
    for _ in range(50):
        score = rng.normal(size=n) * 3
        main = html.decoded(page, score)
        assert all(main[parent[i]] or not main[i] for i in range(1, n))
        best = -np.inf
        for bits in range(1 << n):
            labels = np.array([bits >> i & 1 for i in range(n)], bool)
            if all(labels[parent[i]] or not labels[i] for i in range(1, n)):
                best = max(best, np.where(labels, -np.logaddexp(0, -score), -np.logaddexp(0, score)).sum())
        assert np.where(main, -np.logaddexp(0, -score), -np.logaddexp(0, score)).sum() == pytest.approx(best)


def test_components(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(300, size=(250, 2)) if a != b] + [(500 + k, 501 + k) for k in range(60)] + [(700, 701 + k) for k in range(80)]
    up = {x: x for p in pairs for x in p}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long"), spark).collect()}
    assert got == {x: root(x) for x in up}
    assert components(spark.createDataFrame([], "a long, b long"), spark).count() == 0


def test_fold(spark):
    from hoptally.llm.common import fold

    rows = spark.range(50).select("id", fold("id", 10).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 10 for r in rows)
    assert spark.createDataFrame([(None,)], "id long").select(fold("id", 10)).first()[0] == 0
    assert F is not None


@pytest.mark.parametrize("unit", ["<a ", "<!--", "<b>", "</q>", "</b>", "<b></q>", "<", "<!", '<a b="', "<title>", "<script>", "</", "<a href='x'>", "&amp;", "<x/>", "<select><b>", "</div>", "<option>"])
def test_html_of_a_megabyte(unit):
    """Broken pages take time in proportion to their length: two seconds a megabyte and less, with room for a slow machine."""
    import time

    from hoptally.llm import html

    took = []
    for size in (250_000, 1_000_000):
        page = unit * (size // len(unit))
        began = time.process_time()
        html.Page(page)
        took.append(time.process_time() - began)
    assert took[1] < 6 and (took[1] < 1 or took[1] < 9 * took[0])


def test_html_end_tags_among_many_open_elements():
    import time

    from hoptally.llm import html

    for page in ("<select>" + "<b>" * 150_000 + "</q>" * 150_000, "<b>" * 150_000 + "</q>" * 150_000 + "</a>" * 10):
        began = time.process_time()
        html.Page(page)
        assert time.process_time() - began < 8


def test_html_scanner():
    from hoptally.llm import markup

    class Sink:
        def __init__(self):
            self.out = []

        def handle_starttag(self, tag, attrs):
            self.out.append((tag, *attrs))

        def handle_endtag(self, tag):
            self.out.append("/" + tag)

        def handle_data(self, data):
            self.out.append(data)

    def scanned(html):
        sink = Sink()
        markup.scan(html, sink)
        return [x for k, x in enumerate(sink.out)]

    assert scanned("a&lt;b<P Class=\"x y\" id=z hidden title='&quot;' >c</P >d") == ["a<b", ("p", ("class", "x y"), ("id", "z"), ("hidden", None), ("title", '"')), "c", "/p", "d"]
    assert scanned("<br/><a href=x/>y</a>") == [("br",), "/br", ("a", ("href", "x/")), "y", "/a"]
    assert scanned("a<!-- <b> -->b<!doctype x>c<?x ?>d<!-->e</ x>f") == ["a", "b", "c", "d", "e", "f"]
    assert scanned("<script>if (a<b) '</scr'</SCRIPT >x") == [("script",), "if (a<b) '</scr'", "/script", "x"]
    assert scanned("<style>x") == [("style",), "x"] and scanned("1 < 2 <3") == ["1 < 2 <3"]
    assert scanned("a<b c='x") == ["a"] and scanned("a<!-- b") == ["a"] and scanned("a</b") == ["a"] and scanned("") == []
