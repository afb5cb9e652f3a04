"""The registered queries that SQL can express, against it."""

import os
import random

import duckdb
import pytest

from hoptally.llm import queries as registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, name):
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.execute(f"create view {t.removesuffix('.parquet')} as select * from '{SF}/{t}'")
    df = registry.queries()[name](spark, SF)
    want = c.sql(registry.oracle_sql()[name])
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    at = [list(want.columns).index(k) for k in order]
    assert sorted(repr([r[k] for k in order]) for r in df.collect()) == sorted(repr([r[k] for k in at]) for r in want.fetchall())


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if name in {"quality_rules", "near_dedup", "substring_dedup"}:
            assert docs.count() <= before
            before = docs.count()
        if name != "packing":
            assert docs.columns == columns
            lengths = docs.selectExpr("sum(abs(length(text) - n_chars))").first()[0]
            assert lengths == 0
    whole = docs.groupBy("sequence_id").sum("length").collect()
    assert whole and max(r[1] for r in whole) <= 1024


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls, empty and long texts, repeats, ids that stand twice, clashing names and an empty table, through all stages."""
    import corpus_pipeline

    def prose(seed, sentences=12):
        words = random.Random(seed).choices("amber basin cedar delta ember fjord grove haven islet jetty knoll lagoon marsh north ocean plain quarry ridge shore tundra".split(), k=9 * sentences)
        return " ".join(" ".join([f"{w}{seed}{k % 97}" for k, w in enumerate(words[j : j + 9], j)]).capitalize() + "." for j in range(0, len(words), 9))

    fine, other = prose(1), prose(2)
    rows = [(None, None), (1, ""), (2, " \n\t"), (3, fine), (3, fine), (4, fine), (None, other), (5, "x" * 200_000), (6, prose(3, 3000)), (6, prose(4)), (7, "short"), (8, prose(5) + " " + other)]
    docs = spark.createDataFrame([(i, t, "en", None, len(t or ""), 1, "clash", 2.0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, _h int, pos string, rate double")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    for k, (frame, some) in enumerate(((docs, True), (docs.limit(0), False))):
        out, counts = frame, []
        for j, (name, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, out, str(tmp_path)).write.parquet(f"{tmp_path}/{k}-{j}")
            out = spark.read.schema(spark.read.parquet(f"{tmp_path}/{k}-{j}").schema).parquet(f"{tmp_path}/{k}-{j}")
            counts.append(out.count())
            if name != "packing":
                assert out.columns == docs.columns
        assert (counts[-1] > 0) == some
    kept = {(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/0-1").collect()}
    assert len([i for i, _ in kept if i == 3]) == 1 and not {1, 2, 5, 7} & {i for i, _ in kept}


def test_pipeline_against_its_operators(spark):
    """run() is its stages one after the other: what is packed are the texts that each operator, called by itself, leaves."""
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline
    from hoptally.llm import minhash, mixing, quality, substring
    from hoptally.llm.packing import VOCABULARY

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = {r["doc_id"]: r["clean_text"] for r in quality.quality_rules(docs).collect() if r["kept"]}
    left = spark.createDataFrame([(i, t) for i, t in clean.items()], "doc_id long, text string")
    first = {r["doc_id"] for r in minhash.near_dedup(left).collect() if r["kept"]}
    left = spark.createDataFrame([(i, t) for i, t in clean.items() if i in first], "doc_id long, text string")
    cut = [(r["doc_id"], r["text"]) for r in substring.substring_dedup(left, **substring.PRODUCTION).collect() if r["removed_words"] < r["n_words"] or not r["n_words"]]
    left = spark.createDataFrame(cut, "doc_id long, text string")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(left, spark.read.parquet(f"{SF}/labels.parquet"), ceilings=corpus_pipeline.CEILINGS).collect()}
    reader = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    want = {}
    for i, t in cut:
        ids = np.array([*reader.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want[i] = (len(ids) * copies[i], zlib.crc32(ids[:1024].tobytes()))
    got = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        n, crc = got.get(r["doc_id"], (0, None))
        got[r["doc_id"]] = (n + r["length"], r["ids_crc32"] if r["start"] == 0 and r["length"] == min(1024, r["doc_tokens"]) else crc)
    assert got == {i: x for i, x in want.items() if x[0]}
