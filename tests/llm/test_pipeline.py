"""The pipeline's stages, each against a brute-force version of its decision."""
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daylake.llm import decontaminate, mixing, quality, queries, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, step in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        step(spark, docs, SF).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def test_stages_keep_the_columns(stages):
    for before, after in stages[:-1]:
        assert after.dtypes == before.dtypes and after.count() > 0


def test_quality_stage(spark, stages):
    before, after = stages[0]
    model = queries.quality_model(spark, before, SF)
    good = {r.doc_id for r in quality.score(before, model, ["doc_id"]).where("score >= 0.5").collect()}
    assert {r.doc_id for r in after.collect()} == good and len(good) < before.count()


def test_simhash_stage(stages):
    before, after = stages[1]
    fp = {r.doc_id: simhash.fingerprint(r.text) for r in before.collect()}
    parent = {d: d for d in fp}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in fp:
        for b in fp:
            if a < b and (fp[a] ^ fp[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert sorted(r.doc_id for r in after.collect()) == sorted({find(d) for d in fp})
    assert after.count() < before.count()


def test_decontamination_stage(spark, stages):
    before, after = stages[2]
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in before.collect() if not any(i in decontaminate.normal(r.text) for i in items)}
    assert {r.doc_id for r in after.collect()} == clean


def test_mixing_stage(stages):
    before, after = stages[3]
    want = {(r.doc_id, r.n) for r in mixing.copies(before, mixing.rates(before)).groupBy("doc_id")
            .agg(F.count("*").alias("n")).collect()}
    assert {(r.doc_id, r.n) for r in after.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == want
    assert max(n for _, n in want) > 1


def test_token_stage(stages):
    from tokenizers import Tokenizer
    before, after = stages[4]
    tok, start = Tokenizer.from_file(queries.tokenizer_path()), 0
    got = sorted(after.collect(), key=lambda r: r.start)
    for d, r in zip(sorted(before.collect(), key=lambda r: r.doc_id), got):
        ids = np.array(tok.encode(d.text, add_special_tokens=False).ids + [0], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == before.count()


def test_run_equals_the_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[-1][1].collect()))


def test_odd_rows_go_through(spark):
    rows = [(1, "The plain words of a text that stands here.", "en", "a", 1, "x"), (None, None, None, None, None, None), (2, "", "en", None, 0, "x"),
            (1, "The plain words of a text that stands here.", "en", "a", 1, "x"), (3, "word " * 50_000, "en", "b", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, copy string")
    for name, step in corpus_pipeline.STAGES:
        for part in (docs, docs.limit(0)):
            out = step(spark, part, SF)
            assert out.count() <= 5 if name != "mixing" else out.count() < 40
            if name != "tokens":
                assert out.columns == docs.columns
