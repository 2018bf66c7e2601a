"""corpus_pipeline stage by stage against plain Python."""

import re

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from spendmatch.llm import _tokens, toxicity

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage, the first one fed with some odd rows too."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9000, None, "en", "s", None), (9001, "", "en", "s", 0), (None, "no id", "en", "s", 5),
                                 (9002, "\n", "en", "s", 1)], docs.schema)
    now, out = docs.unionByName(odd).cache(), []
    for name, stage in corpus_pipeline.STAGES:
        new = stage(spark, now, SF).cache()
        out.append((now, new))
        now = new
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "best_fit_packing"]


def test_columns_stay(stages):
    for before, after in stages[:-1]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"] and after.schema == before.schema


def test_toxicity_stage(spark, stages):
    before, after = stages[0]
    scored = toxicity.score(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert rows(after).keys() == {r.doc_id for r in scored.where("predicted = 0").collect()}
    assert {9000, 9001, None} <= rows(after).keys()


def test_dedup_stage(stages):
    before, after = map(rows, stages[1])
    fps = {i: brute.simhash(r.text) for i, r in before.items() if i is not None}
    comp = brute.components(sorted(fps), [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2])
    assert after.keys() == {i for i in fps if comp[i] == i} | {None}
    assert all(after[i] == before[i] for i in after)


def test_dedup_stage_decides_by_row(spark, stages):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    docs = spark.createDataFrame([(1, a, "en", "s", 0), (5, a, "en", "s", 0), (5, b, "en", "s", 0), (5, b, "en", "s", 0),
                                  (None, a, "en", "s", 0)], stages[0][0].schema)
    left = corpus_pipeline.simhash_stage(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == [(0, a), (1, a), (5, b)]


def test_decontamination_stage(spark, stages):
    before, after = map(rows, stages[2])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = {i: brute.contamination(r.text, items) for i, r in before.items()}
    assert after.keys() == {i for i, (n, hit, _) in found.items() if not hit or len(hit) < n}
    for i, r in after.items():
        n, hit, _ = found[i]
        if not hit:
            assert r == before[i]
        else:
            assert len(brute.windows(r.text, 10)[0]) == n - len(hit) and r.n_chars == len(r.text)


def test_secrets_stage(stages):
    before, after = map(rows, stages[3])
    assert before.keys() == after.keys()
    for i, r in after.items():
        found = brute.secrets(before[i].text)
        if not found:
            assert r.text == before[i].text or "[SECRET]" in r.text
        else:
            assert not brute.secrets(re.sub(r"\[SECRET\]", " ", r.text)) and "[SECRET]" in r.text and r.n_chars == len(r.text)


def test_packing_stage(stages):
    before, packed = rows(stages[4][0]), stages[4][1].collect()
    tok = _tokens.tokenizer(public_tokenizers.path("word_bpe_49k.json")).tok
    sizes = {i: len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for i, r in before.items()}
    got = {}
    for r in packed:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == sizes
    by = {}
    for r in packed:
        by[r.sequence_id] = by.get(r.sequence_id, 0) + r.length
    assert max(by.values()) <= 2048 and len(by) <= 1.02 * sum(sizes.values()) / 2048 + 2


def test_run_is_the_composition(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() == stages[4][1].where("doc_id is not null and doc_id < 9000").count()
    assert got.agg(F.sum("ids_crc32")).first() == stages[4][1].where("doc_id is not null and doc_id < 9000").agg(F.sum("ids_crc32")).first()
