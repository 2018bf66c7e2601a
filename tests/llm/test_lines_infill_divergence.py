"""Line dedup, fill-in-middle and the source audit against plain Python, on given documents and odd rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendmatch.llm import divergence, infill, lines, oracle, perfect_hash, queries

from . import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
CLASH = ("n", "form", "output", "n_lines", "n_dropped", "bitmap", "rank", "value", "item", "part", "slot", "shard", "first", "pos", "term", "total")


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(90).select(
        "doc_id", "text", "lang", "source", "n_chars").collect()]
    rng = random.Random(8)
    many = "\n".join(rng.choice(["common line of text", f"own line number {i}", "", "É common LINE ", " \tcommon Line of Text\r"]) for i in range(5000))
    odd = [(1001, None), (1002, ""), (1003, "\n"), (1004, "\n\n"), (1005, rows[0][1]), (1006, many), (1007, "no end\nof line"), (1008, "ended\n"),
           (1009, "has <S> marker\nin it"), (1010, "é" * 9 + "\n" + "é" * 10), (1011, "É" * 10), (1012, "é" * 10 + " \x0b"), (1013, "x" * 90000),
           (1014, "😀 wide\n\U0001F600 Common line of text\nK elvin K sign\nk elvin K sign"), (1014, "second row of the id\ncommon line of text"),
           (1014, "second row of the id\ncommon line of text"), (None, "no id at all\ncommon line of text"), (None, "no id at all\nelse"), (-5, "COMMON LINE OF TEXT")]
    return [*rows, *[(i, t, "en" if k % 3 else None, ["s", None, "", "src1"][k % 4], None) for k, (i, t) in enumerate(odd)], (2000, "lonely words", "xx", "s", 0),
            (2001, "", "yy", "a", 0), (2002, "7 8 9", "yy", "b", 0)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).withColumns({c: F.lit(7) for c in CLASH}).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("hot_share", [lines.HOT_SHARE, 2.0])  # all repeated keys looked up, or all streamed
def test_line_dedup(docs, corpus, hot_share):
    want = Counter(brute.line_dedup([(i, t) for i, t, *_ in corpus]))
    maps = lines.keep_bitmaps(docs, hot_share=hot_share)
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in lines.apply(docs, maps).collect())
    assert got == want
    assert lines.apply(docs, maps).where("doc_id = 1001").first().text is None
    one = maps.where("doc_id = 1006").first()
    assert len(one.bitmap) <= 5000 // 64 + 1 and sum((~w.keep & (1 << 64) - 1).bit_count() for w in one.bitmap) == one.n_dropped


def test_line_dedup_report_and_empty(docs, corpus, empty):
    digest = {(r.doc_id, r.kept_sha256) for r in lines.report(lines.dedup(docs)).collect()}
    assert digest == {(i, hashlib.sha256(t.encode()).hexdigest()) for i, _, _, t in brute.line_dedup([(i, t) for i, t, *_ in corpus])}
    assert lines.dedup(empty).count() == 0 and lines.keep_bitmaps(empty).count() == 0


def test_line_dedup_shuffles_by_range_once(docs):
    from pyspark.sql import Window
    rows = lines._lines(docs, 10, "doc_id", "text")
    placed = rows.repartitionByRange("h1", "h2").withColumn("first", F.first("doc_id").over(Window.partitionBy("h1", "h2").orderBy("doc_id")))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(h1" in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("rate,spm_rate", [(100, 50), (60, 100)])
def test_fill_in_middle(docs, corpus, rate, spm_rate):
    want = Counter((i, *brute.infill(i, t, 7, rate, spm_rate), t or "") for i, t, *_ in corpus)
    done = infill.transform(docs, rate=rate, spm_rate=spm_rate)
    got = done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", infill.restore(F.col("form"), F.col("output")).alias("back"))
    assert Counter(map(tuple, got.collect())) == want
    assert {"spm", "plain"} <= {w[2] for w in want} <= {"spm", "psm", "plain"}


def test_fill_in_middle_report_and_empty(docs, corpus, empty):
    got = {(r.doc_id, r.output_sha256, r.restored_sha256) for r in infill.report(infill.transform(docs)).collect()}
    assert got == {(i, hashlib.sha256(brute.infill(i, t)[4].encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in corpus}
    assert infill.transform(empty).count() == 0


def test_marks_rank_and_select():
    rng = random.Random(4)
    for size in (0, 1, 7, 8, 9, 64, 1000):
        data = bytes(rng.choice([0, 9, 10, 11, 0x0B ^ 0x80, 0x8A, 0xFF, 128, 191, 192]) for _ in range(size))
        for marks, is_marked in ((infill.byte_marks(10), lambda b: b == 10), (infill.continuation_marks, lambda b: 128 <= b < 192)):
            at = [i for i, b in enumerate(data) if is_marked(b)]
            m = infill.Marked(data, marks)
            assert m.rank(np.arange(size + 1)).tolist() == [sum(a < i for a in at) for i in range(size + 1)]
            assert m.select(np.arange(len(at))).tolist() == at


def test_slabs_cut_alike(corpus, monkeypatch):
    ids, texts = [i for i, *_ in corpus], [(t or "").encode() for _, t, *_ in corpus]
    whole = infill.cut(ids, texts, 7, 100, 50)
    monkeypatch.setattr(infill, "SLAB", 3000)
    assert [r for s in infill._slabs(ids, texts) for r in infill.cut(*s, 7, 100, 50)] == whole


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_is_minimal_and_verified(n):
    held = [f"w{i}é".encode() for i in range(n)]
    shard = perfect_hash.Shard.of(held)
    def find(ts): return shard.find(pa.array(ts, pa.binary()), np.array([perfect_hash.term_hash(t) for t in ts], np.uint64)).tolist()
    assert sorted(find(held)) == list(range(n)) and [t.encode() if isinstance(t, str) else t for t in shard.terms.take(pa.array(find(held), pa.int64())).to_pylist()] == held
    assert set(find([f"x{i}".encode() for i in range(2000)])) == {-1}


def test_perfect_hash_twins(monkeypatch):
    monkeypatch.setattr(perfect_hash, "term_hash", lambda t: len(t))  # equal hashes for terms of one length
    held = [b"a", b"b", b"cc", b"dd", b"ee", b"fff"]
    shard = perfect_hash.Shard.of(held)
    got = shard.find(pa.array([*held, b"x", b"zz"], pa.binary()), np.array([1, 1, 2, 2, 2, 3, 1, 2], np.uint64)).tolist()
    assert sorted(got[:6]) == list(range(6)) and got[6:] == [-1, -1]


def test_shares_are_exact():
    n, total = [0, 1, 10 ** 12, 9 * 10 ** 14, 5], [1, 3, 10 ** 12 + 7, 10 ** 15, 9 * 10 ** 15]
    assert divergence._shares(np.array(n), np.array(total)).tolist() == [1 + 10 ** 9 * (a + 1) // b for a, b in zip(n, total)]


def _audit(df, **kw):
    rows = divergence.audit(df, **kw).collect()
    got = {(r.lang, r.source, r.part, r["item"]): (r.value, r["rank"]) for r in rows}
    assert len(got) == len(rows)
    return got


def test_source_audit(docs, corpus, empty, monkeypatch):
    want = brute.divergence([(a, b, t) for _, t, a, b, _ in corpus])
    assert _audit(docs) == want
    # many shards, a round for each few of them, and many blocks
    for name, v in (("SHARD_TERMS", 300), ("CELLS", 2000)):
        monkeypatch.setattr(divergence, name, v)
    assert _audit(docs, round_bytes=9000) == want
    assert _audit(docs, min_docs=1, top=2) == brute.divergence([(a, b, t) for _, t, a, b, _ in corpus], 1, 2)
    assert divergence.audit(empty).count() == 0


def test_tasks_pass_counts_on_when_full(monkeypatch):
    rows = pa.table({"lang": ["a", "b"] * 50, "text": [f"w{'x' * (i % 7)} same" for i in range(100)]}).to_batches(max_chunksize=9)
    monkeypatch.setattr(divergence, "FLUSH_TERMS", 3)
    out = Counter()
    parts = list(divergence._document_counts(iter(rows)))
    for b in parts:
        for r in b.to_pylist():
            out[r["lang"], r["term"]] += r["n"]
    assert len(parts) > 4 and out["a", "same"] == 50 and sum(out.values()) == 200


@pytest.mark.parametrize("name", ["op11_source_divergence_audit", "op12_fill_in_middle", "op13_line_dedup"])
def test_registered_queries_equal_their_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    got = Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())
    rel = duck.execute(oracle.ORACLE[name])
    cols = [c[0] for c in rel.description]
    assert sorted(cols) == sorted(df.columns)
    assert Counter(tuple(dict(zip(cols, r))[c] for c in sorted(cols)) for r in rel.fetchall()) == got
