"""What the learned parts of the secret and personal-data scans find and leave, on planted texts."""

import random
import string

import pytest
from pyspark.sql import functions as F

from spendmatch.llm import pii, secrets
from spendmatch.llm._work import Work

WORDS = "alpha record system table order customer value index total number report engine window stream column".split()


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")


def test_random_strings_and_long_identifiers_are_told_apart(spark, given):
    rng = random.Random(1)
    model = secrets.train(secrets.samples(given))
    alphabets = [string.ascii_letters + string.digits, string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits]
    hidden = ["".join(rng.choice(alphabets[i % 3]) for _ in range(32)) for i in range(60)]
    plain = [f(rng.choices(WORDS, k=5)) for f in ("-".join, "_".join, "/".join, lambda ws: "".join(w.title() for w in ws)) for _ in range(30)]
    rows = [(i, f"deploy with {x} now") for i, x in enumerate(hidden + plain)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id for r in secrets.report(secrets.scan(df, model)).collect() if r.n_markov}
    assert found >= set(range(60)) and len(found) <= 62
    left = {r.doc_id: r.text for r in secrets.redact(df, model=model).collect()}
    assert sum(left[i] == t for i, t in rows[60:]) >= 118 and all("[SECRET]" in left[i] for i in range(60))


def test_samples_do_not_depend_on_copies_or_partitions(spark, given):
    some = given.where("doc_id < 400")
    a = secrets.train(secrets.samples(some, rows=100))
    b = secrets.train(secrets.samples(some.union(some).repartition(7), rows=100))
    assert a == b


@pytest.fixture(scope="module")
def model(spark, given):
    return pii.train(pii.proposals(given), Work(spark, "t"))


def test_planted_personal_data_in_other_forms(spark, model):
    rng = random.Random(4)

    def mail():
        at, dot = rng.choice([(" (at) ", " (dot) "), ("(at)", "(dot)"), (" [at] ", " [dot] "), ("[at]", "."), (" (at) ", ".")])
        return f"{rng.choice(['abc', 'j.smith', 'info', 'anna_b7'])}{at}{rng.choice(['def', 'mail-host', 'uni'])}{dot}{rng.choice(['org', 'com', 'net'])}"

    def number():
        a, b, c = rng.randrange(200, 999), rng.randrange(200, 999), rng.randrange(1000, 9999)
        return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}"])
    texts = [f"Please contact {mail()} about the order." for _ in range(60)]
    texts += [f"Reach the office, {rng.choice(['tel', 'phone', 'call', 'Tel:', 'fax'])} {number()} before noon." for _ in range(60)]
    texts += [f"The hotel sold {number()} units at 5 @ 3.50, version 1.2.{i}, order {rng.randrange(10 ** 8)}." for i in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id for r in pii.report(pii.scan(df, model)).collect() if r.n_added}
    hits = len(found & set(range(120)))
    assert hits >= 0.9 * 120 and hits >= 0.95 * len(found)
    clean = {r.doc_id: r.text for r in pii.redact(df, model=model).collect()}
    assert "[PII]" in clean[0] and "[PII]" in clean[60] and all(clean[i] == texts[i] for i in range(120, 200) if i not in found)


def test_held_out_fold_by_generator(spark, given, model):
    cells = pii.labelled(pii.proposals(given)).where("held")
    least = F.lit(float("inf"))
    for kind, m in model[1].items():
        least = F.when(F.col("kind") == kind, m).otherwise(least)
    rows = cells.select("kind", "y", (F.round(pii.margin(model[0], F.col("x")), 6) >= least).alias("p")).collect()
    assert {"mailbox", "digits"} <= set(model[1])
    for kind in ("mailbox", "digits"):
        own = [r for r in rows if r.kind == kind]
        hit = sum(r.p and r.y for r in own)
        assert hit >= 0.9 * sum(r.y for r in own) and hit >= 0.95 * sum(r.p for r in own)


def test_the_rewritten_span_is_where_it_says(spark):
    df = spark.createDataFrame([(1, "write jo@mail.example.com or +1 (415) 555-2671, card 4111111111111111, and 1234567890 pieces")], "doc_id long, text string")
    rows = pii.rewritten(pii.proposals(df)).collect()
    spans = [(r.text[r.start:r.end], r.y) for r in rows]
    assert len(rows) == 20 and ("jo (at) mail (dot) example (dot) com", 1) in spans and ("(415) 555-2671", 1) in spans
    assert ("4111.1111.1111.1111", 1) in spans and all(y == 0 for s, y in spans if "@" in s and s[0].isdigit())


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "plain words only"), (3, "plain words only")], "doc_id long, text string")
    assert pii.report(pii.scan(df)).where("n_added > 0 or spans <> ''").count() == 0 and pii.scan(df).count() == 4
    assert secrets.report(secrets.scan(df)).where("spans <> ''").count() == 0
