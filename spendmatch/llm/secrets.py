"""Secret scans with character Markov models, in DataFrame functions only.

Fixed patterns find the secrets of known form.  Long runs of identifier
characters are scored by two character bigram models, one of random strings and
one of ordinary identifiers, and taken by their log-likelihood ratio.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from . import _spans

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"  # a whole run, so the same matches as [0-9a-f]+ of 24 characters or more
KINDS = ("assign", "access", "hex", "markov")
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
ALPHABET = 66  # characters of a run
JOINTS = ("-", "_", "/")  # between the words of long identifiers; the fourth way is a capital
PRIOR = 5  # pairs' worth of smoothing
DISTINCT = 8  # a random string has that many different characters; a ruled line does not


def _base(text: Column) -> dict[str, Column]:
    assign = F.filter(_spans.matches(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 6)
    access = F.filter(_spans.matches(text, ACCESS), lambda s: F.length(s["value"]) >= 20)
    return {"assign": assign, "access": access, "hex": _spans.matches(text, HEX)}


def samples(docs: DataFrame, rows: int = 4000, min_length: int = 20, text_col: str = "text") -> DataFrame:
    """Labelled strings (value, secret) from at most ``rows`` different texts, the first by their hash.

    Secret: the values that the fixed patterns find.  Ordinary: the other words
    of identifier characters, six or more long but too short for a candidate,
    so that no candidate teaches the ordinary model its own pairs; and the
    joints of long identifiers, made of neighbouring words: the end of one and
    the start of the next as hyphens, underscores, slashes and capitals join them.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    h = F.xxhash64(text)
    last = docs.select(h.alias("h")).distinct().orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    some = docs.where(h <= F.lit(last)).groupBy(h.alias("h")).agg(F.min(text).alias("text"))
    base = some.select("text", F.concat(
        F.transform(_base(F.col("text"))["assign"], lambda s: F.regexp_extract(s["value"], ASSIGN, 2)),
        F.transform(_base(F.col("text"))["access"], lambda s: s["value"]),
        F.transform(_base(F.col("text"))["hex"], lambda s: s["value"])).alias("found"),
        F.regexp_extract_all("text", F.lit(r"[A-Za-z]{2,}"), F.lit(0)).alias("plain"))
    words = F.filter(F.array_except(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9+/_=-]{6,}"), F.lit(0)), F.col("found")),
                     lambda w: F.length(w) < min_length)
    joints = base.select(F.explode(F.arrays_zip(F.col("plain").alias("a"), F.slice("plain", 2, F.size("plain")).alias("b"))).alias("p")).where(
        "p.b is not null").select(F.lower(F.right("p.a", F.lit(1))).alias("end"), F.lower(F.left("p.b", F.lit(2))).alias("start"),
                                  F.pmod(F.xxhash64("p.a", "p.b"), F.lit(len(JOINTS) + 1)).alias("style"))
    style = F.col("style")
    joined = F.concat("end", F.initcap("start"))
    for k, sign in enumerate(JOINTS):
        joined = F.when(style == k, F.concat(F.col("end"), F.lit(sign), F.col("start"))).otherwise(joined)
    return base.select(F.explode(F.array_distinct("found")).alias("value"), F.lit(True).alias("secret")).unionAll(
        base.select(F.explode(words).alias("value"), F.lit(False).alias("secret"))).unionAll(
        joints.select(joined.alias("value"), F.lit(False).alias("secret")))


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratio of every ASCII character pair (index 128 a + b), random over ordinary.

    Pair frequencies are smoothed towards each model's character frequencies.
    The random model is mixed half and half with uniform characters, so it
    covers alphabets that the samples lack; without samples it is uniform.
    """
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: F.struct(
        F.ascii(F.substring(F.col("value"), i, F.lit(1))).alias("a"), F.ascii(F.substring(F.col("value"), i + 1, F.lit(1))).alias("b"))))
    rows = labelled.where(F.length("value") > 1).select("secret", pair.alias("p")).groupBy(
        "secret", "p.a", "p.b").count().collect()  # at most one row per label and character pair
    pairs, after, single, size = {}, {}, {}, {True: 0, False: 0}
    for r in rows:
        pairs[r.secret, r.a, r.b] = r["count"]
        after[r.secret, r.a] = after.get((r.secret, r.a), 0) + r["count"]
        single[r.secret, r.b] = single.get((r.secret, r.b), 0) + r["count"]
        size[r.secret] += r["count"]

    def p(label: bool, a: int, b: int) -> float:
        one = (single.get((label, b), 0) + 0.5) / (size[label] + 0.5 * ALPHABET)
        return (pairs.get((label, a, b), 0) + PRIOR * one) / (after.get((label, a), 0) + PRIOR)
    return [math.log((0.5 * p(True, a, b) + 0.5 / ALPHABET) / p(False, a, b)) for a in range(128) for b in range(128)]


def llr(value: Column, model: list[float]) -> Column:
    """Summed log-likelihood ratio of an ASCII string's character pairs."""
    table = F.array(*[F.lit(round(x, 4)) for x in model])
    return F.aggregate(F.sequence(F.lit(1), F.length(value) - 1), F.lit(0.0), lambda s, i: s + F.element_at(
        table, F.ascii(F.substring(value, i, F.lit(1))) * 128 + F.ascii(F.substring(value, i + 1, F.lit(1))) + 1))


def scan(docs: DataFrame, model: list[float] | None = None, min_length: int = 20, min_total: float = 12.0,
         min_mean: float = 2.0, train_rows: int = 4000, text_col: str = "text") -> DataFrame:
    """``docs`` with secret_spans: structs (start, rank, end, kind, value) by start, then kind as listed.

    ``markov`` spans are runs of ``min_length`` identifier characters, eight
    different ones among them, whose log-likelihood ratio reaches ``min_total``, and ``min_mean`` a character,
    and that no fixed pattern's span touches.  Without a ``model`` one is
    trained on :func:`samples` of the documents (``train_rows`` bounds them).
    NULL and empty texts have no spans; repeated rows are scanned row by row;
    an input column named secret_spans is replaced.
    """
    if model is None:
        model = train(samples(docs, train_rows, min_length, text_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = {k: F.col(f"__{k}") for k in KINDS}
    columns = _base(text) | {"markov": _spans.matches(text, RUN % min_length)}
    out = docs.drop("secret_spans").select("*", *[c.alias(f"__{k}") for k, c in columns.items()])
    fixed = F.concat(*[_spans.tagged(found[k], i, k) for i, k in enumerate(KINDS[:3])])
    clear = F.filter(found["markov"], lambda c: (F.size(F.array_distinct(F.split(c["value"], ""))) >= DISTINCT) & ~F.exists(fixed, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))

    def taken(c: Column) -> Column:
        ratio = llr(c["value"], model)
        return (ratio >= min_total) & (ratio >= min_mean * F.length(c["value"]))
    random = F.when(F.size(clear) > 0, F.filter(clear, taken)).otherwise(F.array().cast(_spans.SPANS))
    spans = F.array_sort(F.concat(fixed, _spans.tagged(random, 3, "markov")))
    return out.withColumn("secret_spans", spans).drop(*[f"__{k}" for k in KINDS])


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: counts by kind, a digest of the fixed patterns' spans, and all spans."""
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: s["rank"] < 3)
    return found.select(
        F.col(id_col).alias("doc_id"),
        *[_spans.count_of(spans, k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_spans.listed(base), 256).alias("base_sha256"), _spans.listed(spans).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every secret span of the text replaced by ``mark``; nulls, empty texts and repeated rows as in :func:`scan`."""
    found = scan(docs, text_col=text_col, **options)
    return found.withColumn(text_col, _spans.redact(F.col(text_col), F.col("secret_spans"), mark)).drop("secret_spans")
