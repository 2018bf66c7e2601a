"""Personal-data detection by candidate gradient boosting, in DataFrame functions only.

Fixed patterns find the base kinds.  High-recall generators propose further,
overlapping spans; boosted trees over format and context features score them,
and a threshold calibrated on a held-out fold decides which are redacted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from . import _spans
from ._work import Work

# A match starts a run of its characters, or where the match before it ended, and repeats are possessive: the same
# matches as the plain patterns, in time and stack that do not grow with a long run.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# proposals, each with high recall; they may overlap each other and the base spans
GENERATORS = {
    "mailbox": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
               r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++",
    "digits": r"\+?[0-9][0-9\x20().-]{5,}[0-9]",
    "dotted": r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,}+",
}
CONTEXT = 24  # characters before a candidate that are looked at
# a cue is a whole word straight before the candidate, but for signs and these small words
CUES = {1: "e-?mail|mail|contact|write", 2: "tel|telephone|phone|call|fax|mobile|cell", 3: "card|visa|iban|account", 4: "ssn", 5: "host|server"}
LINK = r"(?:[^a-z0-9]|(?<![a-z0-9])(?:us|me|at|is|no|on|to|the|my|our|number)(?![a-z0-9]))*$"
# how spans are rewritten to teach forms that the base patterns miss
AT = (" (at) ", "(at)", " [at] ", " @ ", "[at]")
DOT = (" (dot) ", "(dot)", " [dot] ", ".", "[dot]")
PHONE_CUES = ("tel ", "phone: ", "call us at ", "Fax ", "Tel: ", "my phone is ")
AROUND, BEHIND = 60, 20  # characters of the text kept before and after a rewritten span
FEATURES = 11
BINS = 16


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def add(s: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return s + d - F.when(d > 9, 9).otherwise(0)
    return (n > 0) & (F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add) % 10 == 0)


def _base(text: Column) -> dict[str, Column]:
    def length(s: Column) -> Column:
        return F.length(_digits(s["value"]))
    ip = F.filter(_spans.matches(text, IP), lambda s: s["value"].rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
    card = F.filter(_spans.matches(text, CARD),
                    lambda s: F.when(length(s).between(13, 19), luhn(_digits(s["value"]))).otherwise(False))
    phone = F.filter(_spans.matches(text, PHONE), lambda s: length(s).between(9, 15))
    email = F.when(F.contains(text, F.lit("@")), _spans.matches(text, EMAIL)).otherwise(F.array().cast(_spans.SPANS))
    return {"email": email, "ip": ip, "card": card, "phone": phone}


def _features(text: Column, span: Column) -> Column:
    """Format and context features, each a small whole number below BINS."""
    v = span["value"]
    d = _digits(v)
    before = F.lower(F.substring(text, F.greatest(span["start"] - CONTEXT + 1, F.lit(1)), F.least(span["start"], F.lit(CONTEXT))))
    after = F.substring(text, span["end"] + 1, F.lit(1))
    cue = F.lit(0)
    for k, words in CUES.items():
        cue = F.when(before.rlike(f"(?<![a-z])(?:{words}){LINK}"), k).otherwise(cue)

    def capped(c: Column, top: int = BINS - 1) -> Column:
        return F.least(c, F.lit(top)).cast("int")
    return F.array(
        capped(F.length(v) / 3), capped(F.length(d)), capped(F.size(F.split(v, r"[^0-9A-Za-z]+"))),
        F.when(F.startswith(v, F.lit("+")), 1).otherwise(0),
        F.when(F.contains(v, F.lit("@")), 2).when(v.rlike("at"), 1).otherwise(0),
        F.when(v.rlike(r"[()]"), 1).otherwise(0) + F.when(v.rlike(r"[ -]"), 2).otherwise(0) + F.when(v.rlike(r"\."), 4).otherwise(0),
        F.when(F.length(d).between(13, 19), F.when(luhn(d), 2).otherwise(1)).otherwise(0),
        F.when(v.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), 2).when(v.rlike(r"^[0-9.]+$"), 1).otherwise(0), cue,
        F.when(after.rlike(r"[0-9A-Za-z]"), 1).otherwise(0) + F.when(before.rlike(r"[0-9A-Za-z]$"), 2).otherwise(0),
        F.when(v.rlike(r"[.)\]\x20][A-Za-z]{2,}$"), 1).otherwise(0))


def _candidates(text: Column) -> Column:
    """All proposals as structs (start, rank, end, kind, value)."""
    digit, none = text.rlike(r"[0-9][0-9\x20().-]{5}"), F.array().cast(_spans.SPANS)
    out = []
    for k, (kind, pattern) in enumerate(GENERATORS.items()):
        found = _spans.matches(text, pattern)
        guard = F.contains(text, F.lit("@")) | text.rlike(r"[(\[]at[)\]]") if kind == "mailbox" else digit
        out.append(_spans.tagged(F.when(guard, found).otherwise(none), len(KINDS) + k, kind))
    return F.concat(*out)


def _overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))


def proposals(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with __text, base spans by kind, and __candidates."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    held = docs.select("*", text.alias("__text"))
    t = F.col("__text")
    return held.select("*", *[c.alias(f"__{k}") for k, c in _base(t).items()], _candidates(t).alias("__candidates")).withColumn(
        "__base", F.concat(*[_spans.tagged(F.col(f"__{k}"), i, k) for i, k in enumerate(KINDS)])).drop(*[f"__{k}" for k in KINDS])


def _pick(options: tuple[str, ...], seed: Column) -> Column:
    k, out = F.pmod(seed, F.lit(len(options))), F.lit(options[0])
    for i, x in enumerate(options[1:], 1):
        out = F.when(k == i, x).otherwise(out)
    return out


def _grouped(digits: Column, seed: Column) -> Column:
    """Ten digits as people write them."""
    d = F.lpad(F.substring(digits, -10, 10), 10, "2")
    a, b, c = F.substring(d, 1, 3), F.substring(d, 4, 3), F.substring(d, 7, 4)
    k = F.pmod(seed, F.lit(4))
    return F.when(k == 0, F.concat(F.lit("("), a, F.lit(") "), b, F.lit("-"), c)).when(k == 1, F.concat_ws("-", a, b, c)).when(
        k == 2, F.concat_ws(".", a, b, c)).otherwise(F.concat_ws(" ", a, b, c))


def rewritten(found: DataFrame) -> DataFrame:
    """Evidence that does not depend on the base patterns: (text, start, end, y, held).

    Personal (y 1): base mail addresses with the signs spelled out or spaced,
    their context left as it is, and base phone and card numbers in other
    groupings behind a cue.  Other text (y 0): plain numbers that no base span
    touches, in the same groupings without a cue, or as "n @ n.nn".
    """
    spans = found.select("__text", F.explode("__base").alias("s"), F.lit(1).alias("y")).unionByName(found.select(
        "__text", F.explode(F.filter("__candidates", lambda c: (c["kind"] == "digits") & ~_overlaps(c, F.col("__base")))).alias("s"), F.lit(0).alias("y")))
    # each span in as many forms as there are ways to write a sign; the fold goes by the span's own text
    spans = spans.withColumn("form", F.explode(F.array(*[F.lit(i) for i in range(len(AT))])))
    s, y, seed = F.col("s"), F.col("y"), F.shiftright(F.xxhash64("s.value"), 4) + F.col("form")
    kind, value, digits = s["kind"], s["value"], _digits(s["value"])
    mail = F.concat(F.substring_index(value, "@", 1), _pick(AT, seed), F.replace(F.substring_index(value, "@", -1), F.lit("."), _pick(DOT, seed)))
    card = F.concat_ws(".", *[F.substring(digits, i, 4) for i in (1, 5, 9, 13)])
    price = F.concat(F.substring(digits, 1, 2), F.lit(" @ "), F.substring(digits, 3, 2), F.lit("."), F.substring(digits, 5, 2))
    new = F.when(y == 0, F.when(F.pmod(seed, F.lit(5)) == 0, price).otherwise(_grouped(digits, seed))).when(
        kind == "email", mail).when(kind == "phone", _grouped(digits, seed)).when(kind == "card", card)
    lead = F.when((y == 0) | (kind == "email"), F.lit("")).when(kind == "phone", _pick(PHONE_CUES, seed)).otherwise(F.lit("card "))
    left = F.substring(F.col("__text"), F.greatest(s["start"] - AROUND, F.lit(0)) + 1, F.least(s["start"], F.lit(AROUND)))
    rows = spans.select(F.concat(left, lead).alias("left"), new.alias("new"), F.substring(F.col("__text"), s["end"] + 1, F.lit(BEHIND)).alias("right"),
                        "y", (F.pmod(F.xxhash64(value), F.lit(4)) == 2).alias("held")).where("new is not null")
    return rows.select(F.concat("left", "new", "right").alias("text"), F.length("left").alias("start"),
                       (F.length("left") + F.length("new")).alias("end"), "y", "held")


def labelled(found: DataFrame, rows: int = 20_000) -> DataFrame:
    """Labelled candidates (kind, x, y, held): at most ``rows``, half of each label, the first by a hash.

    They are the proposals that are exactly a :func:`rewritten` span, and as
    other text also the proposals that no base span touches and no cue precedes.
    """
    made = rewritten(found).select("text", "start", "end", "y", "held", F.explode(_candidates(F.col("text"))).alias("c")).where(
        "c.start = start and c.end = end").select("text", "c", "y", "held")
    plain = found.where(F.size("__candidates") > 0).select(F.col("__text").alias("text"), F.explode(F.filter(
        "__candidates", lambda c: ~_overlaps(c, F.col("__base")))).alias("c"), F.lit(0).alias("y"))
    each = made.unionByName(plain.withColumn("held", F.pmod(F.xxhash64("c.value"), F.lit(4)) == 2))
    cells = each.select(F.col("c.kind").alias("kind"), _features(F.col("text"), F.col("c")).alias("x"), "y", "held",
                        F.xxhash64("text", "c.start", "c.kind").alias("h")).where((F.col("y") == 1) | (F.element_at("x", 9) == 0) | (F.element_at("x", 9) == 5))
    parts = [cells.where(F.col("y") == y).orderBy("h", "kind", "x", "held").limit(rows // 2) for y in (0, 1)]
    return parts[0].unionByName(parts[1]).drop("h")


def _tree_value(tree, x: Column) -> Column:
    """A tree is (feature, bin, left, right), where x[feature] <= bin goes left, or a leaf's value."""
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    f, b, left, right = tree
    return F.when(F.element_at(x, f + 1) <= b, _tree_value(left, x)).otherwise(_tree_value(right, x))


def margin(model: list, x: Column) -> Column:
    out = F.lit(0.0)
    for tree in model:
        out = out + _tree_value(tree, x)
    return out


def _best_split(cell: dict[int, tuple[list[float], list[float]]], ridge: float):
    """The split of one node with the largest gain: (feature, bin, (g, h) left, (g, h) right), or None."""
    best, found = 1e-9, None
    for f, (g, h) in sorted(cell.items()):
        gs, hs, gl, hl = sum(g), sum(h), 0.0, 0.0
        for b in range(BINS - 1):
            gl, hl = gl + g[b], hl + h[b]
            gain = gl * gl / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs * gs / (hs + ridge)
            if gain > best:
                best, found = gain, (f, b, (gl, hl), (gs - gl, hs - hl))
    return found


def boost(cells: DataFrame, rounds: int = 6, depth: int = 2, rate: float = 0.7, ridge: float = 1.0) -> list:
    """Second-order boosted trees from cells (x, y, n): equal feature vectors, counted.

    Each level of a tree is one grouped aggregation of gradients by node,
    feature and bin; at most 2^depth x FEATURES x BINS rows come back.
    """
    model: list = []
    for _ in range(rounds):
        p = 1 / (1 + F.exp(-margin(model, F.col("x"))))
        graded = cells.select("x", (F.col("n") * (F.col("y") - p)).alias("g"), (F.col("n") * p * (1 - p)).alias("h"))
        splits: dict[int, tuple] = {}  # node -> its split; the root is 1, the children of k are 2k and 2k + 1
        for level in range(depth):
            node = F.lit(1)
            for k, (f, b, _, _) in sorted(splits.items()):
                node = F.when(node == k, F.when(F.element_at("x", f + 1) <= b, 2 * k).otherwise(2 * k + 1)).otherwise(node)
            sums = graded.select(node.alias("node"), F.posexplode("x").alias("f", "bin"), "g", "h").where(
                F.col("node") >= 2 ** level).groupBy("node", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
            nodes: dict[int, dict] = {}
            for r in sums:
                g, h = nodes.setdefault(r.node, {}).setdefault(r.f, ([0.0] * BINS, [0.0] * BINS))
                g[r.bin], h[r.bin] = r.g, r.h
            splits |= {k: s for k, cell in nodes.items() if (s := _best_split(cell, ridge))}
        if 1 not in splits:
            break

        def build(k: int, leaf: tuple[float, float]):
            if k not in splits:
                return rate * leaf[0] / (leaf[1] + ridge)
            f, b, left, right = splits[k]
            return (f, b, build(2 * k, left), build(2 * k + 1, right))
        model.append(build(1, (0.0, 1.0)))
    return model


def calibrate(cells: DataFrame, model: list, precision: float = 0.98) -> dict[str, float]:
    """Per generator the lowest margin from which the held-out fold reaches ``precision``; absent where none does."""
    rows = cells.select("kind", F.round(margin(model, F.col("x")), 6).alias("m"), "y", "n").groupBy("kind", "m").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("hits")).collect()  # a margin per leaf combination at most
    out = {}
    for kind in GENERATORS:
        n = hits = 0
        for r in sorted((r for r in rows if r.kind == kind), key=lambda r: -r.m):
            n, hits = n + r.n, hits + r.hits
            if (hits + 1) / (n + 2) >= precision:  # one doubtful case of each sort on top, so few cases prove nothing
                out[kind] = r.m
    return out


def train(found: DataFrame, work: Work, rows: int = 20_000) -> tuple[list, dict[str, float]]:
    """(trees, thresholds) from the proposals of the documents."""
    cells = work.table(labelled(found, rows).groupBy("kind", "x", "y", "held").agg(F.count("*").alias("n")).coalesce(1), "cells")
    model = boost(cells.where("not held"))
    return model, calibrate(cells.where("held"), model)


def scan(docs: DataFrame, model: tuple[list, dict[str, float]] | None = None, train_rows: int = 20_000,
         train_docs: int = 8_000, text_col: str = "text") -> DataFrame:
    """``docs`` with pii_spans: structs (rank, start, end, kind, value) by kind as listed, then start.

    Base spans always stay.  A generator's candidate is added, under the
    generator's name, if its margin reaches the calibrated threshold and no
    base span touches it.  Without a ``model`` one is trained on at most
    ``train_rows`` candidates (:func:`labelled`) from the first ``train_docs``
    different texts by their hash; where those hold no personal data nothing is added.  NULL and empty texts have no spans; repeated rows are scanned
    row by row; an input column named pii_spans is replaced.
    """
    docs = docs.drop("pii_spans")
    if model is None:
        work = Work(docs.sparkSession, "pii")
        h = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
        last = docs.select(h.alias("h")).distinct().orderBy("h").limit(train_docs).agg(F.max("h")).first()[0]
        some = docs.where(h <= F.lit(last)).groupBy(h.alias("h")).agg(F.min(text_col).alias(text_col)).drop("h")
        model = train(proposals(some, text_col), work, train_rows)
        work.drop("cells")
    trees, thresholds = model
    found = proposals(docs, text_col)
    text, base = F.col("__text"), F.col("__base")

    def taken(c: Column) -> Column:
        least = F.lit(float("inf"))
        for kind, m in thresholds.items():
            least = F.when(c["kind"] == kind, m).otherwise(least)
        return F.when(~_overlaps(c, base) & (least < float("inf")),
                      F.round(margin(trees, _features(text, c)), 6) >= least).otherwise(False)
    added = F.filter("__candidates", taken) if thresholds else F.array().cast(found.schema["__candidates"].dataType)
    return found.withColumn("pii_spans", _spans.by_rank(F.concat("__base", added))).drop("__text", "__base", "__candidates")


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: counts by kind, a digest of the base spans, and all spans."""
    spans = F.col("pii_spans")
    base = F.filter(spans, lambda s: s["rank"] < len(KINDS))
    return found.select(
        F.col(id_col).alias("doc_id"),
        *[_spans.count_of(spans, k).alias(f"n_{k}") for k in KINDS],
        F.size(F.filter(spans, lambda s: s["rank"] >= len(KINDS))).cast("long").alias("n_added"),
        F.sha2(_spans.listed(base), 256).alias("base_sha256"), _spans.listed(spans).alias("spans"))


def redact(docs: DataFrame, mark: str = "[PII]", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every detected span of the text replaced by ``mark``; nulls, empty texts and repeated rows as in :func:`scan`."""
    found = scan(docs, text_col=text_col, **options)
    spans = F.array_sort(F.transform("pii_spans", lambda s: F.struct(s["start"], s["end"])))
    return found.withColumn(text_col, _spans.redact(F.col(text_col), spans, mark)).drop("pii_spans")
