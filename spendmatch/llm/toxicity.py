"""Toxicity by a weighted finite-state pattern grammar over clauses.

A learned lexicon maps words and stems to symbols; insult, threat, target,
negation and reported-speech transducers are composed into one machine that
reads a clause and names the pattern it matched.  Pattern weights are fitted to
the training labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ._work import Work

# closed-class words of the grammar; open-class words (insults, threats) are learned
TARGETS = "you your yourself u he him his she her they them their tu vous toi vos ihr euch dich usted ustedes vosotros".split()
NEGATIONS = "not never isn aren wasn don doesn nicht kein keine jamais nunca ni".split()
REPORTS = "said says called calls claimed wrote quoted quote told sagte meinte disait disent dijo dicen".split()
THREATS = "kill hurt destroy burn shoot stab beat hang bomb strangle".split()
NEGATION_REACH = 3  # words after a negation that it still covers
STEMS = range(3, 8)  # lengths of the stems learned beside whole words

OTHER, INSULT, THREAT, TARGET, NEG, REPORT, DENIED, QUOTED = range(8)
# what a clause can match; the order is that of the fitted weights
PATTERNS = ("insult", "insult_at_target", "threat", "threat_at_target", "denied", "quoted")
FEATURES = (*PATTERNS, "density")  # and the summed weight of all matches per hundred words

Machine = dict[tuple[int, int], tuple[int, int]]  # (state, symbol) -> (next state, symbol put out)


def negation() -> Machine:
    """Rewrites an insult or threat within reach of a negation to DENIED."""
    m: Machine = {}
    for s in range(NEGATION_REACH + 1):
        for c in range(8):
            m[s, c] = (max(0, s - 1), c)
        m[s, NEG] = (NEGATION_REACH, OTHER)
        if s:
            m[s, INSULT] = m[s, THREAT] = (max(0, s - 1), DENIED)
    return m


def reported() -> Machine:
    """Rewrites an insult or threat after a verb of speech in the clause to QUOTED."""
    m: Machine = {(s, c): (s, c) for s in (0, 1) for c in range(8)}
    m[0, REPORT] = m[1, REPORT] = (1, OTHER)
    m[1, INSULT] = m[1, THREAT] = m[1, DENIED] = (1, QUOTED)
    return m


def seen(symbol: int) -> Machine:
    """Remembers whether the symbol occurred."""
    return {(s, c): (int(s or c == symbol), c) for s in (0, 1) for c in range(8)}


def compose(*machines: Machine) -> tuple[list[tuple[int, ...]], list[list[int]]]:
    """The product machine: its states (one tuple of states each) and next state by state and symbol."""
    states, nxt, k = [tuple(0 for _ in machines)], [], 0
    index = {states[0]: 0}
    while k < len(states):
        row = []
        for c in range(8):
            to, sym = [], c
            for s, m in zip(states[k], machines):
                s2, sym = m[s, sym]
                to.append(s2)
            if tuple(to) not in index:
                index[tuple(to)] = len(states)
                states.append(tuple(to))
            row.append(index[tuple(to)])
        nxt.append(row)
        k += 1
    return states, nxt


STATES, NEXT = compose(negation(), reported(), seen(INSULT), seen(THREAT), seen(DENIED), seen(QUOTED), seen(TARGET))


def _matched(state: tuple[int, ...]) -> list[int]:
    _, _, insult, threat, denied, quoted, target = state
    return [k for k, on in enumerate((insult and not target, insult and target, threat and not target,
                                      threat and target, denied, quoted)) if on]


FINAL = [_matched(s) for s in STATES]
CLAUSE = re.compile(r"[.,;:!?|()\"\n]+")
WORD = re.compile(r"\w+")
_FIXED = {w: c for ws, c in ((TARGETS, TARGET), (NEGATIONS, NEG), (REPORTS, REPORT), (THREATS, THREAT)) for w in ws}


class Grammar:
    """The lexicon transducer (word -> symbol, weight) followed by the composed machine."""

    def __init__(self, lexicon: dict[str, float]):
        self.whole = {k[:-1]: v for k, v in lexicon.items() if k.endswith("$")}
        self.stems = {k: v for k, v in lexicon.items() if not k.endswith("$")}
        self.lengths = sorted({len(s) for s in self.stems})
        arcs = [re.escape(w) + r"\b" for w in [*self.whole, *THREATS]] + [re.escape(s) for s in self.stems]
        self.any = re.compile(r"\b(?:" + "|".join(arcs) + ")")

    def weight(self, word: str) -> float:
        return max([self.whole.get(word, 0.0), *(self.stems.get(word[:n], 0.0) for n in self.lengths if len(word) >= n)])

    def features(self, text: str | None) -> list[float]:
        """Per pattern, the summed weight of the clauses that match it, and the density (log scale); all zero if none does."""
        out = [0.0] * len(FEATURES)
        if not text:
            return out
        low = text.lower()
        if not self.any.search(low):
            return out
        for clause in CLAUSE.split(low):
            if not self.any.search(clause):
                continue
            state, worth = 0, 0.0
            for w in WORD.findall(clause):
                x = self.weight(w)
                state = NEXT[state][INSULT if x else _FIXED.get(w, OTHER)]
                worth += x or float(w in THREATS)
            out[-1] += worth
            for k in FINAL[state]:
                out[k] += worth
        out[-1] *= 100 / max(1, len(WORD.findall(low)))
        return [math.log1p(x) for x in out]


def _words(text: str) -> set[str]:
    return {w for w in WORD.findall(text.lower()) if len(w) > 2 and not w[0].isdigit()}


def _signature(text: str) -> int:
    """One MinHash value over 5-word shingles, so near copies mostly share it."""
    ws = text.lower().split()
    return min((xxhash.xxh64_intdigest(" ".join(ws[i:i + 5])) for i in range(max(1, len(ws) - 4))), default=0) >> 1


def learn_lexicon(sample: DataFrame, work: Work, min_g2: float = 24.0, min_lift: float = 4.0) -> dict[str, float]:
    """Words and stems far likelier in toxic texts: {term: log odds}, from rows (text, toxic).

    Documents are counted once per MinHash value, so a group of copies has one
    vote.  A term is taken when its likelihood-ratio statistic and its lift
    over the base rate pass the two bounds.  Whole words come first; stems are
    counted over the other words, so that no stem lives off one word.  Whole
    words are marked by a closing $.
    """
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([_signature(t) for t in b.column(0).to_pylist()], pa.int64())],
                                             names=["text", "toxic", "sig"])

    def terms_of(texts: DataFrame, terms) -> DataFrame:
        """Document counts by term and label; the term '' counts the documents."""
        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                by = (Counter(), Counter())
                for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    by[y].update(terms(_words(t)))
                    by[y][""] += 1
                seen = list(by[0].keys() | by[1].keys())
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string()), pa.array([by[1][t] for t in seen], pa.int64()),
                                                  pa.array([by[0][t] for t in seen], pa.int64())], names=["term", "pos", "neg"])
        return texts.mapInArrow(counted, "term string, pos long, neg long").groupBy("term").agg(
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))

    def taken(counts: DataFrame, total, least: float) -> dict[str, float]:
        base = total.pos / (total.pos + total.neg)
        p = F.col("pos") / (F.col("pos") + F.col("neg"))
        g2 = 2 * (F.col("pos") * F.log(p / base) + F.when(F.col("neg") > 0, F.col("neg") * F.log((1 - p) / (1 - base))).otherwise(0.0))
        odds = F.log(((F.col("pos") + 0.5) / (total.pos + 1)) / ((F.col("neg") + 0.5) / (total.neg + 1)))
        rows = counts.where((F.col("term") != "") & (F.col("pos") > 0) & (p >= min(least, min_lift * base)) & (g2 >= min_g2)).select(
            "term", odds.alias("w")).where("w > 0").collect()  # each has min_g2 of evidence in a bounded sample, so few
        return {r.term: r.w for r in rows}

    rows = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(signed, "text string, toxic int, sig long")
    one = work.table(rows.groupBy("sig", "toxic").agg(F.min("text").alias("text")).select("text", "toxic"), "one")
    counts = work.table(terms_of(one, lambda ws: ws), "words")
    total = counts.where("term = ''").first()
    if total is None or not total.pos or not total.neg:
        return {}
    whole = taken(counts, total, 0.9)

    def stems(ws: set[str]) -> set[str]:
        return {w[:n] for w in ws if w not in whole for n in STEMS if n < len(w)}
    return {f"{w}$": x for w, x in whole.items()} | taken(terms_of(one, stems), total, 0.5)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the intercept, which the ridge leaves alone."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, keep = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
    return w


def held_out(id_col: str = "doc_id"):
    """Rows kept from learning: crc32 of the id's text leaves 2 on division by 4; a NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, train_rows: int = 8000, cutoff: float = 0.3, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``docs`` with held_out, score (0 to 1) and predicted (score >= cutoff).

    The lexicon and the pattern weights are learned from at most ``train_rows``
    labelled documents outside the held-out fold, the first by a hash of the
    id; every document is scored over its whole text.  NULL, empty and
    pattern-free texts get the score of a document without matches.  With no
    labels, or one class only, the lexicon is empty and the score is the base
    rate (0 without any label).  Repeated labels of an id count as toxic if any
    is; labels, language and source never enter a score.  Input columns named
    held_out, score or predicted are replaced.
    """
    spark = docs.sparkSession
    work = Work(spark, "toxicity")
    docs = docs.drop("held_out", "score", "predicted")
    ids = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(
        F.col(id_col).alias("__id")).agg((F.max("toxic") > 0).cast("int").alias("toxic")).orderBy(
        F.xxhash64("__id"), "__id").limit(train_rows)
    sample = work.table(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).where("text is not null").join(
        F.broadcast(ids), "__id").select("text", "toxic"), "sample")
    lexicon = learn_lexicon(sample, work)
    grammar = spark.sparkContext.broadcast(Grammar(lexicon))
    names = [f"f{k}" for k in range(len(FEATURES))]

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([grammar.value.features(t) for t in b.column(0).to_pylist()], float).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([*(pa.array(x[:, k]) for k in range(len(names))), b.column(1)], names=[*names, "toxic"])

    cells = sample.mapInArrow(matched, ", ".join(f"{c} double" for c in names) + ", toxic int").groupBy(*names, "toxic").count().collect()
    data = np.array([[*r[:-1], r["count"]] for r in cells], float).reshape(-1, len(names) + 2)
    y, n = data[:, -2], data[:, -1].astype(int)
    if 0 < (y * n).sum() < n.sum():
        weights = fit(np.repeat(data[:, :-2], n, axis=0), np.repeat(y, n))
    else:
        weights = np.array([0.0] * len(names) + [30.0 if len(y) and y[0] else -30.0])
    work.drop("sample", "one", "words")
    at, out_names = docs.columns.index(text_col), [*docs.columns, "score"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([grammar.value.features(t) for t in b.column(at).to_pylist()], float).reshape(-1, len(names))
            p = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p)], names=out_names)

    out = docs.mapInArrow(scored, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))
    return out.withColumn("held_out", held_out(id_col)).withColumn("predicted", (F.col("score") >= cutoff).cast("int"))
