"""The one reading of the texts behind ``paragraphs.repeats``, place by place against plain Python."""

import random
from collections import defaultdict

import numpy as np

from spendmatch.llm import paragraphs

from . import brute

PIECES = ["a", "B", "é", "ab ", " ", "\n", "\n\n", " c", "d e f g h i ", "\t", "\x1c", " x "]


def plain_blocks(text, n):
    """{number of the first line: words} of long lines and of blocks of shorter ones."""
    out, open_, held = {}, None, []
    for k, line in enumerate([*text.split("\n"), ""]):
        ws = line.encode().lower().split()
        if 0 < len(ws) < n:
            open_, held = (k if not held else open_), held + ws
            continue
        if len(held) >= n:
            out[open_] = held
        held = []
        if len(ws) >= n:
            out[k] = ws
    return out


def plain_anchors(ws, n, window=paragraphs.ANCHORS):
    m = len(ws) - n + 1
    if m < 1:
        return []
    h = paragraphs.windows(paragraphs.word_hashes(ws), min(paragraphs.SHINGLE, n))[:m].tolist()
    window = min(window, m)
    return sorted({min(range(i, i + window), key=lambda j: (h[j], j)) for i in range(m - window + 1)})


def test_split_anchors_and_minima():
    rng = random.Random(3)
    hasher = paragraphs.MinHash(14, 4)
    for _ in range(600):
        text = "".join(rng.choices(PIECES, k=rng.randint(0, 160)))
        n, wrapped = rng.choice([2, 5, 8, 20]), rng.random() < 0.5
        words, parts = paragraphs.split(text, n, wrapped)
        assert words == text.encode().lower().split()
        for _, at, length, a, b in parts:
            assert text[at:at + length].encode().lower().split() == words[a:b] and b - a >= n
        if wrapped:
            assert {k: words[a:b] for k, _, _, a, b in parts} == plain_blocks(text, n)
        h = paragraphs.word_hashes(words)
        rolled = paragraphs.windows(h, paragraphs.SHINGLE)
        k, at, length = paragraphs.anchored(text, n, h, rolled)
        assert k.tolist() == plain_anchors(words, n)
        for a, s, w in zip(k.tolist(), at.tolist(), length.tolist()):
            assert text[s:s + w].encode().lower().split() == words[a:a + n]
        if parts:
            want = [[int(np.min(paragraphs.shingles(h[a:b]) * m + c)) for m, c in zip(hasher.a, hasher.b)] for *_, a, b in parts]
            for block in (3, 4096):  # a paragraph may reach over blocks
                assert hasher.minima(h, rolled, [p[3:] for p in parts], block).tolist() == want


def test_repeats_against_plain_python(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(700)]
    base = [rng.choices(vocabulary, k=60) for _ in range(5)]
    texts = ["", None, "a b", base[0][0]]
    for k in range(40):
        ws = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            ws[rng.randrange(60)] = rng.choice(vocabulary)
        step = rng.choice([7, 12, 60])
        texts.append("own head\n\n" + "\n".join(" ".join(ws[i:i + step]) for i in range(0, 60, step)) + "\n\n" + " ".join(rng.choices(vocabulary, k=30)))
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(3, texts[3], "x")]  # a repeated row, a clashing column
    found = paragraphs.repeats(spark.createDataFrame(rows, "doc_id long, text string, start string")).collect()

    shingled, passages = {}, defaultdict(list)
    for k, t in enumerate(texts):
        for number, ws in plain_blocks(t or "", 20).items():
            shingled[k, number] = {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)}
        ws = (t or "").encode().lower().split()
        for a in plain_anchors(ws, 20):
            passages[tuple(ws[a:a + 20])].append((k, a))
    keys = sorted(shingled)
    links = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1:]
             if len(shingled[a] & shingled[b]) >= 0.8 * len(shingled[a] | shingled[b])]
    first = brute.components(keys, links)
    size = defaultdict(int)
    for c in first.values():
        size[c] += 1
    want = {("paragraph", *k, *c, size[c], k == c) for k, c in first.items() if size[c] > 1}
    want |= {("passage", *k, *min(at), len(at), k == min(at)) for at in passages.values() if len(at) > 1 for k in at}
    got = [(r.kind, r.doc_id, r.paragraph, r.component_id, r.component_paragraph, r.component_size, r.kept) for r in found]
    assert len(got) == len(set(got)) and set(got) == want


def test_passage_keys_by_words_alone():
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 1 << 63, 60, dtype=np.uint64) for _ in range(3)]
    texts[2][10:40] = texts[0][20:50]
    at = [np.arange(41) for _ in texts]
    alone = [paragraphs.passage_keys(h, a, 20).to_pylist() for h, a in zip(texts, at)]
    whole = paragraphs.passage_keys(np.concatenate(texts), np.concatenate([a + 60 * i for i, a in enumerate(at)]), 20).to_pylist()
    assert whole == sum(alone, []) and all(len(k) == 16 for k in whole)
    assert alone[2][10:21] == alone[0][20:31] and len(set(whole)) == 3 * 41 - 11
    turned = paragraphs.passage_keys(texts[0][::-1].copy(), np.array([40]), 20).to_pylist()
    assert turned[0] != alone[0][0]                                   # the order of the words counts
