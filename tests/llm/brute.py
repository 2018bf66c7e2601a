"""Plain Python versions of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return SPACE.findall((text or "").translate(LOWER))


def components(ids, links):
    top = {i: i for i in ids}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i
    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def simhash(text, n=3):
    ws = words(text)
    if not ws:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(ws[i:i + n]).encode(), 42) for i in range(max(1, len(ws) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def secrets(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{k}:{a}:{e}" for a, _, e, k in sorted(out)]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(text):
    text = text or ""

    def digits(m):
        return re.sub("[^0-9]", "", m[0])
    out = [(0, m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, m.start(), m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(3, m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]
    return [f"{k}:{a}:{e}" for _, a, e, k in sorted(out)]


def good_turing(counts, k=5):
    n = [sum(c == r for c in counts) for r in range(k + 2)]
    half = [0.0] + [(r - 0.5) / r for r in range(1, k + 1)]
    if min(n[1:]) <= 0 or (a := (k + 1) * n[k + 1] / n[1]) >= 1:
        return half
    d = [0.0] + [((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) for r in range(1, k + 1)]
    return d if all(0 < x <= 1 for x in d[1:]) and any(x < 1 for x in d[1:]) else half


class Katz:
    """Katz backoff by recursion over dictionaries."""

    def __init__(self, texts, order, k=5):
        self.order, self.k = order, k
        self.c = [Counter() for _ in range(order + 1)]
        self.docs = len(texts)
        for t in texts:
            ws = ["<s>", *words(t), "</s>"]
            for i in range(1, len(ws)):
                for n in range(1, order + 1):
                    if i - n + 1 >= 0:
                        self.c[n][tuple(ws[i - n + 1:i + 1])] += 1
        self.n = sum(self.c[1].values())
        self.d = [None] + [good_turing(self.c[n].values(), k) for n in range(1, order + 1)]
        off = sum(c * (1 - self.d[1][c]) for c in self.c[1].values() if c <= k)
        self.total, self.unknown = (self.n, off / self.n) if off > 0 else (self.n + 1, 1 / (self.n + 1))
        self.plain = off <= 0
        self.after = [defaultdict(list) for _ in range(order + 1)]
        for n in range(2, order + 1):
            for g in self.c[n]:
                self.after[n][g[:-1]].append(g[-1])

    def kept(self, n, c):
        return c * (self.d[n][c] if c <= self.k else 1.0)

    def history(self, h):
        return self.docs if h == ("<s>",) else self.c[len(h)][h]

    def p(self, w, h):
        if not h:
            c = self.c[1][(w,)]
            return self.unknown if not c else (c if self.plain else self.kept(1, c)) / self.total
        n, total = len(h) + 1, self.history(h)
        if not total:
            return self.p(w, h[1:])
        seen = self.after[n][h]
        left = total - sum(self.kept(n, self.c[n][(*h, v)]) for v in seen)
        thin = left <= 1e-9 * total
        if thin:
            total, left = total + 1, 1.0
        c = self.c[n][(*h, w)]
        if c:
            return (c if thin else self.kept(n, c)) / total
        return left / total / (1 - sum(self.p(v, h[1:]) for v in seen)) * self.p(w, h[1:])

    def score(self, text):
        ws = ["<s>", *words(text), "</s>"]
        return sum(math.log10(self.p(ws[i], tuple(ws[max(0, i - self.order + 1):i]))) for i in range(1, len(ws)))


def windows(text, n):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return ws, [tuple(ws[i:i + min(n, len(ws))]) for i in range(len(ws) - min(n, len(ws)) + 1)] if ws else []


def contamination(text, items, n=10):
    ws, hit, found = windows(text, n)[0], set(), set()
    for item, t in items:
        for w in windows(t, n)[1]:
            for i in range(len(ws) - len(w) + 1):
                if tuple(ws[i:i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found.add(str(item))
    return len(ws), sorted(hit), sorted(found)


def paragraphs(docs, threshold, min_words):
    """{(doc_id, paragraph): first (doc_id, paragraph) of its component}, for those with company."""
    rows = {}
    for doc, text in docs:
        for k, line in enumerate((text or "").split("\n")):
            ws = line.encode().lower().split()
            if len(ws) >= min_words:
                rows[doc, k] = {tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))}
    keys = sorted(rows)
    links = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1:]
             if len(rows[a] & rows[b]) >= threshold * len(rows[a] | rows[b])]
    comp = components(keys, links)
    size = Counter(comp.values())
    return {k: c for k, c in comp.items() if size[c] > 1}


def divergence(docs, min_docs=3, top=200):
    """{(lang, source, part, item): (value, rank)} for rows (lang, source, text)."""
    rows = [(a or "", b or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))) for a, b, t in docs]
    out = {}
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        df = Counter(t for r in own for t in set(r[2]))
        kept = [t for t in df if df[t] >= min_docs]
        count = {s: Counter(t for r in own if r[1] == s for t in r[2] if df[t] >= min_docs) for s in {r[1] for r in own}}
        whole = sum(count.values(), Counter())

        sums = {id(c): sum(c.values()) for c in (whole, *count.values())}

        def share(c, t):
            return 1 + 10 ** 9 * (c[t] + 1) // (sums[id(c)] + len(kept))

        def rank(source, part, found, most):
            for k, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]):
                out[lang, source, part, item] = (v, k + 1)
        for s, c in count.items():
            rank(s, "pair", [(sum((share(c, t) - share(o, t)) ** 2 // share(o, t) for t in kept), i) for i, o in count.items() if i != s], None)
            rank(s, "term", [((p - q) ** 2 // q, t) for t in kept if c[t] and (p := share(c, t)) > (q := share(whole, t))], top)
    return out


def infill(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def line_dedup(docs, min_chars=10):
    """[(doc_id, lines before, lines dropped, text left)] in the order of the rows."""
    split = [(i, (t or "").split("\n")) for i, t in docs]
    owners = defaultdict(set)
    for i, lines in split:
        for x in lines:
            owners[x.strip(" \t\n\x0b\x0c\r").translate(LOWER)].add(i)

    def gone(i, x):
        k = x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
        first = min((o for o in owners[k] if o is not None), default=None)
        return len(k) >= min_chars and len(owners[k]) > 1 and i != first
    return [(i, len(ls), sum(gone(i, x) for x in ls), "\n".join(x for x in ls if not gone(i, x))) for i, ls in split]
