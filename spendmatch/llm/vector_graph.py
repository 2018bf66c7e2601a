"""Embedding near-duplicates through a robust-pruned flat graph.

Vectors are dealt to overlapping cluster shards.  Each shard builds a graph by
robust pruning; a vector's lists from all its shards are joined; a greedy search
from the shard's medoid runs for every vector and keeps expanding while it finds
vectors in range.  Every link is verified in double precision, and recall is
audited against brute force.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ._components import connected_components
from ._work import Work

ROUTE = "label long, cluster long, id long, v array<double>"
HELD = 1 << 20  # numbers that one step of a Python task holds at once (8 MB), whatever the shard, its groups or the length of vectors


def _blocks(rows: int, width: int) -> Iterator[slice]:
    """Slices over ``rows`` rows of ``width`` numbers, about HELD numbers each."""
    step = max(1, HELD // max(1, width))
    return (slice(i, min(i + step, rows)) for i in range(0, rows, step))


def _kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means; empty clusters keep their centre."""
    c = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = np.concatenate([np.argmax(x[s] @ c.T, axis=1) for s in _blocks(len(x), k)])
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 0, sums / np.where(size > 0, size, 1), c)
    return c


def _nearest(x: np.ndarray, c: np.ndarray, many: int) -> np.ndarray:
    """The ``many`` nearest centres of every row, the nearest first."""
    return np.concatenate([np.argsort(-(x[s] @ c.T), axis=1, kind="stable")[:, :many].copy() for s in _blocks(len(x), len(c))])


def robust_prune(x: np.ndarray, degree: int = 24, alpha: float = 1.2, width: int = 48) -> list[np.ndarray]:
    """Neighbour lists of a shard: nearest first, dropping what a chosen neighbour covers ``alpha`` times better.

    Lists also take the reverse edges, the nearest first, up to ``width``, and
    beyond it the edges of a minimum spanning tree, both ways: full lists would
    else cut vectors of a dense group off from the others in range.
    """
    n = len(x)
    if n == 1:
        return [np.empty(0, np.int64)]
    d = np.empty((n, n), np.float32)
    for s in _blocks(n, n):
        d[s] = np.clip(1 - (x[s] @ x.T).astype(np.float32), 0, None)
    alive = d.copy()
    np.fill_diagonal(alive, np.inf)
    out = np.full((n, min(degree, n - 1)), -1)
    rows = np.arange(n)
    for r in range(out.shape[1]):
        pick = np.argmin(alive, axis=1)
        some = np.isfinite(alive[rows, pick])
        if not some.any():
            break
        out[some, r] = pick[some]
        alive[rows, pick] = np.inf
        for s in _blocks(n, n):
            alive[s][alpha * d[pick[s]] <= d[s]] = np.inf
    fro, rank = np.nonzero(out >= 0)
    to = out[fro, rank]
    near = [list(a[a >= 0]) for a in out]
    for k in np.argsort(d[fro, to], kind="stable"):  # reverse edges, nearest first
        if len(near[to[k]]) < width and fro[k] not in near[to[k]]:
            near[to[k]].append(fro[k])
    for a, b in _spanning_tree(d):
        for u, v in ((a, b), (b, a)):
            if v not in near[u]:
                near[u].append(v)
    return [np.array(a, np.int64) for a in near]


def _spanning_tree(d: np.ndarray) -> list[tuple[int, int]]:
    """The edges of a minimum spanning tree over a matrix of distances."""
    n = len(d)
    best, via, out = d[0].copy(), np.zeros(n, np.int64), []
    inside = np.zeros(n, bool)
    k = 0
    for _ in range(n - 1):
        inside[k], best[k] = True, np.inf
        closer = (d[k] < best) & ~inside
        best[closer], via[closer] = d[k][closer], k
        k = int(np.argmin(best))
        out.append((int(via[k]), k))
    return out


def range_search(x: np.ndarray, near: list[np.ndarray], queries: np.ndarray, start: int, radius: float,
                 effort: int, chunk: int = HELD // 4, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs found at ``radius`` similarity or more.

    The search starts at node ``start``, and at the query's ``own`` node where it has one (-1: none).
    Best first, ``effort`` nodes a query are expanded; from there the range
    grows breadth first, every node in range being expanded, so a large group is
    walked to its end.  About ``chunk`` edges are followed at once, and vectors
    are compared in blocks, so memory grows with queries x nodes alone, not with
    the pairs in range.
    """
    n, q = len(x), len(queries)
    count = np.array([len(a) for a in near], np.int64)
    first, flat = np.cumsum(count) - count, np.concatenate([*near, np.empty(0, np.int64)])
    score = np.full((q, n), -np.inf)  # of the nodes met
    open_ = np.full((q, n), -np.inf)  # of those not expanded yet
    met, waiting = score.reshape(-1), open_.reshape(-1)
    score[:, start] = open_[:, start] = queries @ x[start]
    if own is not None:
        here = np.flatnonzero(own >= 0)
        score[here, own[here]] = open_[here, own[here]] = 1.0

    def follow(who: np.ndarray, node: np.ndarray) -> None:
        many = count[node]
        edge = np.arange(many.sum()) + np.repeat(first[node] - np.cumsum(many) + many, many)
        at = np.repeat(who * n, many) + flat[edge]
        at = np.unique(at[np.isneginf(met[at])])
        for s in _blocks(len(at), x.shape[1]):
            a, b = np.divmod(at[s], n)
            met[at[s]] = waiting[at[s]] = np.einsum("ij,ij->i", queries[a], x[b])

    def expand(who: np.ndarray, node: np.ndarray) -> None:
        open_[who, node] = -np.inf
        part = np.cumsum(count[node]) // chunk
        cuts = np.flatnonzero(np.diff(part)) + 1
        for i, j in zip([0, *cuts], [*cuts, len(node)]):
            follow(who[i:j], node[i:j])

    live = np.arange(q)
    for _ in range(effort):
        best = np.argmax(open_ if len(live) == q else open_[live], axis=1)
        go = np.isfinite(open_[live, best])
        live, best = live[go], best[go]
        if not len(live):
            break
        expand(live, best)
    while True:
        who, node = np.nonzero(open_ >= radius)
        if not len(who):
            return np.nonzero(score >= radius)
        expand(who, node)


def _unit(v: pd.Series) -> np.ndarray:
    x = np.array(v.tolist(), float)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """Distinct vectors that can link: (label, v, id, n); id is the smallest of the equal ones, n their number."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vec_col).cast("array<double>").alias("v"))
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.where(F.coalesce(good, F.lit(False))).groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("n"))


def _route(held: DataFrame, per_shard: int, overlap: int, fit_rows: int, max_clusters: int) -> DataFrame:
    """Every vector at its ``overlap`` nearest centres of its label (and length).

    Centres are fitted on at most ``fit_rows`` vectors, the first by a hash of
    the id, and number at most ``max_clusters``.
    """
    sizes = {(r.label, r.d): r.c for r in held.groupBy("label", F.size("v").alias("d")).agg(F.count("*").alias("c")).orderBy(
        F.desc("c"), "label", "d").limit(max_clusters).collect()}  # labels beyond get one shard each, split by size
    sample = held.select("label", "v").orderBy(F.xxhash64("id")).limit(fit_rows).toPandas()
    centres = {}
    for (label, d), rows in sample.groupby([sample.label, sample.v.map(len)]):
        k = min(-(-sizes.get((label, d), 0) // per_shard), len(rows), max(1, max_clusters * len(rows) // len(sample)))
        if k > 1:
            centres[label, d] = _kmeans(_unit(rows.v), k)
    held_centres = held.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        for b in batches:
            for (label, d), rows in b.groupby([b.label, b.v.map(len)]):
                c = held_centres.value.get((label, d))
                if c is None:
                    yield rows.assign(cluster=-int(d))[["label", "cluster", "id", "v"]]
                    continue
                near = _nearest(_unit(rows.v), c, overlap)
                for k in range(near.shape[1]):
                    yield rows.assign(cluster=near[:, k] + int(d) * max_clusters)[["label", "cluster", "id", "v"]]
    return held.select("label", "id", "v").mapInPandas(run, ROUTE)


def _core(x: np.ndarray, threshold: float) -> np.ndarray | None:
    """The vector of a sample with most others in range, if these are half of the sample or more."""
    near = np.concatenate([(x[s] @ x.T >= threshold).sum(axis=1) for s in _blocks(len(x), len(x))])
    return x[np.argmax(near)] if 2 * near.max() >= len(x) else None


def _sub(level: int, name: int, k: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{level} {name} {k}") - (1 << 63)


def _split(routes: DataFrame, work: Work, threshold: float, per_shard: int, max_shard: int, overlap: int, tag: str, levels: int = 3,
           fit_rows: int = 2000, bucket_rows: int = 5000) -> DataFrame:
    """``routes`` with every cluster over ``max_shard`` vectors divided again, by k-means on about ``fit_rows`` of its own.

    Its vectors go to their ``overlap`` nearest centres in tasks of about
    ``bucket_rows``.  Where half are near copies of one vector, the copies would
    have the same few centres nearest and be stored ``overlap`` times at every
    level: all within twice the range of that vector become one cluster, not
    divided again, and all beyond the range another, so both vectors of a link
    lie in one of the two.  What is still too large after ``levels`` rounds stays.
    """
    key, whole = ["label", "cluster"], None
    twice = 2 * threshold ** 2 - 1 if threshold > 0 else -1.0  # the cosine at twice the range
    for level in range(levels):
        sizes = routes.groupBy(*key).agg(F.count("*").alias("m")).where(F.col("m") > max_shard)
        large = work.table(sizes.join(whole, key, "left_anti") if whole else sizes, f"large{tag}_{level}")
        if large.isEmpty():
            break
        rows = routes.join(large, key)
        sample = rows.where(F.pmod(F.xxhash64("id", F.lit(17 + level)), F.ceil(F.col("m") / fit_rows)) == 0)

        def fit(g: pd.DataFrame) -> pd.DataFrame:
            x = _unit(g.v)
            core = _core(x, threshold)
            k = min(max(-(-int(g.m.iloc[0]) // per_shard), 2 * overlap), max(1, len(x) // 8))
            return g.iloc[:1][key].assign(dense=core is not None, centres=[(_kmeans(x, k) if core is None else core).ravel().tolist()])
        centres = work.table(sample.groupBy(*key).applyInPandas(
            fit, "label long, cluster long, dense boolean, centres array<double>"), f"centres{tag}_{level}")
        buckets = F.ceil(F.col("m") / bucket_rows).cast("int")
        dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("id", F.lit(3)), buckets).cast("int")).drop("m")
        sent = centres.join(large, key).withColumn("bucket", F.explode(F.sequence(F.lit(0), buckets - 1))).drop("m")

        def route(g: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
            g = g[["label", "cluster", "id", "v"]].assign(whole=False)  # a sample may be empty
            if not len(g) or not len(c):
                return g
            x, name = _unit(g.v), int(g.cluster.iloc[0])
            centres = np.array(c.centres.iloc[0]).reshape(-1, x.shape[1])
            if c.dense.iloc[0]:
                at = x @ centres[0]
                return pd.concat([g[at >= twice - 1e-9].assign(cluster=_sub(level, name, 0), whole=True),
                                  g[at <= threshold + 1e-9].assign(cluster=_sub(level, name, 1))])
            near = _nearest(x, centres, overlap)
            subs = np.array([_sub(level, name, k) for k in range(int(near.max()) + 1)], np.int64)
            return pd.concat([g.assign(cluster=subs[near[:, k]]) for k in range(near.shape[1])])
        parted = work.table(dealt.groupBy(*key, "bucket").cogroup(sent.groupBy(*key, "bucket")).applyInPandas(
            route, f"{ROUTE}, whole boolean"), f"parted{tag}_{level}")
        cores = parted.where("whole").select(*key).distinct()
        whole = work.table(whole.union(cores) if whole else cores, f"whole{tag}_{level}")
        routes = work.table(routes.join(large, key, "left_anti").select(*routes.columns).union(
            parted.select(*routes.columns)), f"split{tag}_{level}")
        work.drop(f"parted{tag}_{level}")
        if level:
            work.drop(f"split{tag}_{level - 1}")
    return routes


def _groups(rows: DataFrame, graph: DataFrame, own: Column) -> DataFrame:
    """Rows by (label, cluster, part, asked): the members of one part, and the vectors of part ``asked``, which ask."""
    each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    columns = ["label", "cluster", "part", "asked", "id", "v", "near", "member", "asks"]
    members = rows.join(graph, "id").withColumn("part", own).withColumn("asked", each).withColumn("member", F.lit(True)).withColumn(
        "asks", F.col("part") == F.col("asked"))
    others = rows.withColumn("asked", own).withColumn("part", each).where("part <> asked").withColumn(
        "near", F.array().cast("array<long>")).withColumn("member", F.lit(False)).withColumn("asks", F.lit(True))
    return members.select(*columns).union(others.select(*columns))


def links(held: DataFrame, work: Work, threshold: float, per_shard: int = 500, max_shard: int = 1800, overlap: int = 3,
          effort: int = 32, fit_rows: int = 20_000, max_clusters: int = 4096, tag: str = "") -> DataFrame:
    """Verified pairs (a < b) of distinct vectors of one label.

    Within a shard the joined lists are walked; edges that leave it are followed
    in rounds from the vectors found in range (``_leaving``).  Two vectors that
    share no cluster and no chain of links are not found.
    A cluster over ``max_shard`` vectors is divided again by k-means; one that
    stays larger is dealt by hash to parts, and a task searches one part with
    the vectors of one part, so its memory stays bounded.
    """
    routes = work.table(_route(held, per_shard, overlap, fit_rows, max_clusters), f"routes{tag}")
    routes = _split(routes, work, threshold, per_shard, max_shard, overlap, tag)
    parts = routes.groupBy("label", "cluster").agg(F.ceil(F.count("*") / max_shard).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    rows = routes.join(parts, ["label", "cluster"])
    key = ["label", "cluster", "part"]

    def build(g: pd.DataFrame) -> pd.DataFrame:
        near = robust_prune(_unit(g.v))
        ids = g.id.to_numpy()
        return pd.DataFrame({"id": ids, "near": [ids[a] for a in near]})

    graph = rows.withColumn("part", own).groupBy(*key).applyInPandas(build, "id long, near array<long>")
    graph = work.table(graph.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), f"graph{tag}")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g = pd.concat(batches)
        raw, ids = np.array(g.v.tolist(), float), g.id.to_numpy()
        length = np.linalg.norm(raw, axis=1)
        x, place = raw / length[:, None], np.flatnonzero(g.member.to_numpy())
        if not len(place):
            return
        base = x[place]
        at = {i: k for k, i in enumerate(ids[place].tolist())}
        near = [np.array([at[j] for j in a if j in at], np.int64) for a in g.near.iloc[place]]
        medoid = int(np.argmax(base @ base.mean(axis=0)))
        own = np.full(len(x), -1)
        own[place] = np.arange(len(place))
        asked = np.flatnonzero(g.asks.to_numpy())
        found = np.zeros((len(asked), len(place)), bool)
        for i in range(0, len(asked), 512):
            some = asked[i:i + 512]
            who, node = range_search(base, near, x[some], medoid, threshold - 1e-9, effort, own=own[some])
            for s in _blocks(len(who), raw.shape[1]):
                a, b = some[who[s]], place[node[s]]
                real = (ids[a] != ids[b]) & (np.einsum("ij,ij->i", raw[a], raw[b]) / (length[a] * length[b]) >= threshold)
                found[i + who[s][real], node[s][real]] = True
        if np.array_equal(asked, place):  # each pair once, whichever of the two found it
            found = np.triu(found | found.T)
        for s in _blocks(*found.shape):
            a, b = np.nonzero(found[s])
            for c in _blocks(len(a), 8):
                ab = np.sort(np.stack((ids[asked[s.start + a[c]]], ids[place[b[c]]]), axis=1), axis=1)
                yield pd.DataFrame({"a": ab[:, 0], "b": ab[:, 1]})

    pairs = _groups(rows, graph, own).groupBy(*key, "asked").applyInPandas(search, "a long, b long").distinct()
    return _leaving(work.table(pairs, f"links{tag}"), routes, graph, held, work, threshold, tag)


def _leaving(pairs: DataFrame, routes: DataFrame, graph: DataFrame, held: DataFrame, work: Work, threshold: float, tag: str) -> DataFrame:
    """``pairs`` with those that edges leaving a shard lead to.

    A round follows, for each new pair (query, node), the node's edges to vectors
    that share no cluster with the query, and keeps those in range, until no new
    pair appears.  The first round leaves out edges to vectors of all the node's
    clusters: its queries share one of these with the node, and so with them.
    """
    homes = work.table(routes.groupBy("id").agg(F.collect_set("cluster").alias("at")), f"homes{tag}")
    far = homes.select(F.col("id").alias("c"), F.col("at").alias("c_at"))
    edges = graph.select(F.col("id").alias("node"), F.explode("near").alias("c")).join(far, "c")

    def listed(some: DataFrame, name: str) -> DataFrame:
        return work.table(some.groupBy("node").agg(F.collect_list(F.struct("c", "c_at")).alias("out")), f"{name}{tag}")
    out = listed(edges.join(homes.withColumnRenamed("id", "node"), "node").where(F.size(F.array_except("at", "c_at")) > 0), "out")
    side = held.select("id", "label", "v")
    new, seen, k = pairs, pairs, 0
    while True:
        ends = new.select(F.col("a").alias("id"), F.col("b").alias("node")).union(new.select("b", "a"))
        met = ends.join(homes, "id").join(out, "node").select("id", F.explode(F.filter(
            "out", lambda o: ~F.arrays_overlap(o["c_at"], F.col("at"))).getField("c")).alias("c")).select(
            F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")).where("a < b").distinct().join(seen, ["a", "b"], "left_anti")
        both = met.join(side.select(F.col("id").alias("a"), F.col("label").alias("la"), F.col("v").alias("x")), "a").join(
            side.select(F.col("id").alias("b"), F.col("label").alias("lb"), F.col("v").alias("y")), "b").where(
            (F.col("la") == F.col("lb")) & (F.size("x") == F.size("y")))

        def dot(x: str, y: str):
            return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
        near = both.where(dot("x", "y") / (F.sqrt(dot("x", "x")) * F.sqrt(dot("y", "y"))) >= threshold)
        new = work.table(near.select("a", "b").distinct(), f"beyond{tag}_{k}")
        if new.isEmpty():
            return seen
        if not k:
            out = listed(edges, "out_all")
        seen, k = seen.union(new), k + 1


def audit(held: DataFrame, found: DataFrame, threshold: float, work: Work, share: int = 100, block: int = 5000, tag: str = "") -> float:
    """Recall of ``found`` by brute force: the smaller of that per link and the mean of that per vector.

    The queries are the vectors whose id divides by ``share`` and the first 64 by
    a hash of the id, ``block`` broadcast at a time; ten times as many if those
    have no link at all.
    """
    first = held.orderBy(F.xxhash64("id", F.lit(1))).limit(64).select("id").distinct().withColumn("first", F.lit(True))
    for k, part in enumerate((share, max(1, share // 10))):
        asked = work.table(held.join(F.broadcast(first), "id", "left").where(
            (F.pmod("id", F.lit(part)) == 0) | F.col("first")).select("label", "id", "v"), f"asked{tag}_{k}")
        blocks, true = -(-asked.count() // block), None
        for i in range(blocks):
            q = asked.where(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(blocks)) == i).toPandas()
            own = {key: (g.id.to_numpy(), _unit(g.v)) for key, g in q.groupby([q.label, q.v.map(len)])}
            queries = held.sparkSession.sparkContext.broadcast(own)

            def run(batches, queries=queries):
                for b in batches:
                    for key, rows in b.groupby([b.label, b.v.map(len)]):
                        if key in queries.value:
                            ids, x = queries.value[key]
                            for s in _blocks(len(rows), len(ids)):
                                at, to = np.nonzero(x @ _unit(rows.v.iloc[s]).T >= threshold)
                                some = pd.DataFrame({"q": ids[at], "o": rows.id.to_numpy()[s][to]})
                                yield some[some.q != some.o]
            one = held.select("label", "id", "v").mapInPandas(run, "q long, o long")
            true = one if true is None else true.union(one)
        if true is None:
            return 1.0
        hit = found.withColumn("hit", F.lit(1))
        per = true.distinct().select("q", F.least("q", "o").alias("a"), F.greatest("q", "o").alias("b")).join(hit, ["a", "b"], "left").groupBy(
            "q").agg(F.count("*").alias("n"), F.count("hit").alias("hits"))
        n, hits, mean = per.agg(F.sum("n"), F.sum("hits"), F.avg(F.col("hits") / F.col("n"))).first()
        if n:
            return min(hits / n, mean)
    return 1.0


def exact(held: DataFrame, threshold: float, block: int = 2000) -> DataFrame:
    """All pairs (a < b) of distinct vectors of one label, block against block."""
    blocks = held.groupBy("label").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    rows = held.select("label", "id", "v").join(blocks, "label").withColumn("own", F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "v")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g = pd.concat(batches)
        for _, h in g.groupby(g.v.map(len)):
            x, ids = _unit(h.v), h.id.to_numpy()
            left, right = np.flatnonzero(h.own.to_numpy() == h.i.to_numpy()), np.flatnonzero(h.own.to_numpy() == h.j.to_numpy())
            for s in _blocks(len(left), len(right)):
                a, b = np.nonzero(x[left[s]] @ x[right].T >= threshold)
                ab = np.sort(np.stack((ids[left[s][a]], ids[right[b]]), axis=1), axis=1)
                ab = ab[ab[:, 0] != ab[:, 1]]
                yield pd.DataFrame({"a": ab[:, 0], "b": ab[:, 1]})
    return rows.groupBy("label", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, target_recall: float = 0.95, id_col: str = "vec_id",
                    vec_col: str = "embedding", label_col: str = "label", **options) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and their cosine reaches
    ``threshold``.  Equal vectors are searched once and counted as often as
    they occur.  If the audit's recall is below ``target_recall`` the search is
    done again with twice the effort and overlap (twice at most), and after that
    all vectors of a label are compared, block against block.  NULL, empty
    and zero vectors, those with NULL or non-finite components, and rows with a
    NULL label or id link with nothing; vectors of different lengths do not
    link; repeated ids share links; other columns are ignored.
    """
    work = Work(vectors.sparkSession, "vectors")
    held = work.table(usable(vectors, id_col, vec_col, label_col), "distinct")
    options = {"overlap": 3, "effort": 32} | options
    for k in range(3):
        found = links(held, work, threshold, tag=str(k), **options)
        work.drop(f"routes{k}", f"graph{k}")
        if audit(held, found, threshold, work, tag=str(k)) >= target_recall:
            break
        options |= {"overlap": 2 * options["overlap"], "effort": 2 * options["effort"]}
    else:
        found = work.table(exact(held, threshold), "exact")
    comp = connected_components(work, found.select(F.col("a").alias("u"), F.col("b").alias("v")))
    ends = found.select(F.col("a").alias("id"), F.col("b").alias("other")).union(found.select("b", "a"))
    many = held.select(F.col("id").alias("other"), "n")
    linked = ends.join(many, "other").groupBy("id").agg(F.sum("n").alias("others"))
    named = held.join(linked, "id", "left").join(comp, held.id == comp.vertex, "left").select(
        "label", "v", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "id").alias("component"))
    named = work.table(named, "named")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vec_col).cast("array<double>").alias("v"))
    ready = F.col("vec_id").isNotNull()
    out = rows.join(named, ["label", "v"], "left")
    component = F.when(ready, F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.when(ready, F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
