"""Memory of a vector task, and the stored copies of a near-copy group, stay bounded in dense groups."""

import tracemalloc

import numpy as np
import pytest

from spendmatch.llm import vector_graph
from spendmatch.llm._work import Work


def near_copies(rng, many: int, size: int) -> np.ndarray:
    base = rng.normal(size=size)
    x = base / np.linalg.norm(base) + rng.normal(size=(many, size)) * 0.1 / size ** 0.5
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def peak_mb(run) -> tuple[float, object]:
    tracemalloc.start()
    try:
        out = run()
        return tracemalloc.get_traced_memory()[1] / 1e6, out
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("size", [64, 512])
def test_search_of_a_dense_shard_holds_blocks_only(size):
    x = near_copies(np.random.default_rng(4), 700, size)
    near = vector_graph.robust_prune(x)
    mb, (who, node) = peak_mb(lambda: vector_graph.range_search(x, near, x[:400], 0, 0.93, 32, own=np.arange(400)))
    assert set(zip(who.tolist(), node.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(x[:400] @ x.T >= 0.93))))
    assert mb < 40


def test_centres_are_met_in_blocks():
    rng = np.random.default_rng(5)
    x, c = rng.normal(size=(10_000, 8)), rng.normal(size=(1200, 8))
    mb, near = peak_mb(lambda: vector_graph._nearest(x, c, 3))
    assert mb < 40 and np.array_equal(near[::97], np.argsort(-(x[::97] @ c.T), axis=1, kind="stable")[:, :3])


def test_a_cluster_that_does_not_divide_is_not_stored_again(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate((near_copies(rng, 600, 64), rng.normal(size=(300, 64))))
    df = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    held, work = vector_graph.usable(df, "vec_id", "embedding", "label").cache(), Work(spark, "t")
    routes = work.table(vector_graph._route(held, 300, 3, 2000, 3), "routes")
    split = vector_graph._split(routes, work, 0.93, per_shard=50, max_shard=200, overlap=3, tag="")
    assert routes.count() == 2700 and split.count() < 4 * 2700  # 51,610 when every level stored the copies three times
    assert {r.id for r in split.select("id").distinct().collect()} == set(range(900))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = {(int(a), int(b)) for a, b in np.argwhere(unit @ unit.T >= 0.93) if a < b}
    got = [tuple(r) for r in vector_graph.links(held, Work(spark, "t"), 0.93, per_shard=50, max_shard=200, max_clusters=3).collect()]
    assert set(got) == true and len(got) == len(true)
