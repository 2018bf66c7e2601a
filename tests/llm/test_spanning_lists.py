"""Every vector of a dense group is met from any other without leaving the range."""

import numpy as np

from spendmatch.llm import vector_graph


def test_lists_connect_a_dense_group_in_range():
    rng = np.random.default_rng(2)
    base = rng.normal(size=32)
    x = np.concatenate((base + 0.05 * rng.normal(size=(230, 32)), rng.normal(size=(200, 32))))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = vector_graph.robust_prune(x, degree=4, width=6)
    who, node = vector_graph.range_search(x, near, x, 300, 0.93, 32, own=np.arange(len(x)))
    assert set(zip(who.tolist(), node.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(x @ x.T >= 0.93))))


def test_spanning_tree():
    d = np.array([[0, 1, 5, 9], [1, 0, 2, 9], [5, 2, 0, 3], [9, 9, 3, 0]], np.float32)
    assert {frozenset(e) for e in vector_graph._spanning_tree(d)} == {frozenset(e) for e in ((0, 1), (1, 2), (2, 3))}
