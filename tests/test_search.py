"""The in-task search on its own, against brute force, over generated inputs."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from respondry.operators import neighbours


@st.composite
def problems(draw):
    rows, dimensions = draw(st.integers(1, 60)), draw(st.integers(1, 4))
    spread = draw(st.sampled_from([1, 3, 50]))
    numbers = st.integers(0, spread).map(float)
    vectors = draw(st.lists(
        st.lists(numbers, min_size=dimensions, max_size=dimensions), min_size=rows, max_size=rows,
    ))
    return np.array(vectors), draw(st.integers(1, 7)), draw(st.sampled_from([1, 4, 1000]))


def brute_force(queries, data, k):
    found = []
    for q in queries:
        pairs = sorted((float(((q - x) ** 2).sum()), i) for i, x in enumerate(data))
        found.append(pairs[:k])
    return found


@settings(max_examples=150, deadline=None)
@given(problems())
def test_search_is_exact(problem):
    data, k, cell = problem
    before = neighbours.ROWS_PER_CELL
    neighbours.ROWS_PER_CELL = cell
    try:
        reach = np.full(len(data), np.inf)
        best = neighbours.search_block(data, reach, data, np.arange(len(data)), k)
        expected = brute_force(data, data, k)
        for row, pairs in enumerate(expected):
            known = np.isfinite(best.d2[row])
            assert list(zip(best.d2[row][known], best.keys[row][known])) == pairs
        # a reach that is already known cuts nothing that belongs to the answer
        tight = np.array([pairs[-1][0] for pairs in expected])
        again = neighbours.search_block(data, tight, data, np.arange(len(data)), k)
        assert np.array_equal(again.d2, best.d2) and np.array_equal(again.keys, best.keys)
    finally:
        neighbours.ROWS_PER_CELL = before


@settings(max_examples=100, deadline=None)
@given(problems())
def test_tree_sends_rows_to_their_own_leaf(problem):
    data, _, leaf_rows = problem
    tree, leaves = neighbours.grow_tree(data, leaf_rows)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(len(data)))
    found = tree.leaves_of(data)
    for number, members in enumerate(leaves):
        assert (found[members] == number).all()
        assert len(members) <= leaf_rows or (data[members] == data[members][0]).all()


def hierarchy(data, leaf_rows, pieces=2):
    """The boxes of a tree over some rows; every third leaf is taken as empty."""
    tree, members = neighbours.grow_tree(data, leaf_rows)
    full = {leaf: rows for leaf, rows in enumerate(members) if leaf % 3 != 2}
    leaves = {
        leaf: (len(rows), data[rows].min(0), data[rows].max(0), pieces * number, pieces)
        for number, (leaf, rows) in enumerate(full.items())
    }
    return neighbours.Blocks.over(tree, leaves), leaves, np.concatenate(list(full.values()))


@settings(max_examples=100, deadline=None)
@given(problems())
def test_walk_finds_the_boxes_within_reach(problem):
    data, k, leaf_rows = problem
    blocks, leaves, held = hierarchy(data, leaf_rows)
    limit = np.resize([0.0, 3.0, 400.0, np.inf], len(data))
    expected = sorted(
        (row, number)
        for _, low, high, first, pieces in leaves.values()
        for row, near in enumerate(neighbours._to_box(data, low, high) <= limit) if near
        for number in range(first, first + pieces)
    )
    row, block = blocks.within(data, limit)
    assert sorted(zip(row.tolist(), block.tolist())) == expected
    sure, d2 = blocks.surely(data, k), np.sort(((data[:, None] - data[None, held]) ** 2).sum(2), axis=1)
    if len(held) < k:
        assert np.isinf(sure).all()
    else:
        assert (sure >= d2[:, k - 1]).all() and np.isfinite(sure).all()


def test_a_walk_meets_few_boxes(monkeypatch):
    """Points near their own cluster meet some logarithm of the boxes, not all."""
    rng = np.random.default_rng(1)
    data = rng.uniform(0, 1000, (20_000, 2))
    blocks, leaves, _ = hierarchy(data, 20)
    met, apart = [], neighbours.Blocks._apart
    monkeypatch.setattr(
        neighbours.Blocks, "_apart", lambda self, points, row, *rest, **more: met.append(len(row)) or apart(self, points, row, *rest, **more)
    )
    blocks.within(data[:500], np.full(500, 25.0))
    assert len(leaves) > 600 and sum(met) / 500 < 60
