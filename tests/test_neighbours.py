"""Neighbour search and oversampling against brute force on small inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from respondry.operators import neighbours, oversampling


def brute_force(rows, k):
    """{key: [(d2, key), ...]} of the k nearest other rows of the same class."""
    found = {}
    for key, cls, vec in rows:
        near = sorted(
            (float(((np.array(vec) - np.array(v)) ** 2).sum()), other)
            for other, c, v in rows
            if c == cls and other != key
        )
        found[key] = near[:k]
    return found


def clustered(n, seed, dimensions=4):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 400, size=(9, dimensions))
    vectors = centres[rng.integers(0, 9, n)] + rng.integers(0, 12, size=(n, dimensions))
    return [(int(i), int(i % 2), [float(x) for x in v]) for i, v in enumerate(vectors)]


def with_copies(n):
    """A third of all rows are the same vector, another third has few distinct values."""
    rows = []
    for i in range(n):
        vec = [5.0, 5.0] if i % 3 == 0 else ([float(i % 7), 1.0] if i % 3 == 1
                                             else [float(i * i % 101), float(i % 11)])
        rows.append((i, 0, vec))
    return rows


@pytest.fixture
def small_blocks(monkeypatch):
    """Sizes that force many cells, many blocks, cut cells and several query shares."""
    monkeypatch.setattr(neighbours, "ROWS_PER_CELL", 16)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 40)
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 8 * 4 * 50)


def found_neighbours(spark, rows, k, key_type="long", parts=3):
    df = spark.createDataFrame(rows, f"id {key_type}, cls int, vec array<double>")
    out = neighbours.row_neighbours(df.repartition(parts), "cls", "id", k).collect()
    return {r["id"]: [(o["d2"], o["key"]) for o in r["others"]] for r in out}


@pytest.mark.parametrize("rows", [clustered(600, 1), clustered(300, 2, 12), with_copies(400)])
def test_exact_over_many_blocks(spark, small_blocks, rows):
    assert found_neighbours(spark, rows, 5) == brute_force(rows, 5)


def test_exact_in_one_block_and_for_text_keys(spark):
    rows = [(f"k{i:04d}", c, v) for i, c, v in clustered(200, 3)]
    assert found_neighbours(spark, rows, 3, "string") == brute_force(rows, 3)


def test_a_cell_above_the_block_size_is_cut(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 20)
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 8 * 4 * 30)
    rows = clustered(250, 4)
    assert found_neighbours(spark, rows, 4) == brute_force(rows, 4)


def test_far_clusters_are_not_visited(spark, small_blocks, monkeypatch):
    seen = {}
    original = neighbours.written

    def keep(df, name, partition_by=()):
        seen[name] = original(df, name, partition_by)
        return seen[name]

    monkeypatch.setattr(neighbours, "written", keep)
    rows = clustered(600, 1)
    assert found_neighbours(spark, rows, 5) == brute_force(rows, 5)
    row = seen["queries"].agg(F.avg(F.size("targets")), F.max("block")).first()
    assert row[1] > 10 and row[0] < (row[1] + 1) / 2 / 3


def grown(spark, rows, parts, k=5):
    df = spark.createDataFrame(rows, "id long, label double, features array<double>")
    return oversampling.oversample(df.repartition(parts), "id", k=k)


def test_balance_and_segments(spark):
    rows = [(i, float(i % 7 == 0), v) for i, _, v in clustered(400, 5)]
    out = grown(spark, rows, 3).collect()
    sizes = {}
    for r in out:
        sizes[r["label"]] = sizes.get(r["label"], 0) + 1
    assert sizes[0.0] == sizes[1.0]
    assert len({r["row_key"] for r in out}) == len(out)
    minority = [(i, 1, v) for i, label, v in rows if label == 1.0]
    vectors, near = {i: np.array(v) for i, _, v in minority}, brute_force(minority, 5)
    for r in out:
        if r["is_synthetic"]:
            parent = int(r["row_key"].split("#")[0])
            point, base = np.array(r["features"]), vectors[parent]
            assert any(_between(base, vectors[other], point) for _, other in near[parent])


def _between(a, b, p):
    span = b - a
    length = float(span @ span)
    step = float((p - a) @ span) / length if length else 0.0
    return -1e-9 <= step <= 1 + 1e-9 and np.allclose(a + step * span, p)


def test_same_points_for_any_partitioning(spark):
    rows = [(i, float(i % 9 == 0), v) for i, _, v in clustered(300, 6)]
    results = [
        sorted((r["row_key"], r["label"], tuple(r["features"])) for r in grown(spark, rows, n).collect())
        for n in (1, 4, 7)
    ]
    assert results[0] == results[1] == results[2]


def test_small_classes(spark):
    majority = [(i, 0.0, [float(i), 1.0]) for i in range(10)]
    lonely = grown(spark, [*majority, (99, 1.0, [7.0, 7.0])], 2)
    made = [r for r in lonely.collect() if r["is_synthetic"]]
    assert len(made) == 9 and all(r["features"] == [7.0, 7.0] for r in made)
    pair = grown(spark, [*majority, (98, 1.0, [0.0, 0.0]), (99, 1.0, [1.0, 1.0])], 2)
    assert pair.filter("is_synthetic").count() == 8
    even = [(i, float(i % 2), [float(i), 0.0]) for i in range(6)]
    assert grown(spark, even, 2).filter("is_synthetic").count() == 0
    with pytest.raises(ValueError):
        grown(spark, majority, 2)


def test_many_copies_per_row(spark, monkeypatch):
    monkeypatch.setattr(oversampling, "COPIES_PER_BLOCK", 4)
    rows = [(i, 0.0, [float(i), 1.0]) for i in range(50)]
    rows += [(100 + i, 1.0, [float(i), 5.0]) for i in range(3)]
    out = grown(spark, rows, 3)
    assert out.filter("label = 1.0").count() == 50
    assert out.select("row_key").distinct().count() == 100


def test_a_query_meets_few_rows_of_its_block(monkeypatch):
    rng = np.random.default_rng(5)
    data = np.hstack([rng.integers(0, 2, (6000, 6)).astype(float), rng.random((6000, 4))])
    met, shortlist = [], neighbours._shortlist

    def watched(queries, rows, reach, k):
        met.append(len(queries) * len(rows))
        pairs = shortlist(queries, rows, reach, k)
        assert all(len(set(p)) == len(p) for p in [list(zip(*pairs))])
        return pairs

    monkeypatch.setattr(neighbours, "_shortlist", watched)
    best = neighbours.search_block(data[:300], np.full(300, np.inf), data, np.arange(6000), 6)
    assert sum(met) < 0.1 * 300 * 6000
    apart = ((data[:300, None] - data[None]) ** 2).sum(2)
    assert np.allclose(best.d2, np.sort(apart, axis=1)[:, :6])
