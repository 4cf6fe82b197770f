import math

import numpy as np
import pytest

from fieldprep.llm import vectors
from fieldprep.llm.hnsw import Graph

SCHEMA = "vec_id bigint, embedding array<float>, label int, key bigint, family string, n int, shard int"


def _cloud(seed, n=400, dims=16):
    """Random directions, groups of near copies of very different sizes, and chains of links."""
    draws = np.random.default_rng(seed)
    vectors_ = draws.standard_normal((n, dims))
    for start, size in ((0, 2), (2, 5), (10, 120), (200, 30)):
        vectors_[start : start + size] = vectors_[start] + 0.12 * draws.standard_normal((size, dims))
    for k in range(300, 330):
        vectors_[k] = vectors_[k - 1] + 0.22 * draws.standard_normal(dims)
    return vectors_ * draws.uniform(0.1, 10, (n, 1))


def _brute(rows, least=0.93):
    """rows: (vec_id, vector, label) to sorted (vec_id, n_links, component_id, kept)."""

    def good(v, label):
        return label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)

    n, of = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while of[i] != i:
            of[i] = of[of[i]]
            i = of[i]
        return i

    usable = [i for i, (_, v, label) in enumerate(rows) if good(v, label)]
    for a, i in enumerate(usable):
        for j in usable[a + 1 :]:
            if rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.float64(np.float32(rows[i][1])), np.float64(np.float32(rows[j][1]))
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= least:
                    n[i] += 1
                    n[j] += 1
                    of[root(i)] = root(j)
    least_id = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            least_id[root(i)] = min(least_id.get(root(i), vec_id), vec_id)
    return sorted(((r[0], n[i], least_id.get(root(i)), r[0] == least_id.get(root(i))) for i, r in enumerate(rows)), key=str)


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x", 2, 3) for i, v, label in rows], SCHEMA)


def _found(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize("room", [vectors.ROOM, 16 * 50])
def test_equals_brute_force_over_one_and_many_shards(spark, room):
    cloud = _cloud(1)
    rows = [(1000 - i, v.tolist(), 1 + (i % 17 == 0)) for i, v in enumerate(cloud)]
    rows += [(2000 + i, cloud[i % 3].tolist(), 1) for i in range(40)]
    assert _found(vectors.near_vectors(_frame(spark, rows).repartition(6), room=room)) == _brute(rows)


def test_unusable_vectors_ties_repeats_and_missing_ids(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.01], 1), (4, [-1.0, 0.0], 1), (5, [1.0, 0.0], 2), (6, [1.0, 0.0], None),
        (7, None, 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [0.0, -0.0], 1), (12, [], 1), (13, [1.0, 0.0, 0.0], 1),
        (3, [1.0, 0.0], 1), (None, [0.0, 5.0], 3), (None, [0.0, 5.0], 3), (20, [3e38, 3e38], 4), (21, [1e-40, 1e-40], 4), (22, [-0.0, 1.0], 5), (23, [0.0, 1.0], 5), (None, [1.0, 0.0], 1), (None, None, None),
    ]
    assert _found(vectors.near_vectors(_frame(spark, rows))) == _brute(rows)


def test_empty_table(spark):
    assert _found(vectors.near_vectors(_frame(spark, []))) == []


def test_the_graph_finds_nearest_vectors():
    draws = np.random.default_rng(2)
    unit = draws.standard_normal((3000, 32)).astype(np.float32)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    graph = Graph.build(unit, np.arange(3000))
    assert len(graph.members) >= 3 and graph.layers[0].shape == (3000, 32)
    true = np.sort(unit[:500] @ unit.T, axis=1)[:, ::-1][:, :10]
    found = graph.nearest(unit[:500], 10, 64)
    assert (found >= true - 1e-5).mean() > 0.95
    again = Graph.build(unit, np.arange(3000))
    assert all(np.array_equal(a, b) for a, b in zip(graph.layers, again.layers, strict=True))


def test_links_are_recalled_in_large_groups():
    cloud = _cloud(5, 2000, 24)
    unit = (cloud / np.linalg.norm(cloud, axis=1, keepdims=True)).astype(np.float32)
    graph = Graph.build(unit, np.arange(len(unit)))
    who, row = graph.within(unit, 0.93, 32)
    found = np.zeros((len(unit), len(unit)), bool)
    found[who, row] = True
    true = unit @ unit.T >= 0.93
    assert (found & true).sum() / true.sum() > 0.99 and not (found & ~true).any()


def _shard(cloud, spoil=False):
    keys = np.arange(len(cloud))
    scaled = vectors._scaled(cloud)
    graph = Graph.build(vectors._unit(scaled), keys)
    layers = [np.full_like(x, -1) if spoil else x for x in graph.layers]
    return vectors.Shard(
        {
            "keys": keys.astype("<i8").tobytes(), "copies": np.ones(len(keys), "<i8").tobytes(), "vectors": scaled.tobytes(), "dims": cloud.shape[1],
            "members": [m.astype("<i4").tobytes() for m in graph.members], "links": [x.tobytes() for x in layers],
        }
    )


def test_the_beam_widens_until_the_audit_passes():
    cloud = _cloud(6)
    good, spoilt = _shard(cloud), _shard(cloud, spoil=True)
    i, j, beam = vectors.linked(good, good, 0.93)
    assert beam < len(cloud)
    x, y, widest = vectors.linked(spoilt, spoilt, 0.93)
    assert widest == len(cloud)  # without any links nothing is found, and the shard is scanned
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(x.tolist(), y.tolist(), strict=True))


def test_pairs_between_shards_are_found_from_either_side():
    cloud = _cloud(7)
    a, b = _shard(cloud[::2]), _shard(cloud[1::2])
    i, j, _ = vectors.linked(a, b, 0.93)
    length = np.linalg.norm(cloud, axis=1)
    true = (cloud[::2] @ cloud[1::2].T) / np.outer(length[::2], length[1::2]) >= 0.93
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(true)), strict=True))
