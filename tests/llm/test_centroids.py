"""Centroid clustering against plain rounds over all pairs."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwise.llm import centroids


def plain_nearest(x, rows):
    return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), i) for i, c in enumerate(rows))


def plain_clusters(vectors, clusters, rounds, scale, seed):
    whole = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v in vectors]
    digest = lambda r: hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    rows = [x for _, x in sorted(whole, key=lambda r: (digest(r), r[1]))[:clusters]]
    for _ in range(rounds):
        of = [plain_nearest(x, rows)[1] for _, x in whole]
        for c in range(len(rows)):
            own = [x for (_, x), o in zip(whole, of, strict=True) if o == c]
            if own:
                rows[c] = [sum(v) // len(own) for v in zip(*own, strict=True)]
    return [(i, *plain_nearest(x, rows)[::-1]) for i, x in whole], rows


@settings(max_examples=150, deadline=None)
@given(
    st.integers(1, 5).flatmap(
        lambda d: st.tuples(
            st.lists(st.lists(st.integers(-9, 9), min_size=d, max_size=d), min_size=1, max_size=12),
            st.lists(st.lists(st.integers(-12, 12), min_size=d, max_size=d), min_size=1, max_size=8),
        )
    ),
    st.sampled_from([1, 10**15]),
)
def test_threshold_walk_finds_the_nearest_and_the_smaller_of_ties(case, factor):
    rows, xs = case
    kind = np.int64 if factor == 1 else object
    rows, xs = [[v * factor for v in r] for r in rows], [[v * factor for v in r] for r in xs]
    found, distance, compared = centroids.Lists(rows, kind).nearest(np.array(xs, dtype=kind))
    assert [(d, c) for d, c in zip(distance.tolist(), found.tolist(), strict=True)] == [plain_nearest(x, rows) for x in xs]
    assert compared.max() <= len(rows)


def test_the_walk_stops_early():
    rows = [[100 * c, 100 * c] for c in range(50)]
    _, _, compared = centroids.Lists(rows, np.int64).nearest(np.array([[101, 99], [4901, 4901]]))
    assert compared.max() <= 4


def vectors(n, dims, seed=5):
    pick = random.Random(seed)
    centres = [[pick.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    return [(i, [pick.gauss(c, 0.5) for c in pick.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize(("clusters", "rounds"), [(6, 3), (1, 1), (500, 2), (5, 0)])
def test_equals_plain_rounds(spark, clusters, rounds):
    rows = vectors(200, 8) + [(7, vectors(1, 8)[0][1])] * 150 + [(None, [0.0] * 8)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4)
    assigned, found = centroids.cluster_vectors(frame, clusters, rounds, 8, 100, "s")
    expected, plain = plain_clusters(rows, clusters, rounds, 100, "s")
    key = lambda r: tuple(map(repr, r))
    assert sorted((tuple(r) for r in assigned.collect()), key=key) == sorted(expected, key=key)
    assert found == plain
    out = centroids.with_totals(assigned, found).collect()
    inertia = {c: sum(r[2] for r in expected if r[1] == c) for c in {r[1] for r in expected}}
    for r in out:
        assert (r["cluster_inertia"], r["inertia"]) == (inertia[r["cluster"]], sum(inertia.values()))
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, plain[r["cluster"]])).encode()).hexdigest()
    assert len(out) == len(rows)


def test_what_is_kept(spark):
    rows = [
        (1, [0.5, -0.5], "a"), (2, None, "a"), (3, [], "a"), (4, [1.0, None], "a"), (5, [1.0, float("nan")], "a"),
        (6, [float("-inf"), 1.0], "a"), (7, [1.0, 2.0, 3.0], "a"), (8, [1e30, -1e30], "a"), (9, [0.001, -0.001], "a"),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, cluster string")
    kept = {r["vec_id"]: list(r["x"]) for r in centroids.whole_vectors(frame, 2).collect()}
    assert kept == {1: [128, -128], 8: [(1 << 63) - 1, -(1 << 63)], 9: [0, -1]}
    assigned, found = centroids.cluster_vectors(frame, 1, 1, 2)
    out = {r["vec_id"]: r for r in centroids.with_totals(assigned, found).collect()}
    assert set(out) == {1, 8, 9} and out[8]["distance"] is None and out[8]["inertia"] is None


def test_no_vectors(spark):
    frame = spark.createDataFrame([(1, [1.0])], "vec_id bigint, embedding array<float>")
    assigned, found = centroids.cluster_vectors(frame, 3, 2, 2)
    assert found == [] and centroids.with_totals(assigned, found).collect() == []
