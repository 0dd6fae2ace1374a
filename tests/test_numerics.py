import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crossview.numerics import cluster, paths
from crossview.numerics.assignment import assign, exclusive_groups
from crossview.operators import calibration as K


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(1, 5), st.integers(0, 10**6))
def test_assignment_is_optimal(n, m, seed):
    cost = np.random.default_rng(seed).integers(0, 9, (n, m)).astype(float)
    r, c = assign(cost)
    assert len(r) == min(n, m) and len(set(c)) == len(c)
    a = cost if n <= m else cost.T
    best = min(sum(a[i, p[i]] for i in range(a.shape[0])) for p in itertools.permutations(range(a.shape[1]), a.shape[0]))
    assert cost[r, c].sum() == best


def test_assignment_of_nothing():
    assert assign(np.empty((0, 3)))[0].size == 0


def test_exclusive_groups():
    cost = np.array([[0.0, 1.0], [0.1, 0.9], [0.2, 0.3]])
    assert exclusive_groups(cost, [[0, 1]]).tolist() == [1, 0, 0] or exclusive_groups(cost, [[0, 1]]).tolist() == [0, 1, 0]
    assert exclusive_groups(np.zeros((3, 2)), [[0, 1, 2]]) is None


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 7), st.integers(2, 4), st.integers(0, 10**6))
def test_exclusive_groups_are_optimal(n, k, seed):
    rng = np.random.default_rng(seed)
    cost = rng.random((n, k))
    groups = [sorted(rng.choice(n, min(n, 2 + i % 2), replace=False).tolist()) for i in range(rng.integers(0, 4))]
    want = min((sum(cost[i, c] for i, c in enumerate(p)) for p in itertools.product(range(k), repeat=n) if all(len({p[i] for i in g}) == len(g) for g in groups)), default=None)
    got = exclusive_groups(cost, groups)
    assert (got is None) == (want is None) and (want is None or cost[np.arange(n), got].sum() == pytest.approx(want))


def test_exclusive_groups_of_many_sets():
    """Hundreds of separate sets, which one search over all could not end; and no silent way out of one that is too hard."""
    rng = np.random.default_rng(5)
    cost = rng.random((1500, 12))
    groups = [[3 * i, 3 * i + 1, 3 * i + 2] for i in range(500)]
    got = exclusive_groups(cost, groups)
    assert all(len(set(got[g])) == 3 for g in groups)
    assert sum(cost[np.arange(1500), got]) == pytest.approx(sum(cost[g][assign(cost[g])].sum() for g in groups))
    with pytest.raises(RuntimeError, match="overlap in one chain"):
        exclusive_groups(rng.random((40, 30)), [list(range(i, i + 10)) for i in range(30)], limit=20)


def test_ward_separates_and_is_monotone():
    rng = np.random.default_rng(0)
    x = np.r_[rng.normal(0, 0.05, (10, 3)), rng.normal(3, 0.05, (7, 3)), rng.normal(-3, 0.05, (5, 3))]
    heights = [m[2] for m in cluster.ward_merges(x)]
    assert heights == sorted(heights)
    assert cluster.ward_by_count(x, 3).tolist() == [0] * 10 + [1] * 7 + [2] * 5
    assert cluster.ward_by_distance(x, 2.0).max() == 2
    # Two points: their distance; the third merge by Lance and Williams.
    two = cluster.ward_merges(np.array([[0.0], [2.0]]))
    assert two[0][2] == pytest.approx(2.0)


def test_hdbscan_blobs_and_noise():
    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(0, 0.05, (12, 2)), rng.normal(5, 0.05, (9, 2)), [[50.0, 50.0]]]
    labels = cluster.hdbscan(x, 4)
    assert len(set(labels[:12])) == 1 and len(set(labels[12:21])) == 1 and labels[0] != labels[12] and labels[21] == -1
    assert cluster.hdbscan(np.zeros((1, 2)), 2).tolist() == [-1]


def test_hdbscan_does_not_depend_on_order():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (300, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[40:60] = x[40]
    sets = lambda labels: {frozenset(np.flatnonzero(labels == k).tolist()) for k in set(labels.tolist()) - {-1}}
    want = sets(cluster.hdbscan(x, 4))
    for seed in range(4):
        p = np.random.default_rng(seed).permutation(len(x))
        assert sets(cluster.hdbscan(x[p], 4)[np.argsort(p)]) == want
    assert cluster.distances(x)[40:60, 40:60].max() == 0


def test_paths():
    a = np.array([[0.0, 0.0], [2.0, 0.0]])
    assert paths.resample(a, 3).tolist() == [[0, 0], [1, 0], [2, 0]]
    assert paths.average([a, a + [0, 2]]).tolist() == [[0, 1], [2, 1]]
    assert paths.distance(a, a + [0, 1], "pairwise") == pytest.approx(1.0)
    # Directed: every point of a is near b, b's last is far from a.
    b = np.array([[0.0, 0.0], [2.0, 0.0], [9.0, 0.0]])
    assert paths.distance(np.array([[0.0, 0.0], [2.0, 0.0], [2.0, 0.0]]), b, "Hausdorff") == 0
    assert paths.distance(a[:0], a, "pairwise") is None
    assert paths.overlap(np.array([1, 2, 3, 4]), np.arange(8).reshape(4, 2), 2, 3).tolist() == [[2, 3], [4, 5]]
    assert paths.directed([0, 0], [3, 4], np.array([1.0, 0]), np.array([-1.0, 0]), 0.5) == pytest.approx(10.0)
    assert paths.directed([0, 0], [3, 4], np.array([0.1, 0]), np.array([-1.0, 0]), 0.5) == pytest.approx(5.0)


def test_homography_round_trip():
    h = np.array([[0.02, 0.001, -3], [0.0005, 0.03, 2], [1e-5, 2e-5, 1]])
    p = np.array([[0, 0], [1900, 10], [1800, 1000], [50, 900], [700, 500]], float)
    got = K.homography(p, K.apply(h, p))
    assert np.abs(K.apply(got, p) - K.apply(h, p)).max() < 1e-6
    assert K.homography(p[:3], p[:3]) is None and K.homography(p, p[:4]) is None


def test_pose_and_height():
    k = K.assumed_intrinsics(1920, 1080)
    r = K.rotation(np.array([2.0, 0.3, -0.2]))
    t = np.array([0.5, 0.2, 8.0])
    ground = np.array([[0, 0], [3, 0], [3, 4], [0, 4], [1, 2]], float)
    q = (np.c_[ground, np.zeros(5)] @ r.T + t) @ k.T
    image = q[:, :2] / q[:, 2:]
    r2, t2, _ = K.pose(image, ground, k)
    assert np.abs(r2 - r).max() < 1e-5 and np.abs(t2 - t).max() < 1e-4
    assert np.abs(K.rotation(K.rotation_vector(r)) - r).max() < 1e-9
    foot = K.back_project(image[4], k, r, t, 2, 0.0)
    assert np.abs(foot[:2] - ground[4]).max() < 1e-6


def test_sensor_states():
    s = {"id": "a", "attributes": [{"name": "frameWidth", "value": "1920"}, {"name": "fps", "value": "x"}], "place": [{"name": "room", "value": "1"}], "homography": [[2, 0, 0], [0, 2, 0], [0, 0, 1]], "rois": [{"roiCoordinates": [{"x": 0, "y": 0}]}]}
    (got,) = K.sensor_states([s])
    assert got["frame_width"] == 1920 and got["fps"] is None and got["place"] == "room=1" and got["homography"][0] == 0.5 and len(got["rois"]) == 1
