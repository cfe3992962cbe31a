"""Kernels on cases small enough to know, and their invariants."""

from __future__ import annotations

import io
import math

import numpy as np
import pytest

from trajlake.kernels import search as K
from trajlake.kernels import shapes as P
from trajlake.sources import arrays as A


def test_hull_of_a_cube():
    cube = np.array([[x, y, z] for x in (0, 1) for y in (0, 1) for z in (0, 1)], float)
    rng = np.random.default_rng(1)
    assert P.share_inside(rng.uniform(0.01, 0.99, (200, 3)), np.vstack([cube, rng.uniform(0, 1, (50, 3))])) == 1
    assert P.share_inside(rng.uniform(1.01, 2, (50, 3)), cube) == 0
    assert P.share_inside(np.array([[0.5, 0.5, 0.5], [2, 2, 2], [0, 0, 0], [-1, 0, 0]]), cube) == 0.5
    assert P.hull_planes(cube[cube[:, 2] == 0]) is None
    assert P.hull_planes(cube[:3]) is None
    assert P.share_inside(np.zeros((0, 3)), cube) == 0


def test_medoids():
    p = np.array([[0, 0], [0, 1], [1, 0], [10, 10], [10, 11], [11, 10], [20, 0]], float)
    assert P.medoids(p, 3).tolist() == [0, 3, 6]
    assert P.medoids(p[:2], 5).tolist() == [0, 1]


def test_straight_corridor():
    world = K.World(np.ones((9, 81), bool), 0.0, 0.0, 0.25)
    poses, actions = K.plan_poses(world, (1.0, 1.0, 0), (6.0, 1.0))
    assert actions == [K.FORWARD] * 20 + [K.STOP]
    assert len(poses) == len(actions)


def test_steps_turn_or_go_and_stay_clear():
    free = np.ones((40, 40), bool)
    free[20, 5:35] = False
    world = K.World(free, 0.0, 0.0, 0.25)
    poses, actions = K.plan_poses(world, (5.0, 2.0, 3), (5.0, 8.0), K.PlannerSettings(partial_reach=1.0))
    for (x, y, k), (u, v, m), a in zip(poses, poses[1:], actions, strict=False):
        if a == K.FORWARD:
            assert math.isclose(math.hypot(u - x, v - y), 0.25) and m == k
            assert world.at(u, v, 0)
        else:
            assert (u, v) == (x, y) and (m - k) % 24 == (1 if a == K.LEFT else 23)
    assert actions[-1] == K.STOP and math.hypot(poses[-1][0] - 5, poses[-1][1] - 8) < 1.0
    assert K.plan_poses(world, (5.0, 5.0, 0), (5.0, 8.0)) is None  # starts in the wall


def test_grid_path():
    free = np.ones((5, 7), bool)
    free[1:, 3] = False
    path = K.grid_path(free, (4, 0), (4, 6))
    assert path[0] == (4, 0) and path[-1] == (4, 6) and (0, 3) in path
    assert all(free[c] for c in path) and all(max(abs(a - c), abs(b - d)) == 1 for (a, b), (c, d) in zip(path, path[1:], strict=False))
    free[0, 3] = False
    assert K.grid_path(free, (4, 0), (4, 6))[-1] == (4, 2)
    assert K.grid_path(free, (4, 3), (0, 0)) == []


def test_follow():
    assert K.follow(np.array([[0, 0], [1, 0]])) == [1, 1, 1, 1, 0]
    square = K.follow(np.array([[0, 0], [1, 0], [1, 1]]))
    assert square.count(K.LEFT) == 6 and square[-1] == K.STOP
    assert K.follow(np.zeros((1, 2))) == [K.STOP]


def test_lines_and_polylines():
    assert P.line_cells(0, 0, 2, 4).tolist() == [[0, 0], [1, 1], [1, 2], [2, 3], [2, 4]]
    assert P.line_cells(3, 3, 3, 3).tolist() == [[3, 3]]
    free = np.ones((5, 5), bool)
    free[2, 2] = False
    assert P.line_hits(free, P.line_cells(0, 0, 4, 4), 0) and not P.line_hits(free, P.line_cells(0, 0, 0, 4), 0)
    assert P.line_hits(free, P.line_cells(0, 0, 0, 4), 1)  # reaches outside
    straight = np.array([[0, 0], [1, 0], [2, 0], [2, 1], [2, 2]], float)
    assert P.drop_collinear(straight).tolist() == [[0, 0], [2, 0], [2, 2]]
    assert P.simplify(straight, 0.1).tolist() == [[0, 0], [2, 0], [2, 2]]
    assert P.simplify(straight, 5).tolist() == [[0, 0], [2, 2]]
    wall = np.ones((4, 4), bool)
    wall[1, 1] = False
    assert len(P.simplify(straight, 5, wall)) > 2
    line = np.stack([np.arange(30), np.arange(30) * 2.0], axis=1)
    assert np.allclose(P.polynomial_smooth(line), line)
    assert np.allclose(P.gaussian_smooth(line, 1.5)[8:-8], line[8:-8])
    assert np.allclose(P.spline(line, 30), line)
    assert P.snap_jitters(np.array([[0, 0], [0.25, 1], [0.5, 1]]), (0.25,)).tolist() == [[0, 0], [0, 1], [0.5, 1]]
    assert np.allclose(P.safe_smooth(line[:4], np.zeros((2, 2), bool), 2.0), line[:4])


@pytest.mark.parametrize("shape", [(7, 5), (6, 4, 3), (3, 9, 4)])
def test_png_round_trip(shape):
    a = np.random.default_rng(0).integers(0, 256, shape, np.uint8)
    assert np.array_equal(A.png_pixels(A.png_bytes(a)), a)
    with pytest.raises(ValueError):
        A.png_pixels(b"no image")


def test_resize_and_npy():
    a = np.arange(16.0).reshape(4, 4)
    assert np.array_equal(A.resize(a, 4, 4), a) and A.resize(a, 2, 2)[0, 0] == 2.5 and A.resize(a, 9, 9).shape == (9, 9)
    assert np.array_equal(np.load(io.BytesIO(A.npy_bytes(a))), a)
