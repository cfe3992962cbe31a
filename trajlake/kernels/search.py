"""Path search: discrete poses under forward and turn actions, and cells of a grid."""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np

STOP, FORWARD, LEFT, RIGHT = 0, 1, 2, 3


@dataclass(frozen=True)
class PlannerSettings:
    """Step sizes, costs and limits; lengths in metres."""

    forward: float = 0.25
    degrees: int = 15
    turn_weight: float = 0.1
    reach: float = 0.125
    partial_reach: float = 3.0
    expansions: int = 50_000
    grain: float = 0.125
    footprint: int = 1
    goal_footprint: int = 0


class World:
    """A raster with regular axes: cell (row, col) lies at (y0 + row * cell, x0 + col * cell)."""

    def __init__(self, free: np.ndarray, x0: float, y0: float, cell: float) -> None:
        self.free, self.x0, self.y0, self.cell = free.astype(bool), x0, y0, cell
        self._clear: dict[int, np.ndarray] = {}

    def clear(self, radius: int) -> np.ndarray:
        """Cells whose square neighbourhood holds no obstacle; what lies outside the raster doesn't count."""
        if radius not in self._clear:
            ok = self.free.copy()
            h, w = ok.shape
            blocked = np.pad(~self.free, radius)
            for dr in range(2 * radius + 1):
                for dc in range(2 * radius + 1):
                    ok &= ~blocked[dr : dr + h, dc : dc + w]
            self._clear[radius] = ok
        return self._clear[radius]

    def at(self, x: float, y: float, radius: int) -> bool:
        row, col = math.floor((y - self.y0) / self.cell + 0.5), math.floor((x - self.x0) / self.cell + 0.5)
        ok = self.clear(radius)
        return 0 <= row < ok.shape[0] and 0 <= col < ok.shape[1] and bool(ok[row, col])


def plan_poses(world: World, start: tuple[float, float, int], goal: tuple[float, float], s: PlannerSettings = PlannerSettings()) -> tuple[list[tuple[float, float, int]], list[int]] | None:
    """Poses (x, y, heading in turns) and as many actions, the last of which is stop; None if no pose near enough to the goal was met.

    A* over poses; a pose's key is its rounded place and its heading modulo a full circle, so that both sides of the cut at half a
    circle are one heading. Of equal priorities the pose found first goes first, so runs agree. If the goal itself isn't reached within the
    limit of expansions, the nearest pose counts if it lies within ``partial_reach``. A start or a goal in collision has no path.
    """
    turns, rad = 360 // s.degrees, math.radians(s.degrees)
    place = lambda x, y, k: (round(x / s.grain), round(y / s.grain), k % turns)

    def ahead(x: float, y: float, k: int) -> float:
        d = math.hypot(goal[0] - x, goal[1] - y)
        if d < 1e-9:
            return 0.0
        off = (math.atan2(goal[1] - y, goal[0] - x) - k * rad + math.pi) % (2 * math.pi) - math.pi
        return d + s.turn_weight * abs(off)

    x, y, k = start
    if not world.at(x, y, s.footprint) or not world.at(*goal, s.goal_footprint):
        return None
    came: dict[tuple, tuple | None] = {place(*start): None}
    pose: dict[tuple, tuple[float, float, int]] = {place(*start): (x, y, k % turns)}
    did: dict[tuple, int] = {}
    cost = {place(*start): 0.0}
    heap = [(ahead(x, y, k), 0, place(*start))]
    closed: set[tuple] = set()
    count, best, best_d, found = 0, None, math.inf, None
    while heap and len(closed) < s.expansions:
        _, _, here = heapq.heappop(heap)
        if here in closed:
            continue
        closed.add(here)
        x, y, k = pose[here]
        d = math.hypot(goal[0] - x, goal[1] - y)
        if d < best_d:
            best, best_d = here, d
        if d < s.reach:
            found = here
            break
        go = (x + s.forward * math.cos(k * rad), y + s.forward * math.sin(k * rad), k)
        near = math.hypot(goal[0] - go[0], goal[1] - go[1]) < s.reach
        moves = [(LEFT, (x, y, (k + 1) % turns), s.turn_weight * rad), (RIGHT, (x, y, (k - 1) % turns), s.turn_weight * rad)]
        if world.at(go[0], go[1], s.goal_footprint if near else s.footprint):
            moves.insert(0, (FORWARD, go, s.forward))
        for action, to, price in moves:
            key = place(*to)
            total = cost[here] + price
            if key not in closed and total < cost.get(key, math.inf) - 1e-12:
                cost[key], came[key], pose[key], did[key] = total, here, to, action
                count += 1
                heapq.heappush(heap, (total + ahead(*to), count, key))
    end = found if found is not None else best if best_d < s.partial_reach else None
    if end is None:
        return None
    poses, actions = [], [STOP]
    while end is not None:
        poses.append(pose[end])
        if came[end] is not None:
            actions.append(did[end])
        end = came[end]
    return poses[::-1], actions[:0:-1] + [STOP]


def grid_path(free: np.ndarray, start: tuple[int, int], goal: tuple[int, int], expansions: int = 1_000_000) -> list[tuple[int, int]]:
    """Cells from start to goal over free cells and their eight neighbours; if the goal can't be reached, to the met cell nearest to it. Empty if the start isn't free."""
    h, w = free.shape
    if not (0 <= start[0] < h and 0 <= start[1] < w and free[start]):
        return []
    far = lambda c: math.hypot(c[0] - goal[0], c[1] - goal[1])
    cost, came, heap, closed, count = {start: 0.0}, {start: None}, [(far(start), 0, start)], set(), 0
    nearest = start
    while heap and len(closed) < expansions:
        here = heapq.heappop(heap)[2]
        if here in closed:
            continue
        closed.add(here)
        if (far(here), here) < (far(nearest), nearest):
            nearest = here
        if here == goal:
            break
        for dr in (-1, 0, 1):
            for dc in (-1, 0, 1):
                to = (here[0] + dr, here[1] + dc)
                if (dr or dc) and 0 <= to[0] < h and 0 <= to[1] < w and free[to] and to not in closed:
                    total = cost[here] + math.hypot(dr, dc)
                    if total < cost.get(to, math.inf) - 1e-12:
                        cost[to], came[to] = total, here
                        count += 1
                        heapq.heappush(heap, (total + far(to), count, to))
    out, at = [], nearest
    while at is not None:
        out.append(at)
        at = came[at]
    return out[::-1]


def follow(path: np.ndarray, forward: float = 0.25, degrees: float = 15.0) -> list[int]:
    """Actions that follow a polyline from its first point, facing its second: turn while the next point lies more than half a turn aside, else go;
    a point counts as met within half a step. Ends with stop."""
    actions: list[int] = []
    if len(path) < 2:
        return [STOP]
    x, y = path[0]
    turn = math.radians(degrees)
    heading = math.atan2(path[1][1] - y, path[1][0] - x)
    for tx, ty in path[1:]:
        for _ in range(100_000):
            d = math.hypot(tx - x, ty - y)
            if d < forward / 2:
                break
            off = (math.atan2(ty - y, tx - x) - heading + math.pi) % (2 * math.pi) - math.pi
            if abs(off) > turn / 2 + 1e-9:  # a point exactly half a turn aside would be turned to and fro
                actions.append(LEFT if off > 0 else RIGHT)
                heading += math.copysign(turn, off)
            else:
                actions.append(FORWARD)
                x, y = x + forward * math.cos(heading), y + forward * math.sin(heading)
                if math.hypot(tx - x, ty - y) > d:  # passed it
                    break
    return [*actions, STOP]


def plan_pixels(world: World, start: tuple[int, int], goal: tuple[int, int], heading: float = 0.0, s: PlannerSettings = PlannerSettings()) -> tuple[np.ndarray, np.ndarray] | None:
    """``plan_poses`` between cells (row, col), from a heading in degrees: an array of x, y, yaw in radians, and the actions."""
    at = lambda c: (world.x0 + c[1] * world.cell, world.y0 + c[0] * world.cell)
    found = plan_poses(world, (*at(start), round(heading / s.degrees)), at(goal), s)
    if found is None:
        return None
    poses = np.array([(x, y, math.radians(k * s.degrees)) for x, y, k in found[0]])
    return poses, np.array(found[1])


def grid_path_xy(free: np.ndarray, start: tuple[int, int], goal: tuple[int, int]) -> np.ndarray:
    """``grid_path`` between points (x, y), as an array of x, y; empty where the goal isn't reached."""
    cells = grid_path(free, start[::-1], goal[::-1])
    return np.array([c[::-1] for c in cells]) if cells and cells[-1] == goal[::-1] else np.zeros((0, 2), int)
