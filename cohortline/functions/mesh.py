"""Triangles and area of the iso-surface inside a 2 x 2 x 2 cell, by corner pattern.

The masks are binary, so a cell has only 256 patterns. Their areas are derived
from one rule and not listed: cut points sit on the edges between a set and an
unset corner; within each face they are linked so that set corners of an
ambiguous face stay joined; the links close to loops; each loop is filled by
the triangulation of least area. Two set corners on a body diagonal are joined
through the cell by a tube (published cell-pattern method: Lorensen and Cline
1987; ambiguity rule: Chernyaev 1995).
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

# The iso-value is 0.5 in a mask of 0 and 255, so the surface runs this close
# to the unset corner.
UNSET_GAP = 0.5 / 255

CORNERS = np.array([(i >> 2 & 1, i >> 1 & 1, i & 1) for i in range(8)], dtype=float)


# The two corners of an edge of the cell.
Edge = frozenset


def corner_bit(dz: int, dy: int, dx: int) -> int:
    """Bit of the corner at an offset from the cell origin."""
    return 1 << (dz * 4 + dy * 2 + dx)


def _cut(a: int, b: int, on: set[int], gap: float) -> np.ndarray:
    """Where the surface cuts the edge between corners ``a`` and ``b``."""
    inside, outside = (a, b) if a in on else (b, a)
    return CORNERS[outside] + gap * (CORNERS[inside] - CORNERS[outside])


def _faces() -> list[list[int]]:
    """The corners of each face, in order around the face."""
    faces = []
    for axis in range(3):
        u, v = (4 >> a for a in range(3) if a != axis)
        for base in (0, 4 >> axis):
            faces.append([base, base + u, base + u + v, base + v])
    return faces


def _links(on: set[int]) -> list[tuple[frozenset, frozenset]]:
    """Links between cut edges, face by face."""
    links = []
    for face in _faces():
        around = list(zip(face, face[1:] + face[:1]))
        cuts = [frozenset(e) for e in around if (e[0] in on) != (e[1] in on)]
        if len(cuts) == 2:
            links.append((cuts[0], cuts[1]))
        elif len(cuts) == 4:
            # Set corners are joined across the face: cut off each unset one.
            for corner in face:
                if corner not in on:
                    links.append(tuple(e for e in cuts if corner in e))
    return links


def _loops(on: set[int]) -> list[list[frozenset]]:
    """Closed loops of cut edges."""
    beside: dict[frozenset, list[frozenset]] = {}
    for a, b in _links(on):
        beside.setdefault(a, []).append(b)
        beside.setdefault(b, []).append(a)
    loops, seen = [], set()
    for start in beside:
        if start in seen:
            continue
        loop = [start]
        seen.add(start)
        while True:
            onward = [e for e in beside[loop[-1]] if e not in seen]
            if not onward:
                break
            loop.append(onward[0])
            seen.add(onward[0])
        loops.append(loop)
    return loops


def _triangle(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> float:
    return float(np.linalg.norm(np.cross(b - a, c - a)) / 2)


def _least_fill(points: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """The triangulation of least area of a closed polygon in space; the first of those that tie."""

    @lru_cache(maxsize=None)
    def fill(i: int, j: int) -> tuple[float, tuple[tuple[int, int, int], ...]]:
        if j - i < 2:
            return 0.0, ()
        parts = []
        for k in range(i + 1, j):
            (left, first), (right, second) = fill(i, k), fill(k, j)
            area = left + right + _triangle(points[i], points[k], points[j])
            parts.append((area, (*first, *second, (i, k, j))))
        least = min(area for area, _ in parts)
        return next(p for p in parts if p[0] <= least + 1e-12)

    return list(fill(0, len(points) - 1)[1])


def _tube(on: set[int]) -> list[tuple[Edge, Edge, Edge]]:
    """Two set corners on a body diagonal: six triangles around the ring between them."""
    first, last = sorted(on)
    ring = [first ^ 1, first ^ 3, first ^ 2, first ^ 6, first ^ 4, first ^ 5]
    near = {c: first if bin(c ^ first).count("1") == 1 else last for c in ring}
    edges = [frozenset((near[c], c)) for c in ring]
    return [(edges[i], edges[(i + 1) % 6], edges[(i + 2) % 6]) for i in range(6)]


@lru_cache(maxsize=None)
def cell_triangles(gap: float = UNSET_GAP) -> tuple[tuple[tuple[Edge, Edge, Edge], ...], ...]:
    """The triangles of each of the 256 corner patterns, by the cut edges they join."""
    diagonals = {frozenset(p) for p in combinations(range(8), 2) if p[0] ^ p[1] == 7}
    found = []
    for pattern in range(256):
        on = {c for c in range(8) if pattern >> c & 1}
        if frozenset(on) in diagonals:
            found.append(tuple(_tube(on)))
            continue
        triangles = []
        for loop in _loops(on):
            points = [_cut(*sorted(e), on, gap) for e in loop]
            triangles += [tuple(loop[i] for i in t) for t in _least_fill(points)]
        found.append(tuple(triangles))
    return tuple(found)


def lattice_edge(edge: Edge, pattern: int) -> tuple[int, int, int, int, int]:
    """``dz, dy, dx, axis, side`` of a cut edge: its lower corner, its direction, and 1 where the upper corner is set."""
    low, high = sorted(edge)
    axis = {4: 0, 2: 1, 1: 2}[low ^ high]
    return low >> 2 & 1, low >> 1 & 1, low & 1, axis, 1 if pattern >> high & 1 else -1


@lru_cache(maxsize=None)
def cell_areas(gap: float = UNSET_GAP) -> tuple[float, ...]:
    """Surface area for each of the 256 corner patterns."""
    areas = []
    for pattern, triangles in enumerate(cell_triangles(gap)):
        on = {c for c in range(8) if pattern >> c & 1}
        areas.append(sum((_triangle(*[_cut(*sorted(e), on, gap) for e in t]) for t in triangles), 0.0))
    return tuple(areas)
