"""Anchors-hierarchy metric trees over vectors of whole numbers, and one assignment pass through them.

Built from the middle out.  About sqrt(n) anchors are placed one after another, each at the point
farthest from its anchor; a new anchor steals only points farther from their anchor than half the
distance between the two anchors.  Anchors are then merged pairwise, closest balls first, up to the
root, and the points of each anchor are divided the same way downwards.  Every ball caches the sum
and the number of its points.

In a pass all balls of one level are compared with their candidate entries at once.  An entry z' is
struck off for a ball (centre c, radius R) when |c - z'|^2 - |c - z|^2 - 2 R |z - z'| > 0 for the entry
z nearest to c: then no point in the ball is as near to z' as to z.  Children inherit the shorter
list; a ball with one candidate left is owned whole and adds its cached sum and count.  Distances
only strike off (with slack for rounding); points of mixed leaves are compared in whole numbers, so
results, ties included, are those of a comparison with every entry.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 32
# Relative to the squares compared; far above the rounding of float64, far below any gap that matters for speed.
SLACK = 1e-9
_HALF = 1 << 62


@dataclass
class Balls:
    """A tree over points in ``order``; every ball owns order[start:stop], leaves have no children."""

    order: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    left: np.ndarray
    right: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    total: np.ndarray


def _norm(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(-1))


def _place(x: np.ndarray, k: int) -> np.ndarray:
    """The anchor (0 .. k-1 at most) that owns each point."""
    owner, pivots = np.zeros(len(x), dtype=np.int64), [0]
    near = _norm(x - x[0])
    while len(pivots) < k:
        far = int(near.argmax())
        if not near[far] > 0:
            break
        apart = _norm(x[pivots] - x[far])
        # Points nearer to their anchor than half way to the new one cannot change hands.
        maybe = np.flatnonzero(near >= apart[owner] / 2)
        d = _norm(x[maybe] - x[far])
        stolen = d < near[maybe]
        owner[maybe[stolen]], near[maybe[stolen]] = len(pivots), d[stolen]
        pivots.append(far)
    return owner


class _Builder:
    def __init__(self, x: np.ndarray):
        self.x, self.nodes = x, []

    def ball(self, members: np.ndarray) -> int:
        centre = self.x[members].mean(0)
        self.nodes.append((centre, _norm(self.x[members] - centre).max(initial=0.0), members, -1, -1))
        return len(self.nodes) - 1

    def merge(self, a: int, b: int) -> int:
        (ca, ra, ma, *_), (cb, rb, mb, *_) = self.nodes[a], self.nodes[b]
        centre = (ca * len(ma) + cb * len(mb)) / (len(ma) + len(mb))
        members = np.concatenate([ma, mb])
        exact, bound = _norm(self.x[members] - centre).max(), max(_norm(ca - centre) + ra, _norm(cb - centre) + rb)
        self.nodes.append((centre, min(exact, bound), members, a, b))
        return len(self.nodes) - 1

    def grow(self, members: np.ndarray) -> int:
        """The root of a tree over the members."""
        if len(members) <= LEAF:
            return self.ball(members)
        owner = _place(self.x[members], int(np.ceil(np.sqrt(len(members)))))
        parts = [members[owner == k] for k in range(int(owner.max()) + 1)]
        parts = [p for p in parts if len(p)]
        if len(parts) == 1:  # copies of one point
            return self.ball(members)
        roots = [self.grow(p) if len(p) < len(members) else self.ball(p) for p in parts]
        centres, radii = np.stack([self.nodes[r][0] for r in roots]), np.array([self.nodes[r][1] for r in roots])
        cost = _norm(centres[:, None] - centres[None]) + radii[:, None] + radii[None]
        np.fill_diagonal(cost, np.inf)
        cost[np.isnan(cost)] = np.finfo(float).max
        for _ in range(len(roots) - 1):
            i, j = divmod(int(cost.argmin()), len(roots))
            roots[i] = self.merge(roots[i], roots[j])
            cost[j], cost[:, j] = np.inf, np.inf
            centres[i], radii[i] = self.nodes[roots[i]][0], self.nodes[roots[i]][1]
            alive = np.isfinite(cost[i]) & (np.arange(len(roots)) != i)
            row = _norm(centres[alive] - centres[i]) + radii[alive] + radii[i]
            cost[i, alive] = cost[alive, i] = np.where(np.isfinite(row), row, np.finfo(float).max)
            top = roots[i]
        return top


def build(points: np.ndarray) -> Balls:
    """The tree of one block of points (whole numbers, n x w, n above 0)."""
    x = points.astype(float)
    builder = _Builder(x)
    with np.errstate(all="ignore"):
        root = builder.grow(np.arange(len(x)))
    # Numbered from the root down, children behind parents, points in the order of the leaves.
    ids, at, order, spans = [root], 0, [], {}
    while at < len(ids):
        ids += [c for c in builder.nodes[ids[at]][3:] if c >= 0]
        at += 1
    new = {node: i for i, node in enumerate(ids)}

    stack = [(root, False)]
    while stack:
        node, done = stack.pop()
        _, _, members, a, b = builder.nodes[node]
        if a < 0:
            spans[node] = (len(order), len(order) + len(members))
            order += members.tolist()
        elif done:
            spans[node] = (spans[a][0], spans[b][1])
        else:
            stack += [(node, True), (b, False), (a, False)]
    order = np.array(order, dtype=np.int64)
    upto = np.concatenate([np.zeros((1, points.shape[1]), dtype=points.dtype), np.cumsum(points[order], axis=0, dtype=points.dtype)])
    start, stop = (np.array([spans[i][k] for i in ids], dtype=np.int64) for k in (0, 1))
    child = lambda k: np.array([new.get(builder.nodes[i][k], -1) for i in ids], dtype=np.int64)
    return Balls(order, start, stop, child(3), child(4), np.stack([builder.nodes[i][0] for i in ids]),
                 np.array([builder.nodes[i][1] for i in ids], dtype=float), upto[stop] - upto[start])


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (n x k) of whole numbers, beyond 64 bits too."""
    most = max((int(abs(a).max()) for a in (points, entries) if a.size), default=0)
    if (2 * most) ** 2 * max(points.shape[-1], 1) >= _HALF:
        points, entries = points.astype(object), entries.astype(object)
    gap = points[:, None] - entries[None]
    return (gap * gap).sum(-1)


def assign(points: np.ndarray, balls: Balls, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Per point its nearest entry (ties to the lower), per entry sum and count, and how many points were compared singly."""
    k = len(entries)
    nearest = np.zeros(len(points), dtype=np.int64)
    sums, counts = np.zeros(entries.shape, dtype=balls.total.dtype), np.zeros(k, dtype=np.int64)
    z = entries.astype(float)
    singles: list[tuple[np.ndarray, np.ndarray]] = []
    with np.errstate(all="ignore"):
        between = _norm(z[:, None] - z[None])
        scale = (z * z).sum(-1).max(initial=0.0)
        level, held = np.zeros(1, dtype=np.int64), np.ones((1, k), dtype=bool)
        while len(level):
            c, r = balls.centre[level], balls.radius[level]
            d = ((c[:, None] - z[None]) ** 2).sum(-1)
            best = np.where(held, d, np.inf).argmin(1)
            rows = np.arange(len(level))
            gap = d - d[rows, best][:, None] - 2 * r[:, None] * between[best]
            slack = SLACK * (d.max(1) + r * r + scale + (c * c).sum(1))
            held &= ~(gap > slack[:, None])
            whole = held.sum(1) == 1
            owner = held.argmax(1)
            np.add.at(sums, owner[whole], balls.total[level[whole]])
            size = balls.stop[level] - balls.start[level]
            np.add.at(counts, owner[whole], size[whole])
            for node, entry in zip(level[whole], owner[whole]):
                nearest[balls.order[balls.start[node] : balls.stop[node]]] = entry
            leaf = balls.left[level] < 0
            for i in np.flatnonzero(~whole & leaf):
                at = balls.order[balls.start[level[i]] : balls.stop[level[i]]]
                singles.append((at, np.broadcast_to(held[i], (len(at), k))))
            deeper = ~whole & ~leaf
            level = np.concatenate([balls.left[level[deeper]], balls.right[level[deeper]]])
            held = np.concatenate([held[deeper], held[deeper]])
    if singles:
        at, mask = np.concatenate([a for a, _ in singles]), np.concatenate([m for _, m in singles])
        d = squares(points[at], entries)
        d[~mask] = d.max() + 1 if d.size else 0
        own = d.argmin(1)
        nearest[at] = own
        np.add.at(sums, own, points[at])
        np.add.at(counts, own, 1)
    return nearest, sums, counts, sum(len(a) for a, _ in singles)
