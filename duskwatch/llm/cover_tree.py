"""Cover trees over norm-augmented vectors, searched best first by inner product.

A vector x of a block is lengthened by sqrt(M - x.x), M being the greatest x.x of the block, so
that all lie on a sphere and a large inner product is a small distance.  A node covers its
descendants within a radius, its children within a smaller one (each level shrinks the cover by
``SHRINK``); with the distance to the farthest descendant, |q.x - q.c| <= |q| r bounds every inner
product below a node from both sides.  Points that are a child of their own are held by the
parent, so a node is a bucket of points and a row of children.
"""

from __future__ import annotations

import io

import numpy as np

SHRINK = 1.3
BUCKET = 16  # points that are not divided further
EXACT = 2**53  # integers below are exact in floating point
_NONE = np.iinfo(np.int64).min


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products as 64-bit integers, through floating point where that is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most >= 2**63:
        raise ValueError("inner products of these vectors do not fit 64 bits")
    return a.astype(np.int64) @ b.T.astype(np.int64)


class CoverTree:
    """Arrays by point (in bucket order) and by node (children of a node are consecutive)."""

    def __init__(self, ids, labels, vectors, centre, radius, points, kids) -> None:
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.centre, self.radius, self.points, self.kids = centre, radius, points, kids

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> CoverTree:
        x = vectors.astype(np.float64)
        square = (x**2).sum(1)
        grown = np.column_stack((x, np.sqrt(np.maximum(0, square.max(initial=0) - square))))
        order, centre, radius, points, kids = [], [], [], [], []
        waiting = [(np.arange(len(ids)), 0)] if len(ids) else []
        made = len(waiting)
        for members, c in waiting:  # breadth first; grows while it runs
            away = np.sqrt(((grown[members] - grown[members[c]]) ** 2).sum(1))
            reach = float(away.max())
            centre.append(x[members[c]])
            radius.append(reach)
            own, first = members, made
            if len(members) > BUCKET and reach > 0:
                own, left, at = [], np.arange(len(members)), c
                while len(left):  # cover all members with balls of the next level's radius
                    far = ((grown[members[left]] - grown[members[at]]) ** 2).sum(1)
                    covered = far <= (reach / SHRINK) ** 2
                    covered |= left == at
                    ball = members[left[covered]]
                    if len(ball) == 1:
                        own.append(ball)
                    else:
                        waiting.append((ball, int(np.flatnonzero(ball == members[at])[0])))
                        made += 1
                    left = left[~covered]
                    at = left[0] if len(left) else 0
                own = np.concatenate(own) if own else np.empty(0, dtype=np.int64)
            own = own[np.argsort(ids[own], kind="stable")]
            begun = sum(len(o) for o in order[-1:]) + (points[-1][0] if points else 0)
            points.append((begun, begun + len(own)))
            kids.append((first, made))
            order.append(own)
        at = np.concatenate(order) if order else np.empty(0, dtype=np.int64)
        width = vectors.shape[1]
        return cls(
            ids[at], labels[at], vectors[at], np.array(centre).reshape(len(centre), width),
            np.array(radius), np.array(points).reshape(-1, 2), np.array(kids).reshape(-1, 2),
        )

    def packed(self) -> bytes:
        most = int(np.abs(self.vectors).max(initial=0))
        small = next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max)
        out = io.BytesIO()
        np.savez(
            out, ids=self.ids, labels=self.labels, vectors=self.vectors.astype(small),
            centre=self.centre.astype(small if most <= 2**31 else np.float64),
            radius=self.radius, points=self.points, kids=self.kids,
        )
        return out.getvalue()

    @classmethod
    def unpacked(cls, raw: bytes) -> CoverTree:
        held = np.load(io.BytesIO(raw))
        tree = cls(**{name: held[name] for name in ("ids", "labels", "vectors", "centre", "radius", "points", "kids")})
        tree.vectors = tree.vectors.astype(np.int64)
        tree.centre = tree.centre.astype(np.float64)
        return tree

    def search(
        self, asks: np.ndarray, of: np.ndarray, own: np.ndarray, label: np.ndarray, low: np.ndarray,
        high: np.ndarray, k: int, same: bool, together: int = 32,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ``k`` best points of each window, as arrays (window, id, score).

        A window asks with row ``of`` of ``asks`` (ascending); best is largest score, then least
        id.  A point counts if its label is (or is not) the window's, its id is not its own and
        its score lies from low to high.  Each round opens the ``together`` most promising nodes of
        every window; a window is done when no node left can hold a score as good as its k-th.
        Scores are taken once for all windows that ask with one row.
        """
        n, nodes = len(of), len(self.radius)
        row_, id_, score_ = (np.empty(0, dtype=np.int64) for _ in range(3))
        if not nodes or not n:
            return row_, id_, score_
        q = asks.astype(np.float64)
        reach = np.sqrt((q**2).sum(1))
        most = float(np.abs(asks).max(initial=0)) * float(np.abs(self.vectors).max(initial=0)) * asks.shape[1]
        exact = most < EXACT  # then floating point gives the integers themselves
        held = self.vectors.astype(np.float64) if exact else self.vectors
        least = np.maximum(low, _NONE)  # the score that a point must reach by now
        front = np.full((n, nodes), -np.inf)  # upper bounds of nodes not opened
        front[:, 0] = np.inf
        while True:
            front[front < least[:, None]] = -np.inf
            if nodes > together:
                picked = np.argpartition(-front, together - 1, axis=1)[:, :together]
            else:
                picked = np.tile(np.arange(nodes), (n, 1))
            rows, places = np.nonzero(np.take_along_axis(front, picked, 1) > -np.inf)
            if not len(rows):
                break
            opened = picked[rows, places]
            front[rows, opened] = -np.inf
            order = np.argsort(opened, kind="stable")
            rows, opened = rows[order], opened[order]
            starts = np.flatnonzero(np.r_[True, opened[1:] != opened[:-1]])
            for begin, end in zip(starts, np.r_[starts[1:], len(opened)]):
                node, who = opened[begin], rows[begin:end]
                asker = of[who]  # ascending
                fresh = np.r_[True, asker[1:] != asker[:-1]]
                first, back = np.flatnonzero(fresh), np.cumsum(fresh) - 1
                base, many = asker[first], np.diff(np.r_[first, len(who)])
                a, b = self.kids[node]
                if b > a:
                    middle = q[base] @ self.centre[a:b].T
                    spread = reach[base, None] * self.radius[a:b]
                    slack = 1 + 1e-9 * (np.abs(middle) + spread)
                    upper, lower = (middle + spread + slack)[back], (middle - spread - slack)[back]
                    alive = (upper >= least[who, None]) & (lower <= high[who, None])
                    front[who, a:b] = np.where(alive, upper, -np.inf)
                a, b = self.points[node]
                if b > a:
                    scores = q[base] @ held[a:b].T if exact else products(asks[base], held[a:b])
                    bottom = np.minimum.reduceat(least[who], first)[:, None]
                    r, c = np.nonzero((scores >= bottom) & (scores <= np.maximum.reduceat(high[who], first)[:, None]))
                    score = scores[r, c].astype(np.int64)
                    # each hit to all windows that ask with its row
                    wide = many[r]
                    begun = np.cumsum(wide) - wide
                    window = who[np.repeat(first[r] - begun, wide) + np.arange(wide.sum())]
                    c, score = np.repeat(c, wide) + a, np.repeat(score, wide)
                    fits = (score >= least[window]) & (score <= high[window])
                    fits &= ((self.labels[c] == label[window]) == same) & (self.ids[c] != own[window])
                    row_ = np.concatenate((row_, window[fits]))
                    id_ = np.concatenate((id_, self.ids[c[fits]]))
                    score_ = np.concatenate((score_, score[fits]))
            order = np.lexsort((id_, -score_, row_))
            row_, id_, score_ = row_[order], id_[order], score_[order]
            place = np.arange(len(row_)) - np.searchsorted(row_, row_)
            kept = place < k
            row_, id_, score_, place = row_[kept], id_[kept], score_[kept], place[kept]
            full = place == k - 1
            least[row_[full]] = score_[full]
        return row_, id_, score_
