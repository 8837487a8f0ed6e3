"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import numpy as np


class Groups:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near_groups(rows, width, percent):
    """Component of each id and its number of shingles."""
    sets = {i: shingles(t, width) for i, t in rows}
    groups, ids = Groups(sets), sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                groups.join(a, b)
    return {i: (groups.root(i), len(sets[i])) for i in ids}


def vector_links(rows, limit):
    """Links and component of each id."""
    good = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            w = np.array(v, dtype=float)
            good[i] = w / np.linalg.norm(w)
    groups, links = Groups([i for i, _ in rows]), {i: 0 for i, _ in rows}
    ids = sorted(good)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if len(good[a]) == len(good[b]) and good[a] @ good[b] >= limit:
                links[a] += 1
                links[b] += 1
                groups.join(a, b)
    return {i: (links[i], groups.root(i)) for i, _ in rows}


def water_levels(sizes, weights, most):
    """Targets of named sizes: round after round, what exceeds a cap is shared among the others."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if share[s] > most * sizes[s] + 1e-9]
        if not above:
            return fixed | share
        fixed |= {s: most * sizes[s] for s in above}
