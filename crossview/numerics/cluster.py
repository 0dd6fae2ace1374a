"""Hierarchical clustering: Ward by nearest-neighbour chains, and HDBSCAN with excess of mass."""

from __future__ import annotations

import numpy as np


def _squared(x: np.ndarray) -> np.ndarray:
    s = (x * x).sum(1)
    return np.maximum(s[:, None] + s[None, :] - 2 * x @ x.T, 0)


def ward_merges(x: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges (a, b, height) in ascending height; a and b are members of the merged clusters."""
    n = len(x)
    d = _squared(np.asarray(x, float))
    np.fill_diagonal(d, np.inf)
    size, alive, chain, out = np.ones(n), np.ones(n, bool), [], []
    for _ in range(n - 1):
        if not chain:
            chain.append(int(np.flatnonzero(alive)[0]))
        while True:
            a = chain[-1]
            row = np.where(alive, d[a], np.inf)
            b = int(np.argmin(row))
            if len(chain) > 1 and row[chain[-2]] <= row[b]:
                b = chain[-2]
            if len(chain) > 1 and b == chain[-2]:
                break
            chain.append(b)
        a, b = chain.pop(), chain.pop()
        a, b = min(a, b), max(a, b)
        out.append((a, b, float(np.sqrt(d[a, b]))))
        others = alive.copy()
        others[[a, b]] = False
        na, nb, nk = size[a], size[b], size[others]
        new = ((na + nk) * d[a, others] + (nb + nk) * d[b, others] - nk * d[a, b]) / (na + nb + nk)
        d[a, others] = d[others, a] = new
        alive[b] = False
        size[a] += nb
    return sorted(out, key=lambda m: m[2])


def _cut(n: int, merges: list[tuple[int, int, float]]) -> np.ndarray:
    """Labels 0, 1, ... in the order of each cluster's first row."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b, _ in merges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    names: dict[int, int] = {}
    return np.array([names.setdefault(find(i), len(names)) for i in range(n)], int)


def ward_by_distance(x: np.ndarray, threshold: float) -> np.ndarray:
    """Clusters whose merges stay below the threshold."""
    return _cut(len(x), [m for m in ward_merges(x) if m[2] < threshold])


def ward_by_count(x: np.ndarray, k: int) -> np.ndarray:
    merges = ward_merges(x)
    return _cut(len(x), merges[: max(0, len(x) - max(1, k))])


def hdbscan(x: np.ndarray, min_size: int) -> np.ndarray:
    """Labels from 0 on, -1 for noise.

    Core distances (the distance to the ``min_size``-th point, itself included),
    a minimum spanning tree of mutual reachability, the condensed tree, and the
    clusters with the most excess of mass; the root is never a cluster. What
    meets at one distance meets at once, so equal distances need no order.
    """
    n = len(x)
    if n < 2:
        return np.full(n, -1)
    d = distances(x)
    k = min(min_size, n)
    core = np.partition(d, k - 1, axis=1)[:, k - 1]
    return excess_of_mass(n, *reachability_tree(d, core), min_size)


def distances(x: np.ndarray, cuts: tuple[int, ...] = ()) -> np.ndarray:
    """Euclidean distances of all pairs, made a few rows at a time beside the result; what rounding cannot tell from 0 is 0.

    With ``cuts`` the products are taken for each two blocks between them, so that blocks have the same distances to the last
    bit whatever other blocks they are beside.
    """
    x = np.asarray(x, float)
    s, d, at = (x * x).sum(1), np.empty((len(x), len(x))), [0, *cuts, len(x)]
    blocks = [slice(i, j) for i, j in zip(at, at[1:], strict=False) if j > i]
    for k, i in enumerate(blocks):
        for j in blocks[k:]:
            d[i, j] = x[i] @ x[j].T
            d[j, i] = d[i, j].T
    for k in range(0, len(x), 256):
        total = s[k : k + 256, None] + s[None, :]
        square = total - 2 * d[k : k + 256]
        d[k : k + 256] = np.sqrt(np.where(square > 1e-13 * total, square, 0))
    np.fill_diagonal(d, 0)
    return d


def reachability_tree(d: np.ndarray, core: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights and ends of a minimum spanning tree of mutual reachability, from distances and core distances; ``d`` is overwritten."""
    n = len(d)
    reach = np.maximum(np.maximum(d, core[:, None], out=d), core[None, :], out=d)
    inside, best, near, edges = np.zeros(n, bool), np.full(n, np.inf), np.zeros(n, int), []
    at = 0
    for _ in range(n - 1):
        inside[at] = True
        closer = (reach[at] < best) & ~inside
        best[closer], near[closer] = reach[at][closer], at
        nxt = int(np.argmin(np.where(inside, np.inf, best)))
        edges.append((float(best[nxt]), int(near[nxt]), nxt))
        at = nxt
    w, a, b = zip(*edges, strict=True) if edges else ((), (), ())
    return np.array(w, float), np.array(a, int), np.array(b, int)


def excess_of_mass(n: int, weight: np.ndarray, a: np.ndarray, b: np.ndarray, min_size: int) -> np.ndarray:
    """Labels of ``n`` points from edges that hold a minimum spanning tree; of other edges those that close a circle are passed over."""
    if n < 2:
        return np.full(n, -1)
    by = np.lexsort((b, a, weight))
    edges = zip(weight[by].tolist(), a[by].tolist(), b[by].tolist(), strict=True)
    # Single-linkage tree: a node from n on joins all that meet at one distance, whichever of equal edges are in the tree.
    root, node, size, kids, height = list(range(n)), list(range(n)), [1] * n, {}, {}

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for w, a, b in edges:
        a, b = find(a), find(b)
        if a == b:
            continue
        small, big = sorted((node[a], node[b]), key=lambda t: (height.get(t) == w, len(kids.get(t, ()))))
        if height.get(big) != w:
            kids[len(size)], height[len(size)] = [small, big], w
            big = len(size)
            size.append(size[node[a]] + size[node[b]])
        else:
            kids[big] += kids[small] if height.get(small) == w else [small]
            size[big] += size[small]
        root[b] = a
        node[a] = big
    # Condensed tree: a split counts where two or more sides have min_size points or more.
    top = node[find(0)]
    birth, death_mass, parts, points, stack, fresh = {0: 0.0}, {0: 0.0}, {0: []}, {0: []}, [(top, 0)], 1
    while stack:
        t, c = stack.pop()
        if t < n:
            points[c].append(t)
            continue
        level = 1 / height[t] if height[t] > 0 else np.inf
        large = [s for s in kids[t] if size[s] >= min_size]
        lost = size[t] - (size[large[0]] if len(large) == 1 else 0)
        if lost:
            death_mass[c] += _mass(level, birth[c], lost)
        for s in kids[t]:
            if size[s] < min_size:
                points[c] += _leaves(s, n, kids)
            elif len(large) == 1:
                stack.append((s, c))
            else:
                birth[fresh], death_mass[fresh], parts[fresh], points[fresh] = level, 0.0, [], []
                parts[c].append(fresh)
                stack.append((s, fresh))
                fresh += 1
    value, picked = dict(death_mass), {}
    for c in range(fresh - 1, -1, -1):
        below = sum(value[p] for p in parts[c])
        picked[c] = c != 0 and not (parts[c] and below > death_mass[c])
        if not picked[c]:
            value[c] = below if parts[c] else death_mass[c]
    labels, names = np.full(n, -1), {}

    def give(c: int, owner: int | None) -> None:
        todo = [(c, owner)]
        while todo:
            c, owner = todo.pop()
            owner = c if owner is None and picked[c] else owner
            if owner is not None:
                labels[points[c]] = owner
            todo += [(p, owner) for p in parts[c]]

    give(0, None)
    for i in range(n):
        if labels[i] >= 0:
            labels[i] = names.setdefault(labels[i], len(names))
    return labels


def _mass(level: float, born: float, count: int) -> float:
    if np.isinf(level) and np.isinf(born):
        return 0.0
    return (min(level, 1e12) - born) * count


def _leaves(t: int, n: int, tree: dict) -> list[int]:
    out, todo = [], [t]
    while todo:
        t = todo.pop()
        if t < n:
            out.append(t)
        else:
            todo += tree[t]
    return out
