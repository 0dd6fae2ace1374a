"""Minimum-cost assignment by shortest augmenting paths with potentials."""

from __future__ import annotations

import numpy as np


def assign(cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a minimum-cost assignment of min(rows, columns) pairs, in ascending rows."""
    cost = np.asarray(cost, float)
    if cost.ndim != 2 or not cost.size:
        return np.empty(0, int), np.empty(0, int)
    if not np.isfinite(cost).all():
        raise ValueError("costs must be finite")
    if cost.shape[0] > cost.shape[1]:
        c, r = assign(cost.T)
        order = np.argsort(r)
        return r[order], c[order]
    n, m = cost.shape
    u, v, owner = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        owner[0], j = i, 0
        least, came, seen = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while True:
            seen[j] = True
            free = ~seen
            free[0] = False
            reduced = cost[owner[j] - 1] - u[owner[j]] - v[1:]
            better = np.r_[False, reduced < least[1:]] & free
            least[1:][better[1:]] = reduced[better[1:]]
            came[better] = j
            k = int(np.argmin(np.where(free, least, np.inf)))
            delta = least[k]
            u[owner[seen]] += delta
            v[seen] -= delta
            least[free] -= delta
            j = k
            if owner[j] == 0:
                break
        while j:
            owner[j] = owner[came[j]]
            j = came[j]
    pairs = sorted((owner[j] - 1, j - 1) for j in range(1, m + 1) if owner[j])
    return np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)


def exclusive_groups(cost: np.ndarray, groups: list[list[int]], limit: int = 2_000_000) -> np.ndarray | None:
    """Give each row the column of least total cost so that rows of one group have different columns.

    Rows that clash with none take their best column; each connected set of clashing rows is solved on its own,
    exactly, by branch and bound. None if no such choice exists; an error if a set needs more than ``limit`` nodes.
    """
    n = len(cost)
    clash: list[set[int]] = [set() for _ in range(n)]
    for g in groups:
        for a in g:
            clash[a].update(x for x in g if x != a)
    out, seen = cost.argmin(1) if n else np.empty(0, int), np.zeros(n, bool)
    for start in range(n):
        if seen[start] or not clash[start]:
            continue
        own, todo = [], [start]
        seen[start] = True
        while todo:
            i = todo.pop()
            own.append(i)
            fresh = [x for x in clash[i] if not seen[x]]
            seen[fresh] = True
            todo += fresh
        chosen = _exclusive(cost, sorted(own), clash, limit)
        if chosen is None:
            return None
        for i, c in chosen.items():
            out[i] = c
    return out


def _exclusive(cost: np.ndarray, rows: list[int], clash: list[set[int]], limit: int) -> dict[int, int] | None:
    """Branch and bound over connected rows: next the row with the fewest columns left, its cheapest column first."""
    columns, nodes = cost.shape[1], 0
    best, chosen = np.inf, None
    pick: dict[int, int] = {}

    def left(i: int) -> list[int]:
        used = {pick[x] for x in clash[i] if x in pick}
        return [c for c in range(columns) if c not in used]

    # One entry for each row given a column: (row, columns still to try, cost before it).
    stack: list[tuple[int, list[int], float]] = []

    def bound(total: float) -> float:
        return total + sum(min((cost[i, c] for c in left(i)), default=np.inf) for i in rows if i not in pick)

    def descend(total: float) -> None:
        i = min((r for r in rows if r not in pick), key=lambda r: (len(left(r)), -len(clash[r]), r))
        stack.append((i, sorted(left(i), key=lambda c: (cost[i, c], c)), total))

    descend(0.0)
    while stack:
        i, choices, before = stack[-1]
        pick.pop(i, None)
        if not choices:
            stack.pop()
            continue
        nodes += 1
        if nodes > limit:
            raise RuntimeError(f"{len(rows)} behaviors overlap in one chain; their identities need over {limit} trials to be told apart")
        c = choices.pop(0)
        pick[i] = c
        total = before + cost[i, c]
        if bound(total) >= best:
            continue
        if len(pick) == len(rows):
            best, chosen = total, dict(pick)
        else:
            descend(total)
    return chosen
