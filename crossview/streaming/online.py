"""Live ground-plane locations: global ids that follow behaviors from batch to batch, by place.

A place's state is small (mean vectors, recent locations, members) and changes
in steps that depend on each other, so it is one value in the state store, keyed by
place; ids and re-initialisation of one place do not touch another.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np

from ..config import AppConfig
from ..numerics import paths as P
from ..numerics.assignment import assign
from ..operators.clustering import Behavior, appearance, cluster, coexisting_groups, mean_embeddings, stitch_clusters, suppress_overlaps


@dataclass
class Tracked:
    """A global id of a place: unit mean vector, members, locations by time (microseconds); negative ids are shadows."""

    embedding: np.ndarray
    keys: set[str] = field(default_factory=set)
    locations: dict[int, tuple[float, float]] = field(default_factory=dict)
    object_type: str | None = None


@dataclass
class PlaceState:
    tracked: dict[int, Tracked] = field(default_factory=dict)
    next_id: int = 1
    clusters: int | None = None
    assigned_ratio: float = 1.0


def needs_init(state: PlaceState, live: list[Behavior], config: AppConfig) -> bool:
    """No confirmed id yet; or the set number of clusters has drifted; or too few live behaviors are assigned."""
    p, c = config.preprocessing, config.clustering
    confirmed = [g for g in state.tracked if g >= 0]
    if not confirmed:
        return True
    if c.overwrittenNumClusters is not None and p.mtmcPlusReinitDiffRatioClusters is not None:
        if abs(len(confirmed) - c.overwrittenNumClusters) / c.overwrittenNumClusters > p.mtmcPlusReinitDiffRatioClusters:
            return True
    return bool(live) and state.assigned_ratio < p.mtmcPlusReinitRatioAssignedBehaviors


def buffer_ready(live: list[Behavior], config: AppConfig) -> bool:
    """Whether live behaviors span more than the initial buffer."""
    return bool(live) and max(b.end for b in live) - min(b.start for b in live) > config.preprocessing.mtmcPlusInitBufferLenSec * 1e6


def initialise(state: PlaceState, live: list[Behavior], config: AppConfig) -> None:
    """Cluster all live behaviors anew and carry ids over by shared members."""
    rows, labels = cluster(live, config.clustering)
    names = sorted({int(k) for k in labels if k >= 0})
    sets = [{b.key for b, k in zip(rows, labels, strict=True) if k == n} for n in names]
    ids, state.next_id = stitch_clusters(sets, {g: t.keys for g, t in state.tracked.items()}, state.next_id)
    means = mean_embeddings(np.array([b.embedding for b in rows], float), np.asarray(labels)) if rows else {}
    old = state.tracked
    state.tracked = {g: Tracked(means[n], keys, dict(old[g].locations) if g in old else {}) for g, n, keys in zip(ids, names, sets, strict=True) if n in means}


def match(state: PlaceState, live: list[Behavior], config: AppConfig) -> dict[str, int]:
    """The global id of each live behavior, with shadows for new people; members of an id are unique within a group."""
    c = config.clustering
    rows = sorted(live, key=lambda b: b.order)
    held = {k: g for g, t in state.tracked.items() for k in t.keys}
    if not rows or not state.tracked:
        return {}
    if c.skipAssignedBehaviors and all(b.key in held for b in rows):
        return {b.key: held[b.key] for b in rows}
    names = sorted(state.tracked)
    embeddings = np.array([b.embedding for b in rows], float)
    looks = appearance(embeddings, np.array([state.tracked[g].embedding for g in names]))
    for i, b in enumerate(rows):
        if b.key in held:  # what is matched stays
            looks[i] = [0.0 if g == held[b.key] else 1.0 for g in names]
    places = {g: _latest(state.tracked[g]) for g in names}
    near = np.full(looks.shape, np.nan)
    for i, b in enumerate(rows):
        own, way = (b.path[-1], b.path[-1] - b.path[0]) if len(b.path) else (None, None)
        for j, g in enumerate(names):
            if own is not None and places[g] is not None:
                near[i, j] = P.directed(own, places[g][0], way, places[g][1], c.spatioTemporalDirMagnitudeThresh)
    hard = c.enableOnlineSpatioTemporalConstraint and c.onlineSpatioTemporalDistThresh is not None
    groups = coexisting_groups(rows)
    grouped = {i for g in groups for i in g}
    out: dict[int, int] = {}
    for g in [*groups, *[[i] for i in range(len(rows)) if i not in grouped]]:
        far = np.nanmax(near[g]) if np.isfinite(near[g]).any() else 0.0
        st = np.where(np.isnan(near[g]), 1.0, near[g] / far if far > 0 else 0.0)
        cost = c.spatioTemporalDistLambda * st + (1 - c.spatioTemporalDistLambda) * looks[g]
        if hard:
            cost = np.where(near[g] >= c.onlineSpatioTemporalDistThresh, 1.0, cost)
        todo, free = list(range(len(g))), list(range(len(names)))
        if hard:  # very close ones first, each id once
            for j in range(len(names)):
                a = min(todo, key=lambda a: cost[a, j], default=None)
                if a is not None and 0 < cost[a, j] < c.reassignmentDistTightThresh:
                    out.setdefault(g[a], names[j])
                    todo.remove(a)
                    free.remove(j)
        if not todo or not free:
            continue
        part = cost[np.ix_(todo, free)]
        r, k = (np.array([0]), np.array([int(np.argmin(part[0]))])) if len(todo) == 1 else assign(part)
        for a, b in zip(r, k, strict=True):
            if part[a, b] <= part[a].min() and part[a, b] < c.reassignmentDistLooseThresh:
                out.setdefault(g[todo[a]], names[free[b]])
    if c.suppressOverlappingBehaviors and out:
        use = sorted(out)
        fixed = suppress_overlaps(np.array([names.index(out[i]) for i in use]), [[use.index(i) for i in g if i in out] for g in groups], embeddings[use])
        out = {i: names[k] for i, k in zip(use, fixed, strict=True)}
    if c.enableOnlineDynamicUpdate:
        out |= _shadows(state, rows, [i for i in range(len(rows)) if i not in out], embeddings, config)
    return {rows[i].key: g for i, g in out.items()}


def _latest(t: Tracked) -> tuple[np.ndarray, np.ndarray] | None:
    if not t.locations:
        return None
    times = sorted(t.locations)
    first, last = np.array(t.locations[times[0]]), np.array(t.locations[times[-1]])
    return last, last - first


def _shadows(state: PlaceState, rows: list[Behavior], left: list[int], embeddings: np.ndarray, config: AppConfig) -> dict[int, int]:
    """New negative ids for behaviors without one: those that look and stand alike on different sensors share it."""
    c = config.clustering
    root = {i: i for i in left}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(left):
        for j in left[n + 1 :]:
            a, b = rows[i], rows[j]
            if a.sensor == b.sensor or not len(a.path) or not len(b.path):
                continue
            alike = appearance(embeddings[i : i + 1], embeddings[j : j + 1])[0, 0] < c.dynamicUpdateAppearanceDistThresh
            if alike and float(np.linalg.norm(a.path[-1] - b.path[-1])) < c.dynamicUpdateSpatioTemporalDistThresh:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    fresh = min([0, *state.tracked]) - 1
    ids: dict[int, int] = {}
    out = {}
    for i in left:
        r = find(i)
        if r not in ids:
            ids[r], fresh = fresh, fresh - 1
        out[i] = ids[r]
    return out


def update_means(state: PlaceState, rows: list[Behavior], ids: dict[str, int], rate: float, dynamic: bool) -> None:
    """Moving averages of the ids' vectors; ids without new members stay; shadows are added if they are enabled."""
    own: dict[int, list[np.ndarray]] = defaultdict(list)
    for b in rows:
        if b.key in ids:
            own[ids[b.key]].append(b.embedding)
    for g, vectors in own.items():
        total = np.sum(vectors, axis=0)
        n = np.linalg.norm(total)
        if not n:
            continue
        if g in state.tracked:
            mixed = (1 - rate) * state.tracked[g].embedding + rate * total / n
            state.tracked[g].embedding = mixed / (np.linalg.norm(mixed) or 1.0)
        elif dynamic:
            state.tracked[g] = Tracked(total / n)


@dataclass
class Located:
    """Where the ids of a batch are: the newest end and frame, and each id's place, type and members."""

    newest: int
    frame_id: int
    places: dict[int, tuple[float, float]]
    types: dict[int, str]
    keys: dict[int, list[str]]


def located(rows: list[Behavior], ids: dict[str, int], window_us: int) -> Located:
    """Each id's weighted mean of its members' points in the window before the newest end (the older end not included)."""
    newest = max((b.end for b in rows), default=0)
    points: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
    types: dict[int, str] = {}
    keys: dict[int, list[str]] = defaultdict(list)
    for b in sorted(rows, key=lambda b: b.order):
        if b.key not in ids:
            continue
        g = ids[b.key]
        if types.setdefault(g, b.object_type) != b.object_type:
            raise ValueError(f"id {g} has objects of two types: {types[g]} and {b.object_type}")
        keys[g].append(b.key)
        use = (b.times > newest - window_us) & (b.times <= newest)
        weights = np.ones(len(b.path)) if b.weights is None else b.weights
        points[g].append((b.path[use], weights[use]))
    places = {}
    for g, parts in points.items():
        path, weights = np.concatenate([p for p, _ in parts]), np.concatenate([w for _, w in parts])
        if len(path) and weights.sum() > 0:
            places[g] = tuple(float(x) for x in weights @ path / weights.sum())
    return Located(newest, max((b.end_frame for b in rows), default=0), places, {g: types[g] for g in places}, {g: keys[g] for g in places})


def step(state: PlaceState, live: list[Behavior], config: AppConfig) -> dict | None:
    """One batch of a place: (re-)initialise or match, move the state on, and give the row of locations.

    None while a first clustering waits for enough behaviors. Ids without a place in this batch have none in its row.
    """
    s, p, c = config.streaming, config.preprocessing, config.clustering
    if needs_init(state, live, config):
        if not buffer_ready(live, config) or len(live) < (c.overwrittenNumClusters or 1):
            return None
        initialise(state, live, config)
        ids = {k: g for g, t in state.tracked.items() for k in t.keys}
    else:
        ids = match(state, live, config)
        update_means(state, live, ids, c.meanEmbeddingsUpdateRate, c.enableOnlineDynamicUpdate)
        for t in state.tracked.values():
            t.keys = set()
        for key, g in ids.items():
            if g in state.tracked:
                state.tracked[g].keys.add(key)
    matched = {k for k, g in ids.items() if g >= 0}
    at = located(live, ids, int(s.mtmcPlusLocationWindowSec * 1e6))
    current: dict[int, int] = {}  # the ids of this batch, and what they are called from now on
    for g in sorted(at.places):
        if g not in state.tracked:
            continue
        t = state.tracked[g]
        if t.object_type is None:
            t.object_type = at.types[g]
        if t.object_type != at.types[g]:
            raise ValueError(f"id {g} changed its type: {t.object_type}, then {at.types[g]}")
        t.locations[at.newest] = at.places[g]
        current[g] = g
        if c.enableOnlineDynamicUpdate and g < 0 and at.newest > min(t.locations) + c.dynamicUpdateLengthThreshSec * 1e6:
            current[g] = state.next_id  # a shadow that has lasted becomes an id
            state.tracked[state.next_id] = state.tracked.pop(g)
            state.next_id += 1
    rows, counts = {}, defaultdict(int)
    smooth = int(s.mtmcPlusSmoothingWindowSec * 1e6)
    for old, g in sorted(current.items(), key=lambda x: x[1]):
        t = state.tracked[g]
        if g >= 0:
            recent = [v for k, v in t.locations.items() if k > max(t.locations) - smooth]
            rows[g] = {"type": t.object_type, "at": tuple(float(x) for x in np.mean(recent, axis=0)), "keys": at.keys[old]}
            counts[t.object_type] += 1
    keep = int(p.mtmcPlusRetentionInStateSec * 1e6)
    for g in list(state.tracked):
        t = state.tracked[g]
        t.locations = {k: v for k, v in t.locations.items() if at.newest - k <= keep}
        if not t.locations and not t.keys:
            del state.tracked[g]
    state.assigned_ratio = len(matched & {b.key for b in live}) / max(1, len(live))
    return {"timestamp_us": at.newest, "frame_id": at.frame_id, "counts": dict(sorted(counts.items())), "objects": rows}
