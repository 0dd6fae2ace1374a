"""Cross-camera identities: clustering of behaviors, reassignment of those that stand together, continuity of ids.

The behaviors of one batch (or of one place) are clustered together, so a batch
or place is one unit of work in Python. Only the columns that it needs go there:
key, sensor, start, end, embedding and locations.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame

from ..config import AGGLOMERATIVE, AppConfig, ClusteringConfig
from ..numerics import cluster as N
from ..numerics import paths as P
from ..numerics.assignment import assign, exclusive_groups


@dataclass
class Behavior:
    """What clustering knows of a behavior; times are integers (microseconds)."""

    key: str
    sensor: str
    object_id: str
    start: int
    end: int
    embedding: np.ndarray
    times: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    path: np.ndarray = field(default_factory=lambda: np.empty((0, 2)))
    weights: np.ndarray | None = None
    """Of each place in ``path``; None: all count alike."""
    object_type: str = ""
    end_frame: int = 0

    @property
    def order(self) -> tuple:
        """Start, sensor, then the object's number."""
        return (self.start, self.sensor, int(self.object_id) if self.object_id.lstrip("-").isdigit() else 0, self.key)

    def during(self, start: int, end: int) -> np.ndarray:
        return P.overlap(self.times, self.path, start, end) if len(self.times) else self.path[:0]


def coexisting_groups(rows: list[Behavior]) -> list[list[int]]:
    """Maximal sets of behaviors of one sensor that hold at one time, of two or more, in a fixed order."""
    out: set[tuple[int, ...]] = set()
    by_sensor: dict[str, list[int]] = defaultdict(list)
    for i, b in enumerate(rows):
        by_sensor[b.sensor].append(i)
    for own in by_sensor.values():
        # A set is maximal where an interval has just begun and the next event is an end.
        events = sorted([(rows[i].start, 0, i) for i in own] + [(rows[i].end, 1, i) for i in own])
        live: set[int] = set()
        grown = False
        for _, kind, i in events:
            if kind == 0:
                live.add(i)
                grown = True
            else:
                if grown and len(live) > 1:
                    out.add(tuple(sorted(live)))
                grown = False
                live.discard(i)
    return [list(g) for g in sorted(out)]


def appearance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Half of one minus the cosine for all pairs of unit vectors."""
    return np.clip(2 - 2 * a @ b.T, 0, 4) / 4


def mean_embeddings(embeddings: np.ndarray, labels: np.ndarray) -> dict[int, np.ndarray]:
    """Unit sums of each label's vectors; sums without length are left out."""
    out = {}
    for label in np.unique(labels[labels >= 0]):
        total = embeddings[labels == label].sum(0)
        n = np.linalg.norm(total)
        if n > 0:
            out[int(label)] = total / n
    return out


def cluster_embeddings(embeddings: np.ndarray, config: ClusteringConfig, at_least: int) -> np.ndarray:
    """Labels from 0 on, -1 for noise. Ward never makes fewer clusters than behaviors stand together."""
    if config.clusteringAlgo == AGGLOMERATIVE:
        k = config.overwrittenNumClusters
        if k is None:
            k = int(N.ward_by_distance(embeddings, config.agglomerativeClusteringDistThresh).max()) + 1
        return N.ward_by_count(embeddings, min(len(embeddings), max(k, at_least)))
    return N.hdbscan(embeddings, min(config.hdbscanMinClusterSize, len(embeddings)))


def path_distance(rows: list[Behavior], group: list[int], i: int, members: list[int], config: ClusteringConfig) -> float | None:
    """Distance of a behavior's way during its group's common time to the mean way of a cluster's members on other sensors
    that cover that time."""
    start, end = max(rows[g].start for g in group), min(rows[g].end for g in group)
    ways = [rows[m].during(start, end) for m in members if rows[m].sensor != rows[i].sensor and rows[m].start <= start and rows[m].end >= end]
    ways = [w for w in ways if len(w)]
    own = rows[i].during(start, end)
    if not ways or not len(own):
        return None
    return P.distance(own, P.average(ways), config.spatioTemporalDistType)


def reassign(rows: list[Behavior], labels: np.ndarray, groups: list[list[int]], embeddings: np.ndarray, config: ClusteringConfig) -> np.ndarray:
    """One round: each group is assigned to clusters by appearance and ways, then behaviors take the vote of their groups.

    An assignment counts only if it is its row's least cost and below the loose
    threshold; a behavior without any loses its label.
    """
    means = mean_embeddings(embeddings, labels)
    names = sorted(means)
    if not names:
        return labels
    looks = appearance(embeddings, np.array([means[k] for k in names]))
    members = {k: np.flatnonzero(labels == k).tolist() for k in names}
    votes: dict[int, Counter] = defaultdict(Counter)
    grouped = {i for g in groups for i in g}
    for g in [*groups, *[[i] for i in range(len(rows)) if i not in grouped and labels[i] >= 0]]:
        st = np.array([[np.nan if (d := path_distance(rows, g, i, members[k], config)) is None else d for k in names] for i in g])
        top = np.nanmax(st) if np.isfinite(st).any() else 0.0
        st = np.where(np.isnan(st), 1.0, st / (top + 1))
        lam = config.spatioTemporalDistLambda
        cost = lam * st + (1 - lam) * looks[g]
        r, c = (np.array([0]), np.array([int(np.argmin(cost[0]))])) if len(g) == 1 else assign(cost)
        for a, b in zip(r, c, strict=True):
            if cost[a, b] <= cost[a].min() and cost[a, b] < config.reassignmentDistLooseThresh:
                votes[g[a]][names[b]] += 1
    return np.array([min(votes[i], key=lambda k: (-votes[i][k], k)) if votes[i] else -1 for i in range(len(rows))])


def suppress_overlaps(labels: np.ndarray, groups: list[list[int]], embeddings: np.ndarray) -> np.ndarray:
    """Labels of least total appearance distance under which no two behaviors of a group share one; unchanged if there are none."""
    means = mean_embeddings(embeddings, labels)
    names, use = sorted(means), np.flatnonzero(labels >= 0)
    if not names or not len(use):
        return labels
    at = {i: k for k, i in enumerate(use)}
    own = [[at[i] for i in g if i in at] for g in groups]
    cost = appearance(embeddings[use], np.array([means[k] for k in names]))
    chosen = exclusive_groups(cost, [g for g in own if len(g) > 1])
    if chosen is None:
        return labels
    out = labels.copy()
    out[use] = [names[c] for c in chosen]
    return out


def cluster(rows: list[Behavior], config: ClusteringConfig) -> tuple[list[Behavior], np.ndarray]:
    """Behaviors in order and their global labels: none for none, label 1 for a single one, from 0 on otherwise."""
    rows = sorted(rows, key=lambda b: b.order)
    if not rows:
        return rows, np.empty(0, int)
    if len(rows) == 1:
        return rows, np.array([1])
    embeddings = np.array([b.embedding for b in rows], float)
    groups = coexisting_groups(rows)
    labels = cluster_embeddings(embeddings, config, max((len(g) for g in groups), default=1))
    for _ in range(config.numReassignmentIterations):
        new = reassign(rows, labels, groups, embeddings, config)
        if (new == labels).all():
            break
        labels = new
    if config.suppressOverlappingBehaviors:
        labels = suppress_overlaps(labels, groups, embeddings)
    return rows, labels


def behaviors_of(pdf: pd.DataFrame) -> list[Behavior]:
    micros = lambda t: int(pd.Timestamp(t).value // 1000)
    return [
        Behavior(r.key, r.sensor_id, str(r.object_id), micros(r.start), micros(r.end), np.array(r.embedding, float), np.array([micros(t) for t in (r.location_times if r.location_times is not None else [])], np.int64), np.array([list(p) for p in (r.locations if r.locations is not None else [])], float).reshape(-1, 2))
        for r in pdf.itertuples()
    ]


ASSIGNMENT = "{by} string, global_id long, key string, sensor_id string, object_id string, start timestamp, end timestamp"


def global_objects(behaviors: DataFrame, config: AppConfig, by: str) -> DataFrame:
    """A row for each behavior that belongs to a global object; all behaviors of a value of ``by`` are clustered together.

    ``behaviors``: key, sensor_id, object_id, start, end, embedding (unit), locations, location_times and ``by``.
    Rows are filtered before they come here, as Spark cannot do that through the Python step.
    """
    columns = ["key", "sensor_id", "object_id", "start", "end", "embedding", "locations", "location_times"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, labels = cluster(behaviors_of(pdf), config.clustering)
        info = pdf.set_index("key")
        kept = [(b.key, int(k)) for b, k in zip(rows, labels, strict=True) if k >= 0]
        own = info.loc[[k for k, _ in kept]]
        return pd.DataFrame({by: [str(pdf[by].iloc[0])] * len(kept), "global_id": [g for _, g in kept], "key": [k for k, _ in kept], "sensor_id": own.sensor_id.to_numpy(), "object_id": own.object_id.astype(str).to_numpy(), "start": own.start.to_numpy(), "end": own.end.to_numpy()})

    return behaviors.select(by, *columns).groupBy(by).applyInPandas(run, ASSIGNMENT.format(by=by))


def mtmc_objects(assignments: DataFrame, by: str) -> DataFrame:
    """A row for each global object: its time, and its members in order of their start."""
    from pyspark.sql import functions as F

    member = F.struct("start", "sensor_id", "object_id", "key", "end")
    return assignments.groupBy(by, "global_id").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_matched"), F.array_sort(F.collect_list(member)).alias("matched"))


def stitch_clusters(new: list[set[str]], state: dict[int, set[str]], next_id: int) -> tuple[list[int], int]:
    """Ids of new clusters by the keys that they share with the state's, the largest cluster first, each id once.

    Without a shared key, or if the best match is a shadow (a negative id), a cluster gets a new id.
    """
    out, used = [0] * len(new), set()
    for i in sorted(range(len(new)), key=lambda i: (-len(new[i]), i)):
        shared = {g: len(new[i] & keys) for g, keys in state.items() if g not in used and new[i] & keys}
        best = min(shared, key=lambda g: (-shared[g], -len(state[g]), g)) if shared else -1
        if best < 0:
            best, next_id = next_id, next_id + 1
        used.add(best)
        out[i] = best
    return out, next_id


#: Vectors whose distances are held at a time, by those of another such block: two blocks take 134 MB.
BLOCK = 2048


def cluster_detections(vectors: DataFrame, by: str, key: str, min_size: int) -> DataFrame:
    """HDBSCAN labels of raw embeddings, all of a value of ``by`` together.

    A value's vectors are dealt into blocks and each pair of blocks is a unit of work, so all distances are looked at and
    those of two blocks are held. A first pass finds the core distances. In a second each pair gives its minimum spanning tree of
    mutual reachability: an edge of the whole tree lies in one of them. The edges of a value meet in one task.
    """
    from pyspark.sql import functions as F

    from ..session import fresh_folder, written

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    rows = vectors.select(F.col(by).alias("_by"), F.col(key).alias("_key"), F.col("embedding").cast("array<double>").alias("_x")).where("_x is not null")
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), fresh_folder(vectors.sparkSession, "vectors"))
    sizes = rows.groupBy(F.col("_by").alias("_of")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    own = rows.select("_by", "_row", "_x").join(sizes, F.col("_by").eqNullSafe(F.col("_of"))).drop("_of").withColumn("_block", F.pmod(F.xxhash64("_row"), "_blocks").cast("int"))

    def paired(blocks: DataFrame, alone: Column) -> DataFrame:
        other = F.explode(F.filter(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda o: (o != F.col("_block")) | alone))
        return blocks.withColumn("_other", other).withColumns({"_a": F.least("_block", "_other"), "_b": F.greatest("_block", "_other")}).drop("_other", "_blocks").groupBy("_by", "_a", "_b")

    def apart(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, int]:
        pdf = pdf.sort_values(["_block", "_row"])
        cut = int((pdf["_block"] == pdf["_a"]).sum())
        return pdf, N.distances(np.stack(pdf["_x"].to_numpy()), (cut,)), cut

    def nearest(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, d, cut = apart(pdf)
        sides = [(0, d)] if cut == len(pdf) else [(0, d[:cut, cut:]), (cut, d[cut:, :cut])]
        near = [(at, np.sort(np.partition(x, min(min_size, x.shape[1]) - 1, axis=1)[:, :min_size], axis=1)) for at, x in sides if x.size]
        return pd.DataFrame({"_row": np.concatenate([pdf["_row"].to_numpy()[at : at + len(x)] for at, x in near] or [[]]).astype("int64"), "_near": [r for _, x in near for r in x]})

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, d, _ = apart(pdf)
        w, a, b = N.reachability_tree(d, pdf["_core"].to_numpy())
        at = pdf["_row"].to_numpy()
        return pd.DataFrame({"_by": pd.Series([pdf["_by"].iloc[0]] * len(w), dtype=pdf["_by"].dtype), "_w": w, "_a": at[a], "_b": at[b]})

    def label(nodes: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values(["_key", "_row"])
        rows = nodes["_row"].to_numpy()
        by_row = np.argsort(rows)
        place = lambda r: by_row[np.searchsorted(rows, r.to_numpy(), sorter=by_row)]
        a, b = place(edges["_a"]), place(edges["_b"])
        labels = N.excess_of_mass(len(rows), edges["_w"].to_numpy(), a, b, min(min_size, len(rows)))
        return pd.DataFrame({by: nodes["_by"].to_numpy(), key: nodes["_key"].to_numpy(), "label": labels.astype("int64")})

    near = paired(own, F.lit(True)).applyInPandas(nearest, "_row long, _near array<double>").groupBy("_row").agg(F.array_sort(F.flatten(F.collect_list("_near"))).alias("_near"))
    core = near.select("_row", F.element_at("_near", F.least(F.lit(min_size), F.size("_near"))).alias("_core"))
    edges = paired(own.join(core, "_row"), F.col("_blocks") == 1).applyInPandas(tree, f"_by {kinds[by]}, _w double, _a long, _b long")
    return rows.select("_by", "_key", "_row").groupBy("_by").cogroup(edges.groupBy("_by")).applyInPandas(label, f"{by} {kinds[by]}, {key} {kinds[key]}, label long")


def appearance_only(rows: list[Behavior], k: int, loose: float) -> np.ndarray:
    """Ward clusters by appearance with one assignment over each sensor's behaviors."""
    rows = sorted(rows, key=lambda b: b.order)
    embeddings = np.array([b.embedding for b in rows], float)
    labels = N.ward_by_count(embeddings, k)
    groups: dict[str, list[int]] = defaultdict(list)
    for i, b in enumerate(rows):
        groups[b.sensor].append(i)
    means = mean_embeddings(embeddings, labels)
    names, out = sorted(means), np.full(len(rows), -1)
    looks = appearance(embeddings, np.array([means[n] for n in names]))
    for g in groups.values():
        r, c = assign(looks[g])
        for a, b in zip(r, c, strict=True):
            if looks[g[a], b] < loose:
                out[g[a]] = names[b]
    return out
