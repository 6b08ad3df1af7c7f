"""Gradient-boosted regression trees over histograms of quantile bins, with learnt directions for missing values.

Features are cut at their quantiles once, and a row is a byte for each feature. A tree grows level
by level: for each node and feature, gradients and rows are summed by bin, and the best split is
read from the running sums, once with the missing values to the left and once to the right. Of two
children only the smaller is summed; the other is its parent less that.

The rows stay where they are: each task of a barrier stage keeps its part of the rows in memory as
bytes, sums its own histograms, and exchanges these with the other tasks, so all of them find the
same split. What is exchanged depends on nodes, features and bins, and not on rows. A row takes part
in a tree by a hash of its key and the tree, whatever task it is in. A lost task restarts the stage.
"""

from __future__ import annotations

import socket
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.selection import percentiles
from ..functions.series import KEY
from ..sources.scratch import stored

#: Rows that a task is meant to hold; bins of a feature.
TASK_ROWS, BINS = 500_000, 64
#: Rows that are taken at once, so that what is made of them stays in a core's cache.
BLOCK = 1 << 14
#: Nodes up to which a level's histograms are summed by pairs of features.
#: 0: none, as another order of sums decides ties between splits otherwise.
PAIRED = 0
_NODES = "tree int, node int, feature int, threshold double, missing_left boolean, left int, right int, value double, gain double, n long"
#: The row of a tree that has no node holds its errors: value on validation, gain on training.
_ERRORS = -1


@dataclass(frozen=True)
class Settings:
    trees: int = 500
    rate: float = 0.05
    depth: int = 8
    least_rows: int = 5
    rows: float = 0.8
    columns: float = 0.8
    ridge: float = 1.0
    patience: int | None = None
    seed: int = 42


#: The configurations that tuning compares.
CONFIGS = {
    "baseline": Settings(500, 0.05, 8, 5, 0.8, 0.8),
    "shallower": Settings(700, 0.04, 6, 5, 0.85, 0.85),
    "regularized": Settings(700, 0.04, 7, 10, 0.85, 0.85),
    "strong_regularization": Settings(800, 0.035, 6, 15, 0.8, 0.8),
    "deeper": Settings(600, 0.045, 9, 10, 0.8, 0.8),
}


@dataclass
class Tree:
    feature: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray


@dataclass
class Model:
    """Fitted trees. errors: (tree, training, validation) mean absolute errors after each tree."""

    features: list[str]
    base: float
    trees: list[Tree]
    gains: dict[str, tuple[float, int]] = field(default_factory=dict)
    errors: list[tuple[int, float, float | None]] = field(default_factory=list)

    def values(self, x: np.ndarray) -> np.ndarray:
        """Predictions for rows of feature values, NaN where missing."""
        walks = [_walk(t, len(self.features)) for t in self.trees]
        out = np.full(len(x), self.base)
        for begin in range(0, len(x), BLOCK):
            rows = x[begin : begin + BLOCK].T
            # missing values are below every threshold where they go left, and above all where right
            both = np.concatenate([np.where(np.isnan(rows), -np.inf, rows), rows]).reshape(-1)
            n, places = rows.shape[1], np.arange(rows.shape[1])
            for (column, threshold, child, depth), t in zip(walks, self.trees):
                starts, at = column * n, np.zeros(n, dtype=np.intp)
                for _ in range(depth):
                    at = child[2 * at + ~(both[starts[at] + places] <= threshold[at])]
                out[begin : begin + n] += t.value[at]
        return out

    def predict(self, df: DataFrame, as_column: str = "prediction") -> DataFrame:
        """df with predictions. The model's size depends on its trees, and not on the rows."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def predicted(rows: pd.DataFrame) -> pd.Series:
            return pd.Series(shared.value.values(rows.to_numpy(dtype=np.float64, na_value=np.nan)))

        return df.withColumn(as_column, predicted(F.struct(*[number(F.col(c)).alias(f"f{k}") for k, c in enumerate(self.features)])))

    def importances(self, spark: SparkSession, top: int = 20) -> DataFrame:
        """feature, importance: the mean gain of a feature's splits, as a share of all."""
        mean = {f: g / n for f, (g, n) in self.gains.items()}
        total = sum(mean.values()) or 1.0
        scores = sorted(((f, mean.get(f, 0.0) / total) for f in self.features), key=lambda x: (-x[1], x[0]))[:top]
        return spark.createDataFrame(scores, "feature string, importance double")


def _walk(t: Tree, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The column that each node reads (of features twice, the first ones for missing values that go
    left), its threshold, its children (left, right; a leaf's are itself), and the tree's depth."""
    inner, own = t.feature >= 0, np.arange(len(t.feature))
    child = np.stack([np.where(inner, t.left, own), np.where(inner, t.right, own)], axis=1).astype(np.intp)
    column = np.where(inner, t.feature + np.where(t.missing_left.astype(bool), 0, features), 0).astype(np.intp)
    depth, level = 0, np.array([0])
    while (level := child[level[inner[level]]].ravel()).size:
        depth += 1
    return column, t.threshold, child.ravel(), depth


def number(value: Column) -> Column:
    """value as a double; NaN and infinities are missing."""
    x = value.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


@dataclass
class Matrix:
    """Rows with their features, label, key and whether they are for validation, stored once, and the cuts of each feature."""

    rows: DataFrame
    features: list[str]
    cuts: list[np.ndarray]
    tasks: int


def prepared(train: DataFrame, validation: DataFrame | None, features: list[str], label: str, key: list[str], bins: int = BINS) -> Matrix:
    """The matrix that fits share. Cuts are exact quantiles of the training rows; rows without label are left out."""
    columns = [number(F.col(c)).alias(f"f{k}") for k, c in enumerate(features)]
    side = lambda df, last: df.where(F.col(label).isNotNull()).select(F.xxhash64(*key).alias("key"), F.col(label).cast("double").alias("label"), F.lit(last).alias("held_out"), *columns)
    rows = side(train, False)
    if validation is not None:
        rows = rows.unionByName(side(validation, True))
    rows = stored(rows, "matrix")
    names = [f"f{k}" for k in range(len(features))]
    known = rows.where("NOT held_out").unpivot([], names, "feature", "value")
    found = dict(percentiles(known, "value", [k / bins for k in range(1, bins)], ["feature"]).collect())
    cuts = [np.unique(np.array(found.get(n, []), dtype=np.float64)) for n in names]
    spark = train.sparkSession
    tasks = max(1, min(-(-rows.count() // TASK_ROWS), spark.sparkContext.defaultParallelism))
    return Matrix(rows, features, cuts, tasks)


def _mixed(key: np.ndarray, salt: int) -> np.ndarray:
    """64 well-mixed bits of each key."""
    v = key ^ np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        v = (v ^ (v >> np.uint64(shift))) * np.uint64(factor)
    return v ^ (v >> np.uint64(31))


def best_splits(sums: np.ndarray, counts: np.ndarray, least_rows: int, ridge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gain, feature, cut, missing_left) of each node, gain 0 where there is none, from gradients and
    rows by (node, feature, bin); the last bin holds the missing values, and bins up to cut go left."""
    g, n = sums.sum(axis=2)[:, :1, None], counts.sum(axis=2)[:, :1, None]
    left_g, left_n = np.cumsum(sums[:, :, :-1], axis=2), np.cumsum(counts[:, :, :-1], axis=2)
    lost_g, lost_n = sums[:, :, -1:], counts[:, :, -1:]
    each = []
    for a, m in ((left_g, left_n), (left_g + lost_g, left_n + lost_n)):
        gain = a * a / (m + ridge) + (g - a) ** 2 / (n - m + ridge) - g * g / (n + ridge)
        each.append(np.where((m >= least_rows) & (n - m >= least_rows), gain, 0.0))
    gains = np.stack(each, axis=3).reshape(len(sums), -1)
    at = np.argmax(gains, axis=1)
    cuts = left_g.shape[2]
    return gains[np.arange(len(at)), at], at // (2 * cuts), at // 2 % cuts, at % 2 == 1


class _Exchange:
    """Sums arrays over the tasks of a barrier stage along a binary tree of connections, the same
    order of additions each time. A task that is lost breaks its connections, and the stage starts anew."""

    def __init__(self, context):
        me, n = context.partitionId(), len(context.getTaskInfos())
        server = socket.create_server(("", 0))
        host = context.getTaskInfos()[me].address.rsplit(":", 1)[0]
        places = [x.rsplit(":", 1) for x in context.allGather(f"{host}:{server.getsockname()[1]}")]
        self.up = None
        if me:
            self.up = socket.create_connection((places[(me - 1) // 2][0], int(places[(me - 1) // 2][1])))
            self.up.sendall(me.to_bytes(4, "little"))
        found = {}
        for _ in range(sum(c < n for c in (2 * me + 1, 2 * me + 2))):
            child, _ = server.accept()
            found[int.from_bytes(self._read(child, 4), "little")] = child
        server.close()
        self.below = [found[c] for c in sorted(found)]
        for s in [*self.below, *([self.up] if self.up else [])]:
            s.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)

    @staticmethod
    def _read(source: socket.socket, n: int) -> bytearray:
        out, at = bytearray(n), 0
        while at < n:
            got = source.recv_into(memoryview(out)[at:])
            if not got:
                raise ConnectionError("a task of the stage was lost")
            at += got
        return out

    def total(self, part: np.ndarray) -> np.ndarray:
        read = lambda source: np.frombuffer(self._read(source, part.nbytes), dtype=part.dtype).reshape(part.shape)
        for child in self.below:
            part = part + read(child)
        if self.up is not None:
            self.up.sendall(np.ascontiguousarray(part).tobytes())
            part = read(self.up)
        for child in self.below:
            child.sendall(np.ascontiguousarray(part).tobytes())
        return part


class _Part:
    """A task's rows, and what it exchanges with the others."""

    def __init__(self, frames: Iterator[pd.DataFrame], cuts: list[np.ndarray], exchange: _Exchange | None):
        self.total = exchange.total if exchange else lambda part: part
        self.bins = max([len(c) for c in cuts] + [0]) + 2
        binned, label, key, held = [], [], [], []
        for frame in frames:
            x = frame[[f"f{k}" for k in range(len(cuts))]].to_numpy(dtype=np.float64, na_value=np.nan)
            out = np.full(x.shape, self.bins - 1, dtype=np.uint8)
            for k, c in enumerate(cuts):
                known = ~np.isnan(x[:, k])
                out[known, k] = np.searchsorted(c, x[known, k], side="left")
            binned.append(out)
            label.append(frame["label"].to_numpy())
            key.append(frame["key"].to_numpy())
            held.append(frame["held_out"].to_numpy(dtype=bool))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        self.x = np.ascontiguousarray((np.concatenate(binned) if binned else np.empty((0, len(cuts)), np.uint8)).T)
        self.y, self.key, self.held = join(label, np.float64), join(key, np.int64).view(np.uint64), join(held, bool)
        # neighbouring features as one, the last one alone where there is no neighbour
        kind = np.min_scalar_type(self.bins * self.bins)
        self.pairs = [self.x[k].astype(kind) * kind.type(self.bins) + (self.x[k + 1] if k + 1 < len(cuts) else kind.type(0)) for k in range(0, len(cuts), 2)]

    def blocks(self) -> Iterator[slice]:
        return (slice(k, k + BLOCK) for k in range(0, len(self.y), BLOCK))

    def sampled(self, salt: int, share: float) -> np.ndarray:
        """Which rows train a tree."""
        out = ~self.held
        if share < 1:
            for b in self.blocks():
                out[b] &= _mixed(self.key[b], salt) < np.uint64(share * float((1 << 64) - 1025))
        return out

    def moved(self, at: np.ndarray, feature: np.ndarray, following: np.ndarray) -> None:
        """Brings rows from their nodes (at) to those that follow: feature is what a node looks at, and following its next nodes by bin."""
        starts, flat, following = feature * len(self.y), self.x.reshape(-1), following.reshape(-1)
        for b in self.blocks():
            here = at[b].astype(np.intp)
            place = np.arange(b.start, b.start + len(here))
            place += starts[here]
            here *= self.bins
            here += flat[place]
            at[b] = following[here]

    def histograms(self, at: np.ndarray, place: np.ndarray, slots: int, gradient: np.ndarray, chosen: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """(2, slots, columns, bins) sums of gradients and of chosen rows; place: that of each node, or below 0.
        Few nodes are summed by pairs of features, as sums into few cells wait for one another."""
        out = np.zeros((2, slots, len(columns), self.bins))
        slot = place[at]
        wanted = np.flatnonzero(chosen & (slot >= 0))
        slot, g = slot[wanted].astype(np.intp), gradient[wanted]
        if slots <= PAIRED:
            shape = (slots, self.bins, self.bins)
            where, base = {int(c): k for k, c in enumerate(columns)}, slot * self.bins**2
            for p in sorted({int(c) // 2 for c in columns}):
                cell = base + self.pairs[p][wanted]
                for kind, weights in enumerate((g, None)):
                    both = np.bincount(cell, weights, slots * self.bins**2).reshape(shape)
                    for c, axis in ((2 * p, 2), (2 * p + 1, 1)):
                        if c in where:
                            out[kind, :, where[c]] = both.sum(axis=axis)
        else:
            base = slot * self.bins
            for k, c in enumerate(columns):
                cell = base + self.x[c][wanted]
                out[0, :, k] = np.bincount(cell, g, slots * self.bins).reshape(slots, self.bins)
                out[1, :, k] = np.bincount(cell, minlength=slots * self.bins).reshape(slots, self.bins)
        return self.total(out)


def _grown(part: _Part, cuts: list[np.ndarray], gradient: np.ndarray, chosen: np.ndarray, columns: np.ndarray, s: Settings) -> tuple[list[tuple], np.ndarray]:
    """Nodes (feature, threshold, missing_left, left, right, value, gain, n) of a tree, and the leaf of every row."""
    at = np.zeros(len(part.y), dtype=np.int32)
    nodes: list[list] = []
    hist = part.histograms(at, np.zeros(1, dtype=np.int32), 1, gradient, chosen, columns)
    level = [0]
    g, n = float(hist[0, 0, 0].sum()), float(hist[1, 0, 0].sum())
    nodes.append([-1, 0.0, False, -1, -1, -s.rate * g / (n + s.ridge), 0.0, int(n)])
    for depth in range(s.depth):
        gain, feature, cut, missing_left = best_splits(hist[0], hist[1], s.least_rows, s.ridge)
        split = np.flatnonzero(gain > 1e-9)
        if not len(split):
            break
        first = len(nodes)
        looks, following = np.zeros(first, dtype=np.intp), np.repeat(np.arange(first, dtype=np.int32)[:, None], part.bins, axis=1)
        children = []
        for k in split.tolist():
            f, b = int(feature[k]), int(cut[k])
            sides = np.arange(part.bins) <= b
            sides[-1] = missing_left[k]
            g = [float(hist[0, k, f][side].sum()) for side in (sides, ~sides)]
            n = [float(hist[1, k, f][side].sum()) for side in (sides, ~sides)]
            node = nodes[level[k]]
            c = cuts[columns[f]]
            node[:5] = int(columns[f]), float(c[b]) if b < len(c) else float("inf"), bool(missing_left[k]), len(nodes), len(nodes) + 1
            node[6] = float(gain[k])
            looks[level[k]], following[level[k]] = columns[f], np.where(sides, len(nodes), len(nodes) + 1)
            nodes += [[-1, 0.0, False, -1, -1, -s.rate * gg / (nn + s.ridge), 0.0, int(nn)] for gg, nn in zip(g, n)]
            children += n
        part.moved(at, looks, following)
        if depth + 1 == s.depth:
            break
        # only the smaller child of each pair is summed
        pairs = np.array(children).reshape(-1, 2)
        smaller = (pairs[:, 1] < pairs[:, 0]).astype(np.int64)
        place = np.full(len(nodes), -1, dtype=np.int32)
        place[first + 2 * np.arange(len(pairs)) + smaller] = np.arange(len(pairs))
        few = part.histograms(at, place, len(pairs), gradient, chosen, columns)
        both = np.empty((2, 2 * len(pairs), *few.shape[2:]))
        both[:, 2 * np.arange(len(pairs)) + smaller] = few
        both[:, 2 * np.arange(len(pairs)) + 1 - smaller] = hist[:, split] - few
        hist, level = both, list(range(first, len(nodes)))
    return [tuple(x) for x in nodes], at


def _trained(part: _Part, cuts: list[np.ndarray], s: Settings) -> Iterator[tuple]:
    """The rows of _NODES, tree by tree; the first has the base value."""
    learn = np.flatnonzero(~part.held)
    total, n = part.total(np.array([part.y[learn].sum(), len(learn)], dtype=np.float64))
    base = total / n if n else 0.0
    yield (-1, 0, -1, 0.0, False, -1, -1, float(base), 0.0, int(n))
    if not n or not len(cuts):
        return
    now, best, rng = np.full(len(part.y), base), (np.inf, 0), np.random.default_rng(s.seed)
    for tree in range(s.trees):
        gradient = now - part.y
        chosen = part.sampled(s.seed * 100_003 + tree, s.rows)
        columns = np.sort(rng.choice(len(cuts), max(1, int(s.columns * len(cuts))), replace=False))
        nodes, leaf = _grown(part, cuts, gradient, chosen, columns, s)
        for k, x in enumerate(nodes):
            yield (tree, k, *x)
        now += np.array([x[5] for x in nodes])[leaf]
        off = np.abs(now - part.y)
        error, held, count = part.total(np.array([off[learn].sum(), off[part.held].sum(), part.held.sum()]))
        yield (tree, _ERRORS, -1, 0.0, False, -1, -1, float(held / count) if count else None, float(error / n), int(count))
        if s.patience is not None and count:
            best = min(best, (held / count, tree))
            if tree - best[1] >= s.patience:
                return


def fit_matrix(matrix: Matrix, settings: Settings = Settings()) -> Model:
    """A model of the matrix's training rows. With patience, training ends that many trees after the
    least validation error, and the trees after it are dropped."""
    cuts, spread = matrix.cuts, matrix.tasks > 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        exchange, mine = None, True
        if spread:
            from pyspark import BarrierTaskContext

            context = BarrierTaskContext.get()
            exchange, mine = _Exchange(context), context.partitionId() == 0
        part = _Part(frames, cuts, exchange)
        names = [x.split()[0] for x in _NODES.split(", ")]
        held: list[tuple] = []
        for row in _trained(part, cuts, settings):
            if mine:
                held.append(row)
                if len(held) >= 20_000:
                    yield pd.DataFrame(held, columns=names)
                    held = []
        if held:
            yield pd.DataFrame(held, columns=names)

    rows = matrix.rows.repartition(matrix.tasks, "key").sortWithinPartitions("key", "label")
    # a model has a bounded number of nodes, whatever the number of rows
    out = rows.mapInPandas(run, _NODES, barrier=spread).toPandas()
    return _assembled(out, matrix.features, settings)


def _assembled(out: pd.DataFrame, features: list[str], s: Settings) -> Model:
    base = float(out.loc[out["tree"] < 0, "value"].iloc[0]) if len(out) else 0.0
    errors = out[(out["node"] == _ERRORS) & (out["tree"] >= 0)].sort_values("tree")
    history = [(int(t), float(a), None if pd.isna(v) else float(v)) for t, a, v in zip(errors["tree"], errors["gain"], errors["value"])]
    last = len(history)
    if s.patience is not None and last and history[0][2] is not None:
        last = min(history, key=lambda x: (x[2], x[0]))[0] + 1
    trees, gains = [], {}
    nodes = out[(out["node"] >= 0) & (out["tree"] >= 0) & (out["tree"] < last)].sort_values(["tree", "node"])
    for _, t in nodes.groupby("tree", sort=True):
        trees.append(Tree(*[t[c].to_numpy() for c in ("feature", "threshold", "missing_left", "left", "right", "value")]))
        for f, gain in zip(t["feature"], t["gain"]):
            if f >= 0:
                g, n = gains.get(features[f], (0.0, 0))
                gains[features[f]] = (g + gain, n + 1)
    return Model(features, base, trees, gains, history[:last])


def fit(train: DataFrame, features: list[str], label: str = "target_fuel", settings: Settings = Settings(), validation: DataFrame | None = None, key: tuple[str, ...] = (KEY, "timestamp", "row_id")) -> Model:
    """A model of train. Missing, NaN and infinite features count as missing; rows without label are
    left out. The same rows give the same model, however they are partitioned, but for the order of sums."""
    return fit_matrix(prepared(train, validation, features, label, list(key)), settings)


def tuned(train: DataFrame, validation: DataFrame, features: list[str], configs: dict[str, Settings] = CONFIGS, label: str = "target_fuel", patience: int | None = 50, key: tuple[str, ...] = (KEY, "timestamp", "row_id")) -> tuple[str, Model, list[tuple[str, int, float, float]]]:
    """The name and model of least mean absolute error on validation, and (name, trees, training and
    validation error) of each configuration. They share one matrix and are fitted side by side; test rows play no part."""
    matrix = prepared(train, validation, features, label, list(key))
    with ThreadPoolExecutor(len(configs)) as pool:
        models = dict(zip(configs, pool.map(lambda s: fit_matrix(matrix, replace(s, patience=patience)), configs.values())))
    report = [(name, len(m.trees), m.errors[-1][1], m.errors[-1][2]) for name, m in models.items() if m.errors]
    best = min(report, key=lambda r: (r[3] if r[3] is not None else r[2], list(configs).index(r[0])))[0] if report else next(iter(configs))
    return best, models[best], report
