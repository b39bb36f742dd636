"""Boosted trees on counted rows, for many settings at once.

Logistic loss, trees grown level by level on exact splits, the leaf value of one
Newton step, and an initial score of the log-odds. Rows with the same signals
are one cell with a count per label, so a fit's work depends on the number of
cells (60,006 at most for the three signals) and not on the number of rows:
Spark counts the rows, and each setting and fold is then one task.

Gradients are whole numbers (``SCALE`` to one), so that their sums, the splits and
the leaf values do not depend on the order of rows or on how tasks are cut.
A rate of subsampling below 1 draws for every tree a binomial number out of each
cell's count, as drawing each row by itself would.

A tree sends a row left if its value is at most the threshold. Ties between splits
go to the first signal and the lowest threshold. Nodes are numbered from 1, the
children of k are 2k and 2k + 1; tree 0 is a single leaf with the initial score.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.schemas import SIGNALS

# Task functions travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LABEL = "target"
SEED = 42
SCALE = 1 << 24
# Beyond this the cells are no longer sent to the tasks.
MAX_CELLS = 200_000
# Models of more splits are scored by their regions, as their expression would take long to compile.
MAX_SPLITS = 64
MAX_REGIONS = 1 << 20
# Without rows of both labels there is nothing to learn but the one that there is.
SURE = 36.0
NODES = "tree int, node int, signal string, threshold double, `left` int, `right` int, value double, gain double"


@dataclass(frozen=True)
class Cells:
    """Distinct signal values with their counts: ``codes`` index the sorted ``values`` of each signal; counts by fold."""

    features: tuple[str, ...]
    values: tuple[np.ndarray, ...]
    codes: np.ndarray
    positive: np.ndarray
    negative: np.ndarray


class TooManyCells(ValueError):
    """The signals take more values than fit into a task."""


def cells_of(counts: DataFrame, features: Sequence[str] = SIGNALS, max_cells: int = MAX_CELLS) -> Cells:
    """Cells of counted rows (signals, ``target``, ``weight`` and, if there, ``fold``).

    The number of distinct values is checked before they are gathered, as only
    the domain of the signals bounds it; ``TooManyCells`` is raised beyond it.
    """
    folds = ["fold"] if "fold" in counts.columns else []
    whole = counts.dropna(subset=[*features, LABEL]).groupBy(*folds, *features).agg(
        F.sum(F.when(F.col(LABEL) > 0, F.col("weight")).otherwise(0)).cast("long").alias("_pos"),
        F.sum(F.when(F.col(LABEL) > 0, 0).otherwise(F.col("weight"))).cast("long").alias("_neg"))
    distinct = whole.select(*features).distinct().count()
    if distinct > max_cells:
        raise TooManyCells(f"{distinct} combinations of {', '.join(features)}; {max_cells} can be trained on as counts")
    rows = whole.select(*folds, *(F.col(c).cast("double").alias(c) for c in features), "_pos", "_neg").toPandas()
    n_folds = int(rows["fold"].max()) + 1 if folds and len(rows) else 1
    keys = rows[list(features)].to_numpy(float).reshape(-1, len(features))
    own, at = np.unique(keys, axis=0, return_inverse=True)
    values = tuple(np.unique(own[:, f]) for f in range(len(features)))
    codes = np.column_stack([np.searchsorted(v, own[:, f]) for f, v in enumerate(values)]).reshape(len(own), len(features))
    positive, negative = (np.zeros((len(own), n_folds), np.int64) for _ in range(2))
    fold = rows["fold"].to_numpy(int) if folds else np.zeros(len(rows), int)
    np.add.at(positive, (at.ravel(), fold), rows["_pos"].to_numpy(np.int64))
    np.add.at(negative, (at.ravel(), fold), rows["_neg"].to_numpy(np.int64))
    return Cells(tuple(features), values, codes, positive, negative)


def _best_splits(node: np.ndarray, weight: np.ndarray, slope: np.ndarray, cells: Cells, orders: list[np.ndarray]) -> dict[int, tuple]:
    """Per node that can be split: gain, signal, threshold."""
    best: dict[int, tuple] = {}
    for f, order in enumerate(orders):
        rows = order[weight[order] > 0]
        rows = rows[np.argsort(node[rows], kind="stable")]
        at, code = node[rows], cells.codes[rows, f]
        w, g = np.cumsum(weight[rows]), np.cumsum(slope[rows])
        first = np.r_[0, np.flatnonzero(at[1:] != at[:-1]) + 1]
        last = np.r_[first[1:], len(rows)] - 1
        group = np.repeat(np.arange(len(first)), last - first + 1)
        cut = np.flatnonzero((at[1:] == at[:-1]) & (code[1:] != code[:-1]))
        if not len(cut):
            continue
        before_w, before_g = np.r_[0, w[last[:-1]]], np.r_[0, g[last[:-1]]]
        mine = group[cut]
        wl, gl = (w[cut] - before_w[mine]).astype(float), (g[cut] - before_g[mine]).astype(float)
        wr, gr = (w[last] - before_w)[mine].astype(float) - wl, (g[last] - before_g)[mine].astype(float) - gl
        apart = gl / wl - gr / wr
        gain = wl * wr / (wl + wr) * (apart * apart)
        starts = np.r_[0, np.flatnonzero(mine[1:] != mine[:-1]) + 1]
        highest = np.repeat(np.maximum.reduceat(gain, starts), np.diff(np.r_[starts, len(cut)]))
        for k in starts + np.array([np.argmax(part) for part in np.split(gain == highest, starts[1:])]):
            here = int(at[cut[k]])
            if gain[k] > 0 and (here not in best or gain[k] > best[here][0]):
                low, high = cells.values[f][code[cut[k]]], cells.values[f][code[cut[k] + 1]]
                best[here] = (float(gain[k]), f, float((low + high) / 2))
    return best


def fit_cells(cells: Cells, positive: np.ndarray, negative: np.ndarray, sizes: Sequence[int], rate: float, depth: int,
              subsample: float = 1.0, seed: int = SEED) -> tuple[list[tuple], list[np.ndarray]]:
    """Nodes of the trees, and the scores (log-odds) of all cells after each number of trees in ``sizes``.

    Cells without a count take no part in the fit, but get a score.
    """
    total = int(positive.sum()), int(negative.sum())
    start = float(np.log(total[0] / total[1])) if all(total) else SURE if total[0] else -SURE
    raw = np.full(len(cells.codes), start)
    nodes: list[tuple] = [(0, 1, None, None, None, None, start, None)]
    orders = [np.argsort(cells.codes[:, f], kind="stable") for f in range(len(cells.features))]
    points = np.column_stack([v[cells.codes[:, f]] for f, v in enumerate(cells.values)])
    kept: dict[int, np.ndarray] = {}
    trees = max(sizes) if all(total) else 0
    for tree in range(1, trees + 1):
        pos, neg = positive, negative
        if subsample < 1:
            draw = np.random.default_rng([seed, tree])
            pos, neg = draw.binomial(positive, subsample), draw.binomial(negative, subsample)
        chance = np.floor(1 / (1 + np.exp(-raw)) * float(SCALE) + 0.5).astype(np.int64)
        weight = pos + neg
        slope = pos * (SCALE - chance) - neg * chance
        curve = weight * (chance * (SCALE - chance) // SCALE)
        node = np.ones(len(raw), np.int64)
        for _ in range(depth):
            # Nodes of earlier levels that could not be split cannot be now.
            splits = _best_splits(node, weight, slope, cells, orders)
            if not splits:
                break
            signal, cut = np.full(1 << depth, -1), np.zeros(1 << depth)
            for here, (gain, f, threshold) in sorted(splits.items()):
                nodes.append((tree, here, cells.features[f], threshold, 2 * here, 2 * here + 1, None, gain))
                signal[here], cut[here] = f, threshold
            rows = np.flatnonzero(signal[node] >= 0)
            at = node[rows]
            node[rows] = 2 * at + (points[rows, signal[at]] > cut[at])
        leaves, at = np.unique(node, return_inverse=True)
        top, bottom = np.zeros(len(leaves), np.int64), np.zeros(len(leaves), np.int64)
        np.add.at(top, at, slope)
        np.add.at(bottom, at, curve)
        value = np.where(bottom > 0, top / np.maximum(bottom, 1), 0.0) * rate
        nodes += [(tree, int(leaf), None, None, None, None, float(v), None) for leaf, v in zip(leaves, value)]
        raw = raw + value[at]
        if tree in sizes:
            kept[tree] = raw
    return nodes, [kept.get(n, raw) for n in sizes]


def drawn(counts: DataFrame, share: float, seed: int, tree: int) -> DataFrame:
    """Adds ``drawn``: a binomial number out of each ``weight``, drawn in the order of the rows of a table that one task reads."""
    def work(frames):
        draw = np.random.default_rng([seed, tree])
        for frame in frames:
            yield frame.assign(drawn=draw.binomial(frame["weight"].to_numpy().astype(np.int64), share).astype(float))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counts.schema)
    return counts.mapInPandas(work, f"{fields}, drawn double")


def f1_of(raw: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> float:
    """F1 of the label 1, predicted from log-odds of 0 on; 0 if nothing is predicted so."""
    said = raw >= 0
    hit, wrong, missed = positive[said].sum(), negative[said].sum(), positive[~said].sum()
    return float(2 * hit / (2 * hit + wrong + missed)) if hit else 0.0


class Trees:
    """A fitted model: its signals and its nodes (``NODES``), leaf values with the step size in them."""

    def __init__(self, features: Sequence[str], nodes: Sequence[tuple]):
        self.features, self.nodes = tuple(features), sorted(tuple(n) for n in nodes)
        self.size = max((n[0] for n in self.nodes), default=0)

    def first(self, n: int) -> Trees:
        """The model as it was after its first ``n`` trees."""
        return Trees(self.features, [x for x in self.nodes if x[0] <= n])

    def raw(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Log-odds of values given signal by signal."""
        out = np.zeros(len(columns[0]))
        place = {f: k for k, f in enumerate(self.features)}
        for _, group in itertools.groupby(self.nodes, key=lambda n: n[0]):
            at = np.ones(len(out), np.int64)
            group = list(group)
            # Parents have lower numbers than their children.
            for _, node, signal, threshold, left, right, *_ in group:
                if signal is not None:
                    rows = np.flatnonzero(at == node)
                    at[rows] = np.where(columns[place[signal]][rows] > threshold, right, left)
            leaves = {n[1]: n[6] for n in group if n[2] is None}
            known, inverse = np.unique(at, return_inverse=True)
            out = out + np.array([leaves[k] for k in known.tolist()])[inverse]
        return out

    def column(self) -> Column:
        """Log-odds as an expression of the signals: a conditional per node, the trees' values added in pairs."""
        by_tree = {tree: {n[1]: n for n in group} for tree, group in itertools.groupby(self.nodes, key=lambda n: n[0])}

        def value(tree: int, node: int) -> Column:
            _, _, signal, threshold, left, right, leaf, _ = by_tree[tree][node]
            if signal is None:
                return F.lit(leaf)
            return F.when(F.col(signal) <= threshold, value(tree, left)).otherwise(value(tree, right))

        parts = [value(tree, 1) for tree in by_tree]
        while len(parts) > 1:
            parts = [a + b for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) - len(parts) % 2:]
        return parts[0]

    def regions(self) -> tuple[list[list[float]], np.ndarray]:
        """The thresholds of each signal in order, and the log-odds between them, the last signal's place running fastest."""
        cuts = [sorted({n[3] for n in self.nodes if n[2] == f}) for f in self.features]
        size = int(np.prod([len(c) + 1 for c in cuts]))
        if size > MAX_REGIONS:
            raise ValueError(f"the model has {size} regions; {MAX_REGIONS} can be listed")
        # A threshold belongs to the region below it.
        points = [np.array([*c, c[-1] + 1 if c else 0.0]) for c in cuts]
        grid = np.meshgrid(*points, indexing="ij")
        return cuts, self.raw([g.ravel() for g in grid])

    def _with_raw(self, rows: DataFrame, out: str) -> DataFrame:
        """Adds the log-odds: by the expression of short models, by the number of thresholds below each value for others."""
        if sum(n[2] is not None for n in self.nodes) <= MAX_SPLITS:
            return rows.withColumn(out, self.column())
        cuts, raw = self.regions()
        names = [f"{out}_{k}" for k in range(len(cuts))]
        listed = [pa.array([list(map(float, x))], pa.list_(pa.float64())) for x in (*cuts, raw)]
        table = rows.sparkSession.createDataFrame(pa.table(listed, names=[*names, out]))

        def below(name: str, signal: str) -> Column:
            return F.size(F.filter(F.col(name), lambda cut: cut < F.col(signal).cast("double")))

        place = F.lit(0)
        for signal, name, own in zip(self.features, names, cuts):
            place = place * (len(own) + 1) + below(name, signal)
        looked = rows.withColumns({n: table.select(n).scalar() for n in [*names, out]})
        return looked.withColumn(out, F.element_at(out, place.cast("int") + 1)).drop(*names)

    def score(self, rows: DataFrame, out: str = "lem_score") -> DataFrame:
        """Adds the probability of the label 1 times 100; null where a signal is."""
        complete = F.lit(True)
        for f in self.features:
            complete = complete & F.col(f).isNotNull()
        return self._with_raw(rows, out).withColumn(out, F.when(complete, 100.0 / (1.0 + F.exp(-F.col(out)))))

    def score_table(self, spark: SparkSession, domain: Mapping[str, np.ndarray], out: str = "lem_score") -> DataFrame:
        """The score of every combination of the values in ``domain``, worked out once; its size does not depend on rows."""
        grid = [g.ravel() for g in np.meshgrid(*domain.values(), indexing="ij")]
        raw = self.raw([grid[list(domain).index(f)].astype(float) for f in self.features])
        return spark.createDataFrame(pa.table([*map(pa.array, grid), pa.array(100.0 / (1.0 + np.exp(-raw)))], names=[*domain, out]))

    def table(self, spark: SparkSession) -> DataFrame:
        """The nodes as a table; ``follow`` reads it."""
        return spark.createDataFrame(self.nodes, NODES)

    def importance(self) -> dict[str, float]:
        """Shares of the signals in the gains, the mean over the trees that split."""
        shares = []
        for tree, group in itertools.groupby(self.nodes, key=lambda n: n[0]):
            gains = dict.fromkeys(self.features, 0.0)
            for n in group:
                if n[2] is not None:
                    gains[n[2]] += n[7]
            if sum(gains.values()) > 0:
                shares.append([g / sum(gains.values()) for g in gains.values()])
        total = np.sum(shares, axis=0) if shares else np.zeros(len(self.features))
        return dict(zip(self.features, (total / max(total.sum(), 1e-300)).tolist()))

    def save(self, spark: SparkSession, path: str) -> None:
        """Writes the table of nodes; the signals' order is kept beside them."""
        order = spark.createDataFrame([(-1 - k, 0, f, None, None, None, None, None) for k, f in enumerate(self.features)], NODES)
        self.table(spark).unionByName(order).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Trees | None:
    """The stored model, or None if there is none of this kind."""
    try:
        rows = [tuple(r) for r in spark.read.schema(NODES).parquet(path).collect()]
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None
    if not rows:
        return None
    return Trees([r[2] for r in sorted(rows, reverse=True) if r[0] < 0], [r for r in rows if r[0] >= 0])


def follow(rows: DataFrame, nodes: DataFrame, key: Sequence[str], features: Sequence[str] = SIGNALS, out: str = "lem_score") -> DataFrame:
    """Scores by joins with a table of nodes, one level of all trees at a time: key columns and ``out``.

    For models kept as tables, of any size; each row is met once per tree and level.
    """
    spots = F.create_map(*itertools.chain.from_iterable((F.lit(f), F.col(f).cast("double")) for f in features))
    nodes = nodes.filter("tree >= 0")
    at = rows.select(*key, spots.alias("_values"), F.explode(nodes.select(F.array_sort(F.collect_set("tree")).alias("t")).select("t").scalar()).alias("tree"),
                     F.lit(1).alias("node"))
    deepest = nodes.agg(F.max("node")).first()[0]
    splits = nodes.filter(F.col("signal").isNotNull()).select("tree", "node", "signal", "threshold", "left", "right")
    for _ in range(max(0, int(deepest).bit_length() - 1)):
        at = at.join(splits, ["tree", "node"], "left").select(
            *key, "_values", "tree", F.when(F.col("signal").isNull(), F.col("node"))
            .when(F.col("_values")[F.col("signal")] <= F.col("threshold"), F.col("left")).otherwise(F.col("right")).alias("node"))
    values = nodes.filter(F.col("signal").isNull()).select("tree", "node", "value")
    return at.join(values, ["tree", "node"]).groupBy(*key).agg((100.0 / (1.0 + F.exp(-F.sum("value")))).alias(out))


def train(counts: DataFrame, features: Sequence[str] = SIGNALS, *, maxIter: int = 100, stepSize: float = 0.1, maxDepth: int = 3,
          subsamplingRate: float = 1.0, seed: int = SEED, max_cells: int = MAX_CELLS) -> Trees:
    """One model of counted rows; the fit itself is one task, on cells whose number is checked."""
    spark, cells = counts.sparkSession, cells_of(counts, features, max_cells)
    found = _run(spark, cells, [({"stepSize": stepSize, "maxDepth": maxDepth, "subsamplingRate": subsamplingRate}, None)], [maxIter], seed, True)
    return Trees(features, found[0][1])


def _run(spark: SparkSession, cells: Cells, jobs: list[tuple[dict, int | None]], sizes: Sequence[int], seed: int,
         with_nodes: bool = False) -> dict[int, tuple[list[float], list[tuple]]]:
    """Fits each (setting, fold) in a task of its own: F1 on the fold after each number of trees, and the nodes if asked for.

    Fold k is scored by trees of the folds before it; with fold None all rows are trained on.
    """
    shared = spark.sparkContext.broadcast((cells, list(sizes), seed))

    def work(frames):
        cells, sizes, seed = shared.value
        for frame in frames:
            for job, rate, depth, share, fold in frame.itertuples(index=False):
                used = slice(None) if fold < 0 else slice(0, fold)
                pos, neg = cells.positive[:, used].sum(axis=1), cells.negative[:, used].sum(axis=1)
                nodes, scores = fit_cells(cells, pos, neg, sizes, rate, depth, share, seed)
                for n, raw in zip(sizes, scores):
                    held = f1_of(raw, cells.positive[:, fold], cells.negative[:, fold]) if fold >= 0 else None
                    yield pd.DataFrame([[job, n, held, *[None] * 8]], columns=columns).astype(kinds)
                if with_nodes:
                    yield pd.DataFrame([[job, -1, None, *n] for n in nodes], columns=columns).astype(kinds)

    columns = ["job", "trees", "f1", "tree", "node", "signal", "threshold", "left", "right", "value", "gain"]
    kinds = {c: "Int64" for c in ("job", "trees", "tree", "node", "left", "right")} | {c: "float64" for c in ("f1", "threshold", "value", "gain")}
    rows = [(k, float(p["stepSize"]), int(p["maxDepth"]), float(p.get("subsamplingRate", 1.0)), -1 if fold is None else fold)
            for k, (p, fold) in enumerate(jobs)]
    asked = spark.createDataFrame(rows, "job int, rate double, depth int, share double, fold int").repartition(len(rows), "job")
    made = asked.mapInPandas(work, "job int, trees int, f1 double, " + NODES).collect()
    out: dict[int, tuple[list[float], list[tuple]]] = {k: ([], []) for k in range(len(jobs))}
    for r in sorted(made, key=lambda r: (r.job, r.trees)):
        if r.trees < 0:
            plain = tuple(r)[3:]
            out[r.job][1].append(tuple(None if isinstance(v, float) and v != v else v for v in plain))
        else:
            out[r.job][0].append(r.f1)
    return out


def grid_search(fold_counts: DataFrame, grid: Mapping[str, Sequence], splits: int, features: Sequence[str] = SIGNALS,
                seed: int = SEED, max_cells: int = MAX_CELLS) -> tuple[DataFrame, dict]:
    """Expanding-window search over all settings at once: a table of settings with their mean F1, and the best of them.

    ``fold_counts`` holds counted rows per fold. Settings that differ in the
    number of trees share a fit; every other setting and fold is a task of one job.
    """
    spark, cells = fold_counts.sparkSession, cells_of(fold_counts, features, max_cells)
    rest = {k: v for k, v in grid.items() if k != "maxIter"}
    sizes = sorted(grid.get("maxIter", [100]))
    shared = [dict(zip(rest, values)) for values in itertools.product(*rest.values())]
    jobs = [({"stepSize": 0.1, "maxDepth": 3, **s}, fold) for s in shared for fold in range(1, splits + 1)]
    found = _run(spark, cells, jobs, sizes, seed)
    means = {}
    for i, setting in enumerate(shared):
        folds = [found[i * splits + k][0] for k in range(splits)]
        for j, n in enumerate(sizes):
            means[tuple({**setting, "maxIter": n}[k] for k in grid)] = sum(f[j] for f in folds) / splits
    settings = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    table = [(*s.values(), means[tuple(s.values())]) for s in settings]
    best = settings[max(range(len(settings)), key=lambda i: table[i][-1])]
    return spark.createDataFrame(table, [*grid, "mean_f1"]), best
