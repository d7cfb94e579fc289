"""Tree ensembles of many models at once, grown on histograms of binned features.

Features are binned once. A tree grows level by level: for each node, feature and bin the rows and their
gradients are summed, and the best split of each node follows from these sums alone. Sums of parts of the data
add up, so one aggregation per level serves the trees of all models (folds x quantiles) together, however
many blocks the rows lie in. While all rows fit one task (``LOCAL_ROWS``, checked), each model is grown in a task
of its own with the same functions and without a job per level.

* ``quantile``: gradients of the quantile loss; a leaf takes that quantile of the residuals in it, to
  1/4,096 of their range, found by counting on a grid. Gradients are counts, so both ways give equal trees.
* ``squared``: residuals; a leaf takes their mean.
* ``forest``: ``squared`` on bootstrap weights (Poisson, from a hash of row and tree), trees not chained; the
  prediction is a sum, the mean of the first k trees that sum over k.

A missing feature lies below every value. ``threshold`` of a node: rows up to it, and missing ones, go left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.reference import DAY_PERIODS
from wattline.session import settled, ship, work_path

#: Bins of a feature, the first one for missing values.
BINS = 256
#: Rows of a block, and rows up to which each model is grown in one task: with 64 features 13 MB.
BLOCK_ROWS, LOCAL_ROWS = 50_000, 200_000
#: Residuals are counted on so many parts of their range.
GRID = 4_096
#: Trees after which the rows' predictions are stored anew.
EVERY = 10
#: Nodes whose histograms meet in one group, and nodes of all trees that grow at once.
NODES, LEVEL_NODES = 64, 1 << 18
BLOCK = "block long, n long, row binary, bins binary, y binary, test_fold binary, train_from binary, fit binary"
GROWN = (
    "model int, feature array<int>, bin array<int>, threshold array<double>, left array<int>, right array<int>, "
    "value array<double>, cover array<double>, start array<int>"
)
#: Cumulative probabilities of a Poisson variable of mean 1.
POISSON = np.cumsum([np.exp(-1.0)] + [np.exp(-1.0) / np.prod(np.arange(1.0, k + 1)) for k in range(1, 12)])


@dataclass(frozen=True)
class Model:
    """What to grow: trained on fold ``fold``'s training rows (``n_splits``: on all), tested on its test rows."""

    name: str
    fold: int
    objective: str = "quantile"
    alpha: float = 0.5
    rounds: int = 300
    rate: float = 0.05
    depth: int = 5
    min_rows: int = 20
    first: int = 0  # number of its first tree, for bootstrap weights
    seed: int = 42


class Tree:
    """Nodes as arrays; level by level, children behind their parents."""

    def __init__(self):
        self.feature, self.bin = np.array([-1], np.int32), np.zeros(1, np.int32)
        self.left, self.right = np.array([-1], np.int32), np.array([-1], np.int32)
        self.value, self.cover = np.zeros(1), np.zeros(1)
        self.start = 0  # first node of the deepest level

    @property
    def open(self) -> int:
        return len(self.feature) - self.start

    def extend(self, node: np.ndarray, feature: np.ndarray, bin_: np.ndarray) -> None:
        """Splits nodes of the deepest level, counted from its start."""
        size, at = len(self.feature), self.start + node
        self.feature[at], self.bin[at] = feature, bin_
        self.left[at] = size + 2 * np.arange(len(node))
        self.right[at] = self.left[at] + 1
        new = 2 * len(node)
        for name, value in (("feature", -1), ("bin", 0), ("left", -1), ("right", -1), ("value", 0), ("cover", 0)):
            setattr(self, name, np.concatenate([getattr(self, name), np.full(new, value, getattr(self, name).dtype)]))
        self.start = size

    def step(self, bins: np.ndarray, node: np.ndarray, rows: np.ndarray) -> None:
        """Moves ``rows`` from nodes that were split to their children."""
        at = node[rows]
        inner = self.left[at] >= 0
        rows, at = rows[inner], at[inner]
        left = bins[rows, self.feature[at]] <= self.bin[at]
        node[rows] = np.where(left, self.left[at], self.right[at])

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(rows):
            self.step(bins, node, rows)
            rows = rows[self.left[node[rows]] >= 0]
        return node


def bootstrap(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree: the same wherever the row lies."""
    with np.errstate(over="ignore"):
        x = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + tree + 1) * 0x632BE59B)
        for a, b in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            x = (x ^ (x >> np.uint64(a))) * np.uint64(b)
        u = ((x ^ (x >> np.uint64(33))) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return np.searchsorted(POISSON, u, side="right").astype(np.float64)


def weights(model: Model, row: np.ndarray, train_from: np.ndarray, tree: int) -> np.ndarray:
    inside = (train_from <= model.fold).astype(np.float64)
    return inside * bootstrap(row, tree, model.seed) if model.objective == "forest" else inside


def gradients(model: Model, y: np.ndarray, fit: np.ndarray) -> np.ndarray:
    if model.objective == "quantile":
        return (y < fit).astype(np.float64)  # counted; ``best_splits`` makes gradients of counts
    return y if model.objective == "forest" else y - fit


def histogram(bins: np.ndarray, node: np.ndarray, weight: np.ndarray, gradient: np.ndarray) -> tuple[np.ndarray, ...]:
    """(cell, weight, gradient) of every non-empty (node, feature, bin), in order."""
    features = bins.shape[1]
    cell = ((node[:, None] * features + np.arange(features)) * BINS + bins).ravel()
    w, g = np.repeat(weight, features), np.repeat(weight * gradient, features)
    size = (int(node.max()) + 1) * features * BINS if len(node) else 0
    if size <= 4 * len(cell) + 65_536:
        found = np.flatnonzero(np.bincount(cell, minlength=size))
        return found, np.bincount(cell, w, size)[found], np.bincount(cell, g, size)[found]
    order = np.argsort(cell, kind="stable")
    return added(cell[order], w[order], g[order])


def added(cell: np.ndarray, *sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums by cell of values in the order of their cells."""
    if not len(cell):
        return cell, *sums
    at = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    return cell[at], *[np.add.reduceat(s, at) for s in sums]


def best_splits(cell: np.ndarray, w: np.ndarray, g: np.ndarray, features: int, model: Model) -> tuple[np.ndarray, ...]:
    """(node, feature, bin) of the best split of each node that has one; among equals the first feature and bin."""
    if not len(cell):
        return (np.zeros(0, np.int64),) * 3
    if model.objective == "quantile":
        g = model.alpha * w - g
    group = cell // BINS
    at = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[at, len(cell)])
    cw, cg = np.cumsum(w), np.cumsum(g)
    before_w, before_g = (np.repeat(c[at] - x[at], sizes) for c, x in ((cw, w), (cg, g)))
    left_w, left_g = cw - before_w, cg - before_g
    all_w, all_g = (np.repeat(np.add.reduceat(x, at), sizes) for x in (w, g))
    right_w, right_g = all_w - left_w, all_g - left_g
    least = max(model.min_rows, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_g**2 / left_w + right_g**2 / right_w - all_g**2 / all_w
    gain = np.where((left_w >= least) & (right_w >= least), gain, -1.0)
    node = group // features
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    top = np.maximum.reduceat(gain, first)
    # Rounding must not decide between features that part the rows alike.
    near = gain >= np.repeat(top - np.abs(top) * 1e-9, np.diff(np.r_[first, len(node)]))
    hit = np.flatnonzero(near)
    nodes, pick = np.unique(node[hit], return_index=True)
    pick, good = hit[pick], top > 1e-9 * np.maximum(1.0, np.abs(top))
    pick = pick[good]
    return nodes[good], group[pick] % features, cell[pick] % BINS


def leaf_ranges(node: np.ndarray, weight: np.ndarray, residual: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Weight, weighted sum, least and largest residual by node."""
    low, high = np.full(size, np.inf), np.full(size, -np.inf)
    np.minimum.at(low, node, residual)
    np.maximum.at(high, node, residual)
    return np.bincount(node, weight, size), np.bincount(node, weight * residual, size), low, high


def grid_counts(node: np.ndarray, weight: np.ndarray, residual: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    span = np.where(high > low, high - low, 1.0)
    part = np.minimum((residual - low[node]) / span[node] * GRID, GRID - 1).astype(np.int64)
    return np.bincount(node * GRID + part, weight, len(low) * GRID).reshape(len(low), GRID)


def grid_values(counts: np.ndarray, low: np.ndarray, high: np.ndarray, alpha: float) -> np.ndarray:
    """The quantile of each node from the counts on its grid: the upper end of the part that holds the rank."""
    total = np.cumsum(counts, axis=1)
    rank = np.ceil(alpha * total[:, -1] - 1e-9)
    part = (total < np.maximum(rank, 1)[:, None]).sum(axis=1)
    return np.where(high > low, low + (part + 1) / GRID * (high - low), low)


def set_values(tree: Tree, model: Model, stats: tuple[np.ndarray, ...], counts: np.ndarray | None) -> None:
    w, s, low, high = stats
    held = w > 0
    if model.objective == "quantile":
        tree.value[held] = grid_values(counts, np.where(held, low, 0.0), np.where(held, high, 0.0), model.alpha)[held]
    else:
        tree.value[held] = s[held] / w[held]
    # Rows of an inner node are those of its children, which lie behind it.
    tree.cover = w.copy()
    for i in np.flatnonzero(tree.left >= 0)[::-1]:
        tree.cover[i] = tree.cover[tree.left[i]] + tree.cover[tree.right[i]]


def grow_here(model: Model, base: float, part: dict[str, np.ndarray]) -> tuple[list[Tree], np.ndarray]:
    """All trees of a model on rows of one task, and the predictions of these rows."""
    bins, y, row, train_from = part["bins"], part["y"], part["row"], part["train_from"]
    chained = model.objective != "forest"
    fit, trees = np.full(len(y), base if chained else 0.0), []
    for i in range(model.rounds):
        tree, node = Tree(), np.zeros(len(y), np.int64)
        weight = weights(model, row, train_from, model.first + i)
        gradient = gradients(model, y, fit)
        going = np.arange(len(y))
        for _ in range(model.depth):
            used = going[weight[going] > 0]
            sums = histogram(bins[used], node[used] - tree.start, weight[used], gradient[used])
            splits = best_splits(*sums, bins.shape[1], model)
            if not len(splits[0]):
                break
            tree.extend(*splits)
            tree.step(bins, node, going)
            going = going[node[going] >= tree.start]
        used = np.flatnonzero(weight)
        residual = (y - fit if chained else y)[used]
        stats = leaf_ranges(node[used], weight[used], residual, len(tree.feature))
        counts = None
        if model.objective == "quantile":
            low, high = (np.where(stats[0] > 0, x, 0.0) for x in stats[2:])
            counts = grid_counts(node[used], weight[used], residual, low, high)
        set_values(tree, model, stats, counts)
        trees.append(tree)
        fit = fit + (model.rate if chained else 1.0) * tree.value[node]
    return trees, fit


def flat(trees: list[Tree], edges: list[list[float]]) -> dict[str, np.ndarray]:
    """Trees one behind another, children counted from the first node of all."""
    sizes = np.array([len(t.feature) for t in trees], np.int32)
    start = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int32)
    out = {c: np.concatenate([getattr(t, c) for t in trees]) for c in ("feature", "bin", "value", "cover")}
    for c in ("left", "right"):
        out[c] = np.concatenate([np.where(getattr(t, c) >= 0, getattr(t, c) + s, -1) for t, s in zip(trees, start, strict=True)])
    inner = out["feature"] >= 0
    out["threshold"] = np.zeros(len(inner))
    # Bin 0 holds missing values, bin b those above edge b - 2 up to edge b - 1.
    out["threshold"][inner] = [
        -np.inf if b == 0 else edges[f][b - 1] for f, b in zip(out["feature"][inner], out["bin"][inner], strict=True)
    ]
    return {**out, "start": start}


# ---- rows ------------------------------------------------------------------------------------


@dataclass
class Binned:
    """Rows ready for growing: ``blocks`` of binned rows and, by ``_row``, the ``rows`` they were made of."""

    rows: DataFrame
    blocks: DataFrame
    edges: list[list[float]]
    n: int
    n_splits: int


def fold_columns(df: DataFrame, n_splits: int, gap: int, on_short: str = "error") -> DataFrame:
    """``_test_fold`` (-1 for none) and ``_train_from``, the first fold that trains on the row; the folds are those of
    ``evaluate.fold_members``, a later fold trains on all an earlier one does, fold ``n_splits`` on everything."""
    n, row = F.col("series_rows"), F.col("row_no")
    size = F.floor(n / (n_splits + 1))
    short = (size < 1) | ((n - gap - size * n_splits) <= 0)
    start = n - size * n_splits
    wide = F.greatest(size, F.lit(1))
    test: Column = F.when(~short & (row >= start), F.floor((row - start) / wide)).otherwise(-1)
    after = F.floor((size * n_splits - (n - gap - row)) / wide) + 1
    train = F.when(short, F.lit(n_splits)).otherwise(F.least(F.greatest(after, F.lit(0)), F.lit(n_splits)))
    if on_short == "error":
        text = F.lit(f"a series is too short for {n_splits} folds with gap {gap}")
        test = F.when(short, F.raise_error(text).cast("long")).otherwise(test)
    return df.withColumn("_test_fold", test.cast("long")).withColumn("_train_from", train.cast("long"))


def feature_edges(df: DataFrame, features: list[str], bins: int = BINS) -> list[list[float]]:
    """Upper ends of the bins of each feature: quantiles of its values, ``bins`` - 2 of them at most."""
    at = [i / (bins - 1) for i in range(1, bins - 1)]
    found = df.agg(*[F.percentile_approx(F.col(f), at, 10_000) for f in features]).first()
    return [sorted(set(e or [])) for e in found]


def prepare(
    indexed: DataFrame, target: str, features: list[str], n_splits: int = 5, gap: int = DAY_PERIODS, on_short: str = "error",
    block_rows: int = BLOCK_ROWS,
) -> Binned:
    """``indexed`` carries row_no and series_rows, see ``windows.row_index``; rows without a target are left out."""
    ship(indexed.sparkSession)
    kept = fold_columns(indexed.filter(F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double"))), n_splits, gap, on_short)
    kept = settled(kept.withColumn("_row", F.monotonically_increasing_id()))
    numbers = [F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f"f{i}") for i, f in enumerate(features)]
    narrow = kept.select("_row", F.col(target).cast("double").alias("_y"), "_test_fold", "_train_from", *numbers)
    n = narrow.count()
    if not n:
        raise ValueError("no rows to train on")
    edges = feature_edges(narrow, [f"f{i}" for i in range(len(features))])
    binned = narrow.repartition(max(1, -(-n // block_rows))).mapInArrow(_to_blocks(edges, block_rows), BLOCK)
    path = work_path(indexed.sparkSession, "binned")
    binned.write.parquet(path)
    return Binned(kept, indexed.sparkSession.read.schema(BLOCK).parquet(path), edges, n, n_splits)


def _to_blocks(edges: list[list[float]], block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        # A partition holds about block_rows rows; the rest makes blocks of its own.
        for i in range(0, table.num_rows, block_rows):
            part = table.slice(i, block_rows)
            bins = np.zeros((part.num_rows, len(edges)), np.uint8)
            for k, e in enumerate(edges):
                values = part.column(f"f{k}").to_numpy()
                held = ~np.isnan(values)
                bins[held, k] = 1 + np.searchsorted(np.array(e), values[held], side="left")
            row = part.column("_row").to_numpy()
            raw = {
                "block": int(row[0]) if len(row) else 0, "n": part.num_rows, "row": row.tobytes(), "bins": bins.tobytes(),
                "y": part.column("_y").to_numpy().tobytes(), "test_fold": part.column("_test_fold").to_numpy().tobytes(),
                "train_from": part.column("_train_from").to_numpy().tobytes(), "fit": None,
            }
            yield pa.RecordBatch.from_pylist([raw], schema=BLOCK_SCHEMA)

    return run


_KINDS = {"long": pa.int64(), "binary": pa.binary(), "int": pa.int32(), "double": pa.float64()}
BLOCK_SCHEMA = pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in BLOCK.split(", ")])


def _unpack(blocks: list[dict]) -> dict[str, np.ndarray]:
    blocks = sorted(blocks, key=lambda b: b["block"])
    out = {c: np.concatenate([np.frombuffer(b[c], np.int64) for b in blocks]) for c in ("row", "test_fold", "train_from")}
    out["y"] = np.concatenate([np.frombuffer(b["y"], np.float64) for b in blocks])
    out["bins"] = np.concatenate([np.frombuffer(b["bins"], np.uint8).reshape(b["n"], -1) for b in blocks])
    return out


def _bases(binned: Binned, models: list[Model], target: str) -> list[float]:
    """Where each model's predictions start: the quantile or mean of its training rows."""
    y = F.col(target).cast("double")
    wanted = sorted({(m.fold, m.alpha if m.objective == "quantile" else -1.0) for m in models})
    found = binned.rows.agg(
        *[
            F.percentile_approx(F.when(F.col("_train_from") <= fold, y), alpha, 10_000) if alpha >= 0
            else F.avg(F.when(F.col("_train_from") <= fold, y))
            for fold, alpha in wanted
        ]
    ).first()
    values = {w: float(v or 0.0) for w, v in zip(wanted, found, strict=True)}
    return [values[m.fold, m.alpha if m.objective == "quantile" else -1.0] for m in models]


@dataclass
class Grown:
    """``trees``: one row per model, by its place in ``models``. ``tested``: (model, row, prediction) of test rows, for
    a forest the sum over its trees."""

    models: list[Model]
    bases: list[float]
    trees: DataFrame
    tested: DataFrame


def grow(binned: Binned, models: list[Model], target: str, keep_trees: bool = True, local_rows: int = LOCAL_ROWS) -> Grown:
    bases = _bases(binned, models, target)
    if binned.n <= local_rows:
        return _grow_in_tasks(binned, models, bases, keep_trees)
    return _grow_together(binned, models, bases, keep_trees)


TESTED = "model int, row long, prediction double"


def _grow_in_tasks(binned: Binned, models: list[Model], bases: list[float], keep_trees: bool) -> Grown:
    spark, edges = binned.blocks.sparkSession, binned.edges
    schema = GROWN + ", row array<long>, prediction array<double>"

    def run(blocks: pa.Table) -> pa.Table:
        k = blocks.column("model")[0].as_py()
        part = _unpack(blocks.select([c for c in blocks.column_names if c != "model"]).to_pylist())
        trees, fit = grow_here(models[k], bases[k], part)
        inside = part["test_fold"] == models[k].fold
        out = flat(trees, edges) if keep_trees else {}
        found = {"model": k, "row": part["row"][inside], "prediction": fit[inside]}
        empty = [c.split()[0] for c in GROWN.split(", ")[1:]]
        found |= {c: out.get(c, np.zeros(0)) for c in empty}
        return pa.Table.from_pydict(
            {c: pa.array([v], t) for c, v, t in ((f.name, found[f.name], f.type) for f in _arrow(schema))}, schema=_arrow(schema)
        )

    each = binned.blocks.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(len(models) - 1))))
    # A partition each, as far as hashing spreads them: what a task does is far more than its bytes tell.
    grown = each.repartition(2 * len(models), "model").groupBy("model").applyInArrow(run, schema)
    path = work_path(spark, "trees")
    grown.write.parquet(path)
    found = spark.read.parquet(path)
    tested = found.select("model", F.explode(F.arrays_zip("row", "prediction")).alias("t")).select("model", "t.row", "t.prediction")
    return Grown(models, bases, found.drop("row", "prediction"), tested)


def _arrow(schema: str) -> pa.Schema:
    def kind(text: str) -> pa.DataType:
        return pa.list_(_KINDS[text[6:-1]]) if text.startswith("array") else _KINDS[text]

    return pa.schema([(c.split()[0], kind(c.split()[1])) for c in schema.split(", ")])


# ---- one aggregation per level, for all models together ----------------------------------------


def _fits(block: dict, models: list[Model], bases: list[float], recent: list[list[Tree]], bins: np.ndarray) -> list[np.ndarray]:
    """Predictions of a block's rows by each model: those stored, and the trees grown since."""
    if block["fit"] is None:
        fits = [np.full(block["n"], 0.0 if m.objective == "forest" else b) for m, b in zip(models, bases, strict=True)]
    else:
        fits = list(np.frombuffer(block["fit"], np.float64).reshape(len(models), block["n"]).copy())
    for trees in recent:
        for k, tree in enumerate(trees):
            rate = 1.0 if models[k].objective == "forest" else models[k].rate
            fits[k] = fits[k] + rate * tree.value[tree.leaves(bins)]
    return fits


def _each_block(models, bases, recent, visit, schema: pa.Schema):
    """A function for mapInArrow that calls ``visit(block, part, fits)`` for rows to return."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                part = _unpack([block])
                rows = visit(block, part, _fits(block, models, bases, recent, part["bins"]))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


CELLS = "model int, part long, cell binary, w binary, g binary"


def _cells(models, trees, done: int):
    def visit(block, part, fits):
        out = []
        for k, tree in enumerate(trees):
            node = tree.leaves(part["bins"])
            weight = weights(models[k], part["row"], part["train_from"], models[k].first + done)
            used = np.flatnonzero((node >= tree.start) & (weight > 0))
            if not tree.open or not len(used):
                continue
            gradient = gradients(models[k], part["y"], fits[k])[used]
            cell, w, g = histogram(part["bins"][used], node[used] - tree.start, weight[used], gradient)
            slot = cell // (NODES * part["bins"].shape[1] * BINS)
            for s in np.unique(slot).tolist():
                own = slot == s
                out.append({"model": k, "part": s, "cell": cell[own].tobytes(), "w": w[own].tobytes(), "g": g[own].tobytes()})
        return out

    return visit


def _split_groups(models, features: int):
    def run(rows: pa.Table) -> pa.Table:
        k = rows.column("model")[0].as_py()
        cell, w, g = (
            np.concatenate([np.frombuffer(x, kind) for x in rows.column(c).to_pylist()])
            for c, kind in (("cell", np.int64), ("w", np.float64), ("g", np.float64))
        )
        order = np.argsort(cell, kind="stable")
        node, feature, bin_ = best_splits(*added(cell[order], w[order], g[order]), features, models[k])
        return pa.table(
            {"model": pa.array([k] * len(node), pa.int32()), **{c: pa.array(x, pa.int64()) for c, x in (("node", node), ("feature", feature), ("bin", bin_))}}
        )

    return run


def _leaf_stats(models, trees, done: int, ranges: list | None):
    """Per model the sums and ranges of residuals by node, or with ``ranges`` their counts on the grid."""

    def visit(block, part, fits):
        out = []
        for k, tree in enumerate(trees):
            model = models[k]
            if ranges is not None and model.objective != "quantile":
                continue
            weight = weights(model, part["row"], part["train_from"], model.first + done)
            used = np.flatnonzero(weight)
            residual = (part["y"] if model.objective == "forest" else part["y"] - fits[k])[used]
            node = tree.leaves(part["bins"])[used]
            if ranges is None:
                w, s, low, high = leaf_ranges(node, weight[used], residual, len(tree.feature))
            else:
                counts = grid_counts(node, weight[used], residual, *ranges[k]).ravel()
                at = np.flatnonzero(counts)
                out += [{"model": k, "node": int(i), "w": float(counts[i]), "s": 0.0, "low": 0.0, "high": 0.0} for i in at.tolist()]
                continue
            out += [
                {"model": k, "node": i, "w": w[i], "s": s[i], "low": low[i], "high": high[i]} for i in np.flatnonzero(w > 0).tolist()
            ]
        return out

    return visit


STATS = "model int, node long, w double, s double, low double, high double"


def _summed(blocks: DataFrame, visit, models, bases, recent) -> list:
    """Added up by (model, node): at most a few thousand rows for each model, bounded by depth."""
    rows = blocks.mapInArrow(_each_block(models, bases, recent, visit, _arrow(STATS)), STATS)
    return rows.groupBy("model", "node").agg(F.sum("w").alias("w"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high")).collect()


def _grid_quantiles(blocks: DataFrame, ranges: list, models, trees, done, bases, recent) -> dict[int, np.ndarray]:
    """Counts on the grid, summed by (model, node) where the rank is found: a value for each leaf comes back."""
    rows = blocks.mapInArrow(
        _each_block(models, bases, recent, _leaf_stats(models, trees, done, ranges), _arrow(STATS)), STATS
    )
    counts = rows.groupBy("model", F.expr(f"node div {GRID}").alias("leaf"), (F.col("node") % GRID).alias("part")).agg(F.sum("w").alias("w"))
    per_leaf = counts.groupBy("model", "leaf").agg(F.collect_list(F.struct("part", "w")).alias("parts")).collect()
    out = {k: np.zeros((len(t.feature), GRID)) for k, t in enumerate(trees)}
    for r in per_leaf:
        for part, w in r["parts"]:
            out[r["model"]][r["leaf"], part] = w
    return out


def _grow_together(binned: Binned, models: list[Model], bases: list[float], keep_trees: bool) -> Grown:
    spark, features = binned.blocks.sparkSession, len(binned.edges)
    kept, tested = [], []
    for shape, chosen in _batches(models):
        own, own_bases = [models[k] for k in chosen], [bases[k] for k in chosen]
        blocks, recent, grown = binned.blocks, [], [[] for _ in own]
        for done in range(shape[1]):
            trees = [Tree() for _ in own]
            for _ in range(shape[2]):
                cells = blocks.mapInArrow(_each_block(own, own_bases, recent, _cells(own, trees, done), _arrow(CELLS)), CELLS)
                splits = cells.groupBy("model", "part").applyInArrow(
                    _split_groups(own, features), "model int, node long, feature long, bin long"
                ).collect()
                if not splits:
                    break
                for k, tree in enumerate(trees):
                    mine = sorted((r["node"], r["feature"], r["bin"]) for r in splits if r["model"] == k)
                    tree.extend(*(np.array(mine, np.int64).reshape(-1, 3).T))
            stats = [tuple(np.full(len(t.feature), v) for v in (0.0, 0.0, np.inf, -np.inf)) for t in trees]
            for r in _summed(blocks, _leaf_stats(own, trees, done, None), own, own_bases, recent):
                for column, name in zip(stats[r["model"]], ("w", "s", "low", "high"), strict=True):
                    column[r["node"]] = r[name]
            counts = {}
            if shape[0] == "quantile":
                ranges = [tuple(np.where(s[0] > 0, x, 0.0) for x in s[2:]) for s in stats]
                counts = _grid_quantiles(blocks, ranges, own, trees, done, own_bases, recent)
            for k, tree in enumerate(trees):
                set_values(tree, own[k], stats[k], counts.get(k))
                if keep_trees:
                    grown[k].append(tree)
            recent.append(trees)
            if len(recent) == EVERY and done + 1 < shape[1]:
                path = work_path(spark, "binned")
                blocks.mapInArrow(_each_block(own, own_bases, recent, _with_fits, BLOCK_SCHEMA), BLOCK).write.parquet(path)
                blocks, recent = spark.read.schema(BLOCK).parquet(path), []
        path = work_path(spark, "tested")
        blocks.mapInArrow(_each_block(own, own_bases, recent, _tested(own, chosen), _arrow(TESTED)), TESTED).write.parquet(path)
        tested.append(spark.read.parquet(path))
        for k, trees in zip(chosen, grown, strict=True):
            if trees:
                kept.append({"model": k, **{c: v.tolist() for c, v in flat(trees, binned.edges).items()}})
    names = [c.split()[0] for c in GROWN.split(", ")]
    trees = spark.createDataFrame([tuple(r[c] for c in names) for r in kept], GROWN)
    out = tested[0]
    for more in tested[1:]:
        out = out.unionByName(more)
    return Grown(models, bases, trees, out)


def _batches(models: list[Model]) -> list[tuple[tuple, list[int]]]:
    """Models of one shape, so many at once that their trees have no more than LEVEL_NODES nodes in a level."""
    shapes = [(m.objective, m.rounds, m.depth) for m in models]
    out = []
    for shape in sorted(set(shapes)):
        own = [k for k, s in enumerate(shapes) if s == shape]
        size = max(1, LEVEL_NODES >> min(shape[2], 15))
        out += [(shape, own[i : i + size]) for i in range(0, len(own), size)]
    return out


def _with_fits(block, part, fits):
    return [{**block, "fit": np.concatenate(fits).tobytes()}]


def _tested(models, numbers):
    def visit(block, part, fits):
        out = []
        for k, model in enumerate(models):
            for i in np.flatnonzero(part["test_fold"] == model.fold).tolist():
                out.append({"model": numbers[k], "row": int(part["row"][i]), "prediction": float(fits[k][i])})
        return out

    return visit


# ---- training and comparison -------------------------------------------------------------------


def train_quantiles(
    indexed: DataFrame,
    target: str,
    features: list[str],
    alphas: list[float] = (0.1, 0.5, 0.9),
    n_splits: int = 5,
    gap: int = DAY_PERIODS,
    on_short: str = "error",
    local_rows: int = LOCAL_ROWS,
    **growth,
) -> tuple[DataFrame, DataFrame]:
    """Models (name, fold, alpha, base, rate and trees; fold ``n_splits`` is trained on all rows), and the out-of-fold
    predictions p10, p50, p90 beside the columns of ``indexed``, for every test row."""
    binned = prepare(indexed, target, features, n_splits, gap, on_short)
    models = [Model(_name(a), fold, alpha=a, **growth) for fold in range(n_splits + 1) for a in alphas]
    grown = grow(binned, models, target, local_rows=local_rows)
    named = grown.tested.join(F.broadcast(_described(grown).select("model", "name", "fold")), "model")
    wide = named.groupBy("row", "fold").agg(*[F.max(F.when(F.col("name") == _name(a), F.col("prediction"))).alias(_name(a)) for a in alphas])
    predicted = binned.rows.drop("_test_fold", "_train_from").join(wide, F.col("_row") == F.col("row")).drop("_row", "row")
    described = F.broadcast(_described(grown))
    return grown.trees.join(described, "model").drop("model"), predicted


def _name(alpha: float) -> str:
    return f"p{round(alpha * 100)}"


def _described(grown: Grown) -> DataFrame:
    rows = [(k, m.name, m.fold, m.alpha, float(b), m.rate) for k, (m, b) in enumerate(zip(grown.models, grown.bases, strict=True))]
    spark = grown.trees.sparkSession
    return spark.createDataFrame(rows, "model int, name string, fold int, alpha double, base double, rate double")


#: Sizes of the forests compared, each a prefix of the next.
FOREST_SIZES = (25, 50, 125, 250, 500, 750)


def learners(sizes: tuple[int, ...] = FOREST_SIZES, forest_depth: int = 15, rounds: tuple[int, int] = (100, 1000)) -> dict[str, Model]:
    """The learners compared: a free and a shallow tree, one forest in all its sizes, boosting short, long, and long
    with trees of twice the leaves."""
    boost = {"objective": "squared", "rate": 0.1}
    return {
        "decision_tree_free": Model("decision_tree_free", 0, "squared", rounds=1, rate=1.0, depth=30, min_rows=1),
        "decision_tree_5": Model("decision_tree_5", 0, "squared", rounds=1, rate=1.0, depth=5, min_rows=1),
        "random_forest": Model("random_forest", 0, "forest", rounds=max(sizes), depth=forest_depth, min_rows=1),
        f"boosting_{rounds[0]}": Model(f"boosting_{rounds[0]}", 0, rounds=rounds[0], **boost),
        f"boosting_{rounds[1]}": Model(f"boosting_{rounds[1]}", 0, rounds=rounds[1], **boost),
        f"boosting_{rounds[1]}_wide": Model(f"boosting_{rounds[1]}_wide", 0, rounds=rounds[1], depth=6, **boost),
    }


def compare_models(
    indexed: DataFrame,
    target: str,
    features: list[str],
    chosen: dict[str, Model] | None = None,
    sizes: tuple[int, ...] = FOREST_SIZES,
    n_splits: int = 5,
    gap: int = DAY_PERIODS,
    on_short: str = "error",
    local_rows: int = LOCAL_ROWS,
) -> DataFrame:
    """(model, pinball_loss, mae) on identical folds, best first; mae is twice the loss.

    A forest is grown once per fold, in runs of trees between its sizes; the mean over a prefix of the runs is the
    prediction of the smaller forest."""
    binned = prepare(indexed, target, features, n_splits, gap, on_short)
    run = int(np.gcd.reduce(sizes))
    models = []
    for model in (chosen or learners(sizes)).values():
        for fold in range(n_splits):
            if model.objective != "forest":
                models.append(replace(model, fold=fold))
                continue
            models += [replace(model, fold=fold, first=i, rounds=min(run, model.rounds - i)) for i in range(0, model.rounds, run)]
    grown = grow(binned, models, target, keep_trees=False, local_rows=local_rows)
    named = [(k, m.name, m.first, m.objective == "forest") for k, m in enumerate(models)]
    spark = indexed.sparkSession
    described = F.broadcast(spark.createDataFrame(named, "model int, name string, first int, summed boolean"))
    tested = grown.tested.join(described, "model")
    single = tested.filter("NOT summed").select("row", "name", "prediction")
    sums = tested.filter("summed").groupBy("row", "name").agg(
        *[F.sum(F.when(F.col("first") < k, F.col("prediction"))).alias(f"s{k}") for k in sizes]
    )
    means = F.array(*[F.struct(F.concat_ws("_", "name", F.lit(str(k))).alias("name"), (F.col(f"s{k}") / k).alias("prediction")) for k in sizes])
    forests = sums.select("row", F.inline(means)).select("row", "name", "prediction")
    actual = binned.rows.select(F.col("_row").alias("row"), F.col(target).cast("double").alias("_y"))
    loss = F.avg(F.abs(F.col("_y") - F.col("prediction")) / 2)
    return (
        single.unionByName(forests)
        .join(actual, "row")
        .groupBy(F.col("name").alias("model"))
        .agg(loss.alias("pinball_loss"), (loss * 2).alias("mae"))
        .orderBy("pinball_loss")
    )
