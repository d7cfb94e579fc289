"""Stored tree models applied to rows: predictions, and Shapley attributions of each feature.

The attribution of a feature is its share of ``prediction - base`` where, for a set of known features, a tree's
value is the mean over its leaves that the known features allow, unknown ones weighted by the training rows
on each side of a split. A leaf depends on the few features on its path only. For each leaf the shares are worked
out once for all patterns of "the row meets this feature's splits"; a pass over rows then finds each row's
pattern and adds the shares. The attributions of a row add up to its prediction minus the mean prediction.

A missing feature goes left at every split. Models go to the tasks after their size was checked (``MODEL_BYTES``);
more are an error, as the number of trees is chosen by the caller and doesn't grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.session import ship

#: Bytes of model arrays that one pass may carry to the tasks.
MODEL_BYTES = 64 << 20
#: Different features on one path; a leaf's shares are tabled for 2 to this power patterns.
PATH_FEATURES = 12
ARRAYS = ("feature", "threshold", "left", "right", "value", "cover", "start")


def collected(models: DataFrame, columns: list[str]) -> list[dict]:
    """Models as arrays on the driver, after their size was checked."""
    nodes = models.agg(F.sum(F.size("feature"))).first()[0] or 0
    if nodes * 40 > MODEL_BYTES:
        raise ValueError(f"{nodes} nodes are more than one pass may carry; score these models in parts")
    out = []
    for r in models.select(*columns, *ARRAYS).collect():
        out.append({**{c: r[c] for c in columns}, **{c: np.array(r[c]) for c in ARRAYS}})
    return out


def leaves(model: dict, x: np.ndarray, tree: int) -> np.ndarray:
    """The leaf of each row of a matrix (missing values NaN) in a tree."""
    feature, threshold, left, right = (model[c] for c in ("feature", "threshold", "left", "right"))
    node = np.full(len(x), model["start"][tree], np.int64)
    going = np.flatnonzero(left[node] >= 0)
    while len(going):
        at = node[going]
        node[going] = np.where(_meets(x[going, feature[at]], threshold[at]), left[at], right[at])
        going = going[left[node[going]] >= 0]
    return node


def _meets(values: np.ndarray, threshold) -> np.ndarray:
    return np.isnan(values) | (values <= threshold)


def predictions(model: dict, x: np.ndarray) -> np.ndarray:
    total = np.full(len(x), model["base"])
    for tree in range(len(model["start"])):
        total += model["rate"] * model["value"][leaves(model, x, tree)]
    return total


def paths(model: dict, tree: int) -> list[tuple[int, list[tuple[int, float, bool, float]]]]:
    """For each leaf its splits: (feature, threshold, whether the path goes left, share of training rows that do)."""
    out, todo = [], [(int(model["start"][tree]), [])]
    while todo:
        node, path = todo.pop()
        if model["left"][node] < 0:
            out.append((node, path))
            continue
        for child, goes_left in ((model["left"][node], True), (model["right"][node], False)):
            share = model["cover"][child] / model["cover"][node] if model["cover"][node] else 0.0
            todo.append((int(child), [*path, (int(model["feature"][node]), float(model["threshold"][node]), goes_left, share)]))
    return out


def share_table(hidden: np.ndarray, value: float) -> np.ndarray:
    """[pattern, feature]: what each feature of a path gets of its leaf's value, if bit f of the pattern says that the
    row meets feature f's splits. ``hidden``: the weight a feature gives the leaf while it is unknown."""
    k = len(hidden)
    if k > PATH_FEATURES:
        raise ValueError(f"a path with {k} different features; at most {PATH_FEATURES} are supported")
    met = (np.arange(1 << k)[:, None] >> np.arange(k)) & 1
    table = np.zeros((1 << k, k))
    for f in range(k):
        others = [j for j in range(k) if j != f]
        for size in range(k):
            weight = factorial(size) * factorial(k - size - 1) / factorial(k)
            for known in combinations(others, size):
                unknown = [j for j in others if j not in known]
                product = met[:, list(known)].prod(axis=1) * np.prod(hidden[unknown])
                table[:, f] += weight * product * (met[:, f] - hidden[f])
    return table * value


def prepared(model: dict) -> list[list[tuple]]:
    """Per tree, per leaf: (features, for each the tests of its splits, table of shares)."""
    out = []
    for tree in range(len(model["start"])):
        own = []
        for leaf, path in paths(model, tree):
            used = sorted({f for f, *_ in path})
            tests = [[(t, goes_left) for g, t, goes_left, _ in path if g == f] for f in used]
            hidden = np.array([np.prod([s for g, _, _, s in path if g == f]) for f in used])
            own.append((used, tests, share_table(hidden, model["rate"] * model["value"][leaf])))
        out.append(own)
    return out


def expected(model: dict) -> float:
    """The mean prediction over training rows."""
    total = float(model["base"])
    for tree in range(len(model["start"])):
        for leaf, path in paths(model, tree):
            total += model["rate"] * float(model["value"][leaf]) * float(np.prod([s for *_, s in path]))
    return total


def attributions(trees: list[list[tuple]], x: np.ndarray) -> np.ndarray:
    """[row, feature] for a matrix, with what ``prepared`` gives."""
    total = np.zeros(x.shape)
    for own in trees:
        tests: dict[tuple[int, float], np.ndarray] = {}
        for used, splits, table in own:
            pattern = np.zeros(len(x), np.int64)
            for bit, (f, each) in enumerate(zip(used, splits, strict=True)):
                met = np.ones(len(x), dtype=bool)
                for threshold, goes_left in each:
                    if (f, threshold) not in tests:
                        tests[f, threshold] = _meets(x[:, f], threshold)
                    met &= tests[f, threshold] == goes_left
                pattern |= met.astype(np.int64) << bit
            if used:
                total[:, used] += table[pattern]
    return total


def _matrix(batch: pa.RecordBatch, n: int) -> np.ndarray:
    columns = [batch.column(f"f{i}").to_numpy(zero_copy_only=False).astype(np.float64) for i in range(n)]
    return np.column_stack(columns) if n else np.zeros((batch.num_rows, 0))


def _with_features(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    numbers = [F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f"f{i}") for i, f in enumerate(features)]
    return df.select(F.struct(*keep).alias("kept"), *numbers) if keep else df.select(F.lit(0).alias("kept"), *numbers)


def score(df: DataFrame, models: DataFrame, features: list[str], names: list[str] = ("p10", "p50", "p90")) -> DataFrame:
    """``df`` with a column of predictions for each named model; ``features`` in the order they were trained in."""
    ship(df.sparkSession)
    by_name = {m["name"]: m for m in collected(models, ["name", "base", "rate"])}
    missing = [n for n in names if n not in by_name]
    if missing:
        raise ValueError(f"no model named {', '.join(missing)}")
    rows = _with_features(df, features, df.columns)
    kept = rows.schema["kept"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, len(features))
            found = [pa.array(predictions(by_name[n], x)) for n in names]
            yield pa.RecordBatch.from_arrays([batch.column("kept"), *found], names=["kept", *names])

    schema = T.StructType([T.StructField("kept", kept), *[T.StructField(n, T.DoubleType()) for n in names]])
    return rows.mapInArrow(run, schema).select("kept.*", *names)


def attribute(df: DataFrame, models: DataFrame, features: list[str], name: str = "p50", keep: list[str] = ()) -> DataFrame:
    """Columns ``keep``, prediction, base (the mean prediction) and attributions, an array in the order of ``features``."""
    ship(df.sparkSession)
    found = collected(models.filter(F.col("name") == name), ["name", "base", "rate"])
    if len(found) != 1:
        raise ValueError(f"{len(found)} models named {name}")
    model = found[0]
    rows, mean, trees = _with_features(df, features, list(keep)), expected(model), prepared(model)
    fields = [rows.schema["kept"], T.StructField("prediction", T.DoubleType()), T.StructField("attributions", T.ArrayType(T.DoubleType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, len(features))
            shares = attributions(trees, x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(features), pa.int32()), pa.array(shares.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array(predictions(model, x)), lists], names=["kept", "prediction", "attributions"]
            )

    out = rows.mapInArrow(run, T.StructType(fields)).withColumn("base", F.lit(mean))
    return out.select(*(["kept.*"] if keep else []), "prediction", "base", "attributions")


def mean_attribution(attributed: DataFrame, features: list[str]) -> DataFrame:
    """(feature, mean_abs, mean): how much each feature moves predictions, and which way, largest first."""
    each = attributed.select(F.posexplode("attributions").alias("i", "share"))
    names = F.array(*[F.lit(f) for f in features])
    return (
        each.groupBy("i")
        .agg(F.avg(F.abs("share")).alias("mean_abs"), F.avg("share").alias("mean"))
        .select(F.get(names, F.col("i")).alias("feature"), "mean_abs", "mean")
        .orderBy(F.desc("mean_abs"), "feature")
    )
