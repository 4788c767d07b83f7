"""M1: boosted classification trees grown from histograms of rows that are kept as bytes.

The trees are those of Spark's ``GBTClassifier``: the same candidate thresholds, log loss, variance gain, order
of ties and leaves.  Spark keeps every binned row as several objects and sends each through a zip, a walk and an
update per feature in every pass.  Here a row is one byte a feature, one for its class and its margin, in blocks
of many rows; a pass is one job, in which tasks add up their blocks' histograms (rows and residuals per open
node and bin) and the driver picks the splits from the sum, whose size does not depend on the rows.
The fitted trees become an ordinary ``GBTClassificationModel``, by way of its saved form.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroframe.session import shared_path

BLOCK = 1 << 16           # rows of a block
PARTITION_ROWS = 1 << 21  # rows of a partition, at most
LINEAGE = 40              # rounds after which the margins are taken anew from the binned rows
COLLECTED = 64            # histograms that the driver adds itself; more are added in tasks first

NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
         "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, "
         "numCategories: int>>")


def covers(trees) -> bool:
    """Whether *trees* is an estimator with settings that ``fit_trees`` has (others are left to Spark's own fit)."""
    plain = {"subsamplingRate": 1.0, "featureSubsetStrategy": "all", "minInstancesPerNode": 1, "minInfoGain": 0.0,
             "minWeightFractionPerNode": 0.0}
    return (isinstance(trees, GBTClassifier) and trees.getMaxBins() <= 256
            and all(trees.getOrDefault(k) == v for k, v in plain.items())
            and not any(trees.isSet(k) for k in ("weightCol", "validationIndicatorCol")))


def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """At most *most* candidate thresholds, as Spark places them: every midpoint, or those nearest to equal shares of *values*."""
    distinct, counts = np.unique(values, return_counts=True)
    mid = (distinct[:-1] + distinct[1:]) / 2
    if len(mid) <= most:
        return mid
    stride = len(values) / (most + 1)
    upto, target, at = np.cumsum(counts), stride, []
    for i in range(len(mid)):
        if abs(upto[i] - target) < abs(upto[i + 1] - target):
            at.append(i)
            target += stride
    return mid[at]


def _blocks(rows: DataFrame, cuts: list[np.ndarray], n: int):
    """Blocks (bins by feature, classes -1 / 1) of *rows* [x, label], dealt evenly; features without a threshold are left out."""
    used = [j for j, t in enumerate(cuts) if len(t)] or [0]

    def binned(batches):
        held, size = [], 0

        def block():
            bins, y = (np.concatenate(part, axis=-1) for part in zip(*held))
            return pa.RecordBatch.from_pydict({"bins": pa.array([bins.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary())})

        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column(1).to_numpy(zero_copy_only=False)
            if not np.isin(y, (0, 1)).all():
                raise ValueError("a label is neither 0 nor 1")
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            bins = np.array([np.searchsorted(cuts[j], x[:, j]) for j in used], dtype=np.uint8).reshape(len(used), len(y))
            held.append((bins, np.where(y > 0, 1, -1).astype(np.int8)))
            size += len(y)
            if size >= BLOCK:
                yield block()
                held, size = [], 0
        if held:
            yield block()

    def arrays(row):
        y = np.frombuffer(row.y, dtype=np.int8)
        return np.frombuffer(row.bins, dtype=np.uint8).reshape(len(used), len(y)), y

    cores, schema = rows.sparkSession.sparkContext.defaultParallelism, "bins binary, y binary"
    whole = n <= cores * BLOCK
    if whole:  # too few blocks to deal: the rows stay where they lie
        blocks = rows.coalesce(max(2, -(-n // BLOCK))).mapInArrow(binned, schema)
    else:
        blocks = rows.mapInArrow(binned, schema).repartition(cores * -(-n // (PARTITION_ROWS * cores)))
    return blocks.rdd.map(arrays), used, whole


def _leaf(bins: np.ndarray, tree: dict, n: int) -> np.ndarray:
    """The node of every row in the *tree* as far as it is grown."""
    at, flat, rows = np.zeros(n, dtype=np.int64), bins.ravel(), np.arange(n)
    inner = tree["child"] >= 0
    to, cut = np.where(inner, tree["child"], np.arange(len(inner))), np.where(inner, tree["cut"], 255)  # a leaf leads to itself
    for _ in range(tree["depth"]):
        at = to.take(at) + (flat.take((tree["slot"] * n).take(at) + rows) > cut.take(at))
    return at


def _residuals(y: np.ndarray, margin) -> np.ndarray:
    """What a tree is fitted to: the classes in the first round, then the negative gradient of the log loss."""
    if margin is None:
        return y.astype(np.float64)
    with np.errstate(over="ignore"):
        return 4.0 * y / (1.0 + np.exp(2.0 * y * margin))


def _raised(state, tree: dict):
    """A block's *state* (bins, classes, margin) after *tree*."""
    bins, y, margin = state
    step = tree["weight"] * tree["value"][_leaf(bins, tree, len(y))]
    return bins, y, step if margin is None else margin + step


def _scored(block, trees: list[dict]):
    state = *block, None
    for tree in trees:
        state = _raised(state, tree)
    return state


def _histogram(state, tree: dict, opened: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Rows, residuals and their squares by open node and bin, the features one after the other, of one block."""
    bins, y, margin = state
    r, k = _residuals(y, margin), len(opened)
    node = np.full(len(tree["child"]), -1)
    node[opened] = np.arange(k)
    node = node[_leaf(bins, tree, len(y))]
    if (node < 0).any():
        rows = np.flatnonzero(node >= 0)
        bins, r, node = bins[:, rows], r[rows], node[rows]
    out, start, squares = np.empty((3, k, sum(sizes))), 0, r * r
    for of, size in zip(bins, sizes):
        key = node * size + of
        for part, w in zip(out, (None, r, squares)):
            part[:, start:start + size] = np.bincount(key, w, k * size).reshape(k, size)
        start += size
    return out


def _added(rdd) -> np.ndarray:
    return rdd.treeReduce(np.add) if rdd.getNumPartitions() > COLLECTED else rdd.reduce(np.add)


def _impurity(n, s, sq):
    """The variance, as Spark's trees reckon it."""
    return np.where(n > 0, (sq - s * s / n) / n, 0.0)


@np.errstate(divide="ignore", invalid="ignore")
def best_splits(hist: np.ndarray, known: list, sizes: list[int]):
    """Per node its (rows, residuals, squares) and the (gain, feature, bin, left sums, right sums) of its first best split, or None.

    *known* has the sums of a node whose parent was split: they come from that split.
    """
    best, start, sums = [None] * len(known), 0, list(known)
    for j, size in enumerate(sizes):
        upto = np.cumsum(hist[:, :, start:start + size], axis=2)
        start += size
        left, total = upto[:, :, :-1], upto[:, :, -1:]
        right = total - left
        for v, was in enumerate(sums):
            if was is None:
                sums[v] = left[:, v, 0] + right[:, v, 0] if size > 1 else total[:, v, 0]
        if size == 1:
            continue
        n = left[0] + right[0]
        whole = np.array([_impurity(*x) for x in sums])[:, None]
        gain = whole - left[0] / n * _impurity(*left) - right[0] / n * _impurity(*right)
        gain = np.where((left[0] >= 1) & (right[0] >= 1), gain, -1.0)
        for v, b in enumerate(np.argmax(gain, axis=1).tolist()):
            if gain[v, b] > (best[v][0] if best[v] else 0.0):
                best[v] = float(gain[v, b]), j, b, left[:, v, b], right[:, v, b]
    return list(zip(sums, best))


def _grown(state, old, depth: int, weight: float, sizes: list[int], whole: bool) -> dict:
    """The next tree, a job for each level.  The first job keeps the blocks of *state*; those of *old*, from which they come, are let go then.

    Of two sides of a split the one with fewer rows is counted and the other is what is left of the node, unless *whole*: then
    both are counted, which rounds the sums as Spark does.
    """
    tree = {"weight": weight, "depth": 0, "slot": [0], "cut": [0], "child": [-1], "value": [0.0], "gain": [-1.0], "sums": [None]}
    opened, counted, kin, held = [0], [0], {}, {}
    for level in range(max(depth, 1)):
        now = {k: np.array(tree[k]) for k in ("slot", "cut", "child")} | {"depth": level}
        if level:
            counted = opened if whole else sorted({light for _, light in (kin[v] for v in opened)})
        hist = _added(state.map(lambda s, at=np.array(counted): _histogram(s, now, at, sizes)))
        if level == 0 and old is not None:
            old.unpersist()
        got = dict(zip(counted, hist.transpose(1, 0, 2)))
        held = {v: got[v] if v in got else held[kin[v][0]] - got[kin[v][1]] for v in opened}
        found = best_splits(np.stack(list(held.values()), axis=1), [tree["sums"][v] for v in opened], sizes)
        opened = []
        for v, (sums, split) in zip(held, found):
            tree["sums"][v], tree["value"][v] = sums, sums[1] / sums[0]
            if split is None or not depth:
                continue
            c = len(tree["child"])
            tree["gain"][v], tree["slot"][v], tree["cut"][v], left, right = split
            tree["child"][v] = c
            for u, side in ((c, left), (c + 1, right)):
                kin[u] = v, c if left[0] <= right[0] else c + 1
                if abs(_impurity(*side)) >= np.finfo(float).eps:
                    opened.append(u)
                for k, x in (("slot", 0), ("cut", 0), ("child", -1), ("value", side[1] / side[0]), ("gain", -1.0), ("sums", side)):
                    tree[k].append(x)
        tree["depth"] = level + 1
        if not opened:
            break
    return tree | {k: np.array(tree[k]) for k in ("slot", "cut", "child", "value")}


def boost(base, rounds: int, depth: int, rate: float, sizes: list[int], whole: bool) -> list[dict]:
    """The trees fitted to the binned blocks *base*, one after the other."""
    trees, old, state = [], None, base.map(lambda b: _scored(b, [])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for m in range(rounds):
            trees.append(_grown(state, old, depth, 1.0 if m == 0 else rate, sizes, whole))
            slim = [{k: t[k] for k in ("weight", "depth", "slot", "cut", "child", "value")} for t in trees]
            old = state
            state = (base.map(lambda b, ts=slim: _scored(b, ts)) if (m + 1) % LINEAGE == 0
                     else state.map(lambda s, t=slim[-1]: _raised(s, t))).persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        for rdd in (old, state):
            if rdd is not None:
                rdd.unpersist()
    return trees


def _nodes(tree: dict, number: int, used: list[int], cuts: list[np.ndarray]) -> list[tuple]:
    """The rows of *tree* in the model's saved form, in preorder; two leaves that say the same are one."""
    rows = []

    def put(v):
        i, c = len(rows), int(tree["child"][v])
        sums = [float(x) for x in tree["sums"][v]]
        head = (float(tree["value"][v]), float(_impurity(*tree["sums"][v])), sums, int(sums[0]))
        rows.append(None)
        left = right = -1
        if c >= 0:
            left, right = put(c), put(c + 1)
            if all(rows[k][1][6] < 0 for k in (left, right)) and rows[left][1][1] == rows[right][1][1]:
                del rows[i + 1:]
                left = right = -1
        split, gain = (-1, [], -1), -1.0
        if left >= 0:
            j, gain = used[tree["slot"][v]], float(tree["gain"][v])
            split = (j, [float(cuts[j][tree["cut"][v]])], -1)
        rows[i] = (number, (i, *head, gain, left, right, split))
        return i

    put(0)
    return rows


def _model(spark, trees: GBTClassifier, fitted: list[tuple], weights: list[float], width: int) -> GBTClassificationModel:
    path = shared_path(spark, "trees")
    trees.write().save(f"{path}/estimator")
    about = json.loads(spark.read.text(f"{path}/estimator/metadata").first()[0])
    tree = about | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "paramMap": {}, "defaultParamMap": {}}
    about |= {"class": "org.apache.spark.ml.classification.GBTClassificationModel", "numFeatures": width, "numTrees": len(weights)}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    spark.createDataFrame([(i, json.dumps(tree | {"uid": f"{about['uid']}_{i}"}), w) for i, w in enumerate(weights)],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    spark.createDataFrame(fitted, NODES).coalesce(1).write.parquet(f"{path}/model/data")
    return GBTClassificationModel.load(f"{path}/model")


def fit_trees(trees: GBTClassifier, ready: DataFrame) -> GBTClassificationModel:
    """*trees* fitted to the stored vectors and 0/1 labels *ready*.

    As in Spark, the candidate thresholds of a larger table come from a sample of max(bins^2, 10000) rows; the histograms take all rows.
    """
    spark, n = ready.sparkSession, ready.count()
    if not n:
        raise ValueError("no training rows")
    rows = ready.select(vector_to_array(trees.getFeaturesCol()).alias("x"), F.col(trees.getLabelCol()).cast("double").alias("label"))
    most = max(trees.getMaxBins() ** 2, 10_000)
    x = (rows if n <= most else rows.sample(most / n, trees.getSeed())).select("x").toArrow().column(0).combine_chunks()
    x = x.flatten().to_numpy().reshape(len(x), -1)
    cuts = [thresholds(v, min(trees.getMaxBins(), n) - 1) for v in x.T]
    base, used, whole = _blocks(rows, cuts, n)
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        grown = boost(base, trees.getMaxIter(), trees.getMaxDepth(), trees.getStepSize(), [len(cuts[j]) + 1 for j in used], whole)
    finally:
        base.unpersist()
    nodes = [row for i, tree in enumerate(grown) for row in _nodes(tree, i, used, cuts)]
    return _model(spark, trees, nodes, [t["weight"] for t in grown], len(cuts))
