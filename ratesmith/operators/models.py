"""Boosted-tree regression on feature tables.

The learner is Spark ML's ``GBTRegressor`` by rule: at most 32 bins a feature,
cut at sampled quantiles; variance gain; the first tree in full, every other at
the rate times the loss's gradient, which is twice the residual; prediction is
the trees' sum.  The trees grow in ``tree_growth``, whose levels are sums of bin
numbers, where Spark ML takes a job of several stages a level.  Parameter
mapping (reference -> here): n_estimators -> maxIter, learning_rate ->
stepSize, max_depth -> maxDepth, subsample -> subsamplingRate,
colsample_bytree -> featureSubsetStrategy (per node here), random_state ->
seed.  L1/L2 leaf penalties have no counterpart; ``boosting`` has them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial
from itertools import product

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratesmith.operators import tree_growth as TG
from ratesmith.operators.encoders import consecutive_index

SEED = 42

# Named parameter sets: "short" is for quick runs; the others are the
# reference scripts' sizes, the defaults of their feature sets.
PRESETS = {
    "short": dict(maxIter=20, stepSize=0.1, maxDepth=5, subsamplingRate=1.0, featureSubsetStrategy="all"),
    "baseline": dict(maxIter=100, stepSize=0.1, maxDepth=10, subsamplingRate=1.0, featureSubsetStrategy="all"),
    "notebook": dict(maxIter=300, stepSize=0.02, maxDepth=15, subsamplingRate=0.8, featureSubsetStrategy="0.8"),
    "final": dict(maxIter=1000, stepSize=0.01, maxDepth=10, subsamplingRate=0.8, featureSubsetStrategy="0.7"),
    "final_log": dict(maxIter=500, stepSize=0.01, maxDepth=10, subsamplingRate=0.8, featureSubsetStrategy="0.7"),
}

PRESET_OF = {"fs7": "baseline", "fs20": "notebook", "fs20l": "final_log", "fs23": "final", "fs23l": "final_log"}

# The reference's search grid in Spark's parameter names; its two penalty
# parameters (3 and 2 values) have no counterpart here.
FULL_GRID = {
    "maxIter": [100, 300, 500],
    "stepSize": [0.01, 0.05, 0.1],
    "maxDepth": [6, 10, 12],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.7", "all"],
}

#: Bins of a feature at most, and rows sampled for its splits (Spark ML's defaults).
MAX_BINS = 32
SPLIT_ROWS = 10_000

#: Most rows a partition of a training table holds on average.
PART_ROWS = 1_000_000


def assembler(cols: Sequence[str], out: str = "features") -> VectorAssembler:
    """P10: ordered feature columns -> vector (NULLs must be filled first)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error")


class BoostedTrees(Estimator):
    """Boosted trees on ``features`` (a vector) and the label."""

    def __init__(self, label: str, size: dict):
        super().__init__()
        self.label, self.size = label, size

    def _fit(self, dataset: DataFrame) -> BoostedModel:
        return _fit_sizes(dataset, self.label, [self.size])[0][0]


class BoostedModel(Model):
    """Fitted trees: adds ``prediction``; ``features`` does not stay."""

    def __init__(self, trees: TG.Trees, splits: list[np.ndarray]):
        super().__init__()
        self.trees, self.splits = trees, splits

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cells = dataset.withColumn("_cells", vector_to_array("features"))
        return TG.scores(self.trees, 0.0, cells, "_cells", len(self.splits),
                         [c for c in dataset.columns if c != "features"], partial(_to_bins, self.splits))


def gbt(preset: str, label: str = "stars", **overrides) -> BoostedTrees:
    return BoostedTrees(label, {**PRESETS[preset], **overrides})


def _to_bins(splits: list[np.ndarray], cells: np.ndarray) -> np.ndarray:
    """Each value's number of splits below it: a split's own value lies left."""
    out = np.empty(cells.shape, np.int16)
    for i, at in enumerate(splits):
        out[:, i] = np.searchsorted(at, cells[:, i], "left")
    return out


def candidate_splits(values: np.ndarray, rows: float, most: int) -> np.ndarray:
    """At most ``most`` - 1 splits of a feature, from a sample that stands for ``rows``.

    Between all values if they are few, else near the quantiles.  Zeros are what the
    sample's other values leave of ``rows``.
    """
    found, counts = np.unique(values[values != 0], return_counts=True)
    counts = counts.astype(float)
    if not len(found):
        return np.zeros(0)
    zeros = rows - counts.sum()
    if zeros > np.finfo(float).eps * counts.sum() * 100:
        at = int(np.searchsorted(found, 0.0))
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, zeros)
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) <= most - 1:
        return middle
    stride = rows / most
    splits, target, so_far = [], stride, np.cumsum(counts)
    for i in range(1, len(found)):
        if abs(so_far[i - 1] - target) < abs(so_far[i] - target):
            splits.append(middle[i - 1])
            target += stride
    return np.array(splits)


def _fit_sizes(dataset: DataFrame, label: str, sizes: Sequence[dict], fold_col: str | None = None,
               left_out: Sequence[int] | None = None) -> tuple[list[BoostedModel], list[float]]:
    """A model for each size, from ``features`` and the label; with ``left_out``, each
    learns from the rows of other folds, and its mean squared error on that one is taken."""
    fold = [F.col(fold_col).cast("int").alias("_fold")] if fold_col else []
    rows = dataset.select(vector_to_array("features").alias("_cells"), F.col(label).cast("double").alias("_y"), *fold)
    # one row a fold
    counts = {r["_fold"]: r for r in rows.groupBy("_fold" if fold else F.lit(0).alias("_fold")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs("_y")).alias("most")).toLocalIterator()}
    n = sum(r["n"] for r in counts.values())
    if not n:
        raise ValueError("there are no rows to train on")
    outs = [-1] * len(sizes) if left_out is None else list(left_out)
    learnt = {out: sum(r["n"] for f, r in counts.items() if f != out) for out in dict.fromkeys(outs)}
    if not all(learnt.values()):
        raise ValueError("a fold leaves no rows to train on")
    # the sample for the splits: SPLIT_ROWS of each model's rows
    share = min(1.0, SPLIT_ROWS / min(learnt.values()))
    sample = (rows if share >= 1 else rows.sample(share, SEED)).select("_cells", *(["_fold"] if fold else [])).toArrow()
    cells = sample["_cells"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(sample.num_rows, -1)
    folds = sample["_fold"].to_numpy() if fold else np.zeros(sample.num_rows)
    splits = {}
    for out, rows_there in learnt.items():
        mine = cells[folds != out]
        splits[out] = [candidate_splits(mine[:, i], rows_there * share, min(MAX_BINS, rows_there))
                       for i in range(cells.shape[1])]
    # rows have the bins of all models' splits together, and each model its own of these
    every = [np.unique(np.concatenate([s[i] for s in splits.values()])) for i in range(cells.shape[1])]
    jobs = []
    for p, out in zip(sizes, outs, strict=True):
        own = splits[out]
        luts = None if len(splits) == 1 else tuple(
            np.r_[0, np.searchsorted(mine, at, "right")].astype(np.int16) for mine, at in zip(own, every))
        strategy = p["featureSubsetStrategy"]
        jobs.append(TG.Job(p["maxIter"], p["maxDepth"], 2 * p["stepSize"], 1.0, 0.0, tuple(len(x) + 1 for x in own),
                           rows=p["subsamplingRate"], columns=1.0 if strategy == "all" else float(strategy),
                           by_node=True, seed=SEED, left_out=out, luts=luts))
    stages = sorted({p["maxIter"] for p in sizes}) if left_out is not None else []
    trees, losses = TG.grow_models(
        rows, jobs, n, TG.quantum(n, 8 * max(r["most"] for r in counts.values()) + 8),
        max(len(x) for x in every) + 1, partial(_to_bins, every), stages)
    return ([BoostedModel(t, splits[out]) for t, out in zip(trees, outs)],
            [losses[p["maxIter"]][m] for m, p in enumerate(sizes)] if stages else [])


def in_training_parts(data: DataFrame) -> DataFrame:
    """A kept table in as many partitions as cores, or a multiple of that beyond
    PART_ROWS rows each, if it has over twice as many.

    Each level of each tree runs a task a partition, and each task sends the
    level's whole histogram; shuffle partitions are far too many for that.  The
    learner draws its candidate splits by partition, so a table whose partitions
    are few enough keeps them.
    """
    cores = data.sparkSession.sparkContext.defaultParallelism
    wanted = cores * max(1, math.ceil(data.count() / (cores * PART_ROWS)))
    return data.coalesce(wanted) if data.rdd.getNumPartitions() > 2 * wanted else data


def fit(train: DataFrame, cols: Sequence[str], label: str = "stars", preset: str = "short",
        kept: bool = False, **overrides) -> PipelineModel:
    """M3: assemble + boosted trees, fitted on the whole training table.

    The table is persisted (memory, spilling to disk) for the passes the
    tree learner makes over it, and released afterwards, unless the caller
    has ``kept`` it (or what it is a mere projection of).
    """
    data = train.where(F.col(label).isNotNull())
    if not kept:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = Pipeline(stages=[assembler(cols), gbt(preset, label, **overrides)]).fit(
            in_training_parts(data))
    finally:
        if not kept:
            data.unpersist()
    return model


def predict(model: PipelineModel, table: DataFrame, keys: Sequence[str] = ("user_id", "business_id")) -> DataFrame:
    """M5 + P11: ids ride along with their rows; no positional re-attachment."""
    cols = model.stages[0].getInputCols()
    return model.transform(table.select(*dict.fromkeys([*keys, *cols]))).select(*keys, "prediction")


def contiguous_folds(df: DataFrame, order_by: Sequence[str], k: int = 5, name: str = "fold") -> DataFrame:
    """Unshuffled k folds in ``order_by`` order, the first n mod k one row bigger.

    Position comes from the distributed consecutive index; the row count is a
    one-row aggregate.
    """
    idx = consecutive_index(df, order_by, "_idx")
    n = idx.agg(F.count(F.lit(1)).alias("_n"))
    j = idx.crossJoin(F.broadcast(n))
    q = F.expr(f"_n div {k}")
    r = F.expr(f"_n % {k}")
    big = r * (q + 1)
    fold = F.when(F.col("_idx") < big, F.expr(f"_idx div (_n div {k} + 1)")) \
            .otherwise(r + F.expr(f"(_idx - (_n % {k}) * (_n div {k} + 1)) div greatest(_n div {k}, 1)"))
    return j.withColumn(name, fold.cast("long")).drop("_idx", "_n")


@dataclass
class GridResult:
    model: PipelineModel
    best_params: dict
    metrics: list[tuple[dict, float]]


def grid_search(train: DataFrame, cols: Sequence[str], grid: dict[str, list] = FULL_GRID,
                label: str = "stars", k: int = 5,
                order_by: Sequence[str] = ("user_id", "business_id")) -> GridResult:
    """M4: grid × k contiguous folds, scored by MSE, best candidate refit on all rows.

    ``order_by`` is the line order of the training rows; ``metrics`` has every
    candidate with its mean score.  All candidates and folds grow side by side
    from one kept table.
    """
    sizes = [{**PRESETS["short"], **dict(zip(grid, values, strict=True))} for values in product(*grid.values())]
    folded = contiguous_folds(train.where(F.col(label).isNotNull()), order_by, k, "fold")
    kept = assembler(cols).transform(folded).select("features", label, "fold").persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        data = in_training_parts(kept)
        seen = {r["fold"] for r in data.select("fold").distinct().toLocalIterator()}  # k at most
        if len(seen) < max(k, 2):
            raise ValueError(f"only folds {sorted(seen)} of {k} have rows to train on and to score")
        _, mses = _fit_sizes(data, label, [p for p in sizes for _ in range(k)], "fold", [*range(k)] * len(sizes))
        metrics = [({name: p[name] for name in grid}, sum(mses[i * k:(i + 1) * k]) / k) for i, p in enumerate(sizes)]
        best_i = min(range(len(metrics)), key=lambda i: metrics[i][1])
        best = gbt("short", label, **metrics[best_i][0]).fit(data)
    finally:
        kept.unpersist()
    return GridResult(PipelineModel(stages=[assembler(cols), best]), metrics[best_i][0], metrics)
