"""Boosted trees of many models at once: a Spark job for each level of all models' trees.

The trees are those of MLlib's GBTClassifier (log loss, variance, bins by its rule, every row and feature used). MLlib trains one
model after the other with some jobs for each tree, so forty-five models of fifty trees are ten thousand jobs; here tasks add up the
gradients of all models in one pass over binned rows, and the driver gets a histogram for each model and partition. Rows lie on disk between
the passes, and a task holds a batch of them, so memory does not grow with their number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import closing, contextmanager
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import written

BINS = 32
#: Bins follow all values of a model, as MLlib has it, if a part of its rows has up to so many; of more, they follow so many of each part, at equal steps of rank.
EXACT = 10_000
#: Rows that a partition holds if there are many, and at least if there are few.
PART_ROWS, LEAST_ROWS = 1_000_000, 20_000
#: Bytes of blocks that go to Python at once; trees after which the blocks' margins are written, so that few trees are added to them again.
BATCH, WRITTEN = "2m", 10
#: No bin is above it: all rows of a node that is not split go left.
NEVER = 255
_BLOCKS = "model int, train boolean, n long, bins binary, label binary, margin binary"
_COUNTED = "model int, feature int, values binary, counts binary"


def bin_edges(values: np.ndarray, bins: int = BINS, counts: np.ndarray | None = None) -> np.ndarray:
    """The thresholds between bins by MLlib's rule: midpoints of neighbouring values, at about equal counts if there are many.
    counts: how often each of values occurs, once if not given."""
    distinct, at = np.unique(values, return_inverse=True)
    counts = np.bincount(at, counts)
    rows = int(counts.sum())
    splits = min(bins, rows) - 1
    middle = distinct[:-1] / 2 + distinct[1:] / 2
    if len(middle) <= splits:
        return middle
    stride = rows / (splits + 1)
    target, upto, found = stride, np.cumsum(counts), []
    for i in range(1, len(distinct)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            found.append(middle[i - 1])
            target += stride
    return np.array(found)


class Tree:
    """A complete binary tree over bins. Node k of a level has the children 2k (bin at most cut) and 2k+1 of the next one; all rows of
    one that is not split go to the first."""

    def __init__(self, depth: int):
        self.depth = depth
        self.feature = [np.zeros(2**level, np.int64) for level in range(depth)]
        self.cut = [np.full(2**level, NEVER) for level in range(depth)]
        self.value = np.zeros(2**depth)

    def nodes(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row (a column of bins, of which each row is a feature) at a level."""
        node = np.zeros(bins.shape[1], np.uint8 if self.depth < 8 else np.uint32)
        for feature, cut in zip(self.feature[:levels], self.cut):
            right = np.zeros(len(node), bool)
            for k, (f, c) in enumerate(zip(feature.tolist(), cut.tolist())):
                if c != NEVER:
                    right |= (node == k) & (bins[f] > c)
            node = node * 2 + right
        return node

    def __call__(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.nodes(bins, self.depth)]

    def grow(self, level: int, counts: np.ndarray, sums: np.ndarray) -> None:
        """Split the nodes of a level by histograms (node, feature, bin) of rows and gradients."""
        means = np.zeros(2 ** (level + 1))
        for k, (n, s) in enumerate(zip(counts, sums)):
            rows, total = n[0].sum(), s[0].sum()
            if not rows:
                continue
            left, part = n.cumsum(1)[:, :-1], s.cumsum(1)[:, :-1]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = part**2 / left + (total - part) ** 2 / (rows - left) - total**2 / rows
            gain = np.where((left > 0) & (left < rows), gain, -1.0)
            f, b = np.unravel_index(gain.argmax(), gain.shape)
            means[2 * k] = total / rows
            if gain[f, b] > 1e-12 * rows:
                self.feature[level][k], self.cut[level][k] = f, b
                means[2 * k : 2 * k + 2] = part[f, b] / left[f, b], (total - part[f, b]) / (rows - left[f, b])
        if level + 1 == self.depth:
            self.value = means


def _matrix(batch: pa.RecordBatch, features: list[str]) -> np.ndarray:
    """Features of a batch, each a row."""
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in features])


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values in order and how many rows each stands for: all that differ, or EXACT at equal steps of rank if there are more."""
    distinct, counts = np.unique(values, return_counts=True)
    if len(distinct) <= EXACT:
        return distinct, counts
    cuts = np.arange(EXACT + 1) * len(values) // EXACT
    return np.sort(values)[(cuts[:-1] + cuts[1:]) // 2], np.diff(cuts)


def _counts(features: list[str], most: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The counted values of each model and feature, told anew after most rows, so that no more are held."""
        held: dict[int, list[np.ndarray]] = {}
        n = 0

        def told() -> Iterator[pa.RecordBatch]:
            for model in list(held):
                own = held.pop(model)
                for f in range(len(features)):
                    found = [x.tobytes() for x in _counted(np.concatenate([v[f] for v in own]))]
                    yield pa.record_batch([pa.array([x], t) for x, t in zip((model, f, *found), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["model", "feature", "values", "counts"])

        for batch in batches:
            models, values = batch.column("model").to_numpy(), _matrix(batch, features)
            for model in np.unique(models):
                held.setdefault(int(model), []).append(values[:, models == model])
            n += batch.num_rows
            if n >= most:
                yield from told()
                n = 0
        yield from told()

    return run


def _binned(shared, features: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a batch as one block for each model and role: bins, labels of 1 and -1, margins of 0."""
        for batch in batches:
            models, train, values = batch.column("model").to_numpy(), batch.column("train").to_numpy(zero_copy_only=False), _matrix(batch, features)
            labels = np.where(batch.column("label").to_numpy(zero_copy_only=False) == 1, 1, -1).astype(np.int8)
            for model, role in np.unique(np.stack([models, train]), axis=1).T.tolist():
                own = (models == model) & (train == role)
                bins = np.stack([np.searchsorted(e, v) for e, v in zip(shared.value[model], values[:, own])]).astype(np.uint8)
                yield _block(model, bool(role), bins, labels[own], np.zeros(bins.shape[1]))

    return run


def _block(model: int, train: bool, bins: np.ndarray, label: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    values = (model, train, bins.shape[1], bins.tobytes(), label.tobytes(), margin.tobytes())
    return pa.record_batch([pa.array([v], t) for v, t in zip(values, kinds)], [c.split()[0] for c in _BLOCKS.split(", ")])


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for model, train, n, *parts in zip(*(batch.column(c.split()[0]) for c in _BLOCKS.split(", "))):
            bins, label, margin = (np.frombuffer(x.as_buffer(), kind) for x, kind in zip(parts, (np.uint8, np.int8, np.float64)))
            yield model.as_py(), train.as_py(), bins.reshape(-1, n.as_py()), label, margin


def _histograms(shared, level: int, first: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        growing, sums = shared.value, {}
        for model, _, bins, label, margin in _read(batches):
            y = label.astype(np.float64)
            target = y if first else 4 * y / (1 + np.exp(2 * y * margin))
            node, size = growing[model].nodes(bins, level).astype(np.int64) * BINS, 2**level * BINS
            cells = [node + b for b in bins]
            found = np.array([[np.bincount(c, minlength=size) for c in cells], [np.bincount(c, target, size) for c in cells]], np.float64)
            sums[model] = sums.get(model, 0.0) + found
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["model", "sums"])

    return run


def _raised(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks with margins raised by some trees of each model."""
        for model, train, bins, label, margin in _read(batches):
            yield _block(model, train, bins, label, sum((weight * trees[model](bins) for weight, trees in shared.value), margin))

    return run


def _guesses(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for model, _, bins, label, margin in _read(batches):
            guess = (sum((weight * tree(bins) for weight, tree in shared.value[model]), margin) > 0).astype(np.float64)
            yield pa.record_batch([pa.array([model] * len(guess), pa.int32()), pa.array(guess), pa.array((label > 0).astype(np.float64))], ["model", "prediction", "label"])

    return run


@contextmanager
def _small_batches(spark):
    """Blocks go to Python a few at a time: a batch's limit of rows bounds no bytes, and Spark's own of bytes is a part's."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, BATCH)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _edges(train: DataFrame, sizes: dict[int, int], features: list[str]) -> dict[int, list[np.ndarray]]:
    """The bins of each model. A task holds PART_ROWS rows, or the counted values of one feature of a model: EXACT at most of so many rows."""

    def merged(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        values, counts = (np.concatenate([np.frombuffer(x, kind) for x in parts[c]]) for c, kind in (("values", np.float64), ("counts", np.int64)))
        return pd.DataFrame({"model": [key[0]], "feature": [key[1]], "edges": [bin_edges(values, counts=counts).tolist()]})

    found = {m: [np.array([])] * len(features) for m in sizes}
    counted = train.select("model", *features).mapInArrow(_counts(features, PART_ROWS), _COUNTED)
    for row in counted.groupBy("model", "feature").applyInPandas(merged, "model int, feature int, edges array<double>").collect():  # BINS numbers of each
        found[row["model"]][row["feature"]] = np.array(row["edges"])
    return found


def _grown(blocks: DataFrame, models: Iterable[int], features: list[str], depth: int, step: float) -> Iterator[tuple[float, dict[int, Tree]]]:
    """The trees of all models and their weight, round after round, from blocks that are written. Blocks with margins raised by the trees
    so far lie on disk while the next one grows; they are written after WRITTEN trees, and made from those written last, so no plan is nested."""
    spark, models, base, since, first = blocks.sparkSession, list(models), blocks, [], True
    try:
        while True:
            growing, weight = {m: Tree(depth) for m in models}, 1.0 if first else step
            for level in range(depth):
                shared = spark.sparkContext.broadcast(growing)
                sums: dict[int, np.ndarray] = {}
                with _small_batches(spark):
                    rows = blocks.mapInArrow(_histograms(shared, level, first), "model int, sums binary").collect()
                shared.destroy()
                for row in rows:
                    sums[row["model"]] = sums.get(row["model"], 0.0) + np.frombuffer(row["sums"])
                for model, found in sums.items():
                    # (counts or sums, feature, node and bin)
                    growing[model].grow(level, *found.reshape(2, len(features), 2**level, BINS).swapaxes(1, 2))
            yield weight, growing
            blocks.unpersist()
            first = False
            since.append((weight, growing))
            with _small_batches(spark):
                blocks = base.mapInArrow(_raised(spark.sparkContext.broadcast(since)), _BLOCKS)
                if len(since) == WRITTEN:
                    base = blocks = written(blocks, "raised")
                    since = []
                else:
                    blocks = blocks.persist(StorageLevel.DISK_ONLY)
    finally:
        blocks.unpersist()


def _blocks(df: DataFrame, features: list[str]) -> tuple[DataFrame, dict[int, list[np.ndarray]]]:
    """The blocks of rows of role 'train' and 'test' (model, row_id, role, label, features without nulls), and the bins of each model."""
    spark = df.sparkSession
    sizes = {r["model"]: {"train": r["train"], "all": r["n"]} for r in df.groupBy("model").agg(F.count_if(F.col("role") == "train").alias("train"), F.count("*").alias("n")).collect()}  # a row for each model
    if not all(s["train"] for s in sizes.values()):
        raise ValueError("a model has no rows to train on")
    total = sum(s["all"] for s in sizes.values())
    parts = max(-(-total // PART_ROWS), min(spark.sparkContext.defaultParallelism, -(-total // LEAST_ROWS)))
    placed = df.filter("role IN ('train', 'test')").select("model", "row_id", (F.col("role") == "train").alias("train"), "label", *features).repartitionByRange(parts, "model", "row_id").drop("row_id")
    edges = _edges(placed.filter("train"), {m: s["train"] for m, s in sizes.items()}, features)
    return written(placed.mapInArrow(_binned(spark.sparkContext.broadcast(edges), features), _BLOCKS), "binned"), edges


def boosted_guesses(df: DataFrame, features: list[str], trees: int, depth: int, step: float = 0.1) -> DataFrame:
    """Train a model for each number (model) on its rows of role 'train' and guess those of role 'test'.

    df: model int, row_id, role, label (1 or other), features without nulls. Returns model, prediction, label for each test row. All
    rows are used in every tree. The rows' margins after a tree are kept while the next one grows, in the job of its first level.
    """
    binned, edges = _blocks(df, features)
    grown: dict[int, list[tuple[float, Tree]]] = {m: [] for m in edges}
    with closing(_grown(binned.filter("train"), edges, features, depth, step)) as rounds:
        for weight, growing in islice(rounds, trees):
            for model, tree in growing.items():
                grown[model].append((weight, tree))
    return binned.filter("NOT train").mapInArrow(_guesses(df.sparkSession.sparkContext.broadcast(grown)), "model int, prediction double, label double")


class BoostedTrees:
    """A model: its bins, and its trees with their weights."""

    def __init__(self, features: list[str], edges: list[np.ndarray], trees: list[tuple[float, Tree]]):
        self.features, self.edges, self.trees = features, edges, trees

    def transform(self, df: DataFrame) -> DataFrame:
        """df with a prediction, 1 or 0. A missing value lies below every other."""
        shared = df.sparkSession.sparkContext.broadcast((self.edges, self.trees))

        @F.pandas_udf("double")
        def guess(*columns: pd.Series) -> pd.Series:
            edges, trees = shared.value
            bins = np.stack([np.searchsorted(e, c.fillna(-np.inf)) for e, c in zip(edges, columns)]).astype(np.uint8)
            return pd.Series((sum(weight * tree(bins) for weight, tree in trees) > 0).astype(np.float64))

        return df.withColumn("prediction", guess(*self.features))


def _losses(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The number of a part's rows, and the sums of their log loss after each tree."""
        n, sums = 0, np.zeros(len(shared.value))
        for _, _, bins, label, margin in _read(batches):
            n += len(label)
            for i, (weight, tree) in enumerate(shared.value):
                margin = margin + weight * tree(bins)
                sums[i] += 2 * np.logaddexp(0, -2.0 * label * margin).sum()
        yield pa.record_batch([pa.array([n], pa.int64()), pa.array([sums.tolist()], pa.list_(pa.float64()))], ["n", "sums"])

    return run


def stopped_early(train: DataFrame, held: DataFrame, features: list[str], trees: int, depth: int, step: float, patience: int) -> tuple[BoostedTrees, int]:
    """A model of at most trees rounds, up to the one of least log loss on held before patience rounds brought no better one, and
    their number. train, held: row_id, label (1 or other), features without nulls. Losses are looked at after each patience rounds."""
    sides = [rows.select(F.lit(0).alias("model"), "row_id", F.lit(role).alias("role"), "label", *features) for rows, role in ((train, "train"), (held, "test"))]
    binned, edges = _blocks(sides[0].unionByName(sides[1]), features)
    grown: list[tuple[float, Tree]] = []
    with closing(_grown(binned.filter("train"), edges, features, depth, step)) as rounds:
        for weight, growing in islice(rounds, trees):
            grown.append((weight, growing[0]))
            if len(grown) % patience and len(grown) < trees:
                continue
            with _small_batches(train.sparkSession):
                found = binned.filter("NOT train").mapInArrow(_losses(train.sparkSession.sparkContext.broadcast(grown)), "n long, sums array<double>").collect()
            losses = (np.sum([r["sums"] for r in found], 0) / sum(r["n"] for r in found)).tolist()
            best = 0
            for i, loss in enumerate(losses):
                if loss < losses[best]:
                    best = i
                elif i - best >= patience:
                    return BoostedTrees(features, edges[0], grown[: best + 1]), best + 1
    return BoostedTrees(features, edges[0], grown[: best + 1]), best + 1
