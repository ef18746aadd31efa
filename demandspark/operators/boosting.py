"""Gradient boosting that draws its columns once per tree, over one binned and staged table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.operators.rollout import ModelArrays, Trees
from demandspark.session import shared_path, staged

#: Bins of a column, rows in a block, trees between two stagings of the fitted values, partitions summed on the driver.
BINS, BLOCK_ROWS, STAGE_EVERY, DRIVER_PARTS = 32, 65_536, 5, 32
BLOCKS = "bins binary, y binary, chance binary, fitted binary"


@dataclass
class Tree:
    """A growing tree over bins; -1 as the feature marks a leaf."""
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        two = len(self.feature), len(self.feature) + 1
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, *two
        for at in two:
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(at)
            self.right.append(at)
            self.value.append(0.0)
        return two

    def place(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node of each row after at most ``depth`` splits."""
        feature, cut, left, right = (np.array(x) for x in (self.feature, self.cut, self.left, self.right))
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(depth):
            f = feature[at]
            at = np.where(f < 0, at, np.where(bins[rows, np.maximum(f, 0)] <= cut[at], left[at], right[at]))
        return at


@dataclass
class ColumnBoosting:
    """Squared-error boosting of histogram trees. Every tree sees its own share of the columns and of the rows.

    Values are cut into at most ``BINS`` bins by approximate quantiles once and kept as bytes. A level of a tree is one
    pass: partitions return sums of residuals by node, column and bin, which are added up in Spark until few
    enough are left for the driver. Rows of a tree are drawn by a hash, so a rerun draws the same.
    """
    columns: Sequence[str]
    label: str = "units_sold"
    maxIter: int = 200
    maxDepth: int = 6
    stepSize: float = 0.07
    subsamplingRate: float = 0.85
    columnRate: float = 0.8
    minInstancesPerNode: int = 1
    seed: int = 42

    def fit(self, rows: DataFrame) -> ArraysModel:
        columns = list(self.columns)
        data = rows.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)], F.col(self.label).cast("double").alias("y")).where("y IS NOT NULL")
        names = [f"x{i}" for i in range(len(columns))]
        data = staged(data)
        cuts = [np.unique(q) for q in data.approxQuantile(names, [b / BINS for b in range(1, BINS)], 0.001)]
        base = data.agg(F.avg("y")).first()[0]
        if base is None:
            raise ValueError("no rows to learn from")
        store = _Blocks(rows.sparkSession)
        blocks, parts = store.write(data.select(*names, "y", F.xxhash64(*names, "y").alias("chance")).mapInArrow(_pack(cuts, base), BLOCKS))
        rng, done, recent = np.random.default_rng(self.seed), [], []
        n_columns = max(1, int(self.columnRate * len(columns)))
        for number in range(self.maxIter):
            drawn = np.sort(rng.choice(len(columns), n_columns, replace=False))
            recent.append(self._grow(blocks, parts, drawn, recent, number))
            if len(recent) == STAGE_EVERY and number + 1 < self.maxIter:
                blocks, parts = store.write(blocks.mapInArrow(_refit(recent, self.maxDepth), BLOCKS))
                done, recent = done + recent, []
        return ArraysModel(ModelArrays(columns, intercept=float(base), trees=_arrays(done + recent, cuts, self.maxDepth)))

    def _grow(self, blocks: DataFrame, parts: int, drawn: np.ndarray, before: list[Tree], number: int) -> Tree:
        tree, open_nodes = Tree(), [0]
        for depth in range(self.maxDepth):
            work = _histograms(list(before), tree, open_nodes, depth, drawn, self.maxDepth, number, self.subsamplingRate)
            sums = _added(blocks.mapInArrow(work, "sums binary"), parts, len(open_nodes) * len(drawn) * BINS * 2)
            n, s = np.moveaxis(sums.reshape(len(open_nodes), len(drawn), BINS, 2), 3, 0)
            if depth == 0:
                tree.value[0] = self.stepSize * s[0, 0].sum() / max(n[0, 0].sum(), 1)
            following = []
            for i, node in enumerate(open_nodes):
                nl, sl = n[i].cumsum(1)[:, :-1], s[i].cumsum(1)[:, :-1]
                nt, st = n[i, 0].sum(), s[i, 0].sum()
                nr, sr = nt - nl, st - sl
                valid = (nl >= self.minInstancesPerNode) & (nr >= self.minInstancesPerNode)
                gain = np.where(valid, sl ** 2 / np.maximum(nl, 1) + sr ** 2 / np.maximum(nr, 1) - st ** 2 / max(nt, 1), -np.inf)
                best = np.unravel_index(gain.argmax(), gain.shape)
                if not gain[best] > 1e-9 * (1 + abs(st)):
                    continue
                two = tree.split(node, int(drawn[best[0]]), int(best[1]))
                tree.value[two[0]], tree.value[two[1]] = (self.stepSize * a[best] / b[best] for a, b in ((sl, nl), (sr, nr)))
                following += two
            open_nodes = following
            if not open_nodes:
                break
        return tree


class _Blocks:
    """The binned table in the shared folder; a new one replaces the one it was made from."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, None

    def write(self, blocks: DataFrame) -> tuple[DataFrame, int]:
        """The stored blocks and their number of partitions."""
        before, self.path = self.path, shared_path(self.spark, "boosting")
        blocks.write.parquet(self.path)
        if before is not None:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(before)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        stored = self.spark.read.schema(BLOCKS).parquet(self.path)
        return stored, stored.rdd.getNumPartitions()


@dataclass
class ArraysModel:
    """A model as arrays that scores rows as a fitted pipeline does."""
    arrays: ModelArrays

    def transform(self, rows: DataFrame) -> DataFrame:
        shared = rows.sparkSession.sparkContext.broadcast(self.arrays)
        columns = self.arrays.columns

        @F.pandas_udf("double")
        def predict(x: pd.DataFrame) -> pd.Series:
            return pd.Series(shared.value.predict({c: x.iloc[:, i].to_numpy(dtype=float) for i, c in enumerate(columns)}))

        return rows.withColumn("prediction", predict(F.struct(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])))

    def importances(self) -> np.ndarray:
        """How often each column is split on, as shares."""
        trees = self.arrays.trees
        inner = trees.left != np.arange(len(trees.left))
        counts = np.bincount(trees.feature[inner], minlength=len(self.arrays.columns))
        return counts / max(counts.sum(), 1)

    def save(self, spark, path: str) -> None:
        trees = self.arrays.trees
        nodes = [(i, int(f), float(c), int(a), int(b), float(v)) for i, (f, c, a, b, v) in
                 enumerate(zip(trees.feature, trees.threshold, trees.left, trees.right, trees.value))]
        spark.createDataFrame(nodes, "node int, feature int, threshold double, left int, right int, value double").write.mode("overwrite").parquet(f"{path}/nodes")
        head = [(self.arrays.columns, self.arrays.intercept, [int(r) for r in trees.root], [float(w) for w in trees.weight], trees.depth)]
        spark.createDataFrame(head, "columns array<string>, intercept double, root array<int>, weight array<double>, depth int").write.mode("overwrite").parquet(f"{path}/arrays")

    @staticmethod
    def load(spark, path: str) -> ArraysModel:
        head = spark.read.parquet(f"{path}/arrays").first()
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("node").toPandas()  # trees times nodes of one
        trees = Trees(*(nodes[c].to_numpy() for c in ("feature", "threshold", "left", "right", "value")), np.array(head["root"]), np.array(head["weight"]), head["depth"])
        return ArraysModel(ModelArrays(list(head["columns"]), intercept=head["intercept"], trees=trees))


def _pack(cuts: list[np.ndarray], base: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, BLOCK_ROWS):
                part = rows.slice(at, BLOCK_ROWS)
                values = [part.column(i).fill_null(float("nan")).to_numpy(zero_copy_only=False) for i in range(len(cuts))]
                bins = np.column_stack([np.searchsorted(c, v, "left").astype(np.uint8) for c, v in zip(cuts, values)])
                y = part.column(len(cuts)).to_numpy(zero_copy_only=False)
                chance = part.column(len(cuts) + 1).to_numpy(zero_copy_only=False).view(np.uint64)
                yield _block(bins, y, chance, np.full(len(y), base))
    return run


def _block(bins: np.ndarray, y: np.ndarray, chance: np.ndarray, fitted: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in (bins, y, chance, fitted)],
                                      ["bins", "y", "chance", "fitted"])


def _read(rows: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for r in rows.to_pylist():
        y = np.frombuffer(r["y"])
        yield np.frombuffer(r["bins"], np.uint8).reshape(len(y), -1), y, np.frombuffer(r["chance"], np.uint64), np.frombuffer(r["fitted"])


def _sum_of(trees: list[Tree], bins: np.ndarray, depth: int) -> np.ndarray:
    total = np.zeros(len(bins))
    for tree in trees:
        total += np.array(tree.value)[tree.place(bins, depth)]
    return total


def _refit(trees: list[Tree], depth: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for bins, y, chance, fitted in _read(rows):
                yield _block(bins, y, chance, fitted + _sum_of(trees, bins, depth))
    return run


def _histograms(before: list[Tree], tree: Tree, open_nodes: list[int], depth: int, drawn: np.ndarray, max_depth: int, number: int, rate: float) -> Callable:
    """Numbers of rows and sums of their residuals by open node, drawn column and bin, one row per partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(open_nodes) * BINS
        total = np.zeros((len(drawn), size, 2))
        position = np.full(len(tree.feature), -1)
        position[open_nodes] = np.arange(len(open_nodes))
        for rows in batches:
            for bins, y, chance, fitted in _read(rows):
                mixed = (chance ^ np.uint64(0x9E3779B97F4A7C15 * (number + 1) % 2 ** 64)) * np.uint64(0xBF58476D1CE4E5B9)
                used = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) >> np.uint64(11) < rate * 2.0 ** 53
                at = position[tree.place(bins, depth)]
                used &= at >= 0
                residual = (y - fitted - _sum_of(before, bins, max_depth))[used]
                start, own = at[used] * BINS, bins[used]
                for k, column in enumerate(drawn):
                    key = start + own[:, column]
                    total[k, :, 0] += np.bincount(key, minlength=size)
                    total[k, :, 1] += np.bincount(key, residual, size)
        by_node = total.reshape(len(drawn), len(open_nodes), BINS, 2).transpose(1, 0, 2, 3)
        yield pa.RecordBatch.from_arrays([pa.array([by_node.tobytes()], pa.binary())], ["sums"])
    return run


def _added(arrays: DataFrame, parts: int, size: int) -> np.ndarray:
    """The sum of the arrays of all partitions; many are added up in Spark first, some partitions at a time."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for rows in batches:
            for value in rows.column(0):
                total += np.frombuffer(value.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    while parts > DRIVER_PARTS:
        parts = -(-parts // DRIVER_PARTS)
        arrays = arrays.repartition(parts).mapInArrow(add, "sums binary")
    return sum((np.frombuffer(r["sums"]) for r in arrays.collect()), np.zeros(size))


def _arrays(trees: list[Tree], cuts: list[np.ndarray], depth: int) -> Trees:
    """All trees' nodes with raw thresholds; the values hold the step size."""
    feature, threshold, left, right, value, root = [], [], [], [], [], []
    for tree in trees:
        start = len(feature)
        root.append(start)
        for f, c in zip(tree.feature, tree.cut):
            feature.append(max(f, 0))
            threshold.append(0.0 if f < 0 else float(cuts[f][c]) if c < len(cuts[f]) else float("inf"))
        left += [start + at for at in tree.left]
        right += [start + at for at in tree.right]
        value += tree.value
    return Trees(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array(root), np.ones(len(root)), depth)
