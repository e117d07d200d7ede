"""Boosted trees on a cluster: rows are binned once into blocks, and ``trees`` grows on them.

Spark ML hands out two rounds of tasks for each level of each tree, which takes longer than the level does on tables of up to a few million rows.
A table that takes no more than ``LOCAL_BYTES`` in a task is one task's, which grows all trees without another job; fits
side by side are tasks side by side. A larger one lies in memory and on disk of the executors as blocks with their margins; each level is
one job, whose tasks send the counts of their rows, of fixed size, to be added up. Either way the trees are the same.
"""

from __future__ import annotations

import json
import pickle
import sys
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywind.operators.trees import CHUNK, Chunk, Chunks, Grown, Settings, Shape, Tree, binned, candidates, columns_of, grow
from tallywind.storage import jobs_beside, shared_dir, store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a table, its margins and gradients that one task may hold where a fit is alone, and those a row takes beside its bins, which are held twice.
#: Fits side by side, up to ``LOCAL_JOBS``, may take so many times as much: one task each keeps the cores busy, jobs for each level of all of them the driver.
LOCAL_BYTES = 128 << 20
LOCAL_JOBS = 4
ROW_BYTES = 60
#: Bytes of blocks that a task reads at most, one after the other.
PART_BYTES = 128 << 20
#: Values, as they come, that make a block.
BLOCK_VALUES = 1 << 22
#: Rows whose values are looked at for split candidates, as in Spark ML; all rows of a table that has no more.
SAMPLE_ROWS = 10_000
#: Rounds after which the margins are written and no longer derived from earlier ones.
CUT = 10

_BLOCK = "x binary, y binary, first bigint, n int"
_NODES = pa.schema([
    ("treeID", pa.int32()),
    ("nodeData", pa.struct([
        ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()),
        ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
        ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])),
    ])),
])


def cell(column: str, codes: int = 0) -> str:
    """SQL of a feature's value: a null is -1; a category that is null or has no code takes the last one."""
    last = codes - 1
    return f"case when `{column}` between 0 and {last} then double(`{column}`) else {last}D end" if codes else f"coalesce(double(`{column}`), -1D)"


@dataclass(frozen=True)
class Ensemble:
    """Trees on binned features, with what turns them into a model of Spark ML."""

    grown: Grown
    thresholds: tuple[np.ndarray, ...]
    shape: Shape
    settings: Settings

    def weights(self, n: int) -> list[float]:
        return [self.settings.weight(i) for i in range(n)]

    def model(self, spark: SparkSession, n: int | None = None, label: str = "label") -> GBTClassificationModel:
        """The first ``n`` trees as a classifier, by way of the files Spark ML keeps models in."""
        found = self.grown.trees[:n]
        path = f"{shared_dir(spark)}/model-{uuid.uuid4().hex}"
        set_ = {"impurity": "variance", "labelCol": label, "maxDepth": self.settings.depth, "minInstancesPerNode": self.settings.min_leaf, "minInfoGain": self.settings.min_gain, "seed": self.settings.seed}

        def about(kind: str, **more) -> str:
            head = {"class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": f"{kind.rsplit('.', 1)[1]}_{uuid.uuid4().hex[:12]}"}
            return json.dumps(head | {"paramMap": set_ | more.pop("params", {}), "defaultParamMap": {}} | more)

        params = {"maxIter": len(found), "stepSize": self.settings.learning_rate, "subsamplingRate": self.settings.subsample}
        whole = about("classification.GBTClassificationModel", numFeatures=len(self.shape.widths), numTrees=len(found), params=params)
        spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        trees = [(i, about("regression.DecisionTreeRegressionModel"), w) for i, w in enumerate(self.weights(len(found)))]
        spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        nodes = [{"treeID": i, "nodeData": node} for i, tree in enumerate(found) for node in self._nodes(tree)]
        spark.createDataFrame(pa.Table.from_pylist(nodes, _NODES)).coalesce(1).write.parquet(f"{path}/data")
        return GBTClassificationModel.load(path)

    def _nodes(self, tree: Tree) -> Iterator[dict]:
        count, total, squares = tree.sums
        impurity = squares / count - tree.value**2
        for i, (feature, left) in enumerate(zip(tree.feature.tolist(), tree.left.tolist(), strict=True)):
            split = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
            if left >= 0:
                codes = self.shape.codes[feature]
                stays = np.flatnonzero(~tree.turns[i, : self.shape.widths[feature]])
                split = {"featureIndex": feature, "leftCategoriesOrThreshold": stays.astype(float).tolist() if codes else [float(self.thresholds[feature][stays[-1]])], "numCategories": codes or -1}
            yield {
                "id": i, "prediction": float(tree.value[i]), "impurity": float(impurity[i]), "impurityStats": [float(count[i]), float(total[i]), float(squares[i])],
                "rawCount": int(count[i]), "gain": float(tree.gain[i]), "leftChild": left, "rightChild": left + 1 if left >= 0 else -1, "split": split,
            }


def grow_ensemble(
    train: DataFrame,
    held: DataFrame | None,
    features: Sequence[str],
    params,
    rounds: int,
    label: str,
    categories: Mapping[str, int] | None = None,
    patience: int | None = None,
    least: int = 0,
) -> Ensemble:
    """Trees fitted to the labelled rows of ``train``, measured on those of ``held`` after each; see ``trees.grow``.

    Rows and columns are drawn by the numbers of row, round and node, and so are the rows looked at for split candidates.
    """
    spark = train.sparkSession
    codes = tuple((categories or {}).get(c, 0) for c in features)
    settings = Settings(
        params.depth, params.learning_rate, params.subsample, columns_of(params.colsample, len(features)), params.min_leaf, params.min_gain, params.seed
    )

    def cells(df: DataFrame) -> DataFrame:
        known = [f"{cell(c, n)} as _f_{i}" for i, (c, n) in enumerate(zip(features, codes, strict=True))]
        return df.where(F.col(label).isNotNull()).selectExpr(*known, f"double(`{label}`) as _y")

    rows = cells(train).withColumn("_id", F.monotonically_increasing_id())
    n = rows.count()
    if not n:
        raise ValueError("there is no labelled row to fit trees to")
    thresholds = _candidates(rows, n, codes, params)
    shape = Shape(tuple(c or len(t) + 1 for c, t in zip(codes, thresholds, strict=True)), codes)
    every = rows.withColumn("_held", F.lit(False))
    if held is not None:
        every = every.unionByName(cells(held).withColumns({"_id": F.monotonically_increasing_id(), "_held": F.lit(True)}))
    blocks = store(_blocks(every, thresholds, shape)).df
    held_rows = 0 if held is None else blocks.agg(F.sum("n")).first()[0] - n
    if (n + held_rows) * (2 * len(features) * _kind(shape).itemsize + ROW_BYTES) <= LOCAL_BYTES * min(LOCAL_JOBS, jobs_beside()):
        grown = _in_one_task(blocks, settings, shape, rounds, patience, least)
    else:
        spread = Spread(blocks, shape)
        try:
            grown = grow(spread, settings, shape, rounds, patience, least)
        finally:
            spread.close()
    return Ensemble(grown, thresholds, shape, settings)


def _kind(shape: Shape) -> np.dtype:
    return np.dtype(np.uint8 if shape.bins <= 256 else np.uint16 if shape.bins <= 65536 else np.int32)


def _columns(batch: pa.RecordBatch, n: int) -> Iterator[np.ndarray]:
    for i in range(n):
        yield batch.column(i).to_numpy(zero_copy_only=False)


def _candidates(rows: DataFrame, n: int, codes: Sequence[int], params) -> tuple[np.ndarray, ...]:
    """Thresholds of every feature (none of a category's)."""
    bins = min(params.bins, n)
    wanted = max(params.bins**2, SAMPLE_ROWS)
    if n > wanted:
        place = F.pmod(F.xxhash64("_id", F.lit(params.seed)), F.lit(1 << 30))
        rows = rows.where(place < int(wanted / n * (1 << 30)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [list(_columns(batch, len(codes))) for batch in batches]
        if parts:
            columns = [np.concatenate([p[j] for p in parts]) for j in range(len(codes))]
            found = [np.empty(0) if c else candidates(v, bins, len(v)) for v, c in zip(columns, codes, strict=True)]
            yield pa.RecordBatch.from_pydict({"thresholds": pa.array([pickle.dumps(found)], pa.binary())})

    return tuple(pickle.loads(rows.drop("_id", "_y").repartition(1).mapInArrow(find, "thresholds binary").first()[0]))


def _blocks(every: DataFrame, thresholds: Sequence[np.ndarray], shape: Shape) -> DataFrame:
    """Rows of ``_f_i``, ``_y``, ``_id`` and ``_held`` as blocks: bins of one feature after the other, label and whether held out, the first id."""
    kind, codes = _kind(shape), shape.codes

    most = min(CHUNK, max(1 << 12, BLOCK_VALUES // max(1, len(codes))))

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.empty((len(codes), batch.num_rows), dtype=kind)
        for j, values in enumerate(_columns(batch, len(codes))):
            x[j] = values if codes[j] else binned(values, thresholds[j])
        y, ids, out = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_y", "_id", "_held"))
        marks = (y > 0).astype(np.uint8) + 2 * out.astype(np.uint8)
        return pa.RecordBatch.from_pydict({
            "x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([marks.tobytes()], pa.binary()),
            "first": pa.array([int(ids[0])], pa.int64()), "n": pa.array([batch.num_rows], pa.int32()),
        })

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if waiting and sum(b.num_rows for b in waiting) + batch.num_rows > most:
                yield block(pa.concat_batches(waiting))
                waiting = []
            pieces = [batch.slice(at, most) for at in range(0, batch.num_rows, most)]
            yield from map(block, pieces[:-1])
            waiting += pieces[-1:]
        if waiting:
            yield block(pa.concat_batches(waiting))

    return every.mapInArrow(pack, _BLOCK)


def _opened(x: bytes | pa.Buffer, y: bytes | pa.Buffer, first: int, n: int, kind: np.dtype, margin: bytes | None = None) -> Chunk:
    marks = np.frombuffer(y, dtype=np.uint8)
    # Rows of a block come from one partition, one after the other.
    ids = np.arange(first, first + n)
    return Chunk(np.frombuffer(x, dtype=kind).reshape(-1, n), (marks & 1).astype(float), marks > 1, ids, None if margin is None else np.frombuffer(margin))


def _joined(blocks: Iterator[tuple], kind: np.dtype) -> Iterator[Chunk]:
    """Chunks of nearly ``CHUNK`` rows from blocks that may be small."""
    some: list[Chunk] = []
    for block in chain(blocks, [None]):
        chunk = _opened(*block, kind) if block else None
        if some and (chunk is None or sum(c.n for c in some) + chunk.n > CHUNK):
            label = np.concatenate([c.side for c in some]) / 2 + 0.5
            yield Chunk(np.concatenate([c.x for c in some], axis=1), label, np.concatenate([c.held for c in some]), np.concatenate([c.ids for c in some]))
            some = []
        if chunk is not None:
            some.append(chunk)


def _in_one_task(blocks: DataFrame, settings: Settings, shape: Shape, rounds: int, patience: int | None, least: int) -> Grown:
    kind = _kind(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((b["x"][i].as_buffer(), b["y"][i].as_buffer(), b["first"][i].as_py(), b["n"][i].as_py()) for b in batches for i in range(b.num_rows))
        if chunks := list(_joined(rows, kind)):
            grown = grow(Chunks(chunks, shape.bins), settings, shape, rounds, patience, least)
            plain = [(t.feature, t.left, t.turns, t.gain, t.sums) for t in grown.trees], grown.measured
            yield pa.RecordBatch.from_pydict({"grown": pa.array([pickle.dumps(plain)], pa.binary())})

    trees, measured = pickle.loads(blocks.coalesce(1).mapInArrow(run, "grown binary").first()[0])
    return Grown([Tree(*t) for t in trees], measured)


class Spread:
    """All rows, in blocks on the executors. A job opens them and goes down to the level it asks about."""

    def __init__(self, blocks: DataFrame, shape: Shape):
        self.context = blocks.sparkSession.sparkContext
        self.kind, self.bins = _kind(shape), shape.bins
        size = blocks.agg(F.sum(F.octet_length("x"))).first()[0]
        parts = max(-(-self.context.defaultParallelism // jobs_beside()), -(-size // PART_BYTES))
        self.blocks: RDD = blocks.repartition(parts).rdd.map(lambda r: (*r, None)).persist(StorageLevel.MEMORY_AND_DISK)
        self.kept = [self.blocks]
        self.ended = 0
        if self.context.getCheckpointDir() is None:
            self.context.setCheckpointDir(shared_dir(blocks.sparkSession))

    def close(self) -> None:
        for rdd in self.kept:
            rdd.unpersist()

    def begin(self, number: int, settings: Settings) -> None:
        self.number, self.settings, self.tree, self.steps = number, settings, None, 0

    def move(self, tree: Tree) -> None:
        # Nodes keep their numbers while the tree grows, so its latest state leads down all levels.
        self.tree, self.steps = tree, self.steps + 1

    def _down(self):
        number, settings, tree, steps, kind = self.number, self.settings, self.tree, self.steps, self.kind

        def down(block: tuple) -> Chunk:
            chunk = _opened(*block[:4], kind, block[4])
            chunk.begin(number, settings)
            for _ in range(steps):
                chunk.move(tree)
            return chunk

        return down

    def _sum(self, ask) -> np.ndarray:
        down = self._down()

        def run(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
            total = 0
            for block in blocks:
                total = total + ask(down(block))
            if not isinstance(total, int):
                yield total

        return sum(self.blocks.mapPartitions(run).collect())

    def counts(self, slots: np.ndarray, k: int) -> np.ndarray:
        bins = self.bins
        return self._sum(lambda chunk: chunk.counts(slots, k, bins))

    def sums(self, nodes: int) -> np.ndarray:
        return self._sum(lambda chunk: chunk.sums(nodes))

    def end(self, tree: Tree, weight: float) -> np.ndarray:
        down, kind = self._down(), self.kind

        def moved(block: tuple) -> tuple:
            chunk = down(block)
            chunk.end(tree, weight)
            return (*block[:4], chunk.margin.tobytes())

        def measured(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
            for block in blocks:
                yield _opened(*block[:4], kind, block[4]).measured()

        after = self.blocks.map(moved).persist(StorageLevel.MEMORY_AND_DISK)
        self.kept.append(after)
        self.ended += 1
        if self.ended % CUT == 0:
            after.checkpoint()
        out = sum(after.mapPartitions(measured).collect())
        self.blocks.unpersist()
        self.blocks, self.kept = after, [after]
        return out
