"""Gradient-boosted regression trees as a loop of Spark jobs.

Features are binned once: numbers by quantiles, categories by value, with
bins of their own for missing and for unseen values; rows are kept in the shared
folder in blocks of some thousand, a column each of key hashes, parts, labels
and bins.  A tree grows level by level.  For each level one job adds up,
per open node and feature, the gradients and rows of every bin (numpy in the
tasks).  While the tasks' sums are together below ``DRIVER_BYTES`` the driver
adds them up, which is one stage; of two children only the one of fewer rows is
then counted, the other is the parent less it.  Beyond that sums are shuffled by
node and feature, the best split is found there, and the driver sees one
candidate per node and feature.  With a single feature a node's sums are those bins of the
root's that reach it, so a whole tree takes one job.  A split sends a set of bins to the left: a prefix of a number's bins,
with the missing ones on either side, or the categories of lowest mean gradient
(for squared error no other subset is better).

The pass that opens a round also measures the model so far on training and
validation rows.  So every round has its MAE, RMSE and R² without a scan of its
own, and training stops ``patience`` rounds after the last improvement; the
model is then cut at its best round, nothing is fitted again.  A tree is put
into the scores once.  The executors keep the blocks as arrays (``persist`` of
an RDD, dealt evenly when they are first stored) through all rounds, and beside
them the scores of the current round, 8 bytes a row; every ``write_every`` rounds
the scores alone are checkpointed, which bounds what a lost executor costs.

Losses: "squared" (leaves are means) and "absolute" (trees follow the signs of
the residuals, leaves are the exact medians of their residuals).
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, TaskContext, cloudpickle
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..session import shared_path
from .evaluate import cumulative_importance_select
from .quantiles import exact_quantiles

MAX_BINS = 64
MAX_CATEGORIES = 10_000
#: Bins of a feature's own: a missing number or category, a category not learned.
MISSING, OTHER = 0, 1
#: Cells (node, feature, bin) that one job counts; more nodes take more jobs.
MAX_CELLS = 8 << 20
#: Sums of all tasks, in bytes, up to which the driver adds them up.
DRIVER_BYTES = 32 << 20
#: Rows of a block, at least, where a task has as many.
BLOCK_ROWS = 16_384
#: Stored bytes of blocks that a task takes, about, if there are more than a task a core of them.
#: A task reads its blocks one by one, but sends its own sums of every node.
TASK_BYTES = 256 << 20
#: Values (about) that one job hands to the driver in the search for medians.
MEDIAN_VALUES = 1 << 20
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))

cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ---------------------------------------------------------------- bins

@dataclass
class Binning:
    """Bin edges of numbers and learned values of categories."""

    edges: dict[str, list[float]]
    values: dict[str, list[str]]

    @property
    def features(self) -> list[str]:
        return [*self.edges, *self.values]

    @property
    def sizes(self) -> list[int]:
        return [len(e) + 2 for e in self.edges.values()] + [len(v) + 2 for v in self.values.values()]

    def matrix(self, batch: pa.RecordBatch, first: int) -> np.ndarray:
        """(features, rows) bins of the columns from ``first`` on."""
        out = np.zeros((len(self.features), batch.num_rows), np.uint8 if max(self.sizes, default=0) <= 256 else np.uint16)
        for i, e in enumerate(self.edges.values()):
            v = batch.column(first + i).to_numpy(zero_copy_only=False).astype(np.float64)
            out[i] = np.where(np.isnan(v), MISSING, 1 + np.searchsorted(np.array(e), v, side="left"))
        for i, known in enumerate(self.values.values(), len(self.edges)):
            col = batch.column(first + i)
            at = pc.index_in(col, value_set=pa.array(known, col.type)).fill_null(-1).to_numpy(zero_copy_only=False)
            out[i] = np.where(col.is_null().to_numpy(zero_copy_only=False), MISSING, np.where(at < 0, OTHER, at + 2))
        return out

    def columns(self) -> list:
        return [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.edges)] \
            + [F.col(c).cast("string").alias(f"x{i}") for i, c in enumerate(self.values, len(self.edges))]


def fit_binning(train: DataFrame, numeric: Sequence[str], nominal: Sequence[str] = (), max_bins: int = MAX_BINS,
                max_categories: int = MAX_CATEGORIES) -> Binning:
    """Edges at (approximate) quantiles i / max_bins, which are values of the
    column; of a category the ``max_categories`` most frequent values (the
    others share a bin)."""
    points = [i / max_bins for i in range(1, max_bins)]
    x = train.select(*(F.nullif(F.col(c).cast("double"), F.lit(math.nan)).alias(f"x{i}") for i, c in enumerate(numeric)))
    got = x.agg(*(F.percentile_approx(f"x{i}", points, 20 * max_bins).alias(f"x{i}") for i in range(len(numeric)))).first() if numeric else ()
    edges = {c: sorted(set(q or [])) for c, q in zip(numeric, got)}
    values = {}
    for c in nominal:
        top = train.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("v")).count().orderBy(F.desc("count"), "v").limit(max_categories)
        values[c] = sorted(r["v"] for r in top.collect())           # max_categories values at most
    return Binning(edges, values)


#: A stored block of rows: hashes, parts, labels and the (features, rows) bins.
BLOCK = "h binary, part binary, y binary, x binary"


def _block(h: np.ndarray, part: np.ndarray, y: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    columns = (h, part.astype(np.int8), y, x)
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns], names=["h", "part", "y", "x"])


def _arrays(row: Sequence, width: int) -> tuple:
    """(h, part, y, x) of a stored block."""
    h, part, y, x = (np.frombuffer(v, t) for v, t in zip(row, (np.int64, np.int8, np.float64, np.uint8)))
    if len(x) != width * len(h):
        x = x.view(np.uint16)
    return h, part, y, x.reshape(width, len(h))


def _one_by_one(blocks: RDD) -> RDD:
    """Blocks in batches of one, as ``zip`` pairs them."""
    return blocks._reserialize(BatchedSerializer(CPickleSerializer(), 1))


# ---------------------------------------------------------------- trees

@dataclass
class Tree:
    """Nodes as lists; ``feature`` is -1 in a leaf, ``goes_left`` has the bins
    that go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    goes_left: list[np.ndarray | None] = field(default_factory=lambda: [None])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, goes_left: np.ndarray, gain: float, values: tuple[float, float]) -> tuple[int, int]:
        new = len(self.feature), len(self.feature) + 1
        for v in values:
            self.feature.append(-1)
            self.goes_left.append(None)
            self.left.append(0)
            self.right.append(0)
            self.value.append(v)
            self.gain.append(0.0)
        self.feature[node], self.goes_left[node], self.gain[node] = feature, goes_left, gain
        self.left[node], self.right[node] = new
        return new

    def frozen(self) -> tuple:
        """(levels, feature, next node by node and bin, value) as arrays; a
        leaf's next node is itself."""
        n = len(self.feature)
        step = np.repeat(np.arange(n), max([1, *(len(m) for m in self.goes_left if m is not None)])).reshape(n, -1)
        level = np.zeros(n, np.int64)
        for i, m in enumerate(self.goes_left):
            if m is not None:
                step[i] = self.right[i]
                step[i, :len(m)][m] = self.left[i]
                level[[self.left[i], self.right[i]]] = level[i] + 1
        return int(level.max()), np.maximum(np.array(self.feature), 0), step, np.array(self.value)


def leaves(tree: tuple, x: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """Leaf of every row of a (features, rows) matrix, or of ``rows`` alone."""
    levels, feature, step, _ = tree
    if x.shape[0] == 1 and x.size and x.shape[1] > (bins := int(x.max()) + 1):
        return leaves(tree, np.arange(bins)[None])[x[0] if rows is None else x[0][rows]]            # one feature: by bin, not by row
    rows = np.arange(x.shape[1]) if rows is None else rows
    node = np.zeros(len(rows), np.int64)
    flat, then, width, start = x.ravel(), step.ravel(), step.shape[1], feature * x.shape[1]
    for _ in range(levels):
        b = flat[rows + start[node]]
        # bins of other features' rows at a leaf may lie beyond the table; a leaf stays where it is
        node = then[node * width + np.minimum(b, width - 1)]
    return node


@dataclass
class Boosted:
    """A fitted model: base value, trees, and the metrics of every round."""

    binning: Binning
    base: float
    step: float
    loss: str
    trees: list[Tree] = field(default_factory=list)
    #: (set, round, mae, rmse, r2) of the rounds run, those after the best one included
    history: list[tuple] = field(default_factory=list)
    rounds_run: int = 0

    def feature_importance(self, spark: SparkSession) -> DataFrame:
        """(feature, importance): share of the total gain."""
        total = np.zeros(len(self.binning.features))
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    total[f] += g
        share = total / total.sum() if total.sum() > 0 else total
        return spark.createDataFrame(list(zip(self.binning.features, map(float, share))), "feature string, importance double")

    def history_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, "set string, iteration int, mae double, rmse double, r2 double")


# ---------------------------------------------------------------- one job

def _mix64(h: np.ndarray) -> np.ndarray:
    for m in _MIX:
        h = (h ^ (h >> np.uint64(33))) * m
    return h ^ (h >> np.uint64(33))


def in_bag(h: np.ndarray, seed: int, number: int, share: float) -> np.ndarray:
    """Rows drawn for a round, by hash of the key: the same on any partitioning."""
    if share >= 1:
        return np.ones(len(h), bool)
    salt = _mix64(np.array([seed * 1_000_003 + number], np.int64).view(np.uint64))
    return _mix64(h.view(np.uint64) ^ salt) < np.uint64(int(share * (1 << 64)))


def best_split(g: np.ndarray, c: np.ndarray, nominal: bool, min_leaf: float, l2: float = 0.0) -> tuple[float, np.ndarray, tuple[float, float, float, float]] | None:
    """(gain, bins that go left, sums and rows of both sides), or None."""
    total, rows = g.sum(), c.sum()
    best = None
    if nominal:
        there = np.flatnonzero(c > 0)
        orders = [there[np.lexsort((there, g[there] / c[there]))]]
    else:
        rest = np.arange(1, len(c))
        orders = [np.concatenate(([MISSING], rest)), np.concatenate((rest, [MISSING]))] if c[MISSING] else [rest]
    for order in orders:
        gl, cl = np.cumsum(g[order])[:-1], np.cumsum(c[order])[:-1]
        cr = rows - cl
        ok = (cl >= max(min_leaf, 1)) & (cr >= max(min_leaf, 1))
        if not ok.any():
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ok, gl * gl / (cl + l2) + (total - gl) ** 2 / (cr + l2), -np.inf) - total * total / (rows + l2)
        k = int(np.argmax(gain))
        if gain[k] > 1e-9 * (total * total / rows) and gain[k] > 0 and (best is None or gain[k] > best[0]):
            goes = np.zeros(len(c), bool)
            if nominal and cl[k] * 2 >= rows:
                goes[:] = True                          # values not seen here go with the larger side
                goes[order[k + 1:]] = False
            else:
                goes[order[:k + 1]] = True
                if not nominal and not c[MISSING]:
                    goes[MISSING] = cl[k] * 2 >= rows
            best = float(gain[k]), goes, (float(gl[k]), float(cl[k]), float(total - gl[k]), float(cr[k]))
    return best


class _Loop:
    """Rows in the shared folder and the jobs over them."""

    def __init__(self, spark: SparkSession, model: Boosted, rows: DataFrame, seed: int, subsample: float, min_leaf: float, l2: float, write_every: int):
        self.spark, self.model, self.seed, self.subsample, self.min_leaf, self.l2 = spark, model, seed, subsample, min_leaf, l2
        self.write_every, self.path = write_every, shared_path(spark, "boosting", "rows")
        #: Scores of the rounds that the executors keep, and those that are checkpointed.
        self.kept: list[RDD] = []
        self.safe: list[RDD] = []
        #: Training rows, from the pass that measures.
        self.n_train = 0.0
        #: Gradients are rounded to the first in this tree, to the second in the next one.
        self.unit = self.next_unit = 0.0
        #: Feature -> (gradients, rows) of the root's bins in the last tree, where the driver has them.
        self.root: dict[int, tuple] = {}
        #: Node -> feature -> (gradients, rows) of its bins: the last level, where the driver has them.
        self.sums: dict[int, dict[int, tuple]] = {}
        self.level_sums: dict[int, dict[int, tuple]] = {}
        self._write(rows)

    def _write(self, rows: DataFrame) -> None:
        rows.write.parquet(self.path)
        width, base, cores = len(self.model.binning.features), self.model.base, self.spark.sparkContext.defaultParallelism
        # a pass is short: beyond one task a core, a task costs more than its rows until they fill TASK_BYTES
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        sizes = [f.getLen() for f in p.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(p)]
        waves = max(1, -(-sum(sizes) // (TASK_BYTES * cores)))
        # a file (or an even piece of it) is a split, so that tasks get equally many rows
        conf, split = self.spark.conf, str(max(1, -(-max(sizes, default=1) // -(-waves // 4))))
        before = {key: conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
        for key in before:
            conf.set(key, split)
        try:
            stored = self.spark.read.schema(BLOCK).parquet(self.path).rdd
            self.tasks = min(stored.getNumPartitions(), waves * cores)
        finally:
            for key, value in before.items():
                conf.set(key, value)
        self.rows = _one_by_one(stored.coalesce(self.tasks).map(lambda row: _arrays(row, width))).persist(StorageLevel.MEMORY_AND_DISK_DESER)
        self._keep(self.rows.map(lambda b: np.full(len(b[0]), base)))

    def _blocks(self, scores: RDD) -> RDD:
        """Blocks (arrays h, part, y, f, x) with their scores."""
        return self.rows.zip(scores).map(lambda p: (*p[0][:3], p[1], p[0][3]))

    def _keep(self, scores: RDD, safe: bool = False) -> None:
        """Scores that the executors keep from the next pass on."""
        scores = _one_by_one(scores).persist(StorageLevel.MEMORY_AND_DISK_DESER)
        self.kept.append(scores)
        if safe:
            scores.checkpoint()
            self.safe.append(scores)
        self.blocks = self._blocks(scores)

    def _frame(self, blocks: RDD) -> DataFrame:
        return self.spark.createDataFrame(blocks.map(lambda b: tuple(c.tobytes() for c in b)), "h binary, part binary, y binary, f binary, x binary", verifySchema=False)

    def _let_go(self, keep: int = 0) -> None:
        """Give up scores but for the last ``keep``; checkpoints too, once a later one is written."""
        for d in self.kept[:len(self.kept) - keep]:
            d.unpersist()
        del self.kept[:len(self.kept) - keep]
        while self.safe and (not keep or len(self.safe) > 1 and self.safe[1].isCheckpointed()):
            path = self.safe.pop(0).getCheckpointFile()
            if path:
                self._delete(path)

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def close(self) -> None:
        """Delete the stored rows; nothing of the model reads them."""
        self._let_go()
        self.rows.unpersist()
        self._delete(self.path)

    def put(self, tree: Tree, number: int, final: bool) -> None:
        """Put a tree into the scores.  The executors keep them, filled by the
        next pass; ``final`` ones are read by one pass only."""
        t, step = tree.frozen(), self.model.step
        scored = self.blocks.map(lambda b: b[3] + (step * t[3])[leaves(t, b[4])])
        if final:
            self.blocks = self._blocks(_one_by_one(scored))
        else:
            self._keep(scored, number % self.write_every == 0)

    def round_off(self, total: float) -> None:
        """``total``: the sum of the residuals' absolute values.  From the next tree on
        gradients are multiples of a power of two of which twice the total is at
        most 2^53, so that their sums are exact in any order: a parent less one
        child is the other child."""
        self.next_unit = 2.0 ** (math.ceil(math.log2(2 * total)) - 53) if 0 < total < 1e300 else 0.0

    def next_level(self, root: bool) -> None:
        """The sums of the level done are those of the parents."""
        if root:
            self.unit = self.next_unit
        self.sums, self.level_sums = {} if root else self.level_sums, {}

    def _larger(self, tree: Tree, open_nodes: list[int]) -> dict[int, tuple[int, int]]:
        """Nodes whose sums follow from (their parent, its other child)."""
        rest, there = {}, set(open_nodes)
        for parent, sums in self.sums.items():
            pair = tree.left[parent], tree.right[parent]
            if tree.feature[parent] >= 0 and there.issuperset(pair):
                c = sums[tree.feature[parent]][1]
                left = c[tree.goes_left[parent]].sum()
                larger, other = pair if left > c.sum() - left else pair[::-1]
                rest[larger] = parent, other
        return rest

    def level(self, tree: Tree, open_nodes: list[int], feats: list[int], number: int, measure: bool) -> tuple[dict, dict]:
        """Best split of each open node ({node: (gain, feature, bins, sums)}) and,
        with ``measure``, {part: sums} of the model without ``tree``."""
        self.root = {}
        grown, sizes = tree.frozen(), self.model.binning.sizes
        seed, share, absolute, base = self.seed, self.subsample, self.model.loss == "absolute", self.model.base
        n_numeric, min_leaf, l2, unit = len(self.model.binning.edges), self.min_leaf, self.l2, self.unit
        cells = sum(sizes[f] for f in feats)
        # of two children with known sums of the parent only the one of fewer rows is counted
        rest = self._larger(tree, open_nodes)
        nodes = [i for i in open_nodes if i not in rest]
        # the driver adds up small sums; with one feature they are at most MAX_CATEGORIES bins a task
        here = 16 * len(nodes) * cells * self.tasks <= DRIVER_BYTES
        if not here:
            rest, nodes = {}, open_nodes
        slots = len(nodes)
        slot_of = np.full(len(tree.feature), -1)
        slot_of[nodes] = np.arange(slots)

        def count(blocks):
            g_sum = [np.zeros(slots * sizes[f]) for f in feats]
            c_sum = [np.zeros(slots * sizes[f]) for f in feats]
            seen = np.zeros((2, 5))
            for h, which, y, f, x in blocks:
                e = y - f
                if measure:
                    off = y - base
                    for p in (0, 1):
                        m = which == p
                        seen[p] += m.sum(), np.abs(e[m]).sum(), (e[m] ** 2).sum(), off[m].sum(), (off[m] ** 2).sum()
                # the rows that count, by number: of the bins only those looked at are copied
                rows = np.flatnonzero((which == 0) & in_bag(h, seed, number, share))
                if grown[0]:
                    slot = slot_of[leaves(grown, x, rows)]
                    if len(gone := np.flatnonzero(slot < 0)):
                        slot, rows = np.delete(slot, gone), np.delete(rows, gone)
                some = len(rows) < len(e)
                if some:
                    e = e[rows]
                g = np.sign(e) if absolute else np.rint(e / unit) * unit if unit else e
                first = {size: slot * size for size in {sizes[j] for j in feats}} if slots > 1 else {}
                for k, j in enumerate(feats):
                    at = x[j][rows] if some else x[j]
                    if slots > 1:
                        at = first[sizes[j]] + at
                    g_sum[k] += np.bincount(at, g, slots * sizes[j])
                    c_sum[k] += np.bincount(at, minlength=slots * sizes[j])
            task = TaskContext.get().partitionId()
            out = [(-1, p, task, seen[p].tobytes(), b"") for p in (0, 1) if seen[p][0]] if measure else []
            for k, j in enumerate(feats):
                g, c = g_sum[k].reshape(slots, -1), c_sum[k].reshape(slots, -1)
                if here:
                    out.append((0, j, task, g.tobytes(), c.tobytes()))
                else:
                    out += [(s, j, task, g[s].tobytes(), c[s].tobytes()) for s in np.flatnonzero(c.any(axis=1)).tolist()]
            return out

        def choose(batches):
            key, g, c, out = None, None, None, []

            def done():
                if key is None:
                    return
                if key[0] < 0:
                    out.append((*key, 0.0, b"", g.tobytes()))
                    return
                found = best_split(g, c, key[1] >= n_numeric, min_leaf, l2)
                if found:
                    out.append((*key, found[0], found[1].tobytes(), np.array(found[2]).tobytes()))

            for b in batches:
                for s, f, gb, cb in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4))):
                    gv, cv = np.frombuffer(gb), np.frombuffer(cb)
                    if key == (s, f):
                        g, c = g + gv, c + cv
                    else:
                        done()
                        key, g, c = (s, f), gv, cv
            done()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary()))],
                                                 names=["slot", "feature", "gain", "bins", "sums"])

        counted = self.blocks.mapPartitions(count)
        best: dict[int, tuple] = {}
        measured: dict[int, np.ndarray] = {}

        def offer(s: int, f: int, found: tuple) -> None:
            if s not in best or found[0] > best[s][0]:
                best[s] = found[0], f, *found[1:]
        if here:
            total: dict[tuple[int, int], tuple] = {}
            for s, f, _, gb, cb in sorted(counted.collect(), key=lambda r: r[:3]):          # DRIVER_BYTES at most
                g, c = total.get((s, f), (0.0, 0.0))
                total[s, f] = g + np.frombuffer(gb), c + np.frombuffer(cb)
            sums: dict[int, dict[int, tuple]] = {node: {} for node in open_nodes}
            for (s, f), (g, c) in total.items():
                if s < 0:
                    measured[f] = g
                    continue
                for node, gn, cn in zip(nodes, g.reshape(slots, -1), c.reshape(slots, -1)):
                    sums[node][f] = gn, cn
                for node, (parent, other) in rest.items():
                    (gp, cp), (go, co) = self.sums[parent][f], sums[other][f]
                    cn = cp - co
                    sums[node][f] = np.where(cn > 0, gp - go, 0.0), cn
            for i, node in enumerate(open_nodes):
                for f, (g, c) in sums[node].items():
                    found = best_split(g, c, f >= n_numeric, min_leaf, l2) if c.any() else None
                    if found:
                        offer(i, f, found)
            self.root = sums[0] if open_nodes == [0] else {}
            self.level_sums.update(sums if 16 * len(open_nodes) * cells <= DRIVER_BYTES else {})
        else:
            width = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            n = max(1, min(width, slots * len(feats) // 64))
            sums = self.spark.createDataFrame(counted, "slot int, feature int, task int, g binary, c binary", verifySchema=False)
            got = sums.repartition(n, "slot", "feature").sortWithinPartitions("slot", "feature", "task") \
                .mapInArrow(choose, "slot int, feature int, gain double, bins binary, sums binary").collect()        # nodes x features rows
            for r in sorted(got, key=lambda r: (r["slot"], r["feature"])):
                if r["slot"] < 0:
                    measured[r["feature"]] = np.frombuffer(r["sums"])
                else:
                    offer(r["slot"], r["feature"], (r["gain"], np.frombuffer(r["bins"], bool), tuple(np.frombuffer(r["sums"]))))
        if measure:
            self.n_train = float(measured[0][0]) if 0 in measured else 0.0
            self.round_off(float(measured[0][1]) if 0 in measured else 0.0)
            self._let_go(1)                             # this pass has filled the last one
        return {open_nodes[s]: v for s, v in best.items()}, measured

    def grow(self, tree: Tree, depth: int, feature: int = 0) -> None:
        """All levels of a tree on one feature alone, from the root's sums."""
        held, level = {0: self.root[feature]}, 0
        nominal = feature >= len(self.model.binning.edges)
        while held and level < depth:
            opened = {}
            for node, (g, c) in held.items():
                found = best_split(g, c, nominal, self.min_leaf, self.l2)
                if found:
                    gain, goes, (gl, cl, gr, cr) = found
                    for child, m in zip(tree.split(node, feature, goes, gain, (gl / (cl + self.l2), gr / (cr + self.l2))), (~goes, goes)):
                        opened[child] = np.where(m, 0.0, g), np.where(m, 0.0, c)
            held, level = opened, level + 1

    def _residuals(self, tree: Tree, number: int, lo: np.ndarray, hi: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One pass: per leaf the residuals below, at ``lo``, between, at ``hi``
        and above; and the leaf and value of about ``share`` of those between."""
        part, seed, subsample, n = tree.frozen(), self.seed, self.subsample, len(tree.feature)

        def run(blocks):
            counts, kept = np.zeros((n, 5), np.int64), []
            rng = np.random.default_rng((abs(seed), number, TaskContext.get().partitionId()))        # which ones are drawn does not bear on the result
            for h, which, y, f, x in blocks:
                rows = np.flatnonzero((which == 0) & in_bag(h, seed, number, subsample))
                r = (y - f)[rows] + 0.0                 # -0.0 and 0.0 are one value
                leaf = leaves(part, x, rows)
                if len(odd := np.flatnonzero(np.isnan(r))):
                    leaf, r = np.delete(leaf, odd), np.delete(r, odd)
                a, z = lo[leaf], hi[leaf]
                # 0 below, 1 at lo, 2 between, 3 at hi, 4 above; with lo = hi its values count as 1
                where = (r >= a).astype(np.int64) + (r > a) + ((r >= z) & (z > a)) + (r > z) + ((r > z) & (z == a))
                counts += np.bincount(leaf * 5 + where, minlength=n * 5).reshape(n, 5)
                between = where == 2
                if share < 1:
                    between &= rng.random(len(r)) < share
                kept.append((leaf[between].astype(np.int32), r[between]))
            leaf, r = (np.concatenate([k[i] for k in kept]) if kept else np.zeros(0, t) for i, t in enumerate((np.int32, np.float64)))
            return [(counts, leaf, r)]

        got = self.blocks.mapPartitions(run).collect()       # about MEDIAN_VALUES values
        counts = sum((g[0] for g in got), np.zeros((n, 5), np.int64))
        leaf, r = (np.concatenate([np.zeros(0, t), *(g[k] for g in got)]) for k, t in ((1, np.int32), (2, np.float64)))
        order = np.lexsort((r, leaf))
        return counts, leaf[order], r[order]

    def set_medians(self, tree: Tree, number: int) -> None:
        """Leaves become the exact medians of their rows' residuals.

        Values drawn from a leaf's bracket (at first everything) give a narrower
        one; the counts of a pass are exact, so a bracket that misses the middle
        is noticed, and the search ends with all values of a bracket that holds
        it.  What is open after some passes takes ``exact_quantiles``."""
        n = len(tree.feature)
        whole = np.full(n, -math.inf), np.full(n, math.inf)
        (lo, hi), (out_lo, out_hi) = (v.copy() for v in whole), (v.copy() for v in whole)
        open_ = {i for i, f in enumerate(tree.feature) if f < 0}
        share = min(1.0, MEDIAN_VALUES / max(1.0, self.n_train * min(1.0, self.subsample)))
        for _ in range(6):
            counts, leaf, values = self._residuals(tree, number, lo, hi, share)
            left = 0.0
            for i in sorted(open_):
                below, at_lo, mid, at_hi, above = counts[i].tolist()
                rows, end = below + at_lo + mid + at_hi + above, below + at_lo + mid + at_hi
                first, second = (rows - 1) // 2, rows // 2
                if not rows:
                    open_.discard(i)
                    continue
                if first < below or second >= end:
                    lo[i], hi[i] = out_lo[i], out_hi[i]     # missed: another draw from the bracket before
                    left += rows
                    continue
                out_lo[i], out_hi[i] = lo[i], hi[i]
                drawn = values[np.searchsorted(leaf, i):np.searchsorted(leaf, i, side="right")]

                def at(rank: int) -> float | None:
                    rank -= below
                    if rank < at_lo:
                        return float(lo[i])
                    if rank >= at_lo + mid:
                        return float(hi[i])
                    return float(drawn[rank - at_lo]) if len(drawn) == mid else None
                a, z = at(first), at(second)
                if a is not None and z is not None:
                    tree.value[i] = a if a == z else a + 0.5 * (z - a)
                    open_.discard(i)
                    continue
                k = len(drawn)
                slack = 2.5 * math.sqrt(k) + 2              # five standard deviations of a drawn rank
                p, q = ((max(0, min(mid, x - below - at_lo)) * k / mid) for x in (first, second))
                p, q = math.floor(p - slack), math.ceil(q + slack)
                if p >= 0:
                    lo[i] = drawn[p]
                if q < k:
                    hi[i] = drawn[q]
                left += mid * min(1.0, (min(k, q) - max(0, p) + 2) / (k + 1))
            for i in range(n):
                if i not in open_:
                    lo[i] = hi[i] = math.inf                # nothing between: draws no value
            if not open_:
                return
            share = min(1.0, MEDIAN_VALUES / max(1.0, left))
        part, seed, subsample, width = tree.frozen(), self.seed, self.subsample, len(self.model.binning.features)

        def run(batches):
            for b in batches:
                for row in zip(*(c.to_pylist() for c in b.columns)):
                    h, which, y, x = _arrays((*row[:3], row[4]), width)
                    f = np.frombuffer(row[3])
                    take = (which == 0) & in_bag(h, seed, number, subsample)
                    yield pa.RecordBatch.from_arrays([pa.array(leaves(part, x)[take]), pa.array((y - f)[take])], names=["leaf", "r"])
        rest = self._frame(self.blocks).mapInArrow(run, "leaf long, r double").where(F.col("leaf").isin(sorted(open_)))
        for r in exact_quantiles(rest, "r", [0.5], ["leaf"]).collect():    # one row a leaf
            tree.value[r["leaf"]] = r["q"]


def _metrics(sums: np.ndarray) -> tuple[float, float, float | None]:
    n, a, s, y, yy = map(float, sums)
    spread = yy - y * y / n
    return a / n, math.sqrt(s / n), 1 - s / spread if spread > 0 else None


# ---------------------------------------------------------------- fit and apply

def _prepare(train: DataFrame, label: str, numeric: Sequence[str], nominal: Sequence[str], key: str, valid: DataFrame | None, step: float, loss: str,
             max_bins: int, binning: Binning | None, seed: int, subsample: float, min_leaf: float, l2: float, write_every: int) -> _Loop:
    """Bins, base value and the stored blocks of an untrained model."""
    spark = train.sparkSession
    both = train.withColumn("_part", F.lit(0)) if valid is None else train.withColumn("_part", F.lit(0)).unionByName(valid.withColumn("_part", F.lit(1)))
    both = both.where(F.col(label).isNotNull() & ~F.isnan(F.col(label).cast("double")))
    train = both.where("_part = 0")
    binning = binning or fit_binning(train, numeric, nominal, max_bins)
    if loss == "absolute":
        start = exact_quantiles(train, label, [0.5]).select("q").first()
    else:
        y = F.col(label).cast("double")
        start = train.agg(F.avg(y), F.count(y) * F.stddev_pop(y)).first()       # not below the sum of |y - mean|
    base = float(start[0]) if start and start[0] is not None else 0.0
    model = Boosted(binning, base, step, loss)
    bins_of = binning.matrix

    def rows(batches):
        held, n = [], 0

        def block():
            h, part, y, x = (np.concatenate(v, axis=-1) for v in zip(*held))
            held.clear()
            return _block(h, part, y, x)
        for b in batches:
            if b.num_rows:
                held.append((*(b.column(i).to_numpy() for i in range(3)), bins_of(b, 3)))
                n += b.num_rows
                if n >= BLOCK_ROWS:
                    yield block()
                    n = 0
        if held:
            yield block()

    flat = both.select(F.xxhash64(F.col(key)).alias("h"), F.col("_part").alias("part"), F.col(label).cast("double").alias("y"), *binning.columns())
    # the input may lie in few tasks: whole blocks are dealt evenly once, before the many passes
    cores = spark.sparkContext.defaultParallelism
    n = cores * max(4, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // cores))
    loop = _Loop(spark, model, flat.mapInArrow(rows, BLOCK).repartition(n), seed, subsample, min_leaf, l2, write_every)
    if loss != "absolute":
        loop.round_off((start and start[1]) or 0.0)
    return loop


def fit_boosted(train: DataFrame, label: str, numeric: Sequence[str], nominal: Sequence[str] = (), key: str = "key", valid: DataFrame | None = None,
                rounds: int = 200, depth: int = 6, step: float = 0.05, subsample: float = 0.8, feature_share: float = 0.8, loss: str = "squared",
                min_leaf: int = 1, l2: float = 0.0, patience: int | None = None, seed: int = 42, max_bins: int = MAX_BINS, write_every: int = 20,
                binning: Binning | None = None) -> Boosted:
    """Fit a model; the call runs the jobs.

    With ``valid`` its rows are measured every round (by MAE for the absolute
    loss, else RMSE); with ``patience`` too, training ends that many rounds after
    the best one and the later trees are dropped.  Rows without a label are left
    out.  ``key`` names the rows for the sampling of a round (rows of equal key
    are drawn together).
    """
    loop = _prepare(train, label, numeric, nominal, key, valid, step, loss, max_bins, binning, seed, subsample, min_leaf, l2, write_every)
    model = loop.model
    binning = model.binning
    rng = np.random.default_rng(seed)
    n_features = len(binning.features)
    best_round, best_value = 0, math.inf
    at = 2 if loss == "absolute" else 3
    for number in range(1, rounds + 2):
        feats = sorted(rng.choice(n_features, max(1, round(feature_share * n_features)), replace=False).tolist())
        tree, open_nodes, level = Tree(), [0], 0
        last = number > rounds
        while open_nodes and level < (1 if last else depth):
            per_job = max(1, MAX_CELLS // sum(binning.sizes[f] for f in feats))
            splits: dict[int, tuple] = {}
            loop.next_level(level == 0)
            for lo in range(0, len(open_nodes), per_job):
                found, measured = loop.level(tree, open_nodes[lo:lo + per_job], feats[:1] if last else feats, number, measure=level == 0 and lo == 0)
                splits.update(found)
                for p, sums in measured.items() if number > 1 else ():
                    model.history.append((("train", "valid")[p], number - 1, *_metrics(sums)))
            if level == 0 and number > 1 and valid is not None:
                judged = [h for h in model.history if h[0] == "valid" and h[1] == number - 1]
                value = judged[0][at] if judged else math.inf
                if value < best_value:
                    best_round, best_value = number - 1, value
                if patience is not None and number - 1 - best_round >= patience:
                    last = True
            if last:
                break
            if n_features == 1 and loop.root:
                loop.grow(tree, depth)
                break
            opened = []
            for node in sorted(splits):
                gain, f, goes, (gl, cl, gr, cr) = splits[node]
                opened += tree.split(node, f, goes, gain, (gl / (cl + l2), gr / (cr + l2)))
            open_nodes, level = opened, level + 1
        if last:
            break
        if len(tree.feature) == 1:
            tree.value[0] = 0.0
        if loss == "absolute":
            loop.set_medians(tree, number)
        model.trees.append(tree)
        model.rounds_run = number
        loop.put(tree, number, final=number == rounds)
    loop.close()
    if patience is not None and valid is not None:
        model.trees = model.trees[:best_round]
    model.history.sort(key=lambda h: (h[0], h[1]))
    return model


def gains_alone(train: DataFrame, label: str, numeric: Sequence[str], nominal: Sequence[str] = (), key: str = "key", depth: int = 6,
                min_leaf: int = 1, l2: float = 0.0, max_bins: int = MAX_BINS) -> dict[str, float]:
    """Total gain of one whole tree on each feature alone, on all rows.  The rows
    are binned and written once and counted in one job."""
    loop = _prepare(train, label, numeric, nominal, key, None, 1.0, "squared", max_bins, None, 42, 1.0, min_leaf, l2, 1)
    names, gains = loop.model.binning.features, {}
    loop.next_level(True)
    loop.level(Tree(), [0], list(range(len(names))), 1, measure=False)
    for f, name in enumerate(names):
        if f in loop.root:
            loop.grow(tree := Tree(), depth, f)
        else:                                               # sums too large for the driver: levels as jobs
            own = ([name], []) if name in loop.model.binning.edges else ([], [name])
            fitted = fit_boosted(train, label, *own, key, rounds=1, depth=depth, step=1.0, subsample=1.0, feature_share=1.0, min_leaf=min_leaf, l2=l2, max_bins=max_bins).trees
            tree = fitted[0] if fitted else Tree()
        gains[name] = float(sum(tree.gain))
    loop.close()
    return gains


def select_and_refit(train: DataFrame, label: str, numeric: Sequence[str], nominal: Sequence[str], share: float = 0.85,
                     quick: dict | None = None, **kw) -> tuple[Boosted, list[str], Boosted]:
    """(quick model, features kept, model on them): a quick fit ranks the
    features by gain, ``cumulative_importance_select`` keeps those that make up
    ``share``, and a second fit (``kw``) uses only these.  Bins are made once."""
    spark = train.sparkSession
    binning = fit_binning(train, numeric, nominal)
    first = fit_boosted(train, label, numeric, nominal, binning=binning, **{"key": kw.get("key", "key"), **(quick or {})})
    kept = {r["feature"] for r in cumulative_importance_select(first.feature_importance(spark), share).collect()}       # one row a feature
    fewer = Binning({c: e for c, e in binning.edges.items() if c in kept}, {c: v for c, v in binning.values.items() if c in kept})
    return first, fewer.features, fit_boosted(train, label, list(fewer.edges), list(fewer.values), binning=fewer, **kw)


def _apply(model: Boosted, df: DataFrame, keep: Sequence[str], staged: str | None):
    trees = df.sparkSession.sparkContext.broadcast([t.frozen() for t in model.trees])      # bounded by rounds and depth
    base, step, bins_of = model.base, model.step, model.binning.matrix
    first = len(keep)
    if staged is None:
        def run(batches):
            for b in batches:
                if b.num_rows:
                    x = bins_of(b, first)
                    f = np.full(b.num_rows, base)
                    for t in trees.value:
                        f += step * t[3][leaves(t, x)]
                    yield pa.RecordBatch.from_arrays([*b.columns[:first], pa.array(f)], names=[*b.schema.names[:first], "prediction"])
        return run

    def stages(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            x, y = bins_of(b, first), b.column(1).to_numpy(zero_copy_only=False)
            names = np.array(b.column(0).to_pylist(), object)
            f = np.full(b.num_rows, base)
            sets = [(s, np.flatnonzero(names == s)) for s in set(names.tolist())]
            for k, t in enumerate(trees.value):
                f += step * t[3][leaves(t, x)]
                for s, at in sets:
                    e, off = y[at] - f[at], y[at] - base
                    sums.setdefault(s, np.zeros((len(trees.value), 5)))[k] += len(at), np.abs(e).sum(), (e * e).sum(), off.sum(), (off * off).sum()
        for s, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([s] * len(v)), pa.array(np.arange(1, len(v) + 1, dtype=np.int32)), *(pa.array(v[:, i].copy()) for i in range(5))],
                                             names=["set", "iteration", "n", "a", "s", "y", "yy"])
    return stages


def score_boosted(model: Boosted, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns and ``prediction``; any feature may be missing or new."""
    d = df.select(*(F.col(c) for c in keep), *model.binning.columns())
    out = StructType([*d.schema.fields[:len(keep)], StructField("prediction", DoubleType())])
    return d.mapInArrow(_apply(model, d, keep, None), out)


def score_many(models: dict[str, tuple[Boosted, str]], df: DataFrame, keep: Sequence[str] = (), out: str = "predictions") -> DataFrame:
    """``keep`` columns and an array with every model's prediction, in one pass.
    ``models[name]`` is (model, link): "identity", or "log1p" for a model of
    the logarithm, whose predictions are taken back."""
    sent = df.sparkSession.sparkContext.broadcast([(m.base, m.step, link, [t.frozen() for t in m.trees]) for m, link in models.values()])
    binnings = [m.binning for m, _ in models.values()]
    first, places, columns = len(keep), [], []
    for b in binnings:
        places.append(first + len(columns))
        columns += [c.alias(f"x{len(columns) + i}") for i, c in enumerate(b.columns())]
    d = df.select(*(F.col(c) for c in keep), *columns)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            got = np.empty((b.num_rows, len(binnings)))
            for k, (bins, at, (base, step, link, trees)) in enumerate(zip(binnings, places, sent.value)):
                x = bins.matrix(b, at)
                f = np.full(b.num_rows, base)
                for t in trees:
                    f += step * t[3][leaves(t, x)]
                got[:, k] = np.expm1(f) if link == "log1p" else f
            offsets = np.arange(b.num_rows + 1, dtype=np.int32) * len(binnings)
            yield pa.RecordBatch.from_arrays([*b.columns[:first], pa.ListArray.from_arrays(pa.array(offsets), pa.array(got.ravel()))], names=[*b.schema.names[:first], out])

    return d.mapInArrow(run, StructType([*d.schema.fields[:first], StructField(out, ArrayType(DoubleType()))]))


def staged_metrics(model: Boosted, df: DataFrame, label: str, set_col: str | None = None) -> DataFrame:
    """(set, iteration, mae, rmse, r2) after every round on any rows, in one pass:
    running sums of the trees' outputs per row, added up per task and round."""
    d = df.where(F.col(label).isNotNull()).select((F.col(set_col) if set_col else F.lit("all")).cast("string").alias("set"), F.col(label).cast("double").alias("y"),
                                                  *model.binning.columns())
    got = d.mapInArrow(_apply(model, d, ["set", "y"], label), "set string, iteration int, n double, a double, s double, y double, yy double")
    t = got.groupBy("set", "iteration").agg(*(F.sum(c).alias(c) for c in ("n", "a", "s", "y", "yy")))
    return t.select("set", "iteration", (F.col("a") / F.col("n")).alias("mae"), F.sqrt(F.col("s") / F.col("n")).alias("rmse"),
                    (1 - F.try_divide("s", F.col("yy") - F.col("y") * F.col("y") / F.col("n"))).alias("r2"))


# ---------------------------------------------------------------- storage

def save_boosted(spark: SparkSession, model: Boosted, path: str) -> None:
    """A model as Parquet: one row with its header, one row a node."""
    head = json.dumps({"edges": model.binning.edges, "values": model.binning.values, "base": model.base, "step": model.step, "loss": model.loss,
                       "history": model.history, "rounds_run": model.rounds_run})
    nodes = [(k, i, f, None if m is None else bytearray(m.tobytes()), a, b, float(v), float(g)) for k, t in enumerate(model.trees)
             for i, (f, m, a, b, v, g) in enumerate(zip(t.feature, t.goes_left, t.left, t.right, t.value, t.gain))]
    spark.createDataFrame([(head,)], "head string").write.mode("overwrite").parquet(f"{path}/head")
    spark.createDataFrame(nodes, "tree int, node int, feature int, goes_left binary, left int, right int, value double, gain double") \
        .write.mode("overwrite").parquet(f"{path}/nodes")


def load_boosted(spark: SparkSession, path: str) -> Boosted:
    h = json.loads(spark.read.parquet(f"{path}/head").first()[0])
    model = Boosted(Binning(h["edges"], h["values"]), h["base"], h["step"], h["loss"], history=[tuple(x) for x in h["history"]], rounds_run=h["rounds_run"])
    for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():             # bounded by rounds and depth
        if r["node"] == 0:
            model.trees.append(Tree([], [], [], [], [], []))
        t = model.trees[-1]
        mask = None if r["goes_left"] is None else np.frombuffer(bytes(r["goes_left"]), bool)
        for values, x in zip((t.feature, t.goes_left, t.left, t.right, t.value, t.gain), (r["feature"], mask, r["left"], r["right"], r["value"], r["gain"])):
            values.append(x)
    return model
