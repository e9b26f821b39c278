"""Leaf-wise histogram boosting for count data (O-55..O-57): Poisson and
Tweedie objectives, categories as categories, early stopping, resumable.

The rows are binned once (``Binner``) and written as blocks: one row of the
table holds up to ``BLOCK_ROWS`` training rows as byte arrays (a bin per
feature, label, margin). A fit reads them into an RDD of numpy arrays, up to
``PART_ROWS`` rows a partition where the table is small: a round takes as many
passes as its tree is deep, and on few rows a pass is mostly Spark's own time
for planning, starting tasks and shuffling. Each boosting round grows one tree
per group (a group is a model of its own, e.g. one per store; without a group
column there is one):

* a pass over the blocks sums gradient, hessian and rows by (node, feature,
  bin). Spark adds up the tasks' sums by feature; only the totals reach the
  driver, packed: at most leaves x features x bins numbers a group, whatever
  the number of rows and tasks;
* the driver finds each node's best split and splits the best leaf first. A
  split's children are unknown until the next pass, so the order is replayed
  with what is known and every child it runs into is summed in one pass. The
  tree is the one that splitting leaf by leaf gives, with as many passes as the
  tree is deep. Of two children only the smaller one is summed; the other one
  is the difference;
* a pass adds the leaf values to the margins (and the validation rows' errors).

Gradients and hessians are rounded to integers (``_scales``), so sums don't
depend on the order of rows, partitions or retries: any run, also one resumed
from its state folder, gives the same trees.

Numeric features are cut at quantiles, missing values go to the side that
gains more. Categorical features are split into two sets of categories, taken
in the order of their gradient; categories beyond the ``max_categories`` most
frequent ones, unseen and missing values share a bin of their own.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_path, scratch_path, stage_table

BLOCK_ROWS = 1 << 14
#: Rows of a partition, as long as there are no more partitions than the cluster
#: has use for: a pass over fewer takes less than another task and a shuffle.
PART_ROWS = 1 << 17
#: Up to so many partitions the driver adds up their sums itself; beyond, a shuffle does it first.
DIRECT_PARTITIONS = 1
#: Groups (models) of one fit: bounds the sums that reach the driver. ``plans.train`` fits more in turns.
MAX_GROUPS = 64
_NULL = "\x00"
_BLOCK = "block long, grp binary, y binary, bins binary, valid binary, margin binary"


@dataclass
class HistParams:
    power: float = 1.1            # 1.0 = Poisson, (1, 2) = Tweedie
    rounds: int = 90
    learning_rate: float = 0.1
    num_leaves: int = 31
    max_depth: int | None = None  # also bounds the passes of a round
    min_instances: int = 20
    min_hessian: float = 1e-3
    l2: float = 0.0
    max_bins: int = 63
    max_categories: int = 254
    cat_smooth: float = 10.0
    cat_l2: float = 10.0
    row_fraction: float = 1.0
    col_fraction: float = 1.0
    seed: int = 42
    stage_every: int = 20
    early_stopping_rounds: int | None = None


# ---------------------------------------------------------------- bins

@dataclass
class Binner:
    """Upper edges of each numeric feature and the categories of each
    categorical one. Bin 0 stands for missing (and unseen or rare) values."""
    numeric: dict[str, list[float]]
    categorical: dict[str, list[str]]

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    @property
    def is_categorical(self) -> np.ndarray:
        return np.array([False] * len(self.numeric) + [True] * len(self.categorical))

    @property
    def n_bins(self) -> int:
        return 1 + max([len(e) + 1 for e in self.numeric.values()] + [len(c) for c in self.categorical.values()] + [1])

    def bins(self, batch: pa.RecordBatch) -> np.ndarray:
        """[feature, row] bins of a batch."""
        kind = np.uint8 if self.n_bins <= 256 else np.uint16
        out = np.zeros((len(self.features), batch.num_rows), kind)
        for i, (name, edges) in enumerate(self.numeric.items()):
            x = batch.column(name).cast(pa.float64()).to_numpy(zero_copy_only=False)
            out[i] = np.where(np.isnan(x), 0, np.searchsorted(np.array(edges), x, "left") + 1)
        for i, (name, values) in enumerate(self.categorical.items(), len(self.numeric)):
            x = pc.fill_null(batch.column(name).cast(pa.string()), _NULL)
            code = pc.index_in(x, value_set=pa.array(values, pa.string()))
            out[i] = pc.fill_null(code, -1).to_numpy(zero_copy_only=False) + 1
        return out


def fit_bins(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], params: HistParams) -> Binner:
    """Quantile edges in one aggregate; categories by frequency from one
    stacked count, ``max_categories`` of each column to the driver."""
    at = [i / params.max_bins for i in range(1, params.max_bins)]
    edges: dict[str, list[float]] = {}
    if numeric:
        x = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
        row = train.agg(*(F.percentile_approx(x(c), at, 20 * params.max_bins).alias(c) for c in numeric)).first()
        edges = {c: sorted(set(row[c] or [])) for c in numeric}
    values: dict[str, list[str]] = {}
    if categorical:
        each = F.array(*(F.struct(F.lit(c).alias("name"), F.coalesce(F.col(c).cast("string"), F.lit(_NULL)).alias("value")) for c in categorical))
        counts = train.select(F.inline(each)).groupBy("name", "value").count().checkpoint(eager=True)
        for c in categorical:
            top = counts.where(F.col("name") == c).orderBy(F.desc("count"), "value").limit(params.max_categories).collect()
            values[c] = [r["value"] for r in top]
    return Binner(edges, values)


# ---------------------------------------------------------------- trees

@dataclass
class Tree:
    """Nodes of one round, all groups together. ``left`` is a table of bins
    that go to the left child; leaves have feature -1 and a value."""
    roots: np.ndarray          # by group; -1: the group has stopped
    feature: np.ndarray
    left: np.ndarray           # [node, bin] bool
    children: np.ndarray       # [node, 2]
    value: np.ndarray

    def route(self, grp: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """Node where each row ends, -1 in stopped groups."""
        node = self.roots[grp].astype(np.int32)
        live = np.flatnonzero(node >= 0)
        live = live[self.feature[node[live]] >= 0]
        # take() on flat arrays: the same places as by two indices, in half the time
        row, feature, children = self.feature.astype(np.int64) * bins.shape[1], self.feature, self.children.ravel()
        bins, left, n_bins = bins.ravel(), self.left.ravel(), self.left.shape[1]
        at = node.take(live)
        while len(live):
            goes = left.take(at.astype(np.int64) * n_bins + bins.take(row.take(at) + live))
            at = children.take(2 * at + ~goes)
            node[live] = at
            inner = feature.take(at) >= 0
            live, at = live[inner], at[inner]
        return node

    def add_to(self, margin: np.ndarray, grp: np.ndarray, bins: np.ndarray) -> None:
        node = self.route(grp, bins)
        margin += np.where(node >= 0, self.value[node], 0.0)

    def to_json(self) -> str:
        return json.dumps({"roots": self.roots.tolist(), "feature": self.feature.tolist(), "children": self.children.tolist(), "value": self.value.tolist(),
                           "left": [np.flatnonzero(x).tolist() for x in self.left], "bins": self.left.shape[1]})

    @classmethod
    def from_json(cls, text: str) -> Tree:
        d = json.loads(text)
        left = np.zeros((len(d["feature"]), d["bins"]), bool)
        for row, on in zip(left, d["left"]):
            row[on] = True
        return cls(np.array(d["roots"], np.int32), np.array(d["feature"], np.int32), left, np.array(d["children"], np.int32).reshape(-1, 2), np.array(d["value"], float))


@dataclass
class HistModel:
    binner: Binner
    groups: list[str] | None   # values of the group column, or None
    group: str | None
    base: list[float]          # margin before the first tree, by group
    trees: list[Tree]
    best_round: list[int] | None = None

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the expected count; null for rows of unknown groups."""
        shared = df.sparkSession.sparkContext.broadcast(self)
        keep = [c for c in df.columns if c != out]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            for batch in batches:
                grp, known = m.group_codes(batch)
                bins = m.binner.bins(batch)
                margin = np.array(m.base)[grp]
                for t in m.trees:
                    t.add_to(margin, grp, bins)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(np.exp(margin), mask=~known)], names=[*keep, out])

        return df.select(*keep).mapInArrow(run, T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.DoubleType())]))

    def group_codes(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        if self.group is None:
            return np.zeros(batch.num_rows, np.uint16), np.ones(batch.num_rows, bool)
        code = pc.index_in(pc.fill_null(batch.column(self.group).cast(pa.string()), _NULL), value_set=pa.array(self.groups, pa.string()))
        code = pc.fill_null(code, -1).to_numpy(zero_copy_only=False)
        return np.maximum(code, 0).astype(np.uint16), code >= 0

    def save(self, spark: SparkSession, path: str) -> None:
        """One row for the settings and one for each round."""
        meta = {"numeric": self.binner.numeric, "categorical": self.binner.categorical, "groups": self.groups, "group": self.group,
                "base": self.base, "best_round": self.best_round}
        rows = [(-1, json.dumps(meta)), *((i, t.to_json()) for i, t in enumerate(self.trees))]
        spark.createDataFrame(rows, "round int, content string").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> HistModel:
        rows = sorted(map(tuple, spark.read.parquet(path).collect()))
        d = json.loads(rows[0][1])
        return cls(Binner(d["numeric"], d["categorical"]), d["groups"], d["group"], d["base"], [Tree.from_json(x) for _, x in rows[1:]], d["best_round"])


# ---------------------------------------------------------------- passes

def gradients(y: np.ndarray, margin: np.ndarray, power: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the Poisson / Tweedie deviance."""
    a, b = np.exp((1.0 - power) * margin), np.exp((2.0 - power) * margin)
    return -y * a + b, -y * (1.0 - power) * a + (2.0 - power) * b


def _scales(n: int, largest: float) -> float:
    """Integers per unit of gradient: sums of n rows stay below 2**62, those of
    a block below 2**53."""
    bits = min(24, 36 - math.ceil(math.log2(largest + 2)), 60 - math.ceil(math.log2(n + 1)) - math.ceil(math.log2(largest + 2)))
    return 2.0 ** bits


def quantised(y: np.ndarray, margin: np.ndarray, power: float, scale: float) -> tuple[np.ndarray, np.ndarray]:
    bound = 2.0 ** 36
    return tuple(np.clip(np.rint(x * scale), -bound, bound) for x in gradients(y, margin, power))


def _loaded(table: DataFrame, binner: Binner) -> RDD:
    """(block, group codes, labels, bins, validation flags, margins, errors) of
    each block in ``PART_ROWS`` rows a partition, but in no more partitions than
    the cluster works on in two turns: a task adds up the sums of all its blocks."""
    n_features, kind = len(binner.features), np.uint16 if binner.n_bins > 256 else np.uint8

    def arrays(r) -> tuple:
        grp, y, bins, valid, margin = (np.frombuffer(r[c], t) for c, t in (("grp", np.uint16), ("y", np.float64), ("bins", kind), ("valid", bool), ("margin", np.float64)))
        return r["block"], grp, y, bins.reshape(n_features, -1), valid, margin, []

    rows = (table.agg(F.sum(F.octet_length("valid"))).first()[0] or 0)
    return table.rdd.map(arrays).coalesce(max(1, min(_width(table.sparkSession), -(-rows // PART_ROWS))))


def _width(spark: SparkSession) -> int:
    return 2 * spark.sparkContext.defaultParallelism


def _blocks(rows: DataFrame, model: HistModel, label: str, flag: str) -> DataFrame:
    """``rows`` (features, group, label, flag: true in validation rows) as blocks."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, count, m = TaskContext.get().partitionId(), 0, shared.value
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            nonlocal count
            grp, y, valid = (np.concatenate([h[k] for h in held]) for k in (0, 1, 2))
            bins = np.concatenate([h[3] for h in held], 1)
            held.clear()
            count += 1
            values = [grp, y, bins, valid, np.array(m.base)[grp]]
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + count], pa.int64()), *(pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in values)],
                names=["block", "grp", "y", "bins", "valid", "margin"])

        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(first, BLOCK_ROWS)
                grp, known = m.group_codes(piece)
                y = piece.column(label).cast(pa.float64()).to_numpy(zero_copy_only=False)
                valid = pc.fill_null(piece.column(flag), False).to_numpy(zero_copy_only=False).astype(bool)
                use = known & ~np.isnan(y)
                held.append((grp[use], y[use], valid[use], m.binner.bins(piece)[:, use]))
                if sum(len(h[0]) for h in held) >= BLOCK_ROWS:
                    yield flush()
        if held:
            yield flush()

    return rows.mapInArrow(run, _BLOCK)


@dataclass
class _Pass:
    """What a pass needs: shapes, objective and the sample of this round."""
    n_features: int
    n_bins: int
    power: float
    scale: float
    row_fraction: float
    seed: int
    round: int

    def chosen(self, block: int, valid: np.ndarray) -> np.ndarray:
        if self.row_fraction >= 1.0:
            return ~valid
        return ~valid & (np.random.default_rng([self.seed, self.round, block]).random(len(valid)) < self.row_fraction)


def _pack(at: np.ndarray, sums: np.ndarray) -> bytes:
    """Cells (ascending) and their [3, cell] sums: equal high bytes of
    neighbouring numbers stand together and take hardly any space."""
    import zstandard
    numbers = np.ascontiguousarray(np.concatenate([np.diff(at, prepend=0)[None], sums]), "<i8")
    numbers[1] = (numbers[1] << 1) ^ (numbers[1] >> 63)  # the sign in the lowest bit
    return zstandard.ZstdCompressor(level=1).compress(numbers.view(np.uint8).reshape(4, -1, 8).transpose(0, 2, 1).tobytes())


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, 8, -1)
    numbers = np.ascontiguousarray(raw.transpose(0, 2, 1)).view("<i8")[..., 0]
    g = numbers[1].view(np.uint64)
    return np.cumsum(numbers[0]), np.stack([(g >> np.uint64(1)).view(np.int64) ^ -(numbers[1] & 1), numbers[2], numbers[3]])


def _added(cells: int):
    """One packed total of each feature from the tasks' packed sums."""
    def add(items: Iterator[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        totals: dict[int, np.ndarray] = {}
        for f, packed in items:
            at, sums = _unpack(packed)
            totals.setdefault(f, np.zeros((3, cells), np.int64))[:, at] += sums
        for f, total in totals.items():
            at = np.flatnonzero(total[2])
            yield f, _pack(at, total[:, at])

    return add


def _sums(blocks: RDD, tree: Tree, slots: np.ndarray, p: _Pass) -> np.ndarray:
    """[slot, feature, bin, 3] sums of gradient, hessian and rows; ``slots``:
    each node's slot, or -1."""
    n_slots = int(slots.max()) + 1
    cells = n_slots * p.n_bins  # of a feature
    size, parts = p.n_features * cells, blocks.getNumPartitions()

    def run(items: Iterator[tuple]) -> Iterator[tuple[int, bytes]]:
        total = np.zeros((3, size), np.int64)
        for block, grp, y, bins, valid, margin, _ in items:
            node = tree.route(grp, bins)
            slot = np.where(node >= 0, slots[node], -1)
            use = np.flatnonzero((slot >= 0) & p.chosen(block, valid))
            if not len(use):
                continue
            g, h = quantised(y[use], margin[use], p.power, p.scale)
            start = slot[use].astype(np.int64) * p.n_bins
            own = np.empty((3, size))  # whole numbers below 2**53
            for f in range(p.n_features):
                cell = start + bins[f].take(use)
                part = slice(f * cells, (f + 1) * cells)
                own[0, part], own[1, part], own[2, part] = np.bincount(cell, g, cells), np.bincount(cell, h, cells), np.bincount(cell, minlength=cells)
            total += own.astype(np.int64)
        for f in range(p.n_features):
            part = total[:, f * cells:(f + 1) * cells]
            at = np.flatnonzero(part[2])
            if len(at):
                yield f, _pack(at, part[:, at])

    packed = blocks.mapPartitions(run)
    if parts > DIRECT_PARTITIONS:
        packed = packed.partitionBy(min(parts, p.n_features) or 1).mapPartitions(_added(cells))
    total = np.zeros((size, 3), np.int64)
    for f, data in packed.collect():
        at, sums = _unpack(data)  # a cell occurs once in a part
        total[f * cells + at] += sums.T
    return total.reshape(p.n_features, n_slots, p.n_bins, 3).swapaxes(0, 1)


def _advance(blocks: RDD, trees: list[Tree]) -> RDD:
    """Blocks with the trees' values added to the margins, and the squared
    errors (in 256ths) of the validation rows by group: (group, rows, sum)."""
    def run(items: Iterator[tuple]) -> Iterator[tuple]:
        for block, grp, y, bins, valid, margin, _ in items:
            margin = margin.copy()
            for t in trees:
                t.add_to(margin, grp, bins)
            errors = []
            if valid.any():
                e = np.rint((y[valid] - np.exp(margin[valid])) ** 2 * 256).astype(np.int64)
                for k in np.unique(grp[valid]).tolist():
                    mine = grp[valid] == k
                    errors.append((k, int(mine.sum()), int(e[mine].sum())))
            yield block, grp, y, bins, valid, margin, errors

    return blocks.mapPartitions(run)


def _errors(blocks: RDD) -> dict[int, tuple[int, int]]:
    """Validation rows and sum of squared errors (in 256ths) by group."""
    def add(items) -> dict[int, tuple[int, int]]:
        total: dict[int, tuple[int, int]] = {}
        for k, n, sse in items:
            m, e = total.get(k, (0, 0))
            total[k] = m + n, e + sse
        return total

    tasks = blocks.mapPartitions(lambda items: [(k, *v) for k, v in add(x for b in items for x in b[-1]).items()])
    return add(tasks.collect())  # a task sends a row for each group


# ---------------------------------------------------------------- growing

@dataclass
class _Node:
    group: int
    depth: int = 0
    sums: np.ndarray | None = None       # [feature, bin, 3] until its children have theirs
    total: tuple[float, float] = (0.0, 0.0)
    gain: float = 0.0
    feature: int = -1
    left: np.ndarray | None = None
    parts: list[tuple[float, float, int]] = field(default_factory=list)  # totals of the children
    children: list[int] = field(default_factory=list)
    known: bool = False


def best_splits(sums: np.ndarray, categorical: np.ndarray, columns: np.ndarray, p: HistParams, scale: float) -> list[tuple | None]:
    """(gain, feature, table of bins to the left, totals of both children) of
    each node's best split, or None. ``sums``: [node, feature, bin, 3]."""
    g, h, n = sums[..., 0] / scale, sums[..., 1] / scale, sums[..., 2]
    g_all, h_all, n_all = (x[:, 0].sum(1) for x in (g, h, n))
    rows = np.arange(len(sums))
    best_gain, found = np.full(len(sums), 1e-9), [None] * len(sums)

    def gains(gl: np.ndarray, hl: np.ndarray, nl: np.ndarray, l2: float) -> np.ndarray:
        tall = (slice(None),) + (None,) * (gl.ndim - 1)
        gr, hr, nr = g_all[tall] - gl, h_all[tall] - hl, n_all[tall] - nl
        ok = (nl >= p.min_instances) & (nr >= p.min_instances) & (hl >= p.min_hessian) & (hr >= p.min_hessian)
        score = lambda a, b, reg: a * a / np.maximum(b + reg, 1e-12)
        return np.where(ok, score(gl, hl, l2) + score(gr, hr, l2) - score(g_all, h_all, p.l2)[tall], -np.inf)

    def take(k: int, gain: float, f: int, left: np.ndarray) -> None:
        own = [float(x[k, f, left].sum()) for x in (g, h, n)]
        rest = [float(x[k] - o) for x, o in zip((g_all, h_all, n_all), own)]
        found[k] = gain, f, left, [(own[0], own[1], int(own[2])), (rest[0], rest[1], int(rest[2]))]

    numeric = [f for f in columns.tolist() if not categorical[f]]
    if numeric:
        parts = []
        for x in (g, h, n):
            x = x[:, numeric]
            below = np.cumsum(x[:, :, 1:], axis=2)
            parts.append(np.stack([below, below + x[:, :, :1]], 2))  # [node, feature, missing to the left, edge]
        gain = gains(*parts, p.l2).reshape(len(sums), -1)
        at = gain.argmax(1)
        n_edges = sums.shape[2] - 1
        for k in np.flatnonzero(gain[rows, at] > best_gain).tolist():
            f, missing, edge = at[k] // (2 * n_edges), at[k] // n_edges % 2, at[k] % n_edges
            left = np.zeros(sums.shape[2], bool)
            left[1:edge + 2], left[0] = True, bool(missing)
            best_gain[k] = gain[k, at[k]]
            take(k, float(gain[k, at[k]]), numeric[f], left)
    for f in columns.tolist():
        if not categorical[f]:
            continue
        order = np.argsort(np.where(n[:, f] > 0, g[:, f] / (h[:, f] + p.cat_smooth), np.inf), axis=1, kind="stable")
        gain = gains(*(np.cumsum(np.take_along_axis(x[:, f], order, 1), axis=1) for x in (g, h, n)), p.l2 + p.cat_l2)
        at = gain.argmax(1)
        for k in np.flatnonzero(gain[rows, at] > best_gain).tolist():
            left = np.zeros(sums.shape[2], bool)
            left[order[k, :at[k] + 1]] = True
            best_gain[k] = gain[k, at[k]]
            take(k, float(gain[k, at[k]]), f, left)
    return found


class _Grower:
    def __init__(self, active: list[int], n_groups: int, n_bins: int, categorical: np.ndarray, params: HistParams, pas: _Pass):
        self.nodes = [_Node(k) for k in active]
        self.roots = np.full(n_groups, -1, np.int32)
        self.roots[active] = np.arange(len(active))
        self.n_bins, self.categorical, self.params, self.pas = n_bins, categorical, params, pas
        rng = np.random.default_rng([params.seed, pas.round, 1 << 40])
        n_columns = max(1, round(params.col_fraction * pas.n_features))
        self.columns = np.sort(rng.permutation(pas.n_features)[:n_columns])

    def tree(self, splits: set[int]) -> Tree:
        """A tree that splits the given nodes."""
        n, lr = len(self.nodes), self.params.learning_rate
        out = Tree(self.roots, np.full(n, -1, np.int32), np.zeros((n, self.n_bins), bool), np.full((n, 2), -1, np.int32), np.zeros(n))
        for i, node in enumerate(self.nodes):
            if i in splits:
                out.feature[i], out.left[i], out.children[i] = node.feature, node.left, node.children
            elif node.total[1] > 0:
                out.value[i] = -lr * node.total[0] / (node.total[1] + self.params.l2)
        return out

    def replay(self) -> tuple[set[int], list[int]]:
        """Best leaf first, with what is known: (nodes split, split nodes whose
        children are needed next)."""
        split: set[int] = set()
        wanted: list[int] = []
        for root in self.roots[self.roots >= 0].tolist():
            heap = [(-self.nodes[root].gain, root)] if self.nodes[root].gain > 0 else []
            leaves = 1
            while heap and leaves < self.params.num_leaves:
                _, i = heapq.heappop(heap)
                node = self.nodes[i]
                if not node.children:
                    node.children = [len(self.nodes), len(self.nodes) + 1]
                    self.nodes += [_Node(node.group, node.depth + 1, total=t[:2]) for t in node.parts]
                split.add(i)
                leaves += 1
                for c in node.children:
                    if self.nodes[c].known and self.nodes[c].gain > 0:
                        heapq.heappush(heap, (-self.nodes[c].gain, c))
                deepest = self.params.max_depth is not None and node.depth + 1 >= self.params.max_depth
                if not self.nodes[node.children[0]].known and not deepest and leaves < self.params.num_leaves:
                    wanted.append(i)
        return split, wanted

    def learn(self, numbers: list[int], sums: np.ndarray) -> None:
        scale = self.pas.scale
        for i, s, found in zip(numbers, sums, best_splits(sums, self.categorical, self.columns, self.params, scale)):
            node = self.nodes[i]
            node.known, node.sums = True, s
            node.total = float(s[0, :, 0].sum() / scale), float(s[0, :, 1].sum() / scale)
            if found:
                node.gain, node.feature, node.left, node.parts = found

    def grow(self, blocks: RDD) -> tuple[Tree, int]:
        """The round's tree and the number of passes."""
        passes = 1
        roots = list(range(len(self.nodes)))
        self.learn(roots, _sums(blocks, self.tree(set()), np.arange(len(roots)), self.pas))
        while True:
            split, wanted = self.replay()
            if not wanted:
                return self.compact(split), passes
            smaller = [self.nodes[i].children[int(self.nodes[i].parts[1][2] < self.nodes[i].parts[0][2])] for i in wanted]
            larger = [sum(self.nodes[i].children) - c for i, c in zip(wanted, smaller)]
            slots = np.full(len(self.nodes), -1, np.int64)
            slots[smaller] = np.arange(len(smaller))
            expanded = {i for i, node in enumerate(self.nodes) if node.children}
            found = _sums(blocks, self.tree(expanded), slots, self.pas)
            passes += 1
            rest = np.stack([self.nodes[i].sums for i in wanted]) - found
            self.learn([*smaller, *larger], np.concatenate([found, rest]))
            for i in wanted:
                self.nodes[i].sums = None

    def compact(self, split: set[int]) -> Tree:
        """The tree with only the nodes that can be reached, in a fixed order."""
        order: list[int] = []
        for root in self.roots[self.roots >= 0].tolist():
            todo = [root]
            while todo:
                i = todo.pop(0)
                order.append(i)
                if i in split:
                    todo += self.nodes[i].children
        t, place = self.tree(split), {i: k for k, i in enumerate(order)}
        roots = np.array([place[r] if r >= 0 else -1 for r in self.roots.tolist()], np.int32)
        children = np.array([[place.get(c, -1) for c in t.children[i].tolist()] for i in order], np.int32).reshape(-1, 2)
        return Tree(roots, t.feature[order], t.left[order], children, t.value[order])


# ---------------------------------------------------------------- state

class _State:
    """Settings, blocks and one small file a round under a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _file(self, name: str):
        p = self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p, p.getFileSystem(self.conf)

    def has(self, name: str) -> bool:
        p, fs = self._file(name)
        return fs.exists(p)

    def put(self, name: str, text: str) -> None:
        """Written beside and renamed, so that a file is whole or missing."""
        (tmp, fs), (final, _) = self._file(f"_{name}.tmp"), self._file(name)
        out = fs.create(tmp, True)
        out.write(bytearray(text.encode()))
        out.close()
        fs.delete(final, False)
        fs.rename(tmp, final)

    def rounds(self) -> list[dict]:
        found = self.spark.read.text(f"{self.path}/round-*", wholetext=True).collect() if self.has("round-00000") else []
        rounds = {d["round"]: d for d in (json.loads(r[0]) for r in found)}
        return [rounds[i] for i in range(len(rounds)) if i in rounds]

    def get(self, name: str) -> str:
        return self.spark.read.text(f"{self.path}/{name}", wholetext=True).first()[0]


# ---------------------------------------------------------------- fit

@dataclass
class HistResult:
    model: HistModel
    history: list[dict]
    state: str


def _settings(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, params: HistParams, group: str | None) -> dict:
    """Bins, groups with their margins before the first tree, and the scale."""
    y = F.col(label).cast("double")
    by = F.coalesce(F.col(group).cast("string"), F.lit(_NULL)) if group else F.lit("")
    stats = train.where(y.isNotNull()).groupBy(by.alias("g")).agg(F.avg(y).alias("mean"), F.count(y).alias("n"), F.max(y).alias("top")).orderBy("g").limit(MAX_GROUPS + 1).collect()
    if len(stats) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups in one fit: fit them in turns")
    binner = fit_bins(train, numeric, categorical, params)
    return {"numeric": binner.numeric, "categorical": binner.categorical, "groups": [r["g"] for r in stats] if group else None,
            "base": [math.log(max(r["mean"], 1e-9)) for r in stats] or [0.0],
            "scale": _scales(sum(r["n"] for r in stats), max([r["top"] for r in stats], default=0.0))}


def category_histogram(train: DataFrame, column: str, label: str, params: HistParams, group: str | None = None) -> DataFrame:
    """What the first round's first pass knows of a categorical column: grp,
    value, n and the sums g and h of both derivatives, by group and category
    (at most groups x (``max_categories`` + 1) rows; a null value stands for
    the rest)."""
    spark = train.sparkSession
    meta = _settings(train, [], [column], label, params, group)
    model = HistModel(Binner({}, meta["categorical"]), meta["groups"], group, meta["base"], [])
    rows = train.select(*dict.fromkeys([column, *([group] if group else [])]), F.col(label).cast("double").alias("__y"), F.lit(False).alias("__valid"))
    blocks, path = stage_table(_blocks(rows, model, "__y", "__valid"), "category-histogram")
    n = len(model.base)
    pas = _Pass(1, model.binner.n_bins, params.power, meta["scale"], 1.0, params.seed, 0)
    roots = _Grower(list(range(n)), n, model.binner.n_bins, model.binner.is_categorical, params, pas).tree(set())
    sums = _sums(_loaded(blocks, model.binner), roots, np.arange(n), pas)[:, 0]
    drop_path(spark, path)
    values = [None, *(None if v == _NULL else v for v in model.binner.categorical[column])]
    out = [(model.groups[k] if group else None, values[j], int(sums[k, j, 2]), float(sums[k, j, 0] / meta["scale"]), float(sums[k, j, 1] / meta["scale"]))
           for k in range(n) for j in range(len(values)) if sums[k, j, 2]]
    return spark.createDataFrame(out, "grp string, value string, n long, g double, h double")


def fit(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, params: HistParams,
        valid: DataFrame | None = None, group: str | None = None, state: str | None = None) -> HistResult:
    """Boosts on ``train``; rows without a label are left out.

    ``valid`` gives each round's RMSE per group and, with
    ``early_stopping_rounds``, ends a group's training after so many rounds
    without gain; its trees after the best round are dropped. ``state`` is a
    folder on shared storage: called again with the same settings, ``fit`` goes
    on after the last round that is stored there. Without one a folder under
    the checkpoint folder is used and dropped at the end."""
    spark = train.sparkSession
    own = state is None
    st = _State(spark, state or scratch_path(spark, "boosting"))
    columns = list(dict.fromkeys([*numeric, *categorical, *([group] if group else [])]))
    y = F.col(label).cast("double")
    if st.has("settings"):
        meta = json.loads(st.get("settings"))
    else:
        meta = _settings(train, numeric, categorical, label, params, group)
        st.put("settings", json.dumps(meta))
    model = HistModel(Binner(meta["numeric"], meta["categorical"]), meta["groups"], group, meta["base"], [])
    if not st.has("blocks/_SUCCESS"):
        rows = train.select(*columns, y.alias("__y"), F.lit(False).alias("__valid"))
        if valid is not None:
            rows = rows.unionByName(valid.select(*columns, y.alias("__y"), F.lit(True).alias("__valid")))
        if rows.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
            rows = rows.repartition(spark.sparkContext.defaultParallelism)
        _blocks(rows, model, "__y", "__valid").write.mode("overwrite").parquet(f"{st.path}/blocks")
    held = lambda blocks: blocks.persist(StorageLevel.MEMORY_AND_DISK)
    blocks = held(_loaded(spark.read.parquet(f"{st.path}/blocks"), model.binner))
    n_groups, n_bins = len(model.base), model.binner.n_bins
    history, staged = [], None
    for d in st.rounds()[:params.rounds]:
        model.trees.append(Tree.from_json(d.pop("tree")))
        history.append(d)
    stop = _Stopping(n_groups, params.early_stopping_rounds)
    for d in history:
        stop.see(d["round"], d.get("valid_rmse"))
    pas = lambda r: _Pass(len(model.binner.features), n_bins, params.power, meta["scale"], params.row_fraction, params.seed, r)
    if model.trees:  # the stored trees in one pass
        blocks, old = held(_advance(blocks, model.trees)), blocks
        blocks.count()
        old.unpersist()
    spent = None  # the margins before, until something has read the new ones
    import time
    for r in range(len(model.trees), params.rounds):
        active = stop.active()
        if not active:
            break
        began = time.time()
        tree, passes = _Grower(active, n_groups, n_bins, model.binner.is_categorical, params, pas(r)).grow(blocks)
        if spent is not None:
            spent.unpersist()
        after, spent, dropped = _advance(blocks, [tree]), blocks, None
        if (r + 1) % params.stage_every == 0:
            dropped, staged = staged, scratch_path(spark, "boosting-margins")
            after.saveAsPickleFile(staged)
            after = spark.sparkContext.pickleFile(staged).coalesce(blocks.getNumPartitions())
        blocks = held(after)
        if valid is not None:
            errors = _errors(blocks)
        if dropped:
            blocks.count()
            drop_path(spark, dropped)
        model.trees.append(tree)
        rec = {"round": r, "sec": round(time.time() - began, 3), "passes": passes, "leaves": int((tree.feature < 0).sum())}
        if valid is not None:
            rmse = {k: math.sqrt(sse / 256 / n) for k, (n, sse) in errors.items()}
            rec["valid_rmse"] = [rmse.get(k) for k in range(n_groups)]
        history.append(rec)
        st.put(f"round-{r:05d}", json.dumps({**rec, "tree": tree.to_json()}))
        stop.see(r, rec.get("valid_rmse"))
    if spent is not None:
        spent.unpersist()
    blocks.unpersist()
    for path in [staged] if staged else []:
        drop_path(spark, path)
    if own:
        drop_path(spark, st.path)
    if params.early_stopping_rounds and valid is not None:
        model.best_round = [b + 1 for b in stop.best_round]
        for r, t in enumerate(model.trees):
            t.roots = np.where(r < np.array(model.best_round), t.roots, -1).astype(np.int32)
        model.trees = model.trees[:max(model.best_round, default=0)]
    return HistResult(model, history, st.path)


class _Stopping:
    """Best round so far of every group, and which groups go on."""

    def __init__(self, n_groups: int, patience: int | None):
        self.patience = patience
        self.best, self.best_round, self.last = [math.inf] * n_groups, [-1] * n_groups, -1

    def see(self, r: int, rmse: list[float | None] | None) -> None:
        for k in self.active():
            if rmse is None or rmse[k] is None:
                self.best_round[k] = r  # nothing to stop by
            elif rmse[k] < self.best[k] - 1e-12:
                self.best[k], self.best_round[k] = rmse[k], r
        self.last = r

    def active(self) -> list[int]:
        return [k for k, b in enumerate(self.best_round) if not self.patience or self.last - b < self.patience]
