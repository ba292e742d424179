"""Gradient boosting of many learners in lock step.

Features are binned once. The rows lie in blocks (partitions); a block keeps
the current prediction of every learner for its rows. All learners (search
trials, folds, lower and upper quantiles) grow together: one Spark aggregation per tree level adds up,
per block, the gradients and rows of each (learner, open node, feature, bin) and
picks each node's best split from the sums. The driver gets one split per open node and
sends the trees as they stand with the next level. A search of 50 trials thus takes
as many passes as its longest trial has levels.

Where one block holds all rows, its sums are the sums: a task then takes its
group of learners through ``CHECKPOINT_ROUNDS`` rounds by the same steps before the next
pass, and Spark spreads the groups of learners instead of the rows. Both ways give the same trees.

* Levels grow to ``depth``. With ``leaves`` given, splits are then taken best
  gain first until the tree has that many leaves; a node's gain does not depend
  on the order, so this is leaf-first growth.
* Squared loss fits residuals. The ``quantile`` loss fits the pinball gradient
  and sets each leaf to the quantile of its residuals, from mergeable
  summaries (exact up to ``SUMMARY`` rows of a leaf in a block).
* Rows and features of a tree are drawn by hashes of (row, seed, round) and (seed, round): no
  draw depends on how rows are partitioned. Gradients are summed as whole numbers of a fixed
  unit, so sums do not depend on the order of additions either, and a seed gives the same trees each time.
* The validation error of every round is summed with the first level of the next
  one; a learner with ``patience`` stops after so many rounds without a new minimum
  and keeps the trees up to it.

Blocks are checkpointed every ``CHECKPOINT_ROUNDS`` rounds, so a lost
executor costs at most that many rounds of its blocks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.ml.forest import Forest
from panelcast.session import checkpoint_dir, ship_package, stored

MAX_BINS = 32
#: rows of a block; a block is one partition of every pass
BLOCK_ROWS = 100_000
CHECKPOINT_ROUNDS = 50
#: groups of learners per core and block: trials differ in length
GROUPS_PER_CORE = 4
#: residuals kept per leaf and block by a quantile summary
SUMMARY = 512
#: sums of whole numbers up to this are exact in doubles
EXACT = float(1 << 51)
_U64 = np.uint64


@dataclass(frozen=True)
class Setting:
    """What one learner is to grow; rows with stage <= ``train_to`` train it,
    those up to ``val_to`` validate it."""

    rounds: int = 100
    step: float = 0.1
    depth: int = 6
    leaves: int | None = None
    least_rows: int = 1
    row_share: float = 1.0
    feature_share: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    quantile: float | None = None
    patience: int | None = None
    seed: int = 42
    train_to: int = 0
    val_to: int = 1


@dataclass
class Grown:
    """A finished learner: its forest, validation error per round (from no tree on) and best round."""

    forest: Forest
    val_rmse: list[float]
    best_round: int


# -- binned rows --------------------------------------------------------------


def bin_cuts(rows: DataFrame, cols: Sequence[str], bins: int = MAX_BINS) -> list[list[float]]:
    """Upper ends of the bins of each feature: quantiles of the rows, in one aggregate."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(f"q{j}")
                       for j, c in enumerate(cols)]).first()
    return [sorted({float(v) for v in (q or []) if v is not None}) for q in found]


@dataclass
class Block:
    """Some rows, binned, and the predictions of a group of learners for them."""

    group: int
    x: np.ndarray        # rows x features, bins
    y: np.ndarray
    stage: np.ndarray
    key: np.ndarray      # hash of the row, for draws
    score: np.ndarray    # learners of the group x rows


def _blocks(rows: DataFrame, cols: Sequence[str], target: str, stage: str, cuts: list[list[float]],
            groups: list[list[int]], init: list[float], parts: int):
    """The rows as an RDD of blocks, one per partition and group of learners."""
    n = len(cols)

    def pack(batches):
        held = [b for b in batches if len(b)]
        if not held:
            return
        table = pa.Table.from_batches(held)
        x = np.empty((len(table), n), np.uint8)
        for j in range(n):
            x[:, j] = np.searchsorted(cuts[j], table.column(j).to_numpy().astype(float), "left")
        y, s, k = (table.column(n + i).to_numpy() for i in range(3))
        yield pa.RecordBatch.from_pydict({
            "block": [TaskContext.get().partitionId()], "n": [len(y)], "x": [x.tobytes()], "y": [y.astype(float).tobytes()],
            "stage": [s.astype(np.int64).tobytes()], "key": [k.astype(np.int64).tobytes()]})

    numbers = [F.col(c).cast("double").alias(f"f{j}") for j, c in enumerate(cols)]
    wanted = rows.select(*numbers, F.col(target).cast("double").alias("y"), F.col(stage).cast("long").alias("s"))
    wanted = wanted.withColumn("k", F.xxhash64(*wanted.columns))
    packed = stored(wanted.repartition(parts).mapInArrow(
        pack, "block long, n long, x binary, y binary, stage binary, key binary"), "boosting-blocks")

    def unpack(row):
        x = np.frombuffer(row["x"], np.uint8).reshape(row["n"], n)
        y, s, k = (np.frombuffer(row[c], t) for c, t in (("y", float), ("stage", np.int64), ("key", np.uint64)))
        for g, members in enumerate(groups):
            score = np.repeat(np.array([init[t] for t in members], float)[:, None], len(y), axis=1)
            yield row["block"] * len(groups) + g, Block(g, x, y, s, k, score)

    return packed.rdd.flatMap(unpack).partitionBy(parts * len(groups), int).values()


# -- work of a task -----------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers (splitmix64)."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def _drawn(block: Block, s: Setting, number: int) -> np.ndarray:
    """Rows that train the learner's tree of round ``number``."""
    train = block.stage <= s.train_to
    if s.row_share >= 1.0:
        return train
    salt = _U64((s.seed * 0x9E3779B97F4A7C15 + number * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
    return train & ((_mix(block.key ^ salt) >> _U64(11)).astype(float) * 2.0**-53 < s.row_share)


def _walk(x: np.ndarray, tree: tuple[np.ndarray, np.ndarray, np.ndarray], levels: int) -> np.ndarray:
    """Node of each row in a (partly grown) tree given as feature, last bin to the left and left child."""
    feature, cut, left = tree
    node = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    for _ in range(levels):
        child = left[node]
        node = np.where(child >= 0, child + (x[rows, feature[node]] > cut[node]), node)
    return node


def _gradient(block: Block, t: int, s: Setting, reach: float) -> np.ndarray:
    """Negative gradient of the loss per row; squared loss within four times the target's range."""
    rest = block.y - block.score[t]
    if s.quantile is None:
        return np.clip(rest, -reach, reach)
    return np.where(rest >= 0, s.quantile, s.quantile - 1.0)


@dataclass
class _Task:
    """What a level pass asks of one learner."""

    at: int                  # place in its group
    setting: Setting
    number: int              # round
    tree: tuple              # as it stands
    level: int
    slots: np.ndarray        # node -> open slot or -1
    n_slots: int
    features: np.ndarray     # which features the tree may use
    unit: float              # gradients are summed in 1 / unit
    reach: float


def _sums(block: Block, task: _Task, bins: int) -> np.ndarray:
    """Gradients and rows per (open node, feature, bin)."""
    rows = np.flatnonzero(_drawn(block, task.setting, task.number))
    x = block.x[rows]
    slot = task.slots[_walk(x, task.tree, task.level)]
    keep = slot >= 0
    if not keep.all():
        rows, x, slot = rows[keep], x[keep], slot[keep]
    g = np.rint(_gradient(block, task.at, task.setting, task.reach)[rows] * task.unit)
    d = x.shape[1]
    cell = ((slot[:, None] * d + np.arange(d)) * bins + x).ravel()
    size = task.n_slots * d * bins
    return np.stack([np.bincount(cell, np.repeat(g, d), size), np.bincount(cell, minlength=size)]).reshape(
        2, task.n_slots, d, bins)


def _part(g: np.ndarray, n: np.ndarray, s: Setting) -> np.ndarray:
    """Loss that a node takes away with the best value for it."""
    if s.l1:
        g = np.sign(g) * np.maximum(np.abs(g) - s.l1, 0.0)
    return g * g / np.maximum(n + s.l2, 1e-12)


def _best(sums: np.ndarray, task: _Task) -> tuple[np.ndarray, ...]:
    """Best split of each open node: gain (negative: none), feature, last bin to the left, and the
    gradient and rows of the node and of its left side."""
    s = task.setting
    g, n = np.cumsum(sums[0] / task.unit, axis=2), np.cumsum(sums[1], axis=2)
    all_g, all_n = g[:, :1, -1:], n[:, :1, -1:]
    gl, nl = g[:, :, :-1], n[:, :, :-1]
    gain = _part(gl, nl, s) + _part(all_g - gl, all_n - nl, s) - _part(all_g, all_n, s)
    ok = (nl >= max(1, s.least_rows)) & (all_n - nl >= max(1, s.least_rows)) & task.features[None, :, None]
    gain = np.where(ok, gain, -1.0).reshape(len(g), -1)
    pick = gain.argmax(axis=1)
    at = np.arange(len(g))
    return (gain[at, pick], pick // gl.shape[2], pick % gl.shape[2], all_g[:, 0, 0], all_n[:, 0, 0],
            gl.reshape(len(g), -1)[at, pick], nl.reshape(len(g), -1)[at, pick])


def _errors(block: Block, t: int, s: Setting, unit: float) -> np.ndarray:
    val = (block.stage > s.train_to) & (block.stage <= s.val_to)
    rest = block.y[val] - block.score[t][val]
    if s.quantile is not None:
        rest = np.sqrt(np.maximum(s.quantile * rest, (s.quantile - 1.0) * rest))
    return np.array([np.rint(np.minimum(rest * rest * unit, EXACT / 2)).sum(), float(val.sum())])


def _squeeze(values: np.ndarray, weights: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A summary of at most ``size`` weighted values, ascending."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    if len(values) <= size:
        return values, weights
    total = weights.sum()
    at = np.searchsorted(np.cumsum(weights), (np.arange(size) + 0.5) * total / size)
    return values[np.minimum(at, len(values) - 1)], np.full(size, total / size)


def _merged(a: tuple, b: tuple) -> tuple:
    return _squeeze(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), 4 * SUMMARY)


def summary_quantile(summary: tuple[np.ndarray, np.ndarray], share: float) -> float:
    """The first value at which the weights reach ``share`` of their sum."""
    values, weights = summary
    total = np.cumsum(weights)
    return float(values[min(len(values) - 1, int(np.searchsorted(total, share * total[-1] * (1 - 1e-12))))])


def _leaf_summaries(block: Block, task: _Task):
    rows = np.flatnonzero(_drawn(block, task.setting, task.number))
    leaf = _walk(block.x[rows], task.tree, task.level)
    rest = (block.y - block.score[task.at])[rows]
    for node in np.unique(leaf).tolist():
        mine = rest[leaf == node]
        yield node, _squeeze(mine, np.ones(len(mine)), SUMMARY)


# -- trees on the driver ------------------------------------------------------


@dataclass
class _Tree:
    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [0.0])
    grad: list[float] = field(default_factory=lambda: [0.0])
    rows: list[float] = field(default_factory=lambda: [0.0])
    open: list[int] = field(default_factory=lambda: [0])

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature), np.array(self.cut), np.array(self.left)

    def split(self, found: tuple, s: Setting, last: bool) -> None:
        """Take the best splits of the open nodes; the new nodes are open."""
        nodes, self.open = self.open, []
        for node, gain, f, cut, g, n, gl, nl in zip(nodes, *(v.tolist() for v in found), strict=True):
            if node == 0:
                self.grad[0], self.rows[0] = g, n
            if gain <= 1e-12:
                continue
            child = len(self.left)
            self.feature[node], self.cut[node], self.left[node], self.gain[node] = f, cut, child, gain
            for grad, rows in ((gl, nl), (g - gl, n - nl)):
                if not last and rows >= 2 * max(1, s.least_rows):
                    self.open.append(len(self.left))
                for column, value in ((self.feature, 0), (self.cut, 0), (self.left, -1), (self.gain, 0.0),
                                      (self.grad, grad), (self.rows, rows)):
                    column.append(value)

    def best_first(self, leaves: int) -> _Tree:
        """The tree that taking the best gain first gives with so many leaves."""
        import heapq

        queue = [(-self.gain[0], 0)] if self.left[0] >= 0 else []
        taken: set[int] = set()
        while queue and len(taken) + 1 < leaves:
            _, node = heapq.heappop(queue)
            taken.add(node)
            for child in (self.left[node], self.left[node] + 1):
                if self.left[child] >= 0:
                    heapq.heappush(queue, (-self.gain[child], child))
        out = _Tree([], [], [], [], [], [], [])
        number, order = {0: 0}, [0]
        for node in order:  # breadth first: children of a node are neighbours
            inner = node in taken
            for a, b, other in ((out.feature, self.feature, 0), (out.cut, self.cut, 0), (out.gain, self.gain, 0.0)):
                a.append(b[node] if inner else other)
            out.grad.append(self.grad[node])
            out.rows.append(self.rows[node])
            out.left.append(len(order) if inner else -1)
            if inner:
                for child in (self.left[node], self.left[node] + 1):
                    number[child] = len(order)
                    order.append(child)
        return out

    def values(self, s: Setting) -> np.ndarray:
        g, n = np.array(self.grad), np.array(self.rows)
        if s.l1:
            g = np.sign(g) * np.maximum(np.abs(g) - s.l1, 0.0)
        return s.step * g / np.maximum(n + s.l2, 1e-12)

    def depth(self) -> int:
        level = [0] * len(self.left)
        for node, child in enumerate(self.left):
            if child >= 0:
                level[child] = level[child + 1] = level[node] + 1
        return max(level)


# -- learners -----------------------------------------------------------------


@dataclass
class _Learner:
    """One learner between passes: its settings, finished trees, and the tree that is growing."""

    number: int                # among all learners
    at: int                    # place in its group
    setting: Setting
    init: float
    reach: float
    unit: float                # gradients are summed in 1 / unit
    error_unit: float
    width: int                 # features
    trees: list = field(default_factory=list)
    history: list[float] = field(default_factory=list)
    best: int = 0
    done: bool = False         # no tree and no error is to come
    tree: _Tree | None = None
    level: int = 0
    features: np.ndarray | None = None

    def judge(self, errors: np.ndarray) -> None:
        """Take the validation error of the trees so far, and stop if it is time to."""
        total, n = float(errors[0]), float(errors[1])
        now = len(self.trees)
        self.history.append(math.sqrt(total / self.error_unit / n) if n else math.nan)
        if n == 0 or self.history[now] < self.history[self.best]:
            self.best = now
        patience = self.setting.patience
        self.done = now >= self.setting.rounds or (patience is not None and now - self.best >= patience)

    def begin(self) -> None:
        """Start the next tree on the features drawn for it."""
        s = self.setting
        self.tree, self.level, self.features = _Tree(), 0, np.ones(self.width, bool)
        if s.feature_share < 1.0:
            order = np.random.default_rng([s.seed, len(self.trees)]).permutation(self.width)
            self.features[order[max(1, math.ceil(s.feature_share * self.width)) :]] = False

    def ask(self) -> _Task | None:
        """The sums that the next level needs; None if the tree is grown."""
        if not self.tree.open or self.level >= self.setting.depth:
            return None
        slots = np.full(len(self.tree.left), -1)
        slots[self.tree.open] = np.arange(len(self.tree.open))
        return _Task(self.at, self.setting, len(self.trees), self.tree.arrays(), self.level, slots,
                     len(self.tree.open), self.features, self.unit, self.reach)

    def take(self, found: tuple) -> None:
        """Split the open nodes."""
        self.level += 1
        self.tree.split(found, self.setting, self.level == self.setting.depth)

    def prune(self) -> None:
        if self.setting.leaves is not None:
            self.tree = self.tree.best_first(self.setting.leaves)

    def ask_leaves(self) -> _Task:
        return _Task(self.at, self.setting, len(self.trees), self.tree.arrays(), self.tree.depth(), np.zeros(0), 0,
                     self.features, self.unit, self.reach)

    def finish(self, quantiles: dict[int, float] | None) -> tuple:
        """Store the tree; returns what adds it to the predictions of a block."""
        values = self.tree.values(self.setting)
        for node, value in (quantiles or {}).items():
            values[node] = self.setting.step * value
        self.trees.append((self.tree, values))
        update = (self.at, self.tree.arrays(), self.tree.depth(), values)
        self.tree = None
        return update


def _apply(block: Block, updates: list[tuple]) -> Block:
    score = block.score.copy()
    for at, tree, depth, values in updates:
        score[at] += values[_walk(block.x, tree, depth)]
    return Block(block.group, block.x, block.y, block.stage, block.key, score)


def _rounds(block: Block, learners: list[_Learner], bins: int) -> tuple[Block, list[_Learner]]:
    """Some rounds of a group of learners where the block holds all rows."""
    for _ in range(CHECKPOINT_ROUNDS):
        updates = []
        for learner in learners:
            if learner.done:
                continue
            learner.judge(_errors(block, learner.at, learner.setting, learner.error_unit))
            if learner.done:
                continue
            learner.begin()
            while (task := learner.ask()) is not None:
                learner.take(_best(_sums(block, task, bins), task))
            learner.prune()
            share, values = learner.setting.quantile, None
            if share is not None:
                values = {n: summary_quantile(s, share) for n, s in _leaf_summaries(block, learner.ask_leaves())}
            updates.append(learner.finish(values))
        if not updates:
            break
        block = _apply(block, updates)
    return block, learners


# -- all learners -------------------------------------------------------------


def grow(rows: DataFrame, cols: Sequence[str], settings: Sequence[Setting], target: str = "target",
         stage: str = "stage", bins: int = MAX_BINS) -> list[Grown]:
    """All learners, grown in lock step. ``rows`` has the features (not null), the target and ``stage``.

    Bins are cut from the rows that train any of the learners. A learner without training rows
    raises ``ValueError``; without validation rows its errors are NaN and it is not stopped.
    """
    spark = rows.sparkSession
    ship_package(spark)
    checkpoint_dir(spark)
    cores = spark.sparkContext.defaultParallelism
    rows = stored(rows.select(*cols, target, stage), "boosting-rows")
    train_to = max(s.train_to for s in settings)
    cuts = bin_cuts(rows.where(F.col(stage) <= train_to), cols, bins)
    width = max(2, max((len(c) for c in cuts), default=0) + 1)
    init, reach, count = _starts(rows, settings, target, stage)
    parts = max(1, -(-count // BLOCK_ROWS))
    n_groups = max(1, min(len(settings), -(-GROUPS_PER_CORE * cores // parts) if parts < cores else 1))
    groups = [list(range(g, len(settings), n_groups)) for g in range(n_groups)]
    learners = [_Learner(
        t, t // n_groups, s, init[t], reach[t],
        2.0 ** math.floor(math.log2(EXACT / (max(1, count) * (1.0 if s.quantile is not None else reach[t])))),
        2.0 ** math.floor(math.log2(EXACT / (max(1, count) * reach[t] ** 2))), len(cols))
        for t, s in enumerate(settings)]
    blocks = _blocks(rows, cols, target, stage, cuts, groups, init, parts)
    if parts == 1:
        learners = _grow_by_group(blocks, groups, learners, width)
    else:
        _grow_by_level(blocks, n_groups, learners, width, cores)
    return [_finished(cols, cuts, learner) for learner in learners]


def _grow_by_group(blocks, groups: list[list[int]], learners: list[_Learner], bins: int) -> list[_Learner]:
    """One block has all rows: groups of learners are spread, some rounds a pass."""
    state = blocks.map(lambda b: (b, [learners[t] for t in groups[b.group]]))
    while True:
        after = state.map(lambda e: _rounds(*e, bins)).persist()
        after.checkpoint()
        open_groups = after.map(lambda e: any(not learner.done for learner in e[1])).collect()
        state.unpersist()
        state = after
        if not any(open_groups):
            break
    found = state.flatMap(lambda e: e[1]).collect()  # the models
    state.unpersist()
    return sorted(found, key=lambda learner: learner.number)


def _grow_by_level(state, n_groups: int, learners: list[_Learner], bins: int, cores: int) -> None:
    """Rows in several blocks: an aggregation over all blocks per level of all learners."""
    state = state.persist()
    older: list = []  # blocks of the round before, kept until those after them are there
    number = 0

    def by_group(pairs):
        out: list[list] = [[] for _ in range(n_groups)]
        for t, ask in pairs:
            out[t % n_groups].append((t, ask))
        return out

    while any(not learner.done for learner in learners):
        judged = [learner for learner in learners if not learner.done]
        errors = by_group((q.number, (q.at, q.setting, q.error_unit)) for q in judged)
        for learner in judged:
            if len(learner.trees) < learner.setting.rounds:
                learner.begin()
        growing = [learner for learner in judged if learner.tree is not None]
        first = True
        while True:
            tasks = {q.number: task for q in growing if (task := q.ask()) is not None}
            if not tasks and not first:
                break
            asked, wanted = by_group(tasks.items()), errors if first else by_group(())

            def partial(block: Block, asked=asked, wanted=wanted):
                for t, task in asked[block.group]:
                    yield (0, t), _sums(block, task, bins)
                for t, ask in wanted[block.group]:
                    yield (1, t), _errors(block, *ask)

            def finish(item, tasks=tasks):
                (kind, t), value = item
                return (kind, t), value if kind else _best(value, tasks[t])

            sums = state.flatMap(partial).reduceByKey(np.add, min(len(learners) + 1, 2 * cores))
            found = dict(sums.map(finish).collect())  # a split per open node and an error per learner
            if first:
                while older:
                    older.pop().unpersist()
                for learner in judged:
                    learner.judge(found[(1, learner.number)])
                growing = [q for q in growing if not q.done]
            for learner in growing:
                if learner.number in tasks:
                    learner.take(found[(0, learner.number)])
            first = False
        for learner in growing:
            learner.prune()
        quantiles = _leaf_quantiles(state, by_group((q.number, q.ask_leaves()) for q in growing
                                                    if q.setting.quantile is not None))
        updates = by_group((q.number, q.finish(quantiles.get(q.number))) for q in growing)
        if not growing:
            continue
        shared = state.context.broadcast([[u for _, u in group] for group in updates])
        older.append(state)
        state = state.map(lambda block, shared=shared: _apply(block, shared.value[block.group])).persist()
        number += 1
        if number % CHECKPOINT_ROUNDS == 0:
            state.checkpoint()
    state.unpersist()
    for rdd in older:
        rdd.unpersist()


def _leaf_quantiles(state, asked: list[list]) -> dict[int, dict[int, float]]:
    """Quantiles of the residuals of each leaf, from merged summaries."""
    if not any(asked):
        return {}

    def partial(block: Block):
        for t, task in asked[block.group]:
            for node, summary in _leaf_summaries(block, task):
                yield (t, node), summary

    shares = {t: task.setting.quantile for group in asked for t, task in group}
    merged = state.flatMap(partial).reduceByKey(_merged)
    out: dict[int, dict[int, float]] = {}
    for (t, node), value in merged.map(lambda r: (r[0], summary_quantile(r[1], shares[r[0][0]]))).collect():
        out.setdefault(t, {})[node] = value
    return out


def _starts(rows: DataFrame, settings: Sequence[Setting], target: str, stage: str) -> tuple[list[float], list[float], int]:
    """First prediction (mean or quantile of the training targets) and bound of the gradient, per learner; rows in all."""
    y = F.col(target).cast("double")
    wanted = sorted({(s.train_to, s.quantile) for s in settings}, key=lambda w: (w[0], w[1] is None, w[1] or 0.0))
    columns = []
    for i, (to, q) in enumerate(wanted):
        mine = F.when(F.col(stage) <= to, y)
        start = F.avg(mine) if q is None else F.percentile_approx(mine, q, 10_000)
        columns += [start.alias(f"a{i}"), F.min(mine).alias(f"l{i}"), F.max(mine).alias(f"h{i}")]
    found = rows.agg(F.count(F.lit(1)).alias("n"), *columns).first()
    if any(found[f"a{i}"] is None for i in range(len(wanted))):
        raise ValueError("a learner has no training rows")
    by = {w: (float(found[f"a{i}"]), max(4.0 * (float(found[f"h{i}"]) - float(found[f"l{i}"])), 1e-9))
          for i, w in enumerate(wanted)}
    pairs = [by[(s.train_to, s.quantile)] for s in settings]
    return [p[0] for p in pairs], [p[1] for p in pairs], found["n"]


def _finished(cols: Sequence[str], cuts: list[list[float]], learner: _Learner) -> Grown:
    stopped = learner.setting.patience is not None
    kept = learner.trees[: learner.best] if stopped else learner.trees
    starts, parts, at = [], [], 0
    for tree, value in kept:
        left = np.array(tree.left)
        inner = left >= 0
        feature = np.where(inner, np.array(tree.feature), -1)
        threshold = np.array([cuts[f][c] if f >= 0 else 0.0 for f, c in zip(feature.tolist(), tree.cut, strict=True)])
        starts.append(at)
        parts.append((feature, threshold, np.where(inner, left + at, -1), np.where(inner, 0.0, value),
                      np.array(tree.rows), np.array(tree.gain)))
        at += len(left)
    columns = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(6)]
    forest = Forest(list(cols), learner.init, np.array(starts, np.int64), columns[0].astype(np.int64), columns[1],
                    columns[2].astype(np.int64), columns[3], columns[4], columns[5])
    return Grown(forest, learner.history, learner.best if stopped else len(kept))
