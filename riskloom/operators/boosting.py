"""Gradient boosting of all classes together on binned features.

Features are cut into bins once and written as blocks of bytes.  A round grows one tree per class from the softmax's
first and second derivatives.  For every level of its trees one job adds up both derivatives per (class, node, feature,
bin), inside the tasks, and only these sums, whose size depends on the model and not on the rows, come to the driver,
which picks the splits.  Of two children the lighter one is summed and the other is what is left of the parent.
Derivatives are rounded to a grid that keeps all sums exact, so that neither this nor the partitions change a split.
A tree's splits travel with the next job; rows keep only their margins between rounds, cached beside the blocks and
checkpointed now and then, so a lost executor costs a few rounds of its own blocks.

A level of few rows takes less time than its job.  So up to ``WHOLE_BLOCKS`` blocks every class gets a task with a copy of
all rows, which grows the class's tree of a round in one job; up to ``FEW_BLOCKS`` one task grows all classes through
``CHECKPOINT_ROUNDS`` rounds.  The trees are the same to the last bit, as sums are exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, functions as F

from riskloom.operators.trees import LEAF, Trees, joined
from riskloom.session import stage

BLOCK_ROWS = 4096
CHECKPOINT_ROUNDS = 25
BLOCKS_PER_PARTITION = 1000  # at most, some 400 MB
GRID_BITS = 30
WHOLE_BLOCKS, FEW_BLOCKS = 64, 32  # some 20 and 10 MB of bins a copy at 80 features
STEP_ROWS = 1 << 15
WHOLE_ROUNDS = 10  # fewer don't pay for the copies
JOINT_BINS = 64  # of features that are counted together
WIDE_BINS = 4096  # the same where places have more than twice as many rows
GATHERED_BLOCKS = 32  # some 11 MB
KEPT = StorageLevel.MEMORY_AND_DISK_DESER  # blocks are bytes already: packing them again costs more than their sums


@dataclass(frozen=True)
class BoostSettings:
    rounds: int = 300
    depth: int = 6
    rate: float = 0.05
    least_weight: float = 5.0  # of second derivatives in a child
    least_gain: float = 0.1
    row_share: float = 0.8
    column_share: float = 0.8
    l1: float = 0.1
    l2: float = 1.0
    bins: int = 64
    seed: int = 42


@dataclass(frozen=True)
class Boosted:
    """Trees of all classes; the softmax of their margins are the probabilities."""

    trees: Trees
    losses: Sequence[float]  # mean training loss before each round and after the last

    @property
    def n_classes(self) -> int:
        return self.trees.n_outputs


def cut_points(df: DataFrame, values: str, width: int, bins: int) -> list[np.ndarray]:
    """Ascending cuts per feature, in one pass; a value belongs to the first bin whose cut is not below it."""
    shares = F.lit([(i + 1) / bins for i in range(bins - 1)])
    found = df.agg(*[F.percentile_approx(F.col(values)[i], shares, 20_000).alias(f"q{i}") for i in range(width)]).first()
    return [np.unique(np.array(found[f"q{i}"] or [], np.float64)) for i in range(width)]


def blocks_of(df: DataFrame, values: str, label: str, cuts: Sequence[np.ndarray]) -> DataFrame:
    """(rows, bins, labels): up to ``BLOCK_ROWS`` rows as bytes, one byte a feature."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, len(cuts))
                binned = np.empty(x.shape, np.uint8)
                for f, own in enumerate(cuts):
                    binned[:, f] = np.searchsorted(own, x[:, f], "left")
                y = part.column(1).to_numpy(zero_copy_only=False).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows], pa.int32()), pa.array([binned.tobytes()]), pa.array([y.tobytes()])],
                    names=["rows", "bins", "labels"],
                )

    return df.select(values, label).mapInArrow(cut, "rows int, bins binary, labels binary")


@dataclass
class _Block:
    """Blocks of rows, one behind the other, with the number and the rows of each."""

    numbers: list[int]
    sizes: list[int]
    x: np.ndarray  # (features, rows)
    y: np.ndarray
    margins: np.ndarray  # (classes, rows)

    @classmethod
    def together(cls, blocks: Sequence[_Block]) -> _Block:
        x, y, margins = (np.concatenate([getattr(b, n) for b in blocks], -1) for n in ("x", "y", "margins"))
        return cls([n for b in blocks for n in b.numbers], [n for b in blocks for n in b.sizes], x, y, margins)

    def sampled(self, share: float, seed: int, turn: int) -> np.ndarray:
        parts = [np.random.default_rng((seed, turn, number)).random(n) for number, n in zip(self.numbers, self.sizes)]
        return np.flatnonzero(np.concatenate(parts) < share)


@dataclass
class _Joint:
    """Features with few bins under one index: they are counted together, and their own sums follow from the joint ones."""

    features: list[int]
    bins: list[int]
    index: np.ndarray  # of each row

    @classmethod
    def of(cls, x: np.ndarray, bins: Sequence[int], groups: Sequence[Sequence[int]]) -> list[_Joint]:
        out = []
        for features in groups:
            index = x[features[0]].astype(np.uint16)
            for f in features[1:]:
                index = index * np.uint16(bins[f]) + x[f]
            out.append(cls(list(features), [bins[f] for f in features], index))
        return out


def joint_features(bins: Sequence[int], limit: int) -> list[list[int]]:
    """Features in groups whose numbers of bins have a product of at most ``limit``, or of one feature alone."""
    groups: list[list[int]] = []
    sizes: list[int] = []
    for f in sorted(range(len(bins)), key=lambda f: -bins[f]):
        at = next((i for i, size in enumerate(sizes) if size * bins[f] <= limit), None)
        if at is None:
            groups.append([f])
            sizes.append(bins[f])
        else:
            groups[at].append(f)
            sizes[at] *= bins[f]
    return groups


class _Joints:
    """The joint indexes of a block's features, those of small places and those of large ones, made when asked for."""

    def __init__(self, x: np.ndarray, bins: Sequence[int], groups: Sequence[Sequence[Sequence[int]]]):
        self.x, self.bins, self.groups = x, bins, groups
        self.made: dict[bool, list[_Joint]] = {}

    def of(self, wide: bool) -> list[_Joint]:
        if wide not in self.made:
            self.made[wide] = _Joint.of(self.x, self.bins, self.groups[wide])
        return self.made[wide]


def _apart(sums: np.ndarray, bins: Sequence[int]) -> list[np.ndarray]:
    """Sums over the bins of each feature, from those over the joint bins, the last axis; half of the features at a time."""
    if len(bins) == 1:
        return [sums]
    half = len(bins) // 2
    both = sums.reshape(*sums.shape[:-1], math.prod(bins[:half]), -1)
    return _apart(both.sum(axis=-1), bins[:half]) + _apart(both.sum(axis=-2), bins[half:])


def _softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(axis=0))
    return e / e.sum(axis=0)


@dataclass
class _Growing:
    """One class's tree of the current round: splits on bins, level by level."""

    feature: list[int]
    cut: list[int]
    left: list[int]
    right: list[int]
    value: list[float]
    gain: list[float]

    @classmethod
    def new(cls) -> _Growing:
        return cls([LEAF], [0], [LEAF], [LEAF], [0.0], [0.0])

    def add(self) -> int:
        for own, empty in zip((self.feature, self.cut, self.left, self.right, self.value, self.gain), (LEAF, 0, LEAF, LEAF, 0.0, 0.0)):
            own.append(empty)
        return len(self.feature) - 1

    def descend(self, x: np.ndarray, found: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """The rows of each leaf, from the rows of the nodes ``found`` on.

        Rows are dealt node by node: a level reads one byte a row, in ascending order.
        """
        found = dict(found)
        for node, feature in enumerate(self.feature):  # children come behind their parent
            if feature != LEAF and node in found:
                rows = found.pop(node)
                low = x[feature].take(rows) <= self.cut[node]
                found[self.left[node]], found[self.right[node]] = rows.compress(low), rows.compress(~low)
        return found

    def leaves(self, x: np.ndarray) -> dict[int, np.ndarray]:
        return self.descend(x, {0: np.arange(x.shape[1])})

    def cover(self, x: np.ndarray) -> np.ndarray:
        """Rows in each leaf."""
        out = np.zeros(len(self.feature), np.int64)
        for node, rows in self.leaves(x).items():
            out[node] = len(rows)
        return out


def _grid(rows: int) -> float:
    """Steps of 1 / this, at which sums of up to ``rows`` values of at most 1 are exact doubles."""
    return 2.0 ** min(GRID_BITS, 52 - max(rows, 1).bit_length())


def _histograms(
    block: _Block, joints: _Joints, trees: list[_Growing], asked: list[list[int]], columns: np.ndarray, grid: float,
    s: BoostSettings, turn: int,
) -> np.ndarray:
    """(2, places, features, bins): sums of both derivatives for the asked nodes of all classes, over each class's own
    features."""
    p = _softmax(block.margins)
    use = block.sampled(s.row_share, s.seed, turn)
    out = np.zeros((2, sum(map(len, asked)), columns.shape[1], s.bins))
    first = 0
    for k, (tree, nodes) in enumerate(zip(trees, asked)):
        if nodes:
            found = tree.descend(block.x, {0: use})
            both = _derivatives(p[k], block.y == k, grid)
            _add_up_all(out[:, first : first + len(nodes)], [found[node] for node in nodes], both, joints, columns[k])
            first += len(nodes)
    return out


def _derivatives(q: np.ndarray, hit: np.ndarray, grid: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives for probabilities ``q`` of a class that the rows of ``hit`` have."""
    return np.rint((q - hit) * grid) / grid, np.rint(2.0 * q * (1.0 - q) * grid) / grid


def _add_up(
    out: np.ndarray, places: Sequence[np.ndarray], derivatives: Sequence[np.ndarray], joints: list[_Joint], columns: np.ndarray
) -> None:
    """Add the rows of each place to ``out``, (2, places, features, bins), some at a time so that they stay in a cache."""
    n, at = len(places), {int(f): i for i, f in enumerate(columns)}
    used = [j for j in joints if any(f in at for f in j.features)]
    width = [math.prod(j.bins) for j in used]
    totals = [np.zeros(n * w, np.complex128) for w in width]  # both derivatives in one pass
    rows, base = np.concatenate(places), np.repeat(np.arange(n), [len(own) for own in places])
    for lo in range(0, len(rows), STEP_ROWS):
        own, start = rows[lo : lo + STEP_ROWS], base[lo : lo + STEP_ROWS]
        both = derivatives[0].take(own) + 1j * derivatives[1].take(own)
        starts = {w: start * w for w in set(width)} if n > 1 else {}
        for joint, w, total in zip(used, width, totals):
            index = joint.index.take(own)
            np.add.at(total, starts[w] + index if n > 1 else index.astype(np.intp), both)
    for joint, w, total in zip(used, width, totals):
        for f, bins, sums in zip(joint.features, joint.bins, _apart(total.reshape(n, w), joint.bins)):
            if f in at:
                out[0, :, at[f], :bins] += sums.real
                out[1, :, at[f], :bins] += sums.imag


def _add_up_all(
    out: np.ndarray, places: Sequence[np.ndarray], derivatives: Sequence[np.ndarray], joints: _Joints, columns: np.ndarray
) -> None:
    """``_add_up`` of large places one by one, over more features under one index, and of all others together."""
    large = [len(own) > 2 * WIDE_BINS for own in places]
    for i in np.flatnonzero(large).tolist():
        _add_up(out[:, i : i + 1], places[i : i + 1], derivatives, joints.of(True), columns)
    if small := [i for i, is_large in enumerate(large) if not is_large]:
        found = np.zeros((2, len(small), *out.shape[2:]))
        _add_up(found, [places[i] for i in small], derivatives, joints.of(False), columns)
        out[:, small] += found


def _shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def leaf_value(g, h, s: BoostSettings):
    """The step that lowers the loss most under both penalties, times the rate."""
    return -s.rate * _shrunk(np.asarray(g, float), s.l1) / (h + s.l2)


def _split(tree: _Growing, sums: dict[int, np.ndarray], columns: np.ndarray, s: BoostSettings) -> list[tuple[int, int, int]]:
    """Split the nodes where that gains enough; each such node with its lighter and its heavier child.

    ``sums`` holds (2, features, bins) of each open node, over the features ``columns``.
    """
    opened: list[tuple[int, int, int]] = []

    def score(g, h):
        out = np.abs(g)
        out -= s.l1
        np.maximum(out, 0.0, out=out)
        out *= out
        out /= h + s.l2
        return out

    for node, own in sums.items():
        if own[1, 0].sum() < 2 * s.least_weight:
            continue
        upto = np.cumsum(own, axis=2)
        all_g, all_h = upto[:, :1, -1:]
        g, h = upto[:, :, :-1]
        rest_g, rest_h = all_g - g, all_h - h
        gain = score(g, h)
        gain += score(rest_g, rest_h)
        gain -= score(all_g, all_h)
        gain[~(np.minimum(h, rest_h) >= s.least_weight)] = -np.inf
        i, b = divmod(int(np.argmax(gain)), gain.shape[1])
        if not gain[i, b] > s.least_gain:
            continue
        tree.feature[node], tree.cut[node], tree.gain[node] = int(columns[i]), b, float(gain[i, b])
        tree.left[node], tree.right[node] = left, right = tree.add(), tree.add()
        tree.value[left] = float(leaf_value(g[i, b], h[i, b], s))
        tree.value[right] = float(leaf_value(rest_g[i, b], rest_h[i, b], s))
        opened.append((node, left, right) if h[i, b] <= rest_h[i, b] else (node, right, left))
    return opened


def _grow(trees: list[_Growing], columns: Sequence[np.ndarray], s: BoostSettings, ask: Callable[[list[list[int]], int], np.ndarray]) -> None:
    """Grow the trees together, level by level; ``ask(nodes, depth)`` gives (2, places, features, bins) of the asked nodes
    of each tree, one tree behind the other."""
    open_sums: list[dict[int, np.ndarray]] = [{} for _ in trees]
    pairs: list[list[tuple[int, int, int]]] = []
    for depth in range(s.depth):
        asked = [[lighter for _, lighter, _ in own] for own in pairs] if depth else [[0] for _ in trees]
        if not any(asked):
            break
        found, at = ask(asked, depth), 0
        for k, tree in enumerate(trees):
            got = dict(zip(asked[k], found.swapaxes(0, 1)[at : at + len(asked[k])]))
            at += len(asked[k])
            if depth == 0:
                tree.value[0] = float(leaf_value(*got[0][:, 0].sum(axis=1), s))
            else:
                for node, lighter, heavier in pairs[k]:
                    got[heavier] = open_sums[k][node] - got[lighter]
            open_sums[k] = dict(sorted(got.items()))
        pairs = [_split(tree, own, columns[k], s) for k, (tree, own) in enumerate(zip(trees, open_sums))]


def _stepped(block: _Block, trees: list[_Growing]) -> _Block:
    margins = block.margins.copy()
    for own, tree in zip(margins, trees):
        for node, rows in tree.leaves(block.x).items():
            own[rows] += tree.value[node]
    return _Block(block.numbers, block.sizes, block.x, block.y, margins)


def _loss(block: _Block) -> tuple[float, int]:
    p = _softmax(block.margins)
    n = len(block.y)
    return float(-np.log(np.maximum(p[block.y, np.arange(n)], 1e-300)).sum()), n


def _added(rdd: RDD, parts: int, work):
    """The sum of ``work`` over all blocks: added up in each task, in stages where there are many."""

    def inside(blocks):
        total = None
        for block in blocks:
            made = work(block)
            total = made if total is None else [a + b for a, b in zip(total, made)]
        return [] if total is None else [total]

    plus = lambda a, b: [x + y for x, y in zip(a, b)]
    sums = rdd.mapPartitions(inside)
    return sums.treeReduce(plus, 2) if parts > 16 else sums.reduce(plus)


def fit(df: DataFrame, values: str, label: str, n_classes: int, settings: BoostSettings = BoostSettings()) -> Boosted:
    """Boost on the feature array ``values`` and the class numbers 0 to ``n_classes`` - 1 in ``label``."""
    s, spark = settings, df.sparkSession
    head = df.select(F.size(values)).first()
    if head is None:
        raise ValueError("no rows to learn from")
    width = head[0]
    cuts = cut_points(df, values, width, s.bins)
    written = stage(blocks_of(df, values, label, cuts), "blocks")
    n_blocks = written.count()
    parts = max(1, min(n_blocks, max(spark.sparkContext.defaultParallelism, -(-n_blocks // BLOCKS_PER_PARTITION))))
    grid = _grid(n_blocks * BLOCK_ROWS)

    def read(row) -> _Block:
        number, (n, x, y) = row
        labels = np.frombuffer(y, np.uint16)
        by_feature = np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(n, width).T)
        return _Block([number], [n], by_feature, labels, np.zeros((n_classes, n)))

    bins = [len(own) + 1 for own in cuts]
    joined_bins = bins, [joint_features(bins, limit) for limit in (JOINT_BINS, WIDE_BINS)]

    ordered = written.orderBy(F.xxhash64("bins", "labels"), "bins", "labels").rdd.map(tuple).zipWithIndex()
    ordered = ordered.map(lambda r: (r[1], r[0]))
    rng = np.random.default_rng(s.seed)
    taken = max(1, round(s.column_share * width))
    draws = [np.array([np.sort(rng.permutation(width)[:taken]) for _ in range(n_classes)]) for _ in range(s.rounds)]
    if n_blocks <= WHOLE_BLOCKS and s.rounds >= WHOLE_ROUNDS:
        grown, losses, covers = _by_class(ordered.map(read), n_blocks, n_classes, draws, grid, s, joined_bins)
    else:
        dealt = ordered.partitionBy(parts, lambda number: number).map(read)
        grown, losses, covers = _by_level(dealt.mapPartitions(_gathered), parts, draws, grid, s, joined_bins)
    made = [_finished(tree, cover, cuts) for tree, cover in zip((t for trees in grown for t in trees), covers)]
    return Boosted(joined(made, [k for _ in grown for k in range(n_classes)], n_classes), losses)


def _gathered(blocks: Iterable[_Block]) -> Iterator[_Block]:
    """Up to ``GATHERED_BLOCKS`` blocks as one: sums as large as the model are made once for all of them."""
    blocks = iter(blocks)
    while held := list(islice(blocks, GATHERED_BLOCKS)):
        yield _Block.together(held)


JoinedBins = tuple[list[int], list[list[list[int]]]]  # bins of each feature, features counted together in small and large places
Fitted = tuple[list[list[_Growing]], list[float], list[np.ndarray]]  # trees by round and class, losses, covers


def _by_level(state: RDD, parts: int, draws: list[np.ndarray], grid: float, s: BoostSettings, joined_bins: JoinedBins) -> Fitted:
    """A job a level, over blocks dealt to ``parts`` tasks."""
    state = state.persist(KEPT)
    grown: list[list[_Growing]] = []
    losses: list[float] = []
    before: RDD | None = None
    for turn, columns in enumerate(draws):
        trees = [_Growing.new() for _ in columns]

        def ask(asked, depth, state=state, trees=trees, columns=columns, turn=turn):
            def work(block):
                joints = _Joints(block.x, *joined_bins)
                made = [_histograms(block, joints, trees, asked, columns, grid, s, turn)]
                return made if depth else made + [np.array(_loss(block))]

            found = _added(state, parts, work)
            if depth == 0:
                losses.append(float(found[1][0] / found[1][1]))
                if before is not None:
                    before.unpersist()
            return found[0]

        _grow(trees, columns, s, ask)
        grown.append(trees)
        before, state = state, state.map(lambda block, trees=trees: _stepped(block, trees)).persist(KEPT)
        if (turn + 1) % CHECKPOINT_ROUNDS == 0:
            state.checkpoint()  # by the next job
    total, n = _added(state, parts, lambda block: [np.array(_loss(block))])[0]
    losses.append(float(total / n))
    covers = _covers(state, parts, [tree for trees in grown for tree in trees])
    for kept in (before, state):
        if kept is not None:
            kept.unpersist()
    return grown, losses, covers


@dataclass
class _Whole:
    """A copy of all rows, for the trees of the classes ``own``."""

    own: list[int]
    rows: _Block

    def round(self, joints: _Joints, columns: np.ndarray, grid: float, s: BoostSettings, turn: int) -> list[_Growing]:
        """The trees of the own classes in one round."""
        use = self.rows.sampled(s.row_share, s.seed, turn)
        p, y, x = _softmax(self.rows.margins), self.rows.y, self.rows.x
        return [self._tree(x, joints, use, _derivatives(p[k], y == k, grid), columns[k], s) for k in self.own]

    @staticmethod
    def _tree(
        x: np.ndarray, joints: _Joints, use: np.ndarray, derivatives: Sequence[np.ndarray], columns: np.ndarray,
        s: BoostSettings,
    ) -> _Growing:
        tree, found = _Growing.new(), {0: use}

        def ask(asked, depth):
            nonlocal found
            found = tree.descend(x, found)
            out = np.zeros((2, len(asked[0]), len(columns), s.bins))
            _add_up_all(out, [found[node] for node in asked[0]], derivatives, joints, columns)
            return out

        _grow([tree], [columns], s, ask)
        return tree


def _by_class(
    blocks: RDD, n_blocks: int, n_classes: int, draws: list[np.ndarray], grid: float, s: BoostSettings, joined_bins: JoinedBins
) -> Fitted:
    """A copy of all rows for each class, a job a round; of few blocks one copy for all classes, a job for many rounds."""
    tasks = 1 if n_blocks <= FEW_BLOCKS else n_classes
    at_once = CHECKPOINT_ROUNDS if tasks == 1 else 1

    def whole(pairs):
        held: dict[int, list[_Block]] = {}
        for task, block in pairs:
            held.setdefault(task, []).append(block)
        for task, found in held.items():
            found.sort(key=lambda block: block.numbers)
            yield _Whole(list(range(task, n_classes, tasks)), _Block.together(found))

    copies = blocks.flatMap(lambda block: [(task, block) for task in range(tasks)])
    state = copies.partitionBy(tasks, lambda task: task).mapPartitions(whole)
    if tasks > 1:
        state = state.persist(KEPT)
    grown: list[list[_Growing]] = []
    losses: list[float] = []
    before: RDD | None = None
    for first in range(0, len(draws), at_once):

        def rounds(held, first=first):
            out, now = [], held.rows
            joints = _Joints(now.x, *joined_bins)
            for turn in range(first, min(first + at_once, len(draws))):
                trees = _Whole(held.own, now).round(joints, draws[turn], grid, s, turn)
                out.append((trees, np.divide(*_loss(now))))
                now = _stepped(now, trees) if tasks == 1 else now
            return _Whole(held.own, now), out

        after = state.map(rounds)
        if tasks == 1:  # which has stepped its rows already
            after = after.persist(KEPT)
        found = dict(after.map(lambda done: (done[0].own[0], done[1])).collect())
        if before is not None:
            before.unpersist()
        made = [[found[k % tasks][r][0][k // tasks] for k in range(n_classes)] for r in range(len(found[0]))]
        losses += [float(loss) for _, loss in found[0]]
        grown += made

        def step(held, made=made):
            now = held.rows
            for trees in made:
                now = _stepped(now, trees)
            return _Whole(held.own, now)

        if tasks == 1:
            before, state = after, after.map(lambda done: done[0])
        else:
            before, state = state, state.map(step).persist(KEPT)
        if len(grown) % CHECKPOINT_ROUNDS == 0:
            state.checkpoint()  # by the next job
    sent = state.context.broadcast(grown)

    def last(held):
        x = held.rows.x
        covers = [[trees[k].cover(x) for trees in sent.value] for k in held.own]
        return held.own, covers, np.divide(*_loss(held.rows))

    ends = {k: (cover, loss) for own, covers, loss in state.map(last).collect() for k, cover in zip(own, covers)}
    losses.append(float(ends[0][1]))
    for kept in (before, state):
        if kept is not None:
            kept.unpersist()
    return grown, losses, [ends[k][0][r] for r in range(len(grown)) for k in range(n_classes)]


def _covers(state: RDD, parts: int, trees: list[_Growing]) -> list[np.ndarray]:
    """Training rows in each leaf of each tree, in one pass."""
    if not trees:
        return []
    sent = state.context.broadcast(trees)
    count = lambda block: [t.cover(block.x) for t in sent.value]
    return _added(state, parts, count)


def _finished(tree: _Growing, cover: np.ndarray, cuts: Sequence[np.ndarray]) -> dict[str, np.ndarray]:
    """The tree's arrays with real thresholds, and means and numbers of rows in its inner nodes."""
    cover, value = cover.astype(np.float64), np.array(tree.value)
    for node in range(len(tree.feature) - 1, -1, -1):  # children come behind their parent
        if tree.feature[node] != LEAF:
            sides = [tree.left[node], tree.right[node]]
            cover[node] = cover[sides].sum()
            value[node] = (cover[sides] * value[sides]).sum() / cover[node] if cover[node] else value[sides].mean()
    threshold = [
        0.0 if f == LEAF else float(cuts[f][min(c, len(cuts[f]) - 1)]) for f, c in zip(tree.feature, tree.cut)
    ]
    return {
        "feature": np.array(tree.feature),
        "threshold": np.array(threshold),
        "left": np.array(tree.left),
        "right": np.array(tree.right),
        "value": value,
        "cover": cover,
        "gain": np.array(tree.gain),
    }
