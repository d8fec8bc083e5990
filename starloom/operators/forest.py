"""Importances of a random forest over many rows, its trees grown in tasks.

The forest is Spark ML's: 32 bins per feature, a Poisson bag of the rows and a
random subset of the features per node, Gini impurity, nodes split until they
are pure, without gain or at the last level. Spark sums a table of counts for
every node of a level, which deep trees of many small nodes spend their time
on. Here the counts of all rows are summed only for nodes too large for a task;
the rows of every other node go to one task, which grows it to its end. Draws
follow from seed, tree, block and node, so a tree does not depend on where it is grown.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import materialise

BINS = 32
#: Rows times features of a node that one task grows and of a block; numbers handled at once.
NODE_CELLS, BLOCK_CELLS, AT_ONCE = 1 << 24, 1 << 19, 1 << 21
#: Values that stand for those of a feature in a stretch of rows; distinct values up to that are exact.
MARKS = 1_024
#: Rows times trees of a task, and tasks at most.
TASK_ROWS, TASKS = 1 << 19, 2_000
#: Bytes of blocks that a task reads about, and of counts that it holds before it sends them on.
HELD = 1 << 26


# bins


def _summary(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values with counts, or evenly spaced values of equal weight."""
    found, count = np.unique(values, return_counts=True)
    if len(found) <= MARKS:
        return found, count.astype("float64")
    place = ((np.arange(MARKS) + 0.5) * (len(values) / MARKS)).astype("int64")
    return np.sort(values)[place], np.full(MARKS, len(values) / MARKS)


def _cuts(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Upper ends of all bins but the last: every distinct value up to ``BINS``, else bins of about equal count."""
    values, number = np.unique(values, return_inverse=True)
    if len(values) <= BINS:
        return values[:-1]
    upto = np.cumsum(np.bincount(number, counts))
    goal = upto[-1] * np.arange(1, BINS) / BINS
    at = np.searchsorted(upto, goal)
    at -= (at > 0) & (goal - upto[at - 1] <= upto[at] - goal)
    return np.unique(values[np.minimum(at, len(values) - 2)])


def _numbers(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def cuts(rows: DataFrame, width: int) -> list[np.ndarray]:
    """The cuts of every feature of ``x array<double>``, from all rows; a few numbers per feature reach the driver."""
    stretch = max(MARKS, NODE_CELLS // 8 // width)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flushed() -> pa.RecordBatch:
            x = np.concatenate(held)
            parts = [_summary(x[:, i]) for i in range(width)]
            arrays = [pa.array([p[k].tobytes() for p in parts], pa.binary()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype="int32")), *arrays], ["i", "value", "n"])

        for batch in batches:
            if batch.num_rows:
                held.append(_numbers(batch, width))
            if sum(map(len, held)) >= stretch:
                yield flushed()
                held = []
        if held:
            yield flushed()

    def merged(group: pa.Table) -> pa.Table:
        values, counts = (np.concatenate([np.frombuffer(b.as_py()) for b in group[c]]) for c in ("value", "n"))
        return pa.table({"i": group["i"][:1], "cuts": pa.array([_cuts(values, counts).tobytes()], pa.binary())})

    found = rows.select("x").mapInArrow(summaries, "i int, value binary, n binary")
    found = found.groupBy("i").applyInArrow(merged, "i int, cuts binary").collect()
    return [np.frombuffer(r["cuts"]) for r in sorted(found, key=lambda r: r["i"])]


def blocks(rows: DataFrame, ends: list[np.ndarray]) -> DataFrame:
    """Rows of about ``BLOCK_CELLS`` cells as bytes: ``x`` the bins of all features by row, ``y`` the classes."""
    width = len(ends)
    size = max(1, BLOCK_CELLS // width)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _numbers(batch, width), batch.column("label").to_numpy().astype("uint8")
            for part in np.array_split(np.arange(len(y)), -(-len(y) // size)):
                bins = np.empty((len(part), width), "uint8")
                for i, end in enumerate(ends):
                    bins[:, i] = np.searchsorted(end, x[part, i])
                arrays = [pa.array([number]), pa.array([bins.tobytes()], pa.binary()), pa.array([y[part].tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["block", "x", "y"])
                number += 1

    return rows.mapInArrow(turn, "block long, x binary, y binary")


# draws


def _mixed(z: np.ndarray) -> np.ndarray:
    """Well mixed bits of whole numbers (the last step of splitmix64)."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def drawn(seed: int, tree: int, nodes: np.ndarray, width: int, k: int) -> np.ndarray:
    """The ``k`` features that each node may split by, drawn like Spark's by a reservoir: of equal splits the first in it counts."""
    start = _mixed(np.array([seed % (1 << 62)], "uint64") * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tree))
    own = _mixed(start + nodes.astype("uint64"))
    out = np.tile(np.arange(min(k, width)), (len(nodes), 1))
    for feature in range(k, width):
        bits = _mixed(own + np.uint64(feature * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(32)
        place = (bits * np.uint64(feature + 1)) >> np.uint64(32)
        hit = np.flatnonzero(place < k)
        out[hit, place[hit].astype("int64")] = feature
    return out


def bag(seed: int, tree: int, block: int, rows: int) -> np.ndarray:
    """How often each row of a block is in the bag of a tree."""
    return np.minimum(np.random.default_rng([seed % (1 << 62), tree, block]).poisson(1.0, rows), 255).astype("uint8")


# splits


def _scores(left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Impurity that a split takes away, times rows; counts are by class along the first axis."""
    right = total - left
    a, b = left.sum(axis=0), right.sum(axis=0)
    with np.errstate(all="ignore"):
        gain = (left * left).sum(axis=0) / a + (right * right).sum(axis=0) / b - (total * total).sum(axis=0) / (a + b)
    return np.where((a > 0) & (b > 0), gain, -np.inf)


def counted(bins: np.ndarray, at: np.ndarray, y: np.ndarray, w: np.ndarray, nodes: int, classes: int) -> np.ndarray:
    """Counts (class, node, drawn feature, bin) of rows with their bins of the drawn features of their node."""
    k = bins.shape[1]
    code = (((y.astype("int64") * nodes + at) * k)[:, None] + np.arange(k)) * BINS + bins
    return np.bincount(code.ravel(), np.repeat(w.astype("float64"), k), classes * nodes * k * BINS).reshape(classes, nodes, k, BINS)


def best_of_counts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node: which drawn feature, last bin of the left side, gain, and counts by class on the left and in all."""
    left, total = counts.cumsum(axis=3)[..., :-1], counts.sum(axis=3, keepdims=True)
    nodes = np.arange(counts.shape[1])
    gain = _scores(left, total).reshape(len(nodes), -1)
    place = gain.argmax(axis=1)
    j, cut = np.divmod(place, BINS - 1)
    return j, cut, gain[nodes, place], left[:, nodes, j, cut], total[:, :, 0, 0]


def best_of_rows(
    bins: np.ndarray, at: np.ndarray, y: np.ndarray, w: np.ndarray, nodes: int, classes: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same without a cell per bin, for nodes of few rows: rows are sorted by node, feature and bin."""
    k, y_bits, w_bits = bins.shape[1], max(1, (classes - 1).bit_length()), int(w.max()).bit_length()
    shift = y_bits + w_bits
    kind = "int32" if (nodes * k * BINS).bit_length() + shift < 32 else "int64"
    low = (y.astype(kind) << w_bits) | w
    code = ((at.astype(kind) * k)[:, None] + np.arange(k, dtype=kind)) * BINS + bins
    code = np.sort(((code << shift) | low[:, None]).ravel())
    w, y, code = code & ((1 << w_bits) - 1), (code >> w_bits) & ((1 << y_bits) - 1), code >> shift
    end = np.append(code[1:] != code[:-1], True)
    upto = np.stack([np.cumsum(np.where(y == c, w, 0), dtype="int64")[end] for c in range(classes)])
    code = code[end]
    column = code // BINS
    last = np.append(column[1:] != column[:-1], True)
    closed = upto[:, last]
    before = np.concatenate([np.zeros((classes, 1), "int64"), closed[:, :-1]], axis=1)
    number = np.cumsum(last) - last
    left, total = (upto - before[:, number]).astype("float64"), (closed - before)[:, number].astype("float64")
    gain, node = _scores(left, total), column // k
    starts = np.searchsorted(node, np.arange(nodes))
    top = np.maximum.reduceat(gain, starts)
    hits = np.flatnonzero(gain == top[node])
    place = hits[np.searchsorted(node[hits], np.arange(nodes))]
    return column[place] - np.arange(nodes) * k, code[place] % BINS, top, left[:, place], total[:, place]


def gainful(gain: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Splits that take away more than rounding does."""
    return gain > total.sum(axis=0) * 1e-14


def grow(
    x: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int, seed: int, tree: int, node: int, levels: int, k: int
) -> np.ndarray:
    """Gains per feature below a node, grown level by level to its end; rows lie sorted by node, large nodes first."""
    width = x.shape[1]
    flat, gains = x.ravel(), np.zeros(width)
    ids, sizes = np.array([node], "int64"), np.array([len(y)])
    rows, at = np.arange(len(y)), np.zeros(len(y), "int64")
    for _ in range(levels):
        starts = np.concatenate([[0], np.cumsum(sizes)])
        large = int((sizes > BINS).sum())
        found = []
        first = 0
        while first < len(ids):
            end = int(np.searchsorted(starts, starts[first] + AT_ONCE // (k * classes), "right")) - 1
            end = min(max(end, first + 1), first + max(1, AT_ONCE // width), large if first < large else len(ids))
            part = slice(starts[first], starts[end])
            own, here = drawn(seed, tree, ids[first:end], width, k), at[part] - first
            bins = flat[(rows[part] * width)[:, None] + own[here]]
            rest = bins, here, y[rows[part]], w[rows[part]], end - first, classes
            j, *best = best_of_counts(counted(*rest)) if first < large else best_of_rows(*rest)
            found.append((own[np.arange(end - first), j], *best))
            first = end
        feature, cut, gain, left, total = (np.concatenate(part, axis=-1) for part in zip(*found))
        good = gainful(gain, total)
        gains += np.bincount(feature[good], gain[good], width)
        # a node's children are at twice its place and next to it
        child = 2 * at + (flat[rows * width + feature[at]] > cut[at])
        both = np.stack([left, total - left], axis=-1).reshape(classes, -1)
        sizes = np.bincount(child, minlength=2 * len(ids))
        open_ = np.flatnonzero(np.repeat(good, 2) & ((both > 0).sum(axis=0) > 1))
        open_ = open_[np.argsort(-sizes[open_], kind="stable")]
        if not len(open_):
            break
        number = np.full(2 * len(ids), -1)
        number[open_] = np.arange(len(open_))
        at = number[child]
        rows, at = rows[at >= 0], at[at >= 0]
        order = np.argsort(at, kind="stable")
        rows, at = rows[order], at[order]
        ids, sizes = 2 * ids[open_ // 2] + open_ % 2, sizes[open_]
    return gains


# trees


def _found(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of numbers in sorted ids, and which are there."""
    place = np.minimum(np.searchsorted(ids, at), len(ids) - 1)
    return place, ids[place] == at


def placed(x: np.ndarray, top: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """The node each row comes to by the splits of the upper levels; the root is 1, the children of n are 2n and 2n + 1."""
    at = np.ones(len(x), "int64")
    for ids, feature, cut in top:
        place, there = _found(ids, at)
        right = x[np.arange(len(x)), feature[place]] > cut[place]
        at = np.where(there, 2 * at + right, at)
    return at


def importances(
    rows: DataFrame, width: int, classes: int, n: int, trees: int = 100, seed: int = 42, depth: int = 30, node_rows: int | None = None
) -> np.ndarray:
    """Importances by a forest over ``n`` rows (``x array<double>``, ``label double`` 0, 1, ...): the mean over the trees that split.

    ``node_rows`` is the size of nodes that a task grows alone. The driver holds the splits of larger nodes.
    """
    node_rows = node_rows or max(1_000, NODE_CELLS // width)
    k = width if trees == 1 else math.ceil(math.sqrt(width))
    bins = materialise(blocks(rows, cuts(rows, width)))
    tasks = max(1, min(TASKS, max(n * trees // TASK_ROWS, n * width // HELD)))
    bins = bins.repartition(tasks, "block")

    tops: dict[int, list] = {tree: [] for tree in range(trees)}
    gains = np.zeros((trees, width))
    opened = {tree: np.array([1], "int64") for tree in range(trees)} if depth > 0 else {}
    large, small = (opened, {}) if n > node_rows else ({}, opened)
    level = 0
    while large:
        level += 1
        splits = _level(bins, tops, large, classes, width, seed, k)
        larger: dict[int, list[int]] = {}
        for tree, found in _by_tree(splits).items():
            ids, feature, cut = (np.array([r[c] for r in found], "int64") for c in ("node", "feature", "cut"))
            tops[tree].append((ids, feature, cut))
            for r in found:
                gains[tree, r["feature"]] += r["gain"]
                for side, name in enumerate(("low", "high")):
                    count = np.frombuffer(r[name])
                    if level < depth and (count > 0).sum() > 1:
                        goes = larger if count.sum() > node_rows else small
                        goes[tree] = [*goes.get(tree, []), 2 * r["node"] + side]
        large = {tree: np.array(sorted(ids), "int64") for tree, ids in larger.items()}
    if small:
        small = {tree: np.array(sorted(ids), "int64") for tree, ids in small.items()}
        for r in _grown(bins, tops, small, classes, width, seed, k, depth).collect():
            gains[r["tree"]] += np.frombuffer(r["gains"])
    whole = gains.sum(axis=1)
    return (gains[whole > 0] / whole[whole > 0, None]).sum(axis=0) / max(1, int((whole > 0).sum()))


def _by_tree(splits: list) -> dict[int, list]:
    out: dict[int, list] = {}
    for r in sorted(splits, key=lambda r: (r["tree"], r["node"])):
        out.setdefault(r["tree"], []).append(r)
    return out


def _each(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for block, x, y in zip(*[batch.column(c) for c in ("block", "x", "y")]):
            yield block.as_py(), np.frombuffer(x.as_buffer(), "uint8").reshape(-1, width), np.frombuffer(y.as_buffer(), "uint8")


def _level(
    bins: DataFrame, tops: dict, large: dict, classes: int, width: int, seed: int, k: int
) -> list:
    """The best splits of nodes that many tasks count: one row per node that has one."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {tree: drawn(seed, tree, ids, width, k) for tree, ids in large.items()}
        total: dict[int, np.ndarray] = {}
        for block, x, y in _each(batches, width):
            for tree, ids in large.items():
                w = bag(seed, tree, block, len(y))
                place, there = _found(ids, placed(x, tops[tree]))
                at = np.flatnonzero(there & (w > 0))
                part = counted(x[at[:, None], own[tree][place[at]]], place[at], y[at], w[at], len(ids), classes)
                total[tree] = total[tree] + part if tree in total else part
            if sum(t.nbytes for t in total.values()) > HELD:
                yield from sent(total)
                total = {}
        yield from sent(total)

    def sent(total: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for tree, counts in total.items():
            ids = large[tree]
            parts = pa.array([counts[:, i].tobytes() for i in range(len(ids))], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([tree] * len(ids), pa.int32()), pa.array(ids), parts], ["tree", "node", "counts"])

    def best(group: pa.Table) -> pa.Table:
        tree, node = group["tree"][0].as_py(), group["node"][0].as_py()
        counts = sum(np.frombuffer(b.as_py()) for b in group["counts"]).reshape(classes, 1, k, BINS)
        j, cut, gain, left, total = best_of_counts(counts)
        good = gainful(gain, total)
        feature = drawn(seed, tree, np.array([node], "int64"), width, k)[0, j]
        sides = [pa.array([np.ascontiguousarray(side[:, 0]).tobytes()], pa.binary()) for side in (left, total - left)]
        arrays = [pa.array([tree], pa.int32()), pa.array([node], pa.int64()), pa.array(feature.astype("int32")), pa.array(cut.astype("int32")), pa.array(gain), *sides]
        return pa.table(arrays, ["tree", "node", "feature", "cut", "gain", "low", "high"]).filter(pa.array(good))

    nodes = sum(map(len, large.values()))
    found = bins.mapInArrow(counts, "tree int, node long, counts binary").repartition(min(TASKS, nodes), "tree", "node")
    schema = "tree int, node long, feature int, cut int, gain double, low binary, high binary"
    return found.groupBy("tree", "node").applyInArrow(best, schema).collect()


def _grown(
    bins: DataFrame, tops: dict, small: dict, classes: int, width: int, seed: int, k: int, depth: int
) -> DataFrame:
    """Gains per tree of the nodes that a task grows alone: a row per tree."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, x, y in _each(batches, width):
            for tree, ids in small.items():
                w = bag(seed, tree, block, len(y))
                place, there = _found(ids, placed(x, tops[tree]))
                at = np.flatnonzero(there & (w > 0))
                at = at[np.argsort(place[at], kind="stable")]
                here, first = np.unique(place[at], return_index=True)
                parts = np.split(at, first[1:]) if len(here) else []
                sides = [pa.array([side[p].tobytes() for p in parts], pa.binary()) for side in (x, y, w)]
                arrays = [pa.array([tree] * len(here), pa.int32()), pa.array(ids[here]), pa.array([block] * len(here), pa.int64()), *sides]
                yield pa.RecordBatch.from_arrays(arrays, ["tree", "node", "block", "x", "y", "w"])

    def grown(group: pa.Table) -> pa.Table:
        tree, node = group["tree"][0].as_py(), group["node"][0].as_py()
        group = group.sort_by("block")
        x, y, w = (np.concatenate([np.frombuffer(b.as_buffer(), "uint8") for b in group[c]]) for c in ("x", "y", "w"))
        found = grow(x.reshape(-1, width), y, w, classes, seed, tree, node, depth - node.bit_length() + 1, k)
        return pa.table({"tree": group["tree"][:1], "node": group["node"][:1], "gains": pa.array([found.tobytes()], pa.binary())})

    def added(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b.as_py()) for b in group.sort_by("node")["gains"])
        return pa.table({"tree": group["tree"][:1], "gains": pa.array([total.tobytes()], pa.binary())})

    nodes = sum(map(len, small.values()))
    parts = bins.mapInArrow(dealt, "tree int, node long, block long, x binary, y binary, w binary")
    parts = parts.repartition(min(TASKS, 2 * nodes), "tree", "node").groupBy("tree", "node")
    return parts.applyInArrow(grown, "tree int, node long, gains binary").groupBy("tree").applyInArrow(added, "tree int, gains binary")
