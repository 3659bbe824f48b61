"""Regression forests and boosting grown for large tables by MLlib's splits and stopping rules.

MLlib adds up one histogram per node, tree and input partition at every level, so a deep level of many trees
costs gigabytes a partition whatever the rows. Here the rows are binned once and packed in blocks. Nodes of
more than ``local_rows`` rows are split by histograms summed across tasks, as in MLlib; the rows of a smaller
node are sent to one task, which grows the rest of that subtree. No task holds more than ``local_rows``
records of one node. Boosting passes over the same packed blocks, each with its rows' predictions so far.
The nodes are written in MLlib's model format and loaded from there, so prediction,
importances and persistence are MLlib's own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.ml import regression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..sources.tables import shared_root

LOCAL_ROWS = 2_000_000  # records of a node that one task finishes by itself
SMALL_ROWS = 16_384  # rows up to which a node and all below it are counted level by level
CHUNK_ROWS = 262_144  # rows that are counted together
JOINT_BINS = 1_024  # features share a code while their bins' combinations are no more
NARROW_BINS = 128  # the same where many nodes are counted at once
BLOCK_ROWS = 65_536
REBUILD = 50  # boosting rounds after which the predictions are rebuilt from all trees, so that the lineage stays short
NODES_A_ROW = 32  # nodes whose histograms travel together
DIRECT_ROWS = 100_000  # up to these rows both children are counted, so that equal splits of few rows stay equal
CODED_NODES = 32  # nodes up to which packed features are counted by the byte
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(float)  # the bits of each byte, as packed
EPSILON = 2.0 ** -52  # an impurity below this is none, as in MLlib
NODE_SCHEMA = ("tree int, heap bigint, feature int, threshold double, prediction double, impurity double, gain double, "
               "n double, s double, q double, raw bigint")
NODE_COLUMNS = [c.split()[0] for c in NODE_SCHEMA.split(", ")]


@dataclass(frozen=True)
class Bins:
    """Split thresholds of every feature; bin b holds the values above b of them."""

    thresholds: tuple[np.ndarray, ...]
    most: int = JOINT_BINS

    @cached_property
    def sizes(self) -> list[int]:
        return [len(t) + 1 for t in self.thresholds]

    @cached_property
    def starts(self) -> np.ndarray:
        """Each feature's first slot, and the number of slots."""
        return np.cumsum([0, *self.sizes])

    @cached_property
    def flags(self) -> np.ndarray:
        return np.array([len(t) <= 1 for t in self.thresholds])

    @cached_property
    def groups(self) -> list[list[int]]:
        """Features that share a code: the one of most bins first, each into the first group with room."""
        groups, room = [], []
        for f in sorted(range(len(self.sizes)), key=lambda f: -self.sizes[f]):
            for g, size in enumerate(room):
                if size * self.sizes[f] <= self.most:
                    groups[g].append(f)
                    room[g] *= self.sizes[f]
                    break
            else:
                groups.append([f])
                room.append(self.sizes[f])
        return groups

    @cached_property
    def spans(self) -> np.ndarray:
        """Each code's first place among all codes' values, and their number."""
        return np.cumsum([0, *(int(np.prod([self.sizes[f] for f in group])) for group in self.groups)])

    @cached_property
    def code_of(self) -> dict[int, tuple[int, np.ndarray]]:
        """By feature: its code, and its bin in every value of that code."""
        found = {}
        for g, group in enumerate(self.groups):
            value, stride = np.arange(self.spans[g + 1] - self.spans[g]), 1
            for f in group:
                found[f] = g, (value // stride % self.sizes[f]).astype(np.uint8)
                stride *= self.sizes[f]
        return found

    @cached_property
    def cuts(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Features of two bins, then those of more: their numbers, the slots left of each cut, and which cuts exist."""
        sizes, found = np.array(self.sizes), []
        for features in (np.flatnonzero(sizes == 2), np.flatnonzero(sizes > 2)):
            if len(features):
                cut = np.arange(sizes[features].max() - 1)
                valid = cut < sizes[features][:, None] - 1
                found.append((features, self.starts[features][:, None] + np.where(valid, cut, 0), valid))
        return found

    @cached_property
    def narrow(self) -> Bins:
        """The same bins with fewer values a code."""
        return Bins(self.thresholds, NARROW_BINS)

    @cached_property
    def bin_table(self) -> tuple[np.ndarray, np.ndarray, int]:
        """By feature its code, and its bin by feature and value of that code in one array, so many values apart."""
        apart = int(np.diff(self.spans).max())
        table = np.zeros((len(self.sizes), apart), np.uint8)
        for f, (_, bin_of) in self.code_of.items():
            table[f, :len(bin_of)] = bin_of
        return np.array([self.code_of[f][0] for f in range(len(self.sizes))]), table.ravel(), apart

    def narrowed(self, codes: np.ndarray) -> np.ndarray:
        """The codes of ``narrow`` from these."""
        out = np.zeros((len(self.narrow.groups), codes.shape[1]), np.uint8 if np.diff(self.narrow.spans).max() <= 256 else np.uint16)
        for into, group in zip(out, self.narrow.groups):
            stride, parts = 1, {}
            for f in group:
                g, bin_of = self.code_of[f]
                parts[g] = parts.get(g, 0) + bin_of.astype(np.int64) * stride
                stride *= self.sizes[f]
            for g, values in parts.items():
                into += values.astype(out.dtype).take(codes[g])
        return out

    def joint_of_nodes(self, codes: np.ndarray, rows: np.ndarray, node: np.ndarray, nodes: int, w: np.ndarray, wy: np.ndarray) -> np.ndarray:
        """``joint`` of several nodes at once, each row named with its node: an array (2, nodes, values)."""
        out = np.empty((2, nodes, self.spans[-1]))
        for g, code in enumerate(codes):
            at, end = self.spans[g], self.spans[g + 1]
            place = node * (end - at)
            place += code.take(rows)
            for sums, v in zip(out, (w, wy)):
                sums[:, at:end] = np.bincount(place, v, nodes * (end - at)).reshape(nodes, -1)
        return out

    def pack(self, x: np.ndarray) -> np.ndarray:
        """Rows as their codes."""
        packed = np.zeros((len(x), len(self.groups)), np.uint16)
        for g, group in enumerate(self.groups):
            stride = 1
            for f in group:
                packed[:, g] += (np.searchsorted(self.thresholds[f], x[:, f], side="left") * stride).astype(np.uint16)
                stride *= self.sizes[f]
        return packed

    def unpack(self, codes: np.ndarray) -> np.ndarray:
        """Codes (one array each) as one array of bins a feature."""
        out = np.empty((len(self.sizes), codes.shape[1]), np.uint8)
        for f, (g, bin_of) in self.code_of.items():
            out[f] = bin_of[codes[g]]
        return out

    def bits(self, columns: np.ndarray) -> np.ndarray:
        """The features of at most two bins, eight to a byte."""
        return np.packbits(columns[self.flags], axis=0) if self.flags.any() else np.empty((0, columns.shape[1]), np.uint8)

    def joint(self, codes: np.ndarray, rows: np.ndarray | None, w: np.ndarray | None, wy: np.ndarray) -> np.ndarray:
        """Weights (without any: rows) and weighted labels by value of every code, of all rows or those named: an array (2, values)."""
        out = np.empty((2, self.spans[-1]))
        for g, code in enumerate(codes):
            at, end = self.spans[g], self.spans[g + 1]
            place = (code if rows is None else code.take(rows)).astype(np.int64)
            out[0, at:end] = np.bincount(place, w, end - at)
            out[1, at:end] = np.bincount(place, wy, end - at)
        return out

    @cached_property
    def of_values(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """By code: the slots of its features, and which of them each value counts for (values, slots)."""
        found = []
        for g, group in enumerate(self.groups):
            slots = np.concatenate([np.arange(self.starts[f], self.starts[f + 1]) for f in group])
            found.append((slots, np.hstack([np.eye(self.sizes[f])[self.code_of[f][1]] for f in group])))
        return found

    def separate(self, joint: np.ndarray) -> np.ndarray:
        """Sums by value of every code (..., values) as sums by slot of every feature (..., slots)."""
        out = np.empty((*joint.shape[:-1], self.starts[-1]))
        for g, (slots, counts) in enumerate(self.of_values):
            out[..., slots] = joint[..., self.spans[g]:self.spans[g + 1]] @ counts
        return out

    def split(self, codes: np.ndarray, rows: np.ndarray | None, feature: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows (without any: all) left and right of a split, in their order."""
        g, bin_of = self.code_of[feature]
        right = (bin_of > last).take(codes[g] if rows is None else codes[g].take(rows))
        return (np.flatnonzero(~right), np.flatnonzero(right)) if rows is None else (rows[~right], rows[right])


def feature_thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """MLlib's candidate thresholds of one continuous feature from a sample of its values."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) <= bins - 1:
        return middles
    stride = len(values) / bins
    chosen, seen, target = [], float(counts[0]), stride
    for i in range(1, len(distinct)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            chosen.append(middles[i - 1])
            target += stride
    return np.array(chosen)


def find_bins(df: DataFrame, rows: int, max_bins: int, seed: int) -> Bins:
    """Thresholds from a sample of about max(max_bins^2, 10,000) rows, MLlib's own bound; every row is binned by them."""
    wanted = max(max_bins * max_bins, 10_000)
    sample = df.select("x") if rows <= wanted else df.select("x").sample(False, wanted / rows, seed)
    x = np.array([r["x"] for r in sample.collect()])
    return Bins(tuple(feature_thresholds(x[:, f], min(max_bins, rows)) for f in range(x.shape[1])))


def packed_blocks(df: DataFrame, bins: Bins, bags: Callable[[int, int, int], bytes] = lambda part, block, rows: b"") -> DataFrame:
    """rows, labels, bags: rows as codes of their bins in blocks, and what ``bags`` gives for the block's partition, number and rows."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            if np.isnan(y).any():
                raise ValueError("labels must not be null or NaN")
            part = batch.column("part")[0].as_py()
            for at in range(0, len(y), BLOCK_ROWS):
                packed = bins.pack(x[at:at + BLOCK_ROWS])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], pa.binary()) for v in (
                        packed.tobytes(), y[at:at + BLOCK_ROWS].astype(float).tobytes(), bags(part, block, len(packed)))],
                    names=["rows", "labels", "bags"])
                block += 1

    return df.withColumn("part", F.spark_partition_id()).mapInArrow(pack, "rows binary, labels binary, bags binary")


def histogram(bins: Bins, columns: np.ndarray, codes: np.ndarray, node: np.ndarray, nodes: int, w: np.ndarray | None, wy: np.ndarray) -> np.ndarray:
    """Weights (without any: rows) and weighted labels by node and slot, all features' bins in a row: an array (2, nodes, slots).

    Among few nodes, the packed features are counted eight at a time, by the byte that holds their bits.
    """
    sizes, flags = bins.sizes, bins.flags
    starts = np.cumsum([0, *sizes])
    out = np.empty((2, nodes, starts[-1]))

    def counted(column: np.ndarray, size: int) -> np.ndarray:
        place = node * size
        place += column
        return np.stack([np.bincount(place, v, nodes * size).reshape(nodes, size) for v in (w, wy)])

    coded = nodes <= CODED_NODES
    for f, size in enumerate(sizes):
        if not (coded and flags[f]):
            out[:, :, starts[f]:starts[f] + size] = counted(columns[f], size)
    for b, code in enumerate(codes if coded else ()):
        by_code = counted(code, 256)
        zeros, ones = by_code @ (1.0 - BITS), by_code @ BITS
        for i, f in enumerate(np.flatnonzero(flags)[8 * b:8 * b + 8]):
            out[:, :, starts[f]] = zeros[:, :, i]
            if sizes[f] == 2:
                out[:, :, starts[f] + 1] = ones[:, :, i]
    return out


def best_splits(hist: np.ndarray, bins: Bins, n: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, ...]:
    """Feature, last bin of the left side, gain in variance, left weight and left sum of each node's best split.

    The first of equal gains wins; a split with an empty side doesn't count (gain minus infinity).
    """
    shape = len(n), len(bins.sizes)
    last, score, left, left_sum = np.zeros(shape, np.int64), np.full(shape, -np.inf), np.zeros(shape), np.zeros(shape)
    n, s = n[:, None, None], s[:, None, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        whole = s * s / n
        for features, slots, valid in bins.cuts:
            ln, ls = (np.cumsum(sums[:, slots], axis=2) for sums in hist)
            rn, rs = n - ln, s - ls
            scores = np.where(valid & (ln > 0) & (rn > 0), (ls * ls / ln + rs * rs / rn - whole) / n, -np.inf)
            b = np.argmax(scores, axis=2)
            last[:, features] = b
            for out, values in ((score, scores), (left, ln), (left_sum, ls)):
                out[:, features] = np.take_along_axis(values, b[:, :, None], axis=2)[:, :, 0]
    feature, every = np.argmax(score, axis=1), np.arange(shape[0])
    return feature, last[every, feature], score[every, feature], left[every, feature], left_sum[every, feature]


def _nodes(tree: int, heap, feature, threshold, gain, n, s, q, raw) -> dict[str, np.ndarray]:
    impurity = np.maximum(q - s * s / n, 0.0) / n
    return dict(zip(NODE_COLUMNS, (np.full(len(heap), tree, np.int32), heap, feature.astype(np.int32), threshold, s / n, impurity, gain, n, s, q, raw)))


def decide(hist: np.ndarray, bins: Bins, n: np.ndarray, s: np.ndarray, q: np.ndarray, deepest: bool):
    """Split, last left bin, threshold, gain, left weight and left sum of every node; feature -1 and gain -1 where it is a leaf."""
    k = len(n)
    if deepest:
        return np.full(k, -1), np.zeros(k, np.int64), np.zeros(k), np.full(k, -1.0), np.zeros(k), np.zeros(k)
    feature, last, gain, left, left_sum = best_splits(hist, bins, n, s)
    leaf = (gain <= 0) | (np.abs((q - s * s / n) / n) < EPSILON)
    feature[leaf], gain[leaf] = -1, -1.0
    threshold = np.array([bins.thresholds[f][b] if f >= 0 else 0.0 for f, b in zip(feature, last)], dtype=float)
    return feature, last, threshold, gain, left, left_sum


def grow_small(tree: int, heap: int, level: int, max_depth: int, bins: Bins, codes: np.ndarray, y: np.ndarray, w: np.ndarray) -> dict[str, np.ndarray]:
    """All nodes of one subtree, level by level, from its rows; every feature is counted by itself."""
    columns = bins.unpack(codes) if level < max_depth else None
    bits = bins.bits(columns) if level < max_depth else None
    w = w.astype(float)
    wy = w * y
    wyy = wy * y
    node, heaps, found = np.zeros(len(y), np.int64), np.array([heap], np.int64), []
    while True:
        k = len(heaps)
        n, s, q = (np.bincount(node, v, k) for v in (w, wy, wyy))
        raw = np.bincount(node, minlength=k)
        deepest = level == max_depth
        hist = None if deepest else histogram(bins, columns, bits, node, k, w, wy)
        feature, last, threshold, gain, _, _ = decide(hist, bins, n, s, q, deepest)
        found.append(_nodes(tree, heaps, feature, threshold, gain, n, s, q, raw))
        split = feature >= 0
        if not split.any():
            return {c: np.concatenate([part[c] for part in found]) for c in NODE_COLUMNS}
        going = split[node]
        if not going.all():
            columns, bits, node, w, wy, wyy = columns[:, going], bits[:, going], node[going], w[going], wy[going], wyy[going]
        right = columns.ravel().take(feature[node] * len(node) + np.arange(len(node))) > last[node]
        node = 2 * (np.cumsum(split) - 1)[node] + right
        heaps = np.stack([2 * heaps[split], 2 * heaps[split] + 1], axis=1).ravel()
        level += 1


def grow_rest(tree: int, heap: int, level: int, max_depth: int, bins: Bins, codes: np.ndarray, y: np.ndarray, w: np.ndarray) -> dict[str, np.ndarray]:
    """What ``grow_small`` does, over narrow codes, counting of every split only the child of fewer rows."""
    if level == max_depth:
        return grow_small(tree, heap, level, max_depth, bins, codes, y, w)
    codes, bins = bins.narrowed(codes), bins.narrow
    code_of, bin_of, apart = bins.bin_table
    w = w.astype(float)
    wy = w * y
    wyy = wy * y
    node, heaps, found = np.zeros(len(y), np.int64), np.array([heap], np.int64), []
    joint = bins.joint_of_nodes(codes, np.arange(len(y)), node, 1, w, wy)
    while True:
        k = len(heaps)
        n, s, q = (np.bincount(node, v, k) for v in (w, wy, wyy))
        raw = np.bincount(node, minlength=k)
        deepest = level == max_depth
        feature, last, threshold, gain, _, _ = decide(None if deepest else bins.separate(joint), bins, n, s, q, deepest)
        found.append(_nodes(tree, heaps, feature, threshold, gain, n, s, q, raw))
        split = feature >= 0
        if not split.any():
            return {c: np.concatenate([part[c] for part in found]) for c in NODE_COLUMNS}
        going = split[node]
        if not going.all():
            codes, node, w, wy, wyy = codes[:, going], node[going], w[going], wy[going], wyy[going]
        code = codes.ravel().take((code_of[feature] * len(node)).take(node) + np.arange(len(node)))
        right = bin_of.take((feature * apart).take(node) + code) > last.take(node)
        node = (2 * (np.cumsum(split) - 1)).take(node) + right
        heaps = np.stack([2 * heaps[split], 2 * heaps[split] + 1], axis=1).ravel()
        level += 1
        if level < max_depth:
            sides = np.bincount(node, minlength=len(heaps)).reshape(-1, 2)
            pairs, fewer = np.arange(len(sides)), (sides[:, 1] < sides[:, 0]).astype(np.int64)
            rows = np.flatnonzero(np.eye(2, dtype=bool)[fewer].ravel().take(node))
            of_fewer = bins.joint_of_nodes(codes, rows, node.take(rows) >> 1, len(pairs), w.take(rows), wy.take(rows))
            children = np.empty((2, len(pairs), 2, joint.shape[2]))
            children[:, pairs, fewer], children[:, pairs, 1 - fewer] = of_fewer, joint[:, split] - of_fewer
            joint = children.reshape(2, len(heaps), -1)


def _whole(y: np.ndarray) -> tuple[np.ndarray, float]:
    """Labels as whole numbers and how many of them make one, if all are whole hundredths; else as they are."""
    for unit in (1.0, 100.0):
        whole = np.rint(y * unit)
        if np.array_equal(whole / unit, y):
            return whole, unit
    return y, 1.0


def grow(tree: int, heap: int, level: int, max_depth: int, bins: Bins, codes: np.ndarray, y: np.ndarray, w: np.ndarray) -> dict[str, np.ndarray]:
    """All nodes of one subtree from its rows.

    Nodes of more than SMALL_ROWS rows are counted by code, and of a split only the child of fewer rows: the other's sums are its
    parent's rest. Smaller nodes are grown by ``grow_rest``. Labels of whole hundredths are summed as whole numbers, so that
    every sum is exact and equal splits stay equal, whatever was counted.
    """
    if len(y) <= SMALL_ROWS or level == max_depth:
        return grow_small(tree, heap, level, max_depth, bins, codes, y, w)
    y, unit = _whole(y)

    def counted(base: tuple, rows: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        codes, label, weight = base if rows is None else (base[0], base[1].take(rows), base[2].take(rows))
        weighted = weight * label
        return np.array([weight.sum(), weighted.sum(), (weighted * label).sum()]), bins.joint(codes, rows, weight, weighted)

    whole = codes, y, w.astype(float)
    found, here = [], [(heap, whole, None, *counted(whole, None))]
    while here:
        n, s, q = np.stack([sums for *_, sums, _ in here], axis=1)
        raw = np.array([len(base[1]) if rows is None else len(rows) for _, base, rows, *_ in here])
        hist = bins.separate(np.stack([joint for *_, joint in here], axis=1))
        feature, last, threshold, gain, _, _ = decide(hist, bins, n, s, q, False)
        found.append(_nodes(tree, np.array([h for h, *_ in here], np.int64), feature, threshold, gain, n, s, q, raw))
        following, level = [], level + 1
        for i in np.flatnonzero(feature >= 0):
            h, base, rows, sums, joint = here[i]
            sides = bins.split(base[0], rows, feature[i], last[i])
            large = [len(side) > SMALL_ROWS and level < max_depth for side in sides]
            if any(large):
                fewer = int(len(sides[1]) < len(sides[0]))
                of_fewer = counted(base, sides[fewer])
                rest = sums - of_fewer[0], joint - of_fewer[1]
            for right, side in enumerate(sides):
                if not large[right] or len(side) < len(base[1]) // 8:  # few of the rows: together they are read faster
                    part, side = tuple(v.take(side, axis=-1) for v in base), None
                if large[right]:
                    following.append((2 * h + right, base if side is not None else part, side, *(of_fewer if right == fewer else rest)))
                else:
                    found.append(grow_rest(tree, 2 * h + right, level, max_depth, bins, *part))
        here = following
    nodes = {c: np.concatenate([part[c] for part in found]) for c in NODE_COLUMNS}
    nodes["gain"] = np.where(nodes["feature"] < 0, nodes["gain"], nodes["gain"] / unit ** 2)
    return nodes | {c: nodes[c] / unit for c in ("prediction", "s")} | {c: nodes[c] / unit ** 2 for c in ("impurity", "q")}


@dataclass
class Top:
    """The upper part of a tree: by heap place (root 1, children 2i and 2i + 1) the split feature, or -1, and its last left bin."""

    feature: np.ndarray
    last: np.ndarray

    def parted(self, bins: Bins, codes: np.ndarray, rows: np.ndarray | None, wanted: set[int] | None = None) -> Iterator[tuple[int, np.ndarray | None]]:
        """The heap places that rows (without any: all) come to, each with its rows in their order; only the ``wanted`` places, if named."""
        above = None if wanted is None else {h >> d for h in wanted for d in range(h.bit_length())}
        stack = [(1, rows)]
        while stack:
            h, rows = stack.pop()
            if wanted is not None and h not in above:
                continue
            if self.feature[h] < 0 or wanted is not None and h in wanted:
                yield h, rows
            else:
                left, right = bins.split(codes, rows, self.feature[h], self.last[h])
                stack += [(2 * h + 1, right), (2 * h, left)]

    def deeper(self) -> Top:
        """The same tree with room for one more level."""
        return Top(np.concatenate([self.feature, np.full(len(self.feature), -1)]), np.concatenate([self.last, np.zeros_like(self.last)]))


def _bag(bootstrap: bool, rate: float, seed: int, tree: int, part: int, block: int, rows: int) -> np.ndarray:
    """How often each row of a block is in the tree's bag: Poisson draws of the tree and the block, as MLlib's are of the partition."""
    rng = np.random.default_rng([seed % 2**32, tree, part, block])
    return rng.poisson(rate, rows).astype(np.uint8) if bootstrap else (rng.random(rows) < rate).astype(np.uint8)


def grow_forest(df: DataFrame, trees: int, max_depth: int, max_bins: int, seed: int, bootstrap: bool = True, rate: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """The nodes (``NODE_SCHEMA``) of a forest over the columns ``x`` (array) and ``y``, and its packed rows to be released."""
    spark, local_rows = df.sparkSession, LOCAL_ROWS
    rows = df.count()
    if rows == 0:
        raise ValueError("no rows to learn from")
    bins = find_bins(df, rows, max_bins, seed)
    bags = lambda *of: b"".join(_bag(bootstrap, rate, seed, t, *of).tobytes() for t in range(trees))
    blocks = packed_blocks(df, bins, bags).persist()  # with every tree's bag, which each pass below reads
    width, slots = len(bins.groups), bins.starts[-1]

    def chunks(batches):
        """Blocks gathered to CHUNK_ROWS rows: their packed rows, labels, and bags (trees, rows)."""
        held, count = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                held.append(r)
                count += len(r["labels"]) // 8
                if count >= CHUNK_ROWS:
                    yield gathered(held)
                    held, count = [], 0
        if held:
            yield gathered(held)

    def gathered(held):
        rows, labels = (b"".join(r[c] for r in held) for c in ("rows", "labels"))
        return (np.frombuffer(rows, np.uint16).reshape(-1, width), np.frombuffer(labels),
                np.concatenate([np.frombuffer(r["bags"], np.uint8).reshape(trees, -1) for r in held], axis=1))

    tops = [Top(np.full(2, -1), np.zeros(2, np.int64)) for _ in range(trees)]
    open_ = {t: np.array([1], np.int64) for t in range(trees)} if rows > local_rows else {}
    local = {t: np.array([1], np.int64) for t in range(trees)} if rows <= local_rows else {t: np.array([], np.int64) for t in range(trees)}
    found, level = [], 0
    while open_:
        state = spark.sparkContext.broadcast((tops, open_))

        def summed(batches):
            tops, open_ = state.value
            totals = {}
            for packed, y, bags in chunks(batches):
                codes = np.ascontiguousarray(packed.T)
                for t, heaps in open_.items():
                    weight = bags[t]
                    here, place = np.zeros((len(heaps), 2 * slots + 4)), {h: i for i, h in enumerate(heaps.tolist())}
                    for h, rows in tops[t].parted(bins, codes, np.flatnonzero(weight), set(place)):
                        w, label = weight.take(rows).astype(float), y.take(rows)
                        wy = w * label
                        here[place[h], :-4] = bins.separate(bins.joint(codes, rows, w, wy)).ravel()
                        here[place[h], -4:] = w.sum(), wy.sum(), (wy * label).sum(), len(rows)
                    totals[t] = totals[t] + here if t in totals else here
            for t, sums in totals.items():
                for at in range(0, len(sums), NODES_A_ROW):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([t], pa.int32()), pa.array([at], pa.int32()), pa.array([sums[at:at + NODES_A_ROW].tobytes()], pa.binary())],
                        names=["tree", "at", "sums"])

        deepest = level == max_depth

        def chosen(table: pa.Table) -> pa.Table:
            t, at = table.column("tree")[0].as_py(), table.column("at")[0].as_py()
            sums = sum(np.frombuffer(b.as_py()).reshape(-1, 2 * slots + 4) for b in table.column("sums"))
            n, s, q, raw = sums[:, -4:].T
            hist = sums[:, :-4].reshape(len(sums), 2, -1).transpose(1, 0, 2)
            feature, last, threshold, gain, left, _ = decide(hist, bins, n, s, q, deepest)
            nodes = _nodes(t, state.value[1][t][at:at + len(sums)], feature, threshold, gain, n, s, q, raw.astype(np.int64))
            return pa.table({**nodes, "last": last, "left": left})

        level_nodes = blocks.mapInArrow(summed, "tree int, at int, sums binary").groupBy("tree", "at").applyInArrow(
            chosen, f"{NODE_SCHEMA}, last bigint, left double").collect()
        tops, following = [top.deeper() for top in tops], {t: [] for t in range(trees)}
        local = {t: list(h) for t, h in local.items()}
        for r in level_nodes:
            found.append(tuple(r[c] for c in NODE_COLUMNS))
            if r["feature"] >= 0:
                t, h = r["tree"], r["heap"]
                tops[t].feature[h], tops[t].last[h] = r["feature"], r["last"]
                for child, n in ((2 * h, r["left"]), (2 * h + 1, r["n"] - r["left"])):
                    (following if n > local_rows else local)[t].append(child)
        open_ = {t: np.array(sorted(h), np.int64) for t, h in following.items() if h}
        local = {t: np.array(sorted(h), np.int64) for t, h in local.items()}
        level += 1

    final = spark.sparkContext.broadcast((tops, local))

    def scattered(batches):
        tops, local = final.value
        for packed, y, bags in chunks(batches):
            codes = np.ascontiguousarray(packed.T)
            for t, heaps in local.items():
                if len(heaps) == 0:
                    continue
                weight = bags[t]
                for h, rows in tops[t].parted(bins, codes, np.flatnonzero(weight), set(heaps.tolist())):
                    if len(rows):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([t], pa.int32()), pa.array([h], pa.int64()),
                             *[pa.array([v.take(rows, axis=0).tobytes()], pa.binary()) for v in (packed, y, weight)]],
                            names=["tree", "heap", "rows", "labels", "weights"])

    def finished(table: pa.Table) -> pa.Table:
        joined = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
        t, heap = table.column("tree")[0].as_py(), table.column("heap")[0].as_py()
        return pa.table(grow(t, heap, heap.bit_length() - 1, max_depth, bins, np.ascontiguousarray(joined("rows", np.uint16).reshape(-1, width).T),
                             joined("labels", float), joined("weights", np.uint8)))

    deep = blocks.mapInArrow(scattered, "tree int, heap bigint, rows binary, labels binary, weights binary").groupBy("tree", "heap").applyInArrow(
        finished, NODE_SCHEMA)
    return (spark.createDataFrame(found, NODE_SCHEMA).unionByName(deep) if found else deep), blocks


@dataclass
class Boosted:
    """A tree of a boosted model as each row reads it: splits, and the prediction of every heap place."""

    top: Top
    value: np.ndarray
    weight: float


def _advanced(block: tuple, trees: list[Boosted], bins: Bins) -> tuple:
    """A block (codes, labels, predictions) with more trees added to its predictions, in their order."""
    codes, y, predicted = block
    predicted = predicted.copy()
    for tree in trees:
        for h, rows in tree.top.parted(bins, codes, None):
            if rows is None:
                predicted += tree.weight * tree.value[h]
            else:
                predicted[rows] = predicted.take(rows) + tree.weight * tree.value[h]
    return codes, y, predicted


def _level_sums(blocks: Iterator[tuple], bins: Bins, top: Top, heaps: np.ndarray, large: np.ndarray, first: bool) -> Iterator[np.ndarray]:
    """Histograms of the residuals at the given heap places, and each place's weight, sum and squares: one array a task.

    ``large`` says which places are counted by code; the others' features are counted one by one.
    """
    place, total, joint = {h: i for i, h in enumerate(heaps.tolist())}, 0.0, {}
    for codes, y, predicted in blocks:
        label = y if first else 2.0 * (y - predicted)
        here, small = np.zeros((len(heaps), 2 * bins.starts[-1] + 3)), []
        for h, rows in top.parted(bins, codes, None, set(place)):
            if not large[place[h]]:
                small.append((place[h], np.arange(len(y)) if rows is None else rows))
                continue
            mine = label if rows is None else label.take(rows)
            sums = bins.joint(codes, rows, None, mine)
            joint[h] = joint[h] + sums if h in joint else sums
            here[place[h], -3:] = len(mine), mine.sum(), (mine * mine).sum()
        if small:
            rows = np.concatenate([r for _, r in small])
            node, mine, k = np.repeat(np.arange(len(small)), [len(r) for _, r in small]), label[rows], len(small)
            columns, ones = bins.unpack(codes[:, rows]), np.ones(len(rows))
            here[[i for i, _ in small]] = np.concatenate([
                histogram(bins, columns, bins.bits(columns), node, k, None, mine).transpose(1, 0, 2).reshape(k, -1),
                np.stack([np.bincount(node, v, k) for v in (ones, mine, mine * mine)], axis=1)], axis=1)
        total = total + here
    for h, sums in joint.items():
        total[place[h], :-3] = bins.separate(sums).ravel()
    if not isinstance(total, float):
        yield total


def boost(df: DataFrame, rounds: int, max_depth: int, step: float, max_bins: int, seed: int) -> DataFrame:
    """The nodes (``NODE_SCHEMA``) of MLlib's gradient boosting of squared errors over the columns ``x`` and ``y``.

    The first tree learns the labels with weight 1, each later one twice the residuals with weight ``step``.
    The deepest leaves' impurity isn't measured and is stored as 0. Of a split of more than DIRECT_ROWS rows, only the
    lighter child's histogram is counted; the other's is its parent's rest.
    """
    rows = df.count()
    if rows == 0:
        raise ValueError("no rows to learn from")
    bins = find_bins(df, rows, max_bins, seed)
    blocks = packed_blocks(df, bins).persist()
    width, gathered = len(bins.groups), CHUNK_ROWS if rows > DIRECT_ROWS else 1

    def opened(records):
        held, count = [], 0
        for r in records:
            held.append(r)
            count += len(r["labels"]) // 8
            if count >= gathered:
                yield joined(held)
                held, count = [], 0
        if held:
            yield joined(held)

    def joined(held):
        packed = np.frombuffer(b"".join(r["rows"] for r in held), np.uint16).reshape(-1, width)
        y = np.frombuffer(b"".join(r["labels"] for r in held))
        return np.ascontiguousarray(packed.T), y, np.zeros(len(y))

    base = blocks.select("rows", "labels").rdd.mapPartitions(opened)
    trees, found, state = [], [], None
    try:
        for m in range(rounds):
            behind, since = (base, list(trees)) if m % REBUILD == 0 else (state, trees[-1:])
            following = behind.map(lambda b, since=since: _advanced(b, since, bins)).persist(StorageLevel.MEMORY_AND_DISK_DESER)  # as it is, not compressed
            top, value = Top(np.full(2, -1), np.zeros(2, np.int64)), np.zeros(2)
            heaps, counted, known = np.array([1], np.int64), np.array([1], np.int64), {}
            large = np.array([rows > DIRECT_ROWS])
            for level in range(max_depth):
                sums = following.mapPartitions(lambda it, a=(bins, top, counted, large, m == 0): _level_sums(it, *a)).reduce(np.add)
                here = dict(zip(counted.tolist(), sums))
                for h in heaps.tolist():
                    if h not in here:
                        here[h] = known[h // 2] - here[h ^ 1]
                known = here
                sums = np.stack([here[h] for h in heaps.tolist()])
                n, s, q = sums[:, -3:].T
                hist = sums[:, :-3].reshape(len(sums), 2, -1).transpose(1, 0, 2)
                feature, last, threshold, gain, left, left_sum = decide(hist, bins, n, s, q, False)
                nodes = _nodes(m, heaps, feature, threshold, gain, n, s, q, n.astype(np.int64))
                found += zip(*[nodes[c].tolist() for c in NODE_COLUMNS])
                top.feature[heaps], top.last[heaps], value[heaps] = feature, last, s / n
                split = feature >= 0
                if not split.any():
                    break
                top, value = top.deeper(), np.concatenate([value, np.zeros(len(value))])
                first, lighter = 2 * heaps[split], (left > n - left)[split]
                heaps = np.stack([first, first + 1], axis=1).ravel()
                counted = np.sort(np.concatenate([first + lighter, (first + 1 - lighter)[n[split] <= DIRECT_ROWS]]))
                # The children's weights and sums, which are all that the deepest leaves need.
                ln, ls = left[split], left_sum[split]
                n, s = np.stack([ln, n[split] - ln], axis=1).ravel(), np.stack([ls, s[split] - ls], axis=1).ravel()
                large = n[np.isin(heaps, counted)] > DIRECT_ROWS
            else:
                nodes = _nodes(m, heaps, np.full(len(n), -1), np.zeros(len(n)), np.full(len(n), -1.0), n, s, s * s / n, n.astype(np.int64))
                found += zip(*[nodes[c].tolist() for c in NODE_COLUMNS])
                value[heaps] = s / n
            trees.append(Boosted(top, value, 1.0 if m == 0 else step))
            if state is not None:
                state.unpersist()
            state = following
    finally:
        if state is not None:
            state.unpersist()
        blocks.unpersist()
    return df.sparkSession.createDataFrame(found, NODE_SCHEMA)


def _numbered(table: pa.Table) -> pa.Table:
    """One tree's nodes with MLlib's ids: from 0, a child's above its parent's."""
    order = np.argsort(table.column("heap").to_numpy())
    table = table.take(order)
    heap, leaf = table.column("heap").to_numpy(), table.column("feature").to_numpy() < 0
    child = lambda side: np.where(leaf, -1, np.searchsorted(heap, 2 * heap + side)).astype(np.int32)
    return table.append_column("id", pa.array(np.arange(len(heap), dtype=np.int32))).append_column(
        "left", pa.array(child(0))).append_column("right", pa.array(child(1)))


def write_model(spark: SparkSession, estimator, nodes: DataFrame, trees: int, features: int, weights: list[float]) -> str:
    """The folder of MLlib's own model of the nodes: written in its format beside a small fitted template's metadata."""
    path = f"{shared_root(spark)}/models/trees-{uuid.uuid4().hex}"
    tiny = spark.createDataFrame([(Vectors.dense([float(v)] * features), float(v)) for v in range(2)], [estimator.getFeaturesCol(), estimator.getLabelCol()])
    template = estimator.template().fit(tiny)
    template.write().save(f"{path}/template")
    meta = json.loads(spark.read.text(f"{path}/template/metadata").first()[0])
    meta["paramMap"] = {p.name: v for p, v in estimator.extractParamMap().items() if estimator.isSet(p)}
    meta["numTrees"] = trees
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    about = json.loads(spark.read.parquet(f"{path}/template/treesMetadata").first()[1])
    about["paramMap"] = {"maxDepth": estimator.getMaxDepth()}
    spark.createDataFrame([(t, json.dumps(about), w) for t, w in zip(range(trees), weights)], "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    leaf = F.col("feature") < 0
    data = nodes.groupBy("tree").applyInArrow(_numbered, f"{NODE_SCHEMA}, id int, left int, right int").select(
        F.col("tree").alias("treeID"),
        F.struct(
            "id", "prediction", "impurity", F.array("n", "s", "q").alias("impurityStats"), F.col("raw").alias("rawCount"), "gain",
            F.col("left").alias("leftChild"), F.col("right").alias("rightChild"),
            F.struct(
                F.col("feature").alias("featureIndex"),
                F.when(leaf, F.array().cast("array<double>")).otherwise(F.array("threshold")).alias("leftCategoriesOrThreshold"),
                F.lit(-1).alias("numCategories")).alias("split")).alias("nodeData"))
    data.write.parquet(f"{path}/model/data")
    return f"{path}/model"


def _as_arrays(table: pa.Table) -> pa.Table:
    """One tree's nodes by id as bytes: feature, threshold (a leaf's prediction) and both children (a leaf's are itself)."""
    table = table.take(np.argsort(table.column("id").to_numpy()))
    feature, own = table.column("feature").to_numpy().astype(np.int32), np.arange(table.num_rows, dtype=np.int32)
    leaf = feature < 0
    value = np.where(leaf, table.column("prediction").to_numpy(), table.column("threshold").to_numpy())
    children = np.stack([np.where(leaf, own, table.column(c).to_numpy()) for c in ("left", "right")], axis=1).astype(np.int32)
    return pa.table({"tree": table.column("tree")[:1], **{c: pa.array([v.tobytes()], pa.binary()) for c, v in (
        ("feature", feature), ("value", value), ("children", children))}})


def node_arrays(spark: SparkSession, path: str) -> list[tuple[np.ndarray, ...]]:
    """Every tree of a written model, in order, as arrays of ``_as_arrays``: 20 bytes a node."""
    n = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("id"), n["prediction"].alias("prediction"), n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"), n["leftChild"].alias("left"), n["rightChild"].alias("right"))
    rows = nodes.groupBy("tree").applyInArrow(_as_arrays, "tree int, feature binary, value binary, children binary").collect()
    return [(np.frombuffer(r["feature"], np.int32), np.frombuffer(r["value"]), np.frombuffer(r["children"], np.int32)) for r in sorted(rows, key=lambda r: r["tree"])]


def mean_prediction(x: np.ndarray, trees: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    """The trees' mean prediction of rows of features, added up in the trees' order as MLlib does."""
    x, total = np.ascontiguousarray(x), np.zeros(len(x))
    flat, starts = x.ravel(), np.arange(len(x)) * x.shape[1]
    for feature, value, children in trees:
        children, node = children.ravel(), np.zeros(len(x), np.int64)
        while True:
            f = feature[node]
            if (f < 0).all():
                break
            right = ~(flat[starts + np.maximum(f, 0)] <= value[node])
            node = children[2 * node + right]
        total += value[node]
    return total / len(trees)


class RandomForestRegressionModel(regression.RandomForestRegressionModel):
    """MLlib's model of a written forest that predicts from arrays of its nodes.

    MLlib sends a forest to the executors as an object graph, which for millions of nodes takes longer than all of
    their predictions; here its arrays travel. MLlib's own model is loaded only for what else asks for it
    (importances, saving).
    """

    def __init__(self, path: str, trees):
        self._path, self._trees, self._loaded = path, trees, None
        super().__init__()

    @property
    def _java_obj(self):
        if self._loaded is None:
            self._loaded = regression.RandomForestRegressionModel.load(self._path)
        return self._loaded._java_obj

    @_java_obj.setter
    def _java_obj(self, java_obj) -> None:
        if java_obj is not None:  # a copy's
            self._loaded = regression.RandomForestRegressionModel(java_obj)

    def __del__(self) -> None:
        pass  # what is loaded releases itself

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = self._trees

        def predict(x: pa.Array) -> pa.Array:
            if len(x) == 0:
                return pa.array([], pa.float64())
            return pa.array(mean_prediction(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1), trees.value))

        return dataset.withColumn(self.getPredictionCol(), F.arrow_udf(predict, "double")(vector_to_array(self.getFeaturesCol())))


class Forest(RandomForestRegressor):
    """MLlib's random forest (all features at every split) whose fit moves a small node's rows instead of its histograms."""

    def template(self) -> RandomForestRegressor:
        return RandomForestRegressor(numTrees=1, maxDepth=1, featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol())

    def _fit(self, dataset: DataFrame) -> RandomForestRegressionModel:
        df = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        features = len(df.first()["x"])
        nodes, blocks = grow_forest(df, self.getNumTrees(), self.getMaxDepth(), self.getMaxBins(), self.getSeed(), self.getBootstrap(), self.getSubsamplingRate())
        try:
            path = write_model(df.sparkSession, self, nodes, self.getNumTrees(), features, [1.0] * self.getNumTrees())
        finally:
            blocks.unpersist()
        trees = df.sparkSession.sparkContext.broadcast(node_arrays(df.sparkSession, path))
        return self._copyValues(RandomForestRegressionModel(path, trees))


class Boosting(GBTRegressor):
    """MLlib's gradient boosting of squared errors (all rows and features in every round) over packed blocks."""

    def template(self) -> GBTRegressor:
        return GBTRegressor(maxIter=1, maxDepth=1, featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol())

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        df = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        rounds, step = self.getMaxIter(), self.getStepSize()
        nodes = boost(df, rounds, self.getMaxDepth(), step, self.getMaxBins(), self.getSeed())
        features = len(df.first()["x"])
        return GBTRegressionModel.load(write_model(df.sparkSession, self, nodes, rounds, features, [1.0] + [step] * (rounds - 1)))
