"""Random forests that are grown where the rows are.

The algorithm is that of Spark ML's forest (Poisson bags, a random subset of
features for each node, bins in order or as categories, Gini gain, pruning of
leaves that choose alike, leaves that vote with their class shares, importances
by gain), but no tree passes through the driver and no statistics of empty bins
through a shuffle:

* a node with more than ``LOCAL_ROWS`` rows is split by sums over all
  partitions (``_grow_top``), level by level for all trees at once;
* the rows of every other node go to one task, which grows all that is below it
  in memory (``grow``). Its nodes are written to the checkpoint folder.

A row's weight in a tree follows from (seed, tree, place of the row), a node's
features from (seed, tree, place of the node), and all sums are integers: the
forest does not depend on partitions, tasks or ``LOCAL_ROWS``.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavolo.session import ensure_checkpoint_dir

#: The column of the row's place in the canonical order.
PLACE = "_place"
#: Rows in the bag of a node that one task grows on its own.
LOCAL_ROWS = 500_000
#: Cells (node, feature, bin, class) that are summed at once.
CELLS = 2_000_000
#: Distinct rows of a node up to which cuts are tried at the rows, not at all bins.
FEW_ROWS = (4, 8, 16, 32)
#: Rows to predict that meet the trees of a part in one task, about.
PREDICT_ROWS = 1_000_000
#: Grid of votes and gains: their sums are exact in any order.
VOTE_GRID, GAIN_GRID = 1 << 40, 1 << 20

#: Poisson(1): P(at most k), in steps of 2 ** -64.
_POISSON = np.array([min(int(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) * 2**64), 2**64 - 1) for k in range(17)], np.uint64)

Top = dict[int, dict[int, tuple]]


# ---------------------------------------------------------------- draws

def _mixed(x: np.ndarray) -> np.ndarray:
    """The finisher of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _key(seed: int, tree: int, what: int) -> np.uint64:
    return _mixed(np.array([(seed * 0x9E3779B97F4A7C15 + tree * 0xD1B54A32D192ED03 + what) % 2**64], np.uint64))[0]


def _stirred(place: np.ndarray) -> np.ndarray:
    return _mixed(place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))


def bag(stirred: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is in the bag of ``tree``; ``stirred`` as from ``_stirred``."""
    return np.searchsorted(_POISSON, _mixed(stirred ^ _key(seed, tree, 1)), side="right").astype(np.uint8)


def subsets(heap: np.ndarray, seed: int, tree: int, n_features: int, k: int) -> np.ndarray:
    """The ``k`` features that each node may be split by; ``heap`` numbers a node by its path from the root (1). A reservoir sample
    as in Spark, whose order decides between equal cuts."""
    of_node = _mixed(heap.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ _key(seed, tree, 2))
    chosen = np.repeat(np.arange(k)[None, :], len(heap), axis=0)
    for f in range(k, n_features):
        drawn = _mixed(of_node + np.uint64(f * 0xD1B54A32D192ED03 % 2**64)) >> np.uint64(32)
        at = (drawn * np.uint64(f + 1) >> np.uint64(32)).astype(np.int64)
        some = np.flatnonzero(at < k)
        chosen[some, at[some]] = f
    return chosen


# ---------------------------------------------------------------- cuts

#: What the bins of a feature are: numbers in order, or categories (as Bucketizer marks its bins). Few categories: their number.
NUMBERS, CATEGORIES = 0, -1

#: Best cut of each node: (feature's place, score, left counts, whether a bin is to the left).
Cuts = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def feature_kinds(train: DataFrame, features: Sequence[str], n_rows: int, n_classes: int, max_bins: int) -> np.ndarray:
    """As Spark's forest reads the columns' attributes. Up to six categories (of 64 bins) and more than two classes: all subsets are tried."""
    few = int(math.log2(min(max_bins, n_rows) // 2 + 1) + 1) if n_classes > 2 else 0
    kinds = []
    for c in features:
        of = train.schema[c].metadata.get("ml_attr", {})
        n = len(of.get("vals", ())) if of.get("type") == "nominal" else 0
        kinds.append(NUMBERS if n < 2 else n if n <= few else CATEGORIES)
    return np.array(kinds)


def _scores(left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Squared class counts by rows, added up over both sides of each cut with ``left`` (node, ..., class) counts: the larger, the purer. -1 where a side is empty."""
    spread = total.reshape(len(total), *[1] * (left.ndim - 2), total.shape[1])
    n, n_left = total.sum(1).reshape(-1, *[1] * (left.ndim - 2)), left.sum(-1)
    square = np.einsum("...c,...c->...", left, left)
    square_right = (total * total).sum(1).reshape(n.shape) - 2 * (left * spread).sum(-1) + square
    n_right = n - n_left
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where((n_left > 0) & (n_right > 0), square / n_left + square_right / n_right, -1.0)


def _keys(counts: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """The order that bins of (..., class) ``counts`` are tried in, then by number: categories by their impurity (of two classes: by the second one's
    rows), empty ones last."""
    n = counts.sum(-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        key = counts[..., 1] if counts.shape[-1] == 2 else -np.einsum("...c,...c->...", counts, counts) / (n * n)  # one rounding: equal in any order
    return np.where(kinds.reshape(*kinds.shape, *[1] * (n.ndim - kinds.ndim)) == NUMBERS, 0.0, np.where(n > 0, key, np.inf))


def _best_of_bins(counts: np.ndarray, kinds: np.ndarray, n_out: int) -> Cuts:
    """From (node, feature, bin, class) counts and the ``kinds`` (node, feature)."""
    m, k, n_bins, n_classes = counts.shape
    each = np.arange(m)
    place = np.argsort(_keys(counts, kinds), axis=2, kind="stable")
    left = np.take_along_axis(counts, place[..., None], axis=2).cumsum(axis=2)
    total = left[:, 0, -1]
    subset: dict[int, np.ndarray] = {}
    for few in np.unique(kinds[kinds > 0]).tolist():
        subset[few] = (np.arange(1, 1 << (few - 1))[:, None] >> np.arange(few)[None, :]) & 1 > 0
        if len(subset[few]) > left.shape[2]:
            left = np.concatenate([left, np.broadcast_to(left[:, :, -1:], (m, k, len(subset[few]) - left.shape[2], n_classes))], axis=2)
    for few, sets in subset.items():
        own = np.nonzero(kinds == few)
        cells = np.zeros((len(own[0]), few, n_classes))
        cells[:, :min(few, n_bins)] = counts[own][:, :few]
        left[own] = left[own][:, -1:]  # all rows: no cut
        left[own[0], own[1], :len(sets)] = np.einsum("sb,nbc->nsc", sets.astype(np.float64), cells)
    score = _scores(left, total).reshape(m, -1)
    best = score.argmax(1)  # the first of equal ones: the earlier feature, then the earlier cut
    j, cut = np.divmod(best, left.shape[2])
    to_left = np.zeros((m, max(n_out, n_bins)), bool)
    np.put_along_axis(to_left, place[each, j], np.arange(n_bins)[None, :] <= cut[:, None], axis=1)
    for few, sets in subset.items():
        own = np.flatnonzero((kinds[each, j] == few) & (score[each, best] > 0))
        to_left[own] = False
        to_left[own, :few] = sets[cut[own]]
    return j, score[each, best], left[each, j, cut], to_left[:, :n_out]


def _best_of_rows(bins: np.ndarray, shares: np.ndarray, kinds: np.ndarray, n_out: int) -> Cuts:
    """The same from the rows themselves, without sets of few categories: ``bins`` (node, feature, row), ``shares`` (node, row, class) with zeros for no row."""
    each = np.arange(len(bins))
    of_bin = (bins[:, :, None, :] == bins[:, :, :, None]).astype(np.float64) @ shares[:, None]
    key = _keys(of_bin, kinds)
    ahead, mine = key[:, :, None, :], key[:, :, :, None]
    upto = (ahead < mine) | ((ahead == mine) & (bins[:, :, None, :] <= bins[:, :, :, None]))
    left = upto.astype(np.float64) @ shares[:, None]
    score = _scores(left, shares.sum(1))
    of_feature = score.max(2)
    j = of_feature.argmax(1)
    value = of_feature[each, j]
    row = np.where(score[each, j] == value[:, None], upto[each, j].sum(2), bins.shape[2] + 1).argmin(1)
    to_left = np.zeros((len(bins), n_out), bool)
    at, r = np.nonzero(upto[each, j, row])
    to_left[at, bins[at, j[at], r]] = True
    numbers = np.flatnonzero(kinds[each, j] == NUMBERS)
    to_left[numbers] = np.arange(n_out)[None, :] <= bins[each, j, row][numbers, None]
    return j, value, left[each, j, row], to_left


def _best_cuts(x: np.ndarray, y: np.ndarray, w: np.ndarray, start: np.ndarray, size: np.ndarray, feats: np.ndarray, kinds: np.ndarray,
               n_bins: int, n_classes: int, n_out: int) -> Cuts:
    """Best cut of each node; its rows are ``size`` many from ``start`` on."""
    m, k = feats.shape
    j, score, left, to_left = np.zeros(m, np.int64), np.zeros(m), np.zeros((m, n_classes)), np.zeros((m, n_out), bool)
    of_node = kinds[feats]
    by_rows = (of_node <= 0).all(1)

    def take(nodes: np.ndarray, found: Cuts) -> None:
        j[nodes], score[nodes], left[nodes], to_left[nodes] = found

    low, rest = 0, ~by_rows
    for most in FEW_ROWS:
        nodes = np.flatnonzero(by_rows & (size > low) & (size <= most))
        low = most
        step = max(1, CELLS // (k * most * (most + n_classes)))
        for some in (nodes[i:i + step] for i in range(0, len(nodes), step)):
            there = np.arange(most)[None, :] < size[some][:, None]
            rows = np.where(there, start[some][:, None] + np.arange(most)[None, :], start[some][:, None])  # past the end: the first again, at no weight
            shares = np.zeros((len(some), most, n_classes))
            np.put_along_axis(shares, y[rows][:, :, None], np.where(there, w[rows], 0)[:, :, None].astype(np.float64), axis=2)
            take(some, _best_of_rows(x[rows[:, None, :], feats[some][:, :, None]], shares, of_node[some], n_out))
    nodes = np.flatnonzero(rest | (size > low))
    step = max(1, CELLS // (k * n_bins * n_classes))
    for some in (nodes[i:i + step] for i in range(0, len(nodes), step)):
        slot = np.repeat(np.arange(len(some)), size[some])
        rows = np.arange(len(slot)) + np.repeat(start[some] - (size[some].cumsum() - size[some]), size[some])
        take(some, _best_of_bins(_counted(x, y, w.astype(np.float64), rows, slot, feats[some], n_bins, n_classes), of_node[some], n_out))
    return j, score, left, to_left


def _counted(x, y, w, rows, slot, feats, n_bins: int, n_classes: int) -> np.ndarray:
    """Weights by (node, feature, bin, class); ``rows`` of ``x``, each for the node ``slot``."""
    m, k = feats.shape
    flat, width = x.reshape(-1), x.shape[1]
    first, cell, weight = rows * width, slot * (k * n_bins * n_classes) + y[rows], w[rows]
    counts = np.zeros(m * k * n_bins * n_classes)
    for i in range(k):
        counts += np.bincount(cell + (i * n_bins + flat[first + feats[slot, i]].astype(np.int64)) * n_classes, weights=weight, minlength=len(counts))
    return counts.reshape(m, k, n_bins, n_classes)


def _gains(score: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Gini gain times the rows of the node; 0 for no cut and for what is only rounding."""
    n = total.sum(1)
    gain = score - (total * total).sum(1) / np.where(n > 0, n, 1)
    return np.where((score > 0) & (gain > 8 * np.finfo(float).eps * n), gain, 0.0)


def _on_grid(gain: np.ndarray) -> np.ndarray:
    return np.rint(gain * GAIN_GRID).astype(np.int64)


def _splittable(counts: np.ndarray, heap: np.ndarray, max_depth: int) -> np.ndarray:
    """Nodes of more than one class above the last level."""
    return (counts.max(1) < counts.sum(1)) & (heap < 1 << max_depth)


# ---------------------------------------------------------------- one piece

def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, kinds: np.ndarray, heap: int, seed: int, tree: int, k: int, n_classes: int, max_depth: int,
         n_out: int) -> tuple[dict, np.ndarray]:
    """The nodes below and with node ``heap``, and the gains by feature. ``x`` (row, feature) has bins, ``w`` the rows' weights (over 0).
    Of a node: ``feature`` (-1: a leaf), ``cut`` (a bit for each of ``n_out`` bins: to the left), ``left`` (its left child, the right one follows;
    a leaf's number); ``votes`` has the class counts of the leaves. All nodes of a level are split at once; rows lie by node."""
    n_features, n_bins = x.shape[1], int(x.max(initial=0)) + 1
    levels: list[list[np.ndarray]] = []
    counts, heaps = np.bincount(y, weights=w, minlength=n_classes)[None, :], np.array([heap], np.int64)
    may, size = np.flatnonzero(_splittable(counts, heaps, max_depth) & (n_bins > 1)), np.array([len(y)])  # nodes to split, and their rows, one node after the other
    size = size[:len(may)]
    while len(heaps):
        feature, cut, gain = np.full(len(heaps), -1, np.int16), np.zeros((len(heaps), -(-n_out // 8)), np.uint8), np.zeros(len(heaps), np.int64)
        levels.append([feature, cut, gain, counts])
        if not len(may):
            break
        feats = subsets(heaps[may], seed, tree, n_features, k)
        j, score, left, bits = _best_cuts(x, y, w, size.cumsum() - size, size, feats, kinds, n_bins, n_classes, n_out)
        gained = _gains(score, counts[may])
        good = gained > 0
        split = may[good]
        if not len(split):
            break
        feature[split], cut[split], gain[split] = feats[good, j[good]], np.packbits(bits[good], axis=1, bitorder="little"), _on_grid(gained[good])
        if not good.all():
            on = np.repeat(good, size)
            x, y, w, size = x[on], y[on], w[on], size[good]
        heaps = (2 * heaps[split][:, None] + np.arange(2)[None, :]).reshape(-1)
        counts = np.stack([left[good], counts[split] - left[good]], 1).reshape(-1, n_classes)
        # the rows to the left come first within their node
        slot, begin, each = np.repeat(np.arange(len(split)), size), size.cumsum() - size, np.arange(len(y))
        to_left = bits[good].reshape(-1)[slot * n_out + x.reshape(-1)[each * n_features + feature[split][slot]]]
        n_left, ran = np.add.reduceat(to_left.astype(np.int64), begin), to_left.cumsum()
        lefts = ran - (ran[begin] - to_left[begin])[slot]  # of the node, up to and with the row
        order = np.empty(len(y), np.int64)
        order[np.where(to_left, begin[slot] + lefts - 1, n_left[slot] + each - lefts)] = each
        size = np.stack([n_left, size - n_left], 1).reshape(-1)
        keep = _splittable(counts, heaps, max_depth)
        order, size, may = order[np.repeat(keep, size)], size[keep], np.flatnonzero(keep)
        x, y, w = x[order], y[order], w[order]
    return _pruned(levels, n_features, n_classes)


def _pruned(levels: list[list[np.ndarray]], n_features: int, n_classes: int) -> tuple[dict, np.ndarray]:
    """The nodes as in ``grow``, where two leaves of one node that choose the same class become one, again and again, as in Spark."""
    kept = [np.ones(len(level[0]), bool) for level in levels]
    for i in range(len(levels) - 2, -1, -1):
        feature, below = levels[i][0], levels[i + 1]
        split = np.flatnonzero(feature >= 0)
        leaf, choice = (below[0] < 0).reshape(-1, 2), below[3].argmax(1).reshape(-1, 2)
        same = leaf.all(1) & (choice[:, 0] == choice[:, 1])
        feature[split[same]] = -1
        kept[i + 1] = np.repeat(~same, 2)
    out: list[tuple[np.ndarray, ...]] = []
    votes, gains, n_nodes, n_leaves = [], np.zeros(n_features, np.int64), 0, 0
    for (feature, cut, gain, counts), keep in zip(levels, kept):
        feature, cut, gain, counts = feature[keep], cut[keep], gain[keep], counts[keep]
        n_nodes += len(feature)
        ends, child = feature < 0, np.zeros(len(feature), np.int32)
        child[~ends] = n_nodes + 2 * np.arange((~ends).sum())
        child[ends] = n_leaves + np.arange(ends.sum())
        n_leaves += int(ends.sum())
        np.add.at(gains, feature[~ends], gain[~ends])
        votes.append(counts[ends].astype(np.int64))
        out.append((feature, cut, child))
    feature, cut, child = (np.concatenate(c) for c in zip(*out))
    return {"feature": feature, "cut": cut, "left": child, "votes": np.concatenate(votes)}, gains


def _packed(piece: dict) -> bytes:
    return zlib.compress(pickle.dumps(piece, protocol=5), 1)


def _unpacked(blob: bytes) -> dict:
    return pickle.loads(zlib.decompress(blob))


def _is_left(cut: np.ndarray, at: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return (cut.reshape(-1)[at * cut.shape[1] + (bins >> 3)] >> (bins & 7)) & 1 > 0


def _leaves(piece: dict, x: np.ndarray) -> np.ndarray:
    """The number of each row's leaf."""
    at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    flat, width = x.reshape(-1), x.shape[1]
    out = np.zeros(len(x), np.int64)
    while len(rows):
        feature = piece["feature"][at]
        ends = feature < 0
        if ends.any():
            out[rows[ends]] = piece["left"][at[ends]]
            rows, at, feature = rows[~ends], at[~ends], feature[~ends]
        at = piece["left"][at] + ~_is_left(piece["cut"], at, flat[rows * width + feature])
    return out


def _votes_of(counts: np.ndarray) -> np.ndarray:
    """Class shares on the grid."""
    return np.rint(counts / np.maximum(counts.sum(-1, keepdims=True), 1) * VOTE_GRID).astype(np.int64)


def _routed(nodes: dict[int, tuple], x: np.ndarray, rows: np.ndarray, heap: int = 1) -> Iterator[tuple[int, np.ndarray]]:
    """Where ``rows`` come out of the top of a tree: (node, rows)."""
    node = nodes.get(heap)
    if node is None or node[0] < 0 or not len(rows):
        yield heap, rows
        return
    to_left = node[1][x[rows, node[0]]]
    yield from _routed(nodes, x, rows[to_left], 2 * heap)
    yield from _routed(nodes, x, rows[~to_left], 2 * heap + 1)


def _bins(batch: pa.RecordBatch, features: Sequence[str]) -> np.ndarray:
    x = np.empty((batch.num_rows, len(features)), np.uint8)
    for i, c in enumerate(features):
        values = batch.column(c).to_numpy(zero_copy_only=False)
        x[:, i] = values
        if (x[:, i] != values).any():
            raise ValueError(f"{c} is not cut into at most 256 bins")
    return x


# ---------------------------------------------------------------- growing

def _top_counts(top: Top, open_: list[tuple[int, int]], features: Sequence[str], label: str, seed: int, k: int, n_bins: int, n_classes: int):
    """Sums of a partition for the nodes that are split by sums: (slot, counts)."""
    slots = {node: i for i, node in enumerate(open_)}
    trees = sorted({t for t, _ in open_})
    feats = {(t, h): subsets(np.array([h]), seed, t, len(features), k) for t, h in open_}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _bins(batch, features), batch.column(label).to_numpy().astype(np.int64)
            stirred = _stirred(batch.column(PLACE).to_numpy())
            for t in trees:
                w = bag(stirred, seed, t).astype(np.float64)
                for h, rows in _routed(top.get(t, {}), x, np.flatnonzero(w)):
                    if (t, h) in slots and len(rows):
                        found = _counted(x, y, w, rows, np.zeros(len(rows), np.int64), feats[t, h], n_bins, n_classes)[0].astype(np.int64)
                        i = slots[t, h]
                        total[i] = total[i] + found if i in total else found
        for i, found in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([zlib.compress(found.tobytes(), 1)], pa.binary())], names=["slot", "counts"])

    return run


def _top_cuts(shape: tuple[int, ...], kinds: list[np.ndarray]):
    """The best cut of a node from the sums of all partitions; ``kinds`` by slot."""
    def run(group: pa.Table) -> pa.Table:
        counts = np.zeros(shape, np.int64)
        for blob in group.column("counts"):
            counts += np.frombuffer(zlib.decompress(blob.as_py()), np.int64).reshape(shape)
        j, score, left, to_left = _best_of_bins(counts[None].astype(np.float64), kinds[group.column("slot")[0].as_py()][None], shape[1])
        total = counts[0].sum(0)
        return pa.table({"slot": group.column("slot")[:1], "j": pa.array(j, pa.int32()), "cut": pa.array([to_left[0].tobytes()], pa.binary()), "gain": pa.array(_gains(score, total[None].astype(np.float64))),
                         "total": pa.array([total.tolist()], pa.list_(pa.int64())), "left": pa.array([left[0].astype(np.int64).tolist()], pa.list_(pa.int64()))})

    return run


def _grow_top(train: DataFrame, features: Sequence[str], kinds: np.ndarray, label: str, n_rows: int, n_classes: int, num_trees: int, max_depth: int, seed: int,
              k: int, max_bins: int) -> Top:
    """The nodes of more than ``LOCAL_ROWS`` rows: (feature, whether a bin is to the left, class counts, gain), as a leaf
    (-1, None, class counts, 0). The driver holds no others."""
    top: Top = {}
    open_ = [(t, 1) for t in range(num_trees)] if n_rows > LOCAL_ROWS else []
    shape = (k, max_bins + 1, n_classes)
    while open_:
        of_slot = [kinds[subsets(np.array([h]), seed, t, len(features), k)[0]] for t, h in open_]
        found = (train.select(PLACE, label, *features).mapInArrow(_top_counts(top, open_, features, label, seed, *shape), "slot int, counts binary")
                 .groupBy("slot").applyInArrow(_top_cuts(shape, of_slot), "slot int, j int, cut binary, gain double, total array<long>, left array<long>").collect())
        grown = []
        for r in found:  # a row for each node of over LOCAL_ROWS rows
            t, h = open_[r["slot"]]
            if r["gain"] <= 0:
                top.setdefault(t, {})[h] = (-1, None, r["total"], 0)
                continue
            f = int(subsets(np.array([h]), seed, t, len(features), k)[0, r["j"]])
            top.setdefault(t, {})[h] = (f, np.frombuffer(r["cut"], bool), r["total"], int(_on_grid(np.array(r["gain"]))))
            for child, counts in ((2 * h, r["left"]), (2 * h + 1, [a - b for a, b in zip(r["total"], r["left"])])):
                if sum(counts) > LOCAL_ROWS:
                    if _splittable(np.array([counts]), np.array([child]), max_depth)[0]:
                        grown.append((t, child))
                    else:
                        top[t][child] = (-1, None, counts, 0)
        open_ = sorted(grown)
    return top


def _prune_top(top: Top, ends: Iterator[tuple[int, int, list[int]]]) -> None:
    """As ``_pruned``, where one of the leaves is a piece: ``ends`` has the (tree, heap, class counts) of pieces that are one leaf. They are left out of no
    table: no row comes to them any more."""
    choice = {(t, h): int(np.argmax(counts)) for t, h, counts in ends}
    for t, nodes in top.items():
        choice |= {(t, h): int(np.argmax(v[2])) for h, v in nodes.items() if v[0] < 0}
        for h in sorted(nodes, reverse=True):
            one, two = choice.get((t, 2 * h)), choice.get((t, 2 * h + 1))
            if nodes[h][0] >= 0 and one is not None and one == two:
                nodes[h] = (-1, None, nodes[h][2], 0)
                choice[t, h] = int(np.argmax(nodes[h][2]))
                for child in (2 * h, 2 * h + 1):
                    nodes.pop(child, None)


def _to_pieces(top: Top, features: Sequence[str], label: str, seed: int, num_trees: int):
    """The rows of each batch that are in a tree's bag, by the node they come out of the top at."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _bins(batch, features), batch.column(label).to_numpy().astype(np.uint8)
            stirred = _stirred(batch.column(PLACE).to_numpy())
            for t in range(num_trees):
                w = bag(stirred, seed, t)
                nodes = top.get(t, {})
                out = [(h, np.concatenate([x[rows], y[rows, None], w[rows, None]], axis=1).tobytes())
                       for h, rows in _routed(nodes, x, np.flatnonzero(w)) if h not in nodes and len(rows)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([t] * len(out), pa.int32()), pa.array([h for h, _ in out], pa.int64()), pa.array([o for _, o in out], pa.binary())], names=["tree", "heap", "rows"])

    return run


def _pieces(kinds: np.ndarray, seed: int, k: int, n_classes: int, max_depth: int, n_out: int):
    """Rows sorted by (tree, heap) to grown pieces, one in memory at a time."""
    def piece(at: tuple[int, int], blobs: list[bytes]) -> pa.RecordBatch:
        all_ = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, len(kinds) + 2)
        grown, gains = grow(np.ascontiguousarray(all_[:, :-2]), all_[:, -2].astype(np.int64), all_[:, -1], kinds, at[1], seed, at[0], k, n_classes, max_depth, n_out)
        end = grown["votes"][0].tolist() if len(grown["feature"]) == 1 else None
        return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int64()), pa.array([_packed(grown)], pa.binary()), pa.array([gains.tolist()], pa.list_(pa.int64())), pa.array([end], pa.list_(pa.int64()))],
                                          names=["tree", "heap", "piece", "gains", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, blobs = None, []
        for batch in batches:
            for t, h, blob in zip(batch.column("tree").to_pylist(), batch.column("heap").to_pylist(), batch.column("rows")):
                if at != (t, h):
                    if at is not None:
                        yield piece(at, blobs)
                    at, blobs = (t, h), []
                blobs.append(blob.as_py())
        if at is not None:
            yield piece(at, blobs)

    return run


class Tree:
    """A tree to look at: nodes as (path from the root, feature, bins to the left or class counts)."""

    def __init__(self, nodes: list[tuple]):
        self.nodes = nodes

    @property
    def numNodes(self) -> int:  # noqa: N802 (as Spark's)
        return len(self.nodes)

    @property
    def toDebugString(self) -> str:  # noqa: N802
        return "\n".join([f"Tree of {len(self.nodes)} nodes", *[f"{h}: {'counts' if f < 0 else f'feature {f} in'} {v}" for h, f, v in self.nodes]])


class Part:
    """Some trees of a grown forest. ``trees`` brings them to the driver: for small forests and tests."""

    def __init__(self, table: DataFrame, top: Top, first: int, n: int):
        self.table, self.top, self.first, self.n = table, top, first, n

    @cached_property
    def trees(self) -> list[Tree]:
        found: dict[int, list[tuple]] = {t: [] for t in range(self.first, self.first + self.n)}
        for t, nodes in found.items():
            nodes += [(h, f, counts if f < 0 else np.flatnonzero(cut).tolist()) for h, (f, cut, counts, _) in self.top.get(t, {}).items()]
        for r in self.table.where(F.col("tree").between(self.first, self.first + self.n - 1)).collect():
            piece = _unpacked(r["piece"])
            todo = [(0, r["heap"])] if r["heap"] == 1 or self.top[r["tree"]].get(r["heap"] // 2, (-1,))[0] >= 0 else []  # else cut off
            while todo:
                i, h = todo.pop()
                f, to = int(piece["feature"][i]), int(piece["left"][i])
                found[r["tree"]].append((h, f, piece["votes"][to].tolist() if f < 0 else np.flatnonzero(np.unpackbits(piece["cut"][i], bitorder="little")).tolist()))
                todo += [] if f < 0 else [(to, 2 * h), (to + 1, 2 * h + 1)]
        return [Tree(sorted(nodes, key=lambda n: n[0])) for nodes in found.values()]


class GrownForest:
    """``table``: (tree, heap, piece, gains, end), written; ``top``: the nodes above the pieces."""

    def __init__(self, table: DataFrame, top: Top, n_features: int, n_classes: int, num_trees: int, of_part: int):
        self.table, self.top, self.n_features, self.n_classes, self.num_trees, self.of_part = table, top, n_features, n_classes, num_trees, of_part
        self.parts = [Part(table, top, t, min(of_part, num_trees - t)) for t in range(0, num_trees, of_part)]

    @cached_property
    def importances(self) -> np.ndarray:
        """Gains by feature: shares within a tree, added up over the trees that split at all."""
        gains = np.zeros((self.num_trees, self.n_features), np.int64)
        for t, nodes in self.top.items():
            for f, _, _, gain in nodes.values():
                gains[t, f] += gain  # of a leaf: nothing
        for r in self.table.groupBy("tree").agg(*[F.sum(F.get("gains", F.lit(i))).alias(f"g{i}") for i in range(self.n_features)]).collect():  # a row a tree
            gains[r["tree"]] += [r[f"g{i}"] for i in range(self.n_features)]
        of_tree = gains.sum(1, keepdims=True)
        total = np.where(of_tree > 0, gains / np.where(of_tree > 0, of_tree, 1), 0.0).sum(0)
        return total / total.sum() if total.sum() > 0 else total


def grow_forest(train: DataFrame, features: Sequence[str], label: str, n_rows: int, n_classes: int, num_trees: int, max_depth: int, seed: int,
                max_bins: int, of_part: int) -> GrownForest:
    """A forest over ``n_rows`` binned rows with their ``PLACE``; the square root of the number of features (rounded up) is tried at a node."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    k = math.ceil(math.sqrt(len(features)))
    kinds = feature_kinds(train, features, n_rows, n_classes, max_bins)
    top = _grow_top(train, features, kinds, label, n_rows, n_classes, num_trees, max_depth, seed, k, max_bins)
    tasks = min(num_trees * max(1, -(-n_rows // LOCAL_ROWS)), 4 * spark.sparkContext.defaultParallelism)
    dealt = F.pmod(F.xxhash64("tree", "heap") if top else F.col("tree"), F.lit(tasks)).cast("int")
    table = (train.select(PLACE, label, *features).mapInArrow(_to_pieces(top, features, label, seed, num_trees), "tree int, heap long, rows binary")
             .repartitionById(tasks, dealt).sortWithinPartitions("tree", "heap")
             .mapInArrow(_pieces(kinds, seed, k, n_classes, max_depth, max_bins + 1), "tree int, heap long, piece binary, gains array<long>, end array<long>").checkpoint(eager=True))
    if top:
        _prune_top(top, ((r["tree"], r["heap"], r["end"]) for r in table.where("end is not null").select("tree", "heap", "end").collect()))
    return GrownForest(table, top, len(features), n_classes, num_trees, of_part)


# ---------------------------------------------------------------- predicting

def _blocks(features: Sequence[str], label: str, n_parts: int, n_groups: int):
    """Each batch as one row for each part of the forest; the labels go along with the first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        p = TaskContext.get().partitionId()
        for i, batch in enumerate(b for b in batches if b.num_rows):
            x, labels = _bins(batch, features).tobytes(), batch.column(label)
            for part in range(n_parts):
                own = labels if part == 0 else labels.slice(0, 0)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([(p + i) % n_groups], pa.int32()), pa.array([1], pa.int32()), pa.array([p], pa.int64()), pa.array([i], pa.int64()),
                                                  pa.array([x], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)], names=["part", "grp", "kind", "a", "b", "data", "labels"])

    return run


def _voted(top: Top, n_features: int, n_classes: int, num_trees: int, of_part: int):
    """Rows sorted by (part, group, kind): the pieces of a part, then blocks, which get its votes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pieces = None, {}
        for batch in batches:
            for i, (part, group, kind, a, b) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("part", "grp", "kind", "a", "b")])):
                if at != (part, group):
                    at, pieces = (part, group), {}
                data = batch.column("data")[i].as_py()
                if kind == 0:
                    pieces[a, b] = _unpacked(data)
                    pieces[a, b]["votes"] = _votes_of(pieces[a, b]["votes"])
                    continue
                x = np.frombuffer(data, np.uint8).reshape(-1, n_features)
                votes = np.zeros((len(x), n_classes), np.int64)
                for t in range(part * of_part, min(num_trees, (part + 1) * of_part)):
                    nodes = top.get(t, {})
                    for h, rows in _routed(nodes, x, np.arange(len(x))):
                        if h in nodes:
                            votes[rows] += _votes_of(np.array(nodes[h][2]))
                        elif (t, h) in pieces and len(rows):  # a tree with an empty bag has no vote
                            votes[rows] += pieces[t, h]["votes"][_leaves(pieces[t, h], x[rows])]
                yield pa.RecordBatch.from_arrays([pa.array([a], pa.int64()), pa.array([b], pa.int64()), pa.array([votes.tobytes()], pa.binary()), batch.column("labels").slice(i, 1)], names=["a", "b", "votes", "labels"])

    return run


def _elected(n_classes: int):
    def run(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_py(), np.int64) for v in group.column("votes")).reshape(-1, n_classes)
        labels = pa.concat_arrays([c.flatten() for c in group.column("labels").chunks])
        return pa.table({"label": labels, "prediction": pa.array(total.argmax(1), pa.int32())})

    return run


def predict(model: GrownForest, rows: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(label, prediction): the class with most votes, the smallest of equal ones. Blocks of rows meet a part of the trees in a task; their votes are added up."""
    kind = rows.schema[label].dataType.simpleString()
    n_parts, n_groups = len(model.parts), max(1, -(-rows.count() // PREDICT_ROWS))
    blocks = rows.select(label, *features).mapInArrow(_blocks(features, label, n_parts, n_groups), f"part int, grp int, kind int, a long, b long, data binary, labels array<{kind}>")
    pieces = model.table.select(F.floor(F.col("tree") / model.of_part).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("grp"), F.lit(0).alias("kind"),
                                F.col("tree").cast("long").alias("a"), F.col("heap").alias("b"), F.col("piece").alias("data"), F.lit(None).cast(f"array<{kind}>").alias("labels"))
    met = (blocks.unionByName(pieces).repartitionById(n_parts * n_groups, F.col("part") * n_groups + F.col("grp")).sortWithinPartitions("part", "grp", "kind")
           .mapInArrow(_voted(model.top, len(features), model.n_classes, model.num_trees, model.of_part), f"a long, b long, votes binary, labels array<{kind}>"))
    return met.groupBy("a", "b").applyInArrow(_elected(model.n_classes), f"label {kind}, prediction int")
