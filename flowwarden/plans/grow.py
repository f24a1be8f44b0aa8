"""Random forests grown on every row of a table: one task per tree, which draws its own bootstrap of all rows.

Numbers are cut at quantiles of all rows, and the rows are written once as small integers. A tree reads them batch by batch. Nodes with more rows than
``ROWS`` are split by histograms that are summed over the batches, the others with their rows in memory, level by level, so that the memory of a task
depends neither on the rows nor on the classes of the table. Trees are written by the tasks and never come to the driver.

Splits are those of Spark's forests: Gini impurity of weighted rows, a random subset of the features per node, at least ``least`` rows on either side, categories
by subsets if there are few and by order else, siblings with one prediction merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet

#: Rows of the table in a batch, and bootstrap rows that a tree works on in memory.
BATCH, ROWS = 1 << 18, 1 << 20
#: Cells of a histogram of all nodes that are split at once.
CELLS = 1 << 22
#: Gains up to here are rounding.
NO_GAIN = 1e-12
TREE = "tree int, rows bigint, leaves bigint, feature binary, cut binary, right binary, shares binary, sets binary, importance array<double>"


@dataclass(frozen=True)
class Plan:
    """What a task needs to grow a tree. ``names`` are the labels of the classes that there are rows of, ``classes`` their number and ``weights`` their weights;
    ``arity`` is the number of a feature's categories, 0 for numbers; ``bins`` of their bins."""

    path: str
    classes: int
    weights: tuple[float, ...]
    names: tuple[int, ...]
    arity: tuple[int, ...]
    bins: tuple[int, ...]
    tries: int
    depth: int
    least: int
    most_bins: int
    seed: int

    @property
    def widest(self) -> int:
        return max([1, *self.arity])


def files(path: str) -> tuple[pyarrow.fs.FileSystem, list[str]]:
    """The Parquet files of a shared folder, by name."""
    fs, inside = pyarrow.fs.FileSystem.from_uri(path) if ":" in path else (pyarrow.fs.LocalFileSystem(), path)
    found = fs.get_file_info(pyarrow.fs.FileSelector(inside))
    return fs, sorted(f.path for f in found if f.path.endswith(".parquet"))


def _batches(path: str, names: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    fs, found = files(path)
    for name in found:
        with fs.open_input_file(name) as file:
            for batch in pyarrow.parquet.ParquetFile(file).iter_batches(BATCH):
                *x, y = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                yield np.column_stack(x), np.searchsorted(names, y)


def _bootstrap(plan: Plan, tree: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Features, class and number of draws of the rows that are drawn; the same ones each time."""
    for i, (x, y) in enumerate(_batches(plan.path, plan.names)):
        n = np.random.default_rng([plan.seed, tree, i]).poisson(1.0, len(y))
        drawn = n > 0
        yield x[drawn], y[drawn], n[drawn]


def _counts(keys: np.ndarray, y: np.ndarray, n: np.ndarray, size: int, classes: int) -> np.ndarray:
    """Draws by key and class."""
    return np.bincount(keys * classes + y, weights=n, minlength=size * classes).reshape(size, classes)


def _purity(plan: Plan, left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Squares of the weighted counts over their sum, of both sides: the larger, the purer. No split leaves a side with too few rows."""
    right = total - left
    a, b = left * plan.weights, right * plan.weights
    enough = (left.sum(-1) >= plan.least) & (right.sum(-1) >= plan.least)
    with np.errstate(divide="ignore", invalid="ignore"):
        both = (a * a).sum(-1) / a.sum(-1) + (b * b).sum(-1) / b.sum(-1)
    return np.where(enough, both, -np.inf)


def _cut_numbers(plan: Plan, node, value, counts, totals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, their best purity and the last bin on its left, from counts by node and bin in this order."""
    starts = np.concatenate([[True], node[1:] != node[:-1]])
    first, of = np.flatnonzero(starts), np.cumsum(starts) - 1
    upto = counts.cumsum(axis=0)
    score = _purity(plan, upto - (upto[first] - counts[first])[of], totals[node])
    best = np.maximum.reduceat(score, first)
    at = np.flatnonzero(score == best[of])
    _, once = np.unique(of[at], return_index=True)
    return node[first], best, value[at[once]]


def _cut_categories(plan: Plan, f: int, node, value, counts, totals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, their best purity and whether a category goes to the right."""
    # A node of one category can't be split by it.
    several = np.bincount(node, minlength=len(totals)) > 1
    mine = several[node]
    node, value, counts, arity = node[mine], value[mine], counts[mine], plan.arity[f]
    nodes, of = np.unique(node, return_inverse=True)
    best, right = np.full(len(nodes), -np.inf), np.zeros((len(nodes), arity), dtype=bool)
    table = np.zeros((len(nodes), arity, plan.classes))
    table[of, value] = counts
    total = totals[nodes]

    if plan.classes > 2 and arity <= math.log2(plan.most_bins / 2 + 1) + 1:
        subsets = np.arange(1, 1 << (arity - 1))[:, None] >> np.arange(arity) & 1
        for some in np.array_split(np.arange(len(nodes)), max(1, -(-len(nodes) * len(subsets) * plan.classes // CELLS))):
            score = _purity(plan, subsets.astype("float64") @ table[some], total[some, None])
            at = score.argmax(axis=1)
            best[some], right[some] = score[np.arange(len(some)), at], subsets[at] == 0
        return nodes, best, right
    weighted = table * plan.weights
    weight = weighted.sum(-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        share = weighted[..., 1] / weight if plan.classes == 2 else 1 - (weighted * weighted).sum(-1) / weight**2
    order = np.argsort(np.where(weight > 0, share, np.inf), axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    upto = np.take_along_axis(table, order[..., None], axis=1).cumsum(axis=1)
    for last in range(arity - 1):
        score = _purity(plan, upto[:, last], total)
        better = score > best
        best[better], right[better] = score[better], rank[better] > last
    return nodes, best, right


class _Splits:
    """The best split of every node of a level, so far."""

    def __init__(self, plan: Plan, totals: np.ndarray, rng: np.random.Generator):
        m, nf = len(totals), len(plan.arity)
        self.plan, self.totals = plan, totals
        self.tried = np.argpartition(rng.random((m, nf)), plan.tries - 1, axis=1)[:, : plan.tries] if plan.tries < nf else np.tile(np.arange(nf), (m, 1))
        self.best, self.feature, self.cut = np.full(m, -np.inf), np.full(m, -1), np.zeros(m, dtype="int64")
        self.right = np.zeros((m, plan.widest), dtype=bool)

    def offer(self, j: int, node: np.ndarray, value: np.ndarray, counts: np.ndarray) -> None:
        """Counts by node and bin or category of the ``j``-th feature that each node tries."""
        tried, arity = self.tried[:, j], np.array(self.plan.arity)
        for f in [None, *np.flatnonzero(arity)]:
            mine = arity[tried[node]] == 0 if f is None else tried[node] == f
            if not mine.any():
                continue
            given = node[mine], value[mine], counts[mine], self.totals
            at, score, how = _cut_numbers(self.plan, *given) if f is None else _cut_categories(self.plan, f, *given)
            better = score > self.best[at]
            at, how = at[better], how[better]
            self.best[at], self.feature[at] = score[better], tried[at]
            if f is None:
                self.cut[at], self.right[at] = how, False
            else:
                self.right[at] = False
                self.right[at, : how.shape[1]] = how

    def ended(self) -> np.ndarray:
        """What the splits gain; nodes that gain nothing stay leaves."""
        w = self.totals * self.plan.weights
        gain = self.best - (w * w).sum(1) / w.sum(1)
        self.feature[~(gain / w.sum(1) > NO_GAIN)] = -1
        return np.where(self.feature >= 0, gain, 0.0)

    def goes_right(self, node: np.ndarray, value: np.ndarray) -> np.ndarray:
        go = value > self.cut[node]
        of_category = np.array(self.plan.arity)[self.feature[node]] > 0
        if of_category.any():
            go[of_category] = self.right[node[of_category], value[of_category]]
        return go


class _Nodes:
    """Nodes as they are made, level by level."""

    def __init__(self, plan: Plan):
        self.plan, self.n, self.parts = plan, 0, []

    def add(self, totals: np.ndarray, depth: int) -> int:
        """Leaves of this depth, for now; returns the number of the first."""
        m, first = len(totals), self.n
        self.parts.append({
            "stats": totals, "depth": np.full(m, depth), "left": np.full(m, -1), "right": np.full(m, -1), "feature": np.full(m, -1),
            "cut": np.zeros(m, dtype="int64"), "gain": np.zeros(m), "set": np.zeros((m, self.plan.widest), dtype=bool), "first": first,
        })
        self.n += m
        return first

    def split(self, part: dict, at: np.ndarray, splits: _Splits, some: np.ndarray, gain: np.ndarray, children: int) -> None:
        """Nodes ``at`` of a level get the splits ``some``, and pairs of children from ``children`` on."""
        part["feature"][at], part["cut"][at], part["gain"][at], part["set"][at] = splits.feature[some], splits.cut[some], gain[some], splits.right[some]
        part["left"][at] = children + 2 * np.arange(len(at))
        part["right"][at] = part["left"][at] + 1

    def all(self) -> dict[str, np.ndarray]:
        return {k: np.concatenate([p[k] for p in self.parts]) for k in self.parts[0] if k != "first"}


def _subtree(plan: Plan, nodes: _Nodes, x, y, n, depth: int, rng, root: tuple[dict, int] | None = None) -> None:
    """Grows a node in memory from its rows; ``root`` is the node if it is there."""
    flat, nf = np.ascontiguousarray(x).ravel(), x.shape[1]
    rows, sizes = np.arange(len(y)), np.array([len(y)])
    while len(sizes):
        node = np.repeat(np.arange(len(sizes)), sizes)
        classes, drawn = y[rows], n[rows]
        totals = _counts(node, classes, drawn, len(sizes), plan.classes)
        if root:
            part, at = root[0], np.array([root[1]])
        else:
            nodes.add(totals, depth)
            part, at = nodes.parts[-1], np.arange(len(sizes))
        root = None
        growing = (np.count_nonzero(totals, axis=1) > 1) & (depth < plan.depth)
        kept = growing[node]
        rows, node = rows[kept], (np.cumsum(growing) - 1)[node[kept]]
        if not len(rows):
            return
        classes, drawn = classes[kept], drawn[kept]
        at, totals = at[growing], totals[growing]
        splits = _Splits(plan, totals, rng)
        bins = max(plan.bins)
        for j in range(splits.tried.shape[1]):
            value = flat[rows * nf + splits.tried[node, j]].astype("int64")
            # Sorted as one number each: what is counted together, and the row's place.
            keys = np.sort((node * bins + value) << 32 | np.arange(len(rows)))
            order, keys = keys & 0xFFFFFFFF, keys >> 32
            starts = np.concatenate([[True], keys[1:] != keys[:-1]])
            found = keys[starts]
            counts = _counts(np.cumsum(starts) - 1, classes[order], drawn[order], len(found), plan.classes)
            splits.offer(j, found // bins, found % bins, counts)
        gain = splits.ended()
        inner = splits.feature >= 0
        nodes.split(part, at[inner], splits, inner, gain, nodes.n)
        kept = inner[node]
        rows, node = rows[kept], node[kept]
        go = splits.goes_right(node, flat[rows * nf + splits.feature[node]].astype("int64"))
        child = 2 * (np.cumsum(inner) - 1)[node] + go
        order = np.sort(child << 32 | np.arange(len(rows))) & 0xFFFFFFFF
        rows, sizes = rows[order], np.bincount(child, minlength=2 * inner.sum())
        sizes = sizes if inner.any() else sizes[:0]
        depth += 1


def _reach(plan: Plan, tree: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The node that every row ends in."""
    node, at, arity = np.zeros(len(x), dtype="int64"), np.arange(len(x)), np.array(plan.arity)
    while len(at := at[tree["left"][node[at]] >= 0]):
        k = node[at]
        f = tree["feature"][k]
        value = x[at, f].astype("int64")
        go = np.where(arity[f] > 0, tree["set"][k, np.minimum(value, plan.widest - 1)], value > tree["cut"][k])
        node[at] = np.where(go, tree["right"][k], tree["left"][k])
    return node


def _tree(plan: Plan, tree: int) -> dict[str, np.ndarray]:
    """The nodes of a tree, counted by the classes of the plan."""
    rng = np.random.default_rng([plan.seed, tree])
    nodes, total, held, size = _Nodes(plan), np.zeros(plan.classes), [], 0
    for x, y, n in _bootstrap(plan, tree):
        total += np.bincount(y, weights=n, minlength=plan.classes)
        size += len(y)
        held = [*held, (x, y, n)] if size <= ROWS else []
    if size <= ROWS:
        if size:
            _subtree(plan, nodes, *(np.concatenate(a) for a in zip(*held)), 0, rng)
        else:
            nodes.add(total[None], 0)
        return nodes.all()
    nodes.add(total[None], 0)
    sizes, waiting, depth = np.array([size]), [], 0
    while len(sizes):
        # All nodes of this level; those that fit in memory wait, the others are split by histograms.
        part = nodes.parts[-1]
        growing = (np.count_nonzero(part["stats"], axis=1) > 1) & (depth < plan.depth)
        waiting += [(part, i, depth, sizes[i]) for i in np.flatnonzero(growing & (sizes <= ROWS))]
        large = np.flatnonzero(growing & (sizes > ROWS))
        made, so_far = 0, nodes.all()
        for some in np.array_split(large, max(1, -(-len(large) * plan.tries * max(plan.bins) * plan.classes // CELLS))) if len(large) else []:
            splits, bins, place = _Splits(plan, part["stats"][some], rng), max(plan.bins), np.full(nodes.n, -1)
            place[part["first"] + some] = np.arange(len(some))
            counts = np.zeros((plan.tries, len(some) * bins, plan.classes))
            for x, y, n in _bootstrap(plan, tree):
                node = place[_reach(plan, so_far, x)]
                mine = node >= 0
                x, y, n, node = x[mine], y[mine], n[mine], node[mine]
                for j in range(plan.tries):
                    value = x[np.arange(len(x)), splits.tried[node, j]].astype("int64")
                    counts[j] += _counts(node * bins + value, y, n, len(some) * bins, plan.classes)
            for j in range(plan.tries):
                found = np.flatnonzero(counts[j].any(axis=1))
                splits.offer(j, found // bins, found % bins, counts[j][found])
            gain = splits.ended()
            inner = splits.feature >= 0
            nodes.split(part, some[inner], splits, inner, gain, nodes.n + made)
            made += 2 * int(inner.sum())
        if not made:
            break
        first = nodes.add(np.zeros((made, plan.classes)), depth + 1)
        so_far, stats, sizes = nodes.all(), nodes.parts[-1]["stats"], np.zeros(made, dtype="int64")
        for x, y, n in _bootstrap(plan, tree):
            child = _reach(plan, so_far, x) - first
            mine = child >= 0
            stats += _counts(child[mine], y[mine], n[mine], made, plan.classes)
            sizes += np.bincount(child[mine], minlength=made)
        depth += 1
    # Nodes that fit in memory together are read together.
    so_far = nodes.all()
    while waiting:
        group, room = [], ROWS
        while waiting and (waiting[-1][3] <= room):
            room -= waiting[-1][3]
            group.append(waiting.pop())
        place = np.full(len(so_far["left"]), -1)
        place[[part["first"] + i for part, i, _, _ in group]] = np.arange(len(group))
        parts = []
        for x, y, n in _bootstrap(plan, tree):
            node = place[_reach(plan, so_far, x)]
            parts.append((x[node >= 0], y[node >= 0], n[node >= 0], node[node >= 0]))
        x, y, n, node = (np.concatenate(a) for a in zip(*parts))
        for k, (part, i, at, _) in enumerate(group):
            _subtree(plan, nodes, x[node == k], y[node == k], n[node == k], at, rng, (part, i))
    return nodes.all()


def _packed(plan: Plan, number: int, t: dict[str, np.ndarray]) -> dict:
    """A tree as it is written: siblings with one prediction merged, nodes in preorder, so that a left child is behind its parent.

    ``right`` is the right child, or the row of a leaf in ``shares``; ``cut`` the last bin on the left, or the row of ``sets``.
    """
    said, left, right = (t["stats"] * plan.weights).argmax(axis=1), t["left"], t["right"]
    levels = [np.flatnonzero(t["depth"] == d) for d in range(int(t["depth"].max()) + 1)]
    size = np.ones(len(left), dtype="int64")
    for level in reversed(levels):
        i = level[left[level] >= 0]
        same = (left[left[i]] < 0) & (left[right[i]] < 0) & (said[left[i]] == said[right[i]])
        left[i[same]] = -1
        i = i[~same]
        size[i] += size[left[i]] + size[right[i]]
    place = np.full(len(left), -1)
    place[0] = 0
    for level in levels:
        i = level[(place[level] >= 0) & (left[level] >= 0)]
        place[left[i]] = place[i] + 1
        place[right[i]] = place[i] + 1 + size[left[i]]
    there = np.flatnonzero(place >= 0)
    there = there[np.argsort(place[there])]
    leaf = left[there] < 0
    feature = np.where(leaf, -1, t["feature"][there])
    to, cut = np.zeros(len(there), dtype="int64"), t["cut"][there]
    to[~leaf] = place[right[there[~leaf]]]
    weighted = np.zeros((int(leaf.sum()), plan.names[-1] + 1))
    weighted[:, plan.names] = t["stats"][there[leaf]] * plan.weights
    total = weighted.sum(axis=1, keepdims=True)
    shares, to[leaf] = np.unique(np.divide(weighted, total, out=np.zeros_like(weighted), where=total > 0), axis=0, return_inverse=True)
    by_set = ~leaf & (np.array(plan.arity)[feature] > 0)
    sets, cut[by_set] = np.unique(t["set"][there[by_set]], axis=0, return_inverse=True)
    gains = np.bincount(feature[~leaf], weights=t["gain"][there[~leaf]], minlength=len(plan.arity))
    return {
        "tree": number, "rows": int(t["stats"][0].sum()), "leaves": int(leaf.sum()), "feature": feature.astype("int16").tobytes(),
        "cut": cut.astype("int32").tobytes(), "right": to.astype("int32").tobytes(), "shares": shares.tobytes(), "sets": sets.tobytes(),
        "importance": (gains / gains.sum() if gains.sum() > 0 else gains).tolist(),
    }


_ARROW = pa.schema([
    ("tree", pa.int32()), ("rows", pa.int64()), ("leaves", pa.int64()), *[(c, pa.binary()) for c in ("feature", "cut", "right", "shares", "sets")],
    ("importance", pa.list_(pa.float64())),
])


def grown(plan: Plan, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A written tree for each number in ``id``."""
    for batch in batches:
        for number in batch["id"].to_pylist():
            yield pa.RecordBatch.from_pylist([_packed(plan, number, _tree(plan, number))], schema=_ARROW)


@dataclass(frozen=True)
class Tree:
    feature: np.ndarray
    cut: np.ndarray
    right: np.ndarray
    shares: np.ndarray
    sets: np.ndarray


def trees(path: str, classes: int, widest: int) -> list[Tree]:
    """The trees of a folder in their order."""
    fs, names = files(path)
    rows = {}
    for name in names:
        with fs.open_input_file(name) as file:
            for r in pyarrow.parquet.read_table(file, columns=["tree", "feature", "cut", "right", "shares", "sets"]).to_pylist():
                rows[r["tree"]] = Tree(
                    np.frombuffer(r["feature"], "int16"), np.frombuffer(r["cut"], "int32"), np.frombuffer(r["right"], "int32"),
                    np.frombuffer(r["shares"]).reshape(-1, classes), np.frombuffer(r["sets"], bool).reshape(-1, widest),
                )
    return [rows[k] for k in sorted(rows)]
