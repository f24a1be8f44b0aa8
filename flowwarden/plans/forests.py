"""Fitted forests over batches of rows: the same votes as Spark's own scoring, tree by tree, without walking trees per row.

Every tree numbers its leaves from left to right, one bit each. A value of a feature rules out the left leaves of all nodes that it sends to the
right, so a feature has one mask per interval between its thresholds; the masks of a row's features are ANDed, and the lowest bit left is
the leaf. Votes are added in the order of the trees, as Spark does, so sums round alike.
"""

from __future__ import annotations

import functools
import json
import operator

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import StandardScalerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.plans import grow
from flowwarden.plans.forest_model import ForestModel, with_scheme
from flowwarden.session import ship_package, work_path

#: Rows and trees that are worked on at once: a quarter of a megabyte of masks.
ROWS, TREES = 2048, 16
#: Features are looked up together as long as their values have no more combinations.
COMBINATIONS = 512
#: Leaves of a tree up to which masks are quicker than walking down the tree.
MASKED_LEAVES = 256
#: Codes of rows that walk at once.
CODES = 1 << 20


class PackedForest:
    """Masks and leaves of a forest, from its node rows (``tree``, ``id``, children, class counts, split) in order of tree and id."""

    def __init__(self, nodes: list[dict]):
        trees: dict[int, list[dict]] = {}
        for n in nodes:
            trees.setdefault(n["tree"], []).append(n)
        splits = [n["split"] for n in nodes if n["left"] >= 0]
        self.thresholds, self.categories = {}, {}
        for s in splits:
            f = s["featureIndex"]
            if s["numCategories"] < 0:
                self.thresholds.setdefault(f, set()).update(s["leftCategoriesOrThreshold"])
            else:
                self.categories[f] = max(s["numCategories"], self.categories.get(f, 0))
        self.thresholds = {f: np.array(sorted(t)) for f, t in self.thresholds.items()}
        sizes = {f: len(t) + 1 for f, t in self.thresholds.items()} | {f: n + 1 for f, n in self.categories.items()}
        self.counts = np.array([sum(n["left"] < 0 for n in trees[k]) for k in sorted(trees)])
        most = int(self.counts.max())
        words, classes = -(-most // 64), len(nodes[0]["stats"])
        masks = {f: np.full((n, len(trees), words), ~np.uint64(0)) for f, n in sizes.items()}
        self.leaves = np.zeros((len(trees), most, classes))
        for t, tree in enumerate(trees[k] for k in sorted(trees)):
            before = np.concatenate([[0], np.cumsum([n["left"] < 0 for n in tree])])
            for n in tree:
                if n["left"] < 0 and "shares" in n:
                    self.leaves[t, before[n["id"]]] = n["shares"]
                    continue
                if n["left"] < 0:
                    total = functools.reduce(operator.add, n["stats"])
                    self.leaves[t, before[n["id"]]] = [c / total if total != 0 else 0.0 for c in n["stats"]]
                    continue
                first, last = int(before[n["left"]]), int(before[n["right"]])
                out = (1 << last) - (1 << first)
                kept = np.array([~(out >> 64 * w) & (2**64 - 1) for w in range(words)], dtype="uint64")
                f = n["split"]["featureIndex"]
                masks[f][self._goes_right(n["split"], sizes[f]), t] &= kept
        # Features with few values first, so that many of them share a lookup.
        self.lookups, tables = [], []
        for f in sorted(sizes, key=sizes.get):
            if self.lookups and len(tables[-1]) * sizes[f] <= COMBINATIONS:
                self.lookups[-1].append((f, sizes[f]))
                tables[-1] = (tables[-1][:, None] & masks[f][None]).reshape(-1, len(trees), words)
            else:
                self.lookups.append([(f, sizes[f])])
                tables.append(masks[f])
        self.blocks = [[np.ascontiguousarray(table[:, t : t + TREES]) for table in tables] for t in range(0, len(trees), TREES)]

    @functools.cached_property
    def planes(self) -> list[list[list[np.ndarray]]]:
        """The tables of every block word by word, for as many words as its largest tree has leaves. Made where the forest is used."""
        most = [int(self.counts[t : t + TREES].max()) for t in range(0, len(self.leaves), TREES)]
        return [
            [[np.ascontiguousarray(table[:, :, w]) for table in block] for w in range(-(-n // 64))] for block, n in zip(self.blocks, most)
        ]

    def _goes_right(self, split: dict, size: int) -> np.ndarray:
        """Per interval or category of a feature whether the split sends it to the right; the last category stands for all that are out of range."""
        left = split["leftCategoriesOrThreshold"]
        if split["numCategories"] < 0:
            return np.arange(size) > np.searchsorted(self.thresholds[split["featureIndex"]], left[0])
        # Spark keeps the shorter side: what it does not list is on the other one.
        lists_left = len(left) <= split["numCategories"] / 2
        rest = np.arange(size) >= split["numCategories"]
        return np.where(rest, lists_left, ~np.isin(np.arange(size), left))

    def _values(self, x: np.ndarray, f: int) -> np.ndarray:
        if f in self.thresholds:
            return np.searchsorted(self.thresholds[f], x[:, f], side="left")
        n, c = self.categories[f], x[:, f]
        known = (c >= 0) & (c < n) & (c == np.floor(c))
        return np.where(known, c, n).astype("int64")

    def votes(self, x: np.ndarray) -> np.ndarray:
        """Sums of the trees' class shares, one row per row of ``x``."""
        out = np.zeros((len(x), self.leaves.shape[2]))
        sums, leaves = out, self.leaves
        if leaves.shape[2] == 2:
            # Two shares go together as one complex number, the parts of which are added apart.
            sums, leaves = out.view("complex128")[:, 0], leaves.view("complex128")[..., 0]
        for start in range(0, len(x), ROWS):
            part, total = x[start : start + ROWS], sums[start : start + ROWS]
            keys = [
                functools.reduce(lambda key, fs: key * fs[1] + self._values(part, fs[0]), group, np.zeros(len(part), dtype="int64"))
                for group in self.lookups
            ]
            shares, masks = np.empty_like(total), np.empty((2, len(part) * TREES), dtype="uint64")
            for t, planes in zip(range(0, len(leaves), TREES), self.planes):
                trees = min(TREES, len(leaves) - t)
                left, other = masks[:, : len(part) * trees].reshape(2, len(part), trees)
                for of_tree, leaf in zip(leaves[t : t + TREES], self._leaves_of(keys, planes, left, other)):
                    np.add(total, np.take(of_tree, leaf, axis=0, out=shares, mode="clip"), out=total)
        return out

    @staticmethod
    def _leaves_of(keys: list[np.ndarray], planes: list[list[np.ndarray]], left: np.ndarray, other: np.ndarray) -> np.ndarray:
        """The leaf of every row, tree by tree: the number of the lowest bit set in its masks, which is in the first word that is not empty.

        ``left`` and ``other`` are room for a word of masks, a row each.
        """
        leaf = np.zeros(left.shape, dtype="uint8" if len(planes) <= 4 else "int64")
        if not keys:  # trees without any split
            return leaf.T.astype(np.intp)
        for w, tables in enumerate(planes):
            np.take(tables[0], keys[0], axis=0, out=left, mode="clip")
            for table, key in zip(tables[1:], keys[1:]):
                np.bitwise_and(left, np.take(table, key, axis=0, out=other, mode="clip"), out=left)
            # The bits below the lowest; all 64 of an empty word.
            below = np.bitwise_count(np.bitwise_and(np.subtract(left, np.uint64(1), out=other), np.invert(left, out=left), out=left))
            leaf = leaf + below * (leaf == 64 * w) if w else below.astype(leaf.dtype, copy=False)
        return leaf.T.astype(np.intp, order="C")

    def scored(self, x: np.ndarray) -> pa.Array:
        return _shares(self.votes(x))


def _shares(votes: np.ndarray) -> pa.Array:
    """Probabilities of the classes and the likeliest one, the first of equals, one row per row of votes."""
    total = functools.reduce(operator.add, votes.T)
    shares = np.divide(votes, total[:, None], out=votes.copy(), where=total[:, None] != 0)
    offsets = np.arange(0, shares.size + 1, shares.shape[1], dtype="int32")
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(shares.ravel()))
    return pa.StructArray.from_arrays([lists, pa.array(votes.argmax(axis=1).astype("float64"))], ["probs", "said"])


class _Walk:
    """A tree to walk down. A node is one number: its right child, the last code on its left, the column it looks at, and whether it is no leaf; at a leaf, no
    code is above the last one on its left, and a row stays.

    Sets of categories are columns behind those of the features, which hold whether a row's category goes to the right.
    """

    def __init__(self, tree: grow.Tree, arity: np.ndarray):
        self.right, self.shares, inner = tree.right, tree.shares, tree.feature >= 0
        column, cut = np.where(inner, tree.feature, 0).astype("int64"), np.where(inner, tree.cut, 0xFFFF).astype("int64")
        by_set = np.flatnonzero(inner & (arity[column] > 0))
        pairs, which = np.unique(np.stack([column[by_set], cut[by_set]], axis=1), axis=0, return_inverse=True)
        column[by_set], cut[by_set] = len(arity) + which, 0
        self.nodes = tree.right.astype("int64") << 32 | cut << 16 | column << 1 | inner
        self.width, self.tables = len(arity) + len(pairs), []
        for f in np.unique(pairs[:, 0]):
            mine = np.flatnonzero(pairs[:, 0] == f)
            right = tree.sets[pairs[mine, 1], : arity[f]]
            # Values out of range are on the side that a list of the shorter one would not name.
            rest = (~right).sum(axis=1) <= arity[f] / 2
            self.tables.append((f, slice(len(arity) + mine[0], len(arity) + mine[-1] + 1), np.column_stack([right, rest]).T.astype("int16")))

    def votes(self, codes: np.ndarray) -> np.ndarray:
        """The class shares of every row's leaf; ``codes`` has room for the columns of the sets."""
        for f, columns, table in self.tables:
            codes[:, columns] = table[codes[:, f]]
        flat, base = codes.ravel(), np.arange(len(codes)) * codes.shape[1]
        leaf, at, k = np.empty(len(codes), dtype="int64"), np.arange(len(codes)), np.zeros(len(codes), dtype="int64")
        while True:
            node = self.nodes.take(k)
            inner = node & 1
            walking = np.count_nonzero(inner)
            if walking < 0.75 * len(k):
                leaf[at] = k
                some = np.flatnonzero(inner)
                if not len(some):
                    return self.shares[self.right[leaf]]
                at, k, base, node, inner = at[some], k[some], base[some], node[some], inner[some]
            value = flat.take(base + (node >> 1 & 0x7FFF))
            k = np.where(value > (node >> 16 & 0xFFFF), node >> 32, k + inner)


class WalkedForest:
    """Large trees, read from the model's folder where they are used: a row walks down each of them."""

    def __init__(self, path: str, about: dict):
        self.cuts, self.arity, self.classes = [np.array(c) for c in about["cuts"]], np.array(about["arity"]), about["classes"]
        self.trees = [_Walk(t, self.arity) for t in grow.trees(path, self.classes, max([1, *about["arity"]]))]
        self.width = max(t.width for t in self.trees)

    def _codes(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.width), dtype="int16")
        for f, n in enumerate(self.arity):
            c = x[:, f]
            out[:, f] = np.where((c >= 0) & (c < n) & (c == np.floor(c)), c, n) if n else np.searchsorted(self.cuts[f], c, side="left")
        return out

    def votes(self, x: np.ndarray) -> np.ndarray:
        """Sums of the trees' class shares, one row per row of ``x``."""
        out, rows = np.zeros((len(x), self.classes)), max(1, CODES // self.width)
        for start in range(0, len(x), rows):
            codes = self._codes(x[start : start + rows])
            for tree in self.trees:
                out[start : start + rows] += tree.votes(codes)
        return out

    def scored(self, x: np.ndarray) -> pa.Array:
        return _shares(self.votes(x))


@functools.lru_cache(maxsize=4)
def _walked(path: str, about: str) -> WalkedForest:
    return WalkedForest(path, json.loads(about))


def _node_rows(model: ForestModel, spark) -> list[dict]:
    """The nodes of a grown forest as Spark's node table has them, with the shares of leaves."""
    about, out = model.about, []
    for number, t in enumerate(grow.trees(with_scheme(spark, model.path), about["classes"], max([1, *about["arity"]]))):
        for i, (f, cut, to) in enumerate(zip(t.feature.tolist(), t.cut.tolist(), t.right.tolist())):
            node = {"tree": number, "id": i, "left": -1, "right": -1, "stats": [0.0] * about["classes"]}
            if f < 0:
                out.append(node | {"shares": t.shares[to]})
                continue
            n = about["arity"][f]
            sides = np.flatnonzero(~t.sets[cut, :n]).tolist() if n else [about["cuts"][f][cut]]
            out.append(node | {"left": i + 1, "right": to, "split": {"featureIndex": f, "numCategories": n or -1, "leftCategoriesOrThreshold": sides}})
    return out


def packed(model: RandomForestClassificationModel | ForestModel, spark) -> PackedForest:
    """The forest of a fitted model, read from the node table it saves; kept with the model."""
    if not hasattr(model, "_packed") and isinstance(model, ForestModel):
        model._packed = PackedForest(_node_rows(model, spark))
    if not hasattr(model, "_packed"):
        path = work_path(spark, "forest")
        model.write().save(path)
        n = "nodeData"
        nodes = spark.read.parquet(f"{path}/data").select(
            F.col("treeID").alias("tree"), f"{n}.id", F.col(f"{n}.leftChild").alias("left"), F.col(f"{n}.rightChild").alias("right"),
            F.col(f"{n}.impurityStats").alias("stats"), f"{n}.split",
        )
        model._packed = PackedForest(nodes.orderBy("tree", "id").toArrow().to_pylist())
    return model._packed


def numbers_of(stages, column: str) -> list[tuple[str, float, float]] | None:
    """What a feature vector is made of: the columns with what is taken from each and what it is then multiplied by; None where it can't be told."""
    for stage in stages:
        if isinstance(stage, VectorAssembler) and stage.getOutputCol() == column:
            parts = [numbers_of(stages, c) for c in stage.getInputCols()]
            return None if None in parts or stage.getHandleInvalid() != "keep" else [n for part in parts for n in part]
        if isinstance(stage, StandardScalerModel) and stage.getOutputCol() == column:
            parts = numbers_of(stages, stage.getInputCol())
            if parts is None or not (stage.getWithMean() and stage.getWithStd()) or any(n[1:] != (0.0, 1.0) for n in parts):
                return None
            return [(c, m, 1.0 / d if d else 0.0) for (c, _, _), m, d in zip(parts, stage.mean.toArray().tolist(), stage.std.toArray().tolist())]
    return [(column, 0.0, 1.0)]


def with_scores(model: PipelineModel, df: DataFrame, out: str) -> DataFrame:
    """``df`` with the columns of the preparation, and ``out``: the probabilities and the likeliest class of a pipeline that ends in a classifier.

    A forest takes plain numbers, which are scaled batch by batch as Spark scales vectors; the vectors are made only where they are read.
    """
    *stages, last = model.stages
    numbers = numbers_of(stages, last.getFeaturesCol())
    for stage in stages:
        df = stage.transform(df)
    if numbers and all(isinstance(df.schema[c].dataType, T.NumericType) for c, _, _ in numbers):
        return _scored(last, df, numbers, out)
    return _scored(last, df, None, out)


def side_by_side(models: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """``df`` with a column per pipeline, as ``with_scores`` makes it, for forests that can be fed from columns of ``df``: rows go to the workers
    once for all of them."""
    spark, found = df.sparkSession, {}
    for out, model in models.items():
        *stages, last = model.stages
        numbers = numbers_of(stages, last.getFeaturesCol())
        if not _is_packable(last) or not numbers or not {c for c, _, _ in numbers} <= set(df.columns):
            raise ValueError(f"{out} is no forest over the columns {df.columns}")
        found[out] = _votes(last, spark, numbers)
    return df.withColumns(found)


def _is_packable(model) -> bool:
    return isinstance(model, ForestModel) or isinstance(model, RandomForestClassificationModel) and not model.isDefined(model.thresholds)


def _scored(model, df: DataFrame, numbers: list[tuple[str, float, float]] | None, out: str) -> DataFrame:
    if not _is_packable(model):
        made = model.getProbabilityCol(), model.getPredictionCol()
        found = F.struct(vector_to_array(made[0]).alias("probs"), F.col(made[1]).alias("said"))
        return model.transform(df).withColumn(out, found).drop(*made, model.getRawPredictionCol())
    return df.withColumn(out, _votes(model, df.sparkSession, numbers))


def _votes(model: RandomForestClassificationModel | ForestModel, spark, numbers: list[tuple[str, float, float]] | None, walk: bool = False) -> Column:
    ship_package(spark)
    less, times = (np.array([n[i] for n in numbers or []]) for i in (1, 2))
    if walk or isinstance(model, ForestModel) and model.about["most_leaves"] > MASKED_LEAVES:
        path, about = with_scheme(spark, model.path), json.dumps(model.about)
        forest = lambda: _walked(path, about)
    else:
        shared = spark.sparkContext.broadcast(packed(model, spark))
        forest = lambda: shared.value

    def scored(vectors: pa.Array) -> pa.Array:
        return forest().scored(vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1))

    def scaled(*columns: pa.Array) -> pa.Array:
        return forest().scored((np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns]) - less) * times)

    # Called nondeterministic so that the optimizer neither copies it nor pushes filters on its result below it.
    found = F.arrow_udf(scaled if numbers else scored, "probs array<double>, said double").asNondeterministic()
    given = [F.col(c).cast("double") for c, _, _ in numbers] if numbers else [vector_to_array(model.getFeaturesCol())]
    return found(*given)


def _named(model, df: DataFrame) -> DataFrame:
    return df.withColumns({model.getProbabilityCol(): array_to_vector("_found.probs"), model.getPredictionCol(): F.col("_found.said")}).drop("_found")


def walked(model: ForestModel, df: DataFrame) -> DataFrame:
    """``df`` with the probability and prediction columns of a grown forest, every row walking down its trees."""
    return _named(model, df.withColumn("_found", _votes(model, df.sparkSession, None, walk=True)))


def classify(model, df: DataFrame) -> DataFrame:
    """``df`` with the probability and prediction columns of a fitted classifier; forests are scored batch by batch."""
    if not _is_packable(model):
        return model.transform(df)
    return _named(model, _scored(model, df, None, "_found"))


def transform(model, df: DataFrame) -> DataFrame:
    """``model.transform`` of a pipeline that ends in a classifier."""
    *stages, last = model.stages
    if not _is_packable(last):
        return model.transform(df)
    return _named(last, with_scores(model, df, "_found"))
