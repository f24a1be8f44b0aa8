"""Hard negatives by angular triangle filtering.

Every row stores its norm and its angles to ``REFERENCES`` directions. By the triangle inequality on the sphere, the angle of two rows lies
between the largest difference of their stored angles and the smallest sum (or what is left of the sum to the full circle). Cosines of
these ends, times both norms, bound the score. The bounds are widened by more than rounding can take, so a row whose
bounds miss an anchor's window of scores can't lie in it; only the others get the integer product.

Rows are sorted by label and nearest direction and packed into slices of bounded rows and bytes, anchors into blocks likewise. Each slice and block has the
extremes of its angles and norms, which bound all scores between them: a block meets only those slices whose bounds reach one of its windows. A slice
gives at most k rows for an anchor and positive. Directions are fitted by a few rounds of spherical k-means on at most about ``MAX_SAMPLE`` rows,
chosen by a hash (the documented bound); they change the work, never the result.

Components become floor(scale * x), so scores are whole numbers, counted exactly; beyond 64 bits they count as the nearest 64-bit number. Defined results:
rows with a null id, a null label, a null vector or null or non-finite components take no part; only vectors of equal length are compared; rows
that share an anchor's id aren't its candidates; of the scores that the rows of two ids have together the best counts, as a negative the best
inside the window; ties go to the smaller id; zero vectors have score 0; anchors without positives have no rows; empty tables give no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowwarden.llm.common import exact_products, saved, usable, vectors, whole

SCALE = 256
REFERENCES = 16
COARSE = 4
MAX_SAMPLE = 20_000
#: Rows and bytes of a slice, and rows of a block of anchors.
SLICE_ROWS, BLOCK_ROWS = 8192, 1024
PACK_BYTES = 4 << 20
#: Widening of stored angles (32-bit floats of at most pi), and of score bounds.
ANGLE_SLACK, SCORE_SLACK = 2e-6, 1e-9


# --- stored angles


def directions(sample: np.ndarray, count: int = REFERENCES, seed: int = 11) -> np.ndarray:
    """Unit vectors: centres of a few rounds of spherical k-means, filled up by random ones."""
    rng = np.random.default_rng(seed)
    d = sample.shape[1]
    largest = np.abs(sample).max(axis=1, initial=0)
    x = sample[largest > 0] / largest[largest > 0, None]
    x /= np.sqrt((x**2).sum(axis=1, keepdims=True))
    centres = rng.normal(size=(count, d))
    if len(x):
        picked = rng.choice(len(x), min(count, len(x)), replace=False)
        centres[: len(picked)] = x[picked]
        for _ in range(5):
            near = np.argmax(x @ centres.T, axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, x)
            centres = np.where(np.abs(sums).sum(axis=1, keepdims=True) > 0, sums, centres)
            centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300)
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300)


def of_length(fitted: dict[int, np.ndarray], length: int) -> np.ndarray:
    """Directions for vectors of a length; lengths that the sample misses get random ones."""
    if length not in fitted:
        fitted[length] = directions(np.empty((0, length)), seed=length)
    return fitted[length]


def angles(q: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to every direction. Large numbers are scaled first."""
    largest = np.abs(q).max(axis=1, initial=0)[:, None]
    one = q / np.where(largest > 0, largest, 1)
    norm = np.sqrt((one * one).sum(axis=1))
    cos = one @ refs.T / np.where(norm > 0, norm, 1)[:, None]
    return norm * largest[:, 0], np.arccos(np.clip(cos, -1, 1)).astype(np.float32)


def score_bounds(norms: np.ndarray, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest scores, from products of norms and the ends of the angle."""
    slack = 1 + SCORE_SLACK * norms
    low = norms * np.cos(np.minimum(far + ANGLE_SLACK, np.pi)) - slack
    return low, norms * np.cos(np.maximum(near - ANGLE_SLACK, 0)) + slack


def between(of_rows: np.ndarray, of_one: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the angle between every row and one vector, from their stored angles."""
    sums = of_rows + of_one
    return np.abs(of_rows - of_one).max(axis=1), np.minimum(sums, 2 * np.pi - sums).min(axis=1)


# --- slices and blocks

_STATS = "lo array<double>, hi array<double>, norm_lo double, norm_hi double"
_PACK = f"pack long, length int, n int, labels_in array<long>, ids array<long>, labels binary, q binary, kind string, norms binary, angles binary, {_STATS}"
_PACK_ARROW = pa.schema(
    [("pack", pa.int64()), ("length", pa.int32()), ("n", pa.int32()), ("labels_in", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())), ("labels", pa.binary()),
     ("q", pa.binary()), ("kind", pa.string()), ("norms", pa.binary()), ("angles", pa.binary()), ("lo", pa.list_(pa.float64())),
     ("hi", pa.list_(pa.float64())), ("norm_lo", pa.float64()), ("norm_hi", pa.float64())]
)


def _pack(fitted, scale: float, most: int):
    """Sorted rows (id, label, vector) to packs of one length, numbered by task and place."""

    def run(batches):
        held: list[tuple] = []
        rows, number, task = 0, 0, TaskContext.get().partitionId()

        def packed(parts: list[tuple]) -> pa.RecordBatch:
            nonlocal number
            number += 1
            ids, labels, q, norms, angle = (np.concatenate(c) for c in zip(*parts))
            largest = np.abs(q).max(initial=0)
            kind = "<i2" if largest < 2**15 else "<i4" if largest < 2**31 else "<f8"
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([v], t) for v, t in zip(
                        ((task << 32) + number, q.shape[1], len(ids), np.unique(labels).tolist(), ids.tolist(), labels.tobytes(), q.astype(kind).tobytes(),
                         kind, norms.tobytes(), angle.tobytes(), angle.min(axis=0).tolist(), angle.max(axis=0).tolist(), norms.min(), norms.max()),
                        _PACK_ARROW.types,
                    )
                ],
                schema=_PACK_ARROW,
            )

        for batch in batches:
            lengths = batch.column("length").to_numpy()
            cuts = np.flatnonzero(np.diff(lengths)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(lengths)]):
                if start == end:
                    continue
                part = batch.slice(start, end - start)
                q = whole(vectors(part.column("vector")), scale)
                new = (part.column("id").to_numpy(), part.column("label").to_numpy(), q, *angles(q, of_length(fitted.value, q.shape[1])))
                limit = max(1, min(most, PACK_BYTES // (8 * q.shape[1] + 4 * REFERENCES + 24)))
                if held and held[0][2].shape[1] != q.shape[1]:
                    yield packed(held)
                    held, rows = [], 0
                at = 0
                while at < end - start:
                    taken = min(limit - rows, end - start - at)
                    held.append(tuple(c[at : at + taken] for c in new))
                    rows, at = rows + taken, at + taken
                    if rows >= limit:
                        yield packed(held)
                        held, rows = [], 0
        if held:
            yield packed(held)

    return run


def _nearest(fitted, scale: float):
    """The nearest direction of every row, to sort by."""

    def run(batches):
        for batch in batches:
            cells = np.zeros(batch.num_rows, dtype=np.int32)
            lengths = batch.column("length").to_numpy()
            for one in np.unique(lengths):
                some = np.flatnonzero(lengths == one)
                if one:
                    q = whole(vectors(batch.column("vector").take(pa.array(some))), scale)
                    cells[some] = angles(q, of_length(fitted.value, int(one)))[1].argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], [*batch.schema.names, "cell"])

    return run


class Pack:
    """The arrays of a slice or block, from one row of a batch."""

    def __init__(self, batch: pa.RecordBatch, row: int, prefix: str) -> None:
        get = lambda name: batch.column(prefix + name)[row]
        n, d = get("n").as_py(), get("length").as_py()
        self.ids, self.labels = get("ids").values.to_numpy(), np.frombuffer(get("labels").as_py(), np.int64)
        self.q = np.frombuffer(get("q").as_py(), get("kind").as_py()).reshape(n, d).astype(np.float64)
        self.largest = np.abs(self.q).max(axis=1, initial=0)
        self.norms = np.frombuffer(get("norms").as_py(), np.float64)
        self.angles = np.frombuffer(get("angles").as_py(), np.float32).reshape(n, -1).astype(np.float64)

    def scores(self, rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
        return exact_products(self.q[rows], vector, self.largest[rows])


# --- the two searches


def first_ids(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k ids with the best scores, ties to the smaller id."""
    order = np.lexsort((ids, ~scores))  # -scores may not fit
    return order[np.sort(np.unique(ids[order], return_index=True)[1])[:k]]


def best_of_label(anchors: Pack, x: Pack, k: int) -> Iterator[tuple]:
    """(anchor row, rows of x, scores) of the k best rows of the anchor's label."""
    rows_of = {label: np.flatnonzero(x.labels == label) for label in np.unique(anchors.labels)}
    for i, (own, label) in enumerate(zip(anchors.ids, anchors.labels)):
        some = rows_of[label]
        some = some[x.ids[some] != own]
        if not len(some):
            continue
        near, far = between(x.angles[some], anchors.angles[i])
        _, high = score_bounds(anchors.norms[i] * x.norms[some], near, far)
        seeds = some[np.argsort(-high, kind="stable")[: 4 * k]]
        scores = x.scores(seeds, anchors.q[i])
        kept = first_ids(scores, x.ids[seeds], k)
        if len(kept) == k:  # else there may be fewer ids than k
            some = some[high >= scores[kept].min()]
        scores = x.scores(some, anchors.q[i])
        kept = first_ids(scores, x.ids[some], k)
        yield i, some[kept], scores[kept]


def in_windows(anchors: Pack, windows: list[list[tuple[int, int, int]]], x: Pack, k: int) -> Iterator[tuple]:
    """(anchor row, positive's place, rows of x, scores) of the k best rows of other labels in every window (positive, least, largest)."""
    by = int(np.ptp(x.angles, axis=0).argmax())
    order = np.argsort(x.angles[:, by], kind="stable")
    along, largest = x.angles[order, by], x.norms.max()
    for i, wanted in enumerate(windows):
        wanted = [(p, lo, hi) for p, lo, hi in wanted if lo <= hi]
        if not wanted:
            continue
        least, most = min(w[1] for w in wanted), max(w[2] for w in wanted)
        reach = np.pi
        top = anchors.norms[i] * largest * (1 + SCORE_SLACK) + 1
        if least > 0:
            if least > top:
                continue
            reach = math.acos(max(-1.0, min(1.0, (least - 1) / top))) + 2 * ANGLE_SLACK
        # One direction gives a range of the sorted slice, a few more thin it out, all of them decide.
        here = anchors.angles[i]
        some = order[np.searchsorted(along, here[by] - reach) : np.searchsorted(along, here[by] + reach, "right")]
        some = some[(x.labels[some] != anchors.labels[i]) & (x.ids[some] != anchors.ids[i])]
        for columns in (slice(0, COARSE), slice(None)):
            near, far = between(x.angles[some, columns], here[columns])
            low, high = score_bounds(anchors.norms[i] * x.norms[some], near, far)
            some = some[(high >= least) & (low <= most)]
        if not len(some):
            continue
        scores = x.scores(some, anchors.q[i])
        for positive, lo, hi in wanted:
            fits = np.flatnonzero((scores >= lo) & (scores <= hi))
            kept = fits[first_ids(scores[fits], x.ids[some[fits]], k)]
            yield i, positive, some[kept], scores[kept]


def _positives(k: int):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                anchors, x = Pack(batch, row, "b_"), Pack(batch, row, "s_")
                for i, rows, scores in best_of_label(anchors, x, k):
                    own = np.full(len(rows), anchors.ids[i])
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (own, x.ids[rows], scores)], ["anchor_id", "vec_id", "score"])

    return run


def _negatives(k: int, low: int, high: int):
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                anchors, x = Pack(batch, row, "b_"), Pack(batch, row, "s_")
                aims = zip(*(batch.column(c)[row].as_py() for c in ("anchors", "positives", "scores")))
                scores = {(a, p): s for a, p, s in aims}
                of_anchor: dict[int, list] = {}
                for (a, p), s in scores.items():
                    of_anchor.setdefault(a, []).append((p, -(-low * s // 100), high * s // 100))
                windows = [of_anchor.get(int(a), []) for a in anchors.ids]
                for i, positive, rows, found in in_windows(anchors, windows, x, k):
                    own = int(anchors.ids[i])
                    columns = (np.full(len(rows), own), np.full(len(rows), positive), np.full(len(rows), scores[own, positive]), x.ids[rows], found)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run


def _ranked(found: DataFrame, keys: list[str], vec: str, score: str, k: int) -> DataFrame:
    best = found.groupBy(*keys, vec).agg(F.max(score).alias(score))
    order = Window.partitionBy(*keys).orderBy(F.desc(score), vec)
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*(F.col(c).alias(prefix + c) for c in df.columns))


def _meeting(blocks: DataFrame, slices: DataFrame, spread: int, condition: Column | None = None, by_label: bool = False) -> DataFrame:
    """(b_pack, s_pack) of the blocks and slices to compare, from their statistics alone. Slices are dealt to ``spread`` parts, so that
    no part has more than a bounded number of them."""
    light = ["pack", "length", "lo", "hi", "norm_lo", "norm_hi"]
    extra = [c for c in ("least", "most") if c in blocks.columns]
    s = _prefixed(slices.select(*light, "labels_in"), "s_").withColumn("part", F.pmod(F.xxhash64("s_pack"), F.lit(spread)))
    b = _prefixed(blocks.select(*light, "labels_in", *extra), "b_").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))))
    on = (b["b_length"] == s["s_length"]) & (b["part"] == s["part"])
    if by_label:
        b, s = (d.withColumn(f"{p}label", F.explode(f"{p}labels_in")) for d, p in ((b, "b_"), (s, "s_")))
        on = (b["b_length"] == s["s_length"]) & (b["part"] == s["part"]) & (b["b_label"] == s["s_label"])
    if condition is not None:
        on &= condition
    met = b.join(s, on).select("b_pack", "s_pack")
    return met.distinct() if by_label else met


def _reach() -> Column:
    """Whether the scores between a block and a slice can lie between the block's least and most."""
    near = F.array_max(F.zip_with(F.arrays_zip("b_lo", "b_hi"), F.arrays_zip("s_lo", "s_hi"), lambda b, s: F.greatest(F.lit(0.0), b["b_lo"] - s["s_hi"], s["s_lo"] - b["b_hi"])))
    far = F.array_min(
        F.zip_with(
            F.arrays_zip("b_lo", "b_hi"), F.arrays_zip("s_lo", "s_hi"),
            lambda b, s: F.least(b["b_hi"] + s["s_hi"], F.lit(2 * math.pi) - b["b_lo"] - s["s_lo"]),
        )
    )
    largest = F.col("b_norm_hi") * F.col("s_norm_hi")
    slack = largest * SCORE_SLACK + 1

    def at(angle: Column, up: bool) -> Column:
        cos = F.cos(angle)
        wide, narrow = largest, F.col("b_norm_lo") * F.col("s_norm_lo")
        return cos * F.when((cos >= 0) == F.lit(up), wide).otherwise(narrow)

    high = at(F.greatest(near - ANGLE_SLACK, F.lit(0.0)), True) + slack
    low = at(F.least(far + ANGLE_SLACK, F.lit(math.pi)), False) - slack
    return (high >= F.col("b_least")) & (low <= F.col("b_most"))


def hard_negatives(
    df: DataFrame, pick_anchors, k: int = 10, positives: int = 5, low: int = 30, high: int = 90, id_col: str = "vec_id",
    vector_col: str = "embedding", label_col: str = "label", scale: float = SCALE, max_sample: int = MAX_SAMPLE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: per anchor and each of its best ``positives`` rows of the same label,
    the first k rows of other labels with low % of the positive's score <= score <= high % of it."""
    spark = df.sparkSession
    rows = df.where(usable(vector_col) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"),
        F.size(vector_col).alias("length"),
    )
    n = rows.count()
    share = min(1.0, max_sample / max(1, n))
    chosen = rows.where(F.pmod(F.xxhash64("id", "vector"), F.lit(1_000_000)) < int(1e6 * share)).orderBy(F.xxhash64("id", "vector")).limit(2 * max_sample)
    sample = chosen.select("vector", "length").toArrow()
    fitted = {}
    for one in set(sample["length"].to_pylist()) - {0}:
        some = sample.filter(pc.equal(sample["length"], one)) if sample.num_rows else sample
        fitted[one] = directions(vectors(some["vector"]))
    fitted = spark.sparkContext.broadcast(fitted)
    kind = rows.schema["vector"].dataType.simpleString()

    def packs(some: DataFrame, most: int, name: str) -> DataFrame:
        order = ("length", "label", "cell", "id")
        placed = some.mapInArrow(_nearest(fitted, scale), f"id long, label long, vector {kind}, length int, cell int")
        ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
        return saved(ordered.mapInArrow(_pack(fitted, scale, most), _PACK), name)

    slices = packs(rows, SLICE_ROWS, "negatives-slices")
    blocks = packs(rows.where(pick_anchors(F.col("id"))), BLOCK_ROWS, "negatives-blocks")
    n_slices = slices.count()
    spread = max(1, n_slices // 1024)
    # As many tasks as there may be pairs, at most a few for every core: pairs are dealt by number, as their bytes say little of the work.
    tasks = min(max(1, n_slices * blocks.count()), max(4 * spark.sparkContext.defaultParallelism, n_slices))

    def together(met: DataFrame, blocks: DataFrame) -> DataFrame:
        both = met.join(_prefixed(blocks, "b_"), "b_pack").join(_prefixed(slices, "s_"), "s_pack")
        return both.repartition(tasks, "s_pack", "b_pack")

    used = ("n", "length", "ids", "labels", "q", "kind", "norms", "angles")
    columns = [f"{p}_{c}" for p in ("b", "s") for c in used]
    met = _meeting(blocks, slices, spread, by_label=True)
    found = together(met, blocks).select(*columns).mapInArrow(_positives(positives), "anchor_id long, vec_id long, score long")
    best = saved(_ranked(found, ["anchor_id"], "vec_id", "score", positives), "negatives-positives")
    # Of every block: its anchors' positives, and the ends of all their windows.
    of_block = blocks.select("pack", F.explode("ids").alias("anchor_id")).distinct().join(best, "anchor_id").where((F.col("score") >= 0) | F.lit(low == high))
    aims = of_block.groupBy("pack").agg(
        F.collect_list(F.struct("anchor_id", "vec_id", "score")).alias("aims"),
        F.min(F.col("score") * (low / 100)).alias("least"), F.max(F.col("score") * (high / 100)).alias("most"),
    ).select("pack", F.col("aims.anchor_id").alias("anchors"), F.col("aims.vec_id").alias("positives"), F.col("aims.score").alias("scores"), "least", "most")
    aimed = blocks.join(aims, "pack")
    met = _meeting(aimed, slices, spread, _reach())
    wide = together(met, aimed).select(
        *columns, F.col("b_anchors").alias("anchors"), F.col("b_positives").alias("positives"), F.col("b_scores").alias("scores")
    )
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = wide.mapInArrow(_negatives(k, low, high), schema)
    ranked = _ranked(found, ["anchor_id", "positive_id", "positive_score"], "negative_id", "negative_score", k)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
