"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A word is the bag of its byte n-grams (3 to 5, with word marks) and of itself, hashed into a fixed number of vectors; its vector is
their mean, so a misspelling shares most of it. The words of a window of ``WINDOW`` words, one from every word on, are averaged, a softmax over two
classes reads the average, and a text is as toxic as its worst window: whole texts count, and a long one doesn't thin out one
toxic passage. Vectors and softmax are trained jointly by gradient descent in numpy on at most ``MAX_TRAIN`` labelled texts per class
(and ``MAX_TRAIN_BYTES`` of text); scoring needs one number per bucket, the vector's part in the difference of both classes.

Inputs of a score are the words only. Defined results: null, empty and blank texts get the score of no window, which is the
prior; with labels of one kind, or none, every text gets
log odds of 50 or -50; repeated texts get equal scores;
rows with a null label are not learned from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowwarden.llm.common import mix, row_chunks, saved, text_bytes, tidy

BUCKETS = 1 << 16
DIMENSIONS = 8
GRAMS = (3, 4, 5)
WINDOW = 2
MAX_TRAIN = 2000
MAX_TRAIN_BYTES = 14_000_000
EPOCHS = 60
#: Pull of all weights towards zero.
DECAY = 1e-4
THRESHOLD = 0.3
CHUNK_BYTES = 1_000_000
EDGES = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different words, the index of every word among them, and n + 1 offsets of the rows."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")))
    flat = pc.utf8_trim(lists.flatten(), characters=EDGES)
    named = pc.not_equal(flat, "")
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    kept = named.to_numpy(zero_copy_only=False)
    offsets = np.r_[0, np.cumsum(kept)][offsets]
    coded = flat.filter(named).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), offsets


def subwords(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every n-gram of every word and of the word itself."""
    marked = pc.binary_join_element_wise(*(pa.scalar(v, pa.large_string()) if isinstance(v, str) else v for v in ("<", words.cast(pa.large_string()), ">", ""))).cast(pa.large_binary())
    offsets = np.frombuffer(marked.buffers()[1], dtype=np.int64)[marked.offset : marked.offset + len(marked) + 1]
    data = np.frombuffer(marked.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64) if len(marked) else np.empty(0, np.uint64)
    offsets = offsets - offsets[0]
    owner = np.repeat(np.arange(len(marked), dtype=np.int32), np.diff(offsets))
    data = mix(data + np.uint64(1))
    words_out, buckets_out = [], []
    for n in GRAMS:
        last = len(data) - n + 1
        if last <= 0:
            continue
        total = np.zeros(last, dtype=np.uint64)
        for k in range(n):
            total = total * np.uint64(0x2545F4914F6CDD1D) + data[k : k + last]
        inside = owner[:last] == owner[n - 1 :]
        words_out.append(owner[:last][inside])
        buckets_out.append((mix(total[inside] + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int32))
    if len(marked):
        place = np.arange(len(data)) - offsets[owner]
        whole = np.add.reduceat(mix(data + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), offsets[:-1])
        words_out.append(np.arange(len(marked), dtype=np.int32))
        buckets_out.append((mix(whole) % np.uint64(BUCKETS)).astype(np.int32))
    if not words_out:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    return np.concatenate(words_out), np.concatenate(buckets_out)


def windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, row and length of every window: one begins at every word but the last ones of its row; a row of fewer words is one window, and
    rows without words have none."""
    words = np.diff(offsets)
    counts = np.where(words > 0, np.maximum(words - WINDOW + 1, 1), 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    return offsets[rows] + place, rows, np.minimum(words, WINDOW)[rows]


def window_means(value: np.ndarray, index: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = value[index[starts]]
    for k in range(1, WINDOW):
        more = lengths > k
        total[more] += value[index[starts[more] + k]]
    return total / lengths


class Bags:
    """The buckets of every word, in blocks of words, so that work arrays stay small."""

    BLOCK = 20_000

    def __init__(self, words: pa.Array):
        self.blocks = []
        for a in range(0, len(words), self.BLOCK):
            part = words.slice(a, self.BLOCK)
            owner, bucket = subwords(part)
            order = np.argsort(owner, kind="stable")
            starts = np.searchsorted(owner[order], np.arange(len(part)))
            self.blocks.append((bucket[order], starts, np.diff(np.r_[starts, len(bucket)])))

    def mean(self, table: np.ndarray) -> np.ndarray:
        """Per word the mean of ``table`` over its buckets; every word has at least one."""
        parts = [np.add.reduceat(table[bucket], starts) / size for bucket, starts, size in self.blocks]
        return np.concatenate(parts) if parts else np.empty(0)

    def spread(self, by_word: np.ndarray) -> np.ndarray:
        """Per bucket the sum of what its words pass on: the transpose of ``mean``."""
        out, a = np.zeros(BUCKETS), 0
        for bucket, _, size in self.blocks:
            part = by_word[a : a + len(size)] / size
            out += np.bincount(bucket, weights=np.repeat(part, size), minlength=BUCKETS)
            a += len(size)
        return out


@dataclass
class ToxicityModel:
    """One weight per bucket, a bias for texts with words, and the prior for the others (all as log odds)."""

    weights: np.ndarray
    bias: float
    prior: float

    def log_odds(self, texts: pa.Array) -> np.ndarray:
        words, index, offsets = split_words(texts)
        out = np.full(len(offsets) - 1, self.prior)
        if not len(index):
            return out
        value = Bags(words).mean(self.weights)
        starts, rows, lengths = windows(offsets)
        score = window_means(value, index, starts, lengths)
        best = np.maximum.reduceat(score, np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]))
        out[np.unique(rows)] = best + self.bias
        return out


def fit(texts: pa.Array, labels: np.ndarray, prior: float, epochs: int = EPOCHS, seed: int = 3) -> ToxicityModel:
    """Gradient descent (Adam) over all texts; classes weigh the same, ``prior`` (log odds) is put back at the end."""
    rng = np.random.default_rng(seed)
    words, index, offsets = split_words(texts)
    bags, n_words = Bags(words), len(words)
    del words
    starts, rows, lengths = windows(offsets)
    if not len(starts):
        return ToxicityModel(np.zeros(BUCKETS), prior, prior)
    ends = np.diff(np.r_[np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]), len(rows)])
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    texts_with = rows[first]
    y = labels[texts_with].astype(np.float64)
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))

    vectors = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    softmax = rng.normal(0, 0.5, (2, DIMENSIONS))
    bias = np.zeros(1)
    state = [(p, np.zeros_like(p), np.zeros_like(p)) for p in (vectors, softmax, bias)]
    for step in range(1, epochs + 1):
        way = softmax[1] - softmax[0]
        value = bags.mean(vectors @ way)
        score = window_means(value, index, starts, lengths)
        top = np.maximum.reduceat(score, first)
        # The first window that reaches the text's highest score carries its gradient.
        hit = np.flatnonzero(score == np.repeat(top, ends))
        hit = hit[np.unique(rows[hit], return_index=True)[1]]
        odds = top + bias[0]
        error = (1 / (1 + np.exp(-odds)) - y) * share
        spread = np.repeat(error / lengths[hit], lengths[hit])
        inside = np.repeat(starts[hit] - (np.cumsum(lengths[hit]) - lengths[hit]), lengths[hit]) + np.arange(len(spread))
        by_bucket = bags.spread(np.bincount(index[inside], weights=spread, minlength=n_words))
        g_way = by_bucket @ vectors
        gradients = (by_bucket[:, None] * way, np.vstack([-g_way, g_way]), np.array([error.sum()]))
        for (p, m, v), g in zip(state, gradients):
            if p is not bias:
                g = g + DECAY * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return ToxicityModel(vectors @ (softmax[1] - softmax[0]), float(bias[0]) + prior, prior)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Fit on the texts of labelled rows. Texts come to the driver only up to the documented bounds.

    Ids are chosen by a hash, up to ``MAX_TRAIN`` per class; of the different texts under these ids, rows are chosen by a hash of id and text, up to ``MAX_TRAIN``
    and half of ``MAX_TRAIN_BYTES`` per class. The bounds are met in expectation, whatever the table's size and however often an id
    occurs; each class keeps one row at least.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), (F.col(label_col) == 1).cast("int").alias("label")
    )
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    bad, good = counts.get(1, 0), counts.get(0, 0)
    if not bad or not good:
        odds = -50.0 if not bad else 50.0
        return ToxicityModel(np.zeros(BUCKETS), odds, odds)

    def place(*columns: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(1_000_000))

    part = F.when(F.col("label") == 1, min(1.0, MAX_TRAIN / bad)).otherwise(min(1.0, MAX_TRAIN / good))
    chosen = saved(known.distinct().where(place("id") < part * 1_000_000), "label-sample")
    # At most about 2 * MAX_TRAIN ids.
    source = docs.select(F.col(id_col).alias("doc"), F.coalesce(text_col, F.lit("")).alias("text"))
    texts = source.join(F.broadcast(chosen), F.col("doc") == F.col("id")).select("id", "label", "text").distinct()
    texts = saved(texts.withColumn("place", place("id", "text")), "toxicity-sample")
    of_class = texts.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"), F.min("place").alias("least")).collect()
    kept = F.lit(False)
    for r in of_class:
        share = min(1.0, MAX_TRAIN / r["n"], MAX_TRAIN_BYTES / 2 / max(1, r["size"]))
        kept |= (F.col("label") == r["label"]) & ((F.col("place") < int(1e6 * share)) | (F.col("place") == r["least"]))
    texts = texts.where(kept).select(F.col("id").alias("_id"), F.col("label").alias("_label"), "text")
    held = texts.orderBy("_id", "text").toArrow()
    model = fit(held["text"].combine_chunks(), held["_label"].to_numpy(), float(np.log(bad / good)))
    del held
    pa.default_memory_pool().release_unused()
    return model


def _scores(model, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("_text")
            _, offsets = text_bytes(text)
            odds = [model.value.log_odds(text.slice(a, b - a)) for a, b in row_chunks(offsets, CHUNK_BYTES)]
            score = 1 / (1 + np.exp(-np.clip(np.concatenate(odds) if odds else np.empty(0), -500, 500)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(score)], [*columns, "score"])

    return run


def score(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The kept columns with score (0 to 1) and predicted (1 from ``threshold``) of every whole text."""
    inner = [f"_k{i}" for i in range(len(keep))]
    source = docs.select(*[F.col(f"`{c}`").alias(i) for c, i in zip(keep, inner)], F.col(text_col).alias("_text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    everywhere = docs.sparkSession.sparkContext.broadcast(model)
    out = source.mapInArrow(tidy(_scores(everywhere, inner)), f"{kinds + ', ' if kinds else ''}score double")
    return out.select(
        *[F.col(i).alias(c) for c, i in zip(keep, inner)], "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_clean(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs whose text is not predicted toxic, with all their columns."""
    everywhere = docs.sparkSession.sparkContext.broadcast(model)
    cut = float(np.log(threshold / (1 - threshold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(text_col)
            _, offsets = text_bytes(text)
            for a, b in row_chunks(offsets, CHUNK_BYTES):
                clean = everywhere.value.log_odds(text.slice(a, b - a)) < cut
                yield batch.slice(a, b - a).filter(pa.array(clean))

    return docs.mapInArrow(tidy(run), docs.schema)
