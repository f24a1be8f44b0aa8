"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

Texts are split at the tokenizer's special strings and by its published pattern. Words not seen before are encoded together:
their symbols lie in one flat array, each round looks up all neighbouring pairs by binary search in the sorted pair
keys, takes the lowest rank of every word and merges its occurrences from left to right, until no word has a known pair.
A worker remembers words up to a fixed number; this changes time only, never results.

Decoding joins the bytes of the ids' tokens and reads them as UTF-8 with the replacement character for broken sequences.
Defined results: a null text counts as empty and has no ids; whole texts are encoded whatever their length; repeated rows get
equal results; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowwarden.llm.common import tidy

#: The published pre-tokenization pattern of byte-level BPE. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A worker remembers between once and twice as many words.
REMEMBERED = 120_000
#: Characters of a longer word are not worth remembering.
LONG_WORD = 64


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: visible Latin-1 bytes for themselves, the others from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


class Bpe:
    def __init__(self, path: str, with_ids: bool = False):
        self.with_ids = with_ids
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        alphabet = byte_alphabet()
        byte_of = {c: bytes([b]) for b, c in enumerate(alphabet)}
        self.size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])], default=0) + 1
        self.bytes_of = [b""] * self.size
        for token, i in vocab.items():
            self.bytes_of[i] = b"".join(byte_of[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.base = np.array([vocab[c] for c in alphabet], dtype=np.int64)
        left, right, made = [], [], []
        for merge in spec["model"]["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left.append(vocab[a])
            right.append(vocab[b])
            made.append(vocab[a + b])
        keys = np.array(left, dtype=np.int64) * self.size + np.array(right, dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), np.array(made, dtype=np.int64)[order]
        self.words = regex.compile(PATTERN)
        self.splits = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.decimal = [str(i).encode() for i in range(self.size)]
        self.known: dict[str, object] = {}
        self.older: dict[str, object] = {}

    def _ranked(self, symbols: np.ndarray, owner: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and place in the key table of the pairs that begin at ``left``; the highest rank + 1 for none."""
        none = len(self.keys)
        right = np.minimum(left + 1, len(symbols) - 1)
        pair = symbols[left] * self.size + symbols[right]
        at = np.minimum(np.searchsorted(self.keys, pair), none - 1)
        known = (self.keys[at] == pair) & (owner[left] == owner[right]) & (right > left)
        return np.where(known, self.ranks[at], none), at

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        owner = np.repeat(np.arange(len(raw)), np.array([len(r) for r in raw], dtype=np.int64))
        symbols = self.base[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        none = len(self.keys)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        if not none or not len(symbols):
            done.append((owner, symbols))
            symbols = symbols[:0]
        else:
            rank, at = self._ranked(symbols, owner, np.arange(len(symbols)))
        while len(symbols):
            # Words lie one after another, so the lowest rank of each is a reduction over its range.
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            best = np.repeat(lowest, np.diff(np.r_[starts, len(owner)]))
            active = best < none
            if not active.all():  # finished words leave as a whole
                done.append((owner[~active], symbols[~active]))
                owner, symbols, rank, at, best = owner[active], symbols[active], rank[active], at[active], best[active]
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == best)
            # In a run of overlapping hits every second one merges, from the left.
            fresh = np.r_[True, hits[1:] != hits[:-1] + 1]
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(hits)), 0))
            hits = hits[(np.arange(len(hits)) - first) % 2 == 0]
            symbols[hits] = self.made[at[hits]]
            stay = np.ones(len(symbols), dtype=bool)
            stay[hits + 1] = False
            owner, symbols, rank, at = owner[stay], symbols[stay], rank[stay], at[stay]
            # Only the pairs beside a merge have changed.
            here = hits - np.arange(len(hits))
            touched = np.zeros(len(symbols), dtype=bool)
            touched[here] = touched[np.maximum(here - 1, 0)] = True
            changed = np.flatnonzero(touched)
            rank[changed], at[changed] = self._ranked(symbols, owner, changed)
        owners, ids = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
        order = np.argsort(owners, kind="stable")
        flat = ids[order].tolist()
        ends = np.searchsorted(owners[order], np.arange(len(raw) + 1)).tolist()
        return [flat[i:j] for i, j in zip(ends, ends[1:])]

    def _entry(self, ids: list[int]):
        if self.with_ids:
            return np.array(ids, dtype=np.int32).tobytes()
        return len(ids), b",".join([self.decimal[i] for i in ids]), b"".join([self.bytes_of[i] for i in ids])

    def pieces(self, text: str) -> list[str]:
        """Special strings and words of a text, in order."""
        if self.splits is None or not any(s in text for s in self.special):
            return self.words.findall(text)
        out = []
        for part in self.splits.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out.extend(self.words.findall(part))
        return out

    def encode(self, texts: list[str]) -> Iterator[list]:
        """For every text the entries of its pieces: (count, ids as decimals, bytes), or the ids as int32 bytes."""
        split = [self.pieces(t) for t in texts]
        if len(self.known) > REMEMBERED:  # words not seen again until this happens once more are forgotten
            self.known, self.older = {}, self.known
        known, older, extra = self.known, self.older, {}
        fresh = []
        for w in {w for words in split for w in words} - known.keys():
            if w in older:
                known[w] = older[w]
            elif w in self.special:
                extra[w] = self._entry([self.special[w]])
            else:
                fresh.append(w)
        for k in range(0, len(fresh), 20_000):
            part = fresh[k : k + 20_000]
            for word, ids in zip(part, self.encode_words(part)):
                (known if len(word) <= LONG_WORD else extra)[word] = self._entry(ids)
        for words in split:
            yield [known[w] if w in known else extra[w] for w in words] if extra else [known[w] for w in words]

    def decode(self, ids) -> str:
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def tokenizer(path: str, with_ids: bool = False) -> Bpe:
    """One tokenizer per worker process and file."""
    return Bpe(path, with_ids)


def _batches(column, size: int = 2_000_000):
    """Ranges of rows with about ``size`` characters."""
    texts, held = [], 0
    for t in column.to_pylist():
        t = t or ""
        texts.append(t)
        held += len(t)
        if held >= size:
            yield texts
            texts, held = [], 0
    if texts:
        yield texts


def _digests(batches, path: str, columns: list[str], text_col: str):
    bpe = tokenizer(path)
    for batch in batches:
        counts, ids, decoded = [], [], []
        for texts in _batches(batch.column(text_col)):
            for entries in bpe.encode(texts):
                counts.append(sum([e[0] for e in entries]))
                ids.append(hashlib.sha256(b",".join([e[1] for e in entries])).hexdigest())
                plain = b"".join([e[2] for e in entries]).decode("utf-8", "replace")
                decoded.append(hashlib.sha256(plain.encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in columns), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
            [*columns, "n_tokens", "ids_sha256", "decoded_sha256"],
        )
    bpe.older = {}  # a worker that waits for other work holds less


def _token_ids(batches, path: str, columns: list[str], text_col: str):
    bpe = tokenizer(path, True)
    for batch in batches:
        # Output goes out in parts, so that a batch of long texts is never held twice.
        start = 0
        for texts in _batches(batch.column(text_col)):
            parts = [b"".join(entries) for entries in bpe.encode(texts)]
            lengths = [len(p) // 4 for p in parts]
            ids = np.frombuffer(b"".join(parts), dtype=np.int32)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            rows = batch.slice(start, len(texts))
            start += len(texts)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in columns), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))],
                [*columns, "n_tokens", "ids"],
            )
    bpe.older = {}


def _schema(df: DataFrame, columns: list[str], extra: str) -> str:
    return ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns), extra])


def encode_texts(df: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns with n_tokens and ids (list of int) of every whole text."""
    columns = list(keep)
    out = _schema(df, columns, "n_tokens long, ids array<int>")
    source = df.select(*columns, F.col(text_col).alias("_text"))
    return source.mapInArrow(tidy(lambda it: _token_ids(it, path, columns, "_text")), out)


def encode_digests(df: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns with n_tokens, the digest of the ids and the digest of the text decoded from them."""
    columns = list(keep)
    out = _schema(df, columns, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    source = df.select(*columns, F.col(text_col).alias("_text"))
    return source.mapInArrow(tidy(lambda it: _digests(it, path, columns, "_text")), out)


def _decoded(batches, path: str, columns: list[str], ids_col: str):
    bpe = tokenizer(path)
    for batch in batches:
        texts = [bpe.decode(ids or []) for ids in batch.column(ids_col).to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(texts, pa.string())], [*columns, "text"])


def decode_ids(df: DataFrame, path: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns with the text of every list of ids; a null list gives an empty text."""
    columns = list(keep)
    source = df.select(*columns, F.col(ids_col).alias("_ids"))
    return source.mapInArrow(lambda it: _decoded(it, path, columns, "_ids"), _schema(df, columns, "text string"))
