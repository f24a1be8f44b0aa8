"""Reading, intermediate tables and Arrow helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowwarden.session import materialise, ship_package

#: Rows and bytes of one Arrow batch, so that a batch of long texts stays small.
BATCH_ROWS = 1000
BATCH_BYTES = "4m"

#: Separators of words: space, tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, and this package on the Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: computed once, and safe when executors are lost."""
    return materialise(df, f"llm-{name}")


def tidy(run):
    """A function of Arrow batches that, at the end of a task, gives the memory it has freed back to the system: a worker waits for
    other tasks beside executors that need it."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return tidied


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows as one array, and n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    if not len(column):
        return whole[:0], np.zeros(1, np.int64)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, limit: int):
    """Ranges of rows with about ``limit`` bytes each; a longer row is a range of its own."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(rows, max(end, start + 1))
        yield start, end
        start = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer, so that sums and products of hashes spread over all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def usable(column: str, nonzero: bool = False):
    """True for a vector that is not null and holds finite numbers only (and, on demand, one that is not zero)."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = F.col(column).isNotNull() & F.coalesce(finite, F.lit(False))
    if nonzero:
        kept &= F.exists(column, lambda x: x != 0)
    return kept


#: Scaled components and scores are held within these.
LARGEST_COMPONENT = 1e150
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1


def whole(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), held within numbers whose products can be handled."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * scale), -LARGEST_COMPONENT, LARGEST_COMPONENT)


def exact_products(x: np.ndarray, y: np.ndarray, largest: np.ndarray | None = None) -> np.ndarray:
    """Inner products of the rows of ``x`` with ``y``, whole numbers in double precision, exactly; beyond 64 bits the nearest 64-bit number.

    ``largest`` has the largest absolute component of every row, where it is known.
    """
    if not len(x):
        return np.empty(0, np.int64)
    largest = np.abs(x).max(axis=1, initial=0) if largest is None else largest
    bound = largest * (np.abs(y).max(initial=0) * max(1, len(y)))
    if bound.max() < 2.0**52:
        return (x @ y).astype(np.int64)
    out = np.empty(len(x), np.int64)
    small, fits = bound < 2.0**52, bound < 2.0**62
    out[small] = (x[small] @ y).astype(np.int64)
    # A component that meets only zeros may be too large for an integer of 64 bits.
    middle = fits & ~small & (largest < 2.0**62)
    if middle.any():
        out[middle] = x[middle].astype(np.int64) @ y.astype(np.int64)
    for i in np.flatnonzero(~small & ~middle):
        out[i] = min(LONG_MAX, max(LONG_MIN, sum(int(a) * int(b) for a, b in zip(x[i], y))))
    return out


def with_lookup(rows: DataFrame, side: DataFrame, key: str, members: str, n: int) -> DataFrame:
    """``rows`` with the columns of ``side``, which has one row per key and says by how many of the ``n`` rows it is shared; nulls where it has none.

    Keys of more than a thousandth of the rows (so fewer than a thousand) are broadcast, the others joined; rows that the broadcast settles, and null keys, are
    spread by keys of their own. So no task gets more than a thousandth of the rows under one key.
    """
    limit = max(1000, n // 1000)
    columns = [c for c in side.columns if c not in (key, members)]
    renamed = lambda d, p: d.select(F.col(key).alias(f"{p}_key"), *(F.col(c).alias(f"{p}_{c}") for c in columns))
    rows = rows.join(F.broadcast(renamed(side.where(F.col(members) > limit), "hot")), F.col(key) == F.col("hot_key"), "left")
    alone = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
    rows = rows.withColumn("own_key", F.when(F.col("hot_key").isNotNull() | F.col(key).isNull(), alone).otherwise(F.col(key).cast("string")))
    rest = renamed(side.where(F.col(members) <= limit), "rest").withColumn("rest_key", F.col("rest_key").cast("string"))
    rows = rows.join(rest, F.col("own_key") == F.col("rest_key"), "left")
    looked_up = [F.coalesce(f"hot_{c}", f"rest_{c}").alias(c) for c in columns]
    helpers = {"hot_key", "own_key", "rest_key", *(f"{p}_{c}" for p in ("hot", "rest") for c in columns)}
    return rows.select(*(c for c in rows.columns if c not in helpers), *looked_up)
