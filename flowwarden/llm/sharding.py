"""Shards by a keyed permutation of global row numbers.

Rows are numbered from 0 in the order of (id, checksum, size). A Feistel network over [0, a) x [0, b)
with a * b >= rows permutes the numbers, results beyond the last row walk on along their cycle, and the
permuted number gives the shard (remainder) and the slot in it (quotient). So counts differ by at most one,
slots have no gaps, and the place of any row can be computed from its number alone.

Only DataFrame functions are used. Defined results: a null text counts as empty (its size is the overhead
alone, its checksum 0); a null id sorts first; equal rows take neighbouring numbers, so they may go to different
shards; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowwarden.llm.common import saved

OVERHEAD = 8
#: A prime under 2^31: products of two residues fit a long.
PRIME = 2147483647
ROUNDS = 6
#: Numbers that a*b may exceed the row count are a few; beyond so many steps no walk goes on.
MOST_STEPS = 48


def sides(n: int) -> tuple[int, int]:
    """a and b near the root of n with the smallest a * b >= n among some candidates."""
    root = max(1, math.isqrt(max(n, 1)))
    found = [(a * -(-n // a), a) for a in range(max(1, root - 64), root + 65)]
    least, a = min(found)
    return a, max(1, least // a)


def _keys(seed: int) -> list[int]:
    return [(seed * 7919 + 104729 * (k + 1) * (k + 1)) % PRIME for k in range(ROUNDS)]


def permuted_once(x: Column, n: int, seed: int) -> Column:
    """The network on [0, a * b): rounds add a function of one half to the other in turn."""
    a, b = (F.lit(v).cast("long") for v in sides(n))
    halves = F.struct(F.pmod(x, a).alias("l"), F.call_function("div", x, a).alias("r"))
    # One round per element: a chain of expressions instead would repeat each half in the next.
    steps = F.array(*[F.struct(F.lit(k).cast("long").alias("key"), F.lit(i % 2 == 0).alias("left")) for i, k in enumerate(_keys(seed))])
    done = F.aggregate(
        steps,
        halves,
        lambda s, step: F.when(
            step["left"], F.struct(F.pmod(s["l"] + _keyed(s["r"], step["key"]), a).alias("l"), s["r"].alias("r"))
        ).otherwise(F.struct(s["l"].alias("l"), F.pmod(s["r"] + _keyed(s["l"], step["key"]), b).alias("r"))),
    )
    return done["r"] * a + done["l"]


def _keyed(x: Column, key: Column) -> Column:
    """A quadratic map of a residue; every product stays below 2^62."""
    prime = F.lit(PRIME).cast("long")
    t = F.pmod(x * F.lit(1103515245 % PRIME).cast("long") + key, prime)
    return F.pmod(F.pmod(t * t, prime) * F.lit(48271).cast("long") + t, prime)


def permuted(x: Column, n: int, seed: int) -> Column:
    """The permutation of [0, n): walks on while the number is n or more."""
    a, b = sides(n)
    steps = min(a * b - n, MOST_STEPS)
    first = permuted_once(x, n, seed)
    if not steps:
        return first
    limit = F.lit(n).cast("long")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps + 1)),
        x.cast("long"),
        lambda s, i: F.when((i > 1) & (s < limit), s).otherwise(permuted_once(s, n, seed)),
    )
    return F.when(walked < limit, walked).otherwise(F.raise_error(F.lit("a cycle walk did not end")).cast("long"))


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """df with row_number from 0 in the order of the columns; no task holds more than its range of rows.

    Equal rows are dealt by their place in the input as well, so that a repeated row does not fill one range.
    """
    spark = df.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in order]
    ranged = (
        df.withColumn("_at", F.monotonically_increasing_id())
        .repartitionByRange(*keys, "_at")
        .sortWithinPartitions(*keys, "_at")
        .drop("_at")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    ranged = saved(ranged, "numbered")
    part = F.shiftright("_place", 33)
    counts = ranged.groupBy(part.cast("int").alias("part")).count().orderBy("part").collect()
    starts, total = [], 0
    for row in counts:  # one row per partition
        starts.append((row["part"], total))
        total += row["count"]
    first = F.broadcast(spark.createDataFrame(starts, "_part int, _first long"))
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ranged.withColumn("_part", part.cast("int"))
        .join(first, "_part")
        .select(*df.columns, (F.col("_first") + place).alias("row_number"), F.lit(total).cast("long").alias("row_count"))
    )


def shards(df: DataFrame, shard_count: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 17) -> DataFrame:
    """id, size, text_crc32, row_number, shard and slot of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = df.select(
        F.col(id_col),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    rows = numbered(narrow, [id_col, "text_crc32", "size"])
    first = rows.select("row_count").head()
    n = first[0] if first else 0
    place = permuted(F.col("row_number"), max(n, 1), seed)
    count = F.lit(shard_count).cast("long")
    return rows.withColumn("_p", place).select(
        id_col, "size", "text_crc32", "row_number",
        F.pmod("_p", count).cast("int").alias("shard"),
        F.call_function("div", F.col("_p"), count).alias("slot"),
    )
