"""Unions, splits and samples that repeat exactly, decided row by row from a hash of the key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowwarden.functions.scalars import hash_rank
from flowwarden.operators.ranking import numbered_by_range, top_n_per_key
from flowwarden.session import materialise


def hash_below(key: Column, share: float) -> Column:
    """Whether the md5 of the key falls into the lowest ``share`` of all hashes: hex text compares
    like the number, so nothing needs converting."""
    return F.md5(key.cast("string")) < f"{int(share * 16**13):013x}"


def concat(*tables: DataFrame) -> DataFrame:
    """Bag union by column name; a column absent from one table is null there."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def bernoulli(df: DataFrame, key: str, rate: float) -> DataFrame:
    """Each row with probability ``rate``."""
    return df.where(hash_below(F.col(key), rate))


def split_by_hash(df: DataFrame, key: str, test_size: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Train and test in one pass without any count; shares hold in expectation, per stratum too."""
    in_test = hash_below(F.col(key), test_size)
    return df.where(~in_test), df.where(in_test)


def strata_test_sizes(counts: DataFrame, test_size: float) -> DataFrame:
    """Test rows per stratum (``s``, ``n``): proportional shares of ``ceil(rows * test_size)``, the
    left-over rows going to the largest remainders. Returns ``s``, ``n``, ``wanted``; any number of strata."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    all_wanted = math.ceil(total * test_size)
    share = F.lit(all_wanted).cast("double") * F.col("n") / F.lit(float(max(total, 1)))
    shares = counts.select("s", "n", F.floor(share).alias("base"), (F.floor(share) - share).alias("_behind"))
    shares = numbered_by_range(shares.withColumn("_name", F.coalesce(F.col("s").cast("string"), F.lit(""))), ["_behind", "_name"], "_place")
    left = all_wanted - (shares.agg(F.sum("base")).first()[0] or 0)
    return shares.select("s", "n", (F.col("base") + (F.col("_place") < left).cast("bigint")).alias("wanted"))


#: Bits of the 52-bit hash that a histogram counts by, and the histograms that are nested. What is left inside the last bucket is a
#: stratum's rows divided by 2^26.
LEVEL_BITS, LEVELS = 13, 2


def with_test_flag(
    df: DataFrame, key: str, stratum: str | None, out: str = "in_test", test_size: float = 0.2
) -> DataFrame:
    """``out`` marks exactly the wanted number of rows per stratum: those with the smallest key
    hashes, equal hashes in the order of the key; ``key`` must be unique.

    Nothing is sorted: rows are counted by stratum and the top bits of the hash, the bucket in which a stratum's number is reached is counted by the
    next bits, and only the rows of the last bucket are ordered. The row that completes a stratum's number is its cut, and the cuts are
    joined back like any dimension. Without the column the split is unstratified.
    """
    group = F.col(stratum) if stratum and stratum in df.columns else F.lit(0)
    rows = df.select(group.alias("s"), hash_rank(F.col(key)).alias("hash"), F.col(key).alias("key"))
    spots = None
    for level in range(1, LEVELS + 1):
        bucket = F.shiftright("hash", 52 - level * LEVEL_BITS).alias("bucket")
        counts = materialise(rows.groupBy("s", bucket).agg(F.count(F.lit(1)).alias("n")), "split-buckets")
        if spots is None:
            sizes = strata_test_sizes(counts.groupBy("s").agg(F.sum("n").alias("n")), test_size)
            spots = sizes.select(F.col("s").alias("of"), F.col("wanted").alias("left")).where("left > 0")
        spots = materialise(_reached(counts, spots), "split-spots")
        inside = (F.col("s").eqNullSafe(F.col("of"))) & (F.shiftright("hash", 52 - level * LEVEL_BITS) == F.col("at"))
        rows = rows.select("s", "hash", "key").join(spots, inside)
    place = F.row_number().over(Window.partitionBy("s").orderBy("hash", "key"))
    cuts = rows.withColumn("place", place).where("place = left")
    cuts = materialise(cuts.select(F.col("s").alias("_s"), F.col("hash").alias("_cut"), F.col("key").alias("_cut_key")), "strata-cuts")
    marked = df.withColumn("_hash", hash_rank(F.col(key))).join(cuts, group.eqNullSafe(F.col("_s")), "left")
    chosen = (F.col("_hash") < F.col("_cut")) | ((F.col("_hash") == F.col("_cut")) & (F.col(key) <= F.col("_cut_key")))
    return marked.select(*df.columns, F.coalesce(chosen, F.lit(False)).alias(out))


def _reached(counts: DataFrame, spots: DataFrame) -> DataFrame:
    """Per stratum the bucket in which its number is reached (``at``), and how many of that bucket's rows it still takes (``left``)."""
    upto = F.sum("n").over(Window.partitionBy("s").orderBy("bucket"))
    found = counts.join(spots, F.col("s").eqNullSafe(F.col("of"))).withColumn("upto", upto)
    found = found.where((F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("n") < F.col("left")))
    return found.select("of", F.col("bucket").alias("at"), (F.col("left") - (F.col("upto") - F.col("n"))).alias("left"))


def split_train_test(
    df: DataFrame, key: str, stratum: str | None = "label", test_size: float = 0.2
) -> tuple[DataFrame, DataFrame]:
    """Exact stratified split."""
    marked = with_test_flag(df, key, stratum, "_in_test", test_size)
    return marked.where(~F.col("_in_test")).drop("_in_test"), marked.where("_in_test").drop("_in_test")


def balanced_sample(df: DataFrame, label: str, key: str, n: int = 100) -> DataFrame:
    """``n`` rows of every class."""
    return (
        top_n_per_key(
            df.withColumn("_hash", F.md5(F.col(key).cast("string"))), [label], [F.col("_hash").asc(), F.col(key).asc()], n
        ).drop("_hash")
    )
