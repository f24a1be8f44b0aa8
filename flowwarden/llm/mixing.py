"""Mixing sources to target weights with histograms of hashes instead of a sort.

A source whose target is above its size is repeated in whole rounds; the rest of its target is a budget that its
documents fill in the order of a hash of their id and text. The cut in that order is found by summing words per
(source, hash digit): the digit in which the budget runs out is the only one refined at the next level. Each level is one
aggregation of at most 4096 rows per source, the final filter compares hashes.

Cuts nest: a smaller budget always takes a subset. Defined results: a null text has size 0 and takes 0; a null source is a
source of its own, last in order; rows with the same id and text share a hash and are taken or left together; the document
at the cut is taken when that comes nearer to the target; a source of size 0 has target 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowwarden.llm.common import WORD, saved

WEIGHTS = (5, 2, 1)
MOST_ROUNDS = 3
DIGIT_BITS = 12
LEVELS = 5  # digits of the 60-bit hash


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(id_col: str, text_col: str) -> Column:
    """The first 60 bits of an MD5 over the id; documents that share an id differ by their text."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_ROUNDS) -> DataFrame:
    """source, source_size, target: weights in code point order, capped at ``most`` sizes, the excess reshared.

    ``sizes`` has one row per source. Sources are numbered by a range partitioning, so no task needs all of them.
    Every round fixes the sources that reach their cap and shares what is left among the others.
    """
    from flowwarden.llm.sharding import numbered

    spark = sizes.sparkSession
    ordered = numbered(
        sizes.select("source", "source_size", F.col("source").isNull().cast("int").alias("_last")), ["_last", "source"]
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("row_number", F.lit(len(weights))) + 1).cast("int"))
    ranked = saved(
        ordered.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).cast("double").alias("cap")),
        "source-weights",
    )
    total = ranked.agg(F.sum("source_size")).head()[0] or 0
    rate = None  # words per unit of weight; grows from round to round, so capped sources stay capped
    capped = -1
    while True:
        is_capped = F.lit(False) if rate is None else F.col("cap") <= F.col("weight") * rate
        row = ranked.agg(
            F.count_if(is_capped).alias("n"),
            F.sum(F.when(is_capped, F.col("cap"))).alias("fixed"),
            F.sum(F.when(~is_capped, F.col("weight"))).alias("open"),
        ).head()
        if row["n"] == capped or not row["open"]:
            break
        capped = row["n"]
        rate = (total - (row["fixed"] or 0.0)) / row["open"]
    shared = F.col("weight") * F.lit(float(rate or 0.0))
    return ranked.select("source", "source_size", F.least("cap", shared).alias("target"))


def cuts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """source, rounds, cut: documents with a hash below the cut get one round more."""
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = saved(
        targets.withColumn("rounds", rounds).select(
            "source", "source_size", "target", "rounds",
            (F.col("target") - F.col("rounds") * F.col("source_size")).alias("left"),
            F.lit(0).cast("long").alias("prefix"),
        ),
        "cuts",
    )
    for level in range(LEVELS):
        shift = 60 - DIGIT_BITS * (level + 1)
        digit = F.shiftright("hash", shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
        # Only documents in the bucket where the budget runs out, of which there is one per source.
        inside = sized if level == 0 else sized.join(
            state.select("source", "prefix"),
            sized["source"].eqNullSafe(state["source"]) & (F.shiftright(sized["hash"], shift + DIGIT_BITS) == state["prefix"]),
        ).select(sized["source"], sized["hash"], sized["size"])
        sums = inside.groupBy("source", digit.alias("digit")).agg(F.sum("size").alias("words"))
        order = Window.partitionBy("source").orderBy("digit")
        running = sums.select("source", "digit", "words", F.sum("words").over(order).alias("upto"))
        joined = running.alias("r").join(state.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
        # The digits wholly within the budget are the first ones; the next one is the boundary.
        found = joined.groupBy("s.source").agg(
            F.coalesce(F.max(F.when(F.col("r.upto") <= F.col("s.left"), F.col("r.upto"))), F.lit(0)).alias("used"),
            F.min(F.when(F.col("r.upto") > F.col("s.left"), F.col("r.digit"))).alias("boundary"),
            F.min_by(F.when(F.col("r.upto") > F.col("s.left"), F.col("r.words")), F.when(F.col("r.upto") > F.col("s.left"), F.col("r.digit"))).alias("at"),
        ).select(F.col("source").alias("f_source"), "used", "boundary", "at")
        base = F.col("prefix") * F.lit(1 << DIGIT_BITS)
        # No boundary: the whole bucket is within the budget, so the cut lies behind it.
        next_prefix = base + F.coalesce(F.col("boundary"), F.lit(1 << DIGIT_BITS))
        last = level == LEVELS - 1
        if last:  # one hash is left: take it when that comes nearer
            next_prefix = next_prefix + F.when(
                F.col("boundary").isNotNull() & (F.col("at") - (F.col("left") - F.col("used")) <= (F.col("left") - F.col("used"))), 1
            ).otherwise(0)
        state = saved(
            state.join(found, state["source"].eqNullSafe(found["f_source"]), "left").select(
                "source", "source_size", "target", "rounds",
                (F.col("left") - F.coalesce("used", F.lit(0))).alias("left"),
                F.when(F.col("f_source").isNull(), base).otherwise(next_prefix).alias("prefix"),
            ),
            "cuts",
        )
    return state.select("source", "source_size", "target", "rounds", F.col("prefix").alias("cut"))


def mix_sources(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST_ROUNDS, with_rows: bool = False,
) -> DataFrame:
    """Every document with id, size, source_size, target, copies and taken = size * copies.

    ``with_rows`` adds the whole input row as a struct ``row``; otherwise no other column is read.
    """
    size, key = words(F.col(text_col)).alias("size"), hash60(id_col, text_col).alias("hash")
    sized = saved(df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size, key), "sized")
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    marks = cuts(sized.select("source", "hash", "size"), targets).withColumnRenamed("source", "marked")
    rows = sized
    if with_rows:
        whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
        rows = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size, key, whole)
    copies = F.least(F.col("rounds") + (F.col("hash") < F.col("cut")).cast("long"), F.lit(most).cast("long"))
    out = rows.join(marks, F.col("source").eqNullSafe(F.col("marked")))
    return out.select(
        F.col("id").alias(id_col), "size", "source_size", "target", copies.alias("copies"),
        (F.col("size") * copies).alias("taken"), *(["row"] if with_rows else []),
    )


def mixed_documents(df: DataFrame, **options) -> DataFrame:
    """The rows the mix takes with their own columns, each as often as it is taken."""
    chosen = mix_sources(df, with_rows=True, **options).where("copies > 0")
    copy = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return chosen.select("row", copy.alias("copy")).select("row.*")
