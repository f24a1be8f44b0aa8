"""Exact quantiles whose memory does not grow with the table.

Spark's ``percentile`` keeps every distinct value of a column in one aggregation buffer. Here three scans do, whatever the number of columns:

1. a mergeable KLL sketch of every column brackets the wanted ranks;
2. the rows below and inside each bracket are counted exactly, and a sketch of the inside narrows it;
3. what is left inside is grouped by value and picked from.

Where a narrowed bracket would still hold more rows than one task should sort, step 2 is repeated inside it; each time it shrinks by two orders of
magnitude. Sketches only propose: a rank that isn't where its sketch says is looked for in the wider bracket again. Nothing but
counts and bracket ends reaches the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows a bracket may hold at last; so many are sorted in one task.
BRACKET_ROWS = 1_000_000
#: Size of a sketch, a margin above its rank error, and the steps at which the inside of a bracket is looked at.
SKETCH, MARGIN, STEPS = 4096, 0.002, 512


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    bracket_rows: int = BRACKET_ROWS,
) -> dict[str, list[float | None]]:
    """Interpolated quantiles (``percentile`` semantics) of several columns; NaN counts as null."""
    if not columns:
        return {}
    values = {c: _number(F.col(f"`{c}`")) for c in columns}
    ends = sorted({e for p in probs for e in (max(p - MARGIN, 0.0), min(p + MARGIN, 1.0))})
    seen = df.agg(
        *[F.count(v).alias(f"n{i}") for i, v in enumerate(values.values())],
        *[_at(F.lit(True), v, ends).alias(f"q{i}") for i, v in enumerate(values.values())],
    ).first()
    counts = {c: seen[f"n{i}"] for i, c in enumerate(columns)}
    targets: dict[tuple[str, int], _Target] = {}
    for i, c in enumerate(columns):
        for p in probs if counts[c] else ():
            low, high = (seen[f"q{i}"][ends.index(e)] for e in (max(p - MARGIN, 0.0), min(p + MARGIN, 1.0)))
            for rank in {math.floor(p * (counts[c] - 1)), math.ceil(p * (counts[c] - 1))}:
                targets[c, rank] = _Target(c, rank, low, high)
    _find(df, values, list(targets.values()), bracket_rows)

    def interpolate(c: str, p: float) -> float | None:
        if not counts[c]:
            return None
        spot = p * (counts[c] - 1)
        low, high = math.floor(spot), math.ceil(spot)
        a, b = targets[c, low].value, targets[c, high].value
        return a if low == high or a == b else (high - spot) * a + (spot - low) * b

    return {c: [interpolate(c, p) for p in probs] for c in columns}


def approx_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], accuracy: int = 10_000
) -> dict[str, list[float | None]]:
    """One-pass quantiles within ``1/accuracy`` of the wanted rank."""
    row = df.agg(
        *[
            F.percentile_approx(_number(F.col(c)), probs, accuracy).alias(c)
            for c in columns
        ]
    ).first()
    return {c: row[c] if row[c] is not None else [None] * len(probs) for c in columns}


@dataclass
class _Target:
    """A wanted rank and the closed interval that should hold it; ``below`` rows are left of the interval, by exact count."""

    key: str
    rank: int
    low: float | None
    high: float | None
    below: int = 0
    near: tuple[float | None, float | None] = (None, None)  # the narrowed interval
    value: float | None = None

    @property
    def interval(self) -> tuple[str, float | None, float | None]:
        return self.key, self.low, self.high


def _within(value: Column, low: float | None, high: float | None) -> Column:
    inside = value.isNotNull()
    if low is not None:
        inside &= value >= F.lit(low)
    if high is not None:
        inside &= value <= F.lit(high)
    return inside


def _at(inside: Column, value: Column, fractions: list[float]) -> Column:
    """Values at fractions of the ranks of the rows inside, from one sketch; null where there are none."""
    kept = F.when(inside, value)
    sketch = F.kll_sketch_agg_double(kept, SKETCH)
    return F.when(F.count(kept) > 0, F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(f) for f in fractions])))


def _grouped(targets: list[_Target], name: str) -> dict[tuple, list[_Target]]:
    found: dict[tuple, list[_Target]] = {}
    for t in targets:
        found.setdefault((*t.interval, *(t.near if name == "near" else ())), []).append(t)
    return found


def _find(df: DataFrame, values: dict[str, Column], targets: list[_Target], bracket_rows: int) -> None:
    """Sets the values of all targets."""
    left = targets
    while left:
        left = _narrow(df, values, left, bracket_rows)
    _pick(df, values, targets)
    if missed := [t for t in targets if t.value is None]:  # the sketch misplaced them; the counted interval holds them for certain
        for t in missed:
            t.near = (t.low, t.high)
        _pick(df, values, missed)


def _narrow(df: DataFrame, values, targets: list[_Target], bracket_rows: int) -> list[_Target]:
    """One scan over the intervals of the targets; those that have to be narrowed further are returned."""
    groups = list(_grouped(targets, "interval").items())
    steps = [i / STEPS for i in range(STEPS + 1)]
    asked = []
    for i, ((key, low, high), _) in enumerate(groups):
        inside = _within(values[key], low, high)
        below = F.count_if(values[key] < F.lit(low)) if low is not None else F.lit(0).cast("bigint")
        asked += [below.alias(f"b{i}"), F.count_if(inside).alias(f"n{i}"), _at(inside, values[key], steps).alias(f"q{i}")]
    seen = df.agg(*asked).first()
    again = []
    for i, ((_, low, high), group) in enumerate(groups):
        below, n, at = seen[f"b{i}"], seen[f"n{i}"], seen[f"q{i}"]
        for t in group:
            if not below <= t.rank < below + n:
                t.low = t.high = None
                again.append(t)
                continue
            t.below = below
            spot = (t.rank - below) / max(n - 1, 1) * STEPS
            first, last = max(0, math.floor(spot - 2 * MARGIN * STEPS)), min(STEPS, math.ceil(spot + 2 * MARGIN * STEPS))
            t.near = (at[first], at[last])
            if n * (last - first) / STEPS > bracket_rows and at[first] < at[last] and t.near != (low, high):
                t.low, t.high = t.near
                again.append(t)
    return again


def _pick(df: DataFrame, values, targets: list[_Target]) -> None:
    """One scan: the narrowed intervals grouped by value, with what their wider ones have below them as one more value."""
    groups = list(_grouped(targets, "near").items())
    entries, wanted = [], []
    for i, ((key, low, high, near_low, near_high), group) in enumerate(groups):
        value = values[key]
        shown = F.when(value < F.lit(near_low), F.lit(float("-inf"))).otherwise(value) if near_low is not None else value
        kept = _within(value, low, near_high)
        entries.append(F.when(kept, F.struct(F.lit(i).alias("bracket"), (value < F.lit(near_low) if near_low is not None else F.lit(False)).alias("before"), shown.alias("value"))))
        wanted += [F.lit(i), F.array(*[F.lit(t.rank - t.below) for t in group])]
    ordered = Window.partitionBy("bracket").orderBy(F.desc("before"), "value")
    upto, n = F.col("upto"), F.col("n")
    rows = (
        df.select(F.inline(F.array_compact(F.array(*entries))))
        .groupBy("bracket", "before", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(ordered))
        .select("bracket", "before", "value", "upto", "n", F.explode(F.create_map(*wanted)[F.col("bracket")]).alias("rank"))
        .where(~F.col("before") & (upto > F.col("rank")) & (upto - n <= F.col("rank")))
        .select("bracket", "rank", "value")
        .collect()  # one row per rank
    )
    found = {(r["bracket"], r["rank"]): r["value"] for r in rows}
    for i, (_, group) in enumerate(groups):
        for t in group:
            t.value = found.get((i, t.rank - t.below))


def _number(col: Column) -> Column:
    x = col.cast("double")
    return F.when(~F.isnan(x), x)
