"""Cheapest repair of conversations by a square-root checkpointed dynamic program.

The edits of a conversation (keep, change the role, delete, insert an empty turn) lead from state to state of the pattern ``(s?(ua)+)?``. Costs to the
end are worked out backwards over four states. They aren't stored for every row: rows are cut into blocks of at most about the square root of the
table's rows, each block gives the 4 x 4 matrix of its costs (shortest paths), and the matrices of a conversation give the cost vector behind every
block, the checkpoint. Walking forward, a block's vectors are worked out again from its checkpoint, and of all cheapest edits the one with the least
letter (D, I, K, R) is taken, which gives the ASCII-least audit.

How it spreads: rows are numbered and written once. Repeated turns are found by an aggregation of hashes; keys with over a thousandth of the rows (under a thousand
keys) are marked by a broadcast, the others by a join. Blocks are cut from ranges of (conversation, turn, ...), so tasks share a long
conversation. Only codes of one byte a row, matrices and keys take part in this; the texts are shuffled once, for the walk. That streams over
sorted rows and holds one block's codes. A conversation's walk and digest are one task, as its SHA-256 can't be split; memory doesn't grow with it but for the audit, a value
of one row by contract.

Defined results: a null role or text is one space; null turns come first; rows of one turn go by role, then text (its first 64 characters, then a hash); equal
rows are all there, the first may stay; rows with a null conversation id form one conversation; very long texts pass whole; ids
without rows have zeros, an empty audit and the hash of nothing; empty tables give no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowwarden.llm.common import saved

#: Least rows of a block; tables with more than the square of it have longer ones.
LEAST_BLOCK = 1024
#: A key is hot above this share of the rows, so there are fewer hot keys than its inverse.
HOT_SHARE = 1e-3
SPACE = r"\x20\x09-\x0D"
PREFIX = 64

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NONE, BLANK, DUPLICATE, CUT = range(4)
FAULTS = ("", "blank", "duplicate", "truncated")
#: States of the pattern: nothing yet, after s, after u, after a. The next turn to come by insertion or a new role, and its state.
NEXT = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
#: State after keeping a turn, by its initial (s, u, a, other) and the state before; -1 where the pattern forbids it.
KEPT = ((1, -1, -1, -1), (2, 2, -1, 2), (-1, -1, 3, -1), (-1, -1, -1, -1))
INITIALS = "sua"
ALLOWED = frozenset(((0, 1), (1, 2), (2, 1)))
FAR = 1 << 50
#: Costs behind the last row, insertions included.
END = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[int, int, int, int]


def damage(rows: DataFrame) -> DataFrame:
    """Conversation rows with the faults of the query's contract, decided by the checksum of ``conv_id:turn``."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("kind"),
    ).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


# --- the dynamic program


def back(code: int, behind: Vector) -> Vector:
    """Costs before a row, from those behind it."""
    fault, kept = code >> 2, KEPT[code & 3]
    costs = []
    for state in range(4):
        least = DELETE + behind[state]
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED if fault == CUT else 0
            least = min(least, REROLE + more + behind[NEXT[state][1]])
            if kept[state] >= 0:
                least = min(least, KEEP + more + behind[kept[state]])
        costs.append(least)
    start, s, u, a = costs
    u, a = min(u, INSERT + a), min(a, INSERT + u)
    return min(start, INSERT + u, FAR), min(s, INSERT + u, FAR), min(u, FAR), min(a, FAR)


def forward(code: int, behind: Vector, state: int) -> tuple[str, int]:
    """The least letters of cheapest edits up to and with this row, and the state behind it."""
    costs, letters = back(code, behind), ""
    fault, kept = code >> 2, KEPT[code & 3]
    more = TRUNCATED if fault == CUT else 0
    while True:
        target, (_, following) = costs[state], NEXT[state]
        if DELETE + behind[state] == target:
            return letters + "D", state
        if INSERT + costs[following] == target:
            letters, state = letters + "I", following
        elif fault not in (BLANK, DUPLICATE) and kept[state] >= 0 and KEEP + more + behind[kept[state]] == target:
            return letters + "K", kept[state]
        else:
            return letters + "R", following


class Steps:
    """``back`` and ``forward`` remembered: vectors less their least value are few, as insertions bound the differences."""

    def __init__(self) -> None:
        self.vectors: list[Vector] = []
        self.number: dict[Vector, int] = {}
        self.before: dict[tuple[int, int], tuple[int, int]] = {}
        self.onward: dict[tuple[int, int, int], tuple[str, int]] = {}

    def known(self, costs: Vector) -> tuple[int, int]:
        """Number of the vector less its least value, and that value."""
        least = min(costs)
        relative = tuple(c if c >= FAR else c - least for c in costs)
        n = self.number.get(relative)
        if n is None:
            n = self.number[relative] = len(self.vectors)
            self.vectors.append(relative)
        return n, least

    def over(self, codes: bytes, vector: int) -> tuple[list[int], int]:
        """Numbers of the vectors behind every row and before the first, and the sum of the values taken off."""
        found, total = [vector], 0
        for code in reversed(codes):
            step = self.before.get((code, vector))
            if step is None:
                step = self.before[code, vector] = self.known(back(code, self.vectors[vector]))
            vector = step[0]
            total += step[1]
            found.append(vector)
        found.reverse()
        return found, total

    def matrix(self, codes: bytes) -> list[int]:
        """Costs of the block from every state before it to every state behind it, by the state behind."""
        out = []
        for end in range(4):
            unit, _ = self.known(tuple(0 if s == end else FAR for s in range(4)))
            found, total = self.over(codes, unit)
            out += [min(c + total, FAR) for c in self.vectors[found[0]]]
        return out

    def walk(self, code: int, vector: int, state: int) -> tuple[str, int]:
        step = self.onward.get((code, vector, state))
        if step is None:
            step = self.onward[code, vector, state] = forward(code, self.vectors[vector], state)
        return step


def before_block(matrix: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Costs before a block, from its matrix and those behind it."""
    return (matrix.reshape(4, 4) + behind[:, None]).min(axis=0)


# --- its steps over the table

_ORDER = ("conv_id", "turn", "role", "prefix", "h", "place")


def _coded(rows: DataFrame, n: int) -> DataFrame:
    """Order columns and the code of every row: 4 x its fault + its role's initial. ``rows`` has been written, so that places hold."""
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    end = F.right(F.expr(r"rtrim(concat(' ', char(9), char(10), char(11), char(12), char(13)), text)"), F.lit(1))
    initial = F.substring("role", 1, 1)
    rows = rows.select(
        *_ORDER, blank.alias("blank"), (~blank & ~end.isin(".", "!", "?")).alias("cut"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"),
    )
    first = F.min(F.struct("turn", "place")).alias("first")
    seen = saved(rows.where(~F.col("blank")).groupBy("h").agg(first, F.count("*").alias("n")).where("n > 1"), "repair-repeated")
    limit = max(1000, int(n * HOT_SHARE))
    hot = F.broadcast(seen.where(F.col("n") > limit).select(F.col("h").alias("hot_h"), F.col("first.place").alias("hot_first")))
    rest = seen.where(F.col("n") <= limit).select(F.col("h").alias("found"), F.col("first.place").alias("rest_first"))
    rows = rows.join(hot, F.col("h") == F.col("hot_h"), "left")
    # Rows that need no look at the rest get keys of their own, which spreads them.
    key = F.when(F.col("blank") | F.col("hot_h").isNotNull(), F.concat(F.lit("-"), F.col("place"))).otherwise(F.col("h"))
    rows = rows.withColumn("key", key).join(rest, F.col("key") == F.col("found"), "left")
    again = F.coalesce(F.coalesce("hot_first", "rest_first") != F.col("place"), F.lit(False))
    fault = F.when(F.col("blank"), BLANK).when(again, DUPLICATE).when(F.col("cut"), CUT).otherwise(NONE)
    return rows.select(*_ORDER, (fault * 4 + F.col("initial")).alias("code"))


def _blocks(longest: int, schema: pa.Schema):
    """Blocks of sorted rows: the keys of the first, a number in order, codes, and the matrix."""

    def run(batches):
        steps, task, numbered = Steps(), TaskContext.get().partitionId(), 0
        head, codes = None, bytearray()

        def block() -> tuple:
            nonlocal numbered
            numbered += 1
            return (*head, (task << 32) + numbered, bytes(codes), steps.matrix(codes))

        for batch in batches:
            out = []
            for row, code in zip(zip(*(batch.column(c).to_pylist() for c in _ORDER)), batch.column("code").to_pylist()):
                if codes and (row[0] != head[0] or len(codes) >= longest):
                    out.append(block())
                    codes = bytearray()
                if not codes:
                    head = row
                codes.append(code)
            yield from _batch(out, schema)
        if codes:
            yield from _batch([block()], schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _checkpoints(batches):
    """The cost vector behind every block, from blocks that come last to first."""
    conversation, costs, begun = None, None, False
    for batch in batches:
        out = []
        matrices = batch.column("matrix").flatten().to_numpy().reshape(-1, 16)
        for conv, matrix in zip(batch.column("conv_id").to_pylist(), matrices):
            if not begun or conv != conversation:
                conversation, costs, begun = conv, np.array(END, dtype=np.int64), True
            out.append(costs.tolist())
            costs = before_block(matrix, costs)
        yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(out, pa.list_(pa.int64()))], ["block", "behind"])


def _walk(schema: pa.Schema):
    """Edits in order, from rows that are sorted behind the head of their block. The row with edit ``^`` opens a conversation."""

    def run(batches):
        steps = Steps()
        conversation, state, vectors, codes, at, last, begun = None, 0, [], b"", 0, None, False

        def tail():
            out, now = [], state
            while now in (1, 2):  # the pattern isn't complete
                role, now = NEXT[now]
                out.append((conversation, None, "I", role, "", "", False, INSERT))
            return out

        for batch in batches:
            out = []
            for conv, kind, turn, role, text, block, behind in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "text", "codes", "behind"))):
                if not begun or conv != conversation:
                    out += tail() if begun else []
                    conversation, state, last, begun = conv, 0, None, True
                    out.append((conv, None, "^", None, None, "", False, 0))
                if kind == 0:
                    continue
                if kind == 1:
                    codes, at = block, 0
                    vectors, _ = steps.over(codes, steps.known(tuple(behind))[0])
                    continue
                code = codes[at]
                letters, after = steps.walk(code, vectors[at + 1], state)
                at += 1
                for _ in letters[:-1]:
                    name, state = NEXT[state]
                    out.append((conv, None, "I", name, "", "", False, INSERT))
                edit, fault, initial = letters[-1], code >> 2, code & 3
                cost = DELETE if edit == "D" else (TRUNCATED if fault == CUT else 0) + (REROLE if edit == "R" else KEEP)
                name = NEXT[state][0] if edit == "R" else role
                out.append((conv, turn, edit, name, text, FAULTS[fault], last is not None and (last, initial) not in ALLOWED, cost))
                state, last = after, initial
            yield from _batch(out, schema)
        if begun:
            yield from _batch(tail(), schema)

    return run


def edited_turns(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Every edit of every conversation, sorted inside partitions, a conversation in one of them: conv_id, turn, edit (K, R, D, I; a row with ^ opens
    the conversation), role and text after the edit (of a deleted row as they were), fault, illegal (the pair with the row before), cost.

    ``conversations`` has the ids to report; those of ``rows`` if not given.
    """
    ids = rows if conversations is None else conversations
    h = F.sha2(F.concat(F.coalesce(F.concat(F.lit("v"), F.col("conv_id")), F.lit("n")), F.lit(":"), F.length("role"), F.lit(":"), "role", "text"), 256)
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.select("*", F.left("text", F.lit(PREFIX)).alias("prefix"), h.alias("h"), F.monotonically_increasing_id().alias("place"))
    rows = saved(rows, "repair-rows")
    n = rows.count()
    ordered = _coded(rows, n).repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    keys = ", ".join(f"{c} {kind[c]}" for c in _ORDER)
    arrow = pa.schema(
        [*((c, _arrow(kind[c])) for c in _ORDER), ("block", pa.int64()), ("codes", pa.binary()), ("matrix", pa.list_(pa.int64()))]
    )
    longest = max(LEAST_BLOCK, math.isqrt(n))
    blocks = saved(ordered.mapInArrow(_blocks(longest, arrow), f"{keys}, block long, codes binary, matrix array<long>"), "repair-blocks")
    # One conversation's blocks come in one task, the last first; each leaves a vector and only the newest is held.
    backwards = blocks.select("conv_id", "block", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
    behind = backwards.mapInArrow(_checkpoints, "block long, behind array<long>")
    heads = blocks.drop("matrix").join(behind, "block").select(
        *_ORDER, F.lit(1).alias("kind"), F.lit(None).cast("string").alias("text"), "codes", "behind"
    )
    turns = rows.select(*_ORDER, F.lit(2).alias("kind"), "text", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("array<long>").alias("behind"))
    empty = [F.lit(None).cast(kind[c]).alias(c) for c in _ORDER[1:]]
    opening = ids.select("conv_id").distinct().select(
        "conv_id", *empty, F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("codes"),
        F.lit(None).cast("array<long>").alias("behind"),
    )
    together = opening.unionByName(heads).unionByName(turns).repartition("conv_id")
    together = together.sortWithinPartitions("conv_id", F.col("kind") > 0, *_ORDER[1:], "kind")
    out = pa.schema(
        [("conv_id", _arrow(kind["conv_id"])), ("turn", _arrow(kind["turn"])), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()),
         ("fault", pa.string()), ("illegal", pa.bool_()), ("cost", pa.int64())]
    )
    return together.select("conv_id", "kind", "turn", "role", "text", "codes", "behind").mapInArrow(
        _walk(out), f"conv_id {kind['conv_id']}, turn {kind['turn']}, edit string, role string, text string, fault string, illegal boolean, cost long"
    )


def _arrow(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "string": pa.string()}[name]


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _report(schema: pa.Schema):
    def run(batches):
        now = None
        for batch in batches:
            out = []
            for conv, turn, edit, role, text, fault, illegal, cost in zip(*(c.to_pylist() for c in batch.columns)):
                if edit == "^":
                    if now:
                        out.append(now.row())
                    now = _Report(conv)
                else:
                    now.add(turn, edit, role, text, fault, illegal, cost)
            yield from _batch(out, schema)
        if now:
            yield from _batch([now.row()], schema)

    return run


class _Report:
    def __init__(self, conversation) -> None:
        self.conversation = conversation
        self.first = self.last = None
        self.distinct = self.illegal = self.cost = 0
        self.faults = dict.fromkeys(FAULTS, 0)
        self.audit = bytearray()
        self.digest, self.lines = hashlib.sha256(), 0

    def add(self, turn, edit, role, text, fault, illegal, cost) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.distinct += 1
        self.faults[fault] += 1
        self.illegal += illegal
        self.cost += cost
        self.audit += edit.encode()
        if edit != "D":
            self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        counts = (self.faults[f] for f in FAULTS[1:])
        return (self.conversation, gaps, *counts, self.illegal, self.cost, self.audit.decode(), self.digest.hexdigest())


def repair_report(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = pa.schema([("conv_id", _arrow(kind)), *((c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _REPORT.split(", "))])
    return edited_turns(rows, conversations).mapInArrow(_report(schema), f"conv_id {kind}, {_REPORT}")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text of the repaired conversations; rows of one are sorted."""
    return edited_turns(rows).where("edit not in ('^', 'D')").mapInArrow(_placed, "conv_id long, place long, role string, text string")


def _placed(batches):
    last, place, begun = None, 0, False
    for batch in batches:
        places = []
        for conv in batch.column("conv_id").to_pylist():
            place = place + 1 if begun and conv == last else 0
            last, begun = conv, True
            places.append(place)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(places, pa.int64()), batch.column("role"), batch.column("text")], ["conv_id", "place", "role", "text"]
        )
