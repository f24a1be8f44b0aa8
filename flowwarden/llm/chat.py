"""Chat formatting by prefix-target expansion: one example per assistant turn.

Each example holds all turns before the reply and the reply itself; the loss mask covers the reply's text and nothing
else. The turns behind the last reply (or all turns, where there is no reply) make one more example without a target, so
that no turn is lost.

Template of a turn: "### role: text </turn>\\n". Backslash, "###" and "</turn>" inside a role or text (and ": " in a
role) are escaped with a backslash, so neither can look like a marker and reading back is exact.

The rows of a conversation are brought together by a sort, not by a group: tasks stream over them and hold one conversation's
text. Output is quadratic in a conversation's length, as every reply repeats its context. Defined results: a null text or role
is empty; a null turn sorts first; rows with equal turns go by role, then text, and repeated rows stay; rows with a null conversation
id form one conversation; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Control strings and their escapes; the backslash comes first.
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"), (": ", "\\c"))
PLAIN = {code: text for text, code in ESCAPES}
END = " </turn>\n"
TARGET_ROLE = "assistant"

EXAMPLES = "conv_id long, example int, target boolean, n_turns int, text string, loss_start int, loss_end int"


def escape(text: str, role: bool = False) -> str:
    for plain, code in ESCAPES if role else ESCAPES[:-1]:
        text = text.replace(plain, code)
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\[bhtc]", lambda m: PLAIN[m[0]], text) if "\\" in text else text


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted example."""
    out = []
    for block in text.split(END)[:-1]:
        role, _, said = block[4:].partition(": ")
        out.append((unescape(role), unescape(said)))
    return out


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("conv_id", pa.int64()), ("example", pa.int32()), ("target", pa.bool_()), ("n_turns", pa.int32()),
        ("text", pa.string()), ("loss_start", pa.int32()), ("loss_end", pa.int32()),
    ])
    rows, held = [], 0
    current, begun, text, turns, example, open_turns = None, False, "", 0, 0, 0

    def tail():
        return (current, example, False, turns, text, 0, 0)

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        for conv, role, said in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
            if not begun or conv != current:
                if begun and open_turns:
                    rows.append(tail())
                    held += len(text)
                current, begun, text, turns, example, open_turns = conv, True, "", 0, 0, 0
            body = escape(said)
            head = f"### {escape(role, True)}: "
            start = len(text) + len(head)
            text += head + body + END
            turns += 1
            open_turns += 1
            if role == TARGET_ROLE:
                rows.append((current, example, True, turns, text, start, start + len(body)))
                held += len(text)
                example, open_turns = example + 1, 0
            if held > 4_000_000:
                yield packed(rows)
                rows, held = [], 0
    if begun and open_turns:
        rows.append(tail())
    if rows:
        yield packed(rows)


def prefix_examples(df: DataFrame) -> DataFrame:
    """Examples of conversations (conv_id, turn, role, text): one per reply, with text and the span of its loss mask."""
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    ordered = (
        df.select("conv_id", "turn", role.alias("role"), text.alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    return ordered.mapInArrow(_expand, EXAMPLES)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        turns, said, digests = [], [], []
        for text, start, end in zip(*(batch.column(n).to_pylist() for n in ("text", "loss_start", "loss_end"))):
            found = parse(text)
            digest = hashlib.sha256()
            for role, body in found:
                digest.update(f"{role}\n{body}\n".encode())
            turns.append(len(found))
            digests.append(digest.hexdigest())
            said.append(unescape(text[start:end]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"), batch.column("example"), pa.array(turns, pa.int64()), pa.array(digests, pa.string()),
                pa.array(said, pa.string()), pa.array([len(t) for t in batch.column("text").to_pylist()], pa.int64()),
            ],
            ["conv_id", "example", "n_turns", "turns_sha256", "reply", "formatted_chars"],
        )


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation what its examples hold: all turns (from the longest example) and all text under the loss mask."""
    read = examples.mapInArrow(
        _read, "conv_id long, example int, n_turns long, turns_sha256 string, reply string, formatted_chars long"
    )
    replies = F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("example", "reply"))), lambda r: r["reply"]))
    return read.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max_by("turns_sha256", "example").alias("turns_sha256"),
        replies.alias("loss"),
        F.sum("formatted_chars").alias("formatted_chars"),
    ).select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
