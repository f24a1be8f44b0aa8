"""Repairs against a plain search over whole conversations, with the contract's damage."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowwarden.llm import repair
from flowwarden.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(turns):
    """(cost, audit, repaired turns) by a forward search that keeps the least audit of every state; ``turns`` are (role, text, fault)."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    full = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, made) in list(best.items()):
                for letter, after in step[state].items():
                    if letter in full:
                        new = (cost + 5, audit + "I", [*made, (full[letter], "")])
                        if after not in best or new[:2] < best[after][:2]:
                            best[after] = new
        return best

    best = inserted({"": (0, "", [])})
    for role, text, fault in turns:
        after_row = {}
        for state, (cost, audit, made) in best.items():
            ways = [(state, cost + 2, "D", made)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role[:1] in step[state]:
                    ways.append((step[state][role[:1]], cost + more, "K", [*made, (role, text)]))
                ways += [(after, cost + more + 1, "R", [*made, (full[c], text)]) for c, after in step[state].items() if c in full]
            for after, total, letter, now in ways:
                new = (total, audit + letter, now)
                if after not in after_row or new[:2] < after_row[after][:2]:
                    after_row[after] = new
        best = inserted(after_row)
    return min((best[s] for s in ("", "a") if s in best), key=lambda w: w[:2])


def plain(rows, all_rows):
    groups = {conv: [] for conv, *_ in all_rows}
    for r in rows:
        groups[r[0]].append(r)
    out = {}
    for conv, turns in groups.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, marked = set(), []
        for _, _, role, text in turns:
            found = WORD.findall(text)
            fault = "blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        numbers = {t for _, t, *_ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        pairs = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, made = cheapest(marked)
        counts = [sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, pairs, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())
    return out


def reported(df):
    rows = df.collect()
    found = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert reported(QUERIES["op13_conversation_repair"](spark, sf)) == plain(damaged(rows), rows)


def _made_up(n, seed):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "u", "", None, "tool", "Ü", "assistant", "user"]
    texts = ["Yes.", "no", "", None, " \t", "Why?", "Sure!", "ok.  \n", "x" * 3000, "日本。", "a.b"]
    convs = [None, *range(12)]
    return [
        (draw.choice(convs), draw.choice([None, *range(9), 2**40]), draw.choice(roles), draw.choice(texts)) for _ in range(n)
    ]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("least", [1, 3, 1024])
def test_many_faults_in_blocks_of_any_length(spark, monkeypatch, least):
    monkeypatch.setattr(repair, "LEAST_BLOCK", least)
    monkeypatch.setattr(repair.math, "isqrt", lambda n: least)
    rows = _made_up(400, least)
    df = spark.createDataFrame(rows, SCHEMA)
    assert reported(repair.repair_report(repair.damage(df), df)) == plain(damaged(rows), rows)


def test_matrices_agree_with_single_rows():
    draw, steps = random.Random(5), repair.Steps()
    codes = bytes(draw.randrange(16) for _ in range(300))
    cuts = [0, 1, 7, 8, 150, 300]
    behind = np.array(repair.END)
    for a, b in reversed(list(zip(cuts, cuts[1:]))):
        costs = tuple(behind.tolist())
        for code in reversed(codes[a:b]):
            costs = repair.back(code, costs)
        behind = repair.before_block(np.array(steps.matrix(codes[a:b])), behind)
        assert tuple(behind.tolist()) == costs


def test_one_conversation_holds_most_rows(spark, monkeypatch):
    """Spread over range partitions and many blocks; a hot turn is marked by the broadcast."""
    monkeypatch.setattr(repair, "LEAST_BLOCK", 16)
    draw = random.Random(3)
    rows = [(7, i, draw.choice(["user", "assistant"]), draw.choice(["Same.", "Same.", f"t{i}.", f"t{i}"])) for i in range(6000)]
    rows += [(i, 0, "user", "Hello.") for i in range(100, 200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert reported(repair.repair_report(repair.damage(df), df)) == plain(damaged(rows), rows)


def test_clashing_columns_and_empty_table(spark):
    rows = [(1, 0, "user", "Hi.", 1, "p", 2), (1, 1, "assistant", "Yes.", 1, "p", 2)]
    df = spark.createDataFrame(rows, SCHEMA + ", place int, prefix string, kind int")
    assert reported(repair.repair_report(df)) == plain([r[:4] for r in rows], rows)
    assert repair.repair_report(df.limit(0)).count() == 0
    made = [tuple(r) for r in repair.repaired_turns(df.withColumn("role", F.lit("user"))).orderBy("place").collect()]
    assert made == [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")]


def test_conversation_that_loses_every_row(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    assert reported(repair.repair_report(repair.damage(df), df)) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
