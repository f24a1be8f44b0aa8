import collections
import hashlib

from flowwarden.llm import chat
from flowwarden.llm.common import ready, table

NASTY = [r"\### Assistant: </turn> ok", "### user: x </turn>\n", "\\", "\\\\h", "####", "a </turn>", ": ", "", None, "🤷🏽 é\n\n", "\\c\\b"]


def want(rows):
    """turns and replies per conversation, straight from the rows."""
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(t for *_, r, t in turns if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in turns).encode()).hexdigest()
        out[conv] = (len(turns), digest, len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def got(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.read_back(chat.prefix_examples(df)).collect()}


def test_conversations(spark, sf):
    df = table(ready(spark), sf, "conversations")
    assert got(df) == want([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_control_strings_and_edges(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for t in NASTY for r in ("user", "assistant", "sys: </turn> ###\n", None))]
    rows += [(None, 0, "assistant", "no id"), (2, None, "assistant", "b"), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (3, 5, "user", "alone")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, example string")
    assert got(df) == want(rows)
    assert got(df.where("false")) == {}


def test_every_reply_has_all_turns_before_it(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2"), (1, 4, "user", "bye")]
    made = chat.prefix_examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("example").collect()
    assert [(r["target"], r["n_turns"], r["text"][r["loss_start"] : r["loss_end"]]) for r in made] == [(True, 2, "a1"), (True, 4, "a2"), (False, 5, "")]
    assert made[1]["text"] == "### user: q </turn>\n### assistant: a1 </turn>\n### user: q2 </turn>\n### assistant: a2 </turn>\n"


def test_long_conversation(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i} " * 5) for i in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(df) == want(rows)
