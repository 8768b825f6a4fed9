import hashlib
import random

import pytest

from headway.llm import chat_format

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
SAID = r"\### Assistant: </turn> ok"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    """The template by its definition, and the digest columns."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted([(t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv])
        turns = [(role, text) for _, _, role, text in turns]
        formatted = ""
        for i, (role, text) in enumerate(turns):
            escaped = text.replace("\\", "\\b")
            for control in ("turn ", "/turn>", "next/>"):
                escaped = escaped.replace(f"<{control}", f"\\l{control}")
            if i == 0 or turns[i - 1][0] != role:
                head = role.replace("\\", "\\b").replace("\n", "\\n").replace(">", "\\g")
                formatted += f"<turn {head}>\n"
            formatted += escaped + ("<next/>" if i + 1 < len(turns) and turns[i + 1][0] == role else "</turn>\n")
        lost = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (formatted, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(lost), sha(lost), len(formatted))
    return out


def conversations(rng):
    texts = ["", None, "plain", SAID, "<turn user>\nx</turn>\n", "a<next/>b\\", "\\l\\b\\\\<", "</turn", "<</turn>>", "é😀\n", "<turn ", "\\<next/>", "\r\n</turn>\n<turn assistant>\n"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "odd>\n\\n role"]), rng.choice(texts)) for c in range(60) for t in range(rng.randrange(1, 12))]
    rows += [(-7, 0, "user", SAID), (-7, 1, "assistant", SAID), (900, None, "assistant", "no turn"), (900, 1, "assistant", "b"), (900, 1, "assistant", "b"), (900, 1, "user", "tie")]
    return rows + [(None, 0, "user", "no id"), (None, 1, "assistant", "either")]


@pytest.mark.parametrize("block", [2, 512])
def test_round_trip(spark, monkeypatch, block):
    monkeypatch.setattr(chat_format, "BLOCK", block)
    rows = conversations(random.Random(block))
    made = chat_format.format_conversations(spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)).cache()
    want = brute(rows)
    assert {r.conv_id: r.formatted for r in made.collect()} == {c: w[0] for c, w in want.items()}
    assert {r[0]: tuple(r)[1:] for r in chat_format.digest(made).collect()} == {c: w[1:] for c, w in want.items()}


def test_masked_spans_are_the_escaped_texts(spark):
    rows = [(1, 0, "user", "q</turn>"), (1, 1, "assistant", SAID), (1, 2, "assistant", "é😀x")]
    made = chat_format.format_conversations(spark.createDataFrame([(*r, "") for r in rows], SCHEMA)).first()
    spans = [made.formatted[s.start : s.start + s.length] for b in made.loss for s in b.spans]
    assert spans == [r"\b### Assistant: \l/turn> ok", "é😀x"] and [b.start for b in made.loss] == [0]


def test_long_conversation_and_no_rows(spark):
    rows = [(5, i, "assistant" if i % 3 else "user", f"text {i} <next/>") for i in range(3000)]
    df = spark.createDataFrame([(*r, "") for r in rows], SCHEMA)
    found = chat_format.digest(chat_format.format_conversations(df)).collect()
    assert [tuple(r)[1:] for r in found] == [brute(rows)[5][1:]]
    assert chat_format.digest(chat_format.format_conversations(df.limit(0))).count() == 0


def test_main_path_is_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "x", "")], SCHEMA)
    plan = chat_format.digest(chat_format.format_conversations(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
