"""Chat formatting and conversation repair against plain versions."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tenure.llm import chat_format

SCHEMA = "conv_id long, turn long, role string, text string, piece string, id string, turns int, after string"
CONTROLS = ["[INST]", "[/INST]", "<s>", "</s>", "[SYS]", "[ANS]", "[ROLE]x[/ROLE]", "[NEXT]", "[/TURN]", "\\", "[", "<", "[\\INST]", "</\\s>", "\n"]


def _random_rows(seed, n=400):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice([*CONTROLS, "é", "word ", "x"]) for _ in range(rng.randint(0, 8)))
    roles = ["system", "user", "assistant", "assistant", "tool", "[ROLE]", "", None]
    rows = [(rng.randint(0, 30), rng.choice([None, *range(-9, 40)]), rng.choice(roles), rng.choice([None, text(), text()])) for _ in range(n)]
    rows += [(None, 1, "user", "no id"), (None, 2, "assistant", "none"), rows[0], rows[0]]
    rows += [(99, t, "assistant" if t > 9 else "user", f"turn {t} [NEXT]") for t in range(25)]
    return [(*r, "a", "b", 3, "c") for r in rows]


def _wanted(rows):
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = {}
    for k, own in by.items():
        # rows of one turn are ordered by their escaped role and text
        own = sorted(own, key=lambda r: (*order(r)[:2], chat_escape(r[2] or ""), chat_escape(r[3] or "")))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[k] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def chat_escape(text):
    import re

    return re.sub(r"([\[<])(\\*)(/?INST\]|/?SYS\]|ANS\]|/?ROLE\]|/TURN\]|NEXT\]|/?s>)", lambda m: f"{m[1]}\\{m[2]}{m[3]}", text)


@pytest.mark.parametrize("seed, per_piece", [(1, 256), (2, 256), (3, 4), (4, 1)])
def test_chat_reads_back(spark, seed, per_piece):
    rows = _random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = chat_format.digest(chat_format.format_chat(df, turns_per_piece=per_piece)).collect()
    assert {r[0]: tuple(r[1:5]) for r in got} == _wanted(rows) and len(got) == len(_wanted(rows))


def test_chat_pieces_join_to_one_text(spark):
    df = spark.createDataFrame(_random_rows(5), SCHEMA).where("turn is not null").withColumn("turn", F.col("turn") + 100)

    def whole(n):
        found = {}
        for r in sorted(chat_format.format_chat(df, turns_per_piece=n).collect(), key=lambda r: r.piece):
            base = len(found.get(r.conv_id, ("", []))[0])
            text, spans = found.get(r.conv_id, ("", []))
            found[r.conv_id] = (text + r.formatted, spans + [(s.start + base, s.end + base) for s in r.loss_spans])
        return found

    assert whole(3) == whole(1000)


def test_chat_template(spark):
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", "a </s>"), (1, 2, "user", "b"), (1, 3, "assistant", "c [NEXT]"), (1, 4, "tool", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (r,) = chat_format.format_chat(df).collect()
    assert r.formatted == "<s>[SYS]be brief[/SYS][INST]a <\\/s>[NEXT]b[/INST][ANS]c [\\NEXT]</s>[ROLE]tool[/ROLE][/TURN]"
    assert [r.formatted[s.start : s.end] for s in r.loss_spans] == ["c [\\NEXT]"]
    assert chat_format.digest(chat_format.format_chat(df.limit(0))).count() == 0
    long = spark.createDataFrame([(1, 0, "assistant", "[INST]" * 200_000)], df.schema)
    (d,) = chat_format.digest(chat_format.format_chat(long)).collect()
    assert d.loss_chars == 1_200_000 and d.loss_sha256 == hashlib.sha256(b"[INST]" * 200_000).hexdigest()
