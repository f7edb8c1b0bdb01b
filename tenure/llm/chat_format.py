"""Conversations as one formatted text with a loss mask, by Spark expressions alone.

Template: the text begins with ``<s>``; each block of adjacent turns of one role stands
between the role's marks (``[SYS]..[/SYS]``, ``[INST]..[/INST]``, ``[ANS]..</s>``, any other role
``[ROLE]name[/ROLE]..[/TURN]``), and ``[NEXT]`` parts its turns.  Control strings inside a
text get a backslash after their first character, those that have some
backslashes there one more, so that taking one away gives the text back.

A conversation is sorted, merged and joined in pieces of ``turns_per_piece`` turn
numbers, so a conversation of any length is spread over tasks.  A block may run over
several pieces: roles at the pieces' ends are taken from a narrow aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")}
BEGIN, NEXT, OTHER = "<s>", "[NEXT]", ("[ROLE]", "[/ROLE]", "[/TURN]")

#: A control string's first character, backslashes, and the rest of it.
_TAILS = r"(/?INST\]|/?SYS\]|ANS\]|/?ROLE\]|/TURN\]|NEXT\]|/?s>)"
_PLAIN, _ESCAPED = r"([\[<])(\\*)" + _TAILS, r"([\[<])\\(\\*)" + _TAILS

_OPENS = r"\[SYS\]|\[INST\]|\[ANS\]|\[ROLE\]"
_HEAD = r"(?s)\A(?:\[SYS\]|\[INST\]|\[ANS\]|\[ROLE\].*?\[/ROLE\])"
_FOOT = r"(?:\[/SYS\]|\[/INST\]|</s>|\[/TURN\])\z"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _open(role: Column) -> Column:
    other = F.concat(F.lit(OTHER[0]), role, F.lit(OTHER[1]))
    return F.coalesce(*[F.when(role == k, v[0]) for k, v in MARKS.items()], other)


def _close(role: Column) -> Column:
    return F.coalesce(*[F.when(role == k, v[1]) for k, v in MARKS.items()], F.lit(OTHER[2]))


def _runs(turns: Column) -> Column:
    """Adjacent turns of one role merged: array of (role, texts)."""
    kind = "array<struct<role:string,texts:array<string>>>"

    def step(done: Column, turn: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(turn["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
        new = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        merged = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
        return F.when(last["role"] == turn["role"], merged).otherwise(F.concat(done, F.array(new))).cast(kind)

    return F.aggregate(turns, F.array().cast(kind), step)


def _parts(runs: Column, before: Column) -> Column:
    """Array of (what stands before a text, the text, whether it is learnt)."""

    def of(run: Column, i: Column) -> Column:
        ended = F.when(i == 0, F.when(before.isNull(), BEGIN).otherwise("")).otherwise(_close(F.get(runs, i - 1)["role"]))
        first = F.when((i == 0) & before.isNotNull() & (before == run["role"]), F.lit(NEXT)).otherwise(F.concat(ended, _open(run["role"])))
        return F.transform(
            run["texts"],
            lambda text, j: F.struct(
                F.when(j == 0, first).otherwise(NEXT).alias("mark"), text.alias("text"), (run["role"] == "assistant").alias("learnt")
            ),
        )

    return F.flatten(F.transform(runs, of))


def _spans(parts: Column) -> Column:
    """Start and end (exclusive, in code points of the piece) of each learnt text."""
    kind = "struct<at:int,spans:array<struct<start:int,end:int>>>"

    def step(acc: Column, part: Column) -> Column:
        start = acc["at"] + F.length(part["mark"])
        end = start + F.length(part["text"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(part["learnt"], F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans")).cast(kind)

    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().alias("spans")).cast(kind), step)["spans"]


def format_chat(
    df: DataFrame, turns_per_piece: int = 256, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Per conversation and piece: ``id, piece, open_role, formatted, loss_spans``.

    A conversation's formatted text is that of its pieces in order of ``piece``.
    ``open_role`` is the role of the block that the piece goes on with, null where it begins
    a conversation.  ``loss_spans`` are positions of assistant texts, as they stand (escaped).

    Rows are ordered by turn (null turns first), those that share a turn by role and
    escaped text; repeated rows are turns of their own.  Null texts and roles are empty; any role
    is allowed.  Rows with a null id are one conversation.  Other columns are not read;
    an empty table gives an empty result.  Rows of one conversation that
    share a turn's number or have none are kept in one piece.
    """
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        escape(F.coalesce(F.col(f"`{role_col}`"), F.lit(""))).alias("role"),
        F.col(f"`{text_col}`").alias("text"),
    ).withColumn("piece", F.coalesce(F.expr(f"turn div {int(turns_per_piece)}"), F.lit(-(2**63))))

    ends = rows.groupBy("id", "piece").agg(F.min(F.struct("turn", "role")).alias("first"), F.max(F.struct("turn", "role")).alias("last"))
    order = Window.partitionBy("id").orderBy("piece")
    ends = ends.select(
        F.col("id").alias("of"),
        F.col("piece").alias("at"),
        F.lag("last").over(order)["role"].alias("before"),
        F.lead("first").over(order)["role"].alias("after"),
    ).where("before is not null or after is not null")

    turn = F.struct("turn", "role", escape(F.coalesce("text", F.lit(""))).alias("text"))
    pieces = rows.groupBy("id", "piece").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    pieces = pieces.join(ends, F.col("id").eqNullSafe(F.col("of")) & (F.col("piece") == F.col("at")), "left")
    pieces = pieces.select("id", "piece", "before", "after", _runs(F.col("turns")).alias("runs"))
    pieces = pieces.withColumn("parts", _parts(F.col("runs"), F.col("before")))
    last = F.element_at("runs", -1)["role"]
    tail = F.when(F.col("after").isNotNull() & (F.col("after") == last), "").otherwise(_close(last))
    body = F.array_join(F.transform("parts", lambda x: F.concat(x["mark"], x["text"])), "")
    return pieces.select(
        F.col("id").alias(id_col),
        "piece",
        F.col("before").alias("open_role"),
        F.concat(body, tail).alias("formatted"),
        _spans(F.col("parts")).alias("loss_spans"),
    )


def read_back(pieces: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """The turns of each formatted piece and the texts under its loss mask, without escapes."""
    formatted, role = F.col("formatted"), F.col("open_role")

    def turns(block: Column) -> Column:
        named = F.regexp_extract(block, r"(?s)\A\[ROLE\](.*?)\[/ROLE\]", 1)
        known = [F.when(block.startswith(v[0]), k) for k, v in MARKS.items()]
        own = F.coalesce(*known, F.when(block.startswith(OTHER[0]), named), role)
        texts = F.split(F.regexp_replace(F.regexp_replace(block, _HEAD, ""), _FOOT, ""), r"\[NEXT\]", -1)
        # a block that goes on begins with the mark
        texts = F.when(block.startswith(NEXT), F.slice(texts, 2, F.size(texts))).otherwise(texts)
        return F.transform(texts, lambda x: F.struct(unescape(own).alias("role"), unescape(x).alias("text")))

    blocks = F.split(F.regexp_replace(formatted, r"\A<s>", ""), f"(?={_OPENS})", -1)
    learnt = F.transform("loss_spans", lambda s: unescape(F.substr(formatted, s["start"] + 1, s["end"] - s["start"])))
    return pieces.select(
        id_col, "piece", F.flatten(F.transform(blocks, turns)).alias("turns"), learnt.alias("learnt"), F.length(formatted).alias("chars")
    )


def digest(pieces: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Per conversation the counts and hashes of what :func:`read_back` finds.

    A hash needs a conversation's text in one value, so this one step is bound to
    conversations of 2 GB; the formatting is not.
    """
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    each = read_back(pieces, id_col).select(
        F.col(id_col),
        F.struct("piece", said.alias("said"), F.array_join("learnt", "").alias("learnt")).alias("x"),
        F.size("turns").alias("n"),
        "chars",
    )
    whole = each.groupBy(id_col).agg(F.sort_array(F.collect_list("x")).alias("x"), F.sum("n").alias("n"), F.sum("chars").alias("chars"))
    learnt = F.array_join("x.learnt", "")
    return whole.select(
        id_col,
        F.col("n").cast("long").alias("n_turns"),
        F.sha2(F.array_join("x.said", ""), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.col("chars").cast("long").alias("formatted_chars"),
    )
