"""Repair of conversation structure by weighted interval parsing.

The repaired roles must read ``(s?(ua)+)?`` (initials of system, user, assistant).  The repair grammar
is in Chomsky normal form over nonterminals ``[p>q]``: a span of rows, edited, takes the
reader of roles from state p to state q.  A row's cell has its edits, after any closure of
insertions; a longer span is ``[p>q] -> [p>r] [r>q]``.  A cell holds the least (cost, audit) of each
nonterminal, the audit being the edits' initials in order.  The language is regular, so
every derivation of a span falls apart at each inner place and one split of a
span is enough: spans are combined bottom-up, their length doubling.

Least cells may be combined: two audits of one span and cost have equally many rows' edits and
end with one, so none begins with the other, and what follows cannot change their order.

A conversation is parsed in pieces of ``turns_per_piece`` turn numbers, pieces are combined
256 at a time until one cell is left, and the chosen audit is handed back down to the
pieces.  No task holds more than a piece's rows or 256 cells.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save

STATES = 4  # nothing yet, after system, after user, after assistant
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
LEGAL = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
ENDS = (0, 3)
_WHITE = " \t\n\x0b\x0c\r"
_FAN = 256

Cell = list  # STATES x STATES of (cost, audit) or None


def _put(cell: Cell, p: int, q: int, cost: int, audit: str) -> None:
    at = p * STATES + q
    if cell[at] is None or (cost, audit) < cell[at]:
        cell[at] = (cost, audit)


def _closure() -> list[dict[int, int]]:
    """Per state the states that insertions lead to, and how many they take."""
    out = []
    for p in range(STATES):
        found, front = {p: 0}, [p]
        for q in front:
            for x in "ua":
                r = STEP.get((q, x))
                if r is not None and r not in found:
                    found[r] = found[q] + 1
                    front.append(r)
        out.append(found)
    return out


CLOSURE = _closure()
_LEAVES: dict[tuple, Cell] = {}


def leaf(initial: str, alive: bool, truncated: bool) -> Cell:
    """One row's cell: insertions, then an edit; a row that isn't alive must be deleted."""
    key = (initial, alive, truncated)
    if key not in _LEAVES:
        cell: Cell = [None] * STATES**2
        extra = 1 if truncated else 0
        for p in range(STATES):
            for q, n in CLOSURE[p].items():
                cost, audit = n * INSERT, "I" * n
                _put(cell, p, q, cost + DELETE, audit + "D")
                if alive and (q, initial) in STEP:
                    _put(cell, p, STEP[q, initial], cost + KEEP + extra, audit + "K")
                for x in "ua" if alive else "":
                    if (q, x) in STEP:
                        _put(cell, p, STEP[q, x], cost + REROLE + extra, audit + "R")
        if len(initial) > 1 or len(_LEAVES) > 10_000:
            return cell
        _LEAVES[key] = cell
    return _LEAVES[key]


def joined(x: Cell, y: Cell) -> Cell:
    """The cell of two adjacent spans."""
    out: Cell = [None] * STATES**2
    for p in range(STATES):
        for r in range(STATES):
            a = x[p * STATES + r]
            if a is None:
                continue
            for q in range(STATES):
                b = y[r * STATES + q]
                if b is not None:
                    _put(out, p, q, a[0] + b[0], a[1] + b[1])
    return out


def parsed(cells: list[Cell]) -> Cell:
    """The cell of a whole span, from those of its parts, length by length."""
    while len(cells) > 1:
        cells = [joined(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def power(cell: Cell, n: int) -> Cell:
    """The cell of ``n`` equal spans."""
    out = None
    while n:
        if n & 1:
            out = cell if out is None else joined(out, cell)
        cell, n = joined(cell, cell) if n > 1 else cell, n >> 1
    return out


def _packed(cell: Cell, illegal: int) -> dict:
    return {"costs": [x and x[0] for x in cell], "audits": [x and x[1] for x in cell], "illegal": illegal}


def _unpacked(costs, audits) -> list[Cell]:
    return [[None if c is None else (int(c), a) for c, a in zip(x, y)] for x, y in zip(costs, audits)]


def piece_cell(initials, copies, alive, truncated) -> dict:
    """Cell of the rows of a piece; only the first copy of a row can be alive."""
    cells, illegal = [], 0
    for k, (initial, n) in enumerate(zip(initials, copies)):
        n = int(n)
        illegal += n - 1 + (k > 0 and initials[k - 1] + initial not in LEGAL)
        if alive[k]:
            cells.append(leaf(initial, True, bool(truncated[k])))
            n -= 1
        if n:
            cells.append(power(leaf(initial, False, False), n))
    return _packed(parsed(cells), illegal)


def _crossings(heads, tails) -> int:
    return sum(a + b not in LEGAL for a, b in zip(tails, heads[1:]))


def parent_cell(costs, audits, illegal, heads, tails) -> dict:
    return _packed(parsed(_unpacked(costs, audits)), int(sum(illegal)) + _crossings(heads, tails))


def chosen(costs, audits, illegal, heads, tails) -> dict:
    """Least cost and audit of a conversation: from nothing to an end, insertions after the last row allowed."""
    cell = parsed(_unpacked(costs, audits))
    ways = []
    for q in range(STATES):
        for end in ENDS:
            if cell[q] is not None and end in CLOSURE[q]:
                n = CLOSURE[q][end]
                ways.append((cell[q][0] + n * INSERT, cell[q][1] + "I" * n))
    cost, audit = min(ways)
    return {"cost": cost, "audit": audit, "illegal": int(sum(illegal)) + _crossings(heads, tails)}


def shared_out(costs, audits, start, audit) -> list[dict]:
    """The part of the audit that falls to each child, and the state it begins in."""
    out, at, state = [], 0, int(start)
    for cell in _unpacked(costs, audits):
        # one end state only: a state and the edits determine the roles
        state_after, part = next(
            (q, cell[state * STATES + q][1])
            for q in range(STATES)
            if cell[state * STATES + q] is not None and audit.startswith(cell[state * STATES + q][1], at)
        )
        out.append({"start": state, "edits": part})
        at, state = at + len(part), state_after
    out[-1]["edits"] += audit[at:]  # insertions after the last row
    return out


def picks(start, edits, roles, copies) -> list[dict]:
    """The rows that stay or come in: edit, role and place among the piece's rows (0 if inserted)."""
    out, state, row, used = [], int(start), 0, 0
    named = {"u": "user", "a": "assistant"}
    for edit in edits:
        if edit != "I":
            while used >= copies[row]:
                row, used = row + 1, 0
            used += 1
            if edit == "D":
                continue
        x = roles[row][:1] if edit == "K" else "a" if state == 2 else "u"
        state = STEP[state, x]
        out.append({"edit": edit, "role": roles[row] if edit == "K" else named[x], "row": 0 if edit == "I" else row + 1})
    return out


_CELL = "struct<costs:array<long>,audits:array<string>,illegal:long>"


def _call(fn, kind: str, *columns: Column) -> Column:
    return F.udf(fn, kind, useArrow=True)(*columns)


@dataclass
class Repair:
    """``summary``: per conversation counts, cost and audit; ``pieces``: the repaired turns."""

    summary: DataFrame
    pieces: DataFrame


def _faulty(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Distinct rows with their copies and faults."""
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"),
    )
    rows = rows.groupBy("id", "turn", "role", "text").agg(F.count("*").alias("copies")).withColumn("hash", F.sha2("text", 256))
    firsts = rows.groupBy("id", "role", "hash").agg(F.min(F.struct("turn")).alias("at"))
    firsts = firsts.select(F.col("id").alias("f_id"), F.col("role").alias("f_role"), F.col("hash").alias("f_hash"), F.col("at.turn").alias("f_turn"))
    # the key is unique on both sides, so no key is hot
    same = F.col("id").eqNullSafe(F.col("f_id")) & (F.col("role") == F.col("f_role")) & (F.col("hash") == F.col("f_hash"))
    rows = rows.join(firsts, same & F.col("turn").eqNullSafe(F.col("f_turn")), "left")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.right(F.rtrim("text", F.lit(_WHITE)), F.lit(1)).isin(".", "!", "?")
    return rows.select("id", "turn", "role", "text", "copies", blank.alias("blank"), (~ended).alias("truncated"), F.col("f_hash").isNotNull().alias("first"))


def repair(
    df: DataFrame, turns_per_piece: int = 256, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> Repair:
    """The cheapest repair of each conversation.

    ``summary`` has ``id, gaps, blank, duplicate, truncated, illegal, cost, audit``; ``pieces`` has ``id, piece, edits`` and
    ``turns``, an array of (edit, role, text) of what the conversation then consists of, in order of ``piece``.

    Rows are ordered by turn (null turns first), those that share one by role and text.  Null
    roles and texts are one space.  Roles go by their first character; a role that is neither of the
    three is never kept.  Repeated rows are counted, not gathered, and deleted as
    duplicates.  Rows with a null id are one conversation.  An empty table gives empty results.  Other
    columns are not read.  Rows of one conversation that share a turn's number or have none
    are kept in one piece.
    """
    rows = save(_faulty(df, id_col, turn_col, role_col, text_col), "repair-rows")
    alive = F.col("first") & ~F.col("blank")
    counts = rows.groupBy("id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("copies") - F.col("first").cast("int"))).alias("duplicate"),
        F.sum((alive & F.col("truncated")).cast("long")).alias("truncated"),
    )

    row = F.struct("turn", "role", "text", "copies", alive.alias("alive"), "truncated")
    pieces = rows.groupBy("id", F.expr(f"turn div {int(turns_per_piece)}").alias("piece")).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    pieces = save(pieces, "repair-pieces")
    initials = F.transform("rows.role", lambda x: F.substring(x, 1, 1))
    cells = pieces.select("id", "piece", initials.alias("initials"), F.col("rows.copies"), F.col("rows.alive"), F.col("rows.truncated"))
    cells = cells.withColumn("cell", _call(piece_cell, _CELL, *map(F.col, ("initials", "copies", "alive", "truncated"))))
    cells = cells.select("id", "piece", "cell.*", F.get("initials", F.lit(0)).alias("head"), F.element_at("initials", -1).alias("tail"))

    levels: list[DataFrame] = []
    inner = [F.col(f"children.{x}") for x in ("costs", "audits", "illegal", "head", "tail")]
    while True:
        cells = save(cells, "repair-cells")
        ends = cells.agg(F.min("piece"), F.max("piece")).first()
        last = ends[0] is None or ends[1] - ends[0] < _FAN
        parent = F.lit(0).cast("long") if last else F.expr(f"piece div {_FAN}")
        child = F.struct("piece", "costs", "audits", "illegal", "head", "tail")
        levels.append(save(cells.groupBy("id", parent.alias("parent")).agg(F.sort_array(F.collect_list(child)).alias("children")), "repair-level"))
        if last:
            break
        cells = levels[-1].withColumn("cell", _call(parent_cell, _CELL, *inner)).select(
            "id", F.col("parent").alias("piece"), "cell.*", F.get("children.head", F.lit(0)).alias("head"), F.element_at("children.tail", -1).alias("tail")
        )

    best = levels[-1].withColumn("best", _call(chosen, "struct<cost:long,audit:string,illegal:long>", *inner))
    best = save(best.select("id", "parent", "best.*"), "repair-best")

    def handed(level: DataFrame, given: DataFrame) -> DataFrame:
        """``id, piece, start, edits`` of a level's children."""
        own = given.select(F.col("id").alias("g_id"), F.col("piece").alias("g_piece"), "start", "edits")
        both = level.join(own, F.col("id").eqNullSafe(F.col("g_id")) & F.col("parent").eqNullSafe(F.col("g_piece")))
        parts = _call(shared_out, "array<struct<start:int,edits:string>>", *inner[:2], F.col("start"), F.col("edits"))
        both = both.select("id", F.explode(F.arrays_zip(F.col("children.piece").alias("piece"), parts.alias("part"))).alias("x"))
        return both.select("id", F.col("x.piece").alias("piece"), F.col("x.part.start").alias("start"), F.col("x.part.edits").alias("edits"))

    given = best.select("id", F.col("parent").alias("piece"), F.lit(0).alias("start"), F.col("audit").alias("edits"))
    for level in reversed(levels):
        given = handed(level, given)
    given = given.select(F.col("id").alias("g_id"), F.col("piece").alias("g_piece"), "start", "edits")
    done = pieces.join(given, F.col("id").eqNullSafe(F.col("g_id")) & F.col("piece").eqNullSafe(F.col("g_piece")))
    found = _call(picks, "array<struct<edit:string,role:string,row:int>>", F.col("start"), F.col("edits"), F.col("rows.role"), F.col("rows.copies"))
    done = done.select("id", "piece", "rows", "edits", found.alias("found"))
    # the texts never leave the JVM
    text = lambda x: F.coalesce(F.get(F.col("rows.text"), x["row"] - 1), F.lit(""))
    turns = F.transform("found", lambda x: F.struct(x["edit"].alias("edit"), x["role"].alias("role"), text(x).alias("text")))
    summary = counts.withColumnRenamed("id", "c_id").join(best.drop("parent"), F.col("c_id").eqNullSafe(F.col("id")))
    return Repair(
        summary.select(F.col("id").alias(id_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"),
        done.select(F.col("id").alias(id_col), "piece", "edits", turns.alias("turns")),
    )


def digest(repaired: Repair, ids: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """The summary of all ``ids`` with a hash of each repaired conversation.

    The hash needs a conversation's text in one value, so this step is bound to conversations of 2 GB.
    """
    said = F.transform("turns", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    each = repaired.pieces.where(F.size("turns") > 0).select(F.col(id_col).alias("t_id"), F.struct("piece", F.array_join(said, "\n").alias("said")).alias("x"))
    whole = each.groupBy("t_id").agg(F.array_join(F.sort_array(F.collect_list("x"))["said"], "\n").alias("said"))
    out = ids.select(F.col(id_col).alias("id")).distinct()
    summary = repaired.summary.withColumnRenamed(id_col, "s_id")
    out = out.join(summary, F.col("id").eqNullSafe(F.col("s_id")), "left").join(whole, F.col("id").eqNullSafe(F.col("t_id")), "left")
    number = lambda x: F.coalesce(F.col(x), F.lit(0)).cast("long").alias(x)
    return out.select(
        F.col("id").alias(id_col),
        *map(number, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.coalesce("said", F.lit("")), 256).alias("repaired_sha256"),
    )


def damaged(df: DataFrame) -> DataFrame:
    """Conversation rows with faults planted by crc32(``conv_id:turn``) % 20 (nulls: one space).

    0 drops the row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 gives it to the user.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = df.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind")).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")
