"""Exact byte-level BPE token counts of every text prefix by dynamic programming.

The encoding of a prefix ends in exactly one token, and that token can be
found from the encodings of the shorter prefixes: it is the vocabulary entry
that ends there, encodes to itself and stays apart from the last token of
what precedes it.  One pass therefore gives the token count at *every*
prefix; truncation and budget questions read the stored counts instead of
encoding again.

Texts are cut before a single space or line break between two non-space
characters; the pre-tokenizer always cuts there too, so counts add up.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_right
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_PLAIN = re.compile(r"(\n?)( ?[A-Za-z]+)([!-&(-/:-@\[-`{-~]*)")
_MOVES = re.compile(r"\s+|['’]\w{0,2}")
_LEAD = re.compile(r"[ \n](?!\s)")
_PAIRS = 500_000
_ODD = re.compile(r"\s\s|^\s|\s$|[^\S \n]")


def cut(text: str) -> list[str]:
    """Pieces that are encoded independently; joined they are the text."""
    if not text:
        return []
    if _ODD.search(text):
        return _CUT.split(text)
    out: list[str] = []
    for k, line in enumerate(text.split("\n")):
        first, *rest = line.split(" ")
        out.append("\n" + first if k else first)
        out += [" " + x for x in rest]
    return out


class PrefixCounter:
    """Token counts at all prefixes under a byte-level BPE ``tokenizer.json``."""

    def __init__(self, path: str, memo_size: int = 300_000):
        import ahocorasick
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        model = spec["model"]
        if model["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"]:
            raise ValueError("a byte-level BPE tokenizer without normalizer is needed")
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        self.ranks = {pair: k for k, pair in enumerate(pairs)}
        # how each entry is made: rank of its merge and the two halves (single bytes: rank -1)
        self.made = {x: (-1, x, x) for x in model["vocab"]}
        for k, (left, right) in reversed(list(enumerate(pairs))):
            self.made[left + right] = (k, left, right)
        self.special = [x["content"] for x in spec["added_tokens"]]
        self.mapped = {b: self.tok.pre_tokenizer.pre_tokenize_str(b)[0][0] for b in map(chr, range(128))}
        self.entries = ahocorasick.Automaton()  # finds all entries in a word; those that encode to themselves
        for t in model["vocab"]:
            if t not in self.special and self.bpe(t) == [t]:
                self.entries.add_word(t, (len(t), t))
        self.entries.make_automaton()
        self.words = Memo(self._word, memo_size)
        self.counts = Memo(self._counts, memo_size)
        self.pairs: dict[str, bool] = {}  # _apart of two entries, joined by a space; emptied when full

    def bpe(self, s: str) -> list[str]:
        """Merge by rank, leftmost first (only used on one or two vocabulary entries)."""
        parts = list(s)
        while len(parts) > 1:
            rank, i = min((self.ranks.get(p, len(self.ranks)), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == len(self.ranks):
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _apart(self, a: str, b: str) -> bool:
        """Whether ``a`` and ``b`` side by side stay two tokens.

        Undo the later of the two merges at the seam, again and again: a merge
        across the seam wins if its rank comes before the merge undone last
        (at equal rank the left one goes first).
        """
        limit, ranks, made = len(self.ranks), self.ranks, self.made
        while True:
            if ranks.get((a, b), limit) < limit:
                return False
            (ra, _, inner), (rb, outer, _) = made[a], made[b]
            if ra > rb:
                limit, a = ra, inner
            elif rb >= 0:
                limit, b = rb + 1, outer
            else:
                return True

    def _word(self, s: str) -> bytes | list[int]:
        """Token counts after each byte of one pre-token (``s`` in the byte alphabet)."""
        last, count, pairs, known = [""], [0], self.pairs, 0
        for end, (size, t) in self.entries.iter(s):  # by end, the longest entry first
            if end < known:  # this prefix has its last token
                continue
            start = end + 1 - size
            if start:
                before = last[start]
                pair = before + " " + t
                apart = pairs.get(pair)
                if apart is None:
                    if len(pairs) >= _PAIRS:
                        pairs.clear()
                    apart = pairs[pair] = self._apart(before, t)
                if not apart:
                    continue
            last.append(t)
            count.append(count[start] + 1)
            known += 1
        if known != len(s):
            raise ValueError(f"{s!r} has bytes outside the vocabulary")
        return bytes(count) if len(count) <= 256 else count  # no count exceeds the bytes

    def _counts(self, piece: str) -> bytes | array:
        """Token counts after each character of an independently encoded piece."""
        plain = _PLAIN.fullmatch(piece)
        if plain:  # break, word, signs: three pre-tokens of one byte a character
            got = [0]
            for part in plain.groups():
                if part:
                    done = got[-1]
                    got += [done + x for x in self.words["".join(map(self.mapped.__getitem__, part))][1:]]
        elif any(x in piece for x in self.special):
            got = [len(self.tok.encode(piece[:k], add_special_tokens=False)) for k in range(len(piece) + 1)]
        else:
            got, done, ascii_only = [0], 0, piece.isascii()
            for mapped, _ in self.tok.pre_tokenizer.pre_tokenize_str(piece):
                per_byte = self.words[mapped]
                if ascii_only:
                    got += [done + x for x in per_byte[1:]]
                else:
                    pos = 0
                    for width in self._widths(piece, len(got) - 1, len(mapped)):
                        pos += width
                        got.append(done + per_byte[pos])
                done += per_byte[-1]
            self._mend(piece, got)
        return bytes(got) if max(got) < 256 else array("I", got)

    @staticmethod
    def _widths(piece: str, start: int, n_bytes: int) -> list[int]:
        out, size = [], 0
        while size < n_bytes:
            out.append(len(piece[start + len(out)].encode()))
            size += out[-1]
        return out

    def _mend(self, piece: str, got: list[int]) -> None:
        """A cut inside or after a run of space, or after an apostrophe, moves the
        pre-tokens before the cut; those prefixes are split on their own."""
        first = 1 if _LEAD.match(piece) else 0  # one byte of space at the start is one token by itself too
        for m in _MOVES.finditer(piece, first):
            for end in range(m.start() + 1, min(m.end() + 1, len(piece))):
                got[end] = sum(self.words[w][-1] for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(piece[:end]))

    def table(self, text: str) -> PrefixTable:
        pieces = cut(text)
        tables = list(map(self.counts.__getitem__, pieces))
        return PrefixTable(
            list(accumulate(map(len, pieces), initial=0)), list(accumulate((t[-1] for t in tables), initial=0)), tables
        )


class PrefixTable(NamedTuple):
    """``count(p)`` is the exact token count of the text's first p characters."""

    starts: list[int]
    before: list[int]
    tables: list

    @property
    def total(self) -> int:
        return self.before[-1]

    def count(self, p: int) -> int:
        k = min(bisect_right(self.starts, p) - 1, len(self.tables) - 1)
        return self.before[k] + self.tables[k][p - self.starts[k]] if k >= 0 else 0

    def longest(self, limit: int) -> int:
        """Characters of the longest prefix with at most ``limit`` tokens."""
        k = bisect_right(self.before, limit) - 1
        if k >= len(self.tables):
            return self.starts[-1]
        room, t = limit - self.before[k], self.tables[k]
        return self.starts[k] + max(i for i in range(len(t)) if t[i] <= room)


_COUNTERS: dict[str, PrefixCounter] = {}


def _counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def count_tokens(
    df: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` and ``fit_chars``.

    ``fit_chars`` is the longest prefix, in characters, of at most ``limit``
    tokens; both answers come from the same prefix counts.  Null and empty
    texts have 0 bytes, 0 tokens and fit whole.  Null ids stay null, repeated
    rows give a row each, other columns are not read, an empty table gives an
    empty result.  Whole texts are counted, whatever their length.
    """

    def run(batches):
        counter = _counter(tokenizer)
        for batch in batches:
            n, fit, size = [], [], []
            for x in batch.column(1):
                text = x.as_py() or ""
                t = counter.table(text)
                n.append(t.total)
                fit.append(t.longest(limit))
                size.append(len(x.as_buffer()) if x.is_valid else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_()), pa.array(fit, pa.int64())],
                ["id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
            )

    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")
    return out.withColumnRenamed("id", id_col)


def prefix_counts(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The stored table itself: ``counts[p]`` is the token count of the first p characters (p from 0)."""

    def run(batches):
        counter = _counter(tokenizer)
        for batch in batches:
            for k in range(batch.num_rows):  # one text at a time: its counts are many
                t = counter.table(batch.column(1)[k].as_py() or "")
                got = [0]
                for base, piece in zip(t.before, t.tables):
                    got += [base + x for x in piece[1:]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), pa.array([got], pa.list_(pa.int64()))], ["id", "counts"])

    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, counts array<long>").withColumnRenamed("id", id_col)
