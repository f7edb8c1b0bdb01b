"""Packing documents into training windows by Karmarkar-Karp multiway differencing.

Each document is encoded and cut into full windows; the rests, all shorter
than a window, are gathered in a task until they fill ``windows`` windows but
for a small slack, and are then spread over them by differencing: the two
partial partitions with the largest imbalance are merged, the heaviest window
of one with the lightest of the other, until one near-equal partition is
left.  If its heaviest window exceeds the capacity, one more window is tried.

Nothing is shuffled: a task packs its own documents and holds at most one
round of rests, so no key or group can grow a task beyond its input split.
"""

from __future__ import annotations

import heapq
import re
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Indices of ``sizes`` in ``windows`` lists of near-equal sums."""
    # a partial partition: [(sum, items)] by falling sum, empty windows left out
    heap = [(-size, k, [(size, [k])]) for k, size in enumerate(sizes)]
    heapq.heapify(heap)
    k = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = a + b
        if (over := len(both) - windows) > 0:
            # fill up with empty windows, heavy meets light: the `over` lightest of a and of b share
            merged = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a[len(a) - over :], reversed(b[len(b) - over :]))]
            both = a[: len(a) - over] + b[: len(b) - over] + merged
        both.sort(key=lambda x: -x[0])
        spread = both[0][0] - (both[-1][0] if len(both) == windows else 0)
        heapq.heappush(heap, (-spread, k, both))
        k += 1
    return [items for _, items in heap[0][2]] if heap else []


def fill(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``; their count rises until all fit."""
    windows = max(1, -(-sum(sizes) // capacity)) if sizes else 0
    while sizes:
        parts = differencing(sizes, windows)
        if max(sum(sizes[k] for k in part) for part in parts) <= capacity:
            return parts
        windows += 1
    return []


#: Lower-case Latin letters that no normaliser changes.
_LETTERS = "".join(c for c in map(chr, [*range(97, 123), *range(0xDF, 0x100)]) if c.isalpha())


class Encoder:
    """Ids of whole texts as little-endian uint32 bytes.

    With ``by_space`` the texts are cut at plain spaces and line breaks and the
    pieces' ids are kept; this is exact for tokenizers that drop white space
    and split words from signs.
    """

    def __init__(self, path: str, by_space: bool = True):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.by_space = by_space
        #: pieces of ASCII alone may be lowered before, where no special token stands
        self.lowers = by_space and self.encode("ABC Xyz") == self.encode("abc xyz")
        self.memo = Memo(self._piece, 500_000)
        self.plain = None  # words of these letters go to the model as they are
        if by_space and self.tok.pre_tokenizer is not None:
            found = {c: self.tok.pre_tokenizer.pre_tokenize_str(c) for c in _LETTERS}
            self.mapped = {c: x[0][0] for c, x in found.items() if len(x) == 1}
            words = [*_LETTERS, "hello", "straße", "élève", "pingüino", "internationalization"]
            if len(self.mapped) == len(_LETTERS) and all(self._word(w) == self.encode(w) for w in words):
                self.plain = re.compile(f"[{_LETTERS}]+")

    def encode(self, text: str) -> bytes:
        return b"".join(x.to_bytes(4, "little") for x in self.tok.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        mapped = "".join(map(self.mapped.__getitem__, word))
        return b"".join(x.id.to_bytes(4, "little") for x in self.tok.model.tokenize(mapped))

    def _piece(self, piece: str) -> bytes:
        if self.plain and self.plain.fullmatch(piece):
            return self._word(piece)
        # the pre-tokenizer joins a sign with a mark before it, and the normaliser makes
        # letters plus marks of some letters: only words of plain letters are cut off
        word = piece[:-1]
        if piece[-1:] in (".", ",") and (word.isascii() and word.isalpha() or self.plain and self.plain.fullmatch(word)):
            return self.memo[word] + self.memo[piece[-1]]
        return self.encode(piece)

    def __call__(self, text: str) -> bytes:
        if not self.by_space:
            return self.encode(text)
        lowers = self.lowers and "<|" not in text
        if lowers and text.isascii():
            text, lowers = text.lower(), False
        pieces = text.replace("\n", " ").split(" ")
        if lowers:
            # a capital may compose with a mark after it in one case only
            pieces = [x.lower() if x.isascii() else x for x in pieces]
        return b"".join(map(self.memo.__getitem__, pieces))


_ENCODERS: dict[tuple, Encoder] = {}

_SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    df: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 4096,
    windows: int = 128,
    slack: int = 12,
    longest: int = 1024,
    by_space: bool = True,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its ids followed by ``end_id``.  Full windows are sequences
    of their own.  The rest is cut into equal parts of at most ``longest`` tokens
    (large parts can't be balanced) and where it would overfill the round, so
    that a round holds ``windows * (capacity - slack)`` tokens; only the last
    round of a task is smaller.  ``sequence_id`` is the task's number times 2^33 plus a count, so a
    retried task numbers its sequences as before.  ``with_ids`` adds the ids
    (little-endian uint32).

    Null and empty texts are one piece holding ``end_id``.  Null ids and
    repeated rows are packed like any other row; other columns are not read;
    an empty table gives no pieces.
    """
    fields = _SCHEMA + (", ids binary" if with_ids else "")
    room = windows * (capacity - slack)

    def run(batches):
        encoder = _ENCODERS.setdefault((tokenizer, by_space), None) or Encoder(tokenizer, by_space)
        _ENCODERS[tokenizer, by_space] = encoder
        sequence = TaskContext.get().partitionId() << 33
        end = end_id.to_bytes(4, "little")
        rests: list[tuple] = []
        held = 0
        kind = None

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found))
            types = [kind, *[pa.int64()] * 6, *[pa.binary()] * with_ids]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["id", *[x.split()[0] for x in fields.split(", ")]])

        def flush() -> list[tuple]:
            nonlocal sequence, held
            out = []
            for part in fill([x[2] for x in rests], capacity):
                offset = 0
                for k in part:
                    out.append((*rests[k][:5], sequence, offset, *rests[k][5:]))
                    offset += rests[k][2]
                sequence += 1
            rests.clear()
            held = 0
            return out

        for batch in batches:
            kind = batch.schema.field(0).type
            out = []
            for k in range(batch.num_rows):
                doc, ids = batch.column(0)[k].as_py(), encoder(batch.column(1)[k].as_py() or "") + end
                total, start = len(ids) // 4, 0

                def piece(length):
                    part = ids[4 * start : 4 * (start + length)]
                    return (doc, start, length, zlib.crc32(part), total, *([part] if with_ids else []))

                while total - start >= capacity:
                    x = piece(capacity)
                    out.append((*x[:5], sequence, 0, *x[5:]))
                    sequence += 1
                    start += capacity
                parts = -(-(total - start) // longest)
                while start < total:
                    length = min(-(-(total - start) // max(parts, 1)), room - held)
                    parts -= 1
                    rests.append(piece(length))
                    held += length
                    start += length
                    if held == room:
                        out += flush()
                if len(out) >= 4096:
                    yield rows(out)
                    out = []
            if out:
                yield rows(out)
        if rests:
            yield rows(flush())

    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, {fields}")
    return out.withColumnRenamed("id", id_col)
