"""SentencePiece models on the ``tokenizers`` library.

The model protobuf is parsed and its parts are rebuilt: the normaliser
(precompiled character map, extra spaces, dummy prefix), the metaspace marker,
unigram scores, or for BPE models the merges that the scores imply, and byte
fallback.  Batches are encoded by several threads.  Every text can be
encoded by the ``sentencepiece`` library too, to verify parity.
"""

from __future__ import annotations

import heapq
import os
import re
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, slices

_SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
#: packs so many ids
_IDS = [struct.Struct(f"<{n}I").pack for n in range(65)]
_CHUNK = re.compile(f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+")


def build(path: str):
    """The ``tokenizers.Tokenizer`` equal to the SentencePiece model at ``path``, and the parsed model."""
    from sentencepiece import sentencepiece_model_pb2
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    trainer, norm = proto.trainer_spec, proto.normalizer_spec
    pieces = [(p.piece, p.score) for p in proto.pieces]
    ids = {p: k for k, (p, _) in enumerate(pieces)}
    usable = {p.piece: p.score for p in proto.pieces if p.type in (_NORMAL, _USER)}
    if trainer.treat_whitespace_as_suffix:
        raise ValueError("models with the space marker as a suffix are not supported")
    if trainer.model_type == 1:
        model = models.Unigram(pieces, trainer.unk_id, trainer.byte_fallback)
    elif trainer.model_type == 2:
        merges = [
            (-score, ids[p[:k]], ids[p[k:]], p[:k], p[k:])
            for p, score in usable.items()
            for k in range(1, len(p))
            if p[:k] in usable and p[k:] in usable
        ]
        model = models.BPE(
            ids, [m[3:] for m in sorted(merges)], unk_token=pieces[trainer.unk_id][0], fuse_unk=True, byte_fallback=trainer.byte_fallback
        )
    else:
        raise ValueError("only unigram and BPE models are supported")
    tok = Tokenizer(model)
    steps = []
    if norm.precompiled_charsmap:
        steps.append(normalizers.Precompiled(norm.precompiled_charsmap))
    if norm.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if norm.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if norm.escape_whitespaces:
        steps.append(normalizers.Replace(" ", _SPACE))
    tok.normalizer = normalizers.Sequence(steps)
    user = [AddedToken(p.piece, normalized=False) for p in proto.pieces if p.type == _USER]
    if user:
        tok.add_tokens(user)
    ends = [decoders.Replace(_SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    tok.decoder = decoders.Sequence([*ends, *([decoders.Strip(" ", 1, 0)] if norm.add_dummy_prefix else [])])
    return tok, proto


class Codec:
    """Encode and decode whole texts.

    Where no piece goes on with the space marker, a normalised text can be cut
    before each run of markers; the pieces' ids and decodings are kept.
    """

    def __init__(self, path: str, threads: int = 2):
        from tokenizers import normalizers

        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        self.tok, proto = build(path)
        norm = proto.normalizer_spec
        self.prefix = norm.add_dummy_prefix
        #: the normaliser only marks spaces
        self.plain = self.prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
        usable = {p.piece: p.score for p in proto.pieces if p.type in (_NORMAL, _USER)}
        self.separate = not any(_SPACE in p.lstrip(_SPACE) for p in usable) and not any(p.type == _USER for p in proto.pieces)
        self.part, _ = build(path)  # for what is normalised already
        self.part.normalizer = normalizers.Sequence([])
        self.scores = usable if proto.trainer_spec.model_type == 2 else None
        #: what each id decodes to by itself; None where it needs its neighbours (bytes) or is special
        self.spelt = [None if p.type != _NORMAL or p.piece.startswith("<0x") else p.piece.replace(_SPACE, " ") for p in proto.pieces]
        self.known = Memo(self._new)

    def _by_score(self, chunk: str) -> list[str]:
        """BPE by score, the leftmost pair first among equal scores.

        Merge ranks cannot say that: only runs of the space marker, whose
        pieces share one score, need it.
        """
        parts, after, before = list(chunk), list(range(1, len(chunk) + 1)), list(range(-1, len(chunk) - 1))
        heap: list[tuple] = []

        def offer(k: int) -> None:
            if 0 <= k and after[k] < len(parts) and (both := parts[k] + parts[after[k]]) in self.scores:
                heapq.heappush(heap, (-self.scores[both], k, both))

        for k in range(len(parts)):
            offer(k)
        while heap:
            _, k, both = heapq.heappop(heap)
            if not parts[k] or after[k] >= len(parts) or parts[k] + parts[after[k]] != both:
                continue
            gone = after[k]
            parts[k], parts[gone], after[k] = both, "", after[gone]
            if after[k] < len(parts):
                before[after[k]] = k
            offer(before[k])
            offer(k)
        return [x for x in parts if x]

    def _new(self, keys: list[str]) -> list[bytes | tuple[bytes, str]]:
        """Of each chunk its ids, and what they decode to where that is not the chunk itself.

        The keys of a ``plain`` model leave out the chunk's first space marker.
        """
        chunks = [_SPACE + k for k in keys] if self.plain else keys
        got = [x.ids for x in self.part.encode_batch_fast(chunks, add_special_tokens=False)]
        if self.scores:
            for k, chunk in enumerate(chunks):
                if _SPACE * 3 in chunk:
                    got[k] = [i for x in self._by_score(chunk) for i in self._one(x)]
        out: list = [np.array(x, "<u4").tobytes() if len(x) > 64 else _IDS[len(x)](*x) for x in got]
        spelt, hard = self.spelt.__getitem__, []
        spoken = [self._spoken(k) for k in keys]
        for k, ids in enumerate(got):
            try:
                text = "".join(map(spelt, ids))
            except TypeError:
                hard.append(k)
                continue
            if text != spoken[k]:
                out[k] = out[k], text
        for k, text in zip(hard, self._decoded([got[k] for k in hard])):
            if text != spoken[k]:
                out[k] = out[k], text
        return out

    def _spoken(self, key: str) -> str:
        """The text that a chunk stands for."""
        text = key.replace(_SPACE, " ")
        return " " + text if self.plain else text

    def _one(self, piece: str) -> list[int]:
        known = self.tok.token_to_id(piece)
        return [known] if known is not None else self.part.encode(piece, add_special_tokens=False).ids

    def _decoded(self, ids: list[list[int]]) -> list[str]:
        """Decoded without taking off the dummy prefix."""
        if not self.prefix:
            return self.tok.decode_batch(ids, skip_special_tokens=False)
        lead = self.tok.token_to_id(_SPACE)
        return self.tok.decode_batch([[lead, *x] for x in ids], skip_special_tokens=False)

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Of each text the ids (little-endian uint32) and what they decode to."""
        if not self.separate:
            ids = [x.ids for x in self.tok.encode_batch(texts, add_special_tokens=False)]
            return [(np.array(x, "<u4").tobytes(), t) for x, t in zip(ids, self.decode(ids))]
        docs = []
        for text in texts:
            if not text:
                docs.append([])
            elif self.plain and text[0] != " " and "  " not in text and _SPACE not in text:
                docs.append(text.split(" "))
            else:
                flat = _SPACE + text.replace(" ", _SPACE) if self.plain else self.tok.normalizer.normalize_str(text)
                chunks = _CHUNK.findall(flat)
                docs.append([x[1:] for x in chunks] if self.plain else chunks)
        here, new, known, old = {}, [], self.known, self.known.old
        for c in set().union(*docs):
            value = known.get(c)
            if value is None:
                value = old.get(c)
                if value is None:
                    new.append(c)
                    continue
                known.put(c, value)
            here[c] = value
        for at in range(0, len(new), 10_000):
            some = new[at : at + 10_000]
            for c, value in zip(some, self._new(some)):
                known.put(c, value)
                here[c] = value
        out = []
        mark = " " if self.plain else ""
        for doc in docs:
            parts = list(map(here.__getitem__, doc))
            try:
                ids = b"".join(parts)
                text = mark + mark.join(doc).replace(_SPACE, " ") if doc else ""
            except TypeError:  # some chunk decodes to something else
                both = [x if isinstance(x, tuple) else (x, self._spoken(c)) for x, c in zip(parts, doc)]
                ids, text = b"".join([x for x, _ in both]), "".join([t for _, t in both])
            out.append((ids, text[1:] if self.prefix and text[:1] == " " else text))
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tok.decode_batch(ids, skip_special_tokens=False)


_CODECS: dict[tuple, Codec] = {}
_REFERENCE: dict[str, object] = {}


def _codec(path: str, threads: int) -> Codec:
    if (path, threads) not in _CODECS:
        _CODECS[path, threads] = Codec(path, threads)
    return _CODECS[path, threads]


def encode(
    df: DataFrame,
    model: str,
    threads: int = 2,
    verify: bool = False,
    with_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row the ids of the whole text, their number and crc32 (little-endian uint32).

    ``verify`` adds ``same_ids`` (equal to the ``sentencepiece`` library's ids) and
    ``round_trip`` (decoding gives the text back).  Null and empty texts have no
    ids.  Null ids stay null, repeated rows give a row each, other columns are
    not read, an empty table gives an empty result.
    """
    fields = "n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids + ", same_ids boolean, round_trip boolean" * verify

    def run(batches):
        codec = _codec(model, threads)
        if verify and model not in _REFERENCE:
            from sentencepiece import SentencePieceProcessor

            _REFERENCE[model] = SentencePieceProcessor(model_file=model)
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                texts = [x or "" for x in batch.column(1).to_pylist()]
                found = codec.encode(texts)
                out = [
                    batch.column(0),
                    pa.array([len(x) // 4 for x, _ in found], pa.int64()),
                    pa.array([zlib.crc32(x) for x, _ in found], pa.int64()),
                ]
                if with_ids:
                    out.append(pa.array([np.frombuffer(x, "<i4") for x, _ in found], pa.list_(pa.int32())))
                if verify:
                    same = _REFERENCE[model].encode(texts, num_threads=threads)
                    out.append(pa.array([x == np.array(y, "<u4").tobytes() for (x, _), y in zip(found, same)], pa.bool_()))
                    out.append(pa.array([x == y for (_, x), y in zip(found, texts)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(out, ["id", *[x.split()[0] for x in fields.split(", ")]])

    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, {fields}")
    return out.withColumnRenamed("id", id_col)


def decode(df: DataFrame, model: str, threads: int = 2, ids_col: str = "ids", to: str = "text") -> DataFrame:
    """``df`` with the text of each row's ids (null ids: null text); other columns stay."""

    @F.pandas_udf("string")
    def texts(ids: pd.Series) -> pd.Series:
        codec = _codec(model, threads)
        got = codec.decode([[] if x is None else [int(i) for i in x] for x in ids])
        return pd.Series([None if x is None else t for x, t in zip(ids, got)], dtype=object)

    return df.withColumn(to, texts(F.col(ids_col)))
