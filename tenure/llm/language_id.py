"""Language by compression: the raw-content zstandard dictionary that shortens a text most."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save, slices, without_copies

_LEVEL, _PIECE = 6, 1024


def learn(df: DataFrame, per_language: int = 600, window: int = 48, size: int = 131072) -> dict[str, bytes]:
    """A dictionary of up to ``size`` bytes for each language in ``df`` (id, text, lang).

    It holds, in lower case, one run of ``window`` words from each of at most ``per_language`` documents
    (those of smallest hash).  The run starts anywhere in the whole text, by the id's hash, so
    ends of texts are learnt like starts.  Runs that share six words with an earlier one are left
    out; the others get equal shares of the dictionary.
    """
    rows = df.where("lang is not null and id is not null and length(text) > 0").select("lang", "id", F.xxhash64("id").alias("h")).distinct()
    # first within parts of a language: a language may hold most rows
    rows = rows.withColumn("part", F.pmod("h", F.lit(64)))
    for keys in (["lang", "part"], ["lang"]):
        rows = rows.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy("h", "id"))).where(F.col("k") <= per_language)
    picked = save(rows.select("lang", "id"), "language-sample")  # Spark knows its size when it joins
    found = df.select("id", "lang", "text").where("length(text) > 0").join(picked, ["lang", "id"], "left_semi")
    words = F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ")
    start = F.pmod(F.xxhash64("id", F.lit(1)), F.greatest(F.size("words") - window, F.lit(0)) + 1).cast("int") + 1
    run = F.array_join(F.slice("words", start, F.lit(window)), " ")
    runs = found.withColumn("words", words).groupBy("lang", "id").agg(F.min(run).alias("run"))
    by_language: dict[str, list[str]] = {}
    for r in runs.orderBy("lang", "id").collect():
        by_language.setdefault(r["lang"], []).append(r["run"])
    return {lang: _joined(without_copies(x), size) for lang, x in sorted(by_language.items())}


def _joined(runs: list[str], size: int) -> bytes:
    """The runs one after the other, each cut to an equal share of ``size``; what short ones leave goes to the others."""
    raw = sorted((x.lower().encode("utf-8", "replace") for x in runs), key=len)
    out, left = [], size
    for k, x in enumerate(raw):
        x = x[: max(0, left // (len(raw) - k) - 1)]
        left -= len(x) + 1
        out.append(x)
    return b" ".join(out)


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard as z

        self.names = sorted(dictionaries)
        self.compress = [
            z.ZstdCompressor(
                level=_LEVEL,
                dict_data=z.ZstdCompressionDict(dictionaries[x], dict_type=z.DICT_TYPE_RAWCONTENT),
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            ).compress
            for x in self.names
        ]

    def __call__(self, text: str) -> tuple[str, float, float]:
        """Language, score and margin (the next smallest length's excess)."""
        if not self.names or not any(map(str.isalpha, text)):
            return "und", 0.0, 0.0
        raw = text.lower().encode("utf-8", "replace")
        pieces = [raw[k : k + _PIECE] for k in range(0, len(raw), _PIECE)]
        lengths = [sum(len(c(p)) for p in pieces) for c in self.compress]
        best = int(np.argmin(lengths))
        others = [x for k, x in enumerate(lengths) if k != best]
        margin = (min(others) - lengths[best]) / min(others) if others else 1.0
        return self.names[best], margin / (margin + 0.02) if margin else 0.0, margin


_CLASSIFIERS: dict[int, Classifier] = {}


def identify(
    df: DataFrame, dictionaries: dict[str, bytes], least_margin: float = 0.005, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row ``lang_pred``, ``score`` (0 to 1, by the margin) and ``rejected``.

    The whole text is encoded with every dictionary, in pieces, so that the end of a long
    text counts like its start; equal lengths go to the name that sorts first.  ``rejected``
    marks narrow margins, where the smallest length says little.  Null texts and texts
    without a letter (Unicode category L; numerals such as ² are none) are ``und`` with score 0, and rejected.  Null ids stay null, repeated rows give a
    row each, other columns are not read, an empty table gives an empty result.
    """
    key = hash(tuple(sorted(dictionaries.items())))

    def run(batches):
        if key not in _CLASSIFIERS:
            _CLASSIFIERS.clear()
            _CLASSIFIERS[key] = Classifier(dictionaries)
        one = _CLASSIFIERS[key]
        for whole in batches:
            for batch in slices(whole, "text"):
                got = [one(x or "") for x in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([x[0] for x in got], pa.string()),
                        pa.array([x[1] for x in got], pa.float64()),
                        pa.array([x[2] < least_margin for x in got], pa.bool_()),
                    ],
                    ["id", "lang_pred", "score", "rejected"],
                )

    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("id", id_col)
