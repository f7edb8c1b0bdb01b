"""Toxic text by compression distance.

Two zstandard dictionaries share what zstandard's trainer finds in ordinary and
unlabelled text; each adds every word that is significantly more frequent in its
class.  Words are compared within their language, and a repeated passage counts
once.  A window of words is compressed with both, and the difference of the
lengths says which class it is nearer to; windows without such words differ by
nothing.  A text's score weighs its windows' differences against thresholds
calibrated on labelled texts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import logistic, sample_ids, save, slices

_LEVEL, _WORDS, _LONGEST = 9, 12, 512
_RUN, _SAMPLES, _SIGNS = 6, 100_000, ".,;:!?\"'()"
#: Least likelihood ratio statistic of a class's word: one in a thousand at one degree of freedom.
_SIGNIFICANT = 10.83


class Model(NamedTuple):
    toxic: bytes
    ordinary: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    share: float  # of toxic texts in the sample: the score where nothing can be compared


def windows(text: str) -> list[bytes]:
    """Runs of words as bytes, long ones cut; every byte of every word lies in one."""
    words = text.lower().split()
    out = []
    for i in range(0, len(words), _WORDS):
        part = f" {' '.join(words[i : i + _WORDS])} ".encode("utf-8", "replace")
        out += [part] if len(part) <= _LONGEST else [part[k : k + _LONGEST] for k in range(0, len(part), _LONGEST)]
    return out


class Scorer:
    def __init__(self, toxic: bytes, ordinary: bytes):
        import zstandard as z

        made = lambda x: z.ZstdCompressor(
            level=_LEVEL,
            dict_data=z.ZstdCompressionDict(x, dict_type=z.DICT_TYPE_RAWCONTENT),
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        self.toxic, self.ordinary = made(toxic).compress, made(ordinary).compress

    def features(self, text: str) -> list[float]:
        """What the windows' differences (ordinary minus toxic length) look like."""
        toxic, ordinary = self.toxic, self.ordinary
        d = np.array([len(ordinary(x)) - len(toxic(x)) for x in windows(text)] or [0.0], float)
        n = math.log(len(d))
        at = [(d >= k).mean() for k in (2, 3, 4, 6)]
        return [d.mean(), *at, min(d.max(), 12.0), min((d >= 4).sum(), 8), n, at[1] * n]


def _runs(text: str) -> Iterator[tuple[str, str]]:
    """Each word with the run of words that starts at it (at the end of the text, the last run)."""
    words = text.lower().split()
    last = max(0, len(words) - _RUN)
    for i, w in enumerate(words):
        k = min(i, last)
        yield w, " ".join(words[k : k + _RUN])


def _marked(counts: dict[str, dict[str, tuple[int, int]]], sizes: dict[str, tuple[int, int]]) -> tuple[list[str], list[str]]:
    """Toxic and ordinary words, the strongest last.

    ``counts``: texts of both classes by word and language; ``sizes``: all texts
    of both classes by language.  Texts with the word are expected to fall on the classes as
    all texts of their language do; languages where only one class is labelled say nothing.
    """
    strength: tuple[dict, dict] = {}, {}
    for word, by_lang in counts.items():
        both = [0, 0]
        expected = 0.0
        for lang, found in by_lang.items():
            n = sizes[lang]
            if min(n) > 0:
                both = [both[0] + found[0], both[1] + found[1]]
                expected += sum(found) * n[0] / sum(n)
        total = sum(both)
        g = 2 * sum(k * math.log(k / e) for k, e in zip(both, (expected, total - expected)) if k)
        if g >= _SIGNIFICANT:
            strength[both[0] < expected][word] = g
    toxic, ordinary = (sorted(x, key=lambda w: (x[w], w)) for x in strength)
    return toxic, ordinary


def _contents(marks: tuple[list[str], list[str]], samples: list[bytes], base_size: int) -> tuple[bytes, bytes]:
    """Both dictionaries' bytes, of one length: what they share lies equally far from a text."""
    import zstandard as z

    try:
        base = z.train_dictionary(base_size, samples).as_bytes()
    except z.ZstdError:  # too few samples to train on: their text itself
        base = b"".join(samples)[-base_size:]
    words = ["".join(f" {w} " for w in x).encode("utf-8", "replace") for x in marks]
    if not words[0]:
        return base, base
    size = max(map(len, words))
    return words[0].rjust(size, b"\xff") + base, words[1].rjust(size, b"\xff") + base


def _calibrated(contents: tuple[bytes, bytes], x: np.ndarray, y: np.ndarray) -> Model:
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    return Model(*contents, mean, scale, logistic((x - mean) / scale, y), float(y.mean()))


def _untaught(toxic: int, ordinary: int) -> Model:
    none = np.zeros(10)
    return Model(b"", b"", none, none, none, toxic / max(1, toxic + ordinary))


def fit(toxic: list[str], ordinary: list[str], background: list[str] = [], base_size: int = 65536, langs: list | None = None) -> Model:  # noqa: B006
    """Train both dictionaries and calibrate on the same labelled texts.

    ``background`` is unlabelled text that adds to what both dictionaries share;
    ``langs`` are the languages of the toxic and then of the ordinary texts.
    """
    if not toxic or not ordinary:
        return _untaught(len(toxic), len(ordinary))
    texts = [*toxic, *ordinary]
    langs = langs or [""] * len(texts)
    seen, found, owners = set(), set(), set()
    for k, (text, lang) in enumerate(zip(texts, langs)):
        side = int(k >= len(toxic))
        for word, run in _runs(text):
            if (side, lang, word, run) not in seen:
                seen.add((side, lang, word, run))
                found.add((side, lang, word, k))
                owners.add((side, lang, k))
    sizes = Counter((side, lang) for side, lang, _ in owners)
    tally = Counter((side, lang, word) for side, lang, word, _ in found)
    counts: dict = {}
    for _, lang, word in tally:
        counts.setdefault(word, {})[lang] = (tally[0, lang, word], tally[1, lang, word])
    marks = _marked(counts, {lang: (sizes[0, lang], sizes[1, lang]) for lang in set(langs)})
    samples = list(dict.fromkeys(x for t in [*ordinary, *background] for x in _shared(t, set(marks[0]))))[:_SAMPLES]
    contents = _contents(marks, samples, base_size)
    scorer = Scorer(*contents)
    y = np.array([1.0] * len(toxic) + [0.0] * len(ordinary))
    return _calibrated(contents, np.array([scorer.features(t) for t in texts]), y)


def _occurrences(batches):
    """Of (id, toxic, lang, text): a row for each word, with its run."""
    for batch in batches:
        ids, toxic, langs, texts = batch.columns
        at, words, runs = [], [], []

        def rows():
            i = pa.array(at, pa.int64())
            return pa.RecordBatch.from_arrays(
                [ids.take(i), toxic.take(i), langs.take(i), pa.array(words, pa.string()), pa.array(runs, pa.string())],
                ["id", "toxic", "lang", "word", "run"],
            )

        for k, text in enumerate(texts):
            for word, run in _runs(text.as_py()):
                at.append(k)
                words.append(word)
                runs.append(run)
                if len(at) >= 50_000:
                    yield rows()
                    at, words, runs = [], [], []
        if at:
            yield rows()


def _shared(text: str, toxic: set[str]) -> list[bytes]:
    """The windows without a toxic word, which would teach it to both dictionaries."""
    return [x for x in windows(text) if toxic.isdisjoint(w for y in x.decode("utf-8", "replace").split() for w in (y, y.strip(_SIGNS)))]


def _telling(found: DataFrame, sizes: dict[str, tuple[int, int]]) -> DataFrame:
    """Of the words in ``found`` (toxic, lang, word, id) those that ``_marked`` may keep: ``word, by`` (lang, a, b).

    Its statistic is taken on the executors first, with some room for rounding.
    """
    shares = [(lang, n[0] / sum(n)) for lang, n in sizes.items() if min(n) > 0]
    by_lang = F.broadcast(found.sparkSession.createDataFrame(shares, "lang string, share double"))
    counts = found.groupBy("word", "lang").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    words = counts.join(by_lang, "lang").groupBy("word").agg(
        F.collect_list(F.struct("lang", "a", "b")).alias("by"),
        F.sum("a").alias("a"),
        F.sum("b").alias("b"),
        F.sum((F.col("a") + F.col("b")) * F.col("share")).alias("e"),
    )
    part = lambda k, e: F.when(k > 0, k * F.log(k / e)).otherwise(0.0)
    a, b, e = F.col("a"), F.col("b"), F.col("e")
    return words.where(2 * (part(a, e) + part(b, a + b - e)) >= _SIGNIFICANT - 1e-6).select("word", "by")


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 3000, base_size: int = 65536) -> Model:
    """Fit on at most ``per_class`` labelled texts of each class, read whole on the executors.

    ``docs``: id, text and, where known, lang; as many of them, not labelled toxic, serve as background.  ``labels``: id, toxic
    (0 or 1; other values and nulls are left out).  The driver gets counts of significant words, at most
    100,000 windows and a few numbers for each labelled text.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    texts = docs.select("id", F.struct(F.coalesce("text", F.lit("")).alias("text"), lang.alias("lang")).alias("doc"))
    bad = labels.where("toxic = 1").select("id")
    ids = sample_ids(docs.join(bad, "id", "left_anti"), per_class, salt=1).withColumn("toxic", F.lit(-1))
    for k in (0, 1):
        ids = ids.union(sample_ids(labels.where(F.col("toxic") == k), per_class).withColumn("toxic", F.lit(k)))
    parts = docs.sparkSession.sparkContext.defaultParallelism
    picked = texts.join(F.broadcast(ids), "id").repartition(parts, "id", "toxic").groupBy("id", "toxic").agg(F.min("doc").alias("doc"))
    sample = save(picked.select("id", "toxic", "doc.lang", "doc.text"), "toxicity-sample")
    labelled = sample.where("toxic >= 0")

    kind = sample.schema["id"].dataType.simpleString()
    fields = f"id {kind}, toxic int, lang string, word string, run string"
    owned = labelled.mapInArrow(_occurrences, fields).groupBy("toxic", "lang", "word", F.xxhash64("run").alias("run")).agg(F.min("id").alias("id"))
    found = save(owned.select("toxic", "lang", "word", "id").distinct(), "toxicity-words")
    sizes: dict = {}
    for r in found.select("toxic", "lang", "id").distinct().groupBy("lang").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).collect():
        sizes[r["lang"]] = (r["a"], r["b"])
    classes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    if len(classes) < 2:
        return _untaught(classes.get(1, 0), classes.get(0, 0))
    counts = {r["word"]: {x["lang"]: (x["a"], x["b"]) for x in r["by"]} for r in _telling(found, sizes).collect()}
    marks = _marked(counts, sizes)

    def shared(batches):
        toxic = set(marks[0])
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(_shared(text.as_py(), toxic), pa.binary())], ["part"])

    samples = sample.where("toxic <= 0").select("text").mapInArrow(shared, "part binary").distinct()
    # cut to the bound on executors: the driver would else gather each task's first windows to choose from
    order = [F.xxhash64("part").alias("h"), F.col("part")]
    drawn = save(samples.select(*order).orderBy("h", "part").limit(_SAMPLES), "toxicity-windows").toArrow()
    samples = drawn.sort_by([("h", "ascending"), ("part", "ascending")])["part"].to_pylist()
    contents = _contents(marks, samples, base_size)

    def measured(batches):
        scorer = Scorer(*contents)
        for batch in batches:
            x = [scorer.features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["toxic", "x"])

    got = sorted((r["toxic"], r["x"]) for r in labelled.select("toxic", "text").mapInArrow(measured, "toxic int, x array<double>").collect())
    return _calibrated(contents, np.array([x for _, x in got]), np.array([float(y) for y, _ in got]))


_SCORERS: dict[int, Scorer] = {}


def _scores(model: Model):
    key = hash((model.toxic, model.ordinary))

    def run(texts: list[str]) -> np.ndarray:
        if not model.toxic:
            return np.full(len(texts), model.share)
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(model.toxic, model.ordinary)
        x = np.array([_SCORERS[key].features(t) for t in texts])
        g = (x - model.mean) / model.scale @ model.weights[:-1] + model.weights[-1]
        return 1 / (1 + np.exp(-np.clip(g, -30, 30)))

    return run


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on), over all windows of the whole text.

    Null and empty texts score like a text without any sign of toxicity;
    without labels of both classes every score is the share of toxic labels.  Null ids stay
    null, repeated rows give a row each, an empty table gives an empty result.
    Other columns are not read.
    """
    one = _scores(model)

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                s = one([x or "" for x in batch.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], ["id", "score", "predicted"]
                )

    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, score double, predicted int")
    return out.withColumnRenamed("id", id_col)


def keep(df: DataFrame, model: Model, below: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text scores below ``below``, with their columns."""
    one = _scores(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(one([x or "" for x in texts]) if len(texts) else [], dtype=float)

    return df.where(scored(F.col(f"`{text_col}`")) < below)
