"""Quality rules whose thresholds follow the corpus, per language and source.

Each document gets a few integer ratios.  Their distribution within a language
and source is kept as a quantile sketch: counts in buckets whose width grows
with the value (16 to each doubling), so any quantile is known to about 6 %.
Sketches are merged by adding counts: over tasks, from sources to a language,
and from languages to the corpus.  A fence lies beyond the upper (or lower)
quantile by a multiple of the group's own spread.  Groups below ``least``
documents borrow the language's sketch, and those the corpus's.

Everything is DataFrame expressions.  The thresholds are joined to the
documents on a salted key, so one source may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save

_SPACE = "[ \\t-\\r]+"


Get = Callable[[str], Column]


class Rule(NamedTuple):
    """A ratio (an integer, of counts that a getter names) and how far beyond its quantile it may lie."""

    name: str
    value: Callable[[Get], Column]
    #: at least so much room beyond the quantile, whatever the spread
    slack: int
    upper: bool = True


def _per(part: str, whole: str, scale: int) -> Callable[[Get], Column]:
    def value(c: Get) -> Column:
        return F.when(c(whole) > 0, F.floor(c(part) * scale / c(whole)).cast("long")).otherwise(F.lit(0).cast("long"))

    return value


RULES = (
    Rule("symbol_rate", _per("n_symbols", "n_words", 1000), 150),
    Rule("dup_line_rate", _per("n_dup_lines", "n_lines", 1000), 300),
    Rule("repeat_rate", _per("n_repeat_words", "n_words", 1000), 100),
    Rule("capital_rate", _per("n_capitals", "word_chars", 1000), 200),
    Rule("sign_rate", _per("n_signs", "n_words", 1000), 300),
    Rule("long_word", _per("word_chars", "n_words", 100), 400),
    Rule("short_word", _per("word_chars", "n_words", 100), 200, upper=False),
)


def measures(df: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with the counts of each text (null: an empty text), as longs."""
    text, words, lines, hashes, dups = (f"__tenure_q_{x}" for x in ("text", "words", "lines", "hashes", "dups"))
    df = df.withColumn(text, F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    df = df.withColumn(words, F.filter(F.split(text, _SPACE), lambda w: w != ""))
    df = df.withColumn(lines, F.filter(F.split(text, "\\n"), lambda x: x.rlike("[^ \\t-\\r]")))
    at = lambda k: F.get(F.col(words), k)
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 5), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2), at(i + 3), at(i + 4))
    )
    df = df.withColumn(hashes, F.when(F.size(words) >= 5, windows).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn(
        dups,
        F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            F.sort_array(F.transform(F.col(hashes), lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    # starts of windows that stand beside their like in the sorted array
    same = lambda x, k: F.get(F.col(dups), k)["h"] == x["h"]
    starts = F.transform(
        F.filter(F.col(dups), lambda x, k: F.coalesce(same(x, k - 1), F.lit(False)) | F.coalesce(same(x, k + 1), F.lit(False))),
        lambda x: x["i"],
    )
    covered = F.aggregate(
        F.sort_array(starts),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, s: F.struct((s + 5).alias("end"), (acc["n"] + s + 5 - F.greatest(acc["end"], s)).alias("n")),
    )["n"]
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size(lines),
        "n_capitals": F.length(F.regexp_replace(text, "[^A-ZÀ-ÖØ-Þ]+", "")),
        "n_signs": F.length(F.regexp_replace(text, r"[^!?#*$%&|<>{}\[\]=_~^\\/@]+", "")),
    }
    df = df.withColumns({prefix + k: v.cast("long") for k, v in counts.items()})
    return df.drop(text, words, lines, hashes, dups)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def _bucket(x: Column) -> Column:
    """Below 32 the value itself, above the leading five bits and their place."""
    shift = F.greatest(F.length(F.bin(x)) - 5, F.lit(0))
    return F.when(x < 32, x).otherwise(shift * 16 + F.floor(x / F.pow(F.lit(2.0), shift))).cast("long")


def _bounds(bucket: Column, upper: bool) -> Column:
    """The largest (smallest) value of a bucket."""
    shift = F.floor((bucket - 16) / 16).cast("long")
    width = F.pow(F.lit(2.0), shift).cast("long")
    low = (bucket - shift * 16) * width
    return F.when(bucket < 32, bucket).otherwise(low + width - 1 if upper else low)


def sketches(measured: DataFrame, rules=RULES, by=("lang", "source")) -> DataFrame:
    """Counts by rule, bucket and group; the groups are all prefixes of ``by``.

    ``level`` is the number of columns of ``by`` in the key; the others are null.
    Null is a group of its own (``by`` are texts with a mark before non-nulls).
    """
    values = F.array(*[F.struct(F.lit(r.name).alias("rule"), _bucket(r.value(F.col)).alias("bucket")) for r in rules])
    long = measured.select(*by, F.explode(values).alias("v")).select(*by, "v.rule", "v.bucket")
    out = long.groupBy(*by, "rule", "bucket").agg(F.count("*").alias("n")).withColumn("level", F.lit(len(by)))
    finest = save(out, "quality-sketches")
    found = finest
    for k in range(len(by) - 1, -1, -1):
        merged = finest.groupBy(*by[:k], "rule", "bucket").agg(F.sum("n").alias("n"))
        found = found.unionByName(merged.withColumn("level", F.lit(k)), allowMissingColumns=True)
    return found


def fences(sketch: DataFrame, rules=RULES, by=("lang", "source"), tail: float = 0.9, times: float = 3.0) -> DataFrame:
    """Per group: documents and, per rule, the value beyond which a document fails.

    With quantiles q50 and q(tail), the upper fence is
    ``q(tail) + max(slack, times * (q(tail) - q50))``; the lower one mirrors it.
    Each group has a few hundred buckets, however many documents it holds.
    """
    from pyspark.sql import Window

    keys = ["level", *by]
    w = Window.partitionBy(*keys, "rule").orderBy("bucket")
    whole = Window.partitionBy(*keys, "rule")
    ranked = sketch.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(whole))
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("total") * q, F.col("bucket")))
    per_rule = ranked.groupBy(*keys, "rule").agg(
        F.max("total").alias("total"), at(tail).alias("high"), at(0.5).alias("mid"), at(round(1 - tail, 6)).alias("low")
    )
    cols = []
    for r in rules:
        mid = _bounds(F.col("mid"), r.upper)
        if r.upper:
            top = _bounds(F.col("high"), True)
            fence = top + F.greatest(F.lit(r.slack), F.ceil(times * (top - mid)).cast("long"))
        else:
            bottom = _bounds(F.col("low"), False)
            fence = bottom - F.greatest(F.lit(r.slack), F.ceil(times * (mid - bottom)).cast("long"))
        cols.append(F.max(F.when(F.col("rule") == r.name, fence)).alias(r.name))
    return per_rule.groupBy(*keys).agg(F.max("total").alias("n_docs"), *cols)


def _marked(column: str) -> Column:
    """A text that tells null from any value."""
    c = F.col(f"`{column}`")
    return F.when(c.isNotNull(), F.concat(F.lit("="), c.cast("string"))).otherwise(F.lit("0"))


def _limits(got: DataFrame, least: int) -> DataFrame:
    """``lang, source, f``: the fences that hold for each group of ``got``."""
    by = ("lang", "source")
    passed = got.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    fence = save(fences(sketches(passed)), "quality-fences")
    names = [r.name for r in RULES]
    at = lambda level: fence.where(F.col("level") == level).select(*by[:level], F.struct("n_docs", *names).alias(f"f{level}"))
    groups = got.select(*by).distinct().join(at(2), list(by), "left").join(at(1), "lang", "left")
    enough = lambda level: F.col(f"f{level}.n_docs") >= least
    corpus = fence.where("level = 0").select("n_docs", *names).first()  # one row
    rest = F.struct(*[F.lit(corpus[c] if corpus else None).cast("long").alias(c) for c in ("n_docs", *names)])
    # a group takes the finest sketch that is large enough
    chosen = F.when(enough(2), F.col("f2")).when(enough(1), F.col("f1")).otherwise(rest)
    return groups.select(*by, chosen.alias("f"))


def _verdict(c: Get, limit: str) -> tuple[Column, Column]:
    failed = base_failed(c("n_words"), c("n_repeat_words"))
    beyond = F.lit(False)
    for r in RULES:
        at, value = F.col(f"{limit}.{r.name}"), r.value(c)
        beyond = beyond | F.coalesce(value > at if r.upper else value < at, F.lit(False))
    return failed, ~failed & ~beyond


def _source(df: DataFrame, text_col: str, lang_col: str, source_col: str, *more: Column) -> DataFrame:
    return df.select(*more, _marked(lang_col).alias("lang"), _marked(source_col).alias("source"), F.col(f"`{text_col}`").alias("text"))


def judge(
    df: DataFrame,
    least: int = 200,
    salts: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Per row the counts, ``base_failed`` and ``kept``.

    A row is kept if it passes the base rules and no ratio lies beyond the
    fence of its language and source (of the language, or of all rows, where
    those have fewer than ``least`` rows).  A null language or source is a
    group of its own.  A null text is empty: no words, so not kept.  Null
    ids and repeated rows are judged as they stand; other columns are not
    read; an empty table gives an empty result.
    """
    src = _source(df, text_col, lang_col, source_col, F.col(f"`{id_col}`").alias("id"))
    got = save(measures(src).drop("text"), "quality-measures")
    limits = _limits(got, least).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = got.withColumn("salt", F.pmod(F.xxhash64("id", "n_words", "word_chars", "n_capitals", "n_signs"), F.lit(salts)).cast("int"))
    failed, kept = _verdict(F.col, "f")
    return salted.join(limits, ["lang", "source", "salt"], "left").select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        kept.alias("kept"),
    )


def keep(
    df: DataFrame,
    least: int = 200,
    salts: int = 64,
    most_broadcast: int = 100_000,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """The rows of ``df`` that ``judge`` keeps, with their columns.

    The counts are taken twice, once for the fences and once beside the rows,
    which are never shuffled while there are at most ``most_broadcast`` groups; with
    more, rows and fences meet on a salted key.
    """
    got = save(measures(_source(df, text_col, lang_col, source_col)).drop("text"), "quality-measures")
    limits = save(_limits(got, least), "quality-limits")
    pre = "__tenure_q_"
    limits = limits.select(F.col("lang").alias(pre + "lang"), F.col("source").alias(pre + "source"), F.col("f").alias(pre + "f"))
    rows = measures(df, text_col, pre).withColumns({pre + "lang": _marked(lang_col), pre + "source": _marked(source_col)})
    # a row number keeps the filter above the projections: pushed below them it would
    # take the counts' whole expressions along, once for each use
    rows = rows.withColumn(pre + "row", F.monotonically_increasing_id())
    on = [pre + "lang", pre + "source"]
    if limits.count() <= most_broadcast:
        both = rows.join(F.broadcast(limits), on, "left")
    else:
        salt = F.pmod(F.xxhash64(*[pre + x for x in ("n_words", "word_chars", "n_capitals", "n_signs")]), F.lit(salts)).cast("int")
        limits = limits.withColumn(pre + "salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        both = rows.withColumn(pre + "salt", salt).join(limits, [*on, pre + "salt"], "left")
    _, kept = _verdict(lambda name: F.col(pre + name), pre + "f")
    return both.where(kept & (F.col(pre + "row") >= 0)).select(*[F.col(f"`{c}`") for c in df.columns])
