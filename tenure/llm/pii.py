"""Personal data spans: patterns propose, checksums confirm, context scores.

Everything is DataFrame expressions.  A text is split by a pattern and its
matches are extracted by the same pattern; the lengths of both give the
positions (code points).  The patterns are written so that the matcher neither
recurses with the text's length nor tries the same run twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: In the order in which kinds at one position are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

# A dot that no label follows becomes a mark first, so that a host is one run of
# label characters and dots, each dot between labels.
_MARK, _STANDIN = "﷐", "﷑"
_PATTERNS = {
    "email": rf"(?:\G|(?<![A-Za-z0-9._%+{_MARK}-]))[A-Za-z0-9._%+{_MARK}-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # whole runs only: other counts of digits fail anyway
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A text without this holds no match of the kind.
_NEEDS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][ -]?[0-9]"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
    "ssn": lambda t: t.rlike(r"-[0-9]{2}-"),
}
#: Score of a confirmed match before its context is read; accepted from 0.5.
_START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
_CONTEXT = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|address|server|host|adresse",
    "card": "card|visa|mastercard|credit|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|fax|telefon|telefono",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "ssn": "ssn|social security|tax",
}
_M, _P, _L, _B, _O = (f"__tenure_pii_{x}" for x in "mplbo")
_NEAR, _RAISE, _LEAST, _BLOCK = 40, 0.3, 0.5, 512


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    digits = F.reverse(_digits(m))

    def add(total, i):
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _mod97(m: Column) -> Column:
    flat = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substr(flat, F.lit(5)), F.substr(flat, F.lit(1), F.lit(4)))

    def step(rest, i):
        c = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(c < 65, (rest * 10 + c - 48) % 97).otherwise((rest * 100 + c - 55) % 97)

    n = F.length(turned)
    return n.between(15, 34) & (F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) == 1)


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})(?:\.|$)){4}$")
    if kind == "card":
        return _luhn(m)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        return _mod97(m)
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _source(kind: str, text: Column) -> Column:
    if kind != "email":
        return text
    return F.regexp_replace(F.translate(text, _MARK, _STANDIN), r"\.(?![A-Za-z0-9-])", _MARK)


def _split(df: DataFrame, kind: str, text: Column) -> DataFrame:
    """Adds the kind's matches and the parts of the text around them (one more)."""
    src, has = _source(kind, text), _NEEDS[kind](text)
    none = F.array().cast("array<string>")
    return df.withColumns(
        {
            _M: F.when(has, F.regexp_extract_all(src, F.lit(_PATTERNS[kind]), F.lit(0))).otherwise(none),
            _P: F.when(has, F.split(src, _PATTERNS[kind], -1)).otherwise(none),
        }
    )


def _score(kind: str, before: Column, after: Column) -> Column:
    near = F.concat_ws(" ", F.right(before, F.lit(_NEAR)), F.left(after, F.lit(_NEAR))).rlike(rf"(?i)\b(?:{_CONTEXT[kind]})\b")
    return F.when(near, F.lit(min(1.0, _START[kind] + _RAISE))).otherwise(F.lit(_START[kind]))


def _with_kind(df: DataFrame, kind: str, text: str, out: str) -> DataFrame:
    """Column ``out``: the kind's accepted spans, by position.

    Positions are sums of lengths; they are taken within blocks of matches
    first and over the blocks then, so many matches cost no quadratic time.
    """
    df = _split(df, kind, F.col(text))
    at = F.sequence(F.lit(0), F.size(_M) - 1)
    # length of what lies before each match since the last one, and of the match
    df = df.withColumn(
        _L,
        F.when(F.size(_M) > 0, F.transform(at, lambda i: F.struct(F.length(F.get(F.col(_P), i)).alias("gap"), F.length(F.get(F.col(_M), i)).alias("size"), i.alias("i")))),
    )
    empty = F.array().cast("array<struct<s:int,e:int,i:int>>")

    def place(acc, x):
        s = acc["pos"] + x["gap"]
        return F.struct((s + x["size"]).alias("pos"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), (s + x["size"]).alias("e"), x["i"].alias("i")))).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), empty.alias("out"))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(_L) - 1) / _BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(F.col(_L), b * _BLOCK + 1, F.lit(_BLOCK)), start, place),
    )
    df = df.withColumn(_B, F.when(F.size(_M) > 0, blocks))
    offsets = F.aggregate(
        F.col(_B), F.array(F.lit(0)), lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + b["pos"]))
    )
    df = df.withColumn(_O, F.when(F.size(_M) > 0, offsets))
    flat = F.flatten(
        F.transform(F.col(_B), lambda b, k: F.transform(b["out"], lambda x: F.struct((x["s"] + F.get(F.col(_O), k)).alias("s"), (x["e"] + F.get(F.col(_O), k)).alias("e"), x["i"].alias("i"))))
    )

    def span(x):
        score = _score(kind, F.get(F.col(_P), x["i"]), F.get(F.col(_P), x["i"] + 1))
        return F.struct(
            x["s"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            x["e"].alias("end"),
            F.lit(kind).alias("kind"),
            score.alias("score"),
            F.get(F.col(_M), x["i"]).alias("match"),
        )

    accepted = F.filter(F.transform(flat, span), lambda x: (x["score"] >= _LEAST) & _valid(kind, x["match"]))
    slim = F.transform(accepted, lambda x: x.dropFields("match"))
    nothing = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,score:double>>")
    return df.withColumn(out, F.coalesce(F.when(F.size(_M) > 0, slim), nothing)).drop(_M, _P, _L, _B, _O)


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``spans``: array of (start, rank, end, kind, score), by start, then kind.

    Null and empty texts have no spans.  Null ids stay null, repeated rows
    give a row each, other columns are not read, an empty table gives an
    empty result.  Whole texts are searched.  Kinds may overlap each other.
    """
    df = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    for kind in KINDS:
        df = _with_kind(df, kind, "t", f"s_{kind}")
    spans = F.sort_array(F.concat(*[F.col(f"s_{k}") for k in KINDS]))
    return df.select(F.col("id").alias(id_col), spans.alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by kind, the hash of the base kinds' spans and all spans as text."""
    base = F.filter(F.col("spans"), lambda x: x["rank"] < len(BASE_KINDS))
    count = lambda k: F.size(F.filter(F.col("spans"), lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        id_col,
        *[count(k) for k in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        *[count(k) for k in KINDS[len(BASE_KINDS) :]],
    )


def _replaced(kind: str):
    """Of (p: part, m: match after it, q: next part): the part and the match or its kind."""

    def put(x):
        ok = x["m"].isNotNull() & (_score(kind, x["p"], x["q"]) >= _LEAST) & _valid(kind, x["m"])
        return F.concat(x["p"], F.when(ok, F.lit(f"[{kind.upper()}]")).otherwise(F.coalesce(x["m"], F.lit(""))))

    return put


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with each accepted match replaced by its kind in brackets, kind after kind.

    Null texts stay null; all rows and columns stay.  What overlaps a match of
    an earlier kind is searched in what that kind left of the text.  (The
    noncharacters U+FDD0 and U+FDD1 may change places in a text with matches.)
    """
    text = F.col(f"`{text_col}`")
    for kind in KINDS:
        df = _split(df, kind, text)

        zipped = F.arrays_zip(F.col(_P).alias("p"), F.col(_M).alias("m"), F.slice(F.col(_P), 2, F.size(_P)).alias("q"))
        whole = F.array_join(F.transform(zipped, _replaced(kind)), "")
        if kind == "email":
            whole = F.translate(whole, _MARK + _STANDIN, "." + _MARK)
        df = df.withColumn(text_col, F.when(F.size(_M) > 0, whole).otherwise(text)).drop(_M, _P)
    return df
