"""Row-wise operators: quality rules, PII, tokens, packing, classifiers."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from brute import base_spans, quality_counts
from pyspark.sql import functions as F

from tenure.llm import language_id, packing, pii, quality_classifier, quality_rules, sentencepiece_tokens, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, kept string, score string, n_words string"
EDGES = [
    None,
    "",
    " \n\t",
    "a@b.c%x@y.z",
    "x@a..b a@b.c..d@e.f.",
    "1.2.3.4.5.6.7.8 999.1.1.1 0255.0.0.1",
    "4111 1111 1111 1111--4111111111111111 4111-1111-1111-1111-1",
    "+49 (30) 123.456-78 +1 ++12 345 678 90+12345678901",
    "1 2 3 " * 4000,
    "1" * 20000,
    "x@" + "a." * 3000 + "com " + "a@b.co " * 1500,
    "é4111111111111111 DE89 3704 0044 0532 0130 00 iban",
    "the same five words here the same five words here again",
    "line one\nline one\n\n \nline two | & <",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 3 else "en", None if i % 2 else "s", "x", "y", "z") for i, t in enumerate(EDGES)]
    rows += [(None, "no id", None, None, None, None, None), rows[3], rows[3]]
    return spark.createDataFrame(rows, SCHEMA)


def test_quality_counts_equal_brute_force(spark, docs):
    got = quality_rules.judge(docs).collect()
    assert len(got) == len(EDGES) + 3
    for r in got:
        if r.doc_id is not None:
            want = quality_counts(EDGES[r.doc_id])
            assert tuple(r[1:6]) == want
            assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
            assert not (r.base_failed and r.kept)
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_quality_fences_follow_their_group(spark):
    random.seed(3)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(random.randint(3, 8)))
    text = lambda mark: " ".join(word() + mark for _ in range(60))
    rows = [(i, text("|" if i % 2 else ""), "en", "tables" if i % 2 else "prose") for i in range(600)]
    rows += [(1000, text("|"), "en", "prose"), (1001, text("|"), "en", "tables"), (1002, text("|"), None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(df).collect()}
    assert not kept[1000] and kept[1001]
    assert sum(kept[i] for i in range(600)) >= 597
    few = {r.doc_id for r in quality_rules.keep(df).collect()}
    assert few == {i for i, k in kept.items() if k}
    many = quality_rules.keep(df, most_broadcast=0)
    assert many.columns == df.columns and {r.doc_id for r in many.collect()} == few


def test_sketch_buckets_bound_their_values(spark):
    df = spark.range(0, 100000, 7).select("id", quality_rules._bucket(F.col("id")).alias("b"))
    low, high = quality_rules._bounds(F.col("b"), False), quality_rules._bounds(F.col("b"), True)
    assert df.where((low > F.col("id")) | (high < F.col("id")) | (high - low > F.col("id") / 15)).count() == 0


def test_pii_equals_brute_force(spark, docs):
    got = {r.doc_id: r for r in pii.digest(pii.find(docs)).collect()}
    for i, t in enumerate(EDGES):
        counts, sha = base_spans(t)
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == counts
        assert got[i].base_sha256 == sha
    assert got[11].n_iban == 1 and "iban:18:45" in got[11].spans
    assert pii.find(docs.limit(0)).count() == 0


def test_pii_context_and_redaction(spark):
    rows = [(1, "ssn 123-45-6789, " + "x" * 60 + " 123-45-6780"), (2, "mail a@b.co.. now"), (3, None), (4, "plain. text.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert pii.digest(pii.find(df)).where("doc_id = 1").first().n_ssn == 1
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert got[1] == "ssn [SSN], " + "x" * 60 + " 123-45-6780"
    assert got[2] == "mail [EMAIL].. now" and got[3] is None and got[4] == "plain. text."


ALPHABET = ["a", "b", " ", "  ", "\n", "'s", "’", "ll", "the", "é", "日本", "1", "23", "!!", "<|endoftext|>", "\t", "\x1c", "　", "\xa0"]
ALPHABET += ["don't", "I'll", "'ve ", " \n", "\r\n", "👍🏽", "é", "́", "Σ", "İ", "Word.", "word,", "ÉA", "\x85"]


def _random_texts(n, seed):
    pick = random.Random(seed)
    return ["".join(pick.choice(ALPHABET) for _ in range(pick.randint(0, 9))) for _ in range(n)]


def test_prefix_counts_equal_the_library():
    counter = token_counts.PrefixCounter(P.path("byte_bpe_50k.json"))
    for text in _random_texts(250, 1):
        t = counter.table(text)
        counts = [len(counter.tok.encode(text[:p], add_special_tokens=False)) for p in range(len(text) + 1)]
        assert [t.count(p) for p in range(len(text) + 1)] == counts
        for limit in (0, 1, 3):
            assert t.longest(limit) == max(p for p, k in enumerate(counts) if k <= limit)


def test_token_counts_query(spark, docs):
    tok = token_counts.PrefixCounter(P.path("byte_bpe_50k.json")).tok
    got = [r for r in token_counts.count_tokens(docs, P.path("byte_bpe_50k.json")).collect() if r.doc_id is not None]
    assert len(got) == len(EDGES) + 2
    for r in got:
        text = EDGES[r.doc_id] or ""
        n = len(tok.encode(text, add_special_tokens=False))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 512)
    small = docs.where("doc_id in (0, 3)")
    table = {r.doc_id: r.counts for r in token_counts.prefix_counts(small, P.path("byte_bpe_50k.json")).collect()}
    assert table[0] == [0] and len(table[3]) == len(EDGES[3]) + 1


def test_packing_is_exact_and_gapless(spark, docs):
    path = P.path("word_bpe_49k.json")
    tok = packing.Encoder(path).tok
    for text in _random_texts(400, 2):
        assert packing.Encoder.__call__(_encoder(path), text) == _encoder(path).encode(text)
    rows = packing.pack(docs.coalesce(1), path, end_id=2, with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for i, t in enumerate(EDGES):
        want = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        parts = sorted(by_doc[i], key=lambda r: r.start)
        copies = 3 if i == 3 else 1
        assert sum(r.length for r in parts) == copies * len(want) and {r.doc_tokens for r in parts} == {len(want)}
        if copies == 1:
            assert np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in parts]).tolist() == want
            assert [r.start for r in parts] == [sum(x.length for x in parts[:k]) for k in range(len(parts))]
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert packing.pack(docs.limit(0), path, end_id=2).count() == 0


def test_packing_keeps_capitals_before_combining_marks():
    encoder = _encoder(P.path("word_bpe_49k.json"))
    pairs = ["H\u0331", "J\u030c", "T\u0308", "W\u030a", "Y\u030a"]
    texts = [f"{a}{x}{b} The End." for x in pairs for a in ("", "A ", "kA", "\n") for b in ("", "adith", ".", "É", " X")]
    for text in texts:
        assert encoder(text) == encoder.encode(text)


_ENCODERS = {}


def test_packing_signs_after_every_letter():
    path = P.path("word_bpe_49k.json")
    fast = packing.Encoder(path)
    words = [chr(c) for c in range(0x30000) if chr(c).isalpha()]
    for sign in ".,":
        want = fast.tok.encode_batch([w + sign for w in words], add_special_tokens=False)
        bad = [w for w, x in zip(words, want) if fast(w + sign) != b"".join(i.to_bytes(4, "little") for i in x.ids)]
        assert not bad
    for text in ("YEN\u0130.", "a\u0958, b.", "caf\u00e9. na\u00efve, Stra\u00dfe."):
        assert fast(text) == fast.encode(text)


def _encoder(path):
    return _ENCODERS.setdefault(path, None) or _ENCODERS.__setitem__(path, packing.Encoder(path)) or _ENCODERS[path]


def test_differencing_is_near_equal_and_rises():
    sizes = [random.Random(k).randint(1, 1000) for k in range(300)]
    parts = packing.differencing(sizes, 16)
    assert sorted(k for part in parts for k in part) == list(range(300))
    sums = [sum(sizes[k] for k in part) for part in parts]
    assert max(sums) - min(sums) < 0.01 * max(sums)
    assert packing.fill([], 10) == [] and len(packing.fill([6, 6, 6], 10)) == 3


def test_sentencepiece_parity_and_round_trip(spark, docs):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    codec, ref = sentencepiece_tokens.Codec(path, 1), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [t for t in _random_texts(400, 3) if "▁" not in t] + [" " * k + "the" for k in range(40)]
    for text, (ids, back) in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == ref.encode(text)
        assert back == text
    rows = sentencepiece_tokens.encode(docs, path, verify=True)
    assert all(r.same_ids and r.round_trip for r in rows.collect())
    back = {r.doc_id: r.text for r in sentencepiece_tokens.decode(rows.where("doc_id in (0, 5)"), path).collect()}
    assert back == {0: "", 5: EDGES[5]}


def _prose(seed, words, n):
    pick = random.Random(seed)
    return " ".join(pick.choice(words) for _ in range(n))


PLAIN = [a + b for a in ("sun", "riv", "mon", "fel", "gar", "tor", "wil") for b in ("ny", "er", "th", "ing", "den", "ow", "ard", "ost")]


def test_toxicity_separates_and_takes_edge_cases(spark, docs):
    bad = ["wretched", "vile", "hateful", "rotten"]
    make = lambda k, toxic: _prose(k, PLAIN + bad * 3 * toxic, 80)
    model = toxicity.fit([make(k, 1) for k in range(60)], [make(k, 0) for k in range(100, 220)])
    rows = [(k, make(k, k % 2), None) for k in range(1000, 1100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert np.mean([got[k].predicted == k % 2 for k in got]) >= 0.95
    kept = toxicity.keep(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {k for k in got if not got[k].predicted}
    edge = toxicity.score(docs, model).collect()
    assert len(edge) == docs.count() and all(0 <= r.score <= 1 for r in edge)
    nothing = toxicity.fit([], ["a b c"])
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def _taught(spark, texts):
    """A toxicity model of (text, lang, toxic)."""
    rows = [(k, *x) for k, x in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, text string, lang string, toxic int")
    return toxicity.learn(df.select("id", "text", "lang"), df.select("id", "toxic"))


def test_toxicity_keeps_words_of_small_languages(spark):
    bad, rare = ["wretched", "vileness", "hateful", "rottenly"], [f"{x}obriqua" for x in "kzxvjqwp"]
    other = [x[::-1] for x in PLAIN]
    en = lambda k, toxic: _prose(k, PLAIN + bad * 3 * toxic, 60)
    xx = lambda k, toxic: _prose(k, other + [rare[k % 8]] * 12 * toxic, 60)
    texts = [(en(k, k % 3 == 0), "en", int(k % 3 == 0)) for k in range(450)]
    texts += [(xx(k, k % 3 == 0), "xx", int(k % 3 == 0)) for k in range(1000, 1240)]
    model = _taught(spark, texts)
    assert all(x.encode() in model.toxic and x.encode() not in model.ordinary for x in bad + rare)
    df = spark.createDataFrame([(k, xx(k, k % 2)) for k in range(3000, 3080)], "doc_id long, text string")
    assert np.mean([r.predicted == r.doc_id % 2 for r in toxicity.score(df, model).collect()]) >= 0.9


def test_toxicity_sends_the_driver_significant_words_only(spark, monkeypatch):
    """Other words, and the windows in the rows of a sort, stay on the executors."""
    frame, marks, rows = type(spark.range(0)), [], []
    collect, marked = frame.collect, toxicity._marked
    monkeypatch.setattr(frame, "collect", lambda self: rows.extend(found := collect(self)) or found)
    monkeypatch.setattr(toxicity, "_marked", lambda *a: marks.extend(found := marked(*a)) or found)
    bad = ["wretched", "vileness", "hateful", "rottenly"]
    make = lambda k: _prose(k, [*PLAIN, *(f"odd{k}x{i}" for i in range(9)), *bad * 3 * (k % 2)], 60)
    _taught(spark, [(make(k), ("en", "xx")[k % 5 == 0], k % 2) for k in range(120)])
    words = [r.word for r in rows if "word" in r.__fields__]
    assert sorted(words) == sorted(marks[0] + marks[1]) and set(bad) <= set(marks[0])
    assert not any("part" in r.__fields__ for r in rows)


def test_toxicity_learns_from_whole_texts(spark):
    bad = ["wretched", "vileness", "hateful", "rottenly"]
    late = lambda k, toxic: _prose(k, PLAIN, 1700) + " " + _prose(k + 9000, PLAIN + bad * 9 * toxic, 60)
    texts = [(late(k, k % 2), "en", k % 2) for k in range(80)]
    assert all(len(t) > 8192 + 300 for t, _, _ in texts)
    model = _taught(spark, texts)
    df = spark.createDataFrame([(k, late(k, k % 2)) for k in range(3000, 3040)], "doc_id long, text string")
    assert np.mean([r.predicted == r.doc_id % 2 for r in toxicity.score(df, model).collect()]) >= 0.9


def test_toxicity_drops_repeated_passages_not_texts():
    line = " this very line stands below each text here"
    bad = ["wretched", "vileness", "hateful", "rottenly"]
    model = toxicity.fit([_prose(k, PLAIN + bad, 80) + line for k in range(60)], [_prose(k, PLAIN, 80) for k in range(100, 220)])
    assert all(x.encode() in model.toxic for x in bad)
    copied = toxicity.fit([_prose(1, PLAIN + bad, 80)] * 60, [_prose(k, PLAIN, 80) for k in range(100, 220)])
    assert b"wretched" not in copied.toxic


def test_language_by_compression(spark, docs):
    words = {"aa": PLAIN, "bb": [x[::-1] for x in PLAIN]}
    rows = [(k, _prose(k, words[lang], 60).upper() if k % 5 == 0 else _prose(k, words[lang], 60), lang) for k in range(200) for lang in [("aa", "bb")[k % 2]]]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    dictionaries = language_id.learn(df.where("id < 100"))
    got = language_id.identify(df.where("id >= 100"), dictionaries, id_col="id").collect()
    assert all(r.lang_pred == ("aa", "bb")[r.id % 2] for r in got)
    edge = {r.doc_id: r for r in language_id.identify(docs, dictionaries).collect()}
    assert edge[0].lang_pred == edge[1].lang_pred == edge[9].lang_pred == "und" and edge[0].rejected
    assert language_id.identify(docs, {}).where("lang_pred != 'und'").count() == 0
    assert language_id.learn(df.limit(0)) == {}


def test_quality_from_positives_and_unlabelled(spark, docs):
    good = lambda k: _prose(k, PLAIN, 60).capitalize() + "."
    junk = lambda k: " | ".join(_prose(k + j, PLAIN, 1).upper() for j in range(40)) + " !!!"
    model = quality_classifier.fit([good(k) for k in range(300)], [junk(k) if k % 5 == 0 else good(k) for k in range(1000, 1600)])
    df = spark.createDataFrame([(k, junk(k) if k % 2 else good(k)) for k in range(5000, 5100)], "doc_id long, text string")
    got = quality_classifier.score(df, model).collect()
    assert np.mean([r.predicted == 1 - r.doc_id % 2 for r in got]) >= 0.95
    assert 0.5 <= model.prior <= 0.9
    assert all(0 <= r.score <= 1 for r in quality_classifier.score(docs, model).collect())
    assert {r.score for r in quality_classifier.score(docs, quality_classifier.fit([], ["x"])).collect()} == {0.5}


def test_language_needs_letters_and_learns_whole_texts(spark):
    filler = lambda k: " ".join(f"{k}x{j}" for j in range(3000))
    rows = [(k, f"{filler(k)} {_prose(k, PLAIN if k % 2 else [x[::-1] for x in PLAIN], 3000)}", "ab"[k % 2]) for k in range(80)]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    dictionaries = language_id.learn(df)
    assert sorted(dictionaries) == ["a", "b"] and all(0 < len(x) <= 131072 for x in dictionaries.values())
    got = {r.id: r.lang_pred for r in language_id.identify(df, dictionaries, id_col="id").collect()}
    assert all(got[k] == "ab"[k % 2] for k in got)  # the prose lies far beyond the first 2,000 characters
    signs = spark.createDataFrame([(0, "²"), (1, "½ ①"), (2, "Ⅷ"), (3, "12 ²"), (4, "ß")], "doc_id long, text string")
    found = {r.doc_id: r.lang_pred for r in language_id.identify(signs, dictionaries).collect()}
    assert [found[k] for k in range(4)] == ["und"] * 4 and found[4] in "ab"
    same = {"b": b"one two three", "a": b"one two three"}
    assert language_id.identify(signs.where("doc_id = 4"), same).first().lang_pred == "a"  # a tie: the first name
    assert language_id.identify(signs.limit(0), dictionaries).count() == 0


def test_language_dictionary_shares_its_bytes():
    got = language_id._joined(["AB" * 500, "c" * 10, "d" * 900], 300)
    assert len(got) <= 300 and b"cccccccccc" in got and got.count(b"ab") > 60 and got.count(b"d") > 130


def test_quality_learns_from_whole_texts(spark):
    good = lambda k: _prose(k, PLAIN, 4000).capitalize() + "."
    bad = lambda k: _prose(k, PLAIN, 4000).capitalize() + "." + " | $$ %%" * 3000
    rows = [(k, bad(k) if k % 2 else good(k), "x") for k in range(60)]
    docs = spark.createDataFrame([*rows, (None, "x", "x"), (2, None, "x")], "id long, text string, source string")
    labels = spark.createDataFrame([(k, (k + 1) % 2, k) for k in range(0, 60, 3)], "id long, quality int, toxic int")
    model = quality_classifier.learn(docs, labels)
    got = {r.id: r.score for r in quality_classifier.score(docs.where("id > 2"), model, id_col="id").collect()}
    assert min(s for k, s in got.items() if k % 2 == 0) > max(s for k, s in got.items() if k % 2)
    assert quality_classifier.learn(docs.limit(0), labels).edges == [] and quality_classifier.learn(docs, labels.where("quality = 0")).edges == []
    assert quality_classifier.score(docs.limit(0), model, id_col="id").count() == 0


def test_sentencepiece_decodes_what_it_spells(spark):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    codec, ref = sentencepiece_tokens.Codec(path, 1), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", " ", "a", " a", "a ", "a  b", "a   b", "\u2581", "x\u2581y z", "日本 \x01 <s> <0x41> <unk>", "\u0130 é\n\t", "w" * 100 + " v", "one two one  two"]
    for _ in range(2):  # the second time from what is kept
        for text, (ids, back) in zip(texts, codec.encode(texts)):
            ids = np.frombuffer(ids, "<u4").tolist()
            assert ids == ref.encode(text)
            assert back == ref.decode(ids)
