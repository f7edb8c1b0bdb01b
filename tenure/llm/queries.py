"""Registered queries of the training-data operators: ``op<N>_<name>``.

Each reads its whole table and returns its full result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, conversation_repair, embedding_dedup, hard_negatives, language_id, near_dedup, packing, pii, quality_classifier, quality_rules, sentencepiece_tokens, token_counts, toxicity
from .common import held_out, table


def _tokenizer(name: str) -> str:
    """Place of a public vocabulary file (installed on every executor)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def _learnable(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents that may be learnt from, as id and ``columns``."""
    docs = table(spark, sf_dir, "documents").where(~held_out())
    return docs.select(F.col("doc_id").alias("id"), *columns)


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where(~held_out()).select(F.col("doc_id").alias("id"), "quality", "toxic")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = toxicity.learn(_learnable(spark, sf_dir, "text", "lang"), _labels(spark, sf_dir))
    scored = toxicity.score(table(spark, sf_dir, "documents"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    dictionaries = language_id.learn(_learnable(spark, sf_dir, "text", "lang"))
    found = language_id.identify(table(spark, sf_dir, "documents"), dictionaries)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = quality_classifier.learn(_learnable(spark, sf_dir, "text"), _labels(spark, sf_dir))
    scored = quality_classifier.score(table(spark, sf_dir, "documents"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4).drop("key")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_tokens.encode(
        table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"), verify=True, with_ids=False
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=2)


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = dict(told.dtypes)
    odd = spark.range(2).select(
        F.lit(-7).cast(kinds["conv_id"]).alias("conv_id"),
        F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat_format.digest(chat_format.format_chat(told.unionByName(odd)))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations")
    return conversation_repair.digest(conversation_repair.repair(conversation_repair.damaged(told)), told)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    mixed = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(mixed, F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_toxicity": op2_toxicity,
    "op3_language_id": op3_language_id,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_pii": op7_pii,
    "op8_packing": op8_packing,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_chat_formatting": op11_chat_formatting,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_hard_negatives": op13_hard_negatives,
}

#: Smallest id reachable over ``links(a, b)`` (both directions) from ``nodes(id)``.
_REACH = """
    reach(id, other) as (
        select id, id from nodes
        union
        select r.id, l.b from reach r join links l on l.a = r.other
    ),
    roots as (select id, min(other) as component_id from reach group by id)
"""

ORACLE: dict[str, str] = {
    "op5_minhash_near_dedup": f"""
    with recursive words as (
        select doc_id as id, list_filter(
            string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
            lambda x: x <> '') as w
        from documents
    ),
    nodes as (
        select id, case when len(w) >= 4 then list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                        when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s
        from words
    ),
    shingles as (select id, len(s) as n, unnest(s) as x from nodes),
    links as (
        select a.id as a, b.id as b from shingles a join shingles b on a.x = b.x and a.id <> b.id
        group by a.id, b.id having 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
    ),
    {_REACH}
    select id as doc_id, len(s)::bigint as n_shingles, component_id, id = component_id as kept from nodes join roots using (id)
    """,
    "op9_embedding_near_dedup": f"""
    with recursive good as (
        select vec_id as id, embedding::double[] as v from embeddings
        where embedding is not null and len(embedding) > 0
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    nodes as (select vec_id as id from embeddings),
    links as (
        select a.id as a, b.id as b from good a join good b on a.id <> b.id and len(a.v) = len(b.v)
        where list_cosine_similarity(a.v, b.v) >= 0.95
    ),
    counts as (select a as id, count(*) as n_links from links group by a),
    {_REACH}
    select id as vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, id = component_id as kept
    from nodes join roots using (id) left join counts using (id)
    """,
    "op11_chat_formatting": r"""
    with told as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all
        select -7, x.turn, x.role, '</s>[INST] ok [/INST]' from (values (0, 'user'), (1, 'assistant')) x(turn, role)
    ),
    marked as (
        select *, length(regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?SYS\]|ANS\]|/?ROLE\]|/TURN\]|NEXT\]|/?s>)', '\1\\\2\3', 'g')) as n,
            lag(role) over (partition by conv_id order by turn nulls first, role, text) as before
        from told
    )
    select conv_id, count(*)::bigint as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
        coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
        (3 + sum(n + case when role = before then 6 when role = 'system' then 11 when role = 'user' then 13
                          when role = 'assistant' then 9 else 20 + length(role) end))::bigint as formatted_chars
    from marked group by conv_id
    """,
    "op13_hard_negatives": """
    with part as (
        select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * x::double)) as v
        from embeddings
        where vec_id is not null and label is not null and embedding is not null
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ),
    scores as (
        select a.id as anchor, b.id as id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
        from part a join part b on a.id <> b.id and len(a.v) = len(b.v) where a.id % 50 = 0
    ),
    positives as (
        select anchor, id as positive, score as p from scores where same
        qualify row_number() over (partition by anchor order by score desc, id) <= 5
    ),
    ranked as (
        select anchor, positive, p, s.id as id, score, row_number() over (partition by anchor, positive order by score desc, s.id) as rank
        from positives join scores s using (anchor) where not same and 50 * p <= 100 * score and 100 * score <= 95 * p
    )
    select anchor as anchor_id, positive as positive_id, rank::int as rank, id as negative_id, p as positive_score, score as negative_score
    from ranked where rank <= 3
    """,
}
