"""The registered query of each operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import (
    byte_bpe, chat_tree, exact_dedup, language, line_dedup, packed_rows, packing, prefix_trie, quality, simhash, topk, toxicity,
    whitening)
from riskframe.llm.vocabulary import vocabulary


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op3_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_rows.packed_rows(_read(spark, sf_dir, "documents"), vocabulary(spark, "word_bpe_49k.json"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_read(spark, sf_dir, "documents"), vocabulary(spark, "piece_bpe_32k.model"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(_read(spark, sf_dir, "documents")).drop("kept", "text_hash")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), vocabulary(spark, "word_bpe_49k.json"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(_read(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents")).drop("text_hash")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary(spark, "byte_bpe_multi_50k.tiktoken")
    rows = byte_bpe.encode(_read(spark, sf_dir, "documents").select("doc_id", "text"), path)
    ids = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    rows = rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.encode(ids, "UTF-8"), 256).alias("ids_sha256"), "ids", "offsets")
    rows = byte_bpe.decode(rows, path)
    return rows.select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    tricky = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return chat_tree.read_back(chat_tree.chat_tree(known.unionByName(tricky), vocabulary(spark, "byte_bpe_multi_50k.tiktoken")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_read(spark, sf_dir, "conversations"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_exact_top_k, op2_toxicity, op3_token_id_output, op4_language_id, op5_quality_classifier,
    op6_simhash_near_dedup, op7_best_fit_packing, op8_line_dedup, op9_exact_dedup, op10_byte_bpe,
    op11_chat_formatting, op12_prefix_trie, op13_embedding_whitening)}

SQL = {
    "op1_exact_top_k": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v, row_number() over () as row
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (
            select q.row, q.vec_id as query_id, c.vec_id as vec_id,
                   list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
            from v q join v c on q.vec_id % 100 = 0 and q.row <> c.row and len(q.v) = len(c.v))
        select query_id, rank, vec_id, score
        from (select *, row_number() over (partition by row order by score desc, vec_id)::int as rank from s)
        where rank <= 10
    """,
    "op9_exact_dedup": r"""
        with t as (select doc_id, coalesce(text, '') as body from documents),
        n as (select doc_id, length(body) as points, regexp_replace(body, '[\x20\x09-\x0D]', '', 'g') as normal from t)
        select doc_id,
               first_value(doc_id) over w as keep_id,
               count(*) over (partition by normal) as group_size,
               doc_id = first_value(doc_id) over w as kept,
               sha256(normal) as text_sha256
        from n window w as (partition by normal order by points desc, doc_id)
    """,
    "op11_chat_formatting": r"""
        with known as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
            union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
            union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        numbered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from known),
        control as (select '[<\[]\\*(?:\|turn\|>|\|end\|>|\|im_start\|>|\|im_end\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)' as p),
        sized as (
            select *, length(text) + len(regexp_extract_all(text, p)) + 16
                      + length(replace(replace(role, '\', '\\'), chr(10), '\n'))
                      + len(regexp_extract_all(replace(replace(role, '\', '\\'), chr(10), '\n'), p)) as formatted
            from numbered, control)
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
               coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
               sum(formatted)::bigint as formatted_chars
        from sized group by conv_id
    """,
    "op12_prefix_trie": r"""
        with t as (
            select conv_id as c, coalesce(role, '') as r, coalesce(text, '') as x,
                   row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as i
            from conversations where conv_id is not null),
        convs as (
            select c, c - c % 20 as b, list_reduce(
                list_transform(string_split(c::varchar, ''), lambda s: ascii(s)::bigint),
                lambda crc, byte: list_reduce(
                    [0::bigint, 0, 0, 0, 0, 0, 0, 0],
                    lambda v, bit: case when v % 2 = 1 then xor(v // 2, 3988292384::bigint) else v // 2 end, xor(crc, byte)),
                4294967295::bigint) as crc
            from t group by c),
        heads as (select c, b, xor(crc, 4294967295::bigint) % 4 as h from convs),
        rebuilt as (
            select heads.c, 0 as part, i, r, x from heads join t on t.c = heads.b and t.i < h
            union all select heads.c, 1, i, r, x from heads join t on t.c = heads.c and t.i >= h),
        lists as (select c, list({'r': r, 'x': x} order by part, i) as turns from rebuilt group by c),
        whole as (select heads.c, coalesce(turns, []) as turns from heads left join lists using (c)),
        prefixes as (
            select c, d, turns[1:d] as p, d = len(turns) as ends from whole, unnest(range(0, len(turns) + 1)) as u(d)),
        nodes as (
            select d, p, min(c) as conv_id, count(*) as n_convs,
                   sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) as ends_sha256,
                   (count(*) - 1) * coalesce(len(regexp_extract_all(p[d].x, '[^\x20\x09-\x0D]+')), 0) as own_saved
            from prefixes group by d, p),
        shaped as (
            select n.*, up.conv_id as parent_conv_id,
                   (select count(*) from nodes k where k.d = n.d + 1 and k.p[1:n.d] = n.p) as n_children
            from nodes n left join nodes up on up.d = n.d - 1 and up.p = n.p[1:n.d - 1]),
        spread as (select p[1:a] as p, n_children = 0 as leaf, own_saved from shaped, unnest(range(0, d + 1)) as u(a)),
        sums as (select p, count(*) filter (leaf) as n_leaves, sum(own_saved)::bigint as saved_tokens from spread group by p)
        select conv_id, d as depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
        from shaped join sums using (p)
    """,
}
