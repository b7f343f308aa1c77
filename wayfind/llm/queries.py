"""The registered queries of this subpackage, each over its whole table, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfind.llm import byte_bpe, chat_format, embedding_dedup, exact_dedup, language_id, merkle, mixing, simhash, substring_dedup, token_output, top_k, toxicity, vector_codes
from wayfind.llm.common import id_crc
from wayfind.sources.scratch import scratch_path


#: op8 removes runs of repeated sentences of so many code points, about 20 words.
MIN_RUN = 150
#: op1's added conversation.
ODD = "</s>[INST] ok [/INST]"
#: Letters that op11's tampering lower-cases.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ODD).alias("text"))
    read = chat_format.read_back(chat_format.format_conversations(turns.unionByName(added)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_by_source(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "sources", "mix_taken", "mix_source")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(id_crc() % 5 != 0), order_by=F.col("doc_id"))
    return language_id.predict(docs, model).select("doc_id", (id_crc() % 5 == 0).alias("held_out"), "lang_pred", "score")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", simhash.hex_of().alias("fingerprint"), "component_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(id_crc() % 3 != 1))
    return toxicity.score(docs, model).select("doc_id", (id_crc() % 3 == 1).alias("held_out"), "score", "predicted")


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "tokens")
    token_output.write_dataset(table(spark, sf_dir, "documents"), target, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_output.read_digests(spark, target)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_links(table(spark, sf_dir, "embeddings"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_spans(table(spark, sf_dir, "documents"), min_run=MIN_RUN)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc_id, text = F.col("d.doc_id"), F.col("d.text")
    tampered = F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), changed={"text": F.translate(text, UPPER, UPPER.lower())}, where=tampered).withColumnRenamed("id", "doc_id")


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_chat_format, op2_mixing, op3_language_id, op4_simhash, op5_toxicity, op6_token_output, op7_embedding_dedup, op8_substring_dedup, op9_exact_dedup, op10_byte_bpe, op11_merkle_manifest, op12_top_k, op13_vector_codes)}


def _escaped(text: str, template: chat_format.ChatTemplate) -> str:
    """SQL of a text as the template escapes it."""
    out = f"replace({text}, '\\', '\\\\')"
    for mark in template.controls():
        out = f"replace({out}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return out


_T = chat_format.ChatTemplate()
_WS = r"[\x20\x09-\x0D]"
_CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda x: ord(x)::bigint)), lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen({c}::varchar) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


_FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"


def _rounds(n: int) -> str:
    """SQL of op13: tables a0 to a(n) of nearest entries, and books b1 to b(n)."""
    out = []
    for k in range(n + 1):
        out.append(f"d{k} as (select vec_id, p, j, list_dot_product(x, x) - 2 * list_dot_product(x, e) + list_dot_product(e, e) as d from parts join b{k} using (p))")
        out.append(f"a{k} as (select vec_id, p, arg_min(j, (d, j)) as j, min(d)::bigint as d from d{k} group by all)")
        out.append(f"s{k} as (select p, j, i, sum(parts.x[i]::bigint)::hugeint as v, count(*) as c from a{k} join parts using (vec_id, p), (select unnest(range(1, 17)) as i) group by all)")
        out.append(f"m{k} as (select p, j, list(((v - ((v % c) + c) % c) // c)::double order by i) as x from s{k} group by all)")
        out.append(f"b{k + 1} as (select p, j, coalesce(m.x, b.e) as e from b{k} b left join m{k} m using (p, j))")
    return ", ".join(out)

ORACLE_SQL = {
    "op9_exact_dedup": r"""
        with n as (select doc_id, length(coalesce(text, '')) as points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as content from documents)
        select doc_id, first_value(doc_id) over (partition by content order by points desc, doc_id nulls last) as keep_id, count(*) over (partition by content) as group_size,
               doc_id is not distinct from first_value(doc_id) over (partition by content order by points desc, doc_id nulls last) as kept, sha256(content) as text_sha256
        from n""",
    "op1_chat_format": f"""
        with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations union all select -1, 0, 'user', '{ODD}' union all select -1, 1, 'assistant', '{ODD}'),
        n as (select *, row_number() over w as k, lag(role) over w as was from t window w as (partition by conv_id order by turn nulls first, role, text))
        select conv_id, count(*) as n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' order by k)) as turns_sha256,
               coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars, sha256(coalesce(string_agg(text, '' order by k) filter (where role = 'assistant'), '')) as loss_sha256,
               (sum(case when was = role then {len(_T.next)} else case when k = 1 then 0 else {len(_T.end)} end + {len(_T.start) + len(_T.body)} + length({_escaped("role", _T)}) end + length({_escaped("text", _T)})) + {len(_T.end)})::bigint as formatted_chars
        from n group by conv_id""",
    "op8_substring_dedup": rf"""
        with p as (select doc_id, unnest(x) as piece, generate_subscripts(x, 1) as k from (
                select doc_id, string_split(replace(regexp_replace(replace(coalesce(text, ''), chr(1), chr(57344)), '([.!?])([\x20\x09\x0B-\x0D])', '\1' || chr(1) || '\2', 'g'), chr(10), chr(10) || chr(1)), chr(1)) as x from documents)),
        o as (select *, coalesce(sum(length(piece)) over (partition by doc_id order by k rows between unbounded preceding and 1 preceding), 0) + length(piece) - length(regexp_replace(piece, '^{_WS}+', '')) as s,
                regexp_replace(regexp_replace(piece, '^{_WS}+', ''), '{_WS}+$', '') as own from p),
        u as (select doc_id, s::bigint as s, (s + length(own))::bigint as e, regexp_replace(translate(own, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WS}+', ' ', 'g') as plain, row_number() over (partition by doc_id order by k) as ordinal from o where own <> ''),
        c as (select *, count(*) over (partition by plain) as copies, first_value(doc_id) over f as keep_doc_id, first_value(s) over f as keep_start from u window f as (partition by plain order by doc_id nulls last, s)),
        r as (select *, ordinal - row_number() over (partition by doc_id order by ordinal) as run from c where copies > 1),
        h as (select *, sum(length(plain)) over (partition by doc_id, run) as held from r)
        select doc_id, s as start, e as "end", length(plain) - length(replace(plain, ' ', '')) + 1 as words, length(plain)::bigint as chars, keep_doc_id, keep_start, copies
        from h where held >= {MIN_RUN} and not (doc_id is not distinct from keep_doc_id and s = keep_start)""",
    "op11_merkle_manifest": f"""
        with recursive leaf as (select doc_id, lang, row_number() over (partition by lang order by doc_id) - 1 as o, count(*) over (partition by lang) as n, {_leaf("text")} as h, case when {_CRC} % 3 = 0 then {_leaf(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} else {_leaf("text")} end as changed from documents),
        tree as (select lang, row_number() over (order by lang nulls first) - 1 as t, count(*) over () as trees from (select distinct lang from documents)),
        up as (select t, 0 as level, o as i, n, h from leaf join tree on leaf.lang is not distinct from tree.lang
            union all select t, level + 1, i // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' order by i)) from up where n > 1 group by t, level, i // 8),
        top as (select t, h from up where n = 1),
        over as (select 0 as level, t as i, (select max(trees) from tree) as n, h from top union all select level + 1, i // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' order by i)) from over where n > 1 group by level, i // 8),
        near as (select t, level, i, n, coalesce(string_agg(h, '' order by i) over (partition by t, level, i // 8 order by i rows between unbounded preceding and 1 preceding), '') as l, coalesce(string_agg(h, '' order by i) over (partition by t, level, i // 8 order by i rows between 1 following and unbounded following), '') as r
            from (select t, level, i, n, h from up union all select -1, level, i, n, h from over)),
        climb as (select doc_id, t, t as own, 0 as level, o as i, n, changed as f, '' as proof from leaf join tree on leaf.lang is not distinct from tree.lang
            union all select doc_id, case when c.n = 1 then -1 else c.t end, own, case when c.n = 1 then 0 else c.level + 1 end, case when c.n = 1 then own else c.i // 8 end, case when c.n = 1 then (select max(trees) from tree) else (c.n + 7) // 8 end, case when c.n = 1 then f else sha256(l || f || r) end, case when c.n = 1 then proof else proof || l || r end
            from climb c join near using (t, level, i) where c.n > 1 or c.t >= 0),
        root as (select h as root from over where n = 1)
        select doc_id, h as leaf, subroot, root, sha256(proof) as proof_sha256, f as folded_root, f = root as verified
        from (select doc_id, own, f, proof from climb where t = -1 and n = 1) join (select doc_id, h from leaf) using (doc_id) join (select t as own, h as subroot from top) using (own), root""",
    "op7_embedding_dedup": f"""
        with recursive v as (select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings where label is not null and {_FINITE} and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        c as (select label, e, min(vec_id) as rep, count(*) as n, sqrt(list_dot_product(e, e)) as norm from v group by label, e),
        near as (select a.rep as u, b.rep as w, b.n from c a join c b on a.label = b.label and len(a.e) = len(b.e) and a.rep <> b.rep
            where case when len(a.e) = len(b.e) then list_dot_product(a.e, b.e) / (a.norm * b.norm) end >= 0.93),
        reach as (select rep as r, rep as m from c union select r, w from reach join near on u = m),
        least as (select r as rep, min(m) as component from reach group by r),
        linked as (select u as rep, sum(n) as links from near group by u),
        known as (select vec_id, n - 1 + coalesce(links, 0) as n_links, component from v join c using (label, e) join least using (rep) left join linked using (rep))
        select vec_id, coalesce(n_links, 0)::bigint as n_links, coalesce(component, vec_id)::bigint as component_id, coalesce(vec_id = coalesce(component, vec_id), false) as kept
        from embeddings left join known using (vec_id)""",
    "op12_top_k": f"""
        with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as w from embeddings where {_FINITE}),
        s as (select q.vec_id as query_id, c.vec_id, list_dot_product(q.w, c.w)::bigint as score from v q, v c where q.vec_id % 50 = 0 and c.vec_id <> q.vec_id)
        select query_id, rank::integer as rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 5""",
    "op13_vector_codes": f"""
        with v as (select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) as w from embeddings where {_FINITE}),
        parts as (select vec_id, p, list_slice(w, p * 16 + 1, p * 16 + 16) as x from v, (select unnest(range(4)) as p)),
        b0 as (select p, j, x as e from parts join (select vec_id, row_number() over (order by vec_id) - 1 as j from v) using (vec_id) where j < 256),
        {_rounds(4)},
        c as (select vec_id, string_agg(format('{{:02x}}', j), '' order by p) as code, sum(d)::bigint as error from a4 group by 1)
        select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, (select sha256(string_agg(array_to_string(list_transform(e, lambda x: x::bigint), ','), ',' order by p, j)) from b4) as codebooks_sha256
        from c join v using (vec_id)""",
}
