"""Registered queries of the training-data operators: each applies its operator, with production parameters, to its whole
table and derives the contract's columns from the operator's own output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listledger.llm import alignment, bpe, chat, decontam, ngram, pii, prefixtrie, quality, secrets, sharding, simhash, toxicity, urlfilter
from listledger.llm.common import documents, fold
from listledger.session import table

ORACLES: dict[str, str] = {}


def op1_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, model = ngram.train_and_score(documents(spark, sf_dir), *ngram.by_fold())
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs))
    spans = F.array_join(F.transform("secrets", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.select("doc_id", "n_candidates", F.size("secrets").cast("bigint").alias("n_secrets"), spans.alias("spans"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.ToxicModel:
    """Learned from all texts of ``documents`` and the labels of the folds 1 to 4 of 5."""
    return toxicity.train(documents(spark, sf_dir), table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(documents(spark, sf_dir).select("doc_id", "text"), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, error=2)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    coded = bpe.decode(bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), path).drop("text"), path)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, backoff=True).select("page_id", "host", "path", "rule", "verdict")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql("select -7L conv_id, id turn, if(id = 0, 'user', 'assistant') role, '</s>[INST] ok [/INST]' text from range(2)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    out = chat.format_chats(rows).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("learned", chat.read_loss(F.col("segments")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "valid",
    )


ORACLES["op10_chat"] = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), told as (
  select *, row_number() over w as k, lag(role, 1, 'start') over w as before, lead(role) over w is null as last,
    length(replace(replace(text, '\', '\\'), '<|', '<\|')) + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + 23 as chars,
    before || '>' || role in ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user') and (not last or role = 'assistant') as ok
  from rows window w as (partition by conv_id order by turn nulls first, role, text)
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
  cast(sum(if(role = 'assistant', length(text), 0)) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by k) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars, bool_and(ok) as valid
from told group by conv_id
"""


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixtrie.numbered_turns(table(spark, sf_dir, "conversations"))
    rebuilt = prefixtrie.spliced(turns, heads=F.crc32(F.col("id").cast("string").cast("binary")) % 9, base=F.col("id") - F.col("id") % 5)
    nodes = prefixtrie.trie_nodes(*rebuilt)
    return nodes.withColumnsRenamed({"id": "conv_id", "parent_id": "parent_conv_id"})


ORACLES["op11_prefix_trie"] = r"""
with own as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as k
  from conversations where conv_id is not null
), ids as (
  select c, count(*) as n, c - c % 5 as base, xor(list_reduce(list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: if(v & 1 = 1, xor(v >> 1, 3988292384), v >> 1)), 4294967295::bigint), 4294967295::bigint) % 9 as h
  from own group by c
), heads as (
  select ids.c, o.k, o.role, o.text from ids join own o on o.c = ids.base and o.k <= ids.h
), taken as (select c, count(*) as n from heads group by c
), turns as (
  select * from heads
  union all select o.c, o.k - ids.h + coalesce(taken.n, 0), o.role, o.text from own o join ids using (c) left join taken using (c) where o.k > ids.h
), prefixes as (
  select c, k, octet_length(encode(text)) as bytes, list(length(role) || ':' || role || text) over (partition by c order by k) as path from turns
  union all select c, 0, 0, [] from ids
), sizes as (select c, max(k) as size from prefixes group by c
), nodes as (
  select path, min(c) as conv_id, max(k) as depth, count(*) as n_convs, max(bytes) as bytes,
    coalesce(string_agg(if(k = size, c::varchar, null), ',' order by c), '') as ends
  from prefixes join sizes using (c) group by path
), kids as (select path[:depth - 1] as path, count(*) as n_children from nodes where depth > 0 group by 1
), full_nodes as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids using (path)
), up as (
  select path[:d] as path, sum((n_convs - 1) * bytes) as saved, sum(if(n_children = 0, 1, 0)) as leaves
  from (select *, unnest(range(0, depth + 1)) as d from full_nodes) group by 1
)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, up.leaves::bigint as n_leaves, up.saved::bigint as saved_tokens, sha256(n.ends) as ends_sha256
from full_nodes n join up on up.path = n.path left join nodes p on n.depth > 0 and p.path = n.path[:n.depth - 1]
"""


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.aligned_documents(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return found.withColumn("groups_sha256", digest).drop("groups")


def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard_rows(documents(spark, sf_dir), shards=16)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {
    "op1_interpolation": op1_interpolation,
    "op6_urls": op6_urls,
    "op9_quality": op9_quality,
    "op10_chat": op10_chat,
    "op2_secrets": op2_secrets,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_simhash": op5_simhash,
    "op7_bpe": op7_bpe,
    "op8_decontaminate": op8_decontaminate,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_alignment": op12_alignment,
    "op13_shards": op13_shards,
}
