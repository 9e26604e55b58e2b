"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import chat, decontaminate, html_text, licenses, media, merkle, mixing, prefix_trie, quality, simhash, token_files, toxicity, urls
from corpusflow.llm.common import shared_dir, table
from corpusflow.llm.oracles import MERKLE_SQL, TRIE_SQL
from corpusflow.session import spread


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(spread(table(spark, sf_dir, "documents"))).drop("detections")


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store(spread(table(spark, sf_dir, "documents")))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spread(table(spark, sf_dir, "documents")))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spread(table(spark, sf_dir, "pages")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = chat.MARKS[1] + chat.MARKS[2] + " ok " + chat.MARKS[3]
    rows = ", ".join(f"(-7L, {turn}L, '{role}', '{said}')" for turn, role in enumerate(("user", "assistant")))
    extra = spark.sql(f"select * from values {rows} as t(conv_id, turn, role, text)")
    return chat.format_conversations(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spread(table(spark, sf_dir, "pages")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns_of(table(spark, sf_dir, "conversations"))
    kept = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return prefix_trie.trie(*prefix_trie.branched(turns, F.col("conv_id") - F.col("conv_id") % 5, kept, 8))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    less = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    fields = [less if c == "text" else F.col(c) for c in merkle.FIELDS]
    rows = merkle.fold_both(merkle.manifest(docs, also={"now": merkle.leaf(*fields)}), "now")
    proof = F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256")
    return rows.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_licenses": op2_licenses,
    "op3_media": op3_media,
    "op4_simhash": op4_simhash,
    "op5_html": op5_html,
    "op6_decontaminate": op6_decontaminate,
    "op7_chat": op7_chat,
    "op8_mixing": op8_mixing,
    "op9_quality": op9_quality,
    "op10_urls": op10_urls,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_merkle": op12_merkle,
    "op13_tokens": op13_tokens,
}

_ESCAPED = "(2 * length({0}) - length(regexp_replace({0}, '[\\\\<\\[]', '', 'g')))"
_SAID = chat.MARKS[1] + chat.MARKS[2] + " ok " + chat.MARKS[3]
#: What the default template adds to a turn, by role: the lengths of its marks.
_AROUND = {"user": 16, "assistant": 4, "system": 15}
CHAT_SQL = f"""
  with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select * from (values (-7, 0, 'user', '{_SAID}'), (-7, 1, 'assistant', '{_SAID}')) t(conv_id, turn, role, text)),
  d as (select *, {_ESCAPED.format("text")} + case {" ".join(f"when role = '{k}' then {n}" for k, n in _AROUND.items())} else 25 + {_ESCAPED.format("role")} end as n from c)
  select conv_id, count(*) as n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' order by turn, role, text)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256, cast(sum(n) as bigint) as formatted_chars
  from d group by conv_id"""

#: The other operators train models, hash with functions SQL lacks, or decode formats; tests/llm compares these with brute force.
ORACLE_SQL: dict[str, str] = {"op2_licenses": licenses.oracle_sql(), "op7_chat": CHAT_SQL, "op8_mixing": mixing.oracle_sql(), "op10_urls": urls.oracle_sql(), "op11_prefix_trie": TRIE_SQL, "op12_merkle": MERKLE_SQL}
