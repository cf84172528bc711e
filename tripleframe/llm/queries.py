"""Queries of the training-data operators and their SQL, for the entry file."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, exact_dedup, images, license_scan, mixing, near_dedup, quality, secret_scan, sharding
from .common import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Shares of tokens by language for the mix, and its largest rate.
TARGETS = {"en": 0.45, "de": 0.2, "fr": 0.2, "es": 0.15}


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 24)


def labelled_languages(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and lang of the documents in the labels table: what the mix's classifier learns from."""
    return docs.select("doc_id", "lang").join(labels.select("doc_id").distinct(), "doc_id")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, labelled_languages(docs, table(spark, sf_dir, "labels")), TARGETS)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], turns.schema)
    formatted = chat.format_chat(chat.canonical_turns(turns.unionByName(more), "conv_id"), "conv_id")
    return chat.read_digests(formatted, "conv_id")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("keep_locator")


def op8_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test tables hold no images; every row of embeddings is drawn as one."""
    return images.image_copies(images.pictures(table(spark, sf_dir, "embeddings")), "vec_id", "media")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.grade(table(spark, sf_dir, "documents"), quality.ratings_of(table(spark, sf_dir, "labels")))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).drop("n_literal")


QUERIES = {f.__name__: f for f in (op1_sharding, op2_mixing, op3_byte_bpe, op4_minhash_near_dedup, op5_license_scan, op6_chat_format, op7_exact_dedup, op8_image_copies, op9_quality, op10_secret_scan)}

_CONTROLS = ("<|start|>", "<|sep|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>")


def _escaped_sql(column: str) -> str:
    out = rf"replace({column}, '\', '\\')"
    for control in _CONTROLS:
        out = rf"replace({out}, '{control}', '{control[0]}\{control[1:]}')"
    return out


ORACLE_SQL = {
    "op4_minhash_near_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s
  FROM words
), items AS (SELECT doc_id, unnest(s) AS x FROM shingled),
sizes AS (SELECT doc_id, len(s) AS n FROM shingled),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)
), ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.r)
SELECT doc_id, n::BIGINT AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id, n""",
    "op6_chat_format": rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length('<|start|>' || {_escaped_sql("role")} || '<|sep|>' || {_escaped_sql("text")} || '<|end|>') + 1) AS formatted_chars
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars FROM g""",
    "op7_exact_dedup": """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id, count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents""",
}
