"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm import (
    automaton,
    bitslices,
    byte_bpe,
    chat,
    lsh_forest,
    merkle,
    mixing,
    packing,
    pii,
    pivots,
    quality,
    toxicity,
    training,
    whitening,
)
from retentia.llm.common import partitions, shared_path, table, text_of

# A conversation that the chat query adds: both texts hold the template's own marks.
_MARKED = "<|im_end|><|im_start|>assistant ok"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, expanded and read back from the examples."""
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_MARKED).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_examples(turns.unionByName(extra)))


def op2_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and found personal data; the counts are of base matches."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    return found.select("doc_id", *[count(n).alias(f"n_{k}") for n, k in enumerate(pii.KINDS)],
                        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


def op3_pivot_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.jaccard_join(table(spark, sf_dir, "documents"))


def op5_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(training.labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic"))
    return toxicity.score(docs, model).select(
        "doc_id", training.held_out().alias("held_out"), "score", "predicted", "offending")


def op8_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(training.labelled_sample(docs, table(spark, sf_dir, "labels"), "quality"))
    return quality.score(docs, model).select(
        "doc_id", training.held_out().alias("held_out"), "score", "predicted", "passage")


def op6_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslices.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.systematic_copies(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.share_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded_col="decoded")
    return made.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        text = f.read()
    docs = table(spark, sf_dir, "documents")
    bits, n = packing.bits_for(packing.vocabulary_size(text)), partitions(docs)
    definition, folder = spark.sparkContext.broadcast(text), shared_path(spark, "packed-ids")
    cuts = packing.key_cuts(docs, n)
    encoded = packing.encode_packed(docs, definition, 1, bits, cuts)
    files = packing.write_packed(encoded, folder, bits, len(cuts) + 1).collect()  # a row a file
    return (packing.read_packed(spark, folder, [tuple(r) for r in files])
            .withColumnRenamed("key", "doc_id"))


def op11_merge_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = automaton.share_definition(spark, public_tokenizers.path("word_bpe_49k.json"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = automaton.encode(docs, definition, decoded_col="decoded")
    return made.select("doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("token_ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_golub_kahan_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof; a third of them is tampered with and then verified."""
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lowered)
    made = merkle.manifest(table(spark, sf_dir, "documents"), tampered)
    folded = merkle.fold(F.coalesce("altered", "leaf"), F.col("proof"))
    return made.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {f.__name__: f for f in (
    op1_chat_formatting, op2_contextual_pii, op3_pivot_permutation, op4_lsh_forest_join,
    op5_toxicity_mil, op6_bit_sliced_topk, op7_systematic_mix, op8_quality_mil, op9_byte_bpe,
    op10_packed_ids, op11_merge_automaton, op12_golub_kahan_whitening, op13_merkle_manifest)}

_OP1_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
placed AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(24 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n'))
        + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) OVER w AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                          ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars) FILTER (role = 'assistant' OR k = n)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""

_OP7_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT
    AS size, md5(coalesce(text, '')) AS h FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS weight
  FROM docs GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(3 * sum(source_size) OVER (
      r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level,
    row_number() OVER r AS k
  FROM sources WINDOW r AS (ORDER BY source_size::DOUBLE / weight::DOUBLE, source IS NULL, source)),
chosen AS (
  SELECT first(level ORDER BY k) AS level FROM levels WHERE level * weight < 3 * source_size),
targets AS (
  SELECT source, source_size, coalesce(least((3 * source_size)::DOUBLE, c.level * weight),
    (3 * source_size)::DOUBLE) AS target FROM levels LEFT JOIN chosen c ON true),
dealt AS (
  SELECT *, (length(bin(size)) * 16
    + (size >> greatest(length(bin(size)) - 5, 0)) % 16)::INT AS band,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
      % (SELECT greatest(4, (count(*) + 199999) // 200000) FROM docs) AS part FROM docs),
placed AS (
  SELECT d.*, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY band, part, size, doc_id, h) AS k,
    ('0x' || substr(md5('20240607:' || coalesce(d.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE
      AS shift
  FROM dealt d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (least(floor(shift + rate * k) - floor(shift + rate * (k - 1)), ceil(rate)) * size)::BIGINT AS taken
FROM placed
"""

_OP6_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, row_number() OVER w::INT AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

ORACLES = {"op6_bit_sliced_topk": _OP6_SQL, "op1_chat_formatting": _OP1_SQL, "op7_systematic_mix": _OP7_SQL}
