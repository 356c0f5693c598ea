"""The stages of the corpus pipeline: each applies one operator's decisions to documents
and, but for the last, gives back the columns of documents.

Defined results, of every stage: null texts count as empty and stay null; an empty table gives an empty
one; very long texts are read whole; columns beyond those of documents are kept, whatever
their names, but for those that ``encode_bytes`` makes, which it replaces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm import byte_bpe, lsh_forest, mixing, pii, toxicity, training
from retentia.llm.common import distilled, table, text_of, written


def packed(docs: DataFrame) -> DataFrame:
    """The text and, in one column ``doc``, all others: no name of theirs can meet an operator's."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias("doc"), "text")


def unpacked(columns: list[str]) -> list[Column]:
    """The columns of a packed table again, in their order."""
    return [F.col("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in columns]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-or of their sentences calls toxic go; all others stay."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(training.labelled_sample(docs, labels, "toxic"))
    return toxicity.score(packed(docs), model).filter("predicted = 0").select(*unpacked(docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays, that with the smallest doc_id. Rows go
    by id and text, so another text under the same id stays; of rows with the same id and the same text
    the first by their other columns stays. Rows with a null id stay."""
    gone = distilled(spark, lambda: lsh_forest.decided(docs).filter(~F.col("kept") & F.col("cls").isNotNull())
                     .select(F.col("doc_id").alias("id"), "cls").distinct(), "near-copies")
    keyed = packed(docs).select("doc", "text", F.col("doc.doc_id").alias("id"), F.md5(text_of()).alias("cls"))
    keyed = keyed.join(gone, ["id", "cls"], "left_anti")
    again = written(keyed.filter("id IS NOT NULL").groupBy("id", "cls").agg(F.count(F.lit(1)).alias("n"))
                    .filter("n > 1").select("id", "cls"), "repeated-rows")
    if again.isEmpty():
        return keyed.select(*unpacked(docs.columns))
    first = (keyed.join(again, ["id", "cls"], "left_semi").groupBy("id", "cls")
             .agg(F.min(F.struct("doc", "text")).alias("row")).select("row.doc", "row.text"))
    return (keyed.join(again, ["id", "cls"], "left_anti").select("doc", "text").unionByName(first)
            .select(*unpacked(docs.columns)))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Base and found personal data replaced by marks of their kind."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as systematic sampling takes it."""
    return mixing.mix(docs)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, and the number of bytes that they decode to."""
    ranks = byte_bpe.share_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    made = byte_bpe.encode(packed(docs), ranks, public_tokenizers.PATTERN, decoded_col="decoded")
    own = ("text", "token_ids", "n_tokens", "n_bytes")
    return made.select(
        *[F.col("doc").getField(c).alias(c) for c in docs.columns if c not in own], "token_ids",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.octet_length("decoded").cast("long").alias("n_bytes"))
