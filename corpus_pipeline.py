"""A corpus pipeline from the training-data operators: each stage reads what its predecessor stored.

A stage takes (spark, docs, sf_dir) and gives the rows that stay, with the columns of documents; the last gives token ids.

All stages take null ids, texts and sources, empty and very long texts, and repeated rows, which count as rows of their own; an empty table gives an
empty result. Columns besides those of documents pass through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inventrace.llm import lines, mixing, pieces, quality, simhash
from inventrace.llm.common import documents, stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels that are not held out.

    Null and empty texts get the score of a text without n-grams. Equal texts have equal scores. Without labels of both classes all texts score alike.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(quality.labelled(docs, labels))
    return quality.classify(docs, model).filter("predicted = 1").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that occur earlier; n_chars follows the text.

    No document goes: a copy of an earlier text keeps its row with an empty text, a null text stays null. Rows with the same id and text are cut alike.
    """
    cut = lines.line_dedup(docs).drop("line_dedup")
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in cut.columns else cut


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, of repeated rows too; null and empty texts are copies of each other."""
    return simhash.drop_near_duplicates(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix takes them; each copy is whole.

    Null texts and texts without words have no size and are not taken. A null source is a source; without words in any text nothing is taken.
    """
    return mixing.mix(mixing.plan(docs, cut_last=False)).select("doc.*")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix and the text that they decode to; a null text has null ids, an empty one none."""
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    own = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    encoded = pieces.encode(docs, model, keep=own).select(*[f"row.{c}" for c in own], "ids")
    return pieces.decode(encoded, model).select(*own, "ids", F.size("ids").cast("long").alias("n_tokens"), F.col("decoded").alias("text"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing sources to target weights", mixing_sources),
    ("SentencePiece encoding and decoding", sentencepiece),
]
#: The stages train a model and use hashes and a vocabulary that SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each stored before the next one reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
