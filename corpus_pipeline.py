"""From raw documents to packed training sequences, one operator per stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
``docs`` of the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import bytecnn, line_dedup, mixing, packing, simhash
from tablewright.llm.common import table
from tablewright.session import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not reject: those with a score of 0.5 or more.

    NULL and empty texts are scored as no bytes; repeated rows are judged alike; without labels every row stays. An empty table gives an empty result.
    """
    scored = bytecnn.classify_quality(docs, table(spark, sf_dir, "labels"), keep={c: F.col(c) for c in COLUMNS})
    return scored.where(F.col("score") >= 0.5).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; a document may become empty, and stays."""
    kept = line_dedup.drop_repeated_lines(docs, keep={c: F.col(c) for c in ("doc_id", "lang", "source")})
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: of the smallest id, NULL last, then of the smallest hash of the text.

    A row is known by its id and its text, so rows of one id with other texts are judged apart. Of rows equal in both, which are copies, the least in the other
    columns stays. The rows that go are the fewer ones, so the join is against them: Spark broadcasts their keys while they are small, and
    the texts move only beyond that. An empty table gives an empty result; NULL texts are one group.
    """
    # Never NULL inside, so that keys can be compared and joined.
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("text"))
    found = materialise(simhash.near_duplicates(docs.select(key.alias("row"), "text"), id_col="row"), "groups")
    gone = materialise(found.where("id != component").select("id").distinct(), "gone")
    kept = docs.withColumn("id", key).join(gone, "id", "left_anti")
    copies = materialise(found.where("id = component").groupBy("id").count().where("count > 1").select("id"), "copies")
    if copies.isEmpty():
        return kept.select(*COLUMNS)
    least = kept.join(copies, "id", "left_semi").groupBy("id").agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")
    return kept.join(copies, "id", "left_anti").select(*COLUMNS).unionByName(least)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many rows of each document as the mix takes copies of it.

    A NULL source is a source of its own; documents without words are copied by their rate; equal rows are dealt one by one. An empty table gives an empty result.
    """
    mixed = mixing.mix_sources(docs)
    return mixed.select("row.*", F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("copy")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids and their place in sequences of 2048 tokens.

    A NULL text is an empty one and has its end token; every row is packed, repeated ones each, and long ones in pieces. An empty table gives an empty result.
    """
    return packing.pack_documents(docs, TOKENIZER, end_id=0).withColumnRenamed("id", "doc_id")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mixing", mix), ("packing", pack)]

#: The stages fit models and iterate, which SQL cannot express; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{name}")
    return docs
