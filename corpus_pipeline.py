"""Corpus preparation: quality rules, language identification, near-duplicate
removal by the Jaccard join, and packing into training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again before the next one; all but the last return the columns of
documents.  Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricecraft.llm import jaccard, langid, packing, rules
from pricecraft.llm.common import crc_mod, save

MIN_COSINE = 0.2            # below it a text resembles none of the learned languages


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and the learned decision list.

    Rows with a null or empty text have no words and go; rows that share an
    id are judged by their own text; repeated rows stay or go together.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = rules.all_verdicts(docs, labels).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(good["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == good["_key"])
    return docs.join(good, same, "left_semi")


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages.

    Learned from the rows with a language whose crc32(doc_id) mod 4 is not 2.
    Texts without a letter, and those of cosine below MIN_COSINE with every
    language, go; a null ``lang`` is no reason to go.
    """
    held = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    known = langid.learn_prototypes(docs.where(~held))
    pred, score = (max([name, *(c + "_" for c in docs.columns if c.startswith(name))], key=len) for name in ("_lang_pred", "_lang_score"))
    found = langid.identify(docs, known, carry=tuple(docs.columns), names=(pred, score))
    return found.where((F.col(pred) != langid.UND) & (F.col(score) >= MIN_COSINE)).drop(pred, score)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of every group of near duplicates (5-word
    shingles, similarity 0.8 or more).

    Documents without shingles link with nothing and stay.  Of rows that share
    an id one stays; rows without an id cannot be told apart and all stay.
    """
    first = jaccard.jaccard_components(docs).where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens,
    with the ids and their crc32."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality rules", keep_quality),
    ("language id", keep_languages),
    ("n-gram Jaccard join", one_of_each_group),
    ("best-fit packing", pack),
]

#: The stages learn models and tokenize, which SQL cannot express; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
