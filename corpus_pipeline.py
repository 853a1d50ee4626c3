"""From documents to token ids in five stages, each an operator of refloom.llm.

A stage takes (spark, docs, sf_dir) and returns the documents that it leaves; run() writes each result as Parquet to the
shared folder and reads it again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.llm import bpe, jaccard, langid, mixing, suffix_dedup
from refloom.llm.common import read_table, stored
from refloom.session import ship_package

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model can name; null texts and texts without a letter go."""
    ship_package(spark)
    told = langid.identify(docs.select(*COLUMNS), langid.learn(docs))
    return told.where(F.col("lang_pred") != langid.UNKNOWN).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, a similarity of 0.8), that with the smallest doc_id.

    SimHash fingerprints meet by anchor-point covering, as in op2_simhash, and shingles judge; links beyond its bits are found by prefixes.
    """
    ship_package(spark)
    return jaccard.keep_first_similar(docs.select(*COLUMNS))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of byte strings of 200 bytes that occur before, by doc_id; the first stays. Documents of which nothing is left go."""
    ship_package(spark)
    return suffix_dedup.without_later_copies(docs.select(*COLUMNS)).withColumn("n_chars", F.char_length("text").cast("long")).where(F.trim("text") != "").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    ship_package(spark)
    return mixing.mixed_documents(docs.select(*COLUMNS))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids) of each document of the mix."""
    ship_package(spark)
    coded = bpe.encode(docs.select(F.struct("doc_id", "lang", "source").alias("doc"), "text"), "doc")
    return coded.select("doc.*", F.size("ids").alias("n_tokens"), "ids")


STAGES = [
    ("language identification", identify_language),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources", mix),
    ("BPE encoding", encode_tokens),
]

#: Language identification is learned, so SQL can't express the rows; tests/llm holds them against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
