"""From raw documents to token ids: language, toxicity, near duplicates, benchmark passages, encoding.

Each stage is written as Parquet and read again as the next one's documents. What a stage has to
learn, it learns as its operator's query does; labels and benchmark are tables beside the documents.
Empty input gives empty output with the same columns; documents with a null text have no
language and go in the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from granary.llm import bpe, decontam, langid, simhash, toxicity
from granary.llm.common import fold, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one language that can be told; ``lang`` stays as it was."""
    dictionaries = langid.fit(docs.where(fold("doc_id", 3) != 1))
    return langid.identify(docs.select(*COLUMNS), dictionaries).where("NOT lang_rejected").select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below one half."""
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0))
    return toxicity.score(docs.select(*COLUMNS), lexicon).where("toxicity < 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest id; of equal rows one stays.

    A document without an id comes after those with one, in the order of its text's hash.
    """
    key = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.xxhash64("text"))
    keyed = docs.select(*COLUMNS, key.alias("key"))
    groups = simhash.near_duplicates(keyed, id_column="key")
    kept = groups.where("key = component_id").select("key").distinct()
    return keyed.join(kept, "key", "left_semi").dropDuplicates(["key"]).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the benchmark's passages; one that has no other word goes."""
    marked = decontam.mark(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    clean = marked.where((F.size("spans") == 0) | (decontam.n_hit() < F.col("n_words")))
    length = F.when(F.size("spans") > 0, F.length("cleaned").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumns({"text": F.col("cleaned"), "n_chars": length}).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, packed as little-endian unsigned 32-bit integers."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("encoding", encode),
]

#: Compression, a learned lexicon and merging have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
