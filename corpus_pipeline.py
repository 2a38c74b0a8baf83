"""Corpus pipeline: documents to packed training sequences.

1. language_id: documents whose language cannot be told from noise go (source serves as host, lang as the
   declared language).
2. line_dedup: later repeats of lines of three words or more, and of longer passages, are deleted from the texts; documents
   that lose all their text go.
3. near_dedup: one document of each component of documents that share 0.8 or more of their 5-word shingles
   (Jaccard) stays, that of the smallest doc_id, and one row of it.
4. mixing: each source keeps the documents that its share of the token budget reads, once at most.
5. packing: what is left is packed into sequences of 4,096 ids, neighbours by BM25; one row for each piece.

Every stage but the last returns the columns of documents.  Each is written as Parquet and read again, so a lost
executor costs at most the stage it was working on; a stage's folder goes when the next one is written, the last when the driver
ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerleaf.llm import common, language, lines, mixing, packing, simhash

#: The mixture reads four fifths of the tokens it is given, and no document twice.
MIX = {"total": (4, 5), "max_epochs": 1}
#: Encoded in smaller steps than by itself: the executors still hold what the stages before have left.
PACK = {"encode_bytes": 4_000_000}


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null, empty and letterless texts go; null lang and source give no evidence; repeated rows stay together."""
    return language.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first occurrence by doc_id (null first) and line stays; null and blank texts stay; rows of equal doc_id and text are one
    document and stay together."""
    return lines.drop_repeats(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and empty texts are one group of copies; rows with a null doc_id stay; of rows of equal doc_id and text one stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null lang and source are leaves of their own; null texts hold no token; documents of equal doc_id and text come or go together."""
    return mixing.keep_mixed(docs, **MIX)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row is packed whole: a null text is the end id alone, null doc_ids stay null."""
    return packing.pack(docs, **PACK)


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained text scores, fingerprints and token ids are beyond SQL; tests/llm holds each stage's operator against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = common.new_path(spark, f"pipeline-{name}")
        common.remove_later(spark, path)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            common.remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
