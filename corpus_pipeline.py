"""A corpus made ready for training: five stages over ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outagelens import session
from outagelens.llm import language_id, line_dedup, mixing, ngram_join, packing

TOKENIZER = "word_bpe_49k.json"


def _like(docs: DataFrame, result: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the length of the text as it is now."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        result = result.withColumn("n_chars", F.char_length("text").cast(kind))
    return result.select(*docs.columns)


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows: those without text or any letter go.

    The model learns from documents with text and language whose id's CRC-32 modulo 4 is not 2,
    null ids aside. All rows that share an id or a text are judged each for itself; without any
    row to learn from, and of an empty table, none stays.
    """
    learned = docs.filter(language_id.remainder(F.col("doc_id"), 4) != 2)
    predicted = language_id.predict(docs, language_id.train(learned))
    return predicted.filter(F.col("lang_pred") != language_id.UNKNOWN).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows go; so do texts left with no line.

    First is the smallest id and line, null ids last. Rows that share an id are versions of one
    document: a window at the same line of both is no repeat. Null and empty texts hold no
    window and stay.
    """
    rest = line_dedup.drop_repeated_lines(docs)
    return _like(docs, rest.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingles of five words at 0.8, the one with the smallest id.

    Documents without words and rows with a null id link with nothing and stay; rows that share
    the id that stays all stay.
    """
    linked = ngram_join.linked_documents(docs, shingling=ngram_join.Shingling(words=5, percent=80))
    gone = linked.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, some of them more than once.

    The null source is one of the sources; documents without words, or of which the mix takes
    none, go. Repeated rows count each.
    """
    return _like(docs, mixing.mixed_documents(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 ids.

    Every row gives its own pieces, whatever its id; a null text is empty, one end id. Columns
    other than id and text are not part of the result.
    """
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", known_languages),
    ("line_dedup", without_repeated_lines),
    ("ngram_join", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: language prediction and packing have no form in SQL; tests hold them against plain code
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what one returns is written, and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = session.table_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
