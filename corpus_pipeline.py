"""The corpus pipeline: stages over ``documents``, each one operator of ``riskloom.llm``.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but
the last return the columns they were given. Rows with a null id cannot be named in a
decision and pass every filter. Documents are dropped by id, so all rows of an id go together.
A stage keeps on disk only what its result reads: ids, or boilerplate lines.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import jaccard, language, leaks, lines, pieces
from riskloom.llm.common import fold, read_table, release_heap, stored, stored_alone


def _without(docs: DataFrame, gone: Callable[[], DataFrame]) -> DataFrame:
    """``docs`` without the ids in ``gone()`` (``doc_id``)."""
    spark = docs.sparkSession
    ids = stored_alone(spark, lambda: gone().select(F.col("doc_id").alias("_gone")).distinct())
    release_heap(spark)
    return docs.join(ids, docs["doc_id"].cast("long") == ids["_gone"], "left_anti")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that lie too far from every language."""

    def rejected() -> DataFrame:
        model = language.fit_languages(docs, fold(3) != 1)
        return language.predict_languages(docs, model).where("rejected")

    return _without(docs, rejected)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source's boilerplate lines out of its texts. Copies and near copies are still
    there and count once: a line found with copies counted once must stay boilerplate when the
    near duplicates among the documents that hold such lines count as one document as well."""
    host, text = F.col("source"), F.col("text")

    def page_groups(sites: DataFrame) -> DataFrame:
        holders = stored(lines.pages_with_lines(docs, sites))
        groups = jaccard.column_components(holders).where("n_shingles > 0")
        return groups.groupBy(F.col("doc_id").alias("page_id")).agg(F.min("component_id").alias("page_group"))

    def boilerplate() -> DataFrame:
        sites = lines.host_lines(lines.boilerplate_lines(docs, host, text, copies_once=True))
        groups = stored_alone(spark, lambda: page_groups(sites))
        release_heap(spark)
        return lines.confirmed_lines(docs, sites, groups, "doc_id", host, text)

    cleaned = lines.drop_lines(docs, lines.host_lines(stored_alone(spark, boilerplate)))
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near duplicates."""
    return _without(docs, lambda: jaccard.jaccard_components(docs).where("component_id <> doc_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that leak a benchmark item."""
    return _without(docs, lambda: leaks.leaks(docs, read_table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids and decoded text of every document, as digests."""
    release_heap(spark)
    return pieces.piece_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("jaccard_join", dedup_documents),
    ("decontamination", decontaminate),
    ("sentencepiece", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's output is written, read by the next and deleted."""

    def after(count: int) -> DataFrame:
        """The documents that the first ``count`` stages kept."""
        if not count:
            return read_table(spark, sf_dir, "documents")
        return stored_alone(spark, lambda: STAGES[count - 1][1](spark, after(count - 1), sf_dir))

    return STAGES[-1][1](spark, after(len(STAGES) - 1), sf_dir)
