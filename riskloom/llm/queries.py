"""One registered query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    jaccard,
    language,
    leaks,
    lines,
    neighbours,
    pieces,
    quality,
    ranked,
    sharding,
    spelling,
    substrings,
    tokens,
    warc,
)
from riskloom.llm.common import fold, read_table

Query = Callable[[SparkSession, str], DataFrame]

_registry: dict[str, Query] = {}


def query(f: Query) -> Query:
    _registry[f.__name__] = f
    return f


def llm_queries() -> dict[str, Query]:
    return dict(_registry)


def llm_oracles() -> dict[str, str]:
    return {
        "op2_line_dedup": lines.cleaned_sql(extra=", coalesce(n_dropped, 0) AS n_dropped"),
        "op11_ranked_search": ranked.ranked_sql(),
        "op13_warc": warc.archived_sql(),
    }


@query
def op1_language_id(spark, folder):
    docs = read_table(spark, folder, "documents")
    model = language.fit_languages(docs, fold(3) != 1)
    return language.predict_languages(docs, model).select(
        "doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score", "distance", "rejected"
    )


@query
def op2_line_dedup(spark, folder):
    docs = read_table(spark, folder, "documents")
    cleaned = lines.drop_boilerplate(docs, host="source", text="text", dropped="n_dropped")
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op3_neighbours(spark, folder):
    return neighbours.nearest(read_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op4_quality(spark, folder):
    shares = quality.stored_shares(read_table(spark, folder, "documents"))
    model = quality.fit_quality(shares, read_table(spark, folder, "labels"), fold(4) != 2)
    return quality.score_quality(shares, model).select(
        "doc_id", (fold(4) == 2).alias("held_out"), "score", "predicted"
    )


@query
def op5_substring_dedup(spark, folder):
    return substrings.remove_repeats(read_table(spark, folder, "documents"), window=13, keep_text=False)


@query
def op6_sharding(spark, folder):
    text = F.coalesce("text", F.lit(""))
    rows = read_table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("group"),
    )
    law = {"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}
    placed = sharding.shard_rows(rows, F.col("group"), shards=8).withColumns(law)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "home_shard")


@query
def op7_jaccard_join(spark, folder):
    return jaccard.jaccard_components(read_table(spark, folder, "documents"), size=5, percent=80)


@query
def op8_decontamination(spark, folder):
    return leaks.leaks(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@query
def op9_token_counts(spark, folder):
    return tokens.token_counts(read_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op10_sentencepiece(spark, folder):
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.piece_digests(read_table(spark, folder, "documents"), model)


@query
def op11_ranked_search(spark, folder):
    index = ranked.build_index(read_table(spark, folder, "documents"))
    return ranked.search(index, read_table(spark, folder, "benchmark"), k=10).drop("query")


@query
def op12_spelling_variants(spark, folder):
    return spelling.variant_groups(spelling.word_counts(read_table(spark, folder, "documents")))


@query
def op13_warc(spark, folder):
    read = warc.archived(read_table(spark, folder, "pages"), least=0)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
