"""One query per operator of this package over the whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelkit.llm import bpe, decontaminate, fim, html, jaccard, lexical, mixing, pii, quality, secrets, substring, tokens, warc
from modelkit.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024
RANKS = "byte_bpe_50k.tiktoken"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.dedup(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    judged = quality.score(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept")


@query
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(read(spark, sf_dir, "documents")).taken()


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.digest(pii.find(docs, pii.train(pii.hand_labelled(spark))))


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_groups(read(spark, sf_dir, "documents"))


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    tiles = F.transform("tiles", lambda t: F.concat_ws(":", t["place"], t["item_place"], t["tokens"]))
    return found.select("doc_id", "item_id", "item_tokens", "covered", "coverage", F.array_join(tiles, ",").alias("tiles"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = tokens.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query
def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = warc.resolve(warc.captures_of(read(spark, sf_dir, "pages")))
    headers = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return resolved.select(
        "capture_id",
        "canonical",
        "ts",
        F.col("status").cast("long").alias("status"),
        "source_id",
        "outcome",
        F.array_join(headers, ";").alias("headers"),
        F.sha2("body", 256).alias("body_sha256"),
    )


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.top_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(read(spark, sf_dir, "documents"))
    whole = fim.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(whole, 256).alias("restored_sha256"),
    )


@query
def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    made = bpe.encode(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True)
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
