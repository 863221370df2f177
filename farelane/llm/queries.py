"""Registered queries of the text operators: thin, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm import (
    curriculum,
    line_dedup,
    packing,
    periodic_runs,
    quality_rules,
    sentencepiece_bpe,
    simhash,
    suffix_dedup,
    surrogates,
    token_alignment,
    topk_search,
    url_filter,
    warc_zip,
)
from farelane.llm.common import land, let, words_of


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents")).drop("text_key", "lost")


#: The key of the registered queries; real runs take their own from a secret store.
SURROGATE_KEY = b"registered queries"


def private(spark: SparkSession, folder: str) -> DataFrame:
    replaced = surrogates.replace_entities(table(spark, folder, "documents"), SURROGATE_KEY, "kinds")
    return replaced.select("doc_id", "text", F.size("kinds").alias("n_mentions"), F.array_join("kinds", ",").alias("kinds"))


def piece_ids(spark: SparkSession, folder: str) -> DataFrame:
    tokens = sentencepiece_bpe.encode_and_decode(table(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"),
    )


def archived(spark: SparkSession, folder: str) -> DataFrame:
    records = warc_zip.read_records(warc_zip.archive(table(spark, folder, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def nearest(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.search(topk_search.quantised(table(spark, folder, "embeddings")))


def repeats(spark: SparkSession, folder: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    listed = url_filter.named_urls(pages).unionByName(url_filter.mirror_urls(pages))
    judged = url_filter.judge_urls(pages.select("page_id", "url"), listed)
    return judged.select("page_id", "host", "path", "rule", "verdict", "canonical")


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))


def boilerplate(spark: SparkSession, folder: str) -> DataFrame:
    lines = lambda: F.size(F.split(F.coalesce("text", F.lit("")), "\n"))
    docs = table(spark, folder, "documents").withColumn("n_lines", lines())
    left = line_dedup.remove_boilerplate(docs)
    emptied = F.col("text") == ""
    return left.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.length("text").cast("long").alias("n_chars_left"),
        emptied.alias("is_empty"),
        F.md5(F.encode("text", "UTF-8")).alias("text_md5"),
    )


def aligned(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = token_alignment.align(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    written = land(found.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return token_alignment.with_counts(written).drop("block")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document or so repeats a period from some word on."""
    hashed = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    g = F.floor(hashed / 10)

    def repeated(words):
        n = F.size(words)
        a = g % n
        period = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        word = lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % period).cast("int")))
        return F.when(n > 0, F.array_join(F.transform(words, word), " "))

    chosen = F.when(hashed % 10 == 0, let(words_of(F.col("text")), repeated))
    return docs.select("doc_id", F.coalesce(chosen, "text").alias("text"))


def periodic(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.collapse_runs(with_planted_runs(table(spark, folder, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(F.col("best.length") * 1000 / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def mixed(spark: SparkSession, folder: str) -> DataFrame:
    found = curriculum.curriculum(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        curriculum.taken_words(F.col("copies")).alias("taken"),
        F.size("copies").cast("long").alias("n_copies"),
        F.floor(F.get("copies", F.lit(0))["position"] * 1_000_000).alias("first_millionth"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_surrogates": private,
    "op2_quality_rules": quality,
    "op3_sentencepiece": piece_ids,
    "op4_warc_zip": archived,
    "op5_simhash_near_dedup": near_duplicates,
    "op6_best_fit_packing": packed,
    "op7_url_filter": urls,
    "op8_exact_topk": nearest,
    "op9_suffix_dedup": repeats,
    "op10_line_dedup": boilerplate,
    "op11_token_alignment": aligned,
    "op12_periodic_runs": periodic,
    "op13_source_curriculum": mixed,
}
