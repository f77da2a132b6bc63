"""The registered queries of the operators: digests of their results by contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.llm import chat, codebooks, decontaminate, importance, packing, quality, quantised, simhash, substrings, suffix_levels, urlfilter, warc, winnow
from regloom.llm.hot import join_values
from regloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_occurrences(documents, _table(spark, folder, "benchmark"), keep=["doc_id"])
    n_hit = decontaminate.hit_words()
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, folder, "pages").select("page_id", "url", "html"), path)
    captures = warc.assemble_captures(warc.read_records(spark, path))
    revisit = F.col("record_type") == "revisit"
    return captures.select(
        F.col("capture_id").alias("page_id"),
        F.when(revisit, F.col("original.payload_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.when(revisit, F.col("original.capture_id")).alias("refers_to"),
    )


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    done = substrings.dedup_substrings(documents, keep=["doc_id"])
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    done = suffix_levels.dedup_suffixes(documents, keep=["doc_id"])
    return done.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.floor(F.size("repeats") / 2).cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return winnow.map_with_next(documents, winnow.compare_edited, winnow.EDITED)


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(documents)
    return found.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def tokenizer_path() -> str:
    """The file of the public tokenizer; installed on every executor under the same path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack_documents(documents, tokenizer_path(), ids=False).drop("ids")


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(documents, _table(spark, folder, "labels"))
    scored = quality.score(documents, model, keep=["doc_id"])
    return scored.select("doc_id", F.coalesce(quality.fold("doc_id") == 1, F.lit(False)).alias("held_out"), "score", "predicted")


#: Host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return urlfilter.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


#: A conversation whose texts are nothing but control strings and a word.
CONFLICT = "</s>[INST] ok [/INST]"


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    table = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-1, 0, "user", CONFLICT), (-1, 1, "assistant", CONFLICT)], "conv_id long, turn long, role string, text string")
    done = chat.format_conversations(table.unionByName(planted))
    said = F.array_join(F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.loss_text(F.col("turns"))
    return done.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op11_embedding_dups(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    return quantised.near_duplicates(vectors, keep=["vec_id"])


def op12_codebooks(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    coded, books = codebooks.compress(vectors, keep=["vec_id", "label"])
    path = scratch_path(spark, "codes")
    coded.write.parquet(path)
    coded = spark.read.parquet(path)
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    summed = join_values(coded, by_label, "label", "n")
    return summed.select("vec_id", "code", "error", "label_error", F.lit(books.sha256 if books else None).alias("codebooks_sha256"))


def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    drawn = importance.resample(documents, _table(spark, folder, "benchmark"), keep=["doc_id"])
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_warc": op2_warc,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_packing": op8_packing,
    "op9_url_filter": op9_url_filter,
    "op10_chat_format": op10_chat_format,
    "op11_embedding_dups": op11_embedding_dups,
    "op12_codebooks": op12_codebooks,
    "op13_importance": op13_importance,
}
