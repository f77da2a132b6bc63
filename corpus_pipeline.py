"""A corpus pipeline of five stages, from raw documents to packed training sequences.

Each stage reads what the one before has kept, as a table written in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.llm import decontaminate, packing, quality, simhash, suffix_levels
from regloom.llm.queries import tokenizer_path
from regloom.llm.wrapping import unwrapped, wrapped
from regloom.session import scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on labelled ones, does not reject."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(wrapped(docs), model, keep=["row", "text"])
    return unwrapped(scored.where("predicted = 1"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of the SimHash operator connect: 4-word shingles, 4 bits at most."""
    return simhash.drop_near_duplicates(docs, words=simhash.WORDS, distance=simhash.DISTANCE)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without byte runs that start earlier, cut at whole characters; ``n_chars`` follows.

    A document of which nothing is left goes; one that was empty before stays.
    """
    done = suffix_levels.dedup_suffixes(wrapped(docs, "doc_id"), keep=["row"], characters=True)
    text = F.decode("kept", "UTF-8")
    rest = done.where("n_removed = 0 or n_removed < n_bytes").withColumn("text", text)
    n_chars = F.when(F.col("n_removed") == 0, F.col("row").getField("n_chars")).otherwise(F.length("text")) if "n_chars" in docs.columns else None
    return unwrapped(rest, docs, **({} if n_chars is None else {"n_chars": n_chars}))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", drop_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: A trained model, fingerprints and a tokenizer are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the table of documents."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return STAGES[-1][1](spark, rows, sf_dir)
