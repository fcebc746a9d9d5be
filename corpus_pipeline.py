"""A corpus pipeline: from documents to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes a stage's
result and reads it back as the next one's input. All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.llm import jaccard_join, language, mixing, secret_scan, trie_bpe
from millrace.llm.queries import MIX_SEED, vocabulary
from millrace.llm.shared import new_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is near a known language; texts without a letter go, and those
    too far from every centroid."""
    return language.identify(docs.select(*COLUMNS)).where("not rejected").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that with the smallest id. Documents are
    linked from a Jaccard similarity of 0.8 of their five-word shingles on. A row that repeats
    another's id and text goes; documents without an id stay."""
    docs = docs.select(*COLUMNS)
    found = jaccard_join.jaccard_components(docs, words=5, threshold="0.8")
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    # The join has dealt the rows by id already, so the window shuffles nothing.
    copy = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    before = F.lag("text").over(Window.partitionBy("doc_id").orderBy("text"))
    named = docs.join(kept, "doc_id", "left_semi").select("*", copy.alias("_copy"), before.alias("_before"))
    named = named.where((F.col("_copy") == 1) | ~F.col("text").eqNullSafe(F.col("_before")))
    return named.select(*COLUMNS).unionByName(docs.where("doc_id is null"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark."""
    docs = docs.select(*COLUMNS)
    clean = secret_scan.redact_texts(docs, secret_scan.train(docs))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it; texts without words are not taken."""
    mixed = mixing.mix(docs.select(*COLUMNS), seed=MIX_SEED).where("times > 0")
    return mixed.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and the hashes of ids and decoded text."""
    return trie_bpe.encode_texts(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scans", redact_secrets),
    ("source_mixing", mix_sources),
    ("bpe_encoding", encode),
]

# Centroids, Markov models and merges are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
