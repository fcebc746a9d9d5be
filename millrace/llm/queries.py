"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import compression, jaccard_join, language, merkle, merkle_sql, mixing, posting_lists, secret_scan, spelling, spelling_sql, threshold_search, training_order, trie_bpe, unigram_counts, url_sql, url_templates
from .shared import ascii_lower

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The file of a public vocabulary, from the package that holds them."""
    import public_tokenizers

    return public_tokenizers.path(name)


# Fixed value: how the rank files cut texts, with quantifiers that never backtrack.
RANK_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

# Key of the training order, and the id that pads sequences: the vocabulary's end of text.
ORDER_KEY, END_OF_TEXT = 20_240_613, 50_256


@query
def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.tiktoken")
    documents = table(spark, sf_dir, "documents")
    manifest, _ = training_order.training_order(documents, path, RANK_PATTERN, ORDER_KEY, pad=END_OF_TEXT)
    return manifest


@query
def op2_unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    scored = unigram_counts.zipf_vocabulary(pieces)
    return unigram_counts.count_tokens(table(spark, sf_dir, "documents"), scored, model.unk_id())


@query
def op3_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = trie_bpe.encode_texts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return coded.select("doc_id", F.col("n_tokens"), "ids_sha256", "decoded_sha256")


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), words=3, threshold="0.9")


@query
def op6_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.judge_texts(table(spark, sf_dir, "documents"))


@query
def op4_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


@query
def op9_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return secret_scan.scan_texts(documents, secret_scan.train(documents))


# Host, path, whether the rule blocks.
URL_RULES = [
    ("org", "/", False),
    ("example.org", "/es/", True),
    ("example.org", "/en/1", True),
    ("com", "/fr/", False),
    ("com", "/de/", True),
]


@query
def op8_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


ORACLES["op8_path_templates"] = url_sql.oracle(URL_RULES)


MIX_SEED = 7


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), seed=MIX_SEED)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op7_mixing"] = rf"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
    FROM documents
), sums AS (
    SELECT source, sum(size)::BIGINT AS s, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
    FROM sized GROUP BY source
), filled AS (
    -- Words and weights left when the sources with a smaller limit by weight are full.
    SELECT *, (SELECT sum(s) FROM sums)
            - coalesce(sum(3 * s) OVER (ORDER BY 3 * s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(w) OVER (ORDER BY 3 * s / w DESC, source DESC) AS weight
    FROM sums
), level AS (
    SELECT rest, weight FROM filled WHERE 3 * s * weight > rest * w ORDER BY 3 * s / w, source LIMIT 1
), goals AS (
    SELECT source, s, CASE WHEN 3 * s * f.weight <= f.rest * w THEN (3 * s)::DOUBLE
        ELSE ((SELECT rest FROM level) * w)::DOUBLE / (SELECT weight FROM level)::DOUBLE END AS target
    FROM filled f
), ordered AS (
    SELECT doc_id, size, s, target, floor(target + 0.5)::BIGINT AS quota,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5('{MIX_SEED}:' || doc_id || ':' || size)
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, s AS source_size, target,
    (size * (quota // s + CASE WHEN before * 2 + size <= quota % s * 2 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""


@query
def op10_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op13_merkle_witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    documents = table(spark, sf_dir, "documents").select(*fields).withColumn("tampered", ascii_lower(F.col("text")))
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    shown = F.when(hit, merkle.leaf_of(*fields[:-1], "tampered")).otherwise(merkle.leaf_of(*fields))
    made = merkle.merkle_manifest(documents, fields, carry={"shown": shown})
    made = made.withColumn("folded_root", merkle.folded(merkle.hex_of("shown"), "witness"))
    return made.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_of("witness").alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


ORACLES["op13_merkle_witnesses"] = merkle_sql.ORACLE


@query
def op12_threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_search.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


ORACLES["op12_threshold_search"] = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings WHERE embedding IS NOT NULL
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


ORACLES["op11_spelling_variants"] = spelling_sql.ORACLE
