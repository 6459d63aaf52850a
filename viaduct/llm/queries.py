"""The operators applied to whole tables with production parameters, and SQL that gives the same rows."""

from __future__ import annotations

from importlib import import_module

from pyspark.sql import DataFrame, SparkSession, functions as F

from .compression import vector_codes
from .exact_dedup import duplicate_groups
from .html_text import extract_text
from .mixing import plan_mix
from .near_dedup import near_duplicates
from .pieces import encode_digests
from .pii import find_personal_data
from .quality import judge_quality
from .spelling import spelling_variants, word_counts
from .token_counts import count_tokens
from .toxicity import fit, score_toxicity
from .url_filter import judge_urls
from .vector_dedup import linked_vectors

QUERIES = {}

TOKENIZERS = "public_tokenizers"  # the module that knows where vocabulary files lie


def vocabulary(name: str) -> str:
    return import_module(TOKENIZERS).path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(run):
    QUERIES[run.__name__] = run
    return run


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are not learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.filter(~held_out()).select("doc_id", "toxic"))
    return (score_toxicity(docs, model).withColumn("held_out", held_out())
            .select("doc_id", "held_out", "score", "predicted", "evidence"))


@query
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables label documents, not pages: the label with the id of a page stands in as that page's outcome, bad
    if it is marked as of low quality or toxic."""
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"),
                             ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    return judge_urls(table(spark, sf_dir, "pages"), outcomes)


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents"))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base_failed.alias("base_failed"), (~base_failed & F.col("kept")).alias("kept"), "failed")


@query
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "documents"))


@query
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


@query
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(table(spark, sf_dir, "documents"), shorten_every=199))


@query
def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"))


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))
