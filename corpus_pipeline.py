"""The corpus pipeline: documents in, token ids out, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet in the shared folder and read
again as the next stage's documents. All but the last return the columns of `documents`.

1. toxicity: documents whose score reaches the threshold go. The model learns from all labelled documents of sf_dir.
2. exact_dedup: of equal texts the row with the largest id stays.
3. near_dedup: of each group of near copies (five-word runs, similarity 0.8 or more) the smallest id stays.
4. mixing: sources are mixed to their target weights; documents may occur up to three times.
5. sentencepiece: doc_id, number of tokens, and digests of the ids and of the decoded text, for every document as often
   as the mix holds it.

An empty table passes through every stage. Null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viaduct.llm import exact_dedup, mixing, near_dedup, pieces, toxicity
from viaduct.llm.queries import table, vocabulary
from viaduct.llm.stored import forget, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_digests(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

# The scores, sketches and token ids have no SQL; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the last stage's output is left in the shared folder, until the session ends."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            forget(before)
        before = docs
    return docs
