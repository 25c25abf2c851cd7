"""A corpus pipeline of five stages: language, lines, near duplicates, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns the columns of documents, but for the last, which
returns what the encoding makes of each document. Rows repeat after the mix, which takes up to two
copies of a document; the stages before it keep one row for each document they keep.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.llm import bpe, language_id, line_dedup, mixing, near_dup
from quillon.llm.common import documents, materialise, small

#: The result can't be expressed in SQL: compression, sketches and random rounding decide. It is tested against plain versions.
ORACLE_SQL = None

#: Ids that are broadcast at most, about 40 MB; beyond it the documents to keep are found by a shuffle.
KEPT_IDS = 2_000_000
#: Words of a chunk that is encoded at a time: less than op10's, as workers have done other stages before.
WORDS_AT_ONCE = 1_500_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents; documents without letters or of which no language is the nearest go."""
    out = language_id.identify_language(docs, language_id.fit(docs))
    return out.where(~F.col("rejected")).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents share go; documents stay, n_chars follows the text."""
    out = line_dedup.drop_repeated_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents (five-word shingles, 0.8) the one with the smallest id stays."""
    groups = near_dup.near_duplicates(docs.select("doc_id", "text"), size=5)
    kept = materialise(groups.where("kept").select("doc_id").distinct(), groups)
    kept = small(kept, KEPT_IDS)
    return docs.join(kept.withColumnRenamed("doc_id", "__id"), F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights: a document comes back none, one or two times."""
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    taken = mixing.mix_sources(docs.withColumn("__size", words), size="__size")
    return taken.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, as their number and digest, and the digest of what they decode to."""
    out = bpe.encode(docs.select("doc_id", "text"), public_tokenizers.path(bpe.RANKS), digest=True, chunk_words=WORDS_AT_ONCE)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("near_dup", drop_near_duplicates),
    ("mix_sources", mix),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir; each stage's result is written and read again."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
