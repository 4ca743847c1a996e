"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

Null, empty and wordless texts go in the first two stages; given to a later stage alone they are kept, as no copy of
anything and without a passage, and encode to no ids.  Repeated rows are judged alike; of rows equal in doc_id and text the
near-duplicate stage keeps one.  An empty table passes through every stage.  Further columns of the documents travel along
under any name, up to the last stage, which returns its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.llm import decontaminate, language_id, order_minhash, quality_rules, tree_bpe
from halyard.llm.common import unpacked
from halyard.session import cut_lineage
from halyard.sources.tables import read_table

#: A document is rejected as of no language if its language knows fewer of its trigrams than this.
MIN_COVERAGE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents of a recognised language; texts that are null, without letters or mostly unknown go."""
    known = language_id.identify(spark, docs)
    ok = (F.col("_language.lang_pred") != language_id.UNDETERMINED) & (F.col("_language.coverage") >= MIN_COVERAGE)
    return unpacked(known.where(ok))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that pass the base rules and look like their language."""
    return unpacked(quality_rules.apply_rules(docs).where("_verdict.kept"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class."""
    return order_minhash.one_of_each(spark, docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, or any 200 consecutive characters of a longer one, within 10 % of edits."""
    return decontaminate.clean(spark, docs, read_table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and whether they decode to the text's bytes."""
    ranks = tree_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .select("doc_id", "text", tree_bpe.encode(spark, F.col("text"), ranks, public_tokenizers.PATTERN).alias("c"))
    return coded.select("doc_id", (F.octet_length("c.ids") / 4).cast("long").alias("n_tokens"), F.col("c.ids").alias("ids"),
                        (F.col("c.decoded") == F.col("text").cast("binary")).alias("exact"))


STAGES = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("order_minhash", dedup_stage),
    ("decontaminate", decontamination_stage),
    ("tree_bpe", encoding_stage),
]

#: The stages run Python on whole texts and learned models; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
