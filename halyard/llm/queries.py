"""The corpus operators as registered queries: one opN_<name> for each, over its whole table."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.llm import (best_two_fit, decontaminate, html_density, language_id, license_scan, merkle, order_minhash, quality_rules,
                         sql, token_count, token_store, toxicity, tree_bpe, turn_repair)
from halyard.llm.common import held_out
from halyard.session import scratch_path
from halyard.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    out = quality_rules.apply_rules(docs, keep=["doc_id"])
    return out.select("_row.doc_id", *[F.col(f"_q.{c}").alias(c) for c in quality_rules.MEASURES],
                      *[F.col(f"_verdict.{c}").alias(c) for c in ("base_failed", "kept")])


@query("op2_order_minhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = order_minhash.near_duplicate_classes(spark, documents(spark, sf_dir).select("doc_id", "text"))
    members = found.where(F.col("key").isNotNull())
    ids = members.groupBy("class_key").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_rows"))
    alone = found.where(F.col("key").isNull())
    return members.join(ids, "class_key").select("doc_id", "class_id", "class_rows") \
        .unionByName(alone.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_rows")))


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(spark, documents(spark, sf_dir).select("doc_id", "text"))


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scorer = toxicity.learn(spark, docs, read_table(spark, sf_dir, "labels"))
    return scorer.score(spark, docs).select("_row.doc_id", held_out("_row.doc_id").alias("held_out"), F.col("_score").alias("score"),
                                            (F.col("_score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query("op5_html_density")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = pages.select("page_id", "url", html_density.main_text(spark, F.col("html")).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


@query("op6_token_count")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = token_count.count_tokens(spark, F.col("text"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), n.alias("n_tokens")) \
        .withColumn("over_limit", F.col("n_tokens") > 1024)


@query("op7_decontaminate")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(spark, documents(spark, sf_dir).select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    out = language_id.identify(spark, docs)
    return out.select("_row.doc_id", held_out("_row.doc_id").alias("held_out"), F.col("_language.lang_pred").alias("lang_pred"),
                      F.col("_language.score").alias("score"), F.col("_language.coverage").alias("coverage"))


@query("op9_token_store")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    token_store.write_store(spark, documents(spark, sf_dir).select("doc_id", "text"), path, spec, end_id=1)

    @F.pandas_udf("long")
    def crc32(ids: pd.Series) -> pd.Series:
        return ids.map(zlib.crc32).astype("int64")
    back = token_store.read_documents(token_store.open_store(spark, path))
    return back.select("doc_id", "start", "n_tokens", crc32("ids").alias("ids_crc32"))


@query("op10_tree_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = tree_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = documents(spark, sf_dir).select("doc_id", "text")
    coded = docs.select("doc_id", tree_bpe.encode(spark, F.col("text"), ranks, public_tokenizers.PATTERN).alias("c"))
    return coded.select("doc_id", (F.octet_length("c.ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("c.ids", 256).alias("ids_sha256"), F.sha2("c.decoded", 256).alias("decoded_sha256"))


def damaged(turns: DataFrame) -> tuple[DataFrame, Column]:
    """The turns after the contract's damage, and which of them are only there because their row was dropped."""
    part = F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                        (F.crc32(F.concat(part[0], F.lit(":"), part[1])) % 20).alias("harm"))
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("harm") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("harm") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), "harm", copies), F.col("harm") == 0


@query("op11_turn_repair", sql.TURN_REPAIR)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, dropped = damaged(read_table(spark, sf_dir, "conversations"))
    fixed = turn_repair.repair(rows, gone=dropped)

    def hashed(turns):
        head, state, first = None, None, True
        for conv_id, _, role, text, *own in turns:
            if own[-1] is not None:
                if head:
                    yield *head, state.hexdigest()
                head, state, first = (conv_id, *own), hashlib.sha256(), True
            else:
                state.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
        if head:
            yield *head, state.hexdigest()
    own = [fixed.schema[c] for c in ("conv_id", *turn_repair.COUNTS, "audit")]
    return turn_repair.streamed(fixed.select("conv_id", "place", "role", "text", *turn_repair.COUNTS, "audit"), hashed,
                                T.StructType([*own, T.StructField("repaired_sha256", T.StringType())]))


@query("op12_best_two_fit")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    capacity, width = 1024, best_two_fit.id_width(spec)
    pieces = best_two_fit.encoded_pieces(spark, documents(spark, sf_dir).select("doc_id", "text"), spec, public_tokenizers.PATTERN, 2, capacity)

    @F.pandas_udf("long")
    def crc32(ids: pd.Series) -> pd.Series:
        return ids.map(lambda b: zlib.crc32(np.frombuffer(b, f"<u{width}").astype("<u4"))).astype("int64")
    rows = pieces.select("task", "nth", "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), crc32("ids").alias("ids_crc32"))
    return best_two_fit.placed(spark, rows, capacity)


@query("op13_merkle_manifest", sql.MERKLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    fields = ("doc_id", "source", "lang", "n_chars")
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    text = F.col("text")
    leaves = docs.select(F.col("source").alias("group"), F.col("doc_id").alias("key"), merkle.digest(*map(F.col, fields), text).alias("leaf"),
                         F.when(tampered, merkle.digest(*map(F.col, fields), F.translate(text, capitals, capitals.lower()))).alias("altered"))

    @F.pandas_udf("proof_sha256 string, folded binary")
    def folded(leaf: pd.Series, proof: pd.Series, position: pd.Series, size: pd.Series, top_position: pd.Series, top_size: pd.Series) -> pd.DataFrame:
        rows = [(hashlib.sha256(p.hex().encode()).hexdigest(), merkle.fold(x, p, (i, n), (j, m)))
                for x, p, i, n, j, m in zip(leaf, proof, position, size, top_position, top_size)]
        return pd.DataFrame(rows, columns=["proof_sha256", "folded"])
    out = merkle.proved(leaves)
    out = out.select("*", folded(F.coalesce("altered", "leaf"), "proof", "position", "size", "top_position", "top_size").alias("f"))

    def text_of(c: str):
        return F.lower(F.hex(c))
    return out.select(F.col("key").alias("doc_id"), text_of("leaf").alias("leaf"), text_of("subroot").alias("subroot"), text_of("root").alias("root"),
                      "f.proof_sha256", text_of("f.folded").alias("folded_root"), (F.col("f.folded") == F.col("root")).alias("verified"))
