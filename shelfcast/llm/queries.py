"""The registered queries of the document operators.

Each takes (spark, sf_dir), reads its whole table and applies one operator
with production parameters; ``ORACLES`` has DuckDB SQL where SQL can express
the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import (attention_lm, clustering, compression_quality, decontaminate, filter_audit, fingerprints, line_dedup, minhash, packing,
               phrase_dedup, pieces, quality_rules, suffix_dedup)


def tokenizer_file(spark: SparkSession, name: str) -> str:
    """Place of a public tokenizer's file: the folder in
    ``spark.shelfcast.tokenizers``, else the installed package's."""
    folder = spark.conf.get("spark.shelfcast.tokenizers", None)
    if folder:
        return f"{folder.rstrip('/')}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_bytes(spark: SparkSession, name: str) -> bytes:
    with open(tokenizer_file(spark, name), "rb") as f:
        return f.read()


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(C.documents(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = packing.tokenizer_text(tokenizer_bytes(spark, "byte_bpe_50k.json"))
    out = packing.pack(packing.pieces(C.documents(spark, sf_dir), tokenizer, with_ids=False))
    return out.drop("ids")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(C.documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_bytes(spark, "piece_bpe_32k.model")
    out = pieces.round_trip(C.documents(spark, sf_dir), model, texts=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op5_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = phrase_dedup.dedup_passages(C.documents(spark, sf_dir), texts=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir)
    model = compression_quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = compression_quality.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", compression_quality.held_out().alias("held_out"), "score", "predicted")


def op7_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = packing.tokenizer_text(tokenizer_bytes(spark, "byte_bpe_50k.json"))
    return attention_lm.score(C.documents(spark, sf_dir), tokenizer)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_repeated_lines(C.documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_substrings(C.documents(spark, sf_dir), texts=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(C.documents(spark, sf_dir))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.report(C.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(C.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_fingerprints, op2_packing, op3_quality_rules, op4_pieces, op5_phrase_dedup, op6_compression_quality, op7_attention_lm, op8_line_dedup, op9_suffix_dedup, op10_minhash, op11_decontaminate,
                          op12_filter_audit, op13_clusters, pipeline)
}

ORACLES: dict[str, str] = {"op8_line_dedup": line_dedup.ORACLE, "op11_decontaminate": decontaminate.ORACLE,
                           "op12_filter_audit": filter_audit.ORACLE, "op13_clusters": clustering.ORACLE}
