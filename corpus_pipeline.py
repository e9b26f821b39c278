"""Corpus pipeline: documents in, packed training sequences out.

STAGES run in order; each gets all that its predecessor kept, is written as
Parquet in the shared checkpoint folder and reread by the next. All but the
last return the columns of ``documents`` (doc_id, text, lang, source, n_chars).
The column n_chars follows the text where a stage changes it. Further columns
are dropped by the first stage. Empty tables pass through; nulls and repeated rows are treated as each operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import common as C
from shelfcast.llm import compression_quality, line_dedup, minhash, packing, phrase_dedup
from shelfcast.llm.queries import tokenizer_bytes
from shelfcast.session import stage_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _shaped(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of documents, with ``text`` as the new text."""
    return docs.select("doc_id", F.col(text).alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go; without labels of
    both classes there is no classifier, and all stay."""
    C.prepare(spark)
    model = compression_quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if model is None:
        return docs.select(*COLUMNS)
    scored = compression_quality.score(docs.select(*COLUMNS), model)
    return scored.where("predicted = 1").select(*COLUMNS)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in several documents stay in the last of them."""
    C.prepare(spark)
    return _shaped(line_dedup.drop_repeated_lines(docs.select(*COLUMNS)), "kept_text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: that of the smallest doc_id
    (null is smallest). Rows of the same doc_id and text count as one; other
    rows are told apart by a key of their own, whatever their doc_id."""
    C.prepare(spark)
    rows = docs.select(*COLUMNS).dropDuplicates(["doc_id", "text"]).withColumn("__row", F.monotonically_increasing_id())
    rows = stage_table(rows, "near-rows")[0]  # the keys stay as they are
    found = stage_table(minhash.near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text")), "near-duplicates")[0]
    ranked = rows.select("__row", F.struct("doc_id", F.xxhash64("text"), "__row").alias("rank"))
    first = (ranked.join(found.select(F.col("doc_id").alias("__row"), "component_id"), "__row")
             .groupBy("component_id").agg(F.min("rank").alias("rank")).select("rank.__row"))
    return rows.join(first, "__row", "left_semi").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that start in a document with a smaller doc_id are cut out."""
    C.prepare(spark)
    cut = phrase_dedup.dedup_passages(docs, joined=False, more=("lang", "source"))
    return _shaped(cut, "kept_text")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 1024."""
    C.prepare(spark)
    tokenizer = packing.tokenizer_text(tokenizer_bytes(spark, "byte_bpe_50k.json"))
    return packing.pack(packing.pieces(docs, tokenizer))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", repeated_lines),
    ("near-duplicates", near_duplicates),
    ("substring dedup", repeated_passages),
    ("packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over sf_dir's documents."""
    docs = C.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))[0]
    return docs


#: The classifier's decisions can't be written in SQL. A test takes them as they
#: are and holds run() against brute-force versions of the other stages.
ORACLE_SQL = None
