"""Line dedup with DataFrame functions only.

A line's key is the line without white space (space, \\t to \\r) at its ends
and with A-Z in lower case. Keys of at least ``MIN_CHARS`` code points found in
at least ``MIN_DOCS`` documents lose all their lines except those in the
largest doc_id that holds them.

1. Each document's long lines become rows of two 64-bit key hashes, document
   and position (no text), staged in the shared folder.
2. Hashes are counted by document with partial aggregation, so a line in a
   third of all documents reaches a reducer once per task; the counts keep the
   repeated hashes with their largest doc_id.
3. Rows of repeated hashes (a join that adaptive execution can split where a
   hash is frequent) are range-partitioned by hash, document and position and
   sorted: a range may end within a frequent hash, as every row carries the
   document that keeps the line. Streaming them drops all but that one.
4. The dropped positions go back as one keep bitmap per document, compressed:
   a map from word number to 64 keep bits that leaves out words without a
   dropped line. Only the bitmaps meet the texts again.

Nulls and ties: a null or empty text is one empty line; a null doc_id sorts
before all others and counts as one document; rows with the same doc_id count
as one document, and each keeps or loses its own lines. An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from . import common as C

MIN_CHARS, MIN_DOCS = 20, 3
_BLANK = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(_BLANK)))


def _identified(docs: DataFrame) -> DataFrame:
    """A row's own name: its doc_id (null: the smallest) and its text's hash."""
    return docs.withColumn("__doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(int(C.NULL_ID)).cast("long"))).withColumn("__row", F.xxhash64("text"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """__doc, __row, __keep (map<int, long>: word number to keep bits) and
    __dropped of every document that loses a line."""
    key = F.col("key")
    rows = (_identified(docs.select("doc_id", "text")).select("__doc", "__row", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
            .where(F.length("line") >= min_chars)
            .select("__doc", "__row", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
            .select(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), "__doc", "__row", "pos"))
    rows = stage_table(rows, "line-hashes")[0]
    repeated = (rows.groupBy("h1", "h2").agg(F.count_distinct("__doc").alias("docs"), F.max("__doc").alias("last"))
                .where(F.col("docs") >= min_docs).drop("docs"))
    found = (rows.join(repeated, ["h1", "h2"])
             .repartitionByRange("h1", "h2", "__doc", "pos").sortWithinPartitions("h1", "h2", F.desc("__doc"), "pos"))
    words = (found.where(F.col("__doc") < F.col("last"))
             .groupBy("__doc", "__row", F.shiftright("pos", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("gone")))
    return words.groupBy("__doc", "__row").agg(
        F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("keep")))).alias("__keep"),
        F.sum(F.bit_count("gone")).cast("long").alias("__dropped"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All columns of ``docs`` with n_lines, n_dropped and kept_text (the
    lines that stay, joined by \\n)."""
    bitmaps = keep_bitmaps(docs, min_chars, min_docs)
    plain = docs.drop("n_lines", "n_dropped", "kept_text")
    joined = _identified(plain).join(bitmaps, ["__doc", "__row"], "left")

    def stays(_line: Column, i: Column) -> Column:
        word = F.coalesce(F.element_at(F.col("__keep"), F.shiftright(i, 6)), F.lit(-1).cast("long"))
        return F.call_function("shiftrightunsigned", word, i.bitwiseAND(63)).bitwiseAND(1) == 1

    kept = F.when(F.col("__keep").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(F.filter(_lines(F.col("text")), stays), "\n"))
    return joined.select(*plain.columns, F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
                         F.coalesce("__dropped", F.lit(0).cast("long")).alias("n_dropped"), kept.alias("kept_text"))


ORACLE = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
f AS (SELECT k.doc_id, k.line, k.pos, r.last IS NOT NULL AND k.doc_id < r.last AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""
