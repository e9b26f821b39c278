"""Interaction of document filters in every order of application.

Failure conditions of a text (null: empty; words are maximal runs of
``[^\\x20\\x09-\\x0D]``, case-sensitive):

A: under 200 words. B: 100 * distinct words < 50 * words. C: 100 * characters
A-Z > 3 * code points. D: holds any of ``#$%&*|``. E: identical to the text of
any smaller doc_id, in the whole table.

1. One pass over the texts writes a narrow row per document (its part, text
   hash, failures of A to D) to the shared folder; texts are read again only
   for step 2.
2. E by an existential self-join. Hashes that more than one document has are
   counted with partial aggregation; texts of those documents alone meet. The
   right side is pre-aggregated to one row for each hash and exact text with
   its smallest doc_id, so a left semi join on hash, exact text and smaller
   doc_id meets one row for each document, however many copies there are. A
   hash of many copies is dealt over several salts, ``COPIES_PER_SALT`` left
   rows each on average, and the right row stands once under each of them.
3. The ids of E are united with those of the other failures (one bit a filter)
   and summed up to one bit combination for each document; combinations are
   counted by part, quality and toxic label: at most 128 rows a part.
4. The report comes from these counts: 80 pairs of a filter and a set of
   earlier filters, then the 600 steps of the 120 orders.

Nulls and ties: a null lang is the part ''. A null doc_id is neither smaller
nor larger than any other: it never fails E and makes no other text fail.
Rows with one doc_id are documents of their own; equal ones do not make each
other fail. A document is good (toxic) if any row of its labels says so;
without labels it is neither. An empty table has no parts and gives no rows.
Further columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 200, 50, 3
_SPACE = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Repeated hashes, eight bytes each, that a broadcast may hold; more are joined by a shuffle.
BROADCAST_HASHES = 2_000_000
COPIES_PER_SALT = 256
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, hash, hash2 and bits (failures of A to D) of every document."""
    words = F.filter(F.split(_text(), _SPACE), lambda w: w != "")
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), _text().alias("text"), words.alias("words"))
    rows = rows.select("doc_id", "part", "text", F.size("words").cast("long").alias("n"), F.size(F.array_distinct("words")).cast("long").alias("u"))
    size = F.length("text").cast("long")
    upper = size - F.length(F.translate("text", _UPPER, ""))
    tests = {"A": F.col("n") < MIN_WORDS, "B": 100 * F.col("u") < MIN_DISTINCT * F.col("n"), "C": 100 * upper > MAX_UPPER * size,
             "D": F.col("text").rlike(r"[#$%&*|]")}
    bits = sum((F.when(t, BIT[f]).otherwise(0) for f, t in tests.items()), F.lit(0))
    return rows.select("doc_id", "part", F.xxhash64("text").alias("hash"), F.xxhash64(F.lit(1), "text").alias("hash2"), bits.cast("int").alias("bits"))


def later_copies(docs: DataFrame, hashed: DataFrame) -> DataFrame:
    """(doc_id, hash, hash2) of documents whose text a smaller doc_id has.
    ``hashed``: the hash column of all documents."""
    salts = F.floor(F.col("n") / COPIES_PER_SALT).cast("int") + 1
    repeated, _ = stage_table(hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash", salts.alias("salts")), "repeated-texts")
    if repeated.count() <= BROADCAST_HASHES:
        repeated = F.broadcast(repeated)
    texts = (docs.where(F.col("doc_id").isNotNull()).select("doc_id", _text().alias("text")).withColumn("hash", F.xxhash64("text"))
             .join(repeated, "hash"))
    # One column of hash and salt: rows can't be dealt by the hash alone.
    left = texts.withColumn("salted", F.xxhash64("hash", F.pmod(F.xxhash64("doc_id"), "salts").cast("int"))).alias("l")
    first = texts.groupBy("hash", "text").agg(F.min("doc_id").alias("first"), F.first("salts").alias("salts"))
    right = (first.select("hash", "text", "first", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
             .select("text", "first", F.xxhash64("hash", "salt").alias("salted")).alias("r"))
    same = (F.col("l.salted") == F.col("r.salted")) & (F.col("l.text") == F.col("r.text")) & (F.col("r.first") < F.col("l.doc_id"))
    return left.join(right, same, "left_semi").select("doc_id", "hash", F.xxhash64(F.lit(1), "text").alias("hash2"))


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, bits (all five failures), good, toxic, n: documents by combination."""
    rows = stage_table(failures(docs), "filter-failures")[0]
    copies = later_copies(docs, rows.select("hash"))
    of = ["doc_id", "hash", "hash2"]
    marked = copies.select(*of, F.lit(None).cast("string").alias("part"), F.lit(BIT["E"]).alias("bits"), F.lit(0).cast("long").alias("n"))
    own = rows.groupBy(*of, "part", "bits").agg(F.count(F.lit(1)).alias("n"))
    # Rows of one text under one doc_id differ at most in their part: E's ids join every one of them.
    united = own.unionByName(marked).groupBy(*of).agg(
        F.bit_or("bits").alias("bits"), F.collect_set(F.when(F.col("part").isNotNull(), F.struct("part", "n"))).alias("parts"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    each = united.join(known, "doc_id", "left").select("bits", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"), F.inline("parts"))
    return each.groupBy("part", "bits", "good", "toxic").agg(F.sum("n").alias("n"))


def orders(spark) -> DataFrame:
    """The 600 steps of all orders: filter_order, step, own bit, earlier bits."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for i, f in enumerate(order):
            rows.append(("".join(order), i + 1, BIT[f], before))
            before |= BIT[f]
    return spark.createDataFrame(rows, "filter_order string, step int, own int, earlier int")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step; see the contract columns."""
    spark = docs.sparkSession
    counted = combinations(docs, labels)
    steps = orders(spark)
    pairs = F.array(*(F.struct(F.lit(r.own).alias("own"), F.lit(r.earlier).alias("earlier")) for r in steps.select("own", "earlier").distinct().orderBy("own", "earlier").collect()))
    c = F.col
    each = counted.select("*", F.inline(pairs))
    fails, passed = c("bits").bitwiseAND(c("own")) != 0, c("bits").bitwiseAND(c("earlier")) == 0
    here = fails & passed
    total = lambda cond, value=c("n"): F.sum(F.when(cond, value).otherwise(0)).cast("long")
    share = (F.lit(120) / F.greatest(F.lit(1), F.bit_count("bits"))).cast("long")  # a filter comes first among a text's failures in so many orders
    by_pair = each.groupBy("part", "own", "earlier").agg(
        total(passed & ~fails).alias("kept"), total(here).alias("removed"), total(fails & ~passed).alias("redundant"),
        total(c("bits") == c("own")).alias("unique_fails"), total(here & (c("good") == 1)).alias("good_lost"),
        total(here & (c("toxic") == 1)).alias("toxic_lost"), total(fails, c("n") * share).alias("shapley"))
    return by_pair.join(F.broadcast(steps), ["own", "earlier"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT w.r, part, coalesce(good, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS toxic, {
        'A': len(w) < 200,
        'B': 100 * len(list_distinct(w)) < 50 * len(w),
        'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
        'D': regexp_matches(text, '[#$%&*|]'),
        'E': EXISTS (SELECT 1 FROM d x WHERE x.text = w.text AND x.doc_id < w.doc_id)} AS fails
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
g AS (SELECT part, good, toxic, CASE WHEN fails['A'] THEN 'A' ELSE '' END || CASE WHEN fails['B'] THEN 'B' ELSE '' END || CASE WHEN fails['C'] THEN 'C' ELSE '' END
        || CASE WHEN fails['D'] THEN 'D' ELSE '' END || CASE WHEN fails['E'] THEN 'E' ELSE '' END AS failed, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || e.x || z.x AS filter_order FROM x a, x b, x c, x e, x z
      WHERE a.x NOT IN (b.x, c.x, e.x, z.x) AND b.x NOT IN (c.x, e.x, z.x) AND c.x NOT IN (e.x, z.x) AND e.x <> z.x),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS earlier FROM o, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)),
m AS (SELECT s.*, g.*, contains(failed, own) AS fail, length(translate(failed, earlier, '')) < length(failed) AS gone FROM s, g),
t AS (SELECT part, filter_order, step, own,
        CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fail), 0) AS BIGINT) AS kept,
        CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND fail), 0) AS BIGINT) AS removed,
        CAST(coalesce(sum(n) FILTER (WHERE gone AND fail), 0) AS BIGINT) AS redundant,
        CAST(coalesce(sum(n) FILTER (WHERE failed = own), 0) AS BIGINT) AS unique_fails,
        CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND fail AND good), 0) AS BIGINT) AS good_lost,
        CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND fail AND toxic), 0) AS BIGINT) AS toxic_lost
      FROM m GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM t
"""
