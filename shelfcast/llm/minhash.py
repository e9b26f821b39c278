"""MinHash near-dedup: one-permutation hashing with optimal densification.

A document's set: its distinct ``SHINGLE``-word shingles, A-Z in lower case
(a shorter text: all its words as one). Documents with equal sets are one
vertex, named by their smallest doc_id. Vertices whose sets have a similarity
of ``THRESHOLD`` percent or more are linked; components are closed under links.

1. *Signatures.* One hash of each shingle; its top bits choose one of ``BINS``
   bins and the smallest value of each bin is kept. An empty bin borrows from
   bins tried in an order drawn for that bin until one isn't empty (optimal
   densification). ``BANDS`` bands of ``ROWS`` bins are bucket keys. Sets of up
   to ``SMALL`` shingles fill too few bins to be sure of a common band; they
   and all sets they can be similar to add a prefix of their hashes as keys,
   rarest first, which no similar pair can miss.
2. *Covered shingles.* Blocks of the texts in buckets of several members ask
   hash buckets which shingles another such text holds. The count bounds any
   intersection: an edited copy too far from all others has too many shingles
   of its own and leaves before pairs are formed. No link is lost by this.
   ``SWEEPS`` sweeps count anew among the texts that are left.
3. *Stars.* A bucket's pairs are its members with its hub (the member with the
   smallest part of shingles of its own, so the middle of a group of edited
   copies), not all pairs: as many as members. Pairs that share several buckets
   are checked once; pairs whose covered shingles rule a link out, in all or
   counted by segments of the hashes, or that are in one component already, are
   not formed.
4. *Confirmation.* Pairs are confirmed on full sets of 64-bit shingle hashes.
5. *More stars.* A hub leaves its bucket once all members were held against
   it. Buckets of one first hub become one, and sizes of intersections with it
   bound those of further pairs. Buckets that still hold several components get
   new hubs, until none is left, so no link inside a bucket is lost. The first
   ``STARS`` rounds take one hub a bucket; then their number grows 64-fold
   each round, which bounds rounds by the logarithm of a bucket's size.
6. *Components.* Smallest ids spread along confirmed links, with shortcuts.

Nulls and ties: a null or blank text has the empty set, is linked with nothing
and is its own component; a null doc_id sorts before all others (its component
is null where it is the smallest); rows with the same doc_id are one vertex
wherever their sets are the smallest of their class. An empty table gives an
empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from . import common as C
from .phrase_dedup import reply_bits, seen_elsewhere

SHINGLE, THRESHOLD = 5, 75
BINS, BANDS, ROWS = 126, 42, 3
SMALL, STARS, SWEEPS = 64, 1, 1
SEGMENT_BITS = 5  # covered shingles are counted in 32 segments of the hashes
PREFIXED = SMALL * 100 // THRESHOLD + 1  # largest set that adds a prefix

SETS = "doc long, n_shingles long, s1 long, s2 long, keys array<long>, small array<long>"


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    data, offsets = C.raw_text(texts)
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends, first = C.word_spans(data, offsets)
    words = C.word_hashes(data, starts, ends)
    grams = C.gram_hashes(words, width)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            yield np.unique(grams[a:b - width + 1])
        elif b > a:
            yield C.gram_hashes(words[a:b], b - a, salt=b - a)
        else:
            yield np.zeros(0, np.uint64)


def _borrow_order(bins: int) -> np.ndarray:
    """For each bin, the bins it tries when it is empty."""
    rng = np.random.default_rng(7)
    return rng.integers(0, bins, (64 * bins, bins))


_tries = _borrow_order(BINS)


def signature(hashes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Smallest hash of each bin; empty bins are densified."""
    bin_of = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)  # rises with the hash
    have, index = np.unique(bin_of.astype(np.int64), return_index=True)
    out = np.zeros(bins, np.uint64)
    full = np.zeros(bins, bool)
    out[have], full[have] = hashes[index], True
    empty = np.flatnonzero(~full)
    for row in _tries:
        if not len(empty):
            break
        source = row[empty]
        ok = full[source]
        out[empty[ok]] = out[source[ok]]
        empty = empty[~ok]
    return out


def bands(hashes: np.ndarray) -> np.ndarray:
    """Bands of the signature; none for small sets."""
    if len(hashes) <= SMALL:
        return hashes[:0]
    rows = signature(hashes).reshape(BANDS, ROWS)
    band = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        band = C.mix(band + rows[:, j] * np.uint64(2 * j + 3))
    return np.unique(band)


def prefixes(owners: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(key, vertex, n) of the prefixes of small sets: n - ceil(threshold * n)
    + 1 hashes, those found in the fewest sets first. Two similar sets share
    one of them in any order common to all sets."""
    each = owners.select("vertex", "n", "s1", "s2", F.explode("small").alias("key"))
    rarity = each.groupBy("key").agg(F.count(F.lit(1)).alias("sets"))
    size = (F.col("n") - F.ceil(F.col("n") * threshold / 100) + 1).cast("int")
    first = F.slice(F.array_sort(F.collect_list(F.struct("sets", "key"))), 1, size)
    ordered = each.join(rarity, "key").groupBy("vertex", "n", "s1", "s2").agg(first.alias("first"))  # at most PREFIXED a group
    return ordered.select(F.explode("first.key").alias("key"), "vertex", "n")


def signatures(docs: DataFrame) -> DataFrame:
    """Each document's set size, 128-bit set hash, bands and small set, staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            C.lean()
            n, s1, s2, keys, small = [], [], [], [], []
            texts = C.text_column(batch)
            for i in range(0, len(texts), 200):
                for h in shingle_sets(texts.slice(i, 200)):
                    n.append(len(h))
                    s1.append(np.add.reduce(C.mix(h + np.uint64(11))))
                    s2.append(np.add.reduce(C.mix(h ^ np.uint64(0x5DEECE66D))))
                    keys.append(bands(h).view(np.int64))
                    small.append((h if len(h) <= PREFIXED else h[:0]).view(np.int64))
            yield pa.RecordBatch.from_arrays([
                pa.array(C.id_column(batch)), pa.array(n, pa.int64()), pa.array(np.array(s1, np.uint64).view(np.int64)),
                pa.array(np.array(s2, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64())), pa.array(small, pa.list_(pa.int64())),
            ], names=["doc", "n_shingles", "s1", "s2", "keys", "small"])

    return stage_table(docs.select("doc_id", "text").mapInArrow(run, SETS), "signatures")[0]


def _text_sets(block: C.Block) -> list[np.ndarray]:
    """The sets of a block of texts."""
    lens = block.offsets.astype(np.int32)
    texts = pa.Array.from_buffers(pa.string(), len(block.ids), [None, pa.py_buffer(lens), pa.py_buffer(block.data)])
    sets: list[np.ndarray] = []
    for i in range(0, len(texts), 200):
        sets.extend(shingle_sets(texts.slice(i, 200)))
    return sets


def _kept_sets(block: C.Block) -> list[np.ndarray]:
    """The sets of a block that a sweep has written."""
    hashes, cuts = block.data.view(np.uint64), (block.offsets // 8).tolist()
    return [hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _sweep(blocks: DataFrame, sets_of: Callable, threshold: int) -> DataFrame:
    """Blocks of the sets that can have a link, with ``covered``, staged."""
    buckets = C.bucket_count(blocks, 8)

    def distinct(sets):
        keys, count = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)
        return keys, (count > 1).astype(np.uint8)

    shared = C.exchange(blocks, lambda block, _row: list(distinct(sets_of(block))), seen_elsewhere, buckets, "shared")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for batch in batches:
            for i, block in C.unpack(batch):
                sets = sets_of(block)
                keys, _ = distinct(sets)
                found = reply_bits(batch, i, "shared", keys, buckets)
                shown = [h[found[np.searchsorted(keys, h)] > 0] for h in sets]
                covered = np.array([len(h) for h in shown], np.int64)
                n = np.array([len(h) for h in sets], np.int64)
                pick = np.flatnonzero((n > 0) & (100 * covered >= threshold * n))
                if len(pick):
                    data = zstandard.ZstdCompressor(level=1).compress(np.concatenate([sets[d] for d in pick]).tobytes())
                    parts = pa.array([np.bincount((shown[d] >> np.uint64(64 - SEGMENT_BITS)).astype(np.int64), minlength=1 << SEGMENT_BITS).astype(np.int32) for d in pick], pa.list_(pa.int32()))
                    row = (block.block, block.ids[pick].tobytes(), (8 * n[pick]).tobytes(), data, C.ipc_bytes(pa.table({"covered": covered[pick], "parts": parts})))
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["block", "ids", "lens", "data", "more"])

    return stage_table(blocks.join(shared, "block", "left").mapInArrow(run, C.BLOCK_SCHEMA), "swept")[0]


def linkable_sets(docs: DataFrame, wanted: DataFrame, threshold: int = THRESHOLD, sweeps: int = SWEEPS) -> DataFrame:
    """(vertex, n, covered, parts, hashes binary) of the wanted vertices (column
    ``vertex``), staged. ``covered`` counts the shingles found in another
    wanted text too, ``parts`` the same by segments of the hashes. An intersection holds covered shingles only, so vertices
    with fewer than ``threshold`` percent of them have no link and are left
    out; a further sweep counts among those that are left."""
    texts = (docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(C.NULL_ID)).cast("long")).alias("doc_id"), "text")
             .join(wanted.select(F.col("vertex").alias("doc_id")), "doc_id", "left_semi"))
    swept = _sweep(C.pack_blocks(texts, "near-blocks", C.BLOCK_BYTES // 2), _text_sets, threshold)
    for _ in range(sweeps - 1):
        swept = _sweep(swept, _kept_sets, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, block in C.unpack(batch):
                sets = _kept_sets(block)
                covered, parts = (block.more.column(c).combine_chunks() for c in ("covered", "parts"))
                for j in range(0, len(sets), 200):
                    some = sets[j:j + 200]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(block.ids[j:j + 200]), pa.array([len(h) for h in some], pa.int64()), covered.slice(j, 200), parts.slice(j, 200),
                        pa.array([h.tobytes() for h in some], pa.binary()),
                    ], names=["vertex", "n", "covered", "parts", "hashes"])

    return stage_table(swept.mapInArrow(run, "vertex long, n long, covered long, parts array<int>, hashes binary"), "full-sets")[0]


def confirm(pairs: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs (a, b) with the size of their full sets' intersection
    (``common``) and whether that is similar enough (``linked``), staged."""
    left = sets.select(F.col("vertex").alias("b"), F.col("hashes").alias("of_b"))
    right = sets.select(F.col("vertex").alias("a"), F.col("hashes").alias("of_a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, linked = [], []
            for x, y in zip(batch.column("of_a"), batch.column("of_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                merged = np.concatenate([x, y])
                merged.sort()
                common = int((merged[1:] == merged[:-1]).sum())
                both.append(common)
                linked.append(100 * common >= threshold * (len(x) + len(y) - common) and common > 0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(both, pa.int64()), pa.array(linked, pa.bool_())],
                                             names=["a", "b", "common", "linked"])

    told = pairs.join(left, "b").join(right, "a").mapInArrow(run, "a long, b long, common long, linked boolean")
    return stage_table(told, "checked")[0]


def by_first_hub(members: DataFrame, hubs: DataFrame, checked: DataFrame) -> DataFrame:
    """The members with all buckets of one first hub as one bucket, whose key
    is the hub, and ``via``: the size of the intersection with it where that
    pair was checked (null elsewhere, and where repeated doc_ids gave it
    several sizes). Members that share a bucket still do, and a group that
    fills many buckets is no longer repeated in each."""
    size = checked.groupBy("a", "b").agg(F.min("common").alias("low"), F.max("common").alias("high")).where("low = high").select("a", "b", F.col("low").alias("via"))
    merged = members.drop("via").join(hubs.select("key", "hub"), "key").drop("key").withColumnRenamed("hub", "key").distinct()
    ends = merged.withColumn("a", F.least("vertex", "key")).withColumn("b", F.greatest("vertex", "key"))
    return ends.join(size, ["a", "b"], "left").drop("a", "b")


def hubs_of(members: DataFrame, star: int) -> DataFrame:
    """(key, hub, hub_component, hub_n, hub_covered, hub_via, hub_parts): the hubs of each bucket
    in one round, one in each of ``shares`` shares of its members: the member
    with the smallest part of shingles of its own, which most others resemble.
    members: key, vertex, n, covered, via, parts, component."""
    shares = 64 ** max(0, star - STARS + 1)
    own = (F.col("n") - F.col("covered")) / F.col("n")
    share = F.pmod(F.xxhash64("vertex", F.lit(-1 - star)), F.lit(shares))
    first = F.min(F.struct(own.alias("own"), "vertex", "component", "n", "covered", "via", "parts"))
    hubs = members.groupBy("key", share.alias("share")).agg(first.alias("h"))
    return hubs.select("key", *(F.col(f"h.{c}").alias(f"hub_{c}" if c != "vertex" else "hub") for c in ("vertex", "component", "n", "covered", "via", "parts")))


def star_pairs(members: DataFrame, hubs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs (a < b) of each member of a bucket with the bucket's hubs, where
    components differ and the covered shingles allow a link: an intersection
    of at most ``common`` makes a union of at least n + hub_n - common. With
    the bucket's first hub known (``via``), what both share lies inside it or
    among the other covered shingles, each bounded by itself; so is what both
    share in each segment of the hashes (``parts``)."""
    common = F.least("covered", "hub_covered")
    inside = F.least("via", "hub_via") + F.least(F.col("covered") - F.col("via"), F.col("hub_covered") - F.col("hub_via"))
    common = F.when(F.col("via").isNotNull() & F.col("hub_via").isNotNull(), inside).otherwise(common)
    by_part = F.aggregate(F.zip_with("parts", "hub_parts", lambda a, b: F.least(a, b)), F.lit(0), lambda total, x: total + x)
    fits = [100 * most >= threshold * (F.col("n") + F.col("hub_n") - most) for most in (common, by_part)]
    pairs = members.join(hubs, "key").where((F.col("component") != F.col("hub_component")) & fits[0] & fits[1])
    return pairs.select(F.least("vertex", "hub").alias("a"), F.greatest("vertex", "hub").alias("b")).distinct()


def several_components(members: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component."""
    keys = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    return members.join(keys, "key", "left_semi")


def components(links: DataFrame, name: str = "component") -> DataFrame:
    """(vertex, component: smallest vertex reachable) of all linked vertices,
    staged. Each round every vertex moves to its smallest neighbour's smallest
    neighbour and the links are contracted to the places moved to, until none
    is left; links within a place disappear at once, so rounds shrink fast."""
    spark = links.sparkSession
    edges = links.select("a", "b")
    labels = None
    while not edges.isEmpty():
        ends = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage_table(ends.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("place"), F.least("a", "m").alias("to")), "least")[0]
        further = least.select(F.col("place").alias("to"), F.col("to").alias("moved"))
        moves = stage_table(least.join(further, "to").select("place", "moved"), "moves")[0]
        if labels is None:
            labels = moves.select(F.col("place").alias("vertex"), F.col("moved").alias("label"))
        else:
            of = moves.select(F.col("place").alias("label"), "moved")
            labels = stage_table(labels.join(of, "label", "left").select("vertex", F.coalesce("moved", "label").alias("label")), "labels")[0]
        first = moves.select(F.col("place").alias("a"), F.col("moved").alias("x"))
        second = moves.select(F.col("place").alias("b"), F.col("moved").alias("y"))
        left = edges.join(first, "a").join(second, "b").where("x <> y")
        edges = stage_table(left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "contracted")[0]
    if labels is None:
        return spark.createDataFrame([], f"vertex long, {name} long")
    return labels.select("vertex", F.col("label").alias(name))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the smallest of its
    component) of every document."""
    spark = docs.sparkSession
    signed = signatures(docs)
    filled = signed.where("n_shingles > 0")
    classes = filled.groupBy("s1", "s2", "n_shingles").agg(F.min("doc").alias("vertex"))
    classes = stage_table(classes, "classes")[0]
    owners = filled.join(classes, ["s1", "s2", "n_shingles"]).where("doc = vertex").dropDuplicates(["s1", "s2", "n_shingles"])
    owners = stage_table(owners.select("vertex", F.col("n_shingles").alias("n"), "s1", "s2", "keys", "small"), "owners")[0]
    buckets = owners.select(F.explode("keys").alias("key"), "vertex", "n").unionAll(prefixes(owners))
    buckets = stage_table(buckets.distinct(), "buckets")[0]
    rest = several_components(buckets.withColumn("component", F.col("vertex")))
    rest = stage_table(rest, "members")[0]  # most keys have one member
    sets = linkable_sets(docs, rest.select("vertex").distinct())
    # Repeated doc_ids can have several sets of one size: bounds are those of all.
    most = [F.max(F.col("parts")[k]) for k in range(1 << SEGMENT_BITS)]
    covered = sets.groupBy("vertex", "n").agg(F.max("covered").alias("covered"), F.array(*most).alias("parts"))
    rest = rest.join(covered, ["vertex", "n"]).withColumn("via", F.lit(None).cast("long"))
    rest = stage_table(several_components(rest), "linkable")[0]
    links = spark.createDataFrame([], "a long, b long")
    tested, labels, star = links, None, 0
    while not rest.isEmpty():
        hubs = hubs_of(rest, star)
        pairs = star_pairs(rest, hubs)
        if star:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        checked = confirm(pairs, sets)
        found = checked.where("linked").select("a", "b").distinct()
        tested = tested.unionAll(checked.select("a", "b"))
        # A hub has met all members of its bucket that it can be linked with.
        rest = rest.join(hubs.select("key", F.col("hub").alias("vertex"), F.col("hub_n").alias("n")), ["key", "vertex", "n"], "left_anti")
        if not star:
            rest = stage_table(by_first_hub(rest, hubs, checked), "by-first-hub")[0]
        if not found.isEmpty():
            links = stage_table(links.unionAll(found), "all-links")[0]
            labels = components(links)
            rest = rest.drop("component").join(labels, "vertex", "left").withColumn("component", F.coalesce("component", "vertex"))
        rest = stage_table(several_components(rest.select("key", "vertex", "n", "covered", "via", "parts", "component")), "rest")[0]
        star += 1
    if labels is None:
        labels = spark.createDataFrame([], "vertex long, component long")
    of_class = classes.join(labels, "vertex", "left").select("s1", "s2", "n_shingles", F.coalesce("component", "vertex").alias("class_component"))
    joined = signed.select("doc", "n_shingles", "s1", "s2").join(of_class, ["s1", "s2", "n_shingles"], "left")
    component = F.coalesce("class_component", "doc")
    visible = [F.when(c != int(C.NULL_ID), c) for c in (F.col("doc"), component)]
    return joined.select(visible[0].alias("doc_id"), "n_shingles", visible[1].alias("component_id"), (F.col("doc") == component).alias("kept"))
