"""Document fingerprints from prefix polynomial hashes.

A text's prefix arrays (polynomials over its code points modulo two primes)
give the hash of any span in constant time, so they answer any span equality
and find longest common extensions by binary search (``PrefixHashes``).

A fingerprint is a string drawn from these arrays:

* the length and the hash of the whole text,
* the hashes of the prefixes of lengths 1, 2, ... growing by a fourth root of
  two: the common prefix of two fingerprints is found by binary search,
* the smallest span hash of each of 64 classes of ``SPAN``-code-point spans
  (one-permutation sketch), which survives edits anywhere.

Likeness is 1 for equal texts, else the larger of the common prefix's share
of the longer text and the share of equal sketch entries.

Neighbours: ``with_next`` deals documents to ranges of doc_id whose first ids
are ids of the table, and copies each range's first document to the range
before, so one shuffle gives every document its successor.

Nulls and ties: a null text is empty; a null doc_id comes first in the order;
rows of one doc_id are ordered by text. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Primes and bases of the two polynomials; products fit 63 bits.
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 786433)
SPAN, BINS = 12, 64

RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")

_tables: dict = {}


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and inverse powers, by doubling."""
    if len(_tables.get(which, ((),))[0]) < n:
        size, p = max(n, 1 << 17), PRIMES[which]
        both = []
        for b in (BASES[which], pow(BASES[which], -1, p)):
            out = np.ones(1, np.int64)
            while len(out) < size:
                out = np.concatenate([out, out * pow(b, len(out), p) % p])
            both.append(out)
        _tables[which] = tuple(both)
    return _tables[which]


class PrefixHashes:
    """Prefix arrays of a sequence of code points, possibly after a given
    prefix of another text's arrays."""

    def __init__(self, codes: np.ndarray, base: PrefixHashes | None = None, kept: int = 0):
        self.arrays = []
        for i, p in enumerate(PRIMES):
            terms = (codes.astype(np.int64) + 1) * _power(i, kept + len(codes) + 1)[0][kept:kept + len(codes)] % p
            head = base.arrays[i][:kept + 1] if base else np.zeros(1, np.int64)
            self.arrays.append(np.concatenate([head, (head[-1] + np.cumsum(terms)) % p]))

    def __len__(self) -> int:
        return len(self.arrays[0]) - 1

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each span [start, end), below 2**62."""
        out = []
        for i, p in enumerate(PRIMES):
            a = self.arrays[i]
            out.append((a[ends] - a[starts]) % p * _power(i, len(a))[1][starts] % p)
        return out[0] << 31 | out[1]

    def grams(self, k: int, first: int = 0) -> np.ndarray:
        """Hash of each span of k code points from place ``first`` on."""
        n = len(self) - k + 1
        if n <= first:
            return np.zeros(0, np.int64)
        out = []
        for i, p in enumerate(PRIMES):
            a = self.arrays[i]
            out.append((a[first + k:] - a[first:n] + p) * _power(i, len(a))[1][first:n] % p)
        return out[0] << 31 | out[1]

    def equal(self, a: int, b: int, other: PrefixHashes, c: int, d: int) -> bool:
        """Whether this text's span [a, b) equals the other's [c, d)."""
        if b - a != d - c:
            return False
        return bool(self.spans(np.array([a]), np.array([b]))[0] == other.spans(np.array([c]), np.array([d]))[0])

    def common_extension(self, a: int, other: PrefixHashes, b: int) -> int:
        """Length of the longest common text from places a and b on."""
        low, high = 0, min(len(self) - a, len(other) - b)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.equal(a, a + mid, other, b, b + mid) else (low, mid - 1)
        return low


def grid(n: int) -> np.ndarray:
    """Prefix lengths up to n that a fingerprint holds."""
    if n < 1:
        return np.zeros(0, np.int64)
    steps = np.unique(np.floor(2 ** (np.arange(4 * int(n).bit_length() + 1) / 4)).astype(np.int64))
    return steps[steps <= n]


_EMPTY = np.int64((1 << 62) - 1)


def _least(hashes: np.ndarray) -> np.ndarray:
    """Smallest mixed hash of each class of spans."""
    out = np.full(BINS, _EMPTY)
    if len(hashes):
        x = C.mix(hashes.astype(np.uint64))
        cls = (x & np.uint64(BINS - 1)).astype(np.uint8)
        order = np.argsort(cls, kind="stable")
        ranked = cls[order]
        heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        out[ranked[heads]] = np.minimum.reduceat((x >> np.uint64(2)).astype(np.int64)[order], heads)
    return out


class Fingerprint:
    def __init__(self, n: int, whole: int, prefixes: np.ndarray, sketch: np.ndarray):
        self.n, self.whole, self.prefixes, self.sketch = n, whole, prefixes, sketch

    @classmethod
    def of(cls, h: PrefixHashes, least: np.ndarray) -> Fingerprint:
        n = len(h)
        ends = grid(n)
        whole = int(h.spans(np.array([0]), np.array([n]))[0])
        prefixes = (h.spans(np.zeros_like(ends), ends) & 0xFFFFFF).astype(np.uint32)
        sketch = np.where(least == _EMPTY, 0, least % 65535 + 1).astype("<u2")
        return cls(n, whole, prefixes, sketch)

    def __str__(self) -> str:
        packed = self.prefixes.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
        return f"{self.n:x}.{self.whole:016x}.{base64.b64encode(packed).decode()}.{base64.b64encode(self.sketch.tobytes()).decode()}"

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        n, whole, prefixes, sketch = text.split(".")
        raw = np.frombuffer(base64.b64decode(prefixes), np.uint8).reshape(-1, 3)
        wide = np.zeros((len(raw), 4), np.uint8)
        wide[:, :3] = raw
        return cls(int(n, 16), int(whole, 16), wide.view("<u4").ravel(), np.frombuffer(base64.b64decode(sketch), "<u2"))

    def likeness(self, other: Fingerprint) -> float:
        if self.n == other.n and self.whole == other.whole:
            return 1.0
        longer = max(self.n, other.n)
        low, high = 0, min(len(self.prefixes), len(other.prefixes))
        while low < high:  # equal prefixes come first
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.prefixes[mid - 1] == other.prefixes[mid - 1] else (low, mid - 1)
        common = int(grid(longer)[low - 1]) / longer if low else 0.0
        used = (self.sketch > 0) | (other.sketch > 0)
        alike = float(((self.sketch == other.sketch) & used).sum() / used.sum()) if used.any() else 0.0
        return min(max(common, alike), 1 - 1 / (longer + 1))


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def fingerprint(text: str | None) -> str:
    """Fingerprint of one text (a null text is the empty one)."""
    h = PrefixHashes(codes_of(text or ""))
    return str(Fingerprint.of(h, _least(h.grams(SPAN))))


def with_next(docs: DataFrame, run, schema: str) -> DataFrame:
    """Apply ``run`` (an iterator of (doc_id, text, next text) to an iterator
    of record batches) to the documents of each range of doc_id, in order.
    After the last document comes the first."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce("doc_id", F.lit(int(C.NULL_ID)).cast("long")).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)]) if parts > 1 else F.array(F.lit(0.5))
    row = docs.agg(F.min("doc_id").alias("least"), F.percentile_approx("doc_id", shares, 10 * parts).alias("cuts")).first()
    if row["least"] is None:
        return spark.createDataFrame([], schema)
    cuts = np.unique(np.array([row["least"], *row["cuts"]], np.int64))  # at most one per shuffle partition

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            own = np.searchsorted(cuts, ids, "right") - 1
            heads = np.flatnonzero(cuts[own] == ids)  # copies for the range before
            rows = np.concatenate([np.arange(len(ids)), heads])
            bucket = np.concatenate([own, (own[heads] - 1) % len(cuts)])
            copy = np.repeat([0, 1], [len(ids), len(heads)])
            picked = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int64)), pa.array(copy.astype(np.int32)), *picked.columns],
                                             names=["bucket", "copy", "doc_id", "text"])

    def triples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, str]]:
        held = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "copy", "doc_id", "text"))):
                if held is not None and held[0] == row[0] and not held[1]:
                    yield held[2], held[3], row[3]
                held = row

    return (docs.mapInArrow(deal, "bucket long, copy int, doc_id long, text string")
            .repartition(parts, "bucket").sortWithinPartitions("bucket", "copy", "doc_id", "text")
            .mapInArrow(lambda batches: run(triples(batches)), schema))


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text (the last quarter of
    its code points replaced by the first as many of the next document)."""

    def run(rows: Iterator[tuple[int, str, str]]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        ready = (None, None)  # the next document's fingerprint is the one wanted next
        for doc, text, following in rows:
            n = len(text)
            quarter = n // 4
            head = following[:quarter]
            if ready[0] == text:
                codes, h, grams = ready[1]
            else:
                codes = codes_of(text)
                h = PrefixHashes(codes)
                grams = h.grams(SPAN)
            kept = n - quarter
            shared = max(0, kept - SPAN + 1)
            front, rest = _least(grams[:shared]), _least(grams[shared:])
            own = Fingerprint.of(h, np.minimum(front, rest))
            edited = PrefixHashes(codes_of(head), h, kept)
            changed = Fingerprint.of(edited, np.minimum(front, _least(edited.grams(SPAN, shared))))
            next_codes = codes_of(following)
            next_h = PrefixHashes(next_codes)
            next_grams = next_h.grams(SPAN)
            ready = (following, (next_codes, next_h, next_grams))
            nxt = Fingerprint.of(next_h, _least(next_grams))
            out.append((doc, n, hashlib.sha256((text[:kept] + head).encode()).hexdigest(), str(own), str(changed),
                        own.likeness(changed), own.likeness(nxt)))
            if len(out) == 500:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return with_next(docs, run, RESULT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([
        C.id_array(np.array(cols[0], np.int64)), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
        pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.float64()), pa.array(cols[6], pa.float64()),
    ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
