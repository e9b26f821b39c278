"""Substring dedup by column-wise suffix sorting of a collection of texts.

Every byte covered by a ``width``-byte string that also starts in a document
with a smaller doc_id goes. Matches never cross documents.

1. *Anchors.* In each window of ``width`` bytes, the k-byte string with the
   smallest hash (leftmost if tied) is its anchor; equal windows have equal
   anchors at equal places. Blocks of documents learn from hash buckets which
   anchors occur elsewhere too, and which have more than ``FREQUENT`` segments.
2. *Collection.* The windows that share one anchor occurrence form a segment,
   a row of at most ``2 * width - k`` bytes lined up by its anchor. A block
   sends its distinct segments with recurring anchors, each with its smallest
   doc_id, to the anchor's bucket. Segments of a frequent anchor go as their
   single windows, distinct in the block, each to the bucket of its own hash,
   so a phrase in ever new surroundings spreads over all buckets.
3. *Columns.* Each bucket sorts its collection column by column from the
   right: a round inserts one symbol per segment, taken in the order of the
   last round (the symbols read in that order are the column's part of the
   collection's Burrows-Wheeler transform), by a stable counting sort, and
   updates the common prefixes of neighbours from the minima of the last
   round's. Neighbours with a common prefix of ``width`` are equal windows;
   the smallest doc_id of each run keeps its own, the others go.

Comparison is byte by byte, so hashes only choose what is compared. The
arrays of a round take the place of the sequential external files of the
construction on one disk: one key brings a bucket at most ``FREQUENT`` segments
or one window of each block, and executors have no folder of their own that
others could read.

Nulls and ties: a null text is empty; a null doc_id sorts before all others;
equal doc_ids are not smaller than one another. An empty table gives an empty
result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C
from .phrase_dedup import reply_bits, seen_elsewhere

WIDTH, ANCHOR = 50, 24
#: Segments of one anchor, distinct in their blocks, that may meet in one bucket.
FREQUENT = 4096

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<long>, kept binary, kept_sha256 string"


class _Segments:
    """The segments of one run of documents of a block: place and hash of the
    anchor, columns of the first and last window, document, and a hash of all."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int, k: int):
        n, w = len(data), width - k + 1
        self.data, self.w, self.width = data, w, width
        p, inverse = C.prefix_hash(data), C.powers(n + 1)[1]
        grams = C.mix((p[k:] - p[:-k]) * inverse[:n - k + 1]) if n >= k else np.zeros(0, np.uint64)
        bits = np.uint64(max(24, n.bit_length()))
        low = C.sliding_min((grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64), w)
        at = np.flatnonzero(C.same_doc_windows(offsets, n, width)) if n >= width else np.zeros(0, np.int64)
        pos = (low[at] & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (pos[1:] != pos[:-1]) | (at[1:] != at[:-1] + 1)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(at))[:len(head)] - 1
        self.pos = pos[head]
        self.lo, self.hi = at[head] - self.pos + w - 1, at[tail] - self.pos + w - 1
        self.anchor = C.mix(grams[self.pos])  # minima are small: mixed anew, they fill all buckets alike
        self.doc = np.searchsorted(offsets, self.pos, "right") - 1
        whole = (p[at[tail] + width] - p[at[head]]) * inverse[at[head]]
        self.identity = C.mix(whole ^ C.mix(self.anchor + (self.lo * 256 + self.hi).astype(np.uint64)))

    def rows(self, pick: np.ndarray) -> np.ndarray:
        columns = np.arange(self.w - 1 + self.width)
        at = self.pos[pick, None] - self.w + 1 + columns
        there = (columns >= self.lo[pick, None]) & (columns < self.hi[pick, None] + self.width)
        return np.where(there, self.data[np.clip(at, 0, len(self.data) - 1)], 0).astype(np.uint8)


def _parts(block: C.Block, width: int, k: int) -> Iterator[tuple[int, int, _Segments]]:
    for a, b in block.chunks():
        lo, hi = block.offsets[a], block.offsets[b]
        yield a, b, _Segments(block.data[lo:hi], block.offsets[a:b + 1] - lo, width, k)


def _anchor_keys(parts: list):
    anchors = np.concatenate([s.anchor for _, _, s in parts])
    doc = np.concatenate([s.doc + a for a, _, s in parts])
    keys, inverse = np.unique(anchors, return_inverse=True)
    low, high = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), -1)
    np.minimum.at(low, inverse, doc)
    np.maximum.at(high, inverse, doc)
    return keys, (low != high).astype(np.uint8), inverse


def _segment_counts(parts: list, keys: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Distinct segments of each anchor."""
    _, one = np.unique(np.concatenate([s.identity for _, _, s in parts]), return_index=True)
    return np.bincount(inverse[one], minlength=len(keys)).astype(np.uint32)


def _recurring(frequent: int):
    """Reply bits of seen_elsewhere, then as many: the anchor is frequent."""
    def answer(pieces):
        keys, inverse = np.unique(np.concatenate([p[0] for p in pieces]), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([p[2] for p in pieces]), minlength=len(keys))
        many = (total > frequent)[inverse]
        cuts = np.cumsum([0] + [len(p[0]) for p in pieces])
        return [seen + np.packbits(many[a:b]).tobytes() for seen, a, b in zip(seen_elsewhere(pieces), cuts[:-1], cuts[1:])]
    return answer


def _frequent_bits(batch: pa.RecordBatch, i: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    sizes = np.diff(C.bucket_bounds(keys, buckets))
    parts = [np.unpackbits(np.frombuffer(r[len(r) // 2:], np.uint8), count=int(n)) for r, n in zip(C.replies_of(batch, i, "anchors"), sizes[sizes > 0])]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


class _Requests:
    """What a block sends of its distinct segments, sorted by key: whole
    segments by anchor, and the distinct windows of ``frequent`` ones by hash."""

    def __init__(self, anchor, lo, hi, least, rows, frequent: np.ndarray, width: int):
        self.whole, hot = np.flatnonzero(~frequent), np.flatnonzero(frequent)
        count = hi[hot].astype(np.int64) - lo[hot] + 1
        self.segment = np.repeat(hot, count)
        self.column = np.arange(len(self.segment)) - np.repeat(np.cumsum(count) - count, count) + lo[self.segment]
        found = np.empty(len(self.segment), np.uint64)
        columns = rows.shape[1]
        for a in range(0, len(hot), 1 << 13):
            run = hot[a:a + (1 << 13)]
            p = C.prefix_hash(rows[run].ravel())
            mine = slice(int(count[:a].sum()), int(count[:a + len(run)].sum()))
            at = (np.searchsorted(run, self.segment[mine])) * columns + self.column[mine]
            found[mine] = C.mix((p[at + width] - p[at]) * C.powers(len(p))[1][at])
        keys, one, self.window = np.unique(found, return_index=True, return_inverse=True)
        low = np.full(len(keys), np.iinfo(np.int64).max)
        np.minimum.at(low, self.window, least[self.segment])
        self.later = least[self.segment] > low[self.window]  # the window's first holder is another segment's
        column = self.column[one].astype(np.uint8)
        place = np.arange(columns)
        there = (place >= column[:, None]) & (place < column[:, None].astype(np.int64) + width)
        key = np.concatenate([anchor[self.whole], keys])
        self.order = np.argsort(key, kind="stable")
        self.arrays = [x[self.order] for x in (
            key, np.concatenate([lo[self.whole], column]), np.concatenate([hi[self.whole], column]), np.concatenate([least[self.whole], low]),
            np.concatenate([rows[self.whole], np.where(there, rows[self.segment[one]], 0).astype(np.uint8)]))]

    def masks(self, replies: np.ndarray, segments: int) -> np.ndarray:
        """Column mask of each distinct segment."""
        answer = np.empty(len(replies), np.uint32)
        answer[self.order] = replies
        out = np.zeros(segments, np.uint32)
        out[self.whole] = answer[:len(self.whole)]
        bit = np.uint32(1) << self.column.astype(np.uint32)
        np.bitwise_or.at(out, self.segment, np.where(self.later, bit, answer[len(self.whole):][self.window] & bit))
        return out


def _collection(block: C.Block, row, width: int, k: int, buckets: int):
    """(parts, per part: picked segments and their distinct segment, anchors,
    lo, hi, smallest id, rows, whether the anchor is frequent) of the block's
    segments with recurring anchors, distinct and sorted by anchor."""
    parts = list(_parts(block, width, k))
    keys, _, inverse = _anchor_keys(parts)
    recurs = reply_bits(*row, "anchors", keys, buckets)[inverse]
    many = _frequent_bits(*row, keys, buckets)
    at, picks, found = 0, [], []
    for a, _, s in parts:
        pick = np.flatnonzero(recurs[at:at + len(s.pos)])
        at += len(s.pos)
        picks.append(pick)
        found.append((s.anchor[pick], s.identity[pick], block.ids[s.doc[pick] + a]))
    anchor, same, ids = (np.concatenate([f[j] for f in found]) for j in range(3))
    order = np.lexsort((same, anchor))
    new = np.ones(len(order), bool)
    new[1:] = (same[order][1:] != same[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    one = order[new]  # one occurrence of each distinct segment
    least = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(least, group, ids)
    which = np.searchsorted(np.cumsum([0] + [len(p) for p in picks]), one, "right") - 1
    lo, hi = np.empty(len(one), np.uint8), np.empty(len(one), np.uint8)
    rows = np.empty((len(one), width - k + width), np.uint8)
    base = np.cumsum([0] + [len(p) for p in picks])
    for j, (_, _, s) in enumerate(parts):
        mine = np.flatnonzero(which == j)
        pick = picks[j][one[mine] - base[j]]
        lo[mine], hi[mine], rows[mine] = s.lo[pick], s.hi[pick], s.rows(pick)
    groups = [group[base[j]:base[j + 1]] for j in range(len(parts))]
    return parts, picks, groups, anchor[one], lo, hi, least, rows, many[np.searchsorted(keys, anchor[one])]


def repeated_windows(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, ids: np.ndarray, width: int) -> np.ndarray:
    """Column-wise construction over a collection of aligned segments. Bit c of
    the result: the window from column c also starts, at column c, in a
    segment with a smaller id."""
    n, columns = rows.shape
    mask = np.zeros(n, np.uint64)
    text = np.ascontiguousarray(rows.T)
    order = np.arange(n)
    prefix = np.zeros(n + 1, np.uint8)  # common prefix of each suffix and the one before it
    for c in range(columns - 1, -1, -1):
        symbols = text[c][order]  # in the order of the suffixes one column on
        s = np.argsort(symbols, kind="stable")
        ranked = symbols[s]
        bounds = np.concatenate([[0], np.flatnonzero(ranked[1:] != ranked[:-1]) + 1, [n]])
        longer = np.zeros(n + 1, np.uint8)
        between = prefix[1:]
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a > 1:
                own = s[a:b]
                longer[a + 1:b] = np.minimum(np.minimum.reduceat(between[:own[-1]], own[:-1]), width - 1) + 1
        order, prefix = order[s], longer
        if c <= columns - width:
            heads = np.flatnonzero(prefix[:n] < width)
            valid = (lo[order] <= c) & (c <= hi[order])
            own = ids[order]
            least = np.minimum.reduceat(np.where(valid, own, np.iinfo(np.int64).max), heads)
            gone = valid & (np.repeat(least, np.diff(np.append(heads, n))) < own)
            mask[order[gone]] |= np.uint64(1 << c)
    return mask


def _answer(width: int):
    def answer(pieces):
        lo, hi, ids, rows = (np.concatenate([p[j] for p in pieces]) for j in range(1, 5))
        mask = repeated_windows(rows, lo, hi, ids, width)
        cuts = np.cumsum([0] + [len(p[0]) for p in pieces])
        return [mask[a:b].astype("<u4").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
    return answer


def dedup_substrings(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, texts: bool = True, frequent: int = FREQUENT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs), spans (their starts and lengths in turn), kept (remaining
    bytes, null unless ``texts``) and its sha256.

    ``width - anchor`` is at most 31 (one reply bit for each column)."""
    if not 0 < width - anchor <= 31:
        raise ValueError("width - anchor must be 1 to 31")
    blocks = C.pack_blocks(docs, "suffix-blocks", C.BLOCK_BYTES // 2)
    buckets = C.bucket_count(blocks, 8)

    def ask(block, _row):
        parts = list(_parts(block, width, anchor))
        keys, twice, inverse = _anchor_keys(parts)
        return [keys, twice, _segment_counts(parts, keys, inverse)]

    anchors = C.exchange(blocks, ask, _recurring(frequent), buckets, "anchors")
    known = blocks.join(anchors, "block", "left")

    def ask_segments(block, row):
        _, _, _, *segments = _collection(block, row, width, anchor, buckets)
        return _Requests(*segments, width).arrays

    shares = C.bucket_count(blocks, 4)
    masks = C.exchange(known, ask_segments, _answer(width), shares, "masks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, block in C.unpack(batch):
                parts, picks, groups, *segments = _collection(block, (batch, i), width, anchor, buckets)
                least = segments[3]
                replies = C.replies_of(batch, i, "masks")
                mask = np.concatenate([np.frombuffer(r, "<u4") for r in replies]) if replies else np.zeros(0, np.uint32)
                mask = _Requests(*segments, width).masks(mask, len(least))
                for (a, b, s), pick, group in zip(parts, picks, groups):
                    first = block.offsets[a]
                    gone = _covered(s, pick, group, mask, least, block.ids[a:b], width)
                    yield _result(block.ids[a:b], s.data, block.offsets[a:b + 1] - first, gone, texts)

    return known.join(masks, "block", "left").mapInArrow(run, RESULT)


def _covered(s: _Segments, pick, group, mask, least, ids, width: int) -> np.ndarray:
    """Mask of the bytes to remove of one run of documents."""
    # A later document with a segment of the block's first holder repeats all of it.
    bits = np.where(ids[s.doc[pick]] > least[group], np.uint32(0xFFFFFFFF), mask[group])
    step = np.zeros(len(s.data) + 1, np.int32)
    for column in range(s.w):
        gone = pick[(bits >> np.uint32(column) & np.uint32(1) > 0) & (s.lo[pick] <= column) & (column <= s.hi[pick])]
        start = s.pos[gone] - s.w + 1 + column  # distinct: a window has one anchor
        step[start] += 1
        step[start + width] -= 1
    return np.cumsum(step[:-1]) > 0


def _result(ids, data, offsets, gone, texts) -> pa.RecordBatch:
    edge = np.zeros(len(gone) + 1, bool)
    edge[:-1] = gone
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    inner = offsets[:-1][(offsets[:-1] < len(gone))]
    begins[inner] = gone[inner]
    total = np.concatenate([[0], np.cumsum(gone)])
    n_begin = np.concatenate([[0], np.cumsum(begins)])
    heads = np.flatnonzero(begins)
    ends = np.concatenate([np.flatnonzero(edge[:-1] & ~edge[1:]) + 1, offsets[1:]])
    ends = np.unique(ends[(ends > 0)])
    stops = ends[np.searchsorted(ends, heads, "right")] if len(heads) else heads
    removed = np.diff(total[offsets])
    raw = data.tobytes()
    kept, spans = [], []
    for d in range(len(ids)):
        a, b = int(offsets[d]), int(offsets[d + 1])
        kept.append(data[a:b][~gone[a:b]].tobytes() if removed[d] else raw[a:b])
        h = slice(int(n_begin[a]), int(n_begin[b]))
        spans.append(np.stack([heads[h] - a, stops[h] - heads[h]], 1).ravel() if h.stop > h.start else np.zeros(0, np.int64))
    return pa.RecordBatch.from_arrays([
        C.id_array(ids), pa.array(np.diff(offsets)), pa.array(removed.astype(np.int64)), pa.array(np.diff(n_begin[offsets]).astype(np.int64)),
        pa.array(spans, pa.list_(pa.int64())), pa.array(kept if texts else [None] * len(kept), pa.binary()),
        pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
    ], names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept", "kept_sha256"])
