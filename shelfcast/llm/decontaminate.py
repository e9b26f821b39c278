"""Benchmark decontamination with suffix arrays of the training documents.

A word is a run of digits, letters a-z (A-Z in lower case) and code points
from U+0080 on. A window is ``WINDOW`` consecutive words of a benchmark item;
an item of fewer words, but not none, is one window. Words of a document that
lie in an occurrence of any window are hit, and a document with a hit word is
contaminated.

Each task cuts its documents into shards of about ``SHARD_BYTES``. A shard's
words become numbers by exact lookup in the benchmark's vocabulary; runs of
known words that are shorter than the shortest window can hold no occurrence
and are left out. The rest gets a suffix array by prefix doubling, as deep as
the longest item. Then all test suffixes (one for each word at which a window
starts) are searched together: word by word, two binary searches narrow the
interval of training suffixes that begin like the test suffix, until none is
left. The interval at the window's length has all occurrences; those after it
give the longest verbatim match and its places. Words are compared, never
hashes, so a match is verbatim.

No shuffle: the benchmark goes to the tasks, in batches of at most
``BATCH_BYTES`` of text (or one item, where that is longer), and documents
stay where they are. With several batches the documents pass once for each,
staged in the shared folder between passes, so neither the driver nor a task
ever holds more than one batch.

Nulls and ties: a null or empty text has no words (zeros, no items, not
contaminated). Null doc_ids and repeated rows are rows of their own. A null
item_id counts as the empty string; rows with one item_id are one item, and
each row has windows of its own. An empty benchmark contaminates nothing; no
documents give no rows. Columns of the input with the names of ``REPORT`` are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, stage_table
from . import common as C

WINDOW = 10
SHARD_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
REPORT = {"n_words": "long", "hit_spans": "array<struct<first:long,end:long>>", "items": "array<string>", "longest": "long"}

_WORD_BYTE = np.full(256, 32, np.uint8)
for _first, _last, _shift in ((48, 57, 0), (65, 90, 32), (97, 122, 0), (128, 255, 0)):
    _WORD_BYTE[_first:_last + 1] = np.arange(_first, _last + 1) + _shift


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(lower-case words as bytes, words before each document) of UTF-8 texts."""
    plain = _WORD_BYTE[data]
    starts, ends, first = C.word_spans(plain, offsets)
    at = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=at[1:])
    held = np.ascontiguousarray(plain[plain != 32])
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(held)]), first


# ---------------------------------------------------------------- benchmark

@dataclass
class Tests:
    """A batch of benchmark items: words as numbers from 1 and, for each test
    suffix, its start and end there, its window's length, item and place."""
    vocabulary: pa.Array
    numbers: np.ndarray
    start: np.ndarray
    end: np.ndarray
    window: np.ndarray
    item: np.ndarray
    place: np.ndarray
    items: list[str]


def compile_tests(rows: list[tuple[str | None, str | None]], window: int = WINDOW) -> Tests:
    texts = pa.array([t or "" for _, t in rows], pa.string())
    names = sorted({i or "" for i, _ in rows})
    number = {x: k for k, x in enumerate(names)}
    found, first = words(*C.raw_text(texts))
    coded = pc.dictionary_encode(found)
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
    count = np.diff(first)
    row = np.repeat(np.arange(len(rows)), count)
    start = np.arange(len(numbers))
    end, place = first[1:][row], start - first[:-1][row]
    width = np.minimum(window, count)[row]
    use = end - start >= width
    item = np.array([number[i or ""] for i, _ in rows], np.int64)[row]
    return Tests(coded.dictionary, numbers, *(x[use] for x in (start, end, width, item, place)), names)


def test_batches(benchmark: DataFrame, batch_bytes: int = BATCH_BYTES, window: int = WINDOW) -> Iterator[Tests]:
    """The benchmark, read row by row, as batches of bounded size."""
    held: list[tuple[str | None, str | None]] = []
    size = 0
    for row in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        more = len((row[1] or "").encode())
        if held and size + more > batch_bytes:
            yield compile_tests(held, window)
            held, size = [], 0
        held.append((row[0], row[1]))
        size += more
    if held:
        yield compile_tests(held, window)


# ---------------------------------------------------------------- search

def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of the non-zero numbers of ``text``, sorted by the numbers that
    follow up to the next zero, ``depth`` of them at least. ``text`` ends with
    a zero."""
    at = np.flatnonzero(text)
    rank = text.astype(np.int64)
    key = rank[at]
    k = 1
    while True:
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        dense = np.empty(len(at), np.int64)
        dense[order] = np.cumsum(np.concatenate([[1], ranked[1:] != ranked[:-1]])) if len(at) else 0
        rank[at] = dense
        if k >= depth or not len(at) or dense.max() == len(at):
            return at[order]
        after = at + k
        key = dense * (len(at) + 1) + np.where(after < len(text), rank[np.minimum(after, len(text) - 1)], 0)
        k *= 2


def _lower_bound(text: np.ndarray, sa: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, want: np.ndarray) -> np.ndarray:
    """For each interval the first place whose number at ``depth`` is not under ``want``."""
    lo, hi = lo.copy(), hi.copy()
    live = np.flatnonzero(lo < hi)
    while len(live):
        mid = (lo[live] + hi[live]) >> 1
        less = text[sa[mid] + depth] < want[live]
        lo[live[less]] = mid[less] + 1
        hi[live[~less]] = mid[~less]
        live = live[lo[live] < hi[live]]
    return lo


@dataclass
class Found:
    """Matches of a shard: intervals (rows lo, hi, words, test suffix) of the
    suffix array; ``windows`` has them at each window's length, ``falls`` the
    places whose longest match with the suffix has just so many words, and
    ``longest`` each suffix's longest match."""
    windows: np.ndarray
    falls: np.ndarray
    longest: np.ndarray


def search(text: np.ndarray, sa: np.ndarray, tests: Tests) -> Found:
    """Binary search of all test suffixes at once, one word deeper each time."""
    alive = np.arange(len(tests.start))
    lo, hi = np.zeros(len(alive), np.int64), np.full(len(alive), len(sa), np.int64)
    padded = np.concatenate([text, np.zeros(1, text.dtype)])
    windows, falls, longest = [], [], []
    depth = 0
    while len(alive):
        more = tests.end[alive] - tests.start[alive] > depth
        want = np.where(more, tests.numbers[np.minimum(tests.start[alive] + depth, len(tests.numbers) - 1)], -1)
        low = np.where(more, _lower_bound(padded, sa, lo, hi, depth, want), lo)
        high = np.where(more, _lower_bound(padded, sa, low, hi, depth, want + 1), lo)
        if depth >= 1:
            is_match = depth >= tests.window[alive]
            at_window = depth == tests.window[alive]
            if at_window.any():
                windows.append(np.stack([lo, hi, np.full(len(lo), depth), alive], 1)[at_window])
            for a, b in ((lo, low), (high, hi)):
                gone = is_match & (b > a)
                if gone.any():
                    falls.append(np.stack([a, b, np.full(len(a), depth), alive], 1)[gone])
            last = is_match & (high <= low)
            if last.any():
                longest.append(np.stack([lo, hi, np.full(len(lo), depth), alive], 1)[last])
        stay = high > low
        alive, lo, hi = alive[stay], low[stay], high[stay]
        depth += 1
    none = np.zeros((0, 4), np.int64)
    return Found(*(np.concatenate(x) if x else none for x in (windows, falls, longest)))


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of every place of the given intervals."""
    n = hi - lo
    row = np.repeat(np.arange(len(lo)), n)
    return row, np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + lo[row]


class Shard:
    """Documents of one shard, searched for the windows of a batch of tests."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, tests: Tests):
        found, self.first = words(data, offsets)
        self.n_words = np.diff(self.first)
        known = pc.fill_null(pc.index_in(found, value_set=tests.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int32) + 1
        doc = np.repeat(np.arange(len(self.n_words)), self.n_words)
        line = np.zeros(len(known) + len(self.n_words) + 1, np.int32)  # a zero after each document
        spot = np.arange(len(known)) + doc
        line[spot] = known
        full = np.concatenate([[False], line > 0, [False]])
        begin, stop = np.flatnonzero(full[1:] & ~full[:-1]), np.flatnonzero(full[:-1] & ~full[1:])
        wide = stop - begin >= (tests.window.min() if len(tests.window) else len(line) + 1)
        edge = np.zeros(len(line) + 1, np.int32)
        edge[begin[wide]] += 1
        edge[stop[wide]] -= 1
        inside = np.cumsum(edge[:-1]) > 0
        chosen = inside | np.concatenate([[False], inside[:-1]])
        self.text = np.where(inside, line, 0)[chosen]
        if not len(self.text):
            self.text = np.zeros(1, np.int32)
        place = np.full(len(line), -1, np.int64)
        place[spot] = np.arange(len(known))
        self.word = place[chosen] if chosen.any() else np.full(1, -1, np.int64)  # word of the shard at each place
        self.doc = doc
        depth = int((tests.end - tests.start).max()) if len(tests.start) else 1
        self.sa = suffix_array(self.text, depth)
        self.tests = tests
        self.found = search(self.text, self.sa, tests)

    def hit(self) -> np.ndarray:
        """Mask of the shard's words that lie in an occurrence of a window."""
        edge = np.zeros(len(self.doc) + 1, np.int64)
        distinct = np.unique(self.found.windows[:, :3], axis=0)  # equal windows have equal intervals
        row, at = _spread(distinct[:, 0], distinct[:, 1])
        begin = self.word[self.sa[at]]
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + distinct[row, 2], -1)
        return np.cumsum(edge[:-1]) > 0

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, item) pairs with an occurrence, sorted."""
        distinct, of = np.unique(self.found.windows[:, :3], axis=0, return_inverse=True)
        of = of.reshape(-1)
        n_items = max(1, len(self.tests.items))
        owner = np.unique(of * n_items + self.tests.item[self.found.windows[:, 3]])
        owner, item = owner // n_items, owner % n_items
        row, at = _spread(distinct[:, 0], distinct[:, 1])
        n_docs = max(1, len(self.n_words))
        held = np.unique(row * n_docs + self.doc[self.word[self.sa[at]]])
        held, doc = held // n_docs, held % n_docs
        pairs = np.zeros(0, np.int64)
        left, right = np.searchsorted(owner, held, "left"), np.searchsorted(owner, held, "right")
        for part in np.array_split(np.arange(len(held)), max(1, int((right - left).sum()) >> 20)):
            k, at = _spread(left[part], right[part])
            pairs = np.unique(np.concatenate([pairs, doc[part][k] * n_items + item[at]]))
        return pairs // n_items, pairs % n_items

    def longest(self) -> np.ndarray:
        """Words of each document's longest verbatim match, 0 without one."""
        out = np.zeros(len(self.n_words), np.int64)
        distinct = np.unique(self.found.falls[:, :3], axis=0)
        row, at = _spread(distinct[:, 0], distinct[:, 1])
        np.maximum.at(out, self.doc[self.word[self.sa[at]]], distinct[row, 2])
        return out


def _merged(old: list[dict] | None, first: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Spans of this batch joined with those of earlier ones, without overlaps."""
    spans = sorted([(x["first"], x["end"]) for x in old or ()] + list(zip(first.tolist(), end.tolist())))
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _shards(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of about SHARD_BYTES."""
    data, offsets = C.raw_text(C.text_column(batch))
    first, n = 0, batch.num_rows
    while first < n:
        last = min(n, max(first + 1, int(np.searchsorted(offsets, offsets[first] + SHARD_BYTES, "right")) - 1))
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def _report(shard: Shard, old: dict[str, pa.Array]) -> list[pa.Array]:
    """The arrays of REPORT for a shard; ``old``: those of earlier batches."""
    hit, (doc, item), longest = shard.hit(), shard.items(), shard.longest()
    same = np.concatenate([[False], shard.doc[1:] == shard.doc[:-1]]) if len(hit) else np.zeros(0, bool)
    before = np.concatenate([[False], hit[:-1]])[:len(hit)] & same
    after = np.concatenate([hit[1:], [False]])[:len(hit)] & np.concatenate([same[1:], [False]])[:len(hit)]
    begin, stop = np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after) + 1
    names = shard.tests.items
    n = len(shard.n_words)
    span_at, item_at = np.searchsorted(begin, shard.first), np.searchsorted(doc, np.arange(n + 1))
    spans, items = [], []
    for i in range(n):
        a, b = span_at[i], span_at[i + 1]
        spans.append(_merged(old["hit_spans"][i].as_py() if old else None, begin[a:b] - shard.first[i], stop[a:b] - shard.first[i]))
        own = [names[k] for k in item[item_at[i]:item_at[i + 1]].tolist()]
        items.append(sorted({*own, *old["items"][i].as_py()}) if old else own)
    if old:
        longest = np.maximum(longest, old["longest"].to_numpy(zero_copy_only=False))
    kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
    return [pa.array(shard.n_words.astype(np.int64)), pa.array([[{"first": a, "end": b} for a, b in x] for x in spans], kind),
            pa.array(items, pa.list_(pa.string())), pa.array(longest, pa.int64())]


def _pass(docs: DataFrame, tests: Tests, carry: Sequence[str], again: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(tests)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.lean()
        known = shared.value
        for batch in batches:
            for first, last, data, offsets in _shards(batch):
                rows = batch.slice(first, last - first)
                old = {c: rows.column(c) for c in REPORT} if again else {}
                arrays = [rows.column(c) for c in carry] + _report(Shard(data, offsets, known), old)
                yield pa.RecordBatch.from_arrays(arrays, names=[*carry, *REPORT])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.mapInArrow(run, ", ".join(filter(None, [schema, *(f"{c} {t}" for c, t in REPORT.items())])))


def scan(docs: DataFrame, benchmark: DataFrame, columns: Sequence[str] | None = None, window: int = WINDOW,
         batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``columns`` of ``docs`` (all, if None) with ``REPORT``: n_words,
    hit_spans (runs of hit words: first, end), items (ids with occurring
    windows, sorted) and longest (words of the longest verbatim match)."""
    kept = [c for c in (docs.columns if columns is None else columns) if c not in REPORT]
    held = None
    batches = test_batches(benchmark, batch_bytes, window)
    tests = next(batches, None) or compile_tests([], window)
    out, again = docs.select(*dict.fromkeys([*kept, "text"])), False
    for following in batches:  # only a benchmark over batch_bytes has more than one batch
        out, path = stage_table(_pass(out, tests, list(dict.fromkeys([*kept, "text"])), again), "decontaminate")
        if held:
            drop_path(docs.sparkSession, held)
        held, tests, again = path, following, True
    return _pass(out, tests, kept, again)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, longest."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["first"])
    return scan(docs, benchmark, ["doc_id"], window).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hit_spans") > 0).alias("contaminated"), "longest")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark."""
    return scan(docs, benchmark, None, window).where(F.size("hit_spans") == 0).select(*[c for c in docs.columns if c not in REPORT])


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """For every test suffix with a match: item_id, place (word of the item),
    n_words (its longest verbatim match over all shards), n_places, and the
    smallest (doc_id, word) where that match starts (a null doc_id first)."""
    out = None
    for tests in test_batches(benchmark, batch_bytes, window):
        shared = docs.sparkSession.sparkContext.broadcast(tests)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            C.lean()
            known = shared.value
            for batch in batches:
                ids = C.id_column(batch)
                for first, _, data, offsets in _shards(batch):
                    s = Shard(data, offsets, known)
                    lo, hi, n, test = s.found.longest.T
                    row, at = _spread(lo, hi)
                    word = s.word[s.sa[at]]
                    doc, word = ids[first + s.doc[word]], word - s.first[s.doc[word]]
                    order = np.lexsort((word, doc, row))
                    begin = order[np.searchsorted(row[order], np.arange(len(lo)))] if len(lo) else order
                    yield pa.RecordBatch.from_arrays([
                        pa.array([known.items[i] for i in known.item[test].tolist()], pa.string()), pa.array(known.place[test]),
                        pa.array(n), pa.array(hi - lo), pa.array(doc[begin]), pa.array(word[begin])],
                        names=["item_id", "place", "n_words", "n_places", "doc_id", "word"])

        rows = docs.select("doc_id", "text").mapInArrow(run, "item_id string, place long, n_words long, n_places long, doc_id long, word long")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id string, place long, n_words long, n_places long, doc_id long, word long")
    by_length = out.groupBy("item_id", "place", "n_words").agg(F.sum("n_places").alias("n_places"), F.min(F.struct("doc_id", "word")).alias("at"))
    best = by_length.groupBy("item_id", "place").agg(F.max_by(F.struct("n_words", "n_places", "at"), "n_words").alias("best"))
    return best.select("item_id", "place", "best.n_words", "best.n_places", F.expr(f"nullif(best.at.doc_id, {int(C.NULL_ID) + 1} - 1)").alias("doc_id"),
                       F.col("best.at.word").alias("word"))


ORACLE = r"""
WITH i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT item, w, least(10, len(w)) AS n, unnest(range(len(w) - least(10, len(w)) + 1)) AS s FROM i WHERE len(w) > 0),
k AS (SELECT DISTINCT item, n, array_to_string(w[s + 1:s + n], ' ') AS key FROM iw),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dw AS (SELECT doc_id, n, w, unnest(range(len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM k) WHERE len(w) >= n),
f AS (SELECT doc_id, item, s, dw.n FROM dw JOIN k ON dw.n = k.n AND array_to_string(dw.w[s + 1:s + dw.n], ' ') = k.key),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM f) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM f) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN m ON d.doc_id = m.doc_id
"""
