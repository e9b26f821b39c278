"""Helpers shared by the document operators: scratch tables, document blocks,
numpy word and span hashing, and the block <-> bucket exchange.

A *block* is one row holding a few megabytes of whole documents (ids, lengths
and zstd-compressed UTF-8 bytes). Operators that must look at every position
of every text run numpy over blocks and send only distinct hashes through the
shuffle, so a line or passage that a third of all documents share reaches a
reducer once per block, not once per document.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_defaults, stage_table

#: Stands for a null doc_id inside numpy code; sorts before every other id.
NULL_ID = np.iinfo(np.int64).min
#: Uncompressed text bytes of a block. A longer document is a block of its own.
BLOCK_BYTES = 4 << 20
#: Python words are separated by these bytes (space, \t \n \v \f \r).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

BLOCK_SCHEMA = "block long, ids binary, lens binary, data binary, more binary"


def prepare(spark: SparkSession) -> None:
    """Session defaults, only where unset: small Arrow batches keep a Python
    worker's memory bounded when rows are whole documents."""
    ensure_defaults(spark)
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "500"),):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The batch's text with null as the empty string."""
    return pc.fill_null(batch.column(name).cast(pa.string()), "")


def id_column(batch: pa.RecordBatch, name: str = "doc_id") -> np.ndarray:
    return pc.fill_null(batch.column(name).cast(pa.int64()), int(NULL_ID)).to_numpy(zero_copy_only=False)


def id_array(ids: np.ndarray) -> pa.Array:
    """int64 Arrow array; NULL_ID becomes null again."""
    ids = np.asarray(ids, dtype=np.int64)
    return pa.array(ids, mask=ids == NULL_ID)


def raw_text(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


@dataclass
class Block:
    block: int
    ids: np.ndarray      # int64, NULL_ID for null
    offsets: np.ndarray  # int64, one more than ids
    data: np.ndarray     # uint8
    more: pa.Table | None = None  # further columns, row by row

    def texts(self) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist())]

    def chunks(self, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
        """Runs of documents (first, last + 1) of about ``limit`` bytes."""
        first, n = 0, len(self.ids)
        while first < n:
            last = int(np.searchsorted(self.offsets, self.offsets[first] + limit, "right")) - 1
            last = min(n, max(last, first + 1))
            yield first, last
            first = last


def pack_blocks(docs: DataFrame, name: str, block_bytes: int = BLOCK_BYTES, more: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` (doc_id, text and the columns ``more``) as blocks, written to
    the shared folder and reread, so that block numbers stay fixed for every
    later pass. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        lens: list[np.ndarray] = []
        data: list[np.ndarray] = []
        rest: list[pa.Table] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal count, held
            row = pa.RecordBatch.from_arrays([
                pa.array([(part << 32) + count], pa.int64()),
                pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                pa.array([np.concatenate(lens).tobytes()], pa.binary()),
                pa.array([zstandard.ZstdCompressor(level=3).compress(np.concatenate(data).tobytes())], pa.binary()),
                pa.array([ipc_bytes(pa.concat_tables(rest)) if more else None], pa.binary()),
            ], names=["block", "ids", "lens", "data", "more"])
            count, held = count + 1, 0
            ids.clear(), lens.clear(), data.clear(), rest.clear()
            return row

        for batch in batches:
            if not batch.num_rows:
                continue
            own, (raw, off) = id_column(batch), raw_text(text_column(batch))
            first = 0
            while first < len(own):
                last = int(np.searchsorted(off, off[first] + block_bytes - held, "right")) - 1
                last = min(len(own), max(last, first + (not ids)))
                if last > first:
                    ids.append(own[first:last])
                    lens.append(np.diff(off[first:last + 1]))
                    data.append(raw[off[first]:off[last]])
                    if more:
                        rest.append(pa.table({c: batch.column(c) for c in more}).slice(first, last - first))
                    held += int(off[last] - off[first])
                    first = last
                if first < len(own):
                    yield flush()
            if held >= block_bytes:
                yield flush()
        if ids:
            yield flush()

    packed = docs.select("doc_id", "text", *more).mapInArrow(run, BLOCK_SCHEMA)
    return stage_table(packed, name)[0]


def ipc_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def lean() -> None:
    """Hand freed arrays back to the system at once, so that idle Python
    workers don't hold the largest block they have seen (glibc only)."""
    import ctypes

    pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL(None).mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD, no longer adjusted upwards
    except AttributeError:
        pass


def unpack(batch: pa.RecordBatch) -> Iterator[tuple[int, Block]]:
    """(row number, block) of each row of a batch of blocks."""
    import zstandard

    lean()
    cols = [batch.column(c) for c in ("block", "ids", "lens", "data", "more")]
    for i in range(batch.num_rows):
        block, ids, lens, data, more = (c[i].as_py() for c in cols)
        lens = np.frombuffer(lens, np.int64)
        raw = zstandard.ZstdDecompressor().decompress(data)
        yield i, Block(block, np.frombuffer(ids, np.int64), np.concatenate([[0], np.cumsum(lens)]), np.frombuffer(raw, np.uint8),
                       pa.ipc.open_stream(more).read_all() if more else None)


# ---------------------------------------------------------------- hashing

_MULT = 0x9E3779B97F4A7C15 | 1
_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SLOT = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        base = np.full(size, _MULT, np.uint64)
        inv = np.full(size, pow(_MULT, -1, 1 << 64), np.uint64)
        base[0] = inv[0] = 1
        _powers = (np.multiply.accumulate(base), np.multiply.accumulate(inv))
    return _powers


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes modulo 2**64 (length n + 1): the hash of any
    span (a, b) is ``(p[b] - p[a]) * inverse_power[a]``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data) + 1)[0][:len(data)], out=out[1:])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads all bits (for choosing minima and buckets)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each document) of the words of all documents."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:n + 1] = (data != 32) & ((data < 9) | (data > 13))
    edge = offsets[1:-1]
    change = np.flatnonzero(inside[1:] != inside[:-1])  # a start and an end in turn
    starts, ends = change[::2].copy(), change[1::2].copy()
    cut = edge[(edge > 0) & (edge < n)]
    cut = np.unique(cut[inside[cut] & inside[cut + 1]])  # a document ends in a word and the next begins with one
    if len(cut):
        starts = np.sort(np.concatenate([starts, cut]))
        ends = np.sort(np.concatenate([ends, cut]))
    return starts, ends, np.searchsorted(starts, offsets)


_SHORT = 16
#: The low i bytes of eight.
_LOW = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, run: int = 1 << 14) -> np.ndarray:
    """64-bit hash of each word's bytes, ``run`` words at a time. Words of up to
    16 bytes: both halves and the length, each mixed in by a bijection, so no
    pattern of letters cancels out. Longer ones: XXH3."""
    import xxhash

    size = ends - starts
    out = np.empty(len(starts), np.uint64)
    padded = np.concatenate([data, np.zeros(_SHORT, np.uint8)])
    letters = np.ndarray(len(data) + 1, f"V{_SHORT}", padded, strides=(1,))  # the bytes from each place on
    for i in range(0, len(starts), run):
        n = size[i:i + run]
        half = letters[starts[i:i + run]].view("<u8").reshape(-1, 2)
        low, high = half[:, 0] & _LOW[np.minimum(n, 8)], half[:, 1] & _LOW[np.clip(n - 8, 0, 8)]
        out[i:i + run] = mix(low ^ mix(high ^ mix(n.astype(np.uint64) + _SLOT[63])))
    raw = memoryview(padded)
    for k in np.flatnonzero(size > _SHORT).tolist():
        out[k] = xxhash.xxh3_64_intdigest(raw[starts[k]:ends[k]], seed=20240501)
    return out


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As np.unique with the first places and the inverse: only the distinct
    values are sorted, which are far fewer than the words of a block."""
    coded = pa.array(hashes, pa.uint64()).dictionary_encode()
    keys, code = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    order = np.argsort(keys)
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys))
    index = np.empty(len(keys), np.int64)
    index[code[::-1]] = np.arange(len(code))[::-1]  # the last one written is the first place
    return keys[order], index[order], rank[code]


def gram_hashes(words: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of each k consecutive word hashes (length max(0, n - k + 1))."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, (salt * _MULT) & (2 ** 64 - 1), np.uint64)
    for j in range(k):
        out += words[j:j + n] * _SLOT[(j + 17 * salt) % 62]
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by doubling."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    have, cur = 1, x
    while have * 2 <= w:
        cur = np.minimum(cur[:-have], cur[have:])
        have *= 2
    return np.minimum(cur[:n], cur[w - have:w - have + n])


def same_doc_windows(doc_first: np.ndarray, n: int, width: int) -> np.ndarray:
    """Mask of window starts (of n positions) whose window stays in one document."""
    ok = np.ones(max(0, n - width + 1), bool)
    diff = np.zeros(len(ok) + 1, np.int32)
    b = doc_first[1:-1]
    lo, hi = np.maximum(b - width + 1, 0), np.minimum(b, len(ok))
    use = hi > lo
    np.add.at(diff, lo[use], 1)
    np.add.at(diff, hi[use], -1)
    ok &= np.cumsum(diff[:-1]) == 0
    return ok


# ---------------------------------------------------------------- exchange

def bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Positions in sorted uint64 ``keys`` where each bucket begins (and the end)."""
    step = (1 << 64) // buckets + 1
    cuts = np.array([min(i * step, (1 << 64) - 1) for i in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, cuts, "left"), [len(keys)]])


def bucket_count(blocks: DataFrame, per_bucket: float) -> int:
    """Buckets for an exchange: so many blocks' requests fit one reducer."""
    return max(1, math.ceil(blocks.count() / per_bucket))


def exchange(blocks: DataFrame, ask: Callable, answer: Callable, buckets: int, name: str) -> DataFrame:
    """One round of question and answer between blocks and hash buckets.

    ``ask(block, row)`` gives sorted distinct uint64 keys and a list of further
    arrays of the same length. Each bucket gets, from every block, its range
    of keys; ``answer(pieces)`` maps the list of such array lists to one bytes
    reply per piece. Returns (block, replies array<struct<bucket, reply>>),
    staged in the shared folder, so later passes need not ask again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, block in unpack(batch):
                arrays = ask(block, (batch, i))
                bounds = bucket_bounds(arrays[0], buckets)
                full = np.flatnonzero(np.diff(bounds))
                for group in np.array_split(full, max(1, len(full) // 256)):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(group.astype(np.int64)), pa.array(np.full(len(group), block.block, np.int64)),
                        pa.array([pack_arrays([a[bounds[b]:bounds[b + 1]] for a in arrays]) for b in group], pa.binary()),
                    ], names=["bucket", "block", "data"])

    def reduce(table: pa.Table) -> pa.Table:
        lean()
        pieces = [unpack_arrays(x.as_py()) for x in table.column("data")]
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "reply": pa.array(answer(pieces), pa.binary())})

    asked = blocks.mapInArrow(run, "bucket long, block long, data binary")
    replies = asked.groupBy("bucket").applyInArrow(reduce, "block long, bucket long, reply binary")
    gathered = replies.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "reply"))).alias(name))
    return stage_table(gathered, name)[0]


def replies_of(batch: pa.RecordBatch, i: int, name: str) -> list[bytes]:
    """The replies to a block's keys, in the order of the keys."""
    value = batch.column(name)[i].as_py()
    return [x["reply"] for x in value] if value else []


def pack_arrays(arrays: list[np.ndarray]) -> bytes:
    import pickle

    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps([(a.dtype.str, a.shape, np.ascontiguousarray(a).tobytes()) for a in arrays], 5))


def unpack_arrays(data: bytes) -> list[np.ndarray]:
    import pickle

    import zstandard

    return [np.frombuffer(b, d).reshape(s) for d, s, b in pickle.loads(zstandard.ZstdDecompressor().decompress(data))]
