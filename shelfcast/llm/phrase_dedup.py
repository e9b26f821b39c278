"""Substring dedup with repeated-phrase automata.

A window is ``window`` consecutive words of one document. Every word covered
by a window that also starts in a document with a smaller doc_id goes.

1. *Recurring phrases.* In each window the k-word phrase with the smallest
   hash is its anchor; equal windows have equal anchors. Blocks of documents
   send their distinct anchor hashes to hash buckets and learn which occur in
   another document too. Nothing else can hold a repeated window.
2. *Recurring passages.* For windows with a recurring anchor, blocks send the
   distinct window hashes (96 bits) with their smallest doc_id and learn
   whether an even smaller doc_id has the window.
3. *Automata.* Runs of windows to remove are joined to passages; each block
   compiles an Aho-Corasick automaton of the passages it holds (its shard of
   all passages) and streams all its documents through it, which marks every
   occurrence.

A passage shared by a third of the corpus is one key per block; no text is
shuffled by phrase and no group grows with the number of copies.

Nulls and ties: a null text has no words; a null doc_id sorts before all
others; rows with the same doc_id are never "smaller" than one another. An
empty table gives an empty result. Columns other than doc_id and text are
ignored by ``dedup_passages``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

WINDOW, PHRASE = 13, 5
#: Symbols an automaton can tell apart (one code point each, without surrogates).
_SYMBOLS = 1_000_000
#: Words of a passage; longer runs are cut into overlapping passages.
_PASSAGE = 200_000

RESULT = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"


def _windows(block: C.Block, window: int, phrase: int):
    """Word spans of a block; for each window in one document, its anchor."""
    starts, ends, first = C.word_spans(block.data, block.offsets)
    hashes = C.word_hashes(block.data, starts, ends)
    anchors = C.sliding_min(C.gram_hashes(hashes, phrase), window - phrase + 1)
    ok = C.same_doc_windows(first, len(hashes), window)
    return starts, ends, first, hashes, anchors, ok


def _anchor_keys(window: int, phrase: int):
    def ask(block: C.Block, _row):
        _, _, first, _, anchors, ok = _windows(block, window, phrase)
        doc = np.searchsorted(first, np.flatnonzero(ok), "right") - 1
        keys, inverse = np.unique(anchors[ok], return_inverse=True)
        low, high = np.full(len(keys), len(block.ids)), np.full(len(keys), -1)
        np.minimum.at(low, inverse, doc)
        np.maximum.at(high, inverse, doc)
        return [keys, (low != high).astype(np.uint8)]
    return ask


def seen_elsewhere(pieces):
    """Reply bits: the key also came from another block, or twice from this one."""
    keys = np.concatenate([p[0] for p in pieces])
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    found = np.zeros(len(keys), bool)
    found[order[1:]] |= same
    found[order[:-1]] |= same
    out, at = [], 0
    for p in pieces:
        n = len(p[0])
        out.append(np.packbits(found[at:at + n] | (p[1] > 0)).tobytes())
        at += n
    return out


def reply_bits(batch: pa.RecordBatch, i: int, name: str, keys: np.ndarray, buckets: int) -> np.ndarray:
    sizes = np.diff(C.bucket_bounds(keys, buckets))
    parts = [np.unpackbits(np.frombuffer(r, np.uint8), count=int(n)) for r, n in zip(C.replies_of(batch, i, name), sizes[sizes > 0])]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def _candidates(block: C.Block, row, window: int, phrase: int, buckets: int):
    """Windows whose anchor recurs: (starts, ends, first, hashes, positions,
    distinct keys, further 32 bits, key of each position, smallest id of each key)."""
    starts, ends, first, hashes, anchors, ok = _windows(block, window, phrase)
    keys = np.unique(anchors[ok])
    recurs = reply_bits(*row, "anchors", keys, buckets)
    at = np.flatnonzero(ok)
    at = at[recurs[np.searchsorted(keys, anchors[at])]]
    grams = C.gram_hashes(hashes, window, salt=1)[at]
    keys, index, inverse = np.unique(grams, return_index=True, return_inverse=True)
    more = (C.gram_hashes(hashes, window, salt=2)[at][index] >> np.uint64(32)).astype(np.uint32)
    doc = block.ids[np.searchsorted(first, at, "right") - 1]
    least = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(least, inverse, doc)
    most = np.full(len(keys), C.NULL_ID)
    np.maximum.at(most, inverse, doc)
    return starts, ends, first, hashes, at, keys, more, inverse, least, most


def _smaller_elsewhere(pieces):
    """Reply bits: another block has the window under a smaller id."""
    keys, more, ids = (np.concatenate([p[j] for p in pieces]) for j in range(3))
    order = np.lexsort((ids, more, keys))
    k, m, d = keys[order], more[order], ids[order]
    head = np.ones(len(k), bool)
    head[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
    least = d[np.flatnonzero(head)][np.cumsum(head) - 1] if len(k) else d
    smaller = np.zeros(len(k), bool)
    smaller[order] = least < d
    cuts = np.cumsum([0] + [len(p[0]) for p in pieces])
    return [np.packbits(smaller[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]


def passages(at: np.ndarray, least: np.ndarray, doc: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """Maximal runs of window starts of one document with one value of
    ``least``, as word spans (first word, last word + 1, least)."""
    if not len(at):
        return []
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at)) - 1
    out = []
    for a, b, m in zip(at[heads].tolist(), (at[tails] + window).tolist(), least[heads].tolist()):
        while b - a > _PASSAGE:
            out.append((a, a + _PASSAGE, m))
            a += _PASSAGE - window + 1
        out.append((a, b, m))
    return out


def occurrences(hashes: np.ndarray, first: np.ndarray, ids: np.ndarray, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Stream all documents through automata of the passages ``found``; mask
    of the words that an occurrence covers in a document with an id above the
    passage's ``least``."""
    import ahocorasick

    mask = np.zeros(len(hashes) + 1, np.int32)
    todo = list(found)
    while todo:
        # One automaton, as many passages as its alphabet has symbols for.
        taken, size = [], 0
        while todo and (not taken or size + todo[-1][1] - todo[-1][0] <= _SYMBOLS):
            a, b, m = todo.pop()
            taken.append((a, b, m))
            size += b - a
        alphabet = np.unique(np.concatenate([hashes[a:b] for a, b, _ in taken]))
        where = np.searchsorted(alphabet, hashes)
        where[where == len(alphabet)] = 0
        code = np.where(alphabet[where] == hashes, where + 1, 0).astype(np.uint32)
        code[code >= 0xD800] += 0x800  # code points without the surrogates
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        stream = code.astype("<u4").tobytes().decode("utf-32-le")
        for a, b, m in taken:
            key = stream[a:b]
            old = automaton.get(key, None)
            if old is None or m < old[1]:
                automaton.add_word(key, (b - a, m))
        automaton.make_automaton()
        for d in range(len(ids)):
            lo, hi, own = int(first[d]), int(first[d + 1]), int(ids[d])
            for end, (length, least) in automaton.iter(stream[lo:hi]):
                if least < own:
                    mask[lo + end + 1 - length] += 1
                    mask[lo + end + 1] -= 1
    return np.cumsum(mask[:-1]) > 0


def dedup_passages(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, joined: bool = True, texts: bool = True,
                   more: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (``joined``:
    kept words joined by one space; else the text with the removed words and
    the white space before them cut out) and the sha256 of kept_text, which
    is null itself if ``texts`` is false; then the columns ``more`` of docs."""
    blocks = C.pack_blocks(docs, "phrase-blocks", more=more)
    kinds = dict(docs.dtypes)
    buckets = C.bucket_count(blocks, 8)
    anchors = C.exchange(blocks, _anchor_keys(window, phrase), seen_elsewhere, buckets, "anchors")
    known = blocks.join(anchors, "block", "left")

    def ask(block, row):
        _, _, _, _, _, keys, more, _, least, _ = _candidates(block, row, window, phrase, buckets)
        return [keys, more, least]

    smaller = C.exchange(known, ask, _smaller_elsewhere, buckets, "smaller")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, block in C.unpack(batch):
                starts, ends, first, hashes, at, keys, _, inverse, least, most = _candidates(block, (batch, i), window, phrase, buckets)
                elsewhere = reply_bits(batch, i, "smaller", keys, buckets)
                least = np.where(elsewhere, C.NULL_ID, least)  # below every id of this block
                cut = elsewhere | (most > least)
                pick = cut[inverse] if len(at) else np.zeros(0, bool)
                at, inverse = at[pick], inverse[pick]
                doc = np.searchsorted(first, at, "right") - 1
                gone = occurrences(hashes, first, block.ids, passages(at, least[inverse], doc, window))
                yield _result(block, starts, ends, first, gone, joined, texts)

    return known.join(smaller, "block", "left").mapInArrow(run, RESULT + "".join(f", `{c}` {kinds[c]}" for c in more))


def _result(block: C.Block, starts, ends, first, gone, joined, texts) -> pa.RecordBatch:
    raw = block.data.tobytes()
    kept, removed = [], []
    s, e = starts.tolist(), ends.tolist()
    for d in range(len(block.ids)):
        a, b = int(first[d]), int(first[d + 1])
        own = gone[a:b]
        removed.append(int(own.sum()))
        if joined:
            text = raw[block.offsets[d]:block.offsets[d + 1]].split()
            kept.append(b" ".join([w for w, x in zip(text, own.tolist()) if not x] if removed[-1] else text))
        elif removed[-1]:
            parts, last = [], int(block.offsets[d])
            for w in (np.flatnonzero(own) + a).tolist():
                cut = e[w - 1] if w > a else int(block.offsets[d])
                parts.append(raw[last:max(last, cut)])
                last = e[w]
            parts.append(raw[last:block.offsets[d + 1]])
            kept.append(b"".join(parts))
        else:
            kept.append(raw[block.offsets[d]:block.offsets[d + 1]])
    rest = block.more.combine_chunks() if block.more else pa.table({})
    return pa.RecordBatch.from_arrays([
        C.id_array(block.ids), pa.array(np.diff(first).astype(np.int64)), pa.array(removed, pa.int64()),
        pa.array(kept if texts else [None] * len(kept), pa.binary()).cast(pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
        *(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rest.columns),
    ], names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256", *rest.column_names])
