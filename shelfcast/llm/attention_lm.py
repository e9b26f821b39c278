"""Language-model scores: causal self-attention over subword ids, in numpy.

A text's tokens are its words, A-Z in lower case, and one end. A word's subword
ids, all of them, come from a public tokenizer (each distinct word segmented once
per worker).
All training documents (crc32 of doc_id as text, modulo 10, not 0) are learned
from, in these Spark jobs:

* *Word counts*, by an exchange between blocks and hash buckets. They give the
  base score, the smoothed unigram of each token, and the counts of the words
  that begin with each subword id.
* *Classes of ids.* The most frequent first ids are classes of their own; the
  others are grouped by frequency and by the kind of text (languages, mostly)
  in which they are usual. Kinds are clusters of the ``ANCHORS`` most frequent
  ids by the documents they share; a document is of the kind most of its
  anchors are of; an id that is usual in no kind is of the mixed one.
* *Attention.* One layer of causal self-attention over the last ``CONTEXT``
  tokens predicts the class of the next token's first id. A token's embedding is
  that of its first id's class and those of its further ids' classes. It starts
  as the classes' unigram. The training documents are dealt into as many parts
  as there are rounds (``ROUNDS``); in each round every task runs Adam over all
  windows of its documents of that part and the weights are averaged by windows.
  Every token of every training document is learned from once.

* *Further ids.* A second causal layer runs inside the words: from the first id's
  class and the ids before it predicts the class of a word's second and every
  later id, and where the word ends. It learns every distinct training word once,
  in as many rounds: it stands for words that the counts know little of.

A word's probability is that of its class times that of the word in its class:
(its count + m q) / (the class's count + m), where q is the product over the first
id in its class, all further ids and the word's end, by the second layer, and m is
``SHARED`` for each distinct training word of the class and one unseen one. Without
the second layer (``fit`` without ``further``) m q is 0.1 for each of these words.

Texts are scored in overlapping windows of ``CONTEXT`` tokens: all windows of a
batch go through one masked attention, and each token is scored once, in the
first window for a text's first tokens and with at least ``OVERLAP`` tokens
before it else.

Nulls and ties: a null text has the end alone; a null doc_id is a training
document; rows are scored one by one. Without any training document every
token has the count 0 and the classes are uniform. An empty table gives an
empty result.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

CONTEXT, OVERLAP, DIM = 16, 4, 16
KINDS, BANDS, SINGLE, ANCHORS = 5, (256, 1024, 4096), 103, 64
#: The end, single ids, and every band of every kind and of the mixed one.
CLASSES = 1 + SINGLE + (len(BANDS) + 1) * (KINDS + 1)
_CLASS = np.uint8 if CLASSES <= 256 else np.int16
_INPUT = np.uint8 if 2 * CLASSES <= 256 else np.int16
ROUNDS, BATCH, RATE = 4, 64, 0.02
#: Of the layer inside words: words of a step (a word has few places), and the
#: count of a distinct training word that goes to all words that may begin so.
WORD_BATCH, SHARED = 256, 0.5

RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 10 == 0, F.lit(False))


def _is_held_out(ids: np.ndarray) -> np.ndarray:
    return np.array([i != C.NULL_ID and zlib.crc32(b"%d" % i) % 10 == 0 for i in ids.tolist()], bool)


def _words(block: C.Block):
    """Lower-cased bytes, word spans, words before each document, hashes."""
    data = np.frombuffer(block.data.tobytes().lower(), np.uint8)  # bytes: A-Z alone
    starts, ends, first = C.word_spans(data, block.offsets)
    return data, starts, ends, first, C.word_hashes(data, starts, ends)


# ------------------------------------------------------------ word counts

def _ask(block: C.Block, _row):
    _, _, _, first, hashes = _words(block)
    keys, _, inverse = C.distinct(hashes)
    learns = np.repeat(~_is_held_out(block.ids), np.diff(first))
    return [keys, np.bincount(inverse[learns], minlength=len(keys)).astype(np.uint32)]


def _total(pieces):
    """Each key's count over all blocks, and whether the piece is its first."""
    keys = np.concatenate([p[0] for p in pieces])
    counts = np.concatenate([p[1] for p in pieces]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    head = np.ones(len(keys), bool)
    head[1:] = ranked[1:] != ranked[:-1]
    group = np.cumsum(head) - 1
    sums = np.bincount(group, weights=counts[order]).astype(np.int64)
    total, owner = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    total[order], owner[order] = sums[group], head
    cuts = np.cumsum([0] + [len(p[0]) for p in pieces])
    return [C.pack_arrays([total[a:b], owner[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]


ENCODED = "block long, ids binary, words binary"


def encode(known: DataFrame, tokenizer: str) -> DataFrame:
    """Blocks joined with their word counts as numbers, staged: words before
    each document, each word's place among the block's distinct words, and
    those words' training counts, whether the block owns them, first ids, numbers
    of further ids and these. Later passes need neither text nor tokenizer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sub = Subwords.of_worker(tokenizer)
        for batch in batches:
            for i, block in C.unpack(batch):
                data, starts, ends, first, hashes = _words(block)
                keys, index, inverse = C.distinct(hashes)
                replies = [C.unpack_arrays(r) for r in C.replies_of(batch, i, "counts")]
                count, owner = (np.concatenate([np.zeros(0, t), *(r[j] for r in replies)]).astype(t) for j, t in enumerate((np.int64, bool)))
                raw = data.tobytes()
                word_ids = sub.ids_by_hash(keys, lambda new: [raw[a:b] for a, b in zip(starts[index[new]].tolist(), ends[index[new]].tolist())])  # noqa: B023
                yield pa.RecordBatch.from_arrays([
                    pa.array([block.block], pa.int64()), pa.array([block.ids.tobytes()], pa.binary()),
                    pa.array([C.pack_arrays([first, inverse.astype(np.uint32), count, owner, *word_ids])], pa.binary()),
                ], names=["block", "ids", "words"])

    return C.stage_table(known.mapInArrow(run, ENCODED), "lm-encoded")[0]


def _encoded(batch: pa.RecordBatch):
    """(block, doc ids, first, inverse, count, owner, first ids, numbers of
    further ids, further ids) of each row."""
    C.lean()
    for i in range(batch.num_rows):
        block, ids, words = (batch.column(c)[i].as_py() for c in ("block", "ids", "words"))
        yield block, np.frombuffer(ids, np.int64), *C.unpack_arrays(words)


def _summed(encoded: DataFrame, keys: tuple[str, ...], add: Callable, shape: tuple[int, ...]) -> np.ndarray:
    """Sum over all blocks of the integers that ``add(total, row)`` adds to an
    array of this shape: each task sends its non-zero cells, Spark adds them up.
    The shape is a matter of the vocabulary and the settings, not of the data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.int64)
        for batch in batches:
            for row in _encoded(batch):
                add(total, row)
        some = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in some), pa.array(total[some], pa.int64())], names=[*keys, "n"])

    cells = encoded.mapInArrow(run, ", ".join(f"{k} long" for k in (*keys, "n"))).groupBy(*keys).agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(shape, np.int64)
    out[tuple(cells.column(k).to_numpy() for k in keys)] = cells.column("n").to_numpy()
    return out


def id_counts(encoded: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Training words and distinct training words that begin with each id; a
    distinct word is counted by the block that owns it in the exchange."""

    def add(total, row):
        count, owner, first_id = row[4:7]
        mine = np.flatnonzero(owner & (count > 0))
        np.add.at(total[0], first_id[mine], count[mine])
        total[1] += np.bincount(first_id[mine], minlength=size)

    words, distinct = _summed(encoded, ("what", "id"), add, (2, size))
    return words, distinct


def further_counts(encoded: DataFrame, size: int) -> np.ndarray:
    """Distinct training words' further ids: how often each id is among them."""

    def add(total, row):
        _, _, _, _, count, owner, _, more, further = row
        total += np.bincount(further[np.repeat(owner & (count > 0), more)], minlength=size)

    return _summed(encoded, ("id",), add, (size,))


# ------------------------------------------------------------ classes of ids

def _in_training(row):
    """(document, first id) of each word of the block's training documents."""
    ids, first, inverse, first_id = *row[1:4], row[6]
    doc = np.repeat(np.arange(len(ids)), np.diff(first))
    learns = ~_is_held_out(ids)[doc]
    return doc[learns], first_id[inverse[learns]].astype(np.int64)


def _anchor_counts(doc: np.ndarray, first_id: np.ndarray, slot: np.ndarray, docs: int, anchors: int) -> np.ndarray:
    at = slot[first_id]
    use = at >= 0
    return np.bincount(doc[use] * anchors + at[use], minlength=docs * anchors).reshape(docs, anchors)


def kinds_of_anchors(shared: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Kind (0 to KINDS - 1) of each anchor, by spherical k-means over the
    numbers of documents it shares with every anchor."""
    alone = np.sqrt(np.maximum(1, np.diag(shared)))
    like = shared / alone[:, None] / alone
    like /= np.maximum(1e-9, np.linalg.norm(like, axis=1, keepdims=True))
    centre = like[:1]
    for _ in range(KINDS - 1):  # start from anchors unlike those taken
        centre = np.concatenate([centre, like[(like @ centre.T).max(1).argmin()][None]])
    for _ in range(rounds):
        own = (like @ centre.T).argmax(1)
        centre = np.stack([like[own == j].sum(0) if (own == j).any() else centre[j] for j in range(KINDS)])
        centre /= np.maximum(1e-9, np.linalg.norm(centre, axis=1, keepdims=True))
    return (like @ centre.T).argmax(1)


def kinds_of_ids(encoded: DataFrame, words: np.ndarray) -> np.ndarray:
    """Kind of text in which each id is usual; KINDS if it is in none."""
    size = len(words)
    anchors = np.argsort(-words, kind="stable")[:ANCHORS]
    slot = np.full(size, -1)
    slot[anchors] = np.arange(len(anchors))

    def share(total, row):
        held = (_anchor_counts(*_in_training(row), slot, len(row[1]), len(anchors)) > 0).astype(np.float32)
        total += (held.T @ held).astype(np.int64)

    of_anchor = kinds_of_anchors(_summed(encoded, ("a", "b"), share, (len(anchors),) * 2))

    def spread(total, row):
        doc, first_id = _in_training(row)
        by_kind = _anchor_counts(doc, first_id, slot, len(row[1]), len(anchors)) @ np.eye(KINDS, dtype=np.int64)[of_anchor]
        total += np.bincount(by_kind.argmax(1)[doc] * size + first_id, minlength=KINDS * size).reshape(KINDS, size)

    by_kind = _summed(encoded, ("kind", "id"), spread, (KINDS, size)).astype(float)
    rate = (by_kind + 0.01) / (by_kind.sum(1, keepdims=True) + 1)
    rate /= rate.sum(0)
    return np.where(rate.max(0) > 0.6, rate.argmax(0), KINDS)


def classes_of_ids(words: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Class of each id and, last, of the end (0)."""
    order = np.argsort(-words, kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    cls = 1 + SINGLE + (len(BANDS) + 1) * kind + np.searchsorted(BANDS, rank, "right")
    cls[order[:SINGLE]] = 1 + np.arange(len(order[:SINGLE]))
    return np.append(cls, 0).astype(np.int16)


# ------------------------------------------------------------ attention

@dataclass
class Attention:
    """One causal layer: embeddings e (and f of further ids), places p, query,
    key, value and output matrices, and class logits u, b; the class of each id;
    log10 of each class's smoothed count; and the layer inside words."""

    weights: dict[str, np.ndarray]
    cls: np.ndarray
    log_size: np.ndarray
    further: Further | None = None


@dataclass
class Further:
    """The layer inside words; by id its class as a further id, log10 of its
    share as a first id in ``Attention.cls`` and as a further one in ``cls``; and
    log10 of the count that each class's words get by this layer."""

    weights: dict[str, np.ndarray]
    cls: np.ndarray
    log_first: np.ndarray
    log_further: np.ndarray
    log_mass: np.ndarray


def start_weights(classes: int = CLASSES, dim: int = DIM, context: int = CONTEXT) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(3)
    shapes = {"e": (classes, dim), "p": (context, dim), "q": (dim, dim), "k": (dim, dim), "v": (dim, dim), "o": (dim, dim), "u": (dim, classes), "b": (classes,)}
    return {n: (rng.normal(0, 0.3, s) if n != "b" else np.zeros(s)).astype(np.float32) for n, s in shapes.items()}


def _exp_rows(z: np.ndarray, shown: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """z becomes exp(z - shift) where ``shown`` (0 elsewhere); with its sums by
    row and the shift: the largest value of all rows (one number) where no
    value is far below it, each row's own else."""
    shift = z.max(initial=-np.inf)
    if len(z) and z.min() < shift - 40:
        shift = (z if shown is None else np.where(shown > 0, z, -np.inf)).max(1)
        z -= shift[:, None]
        np.minimum(z, 0, out=z)
    else:
        z -= shift
    np.exp(z, out=z)
    if shown is not None:
        z *= shown
    return z, z @ np.ones(z.shape[1], z.dtype), shift


@functools.lru_cache(4)
def _earlier(n: int, t: int, kind: np.dtype) -> np.ndarray:
    """1 where a place of n windows sees another one: no place sees a later one."""
    return np.tile(np.tril(np.ones((t, t), kind)), (n, 1))


def _turned(a: np.ndarray) -> np.ndarray:
    """Each window's matrix transposed, as a copy: many small products of
    transposed views take longer than the copy."""
    return np.ascontiguousarray(a.transpose(0, 2, 1))


def _logits(w: dict[str, np.ndarray], top: np.ndarray) -> np.ndarray:
    """top @ u + b as one product."""
    wide = np.empty((len(top), top.shape[1] + 1), top.dtype)
    wide[:, :-1], wide[:, -1] = top, 1
    return wide @ np.concatenate([w["u"], w["b"][None]])


@dataclass
class Bags:
    """Further ids of the words that the places of some windows see: the classes,
    the place of each (ascending), and the places that have any with their starts."""

    cls: np.ndarray
    place: np.ndarray
    filled: np.ndarray
    start: np.ndarray

    @classmethod
    def of(cls, word: np.ndarray, bounds: np.ndarray, further: np.ndarray) -> Bags:
        """word: by place, as its place among ``bounds``; the word's classes are
        further[bounds[word]:bounds[word + 1]]."""
        word = word.ravel()
        first = bounds.take(word)
        more = bounds.take(word + 1) - first
        start = np.cumsum(more) - more
        filled = np.flatnonzero(more)
        at = np.repeat(first - start, more) + np.arange(int(more.sum()))
        return cls(further.take(at), np.repeat(np.arange(len(word)), more), filled, start.take(filled))


def hidden(w: dict[str, np.ndarray], x: np.ndarray, bags: Bags | None = None):
    """The layer's output at each place of the windows x (windows, places), and
    what the gradient needs."""
    n, t = x.shape
    d = w["e"].shape[1]
    h = w["e"].take(x, 0)
    h += w["p"][:t]
    if bags is not None and len(bags.cls):
        h.reshape(-1, d)[bags.filled] += np.add.reduceat(w["f"].take(bags.cls, 0), bags.start)
    flat = h.reshape(-1, d)
    qkv = flat @ np.concatenate([w[m] for m in "qkv"], 1)
    q, k, v = (qkv[:, i:i + d].reshape(n, t, d) for i in (0, d, 2 * d))
    s = q @ _turned(k)
    s /= np.float32(np.sqrt(d))
    s, total, _ = _exp_rows(s.reshape(n * t, t), _earlier(n, t, s.dtype))
    s /= total[:, None]
    s = s.reshape(n, t, t)
    mixed = s @ v
    return h + (mixed.reshape(-1, d) @ w["o"]).reshape(n, t, d), (h, q, k, v, s, mixed)


def forward(w: dict[str, np.ndarray], x: np.ndarray, bags: Bags | None = None):
    """Log probabilities of the next class after each place of the windows x,
    and what the gradient needs."""
    top, rest = hidden(w, x, bags)
    z = (top.reshape(-1, top.shape[-1]) @ w["u"] + w["b"]).reshape(*x.shape, -1)
    z -= z.max(-1, keepdims=True)
    z -= np.log(np.exp(z).sum(-1, keepdims=True))
    return z, (*rest, top)


def log_of(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, use: np.ndarray, bags: Bags | None = None) -> np.ndarray:
    """Log probabilities of the classes y at the places to use, in order."""
    at = np.flatnonzero(use)
    z = _logits(w, hidden(w, x, bags)[0].reshape(-1, w["e"].shape[1]).take(at, 0))
    own = z[np.arange(len(z)), y.ravel().take(at)]
    _, total, shift = _exp_rows(z)
    return own - shift - np.log(total)


def _by_class(like: np.ndarray, cls: np.ndarray, rows: np.ndarray, place: np.ndarray | None = None) -> np.ndarray:
    """Sums by class of the rows, or of those at the places."""
    out = np.zeros_like(like)
    if len(cls):
        order = np.argsort(cls.astype(np.int16), kind="stable")
        ranked = cls.take(order)
        head = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        out[ranked[head]] = np.add.reduceat(rows.take(order if place is None else place.take(order), 0), head)
    return out


def gradients(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, use: np.ndarray, bags: Bags | None = None) -> dict[str, np.ndarray]:
    """Of the mean negative log probability of the classes y where ``use``;
    only these places reach the class layer."""
    top, (h, q, k, v, s, mixed) = hidden(w, x, bags)
    n, t = x.shape
    d = h.shape[-1]
    at = np.flatnonzero(use)
    used = top.reshape(-1, d).take(at, 0)
    dz, total, _ = _exp_rows(_logits(w, used))
    dz /= len(at) * total[:, None]
    dz[np.arange(len(at)), y.ravel().take(at)] -= 1 / max(1, len(at))
    g = {"u": used.T @ dz, "b": dz.sum(0)}
    dtop = np.zeros((n * t, d), dz.dtype)
    dtop[at] = dz @ w["u"].T
    dtop = dtop.reshape(n, t, d)
    g["o"] = mixed.reshape(-1, d).T @ dtop.reshape(-1, d)
    dmixed = (dtop.reshape(-1, d) @ w["o"].T).reshape(n, t, d)
    ds = dmixed @ _turned(v)
    ds *= s
    ds -= s * (ds @ np.full(t, 1, ds.dtype))[..., None]
    ds /= np.float32(np.sqrt(d))
    dh = dtop.copy()
    for m, of in (("q", ds @ k), ("k", ds.transpose(0, 2, 1) @ q), ("v", s.transpose(0, 2, 1) @ dmixed)):
        g[m] = h.reshape(-1, d).T @ of.reshape(-1, d)
        dh += (of.reshape(-1, d) @ w[m].T).reshape(n, t, d)
    g["p"] = np.zeros_like(w["p"])
    g["p"][:t] = dh.sum(0)
    g["e"] = _by_class(w["e"], x.ravel(), dh.reshape(-1, d))
    if bags is not None:
        g["f"] = _by_class(w["f"], bags.cls, dh.reshape(-1, d), bags.place)
    return g


def adam(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, use: np.ndarray, state: dict, rate: float, bags: Bags | None = None) -> None:
    """One step on a batch of windows, in place."""
    state["step"] = step = state.get("step", 0) + 1
    found = gradients(w, x, y, use, bags)
    g = np.concatenate([found[n].ravel() for n in w])
    m, v = state.get("moments", (np.zeros_like(g), np.zeros_like(g)))
    state["moments"] = m, v
    m *= 0.9
    m += 0.1 * g
    v *= 0.98
    g *= g
    v += 0.02 * g
    change = np.sqrt(v / (1 - 0.98 ** step))
    change += 1e-8
    np.divide(m, change, out=change)
    change *= rate / (1 - 0.9 ** step)
    first = 0
    for a in w.values():
        a -= change[first:first + a.size].reshape(a.shape)
        first += a.size


def windows(cls: np.ndarray, bounds: np.ndarray):
    """Overlapping windows over the texts cls[bounds[i]:bounds[i + 1]]: inputs
    (each place sees the class before it; the end stands before a text),
    targets, which places are scored, and the places' numbers in cls."""
    lengths = np.diff(bounds)
    stride = CONTEXT - OVERLAP
    cls = cls.astype(np.int32)
    n = np.maximum(1, -(-(lengths - OVERLAP) // stride))
    text = np.repeat(np.arange(len(lengths)), n)
    offset = (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * stride
    place = offset[:, None] + np.arange(CONTEXT)
    inside = place < lengths[text][:, None]
    at = np.where(inside, bounds[:-1][text][:, None] + place, 0)
    x = np.where(inside & (place > 0), cls[np.maximum(at - 1, 0)], 0)
    use = inside & ((offset == 0)[:, None] | (np.arange(CONTEXT) >= OVERLAP))
    return x, np.where(inside, cls[at], 0), use, at


def word_windows(first_cls: np.ndarray, more: np.ndarray, further: np.ndarray):
    """Windows inside words, each from its first id's class (as an input apart
    from further ids' classes), the numbers and the classes of its further ids:
    inputs, targets (further ids, then the end), and which places are scored."""
    ends = np.cumsum(more, dtype=np.int64)
    bounds = np.concatenate([[0], ends + np.arange(1, len(more) + 1)])
    x, y, use, at = windows(np.insert(further, ends, 0), bounds)
    starts = np.flatnonzero(use[:, 0])  # the first place is scored in a word's first window alone
    x[starts, 0] = CLASSES + first_cls
    return x, y, use, np.searchsorted(bounds, at[:, 0], "right") - 1


#: What the tokenizer takes for white space, besides the bytes between words: it
#: would run together with the space before the next word.
_SPACE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1(?:\x9a\x80|\xa0\x8e)|\xe2(?:\x80[\x80-\x8b\xa8\xa9\xaf]|\x81\x9f)|\xe3\x80\x80").search
#: The first unit of a lower-cased word that the tokenizer segments by itself:
#: Latin letters, digits or ASCII signs up to an ASCII byte of another kind. Any
#: other word is segmented whole.
_LATIN = rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])"
_UNIT = re.compile(_LATIN + rb"+(?=[!-@\[-`{-~]|$)|[0-9]+(?=[!-/:-~]|$)|[!-/:-@\[-`{-~]+(?=[0-9a-z]|$)").match


class Subwords:
    """Ids of words by the tokenizers library. Each distinct first unit is
    encoded once per table, and a word whose hash is known isn't looked at again;
    the tasks of a Python worker share both tables."""

    _kept: dict[str, Subwords] = {}

    def __init__(self, tokenizer: str, table_size: int = 800_000, hashes: int = 3_000_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.model = Tokenizer.from_str(tokenizer)
        self.model.encode_special_tokens = True
        self.size = self.model.get_vocab_size()
        # Ids whose piece begins with the space before a word.
        self.begins = np.array([(self.model.id_to_token(i) or "").startswith("Ġ") for i in range(self.size)], bool)
        self.table: dict[bytes, bytes] = {}  # ids of units
        self.table_size = table_size
        self.kind = np.dtype(np.uint16 if self.size <= 65536 else np.uint32)
        # Hashes, sorted, and their words' first ids, numbers of further ids and where these are in ``further``.
        self.known = np.zeros(0, np.uint64), np.zeros(0, self.kind), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.further = np.zeros(0, self.kind)
        self.hashes = hashes

    @classmethod
    def of_worker(cls, tokenizer: str) -> Subwords:
        if tokenizer not in cls._kept:
            cls._kept.clear()
            cls._kept[tokenizer] = cls(tokenizer)
        return cls._kept[tokenizer]

    def first_ids(self, words: list[bytes]) -> np.ndarray:
        if len(self.table) > self.table_size:
            self.table.clear()
        units, whole = [], set()
        for w in words:
            if w.isalpha():  # ASCII letters alone are one unit
                units.append(w)
            elif m := _UNIT(w):
                units.append(m.group())
            else:
                units.append(w)
                whole.add(w)
        new = list(set(units).difference(self.table, whole))
        self.table.update(zip(new, self._encoded(new), strict=True))
        new = list(whole.difference(self.table))
        self.table.update(zip(new, self._encoded(new, joined=False), strict=True))
        width, none = self.kind.itemsize, bytes(self.kind.itemsize)
        return np.frombuffer(b"".join([self.table[u][:width] or none for u in units]), self.kind)

    def _encoded(self, words: list[bytes], joined: bool = True) -> Iterator[bytes]:
        """Ids of each word. Words joined by spaces are segmented apart, and only a
        word's first id begins with a space: one encoding serves many of them."""
        for i in range(0, len(words), 2_000):  # the library's encodings of a part are freed before the next one's
            part = words[i:i + 2_000]
            if joined:
                ids = np.array(self.model.encode_batch_fast([" " + b" ".join(part).decode()], add_special_tokens=False)[0].ids, self.kind)
                starts, raw, width = np.flatnonzero(self.begins[ids]), ids.tobytes(), self.kind.itemsize
                cuts = (np.append(starts, len(ids)) * width).tolist()
                yield from (raw[a:b] for a, b in zip(cuts[:-1], cuts[1:]))
            else:
                for e in self.model.encode_batch_fast([" " + w.decode() for w in part], add_special_tokens=False):
                    yield np.array(e.ids, self.kind).tobytes()

    def further_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words' second and later ids, and these."""
        found = {w: self.table[w] for w in words if w in self.table}
        rest = list(set(words).difference(found))
        spaced = {w for w in rest if _SPACE(w)}
        joined = [w for w in rest if w not in spaced]
        found.update(zip(joined, self._encoded(joined), strict=True))
        found.update(zip(spaced, self._encoded(list(spaced), joined=False), strict=True))
        width = self.kind.itemsize
        more = [found[w][width:] for w in words]
        return np.array([len(m) // width for m in more], np.uint32), np.frombuffer(b"".join(more), self.kind)

    def first_ids_by_hash(self, keys: np.ndarray, words: Callable[[np.ndarray], list[bytes]]) -> np.ndarray:
        return self.ids_by_hash(keys, words)[0]

    def ids_by_hash(self, keys: np.ndarray, words: Callable[[np.ndarray], list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First ids, numbers of further ids and these, of the words with these
        hashes (sorted, distinct); ``words`` gives the words at some places among
        them."""
        have, *values = self.known
        at = np.searchsorted(have, keys)
        near = np.minimum(at, len(have) - 1)
        old = have[near] == keys if len(have) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~old)
        letters = words(new)
        first, (more, further) = self.first_ids(letters), self.further_ids(letters)
        fresh = first, more, np.cumsum(more, dtype=np.int64) - more + len(self.further)
        self.further = np.concatenate([self.further, further])
        out = []
        for value, add in zip(values, fresh):
            all_ = np.empty(len(keys), value.dtype)
            all_[old], all_[new] = value[near[old]], add
            out.append(all_)
        first, more, place = out
        ids = self.further.take(np.repeat(place - (np.cumsum(more, dtype=np.int64) - more), more) + np.arange(int(more.sum())))
        if len(have) + len(new) > self.hashes:
            self.known, self.further = (keys, first, more, np.cumsum(more, dtype=np.int64) - more), ids
        else:
            self.known = np.insert(have, at[new], keys[new]), *(np.insert(v, at[new], f) for v, f in zip(values, fresh))
        return first, more, ids


def _classes(cls: np.ndarray, first: np.ndarray, inverse: np.ndarray, first_id: np.ndarray):
    """Classes of all tokens in order, an end after each document, and the
    documents' bounds among them."""
    return np.insert(cls[first_id][inverse], first[1:], cls[-1]), first + np.arange(len(first))


def _bounds(more: np.ndarray) -> np.ndarray:
    """For ``Bags.of``: place 0 is no word, place i + 1 the word i."""
    return np.concatenate([[0, 0], np.cumsum(more, dtype=np.int64)])


def _dealt(block: int, n: int, parts: int) -> np.ndarray:
    """Part of each of the block's n rows, by a hash of its place."""
    return (C.mix(np.uint64(block) + (np.arange(n).astype(np.uint64) << np.uint64(40))) % np.uint64(parts)).astype(np.int64)


_WINDOWS = "block long, part int, windows binary"


def _windows_row(block: int, part: int, arrays: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([part], pa.int32()), pa.array([C.pack_arrays(arrays)], pa.binary())], names=["block", "part", "windows"])


def training_windows(encoded: DataFrame, cls: np.ndarray, parts: int = ROUNDS, further_cls: np.ndarray | None = None) -> DataFrame:
    """All windows of all training documents, staged. A document's windows are
    in one of ``parts`` parts, by a hash of its place. With ``further_cls`` they
    have the word that each place sees and those words' further ids' classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, first, inverse, count, _, first_id, more, further in _encoded(batch):
                tokens, bounds = _classes(cls, first, inverse, first_id)
                length = np.diff(bounds)
                part_of = _dealt(block, len(ids), parts)
                part_of[_is_held_out(ids)] = -1
                if further_cls is not None:
                    word = np.insert(inverse.astype(np.int64) + 1, first[1:], 0)
                    further = further_cls[further].astype(_CLASS)
                for part in range(parts):
                    mine = part_of == part
                    if not mine.any():
                        continue
                    chosen, own = np.repeat(mine, length), np.concatenate([[0], np.cumsum(length[mine])])
                    if further_cls is None:
                        x, y, use, _ = windows(tokens[chosen], own)
                        yield _windows_row(block, part, [x.astype(_CLASS), y.astype(_CLASS), use])
                        continue
                    token = np.append(0, tokens[chosen])
                    seen, target, use, _ = windows(np.arange(1, len(token)), own)
                    here = np.zeros(len(count) + 1, bool)  # the part's words, in a numbering of their own
                    here[word[chosen]] = True
                    here[0] = False
                    number = np.cumsum(here)
                    number[0] = 0
                    w = np.append(0, number[word[chosen]])[seen].astype(np.uint16 if number[-1] < 65536 else np.uint32)
                    kept = here[1:]
                    yield _windows_row(block, part, [token[seen].astype(_CLASS), token[target].astype(_CLASS), use, w, more[kept], further[np.repeat(kept, more)]])

    return C.stage_table(encoded.mapInArrow(run, _WINDOWS), "lm-windows")[0]


def further_windows(encoded: DataFrame, cls: np.ndarray, further_cls: np.ndarray, parts: int = ROUNDS) -> DataFrame:
    """Windows inside all distinct training words, each word by the block that
    owns it, staged; a word's are in one of ``parts`` parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, _, _, _, count, owner, first_id, more, further in _encoded(batch):
                part_of = np.where(owner & (count > 0), _dealt(block, len(count), parts), -1)
                for part in range(parts):
                    mine = part_of == part
                    if mine.any():
                        x, y, use, _ = word_windows(cls[first_id[mine]], more[mine], further_cls[further[np.repeat(mine, more)]])
                        yield _windows_row(block, part, [x.astype(_INPUT), y.astype(_CLASS), use])

    return C.stage_table(encoded.mapInArrow(run, _WINDOWS), "lm-word-windows")[0]


_FIXED = 1 << 16


def _last(use: np.ndarray) -> np.ndarray:
    """Places of each window up to the last one that is scored."""
    return np.maximum(1, (use * np.arange(1, use.shape[1] + 1)).max(1, initial=0))


def learn(weights: dict[str, np.ndarray], chosen: DataFrame, number: int, size: int = BATCH) -> dict[str, np.ndarray]:
    """One round: each task starts from ``weights`` and runs Adam over its
    windows; the mean of their weights, by windows, comes back. Weights are
    added up by Spark as integers, so the order of tasks doesn't matter."""
    names, sizes = list(weights), [a.size for a in weights.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, state, seen = {n: a.copy() for n, a in weights.items()}, {}, 0
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("windows").to_pylist()):
                x, y, use, *words = C.unpack_arrays(packed)
                last = _last(use)
                bounds = _bounds(words[1]) if words else None
                order = np.random.default_rng([number, block]).permutation(len(x))
                for i in range(0, len(x), size):
                    at = order[i:i + size]
                    t = int(last[at].max())  # no scored place sees what comes after
                    bags = Bags.of(words[0][at, :t], bounds, words[2]) if words else None
                    adam(w, x[at, :t].astype(np.int32), y[at, :t].astype(np.int32), use[at, :t], state, RATE / (1 + number), bags)
                seen += len(x)
        flat = np.concatenate([w[n].ravel() for n in names] + [np.ones(1)]).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int64()), pa.array(np.rint(flat * seen * _FIXED).astype(np.int64))], names=["at", "sum"])

    parts = chosen.mapInArrow(run, "at long, sum long").groupBy("at").agg(F.sum("sum").alias("sum")).toArrow()
    flat = np.zeros(sum(sizes) + 1)
    flat[parts.column("at").to_numpy()] = parts.column("sum").to_numpy()
    if not flat[-1]:
        return weights
    cuts = np.cumsum([0] + sizes)
    return {n: (flat[a:b] / flat[-1]).reshape(weights[n].shape).astype(np.float32) for n, a, b in zip(names, cuts[:-1], cuts[1:])}


def fit(encoded: DataFrame, words: np.ndarray, distinct: np.ndarray, ends: int, rounds: int = ROUNDS, share: int = ROUNDS, further: np.ndarray | None = None) -> Attention:
    """From the counts by first id (``id_counts``) and the training documents.
    Each round learns from one of ``share`` parts of them, in turn. ``further``
    (``further_counts``): the words' further ids are seen and learned too."""
    cls = classes_of_ids(words, kinds_of_ids(encoded, words))
    count = np.bincount(cls, weights=np.append(words, ends), minlength=CLASSES)
    kinds = np.bincount(cls, weights=np.append(distinct, ends > 0), minlength=CLASSES)
    smooth = count + 0.1 * (kinds + 1)
    weights = start_weights()
    weights["u"][:] = 0  # starts as the unigram of classes
    weights["b"] = np.log(smooth / smooth.sum()).astype(np.float32)
    inside = None
    if further is not None:
        mass = SHARED * (kinds + 1)
        smooth = count + mass
        inside = fit_further(encoded, cls, distinct, further, mass, rounds, share)
        weights["f"] = np.zeros((CLASSES, DIM), np.float32)
    chosen = training_windows(encoded, cls, share, inside and inside.cls)
    for number in range(rounds):
        weights = learn(weights, chosen.where(F.col("part") == number % share), number)
    return Attention(weights, cls, np.log10(smooth), inside)


def _log_share(counts: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Log10 of each id's smoothed share in its class."""
    own = counts + 0.1
    return np.log10(own / np.bincount(cls, weights=own, minlength=CLASSES)[cls])


def fit_further(encoded: DataFrame, cls: np.ndarray, distinct: np.ndarray, further: np.ndarray, mass: np.ndarray, rounds: int, share: int) -> Further:
    """The layer inside words, from all distinct training words."""
    further_cls = classes_of_ids(further, np.full(len(further), KINDS))[:-1]
    count = np.bincount(further_cls, weights=further, minlength=CLASSES)
    count[0] = distinct.sum()  # a word's end
    weights = start_weights()
    weights["e"] = start_weights(2 * CLASSES)["e"]  # further ids' classes, then first ids'
    weights["u"][:] = 0
    weights["b"] = np.log((count + 0.1) / (count + 0.1).sum()).astype(np.float32)
    chosen = further_windows(encoded, cls, further_cls, share)
    for number in range(rounds):
        weights = learn(weights, chosen.where(F.col("part") == number % share), number, WORD_BATCH)
    return Further(weights, further_cls, _log_share(distinct, cls[:-1]), _log_share(further, further_cls), np.log10(mass))


def _log10_classes(model: Attention, cls: np.ndarray, bounds: np.ndarray, batch: int = 128, words: tuple[np.ndarray, ...] | None = None) -> np.ndarray:
    """Log10 probability of each token's class, scored once each. words: each
    token's word as in ``Bags.of``, with the bounds and classes of these."""
    out = np.zeros(len(cls), np.float32)
    first = 0
    token, word = np.append(0, cls), np.append(0, words[0]) if words else None
    while first < len(bounds) - 1:  # some texts at a time: windows take 16 times their space
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + 50_000, "right")) - 1)
        seen, y, use, at = windows(np.arange(1, len(token)), bounds[first:last + 1])
        x, y = token[seen].astype(np.int32), token[y].astype(np.int32)
        for i in range(0, len(x), batch):
            mine = use[i:i + batch]
            bags = Bags.of(word[seen[i:i + batch]], *words[1:]) if words else None
            out[at[i:i + batch][mine]] = log_of(model.weights, x[i:i + batch], y[i:i + batch], mine, bags)
        first = last
    return out / np.float32(np.log(10))


def log10_words(model: Attention, first_id: np.ndarray, more: np.ndarray, further: np.ndarray, batch: int = 256, rows: int = 20_000) -> np.ndarray:
    """Log10 of the count that each word gets besides its own: the class's mass
    times the word's share in its class by the layer inside words."""
    f, cls = model.further, model.cls[first_id]
    out = f.log_mass[cls] + f.log_first[first_id]
    ends = np.cumsum(more, dtype=np.int64)
    head = np.concatenate([[0], np.cumsum(f.log_further[further])])
    out += head[ends] - head[ends - more]
    order = np.argsort(more, kind="stable")  # words of a length together: windows are no longer than they need to be
    for a in range(0, len(order), rows):
        mine = order[a:a + rows]
        n = more[mine].astype(np.int64)
        at = np.repeat(ends[mine] - n - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        x, y, use, word = word_windows(cls[mine], n, f.cls[further[at]])
        last = _last(use)
        found = []
        for i in range(0, len(x), batch):
            t = int(last[i:i + batch].max())
            found.append(log_of(f.weights, x[i:i + batch, :t], y[i:i + batch, :t], use[i:i + batch, :t]))
        out[mine] += np.bincount(np.repeat(word, use.sum(1)), weights=np.concatenate(found), minlength=len(mine)) / np.log(10)
    return out


def score(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    of every document."""
    blocks = C.pack_blocks(docs, "lm-blocks")
    counts = C.exchange(blocks, _ask, _total, C.bucket_count(blocks, 4), "counts")
    encoded = encode(blocks.join(counts, "block", "left"), tokenizer)
    words, distinct = id_counts(encoded, Subwords(tokenizer).size)
    ends = docs.where(~held_out()).count()
    model = fit(encoded, words, distinct, ends, ROUNDS, ROUNDS, further_counts(encoded, len(words)))
    total = int(words.sum()) + ends
    floor = total + 0.1 * (int(distinct.sum()) + (ends > 0) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, doc_ids, first, inverse, count, _, first_id, more, further in _encoded(batch):
                cls, bounds = _classes(model.cls, first, inverse, first_id)
                c = np.insert(count[inverse], first[1:], ends)
                own = in_class = np.log10(c + 0.1)
                words = None
                if model.further:
                    log_more = log10_words(model, first_id, more, further)
                    known = np.where(count > 0, np.log10(np.maximum(count, 1) + 10.0 ** log_more), log_more)
                    in_class = np.insert(known[inverse], first[1:], model.log_size[0])  # the end is alone in its class
                    words = np.insert(inverse.astype(np.int64) + 1, first[1:], 0), _bounds(more), model.further.cls[further]
                in_model = _log10_classes(model, cls, bounds, words=words) + in_class - model.log_size[cls]
                sums = []
                for value in (c > 0, own - np.log10(floor), in_model):
                    run_ = np.concatenate([[0], np.cumsum(value, dtype=np.float64)])
                    sums.append(run_[bounds[1:]] - run_[bounds[:-1]])
                yield pa.RecordBatch.from_arrays([
                    C.id_array(doc_ids), pa.array(_is_held_out(doc_ids)), pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array(sums[0].astype(np.int64)), pa.array(np.full(len(doc_ids), total, np.int64)), pa.array(sums[1]), pa.array(sums[2]),
                ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return encoded.mapInArrow(run, RESULT)
