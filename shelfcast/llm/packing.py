"""Best-fit packing of token sequences by a configuration linear program.

Documents become ids (and an end id); only those longer than ``SIZE`` are cut,
into pieces of ``SIZE`` ids, the first of which may be shorter. Packing needs
the pieces' lengths only: their histogram has at most ``SIZE`` entries.

* A configuration is a multiset of lengths that fit one sequence. The linear
  program asks for multiplicities that cover the histogram with the fewest
  sequences. Multiplicative weights solve it: each round prices lengths, a
  knapsack dynamic program finds the configuration worth most, it is used for
  a share of what is left of its scarcest length, and the prices of the
  lengths it covers fall. ``ROUNDS`` bounds the number of configurations.
* Multiplicities are rounded down and cut to what is there; what is left over
  is solved again while that places anything, and the rest (few pieces of each
  length) is placed best fit, longest first.
* Pieces find their place without meeting in one task: a piece's rank among
  those of its length is its rank in its own partition plus the counts of the
  partitions before; a plan of rank ranges (bounded by ROUNDS, not by data)
  turns length and rank into sequence and offset.

Nulls and ties: a null text is empty and has the end id alone; rows are
packed one by one, repeated or not; a null doc_id stays null. An empty table
gives an empty result.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table
from . import common as C

SIZE, END_ID = 1024, 2
ROUNDS, PASSES, SHARE, RATE = 200, 2, 0.5, 3.0
#: Characters encoded at a time: their units, as Python strings, take some ten times the space.
SLICE = 1 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, rank long"
#: White space as Unicode has it.
_SPACE = "\t-\r \x85\xa0  -     　"
_LETTER, _SIGN = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
#: Parts of a text between places that no byte-level token crosses: runs of
#: Latin letters or of signs (without the apostrophe of contractions) with the
#: space before them; else all up to the next white space; and runs of white
#: space, of which the last space goes with the word after it.
_UNITS = re.compile(f" ?[{_LETTER}]+(?=[{_SIGN}{_SPACE}]|$)| ?[{_SIGN}]+(?=[{_LETTER}{_SPACE}]|$)| ?[^{_SPACE}]+"
                    f"|[{_SPACE}]+(?=[{_SPACE}][^{_SPACE}])|[{_SPACE}]+").findall
#: Units that are segmented as they are wherever other such units stand around
#: them, and of whose ids only the first begins with a space.
_PLAIN = re.compile(f" [{_LETTER}]+").fullmatch


class UnitEncoder:
    """Ids by the tokenizers library, each distinct unit encoded once per table."""

    _kept: dict[str, UnitEncoder] = {}

    @classmethod
    def of(cls, tokenizer: str) -> UnitEncoder:
        """This process's encoder: the tasks that a Python worker gets one after
        the other go on with its table."""
        if tokenizer not in cls._kept:
            cls._kept = {tokenizer: cls(tokenizer)}
        return cls._kept[tokenizer]

    def __init__(self, tokenizer: str, table_size: int = 500_000):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(tokenizer)
        self.begins = np.array([(self.model.id_to_token(i) or "").startswith("Ġ") for i in range(self.model.get_vocab_size())], bool)
        self.table: dict[str, bytes] = {}
        self.table_size = table_size
        # Added tokens are taken out of a text before anything else is looked at.
        added = [t["content"] for t in json.loads(tokenizer).get("added_tokens", [])]
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def units(self, text: str) -> list[str]:
        if self.added is None or self.added.search(text) is None:
            return _UNITS(text)
        out = []
        for i, part in enumerate(self.added.split(text)):
            out += [part] if i % 2 else _UNITS(part)
        return out

    def _encode_joined(self, plain: list[str]) -> None:
        """Put plain units into the table, 250 of them in one encoding. A
        tokenizer that doesn't mark the space before a word leaves them out."""
        for i in range(0, len(plain), 250):
            part = plain[i:i + 250]
            ids = np.array(self.model.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = [*np.flatnonzero(self.begins[ids]).tolist(), len(ids)]
            if len(cuts) == len(part) + 1 and cuts[0] == 0:
                raw = ids.tobytes()
                self.table.update((u, raw[4 * a:4 * b]) for u, a, b in zip(part, cuts[:-1], cuts[1:]))

    def encode_slices(self, texts: list[str], limit: int = SLICE) -> Iterator[bytes]:
        """Each text's ids; about ``limit`` characters are encoded together."""
        first, held = 0, 0
        for last, text in enumerate(texts, 1):
            held += len(text)
            if held >= limit or last == len(texts):
                yield from self.encode(texts[first:last])
                first, held = last, 0

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.table) > self.table_size:
            self.table.clear()
        units = [self.units(t) for t in texts]
        new = set().union(*units).difference(self.table)  # looks the units up; of a set and .keys() all keys are gone through
        self._encode_joined([u for u in new if _PLAIN(u)])
        new = list(new.difference(self.table))
        for i in range(0, len(new), 10_000):
            part = new[i:i + 10_000]
            for unit, e in zip(part, self.model.encode_batch_fast(part, add_special_tokens=False)):
                self.table[unit] = struct.pack(f"<{len(e.ids)}I", *e.ids)
        table = self.table
        return [b"".join([table[u] for u in us]) for us in units]


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """The documents' pieces, staged: part and rank are the writing task's
    partition and the piece's rank among those of its length there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        part = TaskContext.get().partitionId()
        encoder = UnitEncoder.of(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            docs_, rows = C.id_column(batch), []
            for doc, raw in zip(docs_.tolist(), encoder.encode_slices(C.text_column(batch).to_pylist())):
                raw += end
                n = len(raw) // 4
                first = n if n <= size else n % size or size
                start, piece = 0, 0
                while start < n:
                    length = first if not piece else size
                    ids = raw[4 * start:4 * (start + length)]
                    rows.append((doc, piece, start, length, zlib.crc32(ids), ids if with_ids else None, part, int(seen[length])))
                    seen[length] += 1
                    start, piece = start + length, piece + 1
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([
                    C.id_array(np.array(cols[0], np.int64)), pa.array(cols[1], pa.int32()), *(pa.array(cols[j], pa.int64()) for j in (2, 3, 4)),
                    pa.array(cols[5], pa.binary()), pa.array(cols[6], pa.int32()), pa.array(cols[7], pa.int64()),
                ], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids", "part", "rank"])

    return stage_table(docs.select("doc_id", "text").mapInArrow(run, PIECES), "pieces")[0]


# ------------------------------------------------------------ linear program

def price(values: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Knapsack: how often each length is in the configuration worth most."""
    best = np.zeros(size + 1)
    choice = np.full(size + 1, -1)
    for room in range(int(lengths[0]), size + 1):
        fits = int(np.searchsorted(lengths, room, "right"))
        worth = best[room - lengths[:fits]] + values[:fits]
        j = int(worth.argmax())
        if worth[j] > best[room - 1]:
            best[room], choice[room] = worth[j], j
        else:
            best[room] = best[room - 1]
    out = np.zeros(len(lengths), np.int64)
    room = size
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            out[choice[room]] += 1
            room -= int(lengths[choice[room]])
    return out


def solve(lengths: np.ndarray, counts: np.ndarray, size: int, rounds: int = ROUNDS) -> list[tuple[np.ndarray, float]]:
    """Configurations and multiplicities by multiplicative weights."""
    covered = np.zeros(len(lengths))
    found: dict[bytes, tuple[np.ndarray, float]] = {}
    for _ in range(rounds):
        # A length's price: its size, falling as more of it is covered.
        open_ = covered < 1
        if not open_.any():
            break
        values = lengths / size * np.exp(-RATE * np.minimum(covered, 1) * lengths / size) * (1 + 1e-3 * lengths / size)
        use = np.flatnonzero(open_)
        config = np.zeros(len(lengths), np.int64)
        config[use] = price(values[use], lengths[use], size)
        in_it = config > 0
        left = np.maximum(0, counts * (1 - covered))[in_it]
        times = float((left / config[in_it]).min())
        if times > 1:  # a share of the scarcest length, or all of it once it is little
            times = max(1.0, SHARE * times) if times > 4 else times
        covered[in_it] += config[in_it] * times / counts[in_it]
        covered[covered > 1 - 1e-9] = 1
        key = config.tobytes()
        found[key] = (config, found.get(key, (config, 0.0))[1] + times)
    return list(found.values())


def best_fit(lengths: np.ndarray, counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, over equal sequences at once."""
    bins: dict[int, dict[tuple[int, ...], int]] = {}

    def add(room: int, content: tuple[int, ...], n: int) -> None:
        bins.setdefault(room, {})
        bins[room][content] = bins[room].get(content, 0) + n

    for length, n in sorted(zip(lengths.tolist(), counts.tolist()), reverse=True):
        while n > 0:
            room = min((r for r, b in bins.items() if r >= length and b), default=None)
            if room is None:
                each = min(size // length, n)
                add(size - each * length, (length,) * each, n // each)
                n -= n // each * each
                continue
            content, have = next(iter(bins[room].items()))
            each = min(room // length, n)
            use = min(have, n // each)
            bins[room][content] -= use
            if not bins[room][content]:
                del bins[room][content]
            add(room - each * length, content + (length,) * each, use)
            n -= use * each
    return [(content, n) for b in bins.values() for content, n in b.items()]


def rounded(lengths: np.ndarray, counts: np.ndarray, size: int, least: int) -> list[tuple[tuple[int, ...], int]]:
    """The program's configurations of at least ``least`` tokens, as often as
    it takes them, rounded down; ``PASSES`` times, each on what the pass before
    has left; best fit places the rest."""
    rest, out = counts.copy(), []
    for _ in range(PASSES):
        there = rest > 0
        if not there.any():
            break
        placed = 0
        for config, times in sorted(solve(lengths[there], rest[there], size), key=lambda x: -x[1]):
            full = np.zeros(len(lengths), np.int64)
            full[there] = config
            used = full > 0
            n = min(int(times + 1e-9), int((rest[used] // full[used]).min())) if full @ lengths >= least else 0
            if n > 0:
                rest -= full * n
                placed += n
                out.append((tuple(np.repeat(lengths, full).tolist()), n))
        if not placed:
            break
    there = rest > 0
    return out + best_fit(lengths[there], rest[there], size)


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Configurations (lengths) and how many sequences have each; together
    they hold exactly the histogram.

    Taking every configuration of the program is best where few lengths make
    up the table; where many do, what a poorly filled one holds may fit
    elsewhere. So the program is rounded with several bounds on the filling,
    and the plan of fewest sequences is taken, best fit alone among them."""
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[int(x)] for x in lengths], np.int64)
    plans = [rounded(lengths, counts, size, least) for least in (0, size - size // 16, size - 1)]
    return min([*plans, best_fit(lengths, counts, size)], key=lambda p: sum(n for _, n in p))


def ranges(configurations: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first ranks, first sequence ids and offsets of the plan."""
    rank: dict[int, int] = {}
    out: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for content, n in configurations:
        offset = 0
        for length in content:
            out.setdefault(length, []).append((rank.get(length, 0), sequence, offset))
            rank[length] = rank.get(length, 0) + n
            offset += length
        sequence += n
    return {k: tuple(np.array(v, np.int64).T) for k, v in out.items()}


def pack(pieces_: DataFrame, size: int = SIZE) -> DataFrame:
    """The staged pieces with sequence_id and offset."""
    counts = stage_table(pieces_.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")[0]
    histogram = {int(r["length"]): int(r["n"]) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``size`` rows
    where = ranges(plan(histogram, size))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Dealt by both columns: a join that went on with the window's partitions
    # would bring all pieces of a length, most often SIZE, to one task.
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).repartition("part", "length")
    ranked = pieces_.join(base, ["part", "length"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() + batch.column("base").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length).tolist():
                mine = length == n
                first, ids, places = where[n]
                j = np.searchsorted(first, rank[mine], "right") - 1
                sequence[mine], offset[mine] = ids[j] + rank[mine] - first[j], places[j]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "rank", "base").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long")


def tokenizer_text(raw: bytes) -> str:
    """The tokenizer file's text, checked to be a byte-level one whose tokens
    stay within units (no normalizer, no added prefix space)."""
    spec = json.loads(raw)
    pre = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
        raise ValueError("not a plain byte-level tokenizer")
    return raw.decode()
