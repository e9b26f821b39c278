"""Decontamination, filter audit and clustering against brute force, with
nulls, empty and long texts, ties, repeated rows, empty tables and extra
columns with clashing names."""

import hashlib
import math
import random
import re
from itertools import permutations

import pytest

from .test_ops import fixture_rows, frame, key, same

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


# ---------------------------------------------------------------- op11

def items_of(rows):
    """Items: a passage of the fixture, its repeats, short, empty and null ones."""
    passage = next(t for d, t in rows if d == 400) if rows else "a b c d e f g h i j k"
    w = passage.split()
    return [(1, passage), (1, "Two; WORDS"), (2, " ".join(w[:10]).upper()), (3, "!! " + "... ".join(w[5:25]) + "\x00zz"), (4, None), (5, " \n#"),
            (None, "y  z Q"), (10, " ".join(w[2:11])), (2, " ".join(w[:10])), (7, "Ünïcode wörds x"), (8, " ".join(w[:9] + ["unseen"] + w[9:18]))]


def brute11(docs, items):
    windows = []
    for name, text in items:
        w = words_of(text)
        n = min(10, len(w))
        windows += [("" if name is None else str(name), w[s:s + n]) for s in range(len(w) - n + 1) if n]
    out = []
    for d, text in docs:
        w, hit, names = words_of(text), set(), set()
        for name, x in windows:
            for s in range(len(w) - len(x) + 1):
                if w[s:s + len(x)] == x:
                    hit.update(range(s, s + len(x)))
                    names.add(name)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


def extra_rows(rows):
    if not rows:
        return rows
    w = next(t for d, t in rows if d == 400).split()
    return [*rows, (500, "start " + " ".join(w[7:18]) + " end"), (501, " ".join(w[:9])), (502, "x" * 5000 + " two, words"), (503, "ünïcode WÖRDS x"),
            (503, "Ünïcode wörds, x! " * 3), (None, " ".join(w)), (504, " ".join(w * 3)), (505, "퟿" + " ".join(w[3:13]))]


@pytest.fixture(params=["rows", "empty"])
def rows(request):
    return extra_rows(fixture_rows()) if request.param == "rows" else []


CONTRACT11 = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("batch_bytes", [1 << 20, 64])
def test_decontamination(spark, rows, batch_bytes):
    from pyspark.sql import functions as F

    from shelfcast.llm import decontaminate as D
    items = items_of(rows)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("items", F.lit(3))
    docs = frame(spark, rows).withColumn("longest", F.lit("mine"))
    want = brute11(rows, items)
    if batch_bytes > 64:
        same(D.report(docs, bench).select(*CONTRACT11), want)
    found = D.scan(docs, bench, ["doc_id"], batch_bytes=batch_bytes).collect()  # 64: one item a batch
    have = [(r.doc_id, r.n_words, sum(s["end"] - s["first"] for s in r.hit_spans), len(r["items"]),
             hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), bool(r.hit_spans)) for r in found]
    assert sorted(have, key=key) == sorted(want, key=key)
    same(D.decontaminate(docs, bench).select("doc_id", "score"), [(d, 7) for (d, *_, bad) in want if not bad])


def test_longest_matches(spark):
    from shelfcast.llm import decontaminate as D
    rows = extra_rows(fixture_rows())
    items = items_of(rows)
    bench = spark.createDataFrame(items[:1] + items[7:8], "item_id long, text string")
    docs = frame(spark, [(d, t) for d, t in rows if d is not None])
    want = {}
    for name, text in (items[0], items[7]):
        x = words_of(text)
        for p in range(len(x) - min(10, len(x)) + 1):
            best = []
            for d, t in rows:
                w = words_of(t)
                for s in range(len(w)) if d is not None else ():
                    n = 0
                    while s + n < len(w) and p + n < len(x) and w[s + n] == x[p + n]:
                        n += 1
                    if n >= min(10, len(x)):
                        best.append((-n, d, s))
            if best:
                top = min(best)
                want[str(name), p] = (-top[0], sum(b[0] == top[0] for b in best), top[1], top[2])
    out = {(r.item_id, r.place): (r.n_words, r.n_places, r.doc_id, r.word) for r in D.longest_matches(docs, bench).collect()}
    assert out == want and len(want) > 20
    longest = {(r.doc_id, r.longest) for r in D.scan(docs, bench, ["doc_id"]).collect()}
    assert {(500, 11), (501, 0), (400, 40)} <= longest


def test_no_items(spark):
    from shelfcast.llm import decontaminate as D
    rows = fixture_rows()
    bench = spark.createDataFrame([], "item_id long, text string")
    same(D.report(frame(spark, rows), bench).select(*CONTRACT11), brute11(rows, []))
    assert D.longest_matches(frame(spark, rows), bench).isEmpty()


def test_suffix_array_is_sorted():
    import numpy as np

    from shelfcast.llm.decontaminate import suffix_array
    rng = np.random.default_rng(3)
    for top in (2, 3, 9):
        text = np.concatenate([rng.integers(0, top, 400), np.tile([1], 40), [0]]).astype(np.int32)
        upto = lambda p: tuple(text[p:p + int(np.argmin(text[p:] != 0))])
        found = [upto(p) for p in suffix_array(text, 500)]
        assert found == sorted(upto(p) for p in np.flatnonzero(text))


# ---------------------------------------------------------------- op12

def brute12(docs, labels):
    fails, parts = [], []
    for d, text, lang in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
             "D": any(c in "#$%&*|" for c in t), "E": d is not None and any((x or "") == t and e is not None and e < d for e, x, _ in docs)}
        fails.append({k for k, v in f.items() if v})
        parts.append(lang or "")
    label = lambda d, i: d is not None and any(x[0] == d and x[i] == 1 for x in labels)
    out = []
    for part in sorted(set(parts)):
        mine = [(f, label(d, 1), label(d, 2)) for (d, *_), f, p in zip(docs, fails, parts) if p == part]
        steps, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for i, own in enumerate(order):
                before = set(order[:i])
                here = [m for m in mine if own in m[0] and not m[0] & before]
                total[own] += len(here)
                steps.append((part, "".join(order), i + 1, sum(not m[0] & {*before, own} for m in mine), len(here), sum(own in m[0] and bool(m[0] & before) for m in mine),
                              sum(m[0] == {own} for m in mine), sum(m[1] for m in here), sum(m[2] for m in here)))
        out += [(*s, total[s[1][s[2] - 1]]) for s in steps]
    return out


def audit_rows():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    text = lambda n, k=300: " ".join(rng.choice(vocab[:k]) for _ in range(n))
    clean, hot = text(250), text(220)
    rows = [(1, clean, "en"), (2, clean, "en"), (2, clean, "en"), (2, clean, "fr"), (3, None, None), (4, "", "en"), (5, " \x0b\n", ""), (6, text(400, 20), "de"),
            (7, "LOUD " * 210, "de"), (8, clean + " # x", "fr"), (None, clean, "en"), (None, "only here", "en"), (10, "only here", "en"), (11, text(5000), "fr"),
            (12, "É" + text(230), "x"), (12, "other text of this id", "x"), (13, hot + " |", "en"), (14, "Aa " * 100, "en"), (15, "ﬁ " * 200, "en")]
    return rows + [(100 + i, hot, "en") for i in range(600)]


LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (6, None, 1), (8, 1, None), (100, 1, 0), (101, 1, 1), (None, 1, 1), (999, 1, 1)]


@pytest.mark.parametrize("docs,labels,broadcast", [(audit_rows(), LABELS, True), (audit_rows(), [], False), ([], LABELS, True)])
def test_filter_audit(spark, monkeypatch, docs, labels, broadcast):
    from pyspark.sql import functions as F

    from shelfcast.llm import filter_audit as A
    if not broadcast:
        monkeypatch.setattr(A, "BROADCAST_HASHES", 0)
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({"part": F.lit(1), "bits": F.lit("x"), "hash": F.lit(0)})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit(9))
    same(A.audit(d, marks), brute12(docs, labels))


# ---------------------------------------------------------------- op13

def brute13(vectors, dims, k, rounds):
    kept = [(v, [math.floor(1024 * x) for x in e]) for v, e in vectors
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    ranked = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [e for _, e in ranked[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for r in range(rounds + 1):
        at = [min((dist(e, c), j) for j, c in enumerate(cents)) for _, e in kept]
        if r < rounds:
            for j in range(len(cents)):
                mine = [e for (_, e), a in zip(kept, at) if a[1] == j]
                if mine:
                    cents[j] = [sum(x) // len(mine) for x in zip(*mine)]
    own = {j: sum(a[0] for a in at if a[1] == j) for j in range(len(cents))}
    return [(v, a[1], a[0], own[a[1]], sum(own.values()), hashlib.sha256(",".join(map(str, cents[a[1]])).encode()).hexdigest()) for (v, _), a in zip(kept, at)]


def vectors_of(n, dims=64, seed=0, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(12)]
    rows = [(i, [rng.gauss(m, 0.3) for m in rng.choice(centres)]) for i in range(n)]
    odd = [(n, None), (n + 1, []), (n + 2, [0.5] * (dims - 1)), (n + 3, [float("nan")] + [0.0] * (dims - 1)), (n + 4, [None] + [0.0] * (dims - 1)),
           (n + 5, [float("-inf")] + [0.0] * (dims - 1)), (3, rows[3][1]), (3, [0.25] * dims), (None, [1.0] * dims), (n + 6, [-0.0001] * dims), (n + 7, [0.0] * dims)]
    return rows + odd + [(1000 + i, [0.125] * dims) for i in range(40)]


@pytest.mark.parametrize("n", [400, 60])
def test_clusters(spark, n):
    from pyspark.sql import functions as F

    from shelfcast.llm import clustering as K
    rows = vectors_of(n)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"cluster": F.lit("x"), "distance": F.lit(1)})
    same(K.report(df), brute13(rows, 64, 8, 10))


def test_few_or_no_vectors(spark):
    from shelfcast.llm import clustering as K
    kind = "vec_id long, embedding array<float>"
    few = [(1, [0.5] * 64), (2, [0.25] * 64), (2, [0.25] * 64)]
    same(K.report(spark.createDataFrame(few, kind)), brute13(few, 64, 8, 10))
    for none in ([], [(1, None), (2, [1.0])]):
        assert K.report(spark.createDataFrame(none, kind)).isEmpty()
    K.report(spark.createDataFrame([*few, (9, [3e38] * 64)], kind)).collect()  # beyond the bound of the integers: no failure


def test_bounds_spare_distances_and_stay_exact(spark):
    """Total displacement loosens no more than summed drifts, and every
    assignment equals a full search."""
    import numpy as np

    from shelfcast.llm import clustering as K
    rows = vectors_of(500, seed=4)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = K.cluster(df)
    full = found.exact[0]
    assert all(x < full for x in found.exact[1:]) and sum(found.exact[1:]) < 0.7 * full * K.ROUNDS
    history = np.stack(found.history)
    steps = np.sqrt(((history[1:] - history[:-1]).astype(float) ** 2).sum(2))
    total, summed = K.displacements(history)[0], steps.sum(0)
    assert (total <= summed + 1e-9).all() and (total < summed - 1e-3).any()
    x = np.array([[math.floor(1024 * v) for v in e] for _, e in rows[:500]], np.int32)
    b, _ = K.start(x, history[0])
    for r in range(1, len(history)):
        K.reassign(x, b, history[:r + 1])
        d = np.stack([K.distances(x, c) for c in history[r]], 1)
        assert (b.at == d.argmin(1)).all()
        moved = K.displacements(history[:r + 1])
        assert (b.lower - moved[b.lower_round, np.arange(8)] <= np.sqrt(d) + 1e-6).all()
        assert (b.upper + moved[b.upper_round, b.at] >= np.sqrt(d[np.arange(500), b.at]) - 1e-6).all()
