"""Every operator against its brute-force version on a fixture with nulls,
empty and long texts, ties, repeated rows and clashing extra columns."""

import random

import numpy as np
import pytest

from . import brute


def fixture_rows(seed=1):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(80)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage, line = text(40), "A line that many of them share, x"
    rows = [(i, text(rng.randint(1, 60))) for i in range(24)]
    rows += [(100 + i, text(15) + "\n" + passage + "\n  " + line.upper() + "\t\n" + text(9)) for i in range(5)]
    base = text(120).split()
    for i in range(4):
        copy = list(base)
        copy[10 * i] = "edited"
        rows.append((200 + i, " ".join(copy)))
    rows += [(300, "same text of some words here, twice"), (301, "same text of some words here, twice"), (302, None), (303, ""), (304, " \n\t "),
             (305, text(3000)), (306, "two words"), (307, "Two  words"), (308, "x\n\n  y  z q ﬁ\x1c1"), (400, passage), (400, passage)]
    return rows


def frame(spark, rows):
    """With extra columns whose names clash with the operators' own."""
    data = [(d, t, "en" if (d or 0) % 3 else None, f"s{(d or 0) % 2}", len(t or ""), 7, "x") for d, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, score int, kept string")


@pytest.fixture(params=["rows", "null id", "empty"])
def rows(request):
    return {"rows": fixture_rows(), "null id": [*fixture_rows(2)[:40], (None, fixture_rows(2)[26][1])], "empty": []}[request.param]


def key(row):
    return tuple((x is not None, x) for x in row)


def same(df, want):
    assert sorted(map(tuple, df.collect()), key=key) == sorted(want, key=key)


def test_fingerprints(spark, rows):
    from shelfcast.llm.fingerprints import PrefixHashes, codes_of, compare_edits
    same(compare_edits(frame(spark, rows)), brute.op1(rows) if rows else [])
    a, b = PrefixHashes(codes_of("xxhello world")), PrefixHashes(codes_of("hello there"))
    assert a.common_extension(2, b, 0) == 6 and a.equal(2, 7, b, 0, 5)


def test_packing(spark, rows):
    import public_tokenizers

    from shelfcast.llm import packing
    tokenizer = packing.tokenizer_text(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    out = packing.pack(packing.pieces(frame(spark, rows), tokenizer)).toPandas()
    have = [tuple(None if x != x else x for x in r) for r in out[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(object).values.tolist()]
    assert sorted(have, key=key) == sorted(brute.op2_pieces(rows), key=key)
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g.length.sum() <= 1024 and (g.length.cumsum() - g.length == g.offset).all()


def test_quality_rules(spark, rows):
    from shelfcast.llm.quality_rules import judge
    out = judge(frame(spark, rows))
    same(out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"), brute.op3_base(rows))
    assert out.where("base_failed and kept").isEmpty()


def test_pieces(spark, rows):
    import public_tokenizers

    from shelfcast.llm.pieces import round_trip
    out = round_trip(frame(spark, rows), open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())
    same(out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"), brute.op4(rows))


def test_phrase_dedup(spark, rows):
    from shelfcast.llm.phrase_dedup import dedup_passages
    same(dedup_passages(frame(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256"), brute.op5(rows))


def test_suffix_dedup(spark, rows):
    from shelfcast.llm.suffix_dedup import dedup_substrings
    same(dedup_substrings(frame(spark, rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), brute.op9(rows))


def test_line_dedup(spark, rows):
    from pyspark.sql import functions as F

    from shelfcast.llm.line_dedup import drop_repeated_lines
    out = drop_repeated_lines(frame(spark, rows)).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256))
    same(out, brute.op8(rows))


def test_minhash(spark, rows):
    from shelfcast.llm.minhash import near_duplicates
    same(near_duplicates(frame(spark, rows)), brute.op10(rows))


def test_classifier_learns_and_handles_missing_labels(spark, rows):
    from shelfcast.llm import compression_quality as K
    docs = frame(spark, rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert K.score(docs, K.fit(docs, none)).where("predicted = 1").isEmpty()
    junk = [(1000 + i, " ".join(f"w{j % 7}###" for j in range(i, i + 60))) for i in range(40)]
    good = [(2000 + i, t) for i, (_, t) in enumerate(fixture_rows(3)[:24] + fixture_rows(4)[:24])]
    both = frame(spark, junk + good)
    labels = spark.createDataFrame([(d, 0, 0) for d, _ in junk] + [(d, 1, 0) for d, _ in good], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r["score"] for r in K.score(both, K.fit(both, labels)).collect()}
    assert max(out[d] for d, _ in junk) < 0.5


def test_attention_scores(spark, rows):
    import math
    import zlib
    from collections import Counter

    import public_tokenizers

    from shelfcast.llm import attention_lm
    tokenizer = open(public_tokenizers.path("byte_bpe_50k.json")).read()
    out = attention_lm.score(frame(spark, rows), tokenizer).collect()
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    texts = [(d, [*brute.words_of(low(t)), "\n"]) for d, t in rows]
    count = Counter(w for d, ws in texts if not held(d) for w in ws)
    n, v = sum(count.values()), len(count)
    want = sorted(((d, held(d), len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for d, ws in texts), key=key)
    assert sorted(((*tuple(r)[:5], round(r["base_score"], 6)) for r in out), key=key) == want
    assert all(r["score"] < 0 for r in out)


def test_attention_is_causal_and_gradients_agree():
    import numpy as np

    from shelfcast.llm import attention_lm as A
    w = {k: v.astype(np.float64) for k, v in A.start_weights(6, 4, 5).items()}
    x = np.random.default_rng(0).integers(0, 6, (3, 5))
    changed = x.copy()
    changed[:, 3:] = (changed[:, 3:] + 1) % 6
    assert np.allclose(A.forward(w, x)[0][:, :3], A.forward(w, changed)[0][:, :3])
    y, use = (x + 1) % 6, np.ones(x.shape, bool)
    loss = lambda: -A.forward(w, x)[0][np.arange(3)[:, None], np.arange(5), y].mean()
    g = A.gradients(w, x, y, use)
    for name in w:
        at = tuple(0 for _ in w[name].shape)
        before, eps = w[name][at], 1e-5
        w[name][at] = before + eps
        up = loss()
        w[name][at] = before - eps
        down = loss()
        w[name][at] = before
        assert abs((up - down) / (2 * eps) - g[name][at]) < 1e-5, name


def outlier_rows():
    """A tight source without symbols, with some planted outliers from 9000 on."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(4000)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    rows = [(i, " ".join(text(rng.randint(90, 110)))) for i in range(300)]
    symbols = text(100)
    for j in range(30):
        symbols[3 * j] += "#"
    repeats = text(90)
    rows += [(9000, " ".join(symbols)), (9001, " ".join(repeats + repeats[:9])), (9002, " ".join(text(500))),
             (9003, "\n".join(w + "\nsame" for w in text(50)))]
    return rows


def mcd_verdict(stats):
    """kept of rows of one group by numpy, from the base columns."""
    import numpy as np

    from shelfcast.llm import quality_rules as Q
    n = np.maximum(1, stats.n_words.to_numpy(float))
    x = np.stack([np.log1p(stats.n_words), np.log1p(stats.word_chars / n), *(np.sqrt(stats[c] / n) for c in ("n_symbols", "n_dup_lines", "n_repeat_words"))], 1)
    use = x[~stats.base_failed.to_numpy(bool)]
    c = np.median(use, 0)

    def factor(s):
        low = np.zeros((5, 5))
        for r in range(5):
            for k in range(r + 1):
                rest = Q.CONSISTENCY * s[r, k] - low[r, :k] @ low[k, :k]
                low[r, k] = np.sqrt(max(rest, Q.RIDGE[r] ** 2)) if r == k else rest / low[k, k]
        return low

    def distance(v, m, low):
        return (np.linalg.solve(low, (v - m).T) ** 2).sum(0)

    found = []
    parts = (use, use[use[:, 0] <= c[0]], use[use[:, 0] > c[0]], use[(use[:, 2:] <= c[2:]).all(1)])
    starts = [(c, np.diag((1.4826 * np.median(abs(use - c), 0)) ** 2))] + [(p.mean(0), np.cov(p.T, bias=True)) for p in parts if len(p)]
    for m, s in starts:
        low, before = factor(s), np.inf
        while True:
            d = distance(use, m, low)
            near = use[d <= np.sort(d)[int(np.ceil(Q.SUBSET * len(d))) - 1]]
            m, low = near.mean(0), factor(np.cov(near.T, bias=True))
            now = 2 * np.log(np.diag(low)).sum()
            if now >= before - Q.SETTLED:
                break
            before = now
        found.append((now, m, low))
    _, m, low = min(found, key=lambda f: f[0])
    return ~stats.base_failed.to_numpy(bool) & (distance(x, m, low) <= Q.CUTOFF)


def test_quality_rules_reject_planted_outliers(spark):
    from shelfcast.llm.quality_rules import judge
    docs = spark.createDataFrame([(d, t, "en", "s") for d, t in outlier_rows()], "doc_id long, text string, lang string, source string")
    out = judge(docs).toPandas()
    kept = dict(zip(out.doc_id, out.kept))
    assert not any(kept[d] for d in (9000, 9001, 9002, 9003)) and not out.base_failed.loc[out.doc_id >= 9000].any()
    assert sum(kept[d] for d in range(300)) >= 298
    assert list(out.kept) == list(mcd_verdict(out))


@pytest.mark.parametrize("frequent", [0, 3])
def test_suffix_dedup_splits_frequent_anchors(spark, rows, frequent):
    from shelfcast.llm.suffix_dedup import dedup_substrings
    same(dedup_substrings(frame(spark, rows), frequent=frequent).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), brute.op9(rows))


def phrase_blocks():
    """Blocks whose documents share a phrase of 48 bytes in surroundings of their own."""
    import numpy as np

    from shelfcast.llm import common as C
    rng = random.Random(6)
    letters = lambda n: bytes(rng.choice(b"abcdefghijklmnop") for _ in range(n))
    phrase = letters(48)
    for b in range(4):
        texts = [letters(60) + phrase + letters(60) for _ in range(100)]
        yield np.arange(100 * b, 100 * b + 100), np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])


def test_no_key_of_suffix_dedup_grows_with_a_phrase():
    import numpy as np

    from shelfcast.llm import common as C
    from shelfcast.llm import suffix_dedup as S
    received, asked, parts = [], [], []
    for ids, data, offsets in phrase_blocks():
        part = [(0, len(ids), S._Segments(data, offsets, 50, 24))]
        keys, twice, inverse = S._anchor_keys(part)
        parts.append((part[0][2], ids))
        asked.append([keys, twice, S._segment_counts(part, keys, inverse)])
    replies = S._recurring(50)(asked)
    for (s, ids), (keys, _, _), reply in zip(parts, asked, replies):
        many = np.unpackbits(np.frombuffer(reply[len(reply) // 2:], np.uint8), count=len(keys)).astype(bool)
        every = np.arange(len(s.pos))
        request = S._Requests(s.anchor, s.lo, s.hi, ids[s.doc], s.rows(every), many[np.searchsorted(keys, s.anchor)], 50)
        received.append(request.arrays[0])
    shared = np.concatenate([s.anchor for s, _ in parts])
    assert np.unique(shared, return_counts=True)[1].max() >= 200
    assert np.unique(np.concatenate(received), return_counts=True)[1].max() <= 50
    shares = np.diff(sum(C.bucket_bounds(np.sort(keys), 4) for keys in received))
    assert shares.max() < 1.5 * shares.mean()


def lm_parts(spark, rows, block_bytes=1 << 12):
    import public_tokenizers

    from shelfcast.llm import attention_lm as A
    from shelfcast.llm import common as C
    from shelfcast.llm import packing
    tokenizer = packing.tokenizer_text(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    blocks = C.pack_blocks(frame(spark, rows), "lm-blocks", block_bytes)
    encoded = A.encode(blocks.join(C.exchange(blocks, A._ask, A._total, 3, "counts"), "block", "left"), tokenizer)
    return A, A.Subwords(tokenizer), encoded


def lm_words(text):
    return brute.words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def lm_trains(A, C, d):
    return not A._is_held_out(np.array([C.NULL_ID if d is None else d]))[0]


def test_attention_counts_all_training_text(spark, rows):
    from shelfcast.llm import common as C
    A, sub, encoded = lm_parts(spark, rows)
    words, distinct, seen = np.zeros(sub.size, np.int64), np.zeros(sub.size, np.int64), set()
    for d, t in rows:
        if lm_trains(A, C, d):
            for w in lm_words(t):
                words[sub.first_ids([w.encode()])[0]] += 1
                seen.add(w)
    for w in seen:
        distinct[sub.first_ids([w.encode()])[0]] += 1
    got = A.id_counts(encoded, sub.size)
    assert (got[0] == words).all() and (got[1] == distinct).all()


def test_attention_first_ids_by_unit(spark, rows):
    """The first id of a word's first unit is the whole word's."""
    A, sub, _ = lm_parts(spark, rows[:3])
    rng = random.Random(2)
    words = ["".join(rng.choice("abz\xe9\xf7\xd7\xdf\u03b1\u20ac09!'#_-~\xa0\x1c\u0301") for _ in range(rng.randint(1, 7))) for _ in range(20_000)]
    words += ["'s", "it's", "<|endoftext|>", "x<|endoftext|>", "a" * 5000, "\xfcber-9", "1,234.5"]
    whole = [e.ids[0] for e in sub.model.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]
    assert sub.first_ids([w.encode() for w in words]).tolist() == whole


def two_languages(n=260, seed=8):
    """Documents of 120 words, each in one of two languages without common words."""
    rng = random.Random(seed)
    words = [["".join(rng.choice(a) for _ in range(6)) for _ in range(150)] for a in ("abcdefgh", "stuvwxyz")]
    return [(i, " ".join(rng.choice(words[i % 2]) for _ in range(120))) for i in range(n)]


def test_attention_score_by_text(spark, rows):
    """Every text's score, token by token and window by window, from the fitted model."""
    import math
    from collections import Counter

    from shelfcast.llm import common as C
    rows = [*rows, *((10_000 + d, t) for d, t in two_languages(60))]
    A, sub, encoded = lm_parts(spark, rows)
    words, distinct = A.id_counts(encoded, sub.size)
    ends = sum(lm_trains(A, C, d) for d, _ in rows)
    model = A.fit(encoded, words, distinct, ends, rounds=1, share=1)
    tokenizer = sub.model.to_str()
    count = Counter(w for d, t in rows if lm_trains(A, C, d) for w in lm_words(t))
    classes = {w: int(model.cls[sub.first_ids([w.encode()])[0]]) for _, t in rows for w in lm_words(t)}
    of_class, kinds = Counter({0: ends}), Counter({0: int(ends > 0)})
    for w, n in count.items():
        of_class[classes[w]] += n
        kinds[classes[w]] += 1
    stride = A.CONTEXT - A.OVERLAP
    original = A.fit
    A.fit = lambda *_: model
    try:
        got = sorted(((r["doc_id"], round(r["score"], 2)) for r in A.score(frame(spark, rows), tokenizer).collect()), key=key)
    finally:
        A.fit = original
    want = []
    for d, t in rows:
        tokens = [*((classes[w], count[w]) for w in lm_words(t)), (0, ends)]
        if len(tokens) > 2_000:
            continue
        value = 0.0
        for i, (cls, c) in enumerate(tokens):
            begin = 0 if i < A.CONTEXT else stride * -(-(i - A.CONTEXT + 1) // stride)
            x = np.array([[tokens[j - 1][0] if j else 0 for j in range(begin, i + 1)]])
            value += A.forward(model.weights, x)[0][0, -1, cls] / math.log(10)
            value += math.log10((c + 0.1) / (of_class[cls] + 0.1 * (kinds[cls] + 1)))
        want.append((d, value))
    short = {}
    for d, v in want:
        short.setdefault(d, []).append(v)
    for d, values in short.items():
        have = sorted(v for i, v in got if i == d)
        if len(have) == len(values):
            assert np.allclose(have, sorted(values), atol=0.02, rtol=1e-4), d


def test_attention_beats_the_unigram(spark):
    """On held-out texts, after training; every task's windows count."""
    rows = two_languages()
    A, sub, encoded = lm_parts(spark, rows, 1 << 14)
    words, distinct = A.id_counts(encoded, sub.size)
    assert words.sum() == sum(120 for d, _ in rows if lm_trains(A, A.C, d))
    kind = A.kinds_of_ids(encoded, words)
    language = {}
    for d, t in rows:
        for i in sub.first_ids([w.encode() for w in lm_words(t)]).tolist():
            language.setdefault(i, set()).add(d % 2)
    by_kind = {}
    for i, of in language.items():
        if len(of) == 1 and kind[i] < A.KINDS:
            by_kind.setdefault(int(kind[i]), set()).update(of)
    assert by_kind and all(len(of) == 1 for of in by_kind.values())  # no kind mixes the languages
    chosen = A.training_windows(encoded, A.classes_of_ids(words, kind), 1)
    assert sum(len(A.C.unpack_arrays(r["windows"])[0]) for r in chosen.collect()) == sum(10 for d, _ in rows if lm_trains(A, A.C, d))
    plain, trained = (A.fit(encoded, words, distinct, 234, rounds=r, share=1) for r in (0, 3))
    x = plain.cls[sub.first_ids([w.encode() for w in lm_words(rows[1][1])])].astype(np.int64)
    bounds = np.array([0, len(x)])
    assert A._log10_classes(trained, x, bounds).mean() > A._log10_classes(plain, x, bounds).mean() + 0.1


def test_minhash_forms_few_pairs_of_unlike_copies(spark, monkeypatch):
    """Copies of one text, each with five words changed elsewhere, are not similar
    to one another: their counts by segment rule nearly all pairs out."""
    from shelfcast.llm import minhash as M
    rng, rows = random.Random(4), []
    for d in range(80):
        words = [f"w{i}" for i in range(200)]
        for at in rng.sample(range(8, 192), 5):
            words[at] = f"own{d}x{at}"
        rows.append((d, " ".join(words)))
    rows.append((80, rows[0][1] + " end"))
    formed, star_pairs = [], M.star_pairs

    def counted(*args):
        out = star_pairs(*args)
        formed.append(out.count())
        return out

    monkeypatch.setattr(M, "star_pairs", counted)
    same(M.near_duplicates(frame(spark, rows)), brute.op10(rows))
    assert 0 < sum(formed) < 5 * len(rows)


def test_attention_learns_from_every_training_token(spark, monkeypatch):
    """By its settings: over all rounds each token of a training document, and its end, is learned from once."""
    rows = two_languages()
    A, sub, encoded = lm_parts(spark, rows, 1 << 14)
    rounds, learn = [], A.learn

    def seen(weights, chosen, number):
        rounds.append(sum(int(A.C.unpack_arrays(r["windows"])[2].sum()) for r in chosen.collect()))
        return learn(weights, chosen, number)

    monkeypatch.setattr(A, "learn", seen)
    A.fit(encoded, *A.id_counts(encoded, sub.size), 234)
    assert sum(rounds) == sum(121 for d, _ in rows if lm_trains(A, A.C, d)) and len(rounds) == A.ROUNDS and min(rounds) > 0


def test_attention_rows_far_apart():
    """Softmax rows whose values differ by far more than exp can hold."""
    from shelfcast.llm import attention_lm as A
    z = np.array([[900, 899, 0], [-900, -901, -950], [3, 2, 1]], np.float32)
    for shown in (None, np.tril(np.ones((3, 3), np.float32))):
        e, total, shift = A._exp_rows(z.copy(), shown)
        want = np.where(np.ones((3, 3)) if shown is None else shown > 0, np.exp((z - z.max(1, keepdims=True) if shown is None else z - np.array([[900], [-900], [3]])).astype(float)), 0)
        assert np.allclose(e / total[:, None], want / want.sum(1, keepdims=True), atol=1e-6)
        assert np.allclose(shift + np.log(total), z.astype(float).max(1) + np.log(want.sum(1)), atol=1e-4)


def test_packing_ids_are_the_librarys():
    """Of whole texts of words, signs, white space and added tokens, through the table of units."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from shelfcast.llm import packing
    text = packing.tokenizer_text(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    library, encoder = Tokenizer.from_str(text), packing.UnitEncoder(text)
    rng = random.Random(6)
    words = ["".join(rng.choice("abehinrstz\xe9\xdf\xfc") for _ in range(rng.randint(1, 9))) for _ in range(3000)] + ["it's", "'ll", "1,2", "<|endoftext|>", "\u03b1\u03b2", "\xa0x", "--", "\u20ac5", "x\u0301y"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\n", " \n\t", ". ", ""]) for _ in range(rng.randint(0, 200))) for _ in range(400)]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(texts) == want
    assert len([u for u in encoder.table if packing._PLAIN(u)]) > 1000


def crafted(length):
    """Two words of letters that a polynomial hash modulo 2**64 can't tell apart."""
    word = "a"
    while len(word) < length:
        word += word.translate({97: 98, 98: 97})
    return word, word.translate({97: 98, 98: 97})


@pytest.mark.parametrize("length", [1024, 4096])
def test_crafted_words_are_not_equal(spark, length):
    from shelfcast.llm.minhash import near_duplicates
    from shelfcast.llm.phrase_dedup import dedup_passages
    x, y = crafted(length)
    tail = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{x} {tail}"), (2, f"{y} {tail}"), (3, f"{x} k"), (4, f"{y} k"), (5, f"{x} {tail}"), (6, f"{y} k")]
    same(dedup_passages(frame(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256"), brute.op5(rows))
    same(near_duplicates(frame(spark, rows)), brute.op10(rows))


def test_word_hashes_by_run(spark):
    import numpy as np

    from shelfcast.llm import common as C
    texts = ["one two two", "three", "", "one", "\u00e9\u00e9 x" * 40, " ".join("a" * n + " " + "a" * n + "b" for n in range(1, 40)), "a\0 a\0\0 end"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    starts, ends, _ = C.word_spans(data, offsets)
    whole = C.word_hashes(data, starts, ends)
    words = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    assert all((whole[i] == whole[j]) == (words[i] == words[j]) for i in range(len(words)) for j in range(len(words)))
    assert (C.word_hashes(data, starts, ends, run=7) == whole).all() and len(words) > 40


def test_added_tokens_are_the_librarys(spark):
    import public_tokenizers

    from shelfcast.llm import packing
    tokenizer = packing.tokenizer_text(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    rows = [(1, "<|endoftext|>"), (2, "a b<|endoftext|> c  <|endoftext|><|endoftext|>d'll"), (3, "<|endoftext|"), (4, "x <|endoftext|> " * 300)]
    out = packing.pieces(frame(spark, rows), tokenizer).select("doc_id", "piece", "start", "length", "ids_crc32")
    same(out, brute.op2_pieces(rows))


def test_packing_takes_the_programs_configurations():
    import random

    from shelfcast.llm import packing
    n = lambda p: sum(k for _, k in p)
    rng = random.Random(3)
    cases = [{500: 1000, 300: 1000, 210: 1000}, {400: 3000, 333: 3000, 280: 3000}, {1024: 5}, {1: 7}, {513: 40, 512: 41, 511: 40}]
    cases += [{rng.randint(1, 1024): rng.randint(1, 50) for _ in range(rng.randint(1, 60))} for _ in range(6)]
    for i, histogram in enumerate(cases):
        lengths, counts = packing.np.array(sorted(histogram)), packing.np.array([histogram[x] for x in sorted(histogram)])
        found, plain = packing.plan(histogram), n(packing.best_fit(lengths, counts, 1024))
        have = {}
        for content, k in found:
            assert sum(content) <= 1024 and k > 0
            for x in content:
                have[x] = have.get(x, 0) + k
        assert have == histogram and n(found) <= plain
        assert n(found) >= -(-sum(x * c for x, c in histogram.items()) // 1024)
        if i == 0:
            assert n(found) == 1000 < plain
        if i == 1:
            assert n(found) < 3200 < plain


def test_packing_encodes_slices():
    """A batch's units don't all stand in memory at once."""
    from shelfcast.llm import packing

    class Encoder(packing.UnitEncoder):
        def __init__(self):
            self.seen = []

        def encode(self, texts):
            self.seen.append(texts)
            return [t.encode() for t in texts]

    texts = ["a" * n for n in (3, 0, 9, 4, 5, 30, 1, 0)]
    encoder = Encoder()
    assert list(encoder.encode_slices(texts, 10)) == [t.encode() for t in texts]
    assert [len(s) for s in encoder.seen] == [3, 3, 2] and list(encoder.encode_slices([], 10)) == []


def test_packing_deals_pieces_by_part_and_length(spark):
    """Pieces of one length (many have 1024) don't meet in one task."""
    import re

    from shelfcast.llm import packing
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = [(i, 0, 0, 1024, 7, None, i % 4, i // 4) for i in range(40)]
        out = packing.pack(spark.createDataFrame(rows, packing.PIECES))
        dealt = re.findall(r"Exchange hashpartitioning\((\w+)#\d+, (\w+)", out._jdf.queryExecution().executedPlan().toString())
        assert dealt.count(("part", "length")) == 2  # both sides of the join
        assert sorted(r["sequence_id"] for r in out.collect()) == list(range(40))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_attention_plain_words_are_units_at_once(monkeypatch):
    """Words of ASCII letters need no search for their unit; the mask of a window size is made once."""
    import public_tokenizers

    from shelfcast.llm import attention_lm as A
    from shelfcast.llm import packing
    sub = A.Subwords(packing.tokenizer_text(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read()))
    looked, unit = [], A._UNIT
    monkeypatch.setattr(A, "_UNIT", lambda w: looked.append(w) or unit(w))
    words = ["plain", "z" * 300, "it's", "1,2", "\xfcber", "the"]
    want = [e.ids[0] for e in sub.model.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]
    assert sub.first_ids([w.encode() for w in words]).tolist() == want
    assert looked == ["it's".encode(), b"1,2", "\xfcber".encode()]
    mask = A._earlier(2, 3, np.dtype(np.float32))
    assert mask is A._earlier(2, 3, np.dtype(np.float32)) and (mask == np.tile(np.tril(np.ones((3, 3))), (2, 1))).all()


def test_attention_known_words_are_not_looked_at_again(monkeypatch):
    """A worker looks at a word's letters once, whatever the number of blocks that hold it; a full table starts anew."""
    import public_tokenizers

    from shelfcast.llm import attention_lm as A
    from shelfcast.llm import packing
    sub = A.Subwords(packing.tokenizer_text(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read()), hashes=6)
    looked, first_ids = [], sub.first_ids
    monkeypatch.setattr(sub, "first_ids", lambda words: looked.extend(words) or first_ids(words))

    def ids_of(words):
        keys = np.array([sum(w) for w in words], np.uint64)  # stands for the hashes
        order = np.argsort(keys)
        got = sub.first_ids_by_hash(keys[order], lambda new: [words[i] for i in order[new]])
        assert got.tolist() == [sub.model.encode(" " + words[i].decode(), add_special_tokens=False).ids[0] for i in order]

    ids_of([b"the", b"cat", b"it's"])
    ids_of([b"cat", b"dog", b"the"])
    assert sorted(looked) == [b"cat", b"dog", b"it's", b"the"]
    ids_of([])
    ids_of([b"more", b"words", b"cat"])
    assert sorted(looked[4:]) == [b"more", b"words"]
    ids_of([b"one", b"it's"])  # seven words: the table is full
    ids_of([b"one", b"dog"])
    assert looked[6:] == [b"one", b"dog"]


def test_word_hashes_letter_by_letter():
    """Spans, hashes and distinct hashes against a plain version, for words of all lengths at all places."""
    import xxhash

    from shelfcast.llm import common as C
    rng = random.Random(6)
    texts = [b"", b" ", b"a", b"ab", *(b" ".join(bytes(rng.choice(b"abc\x00\xff") for _ in range(rng.randint(1, 40 if d % 2 else 3))) for _ in range(40)) + b"\n" * (d % 3) for d in range(30))]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    starts, ends, first = C.word_spans(data, offsets)
    words = [t.split() for t in texts]
    raw = data.tobytes()
    assert [raw[a:b] for a, b in zip(starts, ends)] == [w for ws in words for w in ws]
    assert np.diff(first).tolist() == [len(ws) for ws in words]

    def hash_of(w):
        if len(w) > 16:
            return xxhash.xxh3_64_intdigest(w, seed=20240501)
        low, high = (np.array([int.from_bytes(w[i:i + 8], "little")], np.uint64) for i in (0, 8))
        return int(C.mix(low ^ C.mix(high ^ C.mix(np.array([len(w)], np.uint64) + C._SLOT[63])))[0])

    hashes = C.word_hashes(data, starts, ends, 64)
    assert hashes.tolist() == [hash_of(w) for ws in words for w in ws]
    for some in (hashes, hashes[:1], hashes[:0]):
        for got, want in zip(C.distinct(some), np.unique(some, return_index=True, return_inverse=True)):
            assert got.tolist() == want.tolist()


def test_attention_logits_and_transposes():
    """One product with the bias in it gives the values of a product and a sum."""
    from shelfcast.llm import attention_lm as A
    w, rng = A.start_weights(), np.random.default_rng(1)
    w["b"] = rng.normal(0, 1, w["b"].shape).astype(np.float32)
    top, a = rng.normal(0, 1, (40, A.DIM)).astype(np.float32), rng.normal(0, 1, (3, 5, 4))
    assert np.allclose(A._logits(w, top), top @ w["u"] + w["b"], atol=1e-6)
    assert (A._turned(a) == a.transpose(0, 2, 1)).all() and A._turned(a).flags.c_contiguous


def odd_words(n, seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abz\xe9\xf7\xd7\xdfα€09!'#_-~\xa0\x1ć ") for _ in range(rng.randint(1, 9))) for _ in range(n)]
    return [*dict.fromkeys([*words, "'s", "it's", "<|endoftext|>", "x<|endoftext|>", "a" * 5000, "\xfcber-9", "1,234.5", "　", "internationalisation"])]


def test_attention_ids_are_the_librarys():
    """All ids of a word, not the first alone; also of words known from earlier blocks and when the table starts anew."""
    import public_tokenizers

    from shelfcast.llm import attention_lm as A
    from shelfcast.llm import packing
    text = packing.tokenizer_text(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    words = odd_words(9_000)
    want = [e.ids for e in A.Subwords(text).model.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]
    assert max(map(len, want)) > 100 and sum(len(i) > 1 for i in want) > 4_000
    for hashes in (1 << 20, 5_000):
        sub, rng = A.Subwords(text, hashes=hashes), np.random.default_rng(0)
        for _ in range(6):
            mine = np.sort(rng.choice(len(words), 3_000, replace=False))
            first, more, further = sub.ids_by_hash(mine.astype(np.uint64), lambda new: [words[i].encode() for i in mine[new]])  # noqa: B023
            cuts = np.concatenate([[0], np.cumsum(more)]).astype(int)
            assert [[f, *further[a:b].tolist()] for f, a, b in zip(first.tolist(), cuts[:-1], cuts[1:])] == [want[i] for i in mine]


def test_attention_gradients_of_further_ids():
    from shelfcast.llm import attention_lm as A
    w = {k: v.astype(np.float64) for k, v in A.start_weights(6, 4, 5).items()}
    rng = np.random.default_rng(1)
    w["f"] = rng.normal(0, 0.3, (6, 4))
    x = rng.integers(0, 6, (3, 5))
    word, bounds, further = rng.integers(0, 5, (3, 5)), np.array([0, 0, 0, 2, 3, 6]), np.array([1, 4, 4, 2, 3, 2])
    word[0, 0] = 4
    bags = A.Bags.of(word, bounds, further)
    assert bags.cls.tolist() == [c for i in word.ravel() for c in further[bounds[i]:bounds[i + 1]]]
    y, use = (x + 1) % 6, np.ones(x.shape, bool)
    loss = lambda: -A.forward(w, x, bags)[0][np.arange(3)[:, None], np.arange(5), y].mean()
    assert abs(loss() + A.log_of(w, x, y, use, bags).mean()) < 1e-6
    g = A.gradients(w, x, y, use, bags)
    for name in w:
        for at in ((0,) * w[name].ndim, (2,) * w[name].ndim):
            before, eps = w[name][at], 1e-5
            w[name][at] = before + eps
            up = loss()
            w[name][at] = before - eps
            down = loss()
            w[name][at] = before
            assert abs((up - down) / (2 * eps) - g[name][at]) < 1e-5, name


def test_attention_sees_and_predicts_all_ids(spark, rows):
    """The query's score of every text, token by token and id by id, from the model that it fits."""
    import math
    from collections import Counter

    from shelfcast.llm import common as C
    rows = [*rows, *((10_000 + d, t) for d, t in two_languages(60))]
    A, sub, encoded = lm_parts(spark, rows)
    tokenizer, fit, fitted = sub.model.to_str(), A.fit, []
    A.fit = lambda *a: fitted.append(fit(*a)) or fitted[0]
    try:
        got = [(r["doc_id"], r["score"]) for r in A.score(frame(spark, rows), tokenizer).collect()]
    finally:
        A.fit = fit
    model = fitted[0]
    inside = model.further
    ids = {w: sub.model.encode(" " + w, add_special_tokens=False).ids for _, t in rows for w in lm_words(t)}
    count = Counter(w for d, t in rows if lm_trains(A, C, d) for w in lm_words(t))
    ends = sum(lm_trains(A, C, d) for d, _ in rows)
    further, firsts = Counter(i for w in count for i in ids[w][1:]), Counter(ids[w][0] for w in count)
    assert (A.further_counts(encoded, sub.size) == [further[i] for i in range(sub.size)]).all() and sum(further.values()) > 100
    cls = lambda i: int(model.cls[i])
    later = lambda i: int(inside.cls[i])
    stride, size = A.CONTEXT - A.OVERLAP, sub.size

    def begin(i):
        return 0 if i < A.CONTEXT else stride * -(-(i - A.CONTEXT + 1) // stride)

    def share(counts, of, i):
        return (counts[i] + 0.1) / sum(counts[j] + 0.1 for j in np.flatnonzero(of == of[i]).tolist())

    shares: dict = {}
    of_class, kinds = Counter(), Counter()
    for w, n in count.items():
        of_class[cls(ids[w][0])] += n
        kinds[cls(ids[w][0])] += 1

    def in_class(w):
        first, *rest = ids[w]
        q = math.log(shares.setdefault((0, first), share(firsts, model.cls[:size], first)))
        x = [A.CLASSES + cls(first), *(later(i) for i in rest)]
        for i, y in enumerate([*(later(i) for i in rest), 0]):
            q += A.forward(inside.weights, np.array([x[begin(i):i + 1]]))[0][0, -1, y]
        q += sum(math.log(shares.setdefault((1, i), share(further, inside.cls, i))) for i in rest)
        mass = A.SHARED * (kinds[cls(first)] + 1)
        return math.log((count[w] + mass * math.exp(q)) / (of_class[cls(first)] + mass)) if count[w] or q > -600 else None

    known: dict = {}
    want: dict = {}
    for d, t in rows:
        words = lm_words(t)
        if len(words) > 120 or any(len(ids[w]) > 200 for w in words):
            continue
        value = 0.0
        for i, w in enumerate([*words, None]):
            seen = [None if j < 0 else words[j] for j in range(begin(i) - 1, i)]
            seen[0] = None if begin(i) == 0 else seen[0]
            x = np.array([[0 if s is None else cls(ids[s][0]) for s in seen]])
            lists = [[] if s is None else [later(k) for k in ids[s][1:]] for s in seen]
            bags = A.Bags.of(np.arange(len(seen)), np.concatenate([[0], np.cumsum([len(v) for v in lists])]).astype(int), np.array(sum(lists, []), int))
            value += A.forward(model.weights, x, bags)[0][0, -1, 0 if w is None else cls(ids[w][0])]
            if w is not None:
                value += known[w] if w in known else known.setdefault(w, in_class(w))
        want.setdefault(d, []).append(value / math.log(10))
    assert len(want) >= 60
    for d, values in want.items():
        have = sorted(v for i, v in got if i == d)
        if len(have) == len(values):
            assert np.allclose(have, sorted(values), atol=0.02, rtol=1e-4), d


def test_attention_learns_inside_every_distinct_word(spark):
    """Each distinct training word's further ids and end, once over all parts; words of one first id differ by their further ids."""
    rows = [*two_languages(80), (9_001, "antest anword anther"), (9_002, None)]
    A, sub, encoded = lm_parts(spark, rows, 1 << 13)
    words, distinct = A.id_counts(encoded, sub.size)
    further = A.further_counts(encoded, sub.size)
    chosen = A.further_windows(encoded, A.classes_of_ids(words, A.kinds_of_ids(encoded, words)), A.classes_of_ids(further, np.full(sub.size, A.KINDS))[:-1])
    used = {}
    for r in chosen.collect():
        used[r["part"]] = used.get(r["part"], 0) + int(A.C.unpack_arrays(r["windows"])[2].sum())
    train = {w for d, t in rows if lm_trains(A, A.C, d) for w in lm_words(t)}
    assert sum(used.values()) == sum(len(sub.model.encode(" " + w, add_special_tokens=False).ids) for w in train) and len(used) == A.ROUNDS
    model = A.fit(encoded, words, distinct, 80, 1, 1, further)
    first, more, ids = (np.array(v, np.int64) for v in ([7, 7, 7], [0, 1, 2], [300, 300, 400]))
    got = 10.0 ** (A.log10_words(model, first, more, ids) - model.further.log_mass[model.cls[7]])
    assert len(set(got.tolist())) == 3 and (got > 0).all() and got.sum() < 1
