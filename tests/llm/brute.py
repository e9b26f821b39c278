"""Plain Python versions of the document operators, for small fixtures."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall(text or "")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def _key(doc):
    return -1 << 63 if doc is None else doc


def windows_removed(seqs, width):
    """seqs: (doc_id, sequence) rows. Mask of covered items of each row."""
    least = {}
    for doc, seq in seqs:
        for i in range(len(seq) - width + 1):
            w = tuple(seq[i:i + width])
            least[w] = min(least.get(w, _key(doc)), _key(doc))
    out = []
    for doc, seq in seqs:
        gone = [False] * len(seq)
        for i in range(len(seq) - width + 1):
            if least[tuple(seq[i:i + width])] < _key(doc):
                gone[i:i + width] = [True] * width
        out.append(gone)
    return out


def op5(rows, window=13):
    seqs = [(d, words_of(t)) for d, t in rows]
    out = []
    for (d, w), gone in zip(seqs, windows_removed(seqs, window)):
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def op9(rows, width=50):
    seqs = [(d, (t or "").encode()) for d, t in rows]
    least = {}
    for d, b in seqs:
        for i in range(len(b) - width + 1):
            w = b[i:i + width]
            least[w] = min(least.get(w, _key(d)), _key(d))
    out = []
    for d, b in seqs:
        gone = [False] * len(b)
        for i in range(len(b) - width + 1):
            if least[b[i:i + width]] < _key(d):
                gone[i:i + width] = [True] * width
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def op1(rows):
    from shelfcast.llm import fingerprints as P
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (_key(r[0]), r[1]))
    out = []
    for i, (d, t) in enumerate(rows):
        # The next document is the first row of the next place in the order.
        nxt = rows[(i + 1) % len(rows)][1]
        m = len(t) // 4
        edited = t[:len(t) - m] + nxt[:m]
        f, g, h = (P.fingerprint(x) for x in (t, edited, nxt))
        a, b, c = (P.Fingerprint.parse(x) for x in (f, g, h))
        out.append((d, len(t), sha(edited), f, g, a.likeness(b), a.likeness(c)))
    return out


def op4(rows):
    import numpy as np
    import public_tokenizers
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = []
    for d, t in rows:
        ids = m.encode(t or "", add_bos=True, add_eos=True)
        out.append((d, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(m.decode(ids))))
    return out


def op3_base(rows):
    out = []
    for d, t in rows:
        w = words_of(t)
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        seen = {}
        for i in range(len(w) - 4):
            seen.setdefault(tuple(w[i:i + 5]), []).append(i)
        gone = set()
        for places in seen.values():
            if len(places) > 1:
                for i in places:
                    gone.update(range(i, i + 5))
        sym = sum(c in "#*$%&|<>" for c in t or "")
        out.append((d, len(w), sum(map(len, w)), sym, len(lines) - len(set(lines)), len(gone), len(w) < 10 or 100 * len(gone) > 20 * len(w)))
    return out


def line_key(line):
    s = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def op8(rows):
    docs, last = {}, {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            k = line_key(x)
            if len(k) >= 20:
                docs.setdefault(k, set()).add(_key(d))
                last[k] = max(last.get(k, _key(d)), _key(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(docs.get(line_key(x), ())) < 3 or last[line_key(x)] == _key(d)]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def op10(rows, width=5, threshold=75):
    sets = []
    for d, t in rows:
        w = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in holders[x]:
                if j > i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if 100 * c >= threshold * (len(s) + len(sets[j]) - c):
                root[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), _key(d)), _key(d))
    out = []
    for i, (d, _) in enumerate(rows):
        c = least[find(i)]
        out.append((d, len(sets[i]), None if c == -1 << 63 else c, _key(d) == c))
    return out


def op2_pieces(rows, size=1024, end_id=2):
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [end_id]
        at = 0
        for p in range(-(-len(ids) // size)):
            n = size if p or len(ids) % size == 0 else min(len(ids), len(ids) % size)
            out.append((d, p, at, n, zlib.crc32(np.array(ids[at:at + n], "<u4").tobytes())))
            at += n
        assert at == len(ids)
    return out
