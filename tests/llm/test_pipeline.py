"""Stages of the corpus pipeline with nulls, repeated rows and empty tables."""

import random

import pytest

import corpus_pipeline as P

from . import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)


def texts(seed, n=40):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def near(text):
    return text + " edited"


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (3, 1, 0)]])
def test_no_classifier_keeps_all(spark, tmp_path, labels):
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(1, texts(1)), (2, None), (3, texts(2)), (3, texts(2)), (None, "")]
    out = P.quality_classifier(spark, docs_of(spark, rows), str(tmp_path))
    assert sorted(map(str, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(str, rows))


def test_near_duplicates_go_by_row(spark):
    x, y, z, n = texts(1), texts(2), texts(3), texts(4)
    rows = [(3, x), (5, near(x)), (5, y), (7, z), (7, z), (8, None), (None, n), (None, near(n)), (None, texts(5))]
    out = P.near_duplicates(spark, docs_of(spark, rows), "")
    have = [(r.doc_id, r.text) for r in out.collect()]
    of_null = [t for d, t in have if d is None]
    assert len(of_null) == 2 and texts(5) in of_null and (n in of_null) != (near(n) in of_null)
    assert sorted((d, t or "") for d, t in have if d is not None) == sorted([(3, x), (5, y), (7, z), (8, "")])
    assert P.near_duplicates(spark, docs_of(spark, []), "").isEmpty()


def without_lines(rows):
    """Stage 2 by brute force: the texts that are left."""
    docs, last = {}, {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            k = brute.line_key(x)
            docs.setdefault(k, set()).add(d)
            last[k] = max(last.get(k, d), d)
    stays = lambda d, x: len(brute.line_key(x)) < 20 or len(docs[brute.line_key(x)]) < 3 or last[brute.line_key(x)] == d
    return [(d, "\n".join(x for x in (t or "").split("\n") if stays(d, x))) for d, t in rows]


def without_passages(rows, window=13):
    """Stage 4: removed words go with the white space before them."""
    spans = [[m.span() for m in brute.WORD.finditer(t or "")] for _, t in rows]
    gone = brute.windows_removed([(d, brute.words_of(t)) for d, t in rows], window)
    out = []
    for (d, t), words, cut in zip(rows, spans, gone):
        text, last = "", 0
        for i, (a, b) in enumerate(words):
            if cut[i]:
                text += (t or "")[last:max(last, words[i - 1][1] if i else 0)]
                last = b
        out.append((d, text + (t or "")[last:]))
    return out


def test_run_against_brute_stages(spark, tmp_path):
    """Every stage of run() but the classifier's verdict, which is taken as it
    is after a look at whom it rejects."""
    rng = random.Random(8)
    passage, line = texts(70, 30), "A line that many of them share, word by word"
    good = [(i, texts(i, rng.randint(30, 90))) for i in range(60)]
    good += [(100 + i, texts(200 + i, 25) + " " + passage + " " + texts(300 + i, 25)) for i in range(4)]
    good += [(120 + i, texts(400 + i, 40) + "\n  " + line.upper() + " \n" + texts(500 + i, 12)) for i in range(4)]
    base = texts(600, 150)
    good += [(140, base), (141, near(base)), (142, base), (143, texts(700, 4000))]
    junk = [(1000 + i, " ".join(f"w{j % 7}###" for j in range(i, i + 60))) for i in range(40)]
    empty = [(2000, None), (2001, "")]
    rows = good + junk + empty
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(d, 1, 0) for d, _ in good[:60]] + [(d, 0, 0) for d, _ in junk[:30]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in P.quality_classifier(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect()}
    assert not kept & {d for d, _ in junk} and len(kept & {d for d, _ in good}) > 60
    want = without_lines([r for r in rows if r[0] in kept])
    alone = {d for (d, *_, stays) in brute.op10(want) if stays}
    want = without_passages([r for r in want if r[0] in alone])
    out = P.run(spark, str(tmp_path)).toPandas()
    have = sorted(map(tuple, out[["doc_id", "piece", "start", "length", "ids_crc32"]].values.tolist()))
    assert have == sorted(brute.op2_pieces(want))
    assert alone >= {d for d, _ in good if d in kept} - {141, 142} and (out.length.max() == 1024)
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g.length.sum() <= 1024 and (g.length.cumsum() - g.length == g.offset).all()
