"""Quality classifier by compression with zstandard dictionaries.

One dictionary is built from good and one from bad labelled text. A text is
cut into pieces of ``PIECE`` bytes (all of it), each is compressed with both,
and the difference of the summed sizes, normalised by the text's length,
(bad - good) / bytes, is calibrated by logistic regression into the
probability of label 1. Short texts say little either way, so the calibration
has a second term, 1 / (1 + bytes / 32), for what is known of them beforehand.

Only the training rows' labels are read. Dictionaries and calibration are fit
on a bounded sample of labelled documents: ``PER_CLASS`` of each label for the
dictionaries and as many others for the calibration, taken by hash of doc_id.
Their ids and texts are the only data gathered on the driver, and the model is
two dictionaries of at most ``DICT_BYTES`` and three numbers.

Nulls and ties: a null text is empty and gets the calibrated score of
difference 0 and length 0; rows are independent; labels whose
doc_id or quality is null are not used. A table without both labels among its
training rows gives every text the score 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

PIECE, DICT_BYTES, LEVEL = 1024, 110 << 10, 3
#: Labelled documents of each class for the dictionaries, and for the calibration.
PER_CLASS = 1200
THRESHOLD = 0.7


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, float, float]  # of the difference, of shortness, and the offset


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from (false for a null id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


class Sizer:
    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        self.coders = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            self.coders.append(zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False))

    def difference(self, text: bytes) -> float:
        good, bad = (sum(len(c.compress(text[i:i + PIECE])) for i in range(0, len(text), PIECE)) for c in self.coders)
        return (bad - good) / max(1, len(text))


def _differences(docs: DataFrame, good: bytes, bad: bytes, more: list[str]) -> DataFrame:
    names = ["doc_id", *more]
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = Sizer(good, bad)
        for batch in batches:
            texts = C.text_column(batch).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in names), pa.array([sizer.difference(x) for x in texts], pa.float64()),
                pa.array([1 / (1 + len(x) / 32) for x in texts], pa.float64()),
            ], names=[*names, "difference", "shortness"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", difference double, shortness double"
    return docs.mapInArrow(run, schema)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> np.ndarray:
    """Weights of the columns of ``x`` and the offset, by Newton's method,
    with Platt's smoothed targets."""
    n1, n0 = weight[y > 0].sum(), weight[y == 0].sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = np.where(x.std(0) > 0, x.std(0), 1.0)
    design = np.concatenate([x / scale, np.ones((len(x), 1))], 1)
    w = np.zeros(design.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (weight * (p - target)) + ridge * w
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return np.append(w[:-1] / scale, w[-1])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | None:
    """Model from the labelled rows that aren't held out; None if a class is missing."""
    import zstandard

    known = (labels.where(F.col("doc_id").isNotNull() & ~held_out()).where(F.col("quality").isin(0, 1))
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    totals = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    picked = None
    for q in (0, 1):
        part = known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * per_class)
        picked = part if picked is None else picked.unionAll(part)
    # At most 4 * per_class ids.
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").withColumn("fits", F.xxhash64("doc_id") % 2 == 0)
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    for row in sample.where("fits").select("quality", "text").toLocalIterator():
        raw = (row["text"] or "").encode()
        texts[row["quality"]] += [raw[i:i + PIECE] for i in range(0, len(raw), PIECE)]
    if not texts[0] or not texts[1]:
        return None
    built = []
    for q in (1, 0):
        try:
            built.append(zstandard.train_dictionary(DICT_BYTES, texts[q], level=LEVEL).as_bytes())
        except zstandard.ZstdError:  # too few samples to train on: their text itself
            built.append(b"".join(texts[q])[-DICT_BYTES:] or b" ")
    rest = _differences(sample.where(~F.col("fits")), *built, ["quality"]).select("difference", "shortness", "quality").collect()
    x = np.array([[r[0], r[1]] for r in rest]).reshape(-1, 2)
    y = np.array([r[2] for r in rest])
    if not len(y) or y.min() == y.max():
        return Model(*built, (50.0, 0.0, 0.0))
    # The sample has as many of each class; weights give back their true shares.
    weight = np.where(y > 0, totals[1] / (y > 0).sum(), totals[0] / (y == 0).sum()) * len(y) / sum(totals.values())
    return Model(*built, tuple(float(v) for v in logistic(x, y, weight)))


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, difference, shortness, score (0 to 1), predicted (1 if score >= threshold)
    and the other columns of ``docs``."""
    if model is None:
        scored = docs.withColumn("difference", F.lit(0.0)).withColumn("shortness", F.lit(0.0)).withColumn("score", F.lit(0.5))
    else:
        more = [c for c in docs.columns if c not in ("doc_id", "difference", "shortness", "score", "predicted")]
        scored = _differences(docs, model.good, model.bad, more)
        z = F.col("difference") * model.weights[0] + F.col("shortness") * model.weights[1] + model.weights[2]
        scored = scored.withColumn("score", 1 / (1 + F.exp(-z)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
