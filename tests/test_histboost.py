"""Histogram boosting against a plain numpy version that splits leaf by leaf."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import histboost as H

SCHEMA = "k int, x1 double, x2 double, c string, store string, sales int"


def rows_of(n, seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        x1, x2, c, store = rng.uniform(0, 1), rng.normal(), int(rng.integers(0, 12)), ["a", "b", None][k % 3]
        mu = np.exp(0.3 + 1.2 * x1 + 0.6 * (c % 2) + 0.4 * (k % 3) - 0.5 * (x2 > 1))
        out.append((k, None if k % 17 == 0 else float(x1), float("nan") if k % 29 == 0 else float(x2), f"c{c}" if k % 31 else None, store, int(rng.poisson(mu))))
    return out


def plain_split(g, h, n, categorical, p):
    """Best split of one node from its sums: [feature][bin]; loops only."""
    total = g[0].sum(), h[0].sum(), n[0].sum()
    score = lambda a, b, l2: a * a / max(b + l2, 1e-12)
    best = (1e-9, None, None)
    options = []
    for f in range(len(g)):
        if not categorical[f]:
            for missing in (False, True):
                options += [(f, [*([0] if missing else []), *range(1, e + 2)], p.l2) for e in range(len(g[f]) - 1)]
    for f in range(len(g)):
        if categorical[f]:
            there = sorted((b for b in range(len(g[f])) if n[f][b]), key=lambda b: (g[f][b] / (h[f][b] + p.cat_smooth), b))
            options += [(f, there[:e + 1], p.l2 + p.cat_l2) for e in range(len(there))]
    for f, left, l2 in options:
        gl, hl, nl = g[f][left].sum(), h[f][left].sum(), n[f][left].sum()
        if min(nl, total[2] - nl) < p.min_instances or min(hl, total[1] - hl) < p.min_hessian:
            continue
        gain = score(gl, hl, l2) + score(total[0] - gl, total[1] - hl, l2) - score(total[0], total[1], p.l2)
        if gain > best[0]:
            best = (gain, f, left)
    return best


def plain_boost(bins, y, base, categorical, n_bins, p, scale):
    """Margins after p.rounds trees, one leaf split at a time."""
    margin = np.full(len(y), base)
    for _ in range(p.rounds):
        g, h = (x / scale for x in H.quantised(y, margin, p.power, scale))
        def sums(rows):
            one = lambda w: np.stack([np.bincount(bins[f][rows], w[rows], n_bins) for f in range(len(bins))])
            return one(g), one(h), one(np.ones(len(y)))
        leaves = [np.arange(len(y))]
        found = [plain_split(*sums(leaves[0]), categorical, p)]
        while len(leaves) < p.num_leaves:
            i = max(range(len(leaves)), key=lambda k: found[k][0])
            if found[i][1] is None:
                break
            _, f, left = found[i]
            rows, goes = leaves[i], np.isin(bins[f][leaves[i]], left)
            leaves[i:i + 1], found[i:i + 1] = [rows[goes], rows[~goes]], [plain_split(*sums(r), categorical, p) for r in (rows[goes], rows[~goes])]
        for rows in leaves:
            margin[rows] += -p.learning_rate * g[rows].sum() / (h[rows].sum() + p.l2)
    return margin


PARAMS = H.HistParams(rounds=4, num_leaves=9, learning_rate=0.2, max_bins=15, min_instances=10, stage_every=2)


@pytest.mark.parametrize("power", [1.0, 1.1])
def test_equals_plain_version(spark, power):
    p = H.HistParams(**{**PARAMS.__dict__, "power": power})
    rows = rows_of(2000)
    df = spark.createDataFrame(rows, SCHEMA)
    for group, parts in ((None, 3), ("store", 5)):
        res = H.fit(df.repartition(parts), ["x1", "x2"], ["c"], "sales", p, group=group)
        got = {r.k: r.prediction for r in res.model.predict(df).collect()}
        batch = df.orderBy("k").toArrow().to_batches()
        bins = np.concatenate([res.model.binner.bins(b) for b in batch], 1).astype(int)
        y, stores = np.array([r[5] for r in rows], float), [r[4] for r in rows]
        want = np.zeros(len(rows))
        for s in {None} if group is None else set(stores):
            mine = np.array([group is None or x == s for x in stores])
            margin = plain_boost(bins[:, mine], y[mine], np.log(y[mine].mean()), res.model.binner.is_categorical, res.model.binner.n_bins, p, H._scales(len(rows), y.max()))
            want[mine] = np.exp(margin)
        assert np.allclose([got[k] for k in range(len(rows))], want, rtol=1e-9)
        assert any(h["passes"] < 9 for h in res.history)


def test_category_effect_in_one_split(spark):
    rows = [(k, 0.5, 0.0, f"c{k % 40}", "a", 8 if k % 2 else 1) for k in range(4000)]
    res = H.fit(spark.createDataFrame(rows, SCHEMA), ["x1", "x2"], ["c"], "sales", H.HistParams(rounds=1, num_leaves=2, learning_rate=1.0))
    t = res.model.trees[0]
    names = res.model.binner.categorical["c"]
    left = {names[b - 1] for b in np.flatnonzero(t.left[0]) if b}
    assert (t.feature >= 0).sum() == 1 and left in ({f"c{i}" for i in range(0, 40, 2)}, {f"c{i}" for i in range(1, 40, 2)})


def test_resumed_run_gives_the_same_trees(spark, tmp_path):
    df = spark.createDataFrame(rows_of(1500, 3), SCHEMA)
    train, valid = df.where("k % 5 > 0"), df.where("k % 5 = 0")
    p = H.HistParams(**{**PARAMS.__dict__, "rounds": 6, "row_fraction": 0.7, "col_fraction": 0.7})
    fit = lambda rounds, state: H.fit(train, ["x1", "x2"], ["c"], "sales", H.HistParams(**{**p.__dict__, "rounds": rounds}), valid, "store", str(state))
    whole = fit(6, tmp_path / "a")
    text = lambda r: [t.to_json() for t in r.model.trees]
    fit(3, tmp_path / "a3")
    # the stopped run had the same rows in the same blocks
    import shutil
    shutil.copytree(tmp_path / "a", tmp_path / "b")
    for r in (3, 4, 5):
        (tmp_path / "b" / f"round-{r:05d}").unlink()
    again = fit(6, tmp_path / "b")
    assert text(again) == text(whole) and len(whole.model.trees) == 6
    assert [h["valid_rmse"] for h in again.history] == [h["valid_rmse"] for h in whole.history]


def test_early_stopping_by_group_and_round_trip(spark, tmp_path):
    df = spark.createDataFrame(rows_of(1200, 7), SCHEMA)
    p = H.HistParams(rounds=30, num_leaves=15, learning_rate=0.6, max_bins=15, min_instances=5, early_stopping_rounds=3)
    res = H.fit(df.where("k % 4 > 0"), ["x1", "x2"], ["c"], "sales", p, df.where("k % 4 = 0"), "store")
    curve = np.array([h["valid_rmse"] for h in res.history], float)
    assert len(res.history) < 30
    for k, best in enumerate(res.model.best_round):
        assert best == int(np.nanargmin(curve[:best + 3, k])) + 1
    assert len(res.model.trees) == max(res.model.best_round)
    path = str(tmp_path / "model")
    res.model.save(spark, path)
    a, b = (m.predict(df).orderBy("k").select("prediction").collect() for m in (res.model, H.HistModel.load(spark, path)))
    assert a == b
    unknown = spark.createDataFrame([(1, 0.5, 0.1, "new", "zzz", 1), (2, 0.5, 0.1, "new", "a", 1)], SCHEMA)
    assert [r.prediction is None for r in res.model.predict(unknown).orderBy("k").collect()] == [True, False]


def test_many_partitions_shuffle_the_sums(spark, monkeypatch):
    df = spark.createDataFrame(rows_of(600, 9), SCHEMA)
    text = lambda: [t.to_json() for t in H.fit(df.repartition(6, "k"), ["x1"], ["c"], "sales", PARAMS).model.trees]
    before = text()
    monkeypatch.setattr(H, "DIRECT_PARTITIONS", 0)
    assert text() == before


def test_depth_bound(spark):
    p = H.HistParams(rounds=1, num_leaves=31, max_depth=3, max_bins=15, min_instances=5)
    res = H.fit(spark.createDataFrame(rows_of(2000, 2), SCHEMA), ["x1", "x2"], ["c"], "sales", p)
    t = res.model.trees[0]
    depth = {0: 0}
    for i, pair in enumerate(t.children.tolist()):
        depth |= {c: depth[i] + 1 for c in pair if c >= 0}
    assert max(depth.values()) == 3 and (t.feature < 0).sum() == 8 and res.history[0]["passes"] == 3


def test_missing_labels_and_empty_valid(spark):
    df = spark.createDataFrame([*rows_of(300, 1), (9999, 0.1, 0.1, "c1", "a", None)], SCHEMA)
    res = H.fit(df, ["x1"], ["c"], "sales", PARAMS, df.where("1 = 0"))
    assert res.history[0]["valid_rmse"] == [None] and len(res.model.trees) == 4
    assert res.model.predict(df).where(F.col("prediction") <= 0).isEmpty()
    assert json.loads(res.model.trees[0].to_json())["roots"] == [0]


def test_packed_sums_come_back():
    at = np.array([0, 3, 4, 900, 1 << 40])
    sums = np.array([[-1, 5, -(1 << 61), 0, 7], [1, 1 << 60, 3, 2, 9], [1, 2, 1 << 40, 4, 5]])
    got = H._unpack(H._pack(at, sums))
    assert (got[0] == at).all() and (got[1] == sums).all()
    assert [x.shape for x in H._unpack(H._pack(at[:0], sums[:, :0]))] == [(0,), (3, 0)]


def test_driver_gets_totals_not_every_tasks_sums(spark, monkeypatch):
    df = spark.createDataFrame(rows_of(1200, 4), SCHEMA)
    received, unpack = [], H._unpack
    monkeypatch.setattr(H, "_unpack", lambda data: received.append(len(data)) or unpack(data))
    res = H.fit(df.repartition(6, "k"), ["x1", "x2"], ["c"], "sales", PARAMS, group="store")
    assert 0 < len(received) <= 3 * sum(h["passes"] for h in res.history)


def test_a_pass_over_few_rows_is_one_stage(spark):
    """Spark's own time for tasks and shuffles is what a pass over a small table takes."""
    df = spark.createDataFrame(rows_of(1200, 5), SCHEMA).repartition(6, "k").cache()
    sc = spark.sparkContext

    def run(rounds):
        sc.setJobGroup(f"rounds-{rounds}", "")
        res = H.fit(df, ["x1", "x2"], ["c"], "sales", H.HistParams(**{**PARAMS.__dict__, "rounds": rounds, "stage_every": 20}))
        tracker = sc.statusTracker()
        return res.history, sum(len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(f"rounds-{rounds}"))

    try:
        (_, few), (history, more) = run(2), run(6)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        df.unpersist()
    assert 0 < more - few <= sum(h["passes"] for h in history[2:])


def test_more_rows_take_more_partitions(spark, monkeypatch):
    df = spark.createDataFrame(rows_of(900, 8), SCHEMA).repartition(6, "k")
    parts, loaded = [], H._loaded
    monkeypatch.setattr(H, "_loaded", lambda *a: parts.append(out := loaded(*a)) or out)
    text = lambda: [t.to_json() for t in H.fit(df, ["x1", "x2"], ["c"], "sales", PARAMS, df.where("k < 90"), "store").model.trees]
    before = text()
    monkeypatch.setattr(H, "PART_ROWS", 300)
    assert text() == before
    assert [p.getNumPartitions() for p in parts] == [1, 4]
