import math

import numpy as np
from pyspark.sql import functions as F

from shelfcast.operators import boosting as B
from shelfcast.operators import trend as TR


def test_trend_recovers_ar_coefficients(spark):
    # Synthetic store totals whose log1p follows the ARX model exactly
    # (plus small noise): the fitted betas must match.
    rng = np.random.default_rng(0)
    beta = {"one": 0.5, "y1": 0.4, "y7": 0.3, "y8": -0.1, "snap": 0.2, "is_event": -0.3}
    rows = []
    for store in ["S1", "S2"]:
        y = [3.0] * 8
        for t in range(8, 600):
            snap = 1 if (t % 30) < 10 else 0
            ev = 1 if t % 97 == 0 else 0
            v = (beta["one"] + beta["y1"] * y[t - 1] + beta["y7"] * y[t - 7] + beta["y8"] * y[t - 8]
                 + beta["snap"] * snap + beta["is_event"] * ev + rng.normal(0, 0.01))
            y.append(v)
            rows.append((store, t + 1, float(np.expm1(v)), snap, ev))
    sd = spark.createDataFrame(rows, "store_id string, day_num int, sales double, snap int, is_event int")
    fc = TR.fit_forecast(sd, 600).collect()
    assert len(fc) == 56
    r = fc[0]
    for k, v in beta.items():
        assert abs(r[f"beta_{k}"] - v) < 0.05, (k, r[f"beta_{k}"])
    assert all(x.store_trend > 0 for x in fc)


def _store_days(spark, rows, parts=4):
    return spark.createDataFrame(rows, "store_id string, day_num int, sales double, snap int, is_event int").repartition(parts)


def test_trend_recovers_moving_average(spark):
    # ARMA totals with planted moving-average terms at lags 1 and 7.
    rng = np.random.default_rng(11)
    n, theta, seasonal, rows = 4000, 0.5, 0.3, []
    for store in ["S1", "S2"]:
        e = rng.normal(0, 0.1, n)
        y = [6.0] * 8
        for t in range(8, n):
            shock = e[t] + theta * e[t - 1] + seasonal * e[t - 7] + theta * seasonal * e[t - 8]
            y.append(2.4 + 0.3 * y[t - 1] + 0.3 * y[t - 7] + 0.15 * (t % 30 < 10) + shock)
        rows += [(store, t + 1, float(np.expm1(v)), int(t % 30 < 10), 0) for t, v in enumerate(y)]
    r = TR.fit_forecast(_store_days(spark, rows), n).first()
    for name, want in {"e1": theta, "e7": seasonal, "e8": theta * seasonal, "y1": 0.3, "y7": 0.3, "snap": 0.15}.items():
        assert abs(r[f"beta_{name}"] - want) < 0.05, (name, r[f"beta_{name}"])


def test_known_regressors_move_the_forecast(spark):
    # A planted SNAP effect in the held-out days: flags of those days, not the
    # last one repeated; their sales must not matter.
    rng = np.random.default_rng(2)
    y, rows = [5.0] * 8, []
    for t in range(8, 1000):
        y.append(2.0 + 0.2 * y[t - 1] + 0.4 * y[t - 7] + 0.5 * (t % 20 < 10) + rng.normal(0, 0.02))
    rows = [("S1", t + 1, float(np.expm1(v)), int(t % 20 < 10), 0) for t, v in enumerate(y)]
    held = [(s, d, 1e9 if d > 972 else v, f, ev) for s, d, v, f, ev in rows]
    plain = {r.day_num: r.store_trend for r in TR.trend_lookup(_store_days(spark, rows), 972).collect()}
    known = {r.day_num: r.store_trend for r in TR.trend_lookup(_store_days(spark, rows), 972, known_future=True).collect()}
    blind = {r.day_num: r.store_trend for r in TR.trend_lookup(_store_days(spark, held), 972, known_future=True).collect()}
    days = range(973, 1001)
    error = lambda f: np.mean([abs(np.log1p(f[d]) - y[d - 1]) for d in days])
    assert error(known) < 0.1 < error(plain)
    assert all(abs(known[d] - blind[d]) < 1e-6 * known[d] for d in days)
    assert max(known) == 1000 and abs(known[900] - plain[900]) < 1e-6 * known[900]
    actual = TR.trend_lookup(_store_days(spark, rows), 972, "actual").where("day_num > 972")
    assert actual.count() == 28  # history is cut at the last training day


def _poisson_frame(spark, n=4000, seed=1):
    rng = np.random.default_rng(seed)
    x1 = rng.uniform(0, 1, n)
    x2 = rng.integers(0, 3, n)
    mu = np.exp(0.5 + 1.5 * x1 + 0.4 * x2)
    y = rng.poisson(mu)
    return spark.createDataFrame([(float(a), int(b), int(c)) for a, b, c in zip(x1, x2, y)],
                                 "x1 double, x2 int, sales int")


def test_newton_boosting_improves_and_roundtrips(spark, tmp_path):
    df = _poisson_frame(spark)
    train, test = df.randomSplit([0.8, 0.2], seed=3)
    res = B.fit(train, ["x1", "x2"], "sales", B.BoostParams(power=1.0, rounds=6, learning_rate=0.5,
                                                            max_depth=3, checkpoint_every=3),
                valid=test)
    hist = [h["valid_rmse"] for h in res.history]
    base = test.agg(F.sqrt(F.avg((F.col("sales") - math.exp(res.base_margin)) ** 2))).first()[0]
    assert hist[-1] < base            # better than the constant model
    assert hist[-1] <= hist[0] + 1e-9
    p1 = res.model.transform(test).select("prediction").collect()
    path = str(tmp_path / "m")
    res.model.write().overwrite().save(path)
    from pyspark.ml import PipelineModel
    p2 = PipelineModel.load(path).transform(test).select("prediction").collect()
    assert all(abs(a.prediction - b.prediction) < 1e-12 for a, b in zip(p1, p2))


def test_tweedie_grad_hess_positive(spark):
    df = spark.createDataFrame([(0.0, -2.0), (3.0, 1.0), (10.0, 0.0)], "y double, m double")
    for p in (1.0, 1.1, 1.5):
        g, h = B.grad_hess(F.col("y"), F.col("m"), p)
        assert all(r[0] > 0 for r in df.select(h).collect())


def test_early_stopping_keeps_best(spark):
    df = _poisson_frame(spark, 2000, seed=5)
    train, test = df.randomSplit([0.8, 0.2], seed=4)
    res = B.fit(train, ["x1", "x2"], "sales",
                B.BoostParams(power=1.1, rounds=8, learning_rate=1.5, max_depth=4,
                              early_stopping_rounds=2, checkpoint_every=4), valid=test)
    assert res.best_round is not None
    assert len(res.model.stages) == res.best_round + 2
