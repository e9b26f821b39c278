"""Gradient boosting for count data on Spark ML trees (O-55..O-57, O-14).

MLlib's ``GBTRegressor`` only offers squared and absolute loss. Poisson and
Tweedie boosting are built as Newton boosting over MLlib regression trees:
with a log link and margin F, for Tweedie power p (p = 1 is Poisson)

    g = -y e^{(1-p)F} + e^{(2-p)F}
    h = -y (1-p) e^{(1-p)F} + (2-p) e^{(2-p)F}      (> 0 for 1 <= p < 2)

A regression tree fitted to z = -g/h with instance weight h has leaf values
sum(-g)/sum(h), the Newton step, and its weighted-variance split gain ranks
splits like the Newton gain. Each round is a distributed tree fit; only the
tree (a few KB) reaches the driver.

Row sampling ("bagging") and per-node column sampling use a one-tree
``RandomForestRegressor`` (``subsamplingRate``, ``featureSubsetStrategy``);
without sampling a ``DecisionTreeRegressor`` is used. Leaf-wise growth with
N leaves is approximated by depth-wise trees of depth ~log2(N).

Lineage: the margin column is updated every round, so the training frame is
persisted and, every few rounds, written as a table in the shared checkpoint
folder and read back; a lost executor recomputes from the last written
table only. Intermediate tables are deleted once the trees are fitted (the
model does not depend on them).

The fitted model is a plain ``PipelineModel`` (assembler, one tree per round,
and a SQL step summing the margins), so ``save``/``load`` are MLlib's own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, drop_path, stage_table


@dataclass
class BoostParams:
    power: float = 1.1            # 1.0 = Poisson, (1, 2) = Tweedie
    rounds: int = 90
    learning_rate: float = 0.1
    max_depth: int = 5            # stands in for 31 leaves
    min_instances: int = 20
    max_bins: int = 63
    row_fraction: float = 1.0
    col_fraction: float = 1.0
    seed: int = 42
    checkpoint_every: int = 5
    early_stopping_rounds: int | None = None


@dataclass
class BoostResult:
    model: PipelineModel
    base_margin: float
    history: list[dict] = field(default_factory=list)
    best_round: int | None = None


def grad_hess(y, margin, power: float):
    """Columns (g, h) of the Tweedie / Poisson deviance at ``margin``."""
    p = power
    a = F.exp(margin * (1.0 - p))
    b = F.exp(margin * (2.0 - p))
    g = -y * a + b
    h = -y * (1.0 - p) * a + (2.0 - p) * b
    return g, h


def _tree(params: BoostParams, rnd: int, pred_col: str):
    common = dict(featuresCol="features", labelCol="__z", weightCol="__h",
                  predictionCol=pred_col, maxDepth=params.max_depth,
                  minInstancesPerNode=params.min_instances, maxBins=params.max_bins,
                  seed=params.seed + rnd)
    if params.row_fraction < 1.0 or params.col_fraction < 1.0:
        return RandomForestRegressor(numTrees=1, bootstrap=False,
                                     subsamplingRate=params.row_fraction,
                                     featureSubsetStrategy=str(params.col_fraction), **common)
    return DecisionTreeRegressor(**common)


def _rmse(df: DataFrame, label: str, margin: str) -> float:
    e = F.col(label).cast("double") - F.exp(F.col(margin))
    return float(df.agg(F.sqrt(F.avg(e * e))).first()[0])


def fit(train: DataFrame, features: Sequence[str], label: str, params: BoostParams,
        valid: DataFrame | None = None) -> BoostResult:
    """Fit the booster; ``valid`` enables per-round holdout RMSE and, with
    ``early_stopping_rounds``, stopping after that many rounds without gain."""
    spark = train.sparkSession
    checkpoint_dir(spark)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    y = F.col(label).cast("double")
    base = train.agg(F.avg(y)).first()[0]
    base_margin = math.log(max(base, 1e-9))

    # Every round makes several passes over the training rows: spread them
    # over at least the cluster's default parallelism (AQE may have
    # coalesced a small input into a few partitions). Large inputs already
    # have more partitions and are left as they are.
    min_parts = spark.sparkContext.defaultParallelism

    def prep(df):
        out = assembler.transform(df.select(*features, label)).select(
            "features", y.alias("__y"), F.lit(base_margin).alias("__m"))
        if out.rdd.getNumPartitions() < min_parts:
            out = out.repartition(min_parts)
        return out

    data = prep(train).persist(StorageLevel.MEMORY_AND_DISK)
    vdata = prep(valid).persist(StorageLevel.MEMORY_AND_DISK) if valid is not None else None
    staged: list[str] = []

    def cut(df, name):
        out, path = stage_table(df, name)
        staged.append(path)
        return out.persist(StorageLevel.MEMORY_AND_DISK)

    trees, history = [], []
    best, best_round, since_best = float("inf"), None, 0
    lr = params.learning_rate
    import time
    for r in range(params.rounds):
        t0 = time.time()
        g, h = grad_hess(F.col("__y"), F.col("__m"), params.power)
        work = data.withColumns({"__z": -g / h, "__h": h})
        tree = _tree(params, r, f"__p{r}").fit(work)
        trees.append(tree)
        nxt = (tree.transform(data).withColumn("__m", F.col("__m") + lr * F.col(f"__p{r}"))
                   .drop(f"__p{r}"))
        if (r + 1) % params.checkpoint_every == 0:
            nxt = cut(nxt, "boost-train")
        else:
            nxt = nxt.persist(StorageLevel.MEMORY_AND_DISK)
        nxt.count()  # in place before what it is made from goes
        data.unpersist()
        data = nxt
        rec = {"round": r + 1, "sec": round(time.time() - t0, 2)}
        if vdata is not None:
            vn = (tree.transform(vdata).withColumn("__m", F.col("__m") + lr * F.col(f"__p{r}"))
                      .drop(f"__p{r}"))
            vn = cut(vn, "boost-valid") if (r + 1) % params.checkpoint_every == 0 \
                else vn.persist(StorageLevel.MEMORY_AND_DISK)
            rec["valid_rmse"] = _rmse(vn, "__y", "__m")
            vdata.unpersist()
            vdata = vn
            if rec["valid_rmse"] < best - 1e-12:
                best, best_round, since_best = rec["valid_rmse"], r + 1, 0
            else:
                since_best += 1
        history.append(rec)
        if params.early_stopping_rounds and vdata is not None and since_best >= params.early_stopping_rounds:
            break
    data.unpersist()
    if vdata is not None:
        vdata.unpersist()
    for path in staged:
        drop_path(spark, path)
    n_keep = best_round if (params.early_stopping_rounds and best_round) else len(trees)
    model = assemble_model(assembler, trees[:n_keep], base_margin, lr)
    return BoostResult(model, base_margin, history, best_round)


def assemble_model(assembler: VectorAssembler, trees, base_margin: float, lr: float) -> PipelineModel:
    """assembler -> trees (each adds its own prediction column) -> SQL step:
    prediction = exp(base + lr * sum of tree outputs)."""
    terms = " + ".join(f"__p{i}" for i in range(len(trees))) or "0.0"
    drop = ", ".join(f"__p{i}" for i in range(len(trees)))
    sql = (f"SELECT * EXCEPT (features{', ' + drop if drop else ''}), "
           f"exp({base_margin!r} + {lr!r} * ({terms})) AS prediction FROM __THIS__")
    stages = [assembler]
    for i, t in enumerate(trees):
        t.setPredictionCol(f"__p{i}")
        stages.append(t)
    stages.append(SQLTransformer(statement=sql))
    return PipelineModel(stages)
