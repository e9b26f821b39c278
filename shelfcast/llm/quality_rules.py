"""Quality rules: robust multivariate outliers, with DataFrame functions only.

Base statistics of each text: words, their code points, symbols, lines equal
to an earlier one, and words in five-word windows found twice or more. They
become a vector (``VECTOR``): log length, log mean word length, and the roots
of the shares of symbols, repeated lines and repeated words.

For each language and source the minimum covariance determinant is estimated.
From each of ``STARTS`` (medians and median deviations; mean and covariance of
all rows, of the shorter and the longer half, and of the rows at or below the
medians of the three shares) concentration steps take the ``SUBSET`` share of
the rows with the smallest distances and their mean and covariance, until the
determinant falls no further; the start with the smallest one counts. The
covariance gets a consistency factor; only a direction whose variance is below
the square of ``RIDGE`` (a group where most documents have no symbol at all)
gets that instead. A document is rejected if its squared Mahalanobis distance
exceeds ``CUTOFF``.

Vectors are staged once; every step is one or two aggregations by group and
start with partial aggregation, so a source with a third of all rows is summed
up in many tasks. Settled starts leave the steps. Group tables join back by
AQE's choice of join.

Nulls and ties: a null text has no words; null lang or source are groups of
their own; base_failed documents take no part in the estimates. Groups of less
than ``SMALL`` rows, too few for a covariance, get the squares of ``FLOOR`` on
its diagonal. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table

GROUP = ("lang", "source")
SUBSET = 0.75
#: Consistency of the 0.75 subset in five dimensions: 0.75 / P(chi2_7 <= q) with q the 0.75 quantile of chi2_5.
CONSISTENCY = 1.416
#: The 0.9999 quantile of chi2_5.
CUTOFF = 25.74
#: Standard deviation of a direction in which a group does not vary: less than
#: a tenth in length, and about one symbol, line or word in 300 words.
RIDGE = (0.1, 0.05, 0.06, 0.06, 0.06)
#: Standard deviations added in groups of less than SMALL rows.
FLOOR, SMALL = (0.7, 0.15, 0.12, 0.12, 0.12), 25
STARTS = ("medians", "all", "shorter", "longer", "plain")
#: A start is settled when its log determinant falls by no more.
SETTLED = 1e-4
DIM = 5
_BLANKS = r"[\x20\x09-\x0D]"


def _once(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column, width: int = 5) -> Column:
    """Words in windows of ``width`` that occur twice or more."""
    def window(i: Column) -> Column:
        return F.struct(F.xxhash64(*[F.get(words, i + j) for j in range(width)]).alias("h"), i.alias("i"))

    def places(s: Column) -> Column:
        def again(x: Column, k: Column) -> Column:
            before = F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
            return before | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, again), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last"))
        return F.aggregate(p, start, lambda a, x: F.struct((a["n"] + F.least(F.lit(width), x - a["last"])).alias("n"), x.alias("last")))["n"]

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - width), window)
    found = _once(_once(F.sort_array(windows), places), covered)
    return F.when(F.size(words) >= width, found).otherwise(F.lit(0))


def base_stats(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words (long) and base_failed of every document."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, _BLANKS + "+"), lambda x: x != "")
    of_words = _once(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeated(w).cast("long").alias("n_repeat_words")))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    same = _once(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    out = docs.select("doc_id", *GROUP, of_words.alias("w"), same.cast("long").alias("n_dup_lines"),
                      F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"))
    failed = (F.col("w.n_words") < 10) | (100 * F.col("w.n_repeat_words") > 20 * F.col("w.n_words"))
    return out.select("doc_id", *GROUP, "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words", failed.alias("base_failed"))


def _vector(n: Column) -> list[Column]:
    words = F.greatest(n, F.lit(1))
    return [F.log1p(n), F.log1p(F.col("word_chars") / words), *(F.sqrt(F.col(c) / words) for c in ("n_symbols", "n_dup_lines", "n_repeat_words"))]


def _keyed(df: DataFrame) -> DataFrame:
    """Group columns with null told apart from every string."""
    return df.withColumns({f"g_{c}": F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in GROUP})


_KEYS = [f"g_{c}" for c in GROUP]


def _distance(i: int = DIM) -> Column:
    """Squared distance from mean ``m`` under the Cholesky factor ``l``."""
    z: list[Column] = []
    for r in range(i):
        z.append(F.col(f"z{r}"))
    return reduce(lambda a, b: a + b, (x * x for x in z))


def _whiten(df: DataFrame) -> DataFrame:
    """Adds z0..z4 by forward substitution, and distance."""
    for r in range(DIM):
        rest = F.col(f"x{r}") - F.col(f"m{r}")
        for k in range(r):
            rest = rest - F.col(f"l{r}{k}") * F.col(f"z{k}")
        df = df.withColumn(f"z{r}", rest / F.col(f"l{r}{r}"))
    return df.withColumn("distance", _distance())


def _factor(groups: DataFrame) -> DataFrame:
    """Cholesky factor l of the covariances s, and its log determinant."""
    small = F.col("n") < SMALL
    for r in range(DIM):
        for k in range(r + 1):
            rest = F.coalesce(F.col(f"s{r}{k}"), F.lit(0.0)) * CONSISTENCY
            if r == k:
                rest = rest + F.when(small, FLOOR[r] ** 2).otherwise(0.0)
            for j in range(k):
                rest = rest - F.col(f"l{r}{j}") * F.col(f"l{k}{j}")
            groups = groups.withColumn(f"l{r}{k}", F.sqrt(F.greatest(rest, F.lit(RIDGE[r] ** 2))) if r == k else rest / F.col(f"l{k}{k}"))
    log_det = reduce(lambda a, b: a + b, (2 * F.log(F.col(f"l{r}{r}")) for r in range(DIM)))
    return groups.select(*_KEYS, "start", "n", log_det.alias("log_det"), *_ESTIMATE)


_ESTIMATE = [f"m{r}" for r in range(DIM)] + [f"l{r}{k}" for r in range(DIM) for k in range(r + 1)]


def _moments(rows: DataFrame) -> DataFrame:
    """Of each group and start; n is that of the whole group."""
    means = [F.avg(f"x{r}").alias(f"m{r}") for r in range(DIM)]
    return rows.groupBy(*_KEYS, "start").agg(
        F.first("n").alias("n"), *means, *[F.covar_pop(f"x{r}", f"x{k}").alias(f"s{r}{k}") for r in range(DIM) for k in range(r + 1)])


def _starts(vectors: DataFrame) -> DataFrame:
    """The first estimates of each group, by start."""
    middle = vectors.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(f"x{r}", 0.5, 10000).alias(f"c{r}") for r in range(DIM)])
    middle = stage_table(middle, "medians")[0]
    centred = vectors.join(middle, _KEYS)
    spread = centred.groupBy(*_KEYS).agg(
        F.first("n").alias("n"), *[F.first(f"c{r}").alias(f"m{r}") for r in range(DIM)],
        *[F.percentile_approx(F.abs(F.col(f"x{r}") - F.col(f"c{r}")), 0.5, 10000).alias(f"d{r}") for r in range(DIM)])
    medians = spread.withColumns({f"s{r}{k}": F.pow(F.col(f"d{r}") * 1.4826, 2) if r == k else F.lit(0.0) for r in range(DIM) for k in range(r + 1)})
    plain = reduce(lambda a, b: a & b, (F.col(f"x{r}") <= F.col(f"c{r}") for r in range(2, DIM)))
    parts = {"all": F.lit(True), "shorter": F.col("x0") <= F.col("c0"), "longer": F.col("x0") > F.col("c0"), "plain": plain}
    named = F.array_compact(F.array(*[F.when(part, name) for name, part in parts.items()]))
    of_parts = _moments(centred.withColumn("start", F.explode(named)))
    return _factor(medians.withColumn("start", F.lit(STARTS[0]))).unionByName(_factor(of_parts))


def estimates(vectors: DataFrame) -> DataFrame:
    """Robust mean and Cholesky factor of each group of the staged vectors
    (columns g_lang, g_source, x0..x4)."""
    by = [*_KEYS, "start"]
    # What a start covers is no subset of the wanted size: its determinant is not compared.
    active = stage_table(_starts(vectors).withColumn("log_det", F.lit(float("inf"))), "starts")[0]
    settled = []
    while not active.isEmpty():
        placed = _whiten(vectors.join(active, _KEYS)).select(*by, "n", *[f"x{r}" for r in range(DIM)], "distance")
        cut = placed.groupBy(*by).agg(F.percentile_approx("distance", SUBSET, 10000).alias("cut"))
        cut = stage_table(cut, "cuts")[0]
        near = placed.join(cut, by).where(F.col("distance") <= F.col("cut"))
        before = active.select(*by, F.col("log_det").alias("before"))
        step = stage_table(_factor(_moments(near)).join(before, by), "estimates")[0]
        falls = F.col("log_det") < F.col("before") - SETTLED
        settled.append(step.where(~falls).drop("before"))
        active = step.where(falls).drop("before")
    if not settled:
        return active.select(*_KEYS, *_ESTIMATE)
    least = reduce(DataFrame.unionByName, settled).groupBy(*_KEYS).agg(F.min(F.struct("log_det", "start", *_ESTIMATE)).alias("e"))
    return stage_table(least.select(*_KEYS, *[f"e.{c}" for c in _ESTIMATE]), "least")[0]


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Base statistics, base_failed, distance (null if base_failed or the
    group has no estimate) and kept of every document."""
    stats = stage_table(base_stats(docs), "stats")[0]
    vectors = _keyed(stats).withColumns({f"x{r}": c for r, c in enumerate(_vector(F.col("n_words")))})
    groups = estimates(vectors.where(~F.col("base_failed")))
    placed = _whiten(vectors.join(groups, _KEYS, "left"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return placed.select(*stats.columns, F.when(~F.col("base_failed"), F.col("distance")).alias("distance"), kept.alias("kept"))
