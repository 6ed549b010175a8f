"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

1. Statistics of a text are built-in Spark expressions (:func:`statistics`).
2. Boosted shallow trees are grown on a bounded sample of labelled rows; every
   path from a root to a node is a conjunctive rule (:func:`grow_rules`).
3. Lasso logistic regression on the rules keeps a few with a weight each
   (:func:`fit_lasso`).
4. The kept rules are compiled into one Spark column (:func:`compile_score`), so
   scoring is a projection without user functions.

``MAX_TRAIN`` bounds the sample: labelled rows are taken by a hash of their id,
at a rate that gives at most about that many. All else covers every row.

Defined cases: a null text counts as empty and is scored like one; ratios with
denominator 0 are 0; several labels of one id count as their mean (null labels
do not count); without any labelled row, or with one class only, the score is
the smoothed share of label 1 (0.5 without rows); equal rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlife.llm.textstats import NOT_SPACE, STOP_WORDS, words

MAX_TRAIN = 12_000
TREES, DEPTH, LEARNING_RATE, MIN_LEAF, BINS = 40, 3, 0.3, 10, 32
LASSO = 2e-3
#: The most paths that the trees can have; nothing is dropped.
MAX_RULES = TREES * (2 ** (DEPTH + 1) - 2)

STATISTICS = ("n_words", "word_length", "stop_words", "distinct_words", "symbols", "upper", "digits", "marks",
              "lines", "line_words", "dup_lines")


def statistics(df: DataFrame, keep: Sequence[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of ``df`` plus one struct column ``stats_`` of doubles."""
    ids = [F.col(f"`{c}`").alias(f"k{i}_") for i, c in enumerate(keep)]
    t = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    step = df.select(*ids, t.alias("t_"), words(t).alias("w_"),
                     F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_SPACE)).alias("l_"))
    text, w, lines = F.col("t_"), F.col("w_"), F.col("l_")

    def n(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("double")

    counts = step.select(*[F.col(f"k{i}_") for i in range(len(keep))], F.struct(
        F.size(w).cast("double").alias("n"), F.size(F.array_distinct(w)).cast("double").alias("d"),
        F.length(F.array_join(w, "")).cast("double").alias("c"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("double").alias("s"),
        F.size(lines).cast("double").alias("l"), F.size(F.array_distinct(lines)).cast("double").alias("ld"),
        n(r"[#*$%&|<>@^~=+_\\{}\[\]]").alias("y"), n(r"\p{Lu}").alias("u"), n("[0-9]").alias("g"),
        n("[!?]").alias("m")).alias("x"))

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    values = {
        "n_words": F.col("x.n"), "word_length": ratio("x.c", "x.n"), "stop_words": ratio("x.s", "x.n"),
        "distinct_words": ratio("x.d", "x.n"), "symbols": ratio("x.y", "x.n"), "upper": ratio("x.u", "x.c"),
        "digits": ratio("x.g", "x.c"), "marks": ratio("x.m", "x.n"), "lines": F.col("x.l"),
        "line_words": ratio("x.n", "x.l"),
        "dup_lines": F.when(F.col("x.l") > 0, 1 - F.col("x.ld") / F.col("x.l")).otherwise(F.lit(0.0)),
    }
    return counts.select(*[F.col(f"k{i}_").alias(c) for i, c in enumerate(keep)],
                         F.struct(*[values[s].alias(s) for s in STATISTICS]).alias("stats_"))


# A rule is a tuple of conditions (statistic index, is_above, threshold), sorted.


def _best_split(codes: np.ndarray, grad: np.ndarray, hess: np.ndarray, bins: int):
    """(gain, feature, bin) of the best split ``code <= bin``, by summed gradients per bin."""
    best = (1e-9, -1, -1)
    total_g, total_h = grad.sum(), hess.sum()
    for f in range(codes.shape[1]):
        g = np.cumsum(np.bincount(codes[:, f], grad, bins))[:-1]
        h = np.cumsum(np.bincount(codes[:, f], hess, bins))[:-1]
        n = np.cumsum(np.bincount(codes[:, f], minlength=bins))[:-1]
        gain = g * g / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g ** 2 / (total_h + 1)
        gain[(n < MIN_LEAF) | (len(grad) - n < MIN_LEAF)] = 0
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), f, k)
    return best


def grow_rules(x: np.ndarray, y: np.ndarray) -> list[tuple]:
    """Every root-to-node path of boosted trees on (x, y), without repeats."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    score, rules = np.zeros(len(y)), {}

    def grow(rows: np.ndarray, path: tuple, grad, hess, step) -> None:
        gain, f, k = _best_split(codes[rows], grad[rows], hess[rows], BINS) if len(path) < DEPTH else (0, -1, -1)
        if f < 0:
            step[rows] = -grad[rows].sum() / (hess[rows].sum() + 1)
            return
        low = codes[rows, f] <= k
        for part, above in ((rows[low], False), (rows[~low], True)):
            way = tuple(sorted({*path, (f, above, float(edges[f][k]))}))
            rules.setdefault(way, len(rules))
            grow(part, way, grad, hess, step)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        step = np.zeros(len(y))
        grow(np.arange(len(y)), (), p - y, p * (1 - p), step)
        score += LEARNING_RATE * step
    return list(rules)


def holds(x: np.ndarray, rules: Sequence[tuple]) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for j, rule in enumerate(rules):
        for f, above, t in rule:
            out[:, j] *= (x[:, f] > t) if above else (x[:, f] <= t)
    return out


def fit_lasso(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 800) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient for logistic loss + penalty * |weights|; the intercept is free."""
    z = np.hstack([r, np.ones((len(r), 1))])
    gram = z.T @ z / (4 * len(y))
    rate = 1 / np.linalg.norm(gram, 2)
    w = v = np.zeros(z.shape[1])
    for k in range(steps):
        g = z.T @ (1 / (1 + np.exp(-np.clip(z @ v, -40, 40))) - y) / len(y)
        u = v - rate * g
        u[:-1] = np.sign(u[:-1]) * np.maximum(np.abs(u[:-1]) - rate * penalty, 0)
        w, v = u, u + k / (k + 3) * (u - w)
    return w[:-1], float(w[-1])


def fit(x: np.ndarray, y: np.ndarray) -> tuple[list[tuple[tuple, float]], float]:
    """([(rule, weight)], intercept)."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return [], float(np.log(share / (1 - share)))
    rules = grow_rules(x, y)
    weights, bias = fit_lasso(holds(x, rules), y, LASSO)
    return [(r, float(w)) for r, w in zip(rules, weights) if w != 0], bias


def compile_score(model: tuple, stats: str = "stats_") -> Column:
    """The ensemble as one Spark column, 0 to 1."""
    rules, bias = model
    total = F.lit(bias)
    for rule, weight in rules:
        ok = F.lit(True)
        for f, above, t in rule:
            value = F.col(f"{stats}.{STATISTICS[f]}")
            ok = ok & ((value > F.lit(t)) if above else (value <= F.lit(t)))
        total = total + F.when(ok, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def training_rows(docs: DataFrame, labels: DataFrame, key: str, label: str, max_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(statistics, label) of at most about ``max_rows`` labelled rows, chosen by a hash of the id."""
    one = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
           .groupBy(F.col(key).alias("id_")).agg(F.avg(label).alias("y_")))
    n = one.count()
    rate = min(1.0, max_rows / max(n, 1))
    picked = one.where(F.pmod(F.xxhash64("id_"), F.lit(1 << 30)) < F.lit(int(rate * (1 << 30))))
    # at most about max_rows ids: small enough to send to every task
    text = docs.select(F.col(key).alias("id_"), "text").join(F.broadcast(picked), "id_")
    rows = statistics(text, ["id_", "y_"]).groupBy("id_").agg(
        F.min("y_").alias("y"), F.min("stats_").alias("s")).orderBy("id_").collect()
    x = np.array([tuple(r["s"]) for r in rows], dtype=float).reshape(-1, len(STATISTICS))
    return x, np.array([r["y"] >= 0.5 for r in rows], dtype=float)


def quality_classifier_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    def held(c):
        return F.crc32(F.col(c).cast("string").cast("binary")) % 4 == 2
    learn = labels.select("doc_id", "quality").where(~held("doc_id"))
    model = fit(*training_rows(docs.select("doc_id", "text"), learn, "doc_id", "quality", MAX_TRAIN))
    scored = statistics(docs.select("doc_id", "text"), ["doc_id"]).select(
        "doc_id", F.coalesce(held("doc_id"), F.lit(False)).alias("held_out"), compile_score(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
