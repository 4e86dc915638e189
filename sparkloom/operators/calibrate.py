"""Calibration of metric weights against a labelled golden set."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import scoring as S
from sparkloom.operators import monitor


def training_rows(golden: DataFrame, content_type: str | None = None) -> DataFrame:
    """Labelled rows with metrics, of one content type where named."""
    rows = golden.where("label is not null and raw_metrics is not null")
    return rows if content_type is None else rows.where(F.col("content_type") == content_type)


def gram(rows: DataFrame, names: list[str], target: str = "y") -> DataFrame:
    """One row: n, the products of every two metrics and of each with the target."""
    products = [F.sum(F.col(a) * F.col(b)).alias(f"{a}__{b}") for i, a in enumerate(names) for b in names[i:]]
    return rows.agg(F.count("*").alias("n"), *products, *(F.sum(F.col(a) * F.col(target)).alias(f"{a}__y") for a in names))


def nonnegative_lasso(xx: np.ndarray, xy: np.ndarray, n: int, alpha: float = 0.001, rounds: int = 10_000, tolerance: float = 1e-10) -> np.ndarray:
    """Minimises |y - Xw|^2 / 2n + alpha |w| over w >= 0, by coordinate descent on the products."""
    w = np.zeros(len(xy))
    for _ in range(rounds):
        before = w.copy()
        for j in range(len(w)):
            if xx[j, j] > 0:
                w[j] = max(0.0, (xy[j] - xx[j] @ w + xx[j, j] * w[j] - alpha * n) / xx[j, j])
        if np.abs(w - before).max() < tolerance:
            break
    return w


def train(rows: DataFrame, names: list[str] | None = None, alpha: float = 0.001, least: int = 10) -> dict[str, float]:
    """Weights that sum to 1 from rows with label 5 (target 1) and 1 (target 0); tiny ones are dropped."""
    names = names or list(S.WEIGHTS)
    rows = rows.where("label in (1, 5)").withColumn("y", (F.col("label") == 5).cast("double"))
    one = gram(rows, names).first()
    if one["n"] < least:
        raise ValueError(f"{one['n']} labelled rows; {least} are needed")
    xx = np.array([[one[f"{a}__{b}"] if f"{a}__{b}" in one else one[f"{b}__{a}"] for b in names] for a in names])
    w = nonnegative_lasso(xx, np.array([one[f"{a}__y"] for a in names]), one["n"], alpha)
    total = w.sum()
    return {k: float(x / total) for k, x in zip(names, w, strict=True) if total > 0 and x / total > 1e-4}


def folds(rows: DataFrame, k: int = 5, domain: str = "domain") -> DataFrame:
    """``rows`` with a fold of their domain, so that no domain is in two folds."""
    return rows.withColumn("fold", F.pmod(F.xxhash64(domain), F.lit(k)).cast("int"))


def cross_validated(rows: DataFrame, k: int = 5, names: list[str] | None = None) -> list[float]:
    """qadi of each domain fold under weights trained on the others."""
    rows, out = folds(rows, k), []
    for fold in range(k):
        held = rows.where(F.col("fold") == fold)
        weights = train(rows.where(F.col("fold") != fold), names)
        out.append(validate(held, weights).first()["qadi"])
    return out


def validate(rows: DataFrame, weights: dict[str, float]) -> DataFrame:
    """One row: class means of the sigmoid score, separation, qadi and whether it passes."""
    scored = rows.withColumn("score", S.sigmoid_score(weights))
    truth, predicted = F.col("label") >= 4, F.col("score") > 0.5
    means = monitor.separation(scored)
    measure = scored.where("label <> 3").agg(*monitor.qadi(truth, predicted))
    return means.crossJoin(measure).withColumn("passed", F.col("separated") & (F.col("qadi") < 0.3))  # one row each
