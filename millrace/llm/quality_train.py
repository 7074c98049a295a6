"""Fits the model of quality: python -m millrace.llm.quality_train TRAIN_DIR HOLDOUT_DIR HOLDOUT_CSV OUT_JSON

Weak labels come from rules on the statistics, on at most MAX_ROWS documents; gradient-boosted trees learn them; a
logistic curve on hand-checked documents (doc_id,prose) that the trees never saw calibrates their score.
"""

from __future__ import annotations

import csv
import json
import sys

import numpy as np
from pyspark.sql import functions as F

from millrace.llm.quality import STATISTICS, common_word_set, probabilities, raw_scores, statistics

MAX_ROWS = 20_000
TREES, DEPTH, RATE, LEAST = 80, 3, 0.2, 8
_AT = {s: n for n, s in enumerate(STATISTICS)}


def weak_label(values: list[float]) -> int | None:
    """1 prose, 0 structural junk, None where the rules don't agree."""
    get = lambda s: values[_AT[s]]
    prose = [get("running_share") > 0.6, get("common_word_share") > 0.2, get("table_line_share") < 0.4, get("repeated_sentence_share") < 0.6]
    junk = [get("running_share") < 0.35, get("table_line_share") > 0.5, get("distinct_line_share") < 0.3, get("common_word_share") < 0.1]
    if all(prose) and not any(junk):
        return 1
    return 0 if junk[0] and not prose[0] else None


def _tree(x: np.ndarray, bins: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray, rows: np.ndarray, depth: int):
    g, h = gradient[rows].sum(), hessian[rows].sum()
    best = (1e-6, None, None)
    if depth and rows.size >= 2 * LEAST:
        for f, edges in enumerate(bins):
            which = x[rows, f]
            gs = np.bincount(which, gradient[rows], len(edges) + 1).cumsum()[:-1]
            hs = np.bincount(which, hessian[rows], len(edges) + 1).cumsum()[:-1]
            ns = np.bincount(which, minlength=len(edges) + 1).cumsum()[:-1]
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            gain[(ns < LEAST) | (rows.size - ns < LEAST)] = -1
            if gain.size and gain.max() > best[0]:
                best = (gain.max(), f, int(gain.argmax()))
    if best[1] is None:
        return float(np.round(RATE * g / (h + 1), 5))
    _, f, cut = best
    left = x[rows, f] <= cut
    return [f, float(np.round(bins[f][cut], 6)), _tree(x, bins, gradient, hessian, rows[left], depth - 1), _tree(x, bins, gradient, hessian, rows[~left], depth - 1)]


def boost(values: np.ndarray, labels: np.ndarray) -> dict:
    """Trees on the gradient of the logistic loss."""
    bins = [np.unique(np.quantile(values[:, f], np.linspace(0.02, 0.98, 49)).round(6)) for f in range(values.shape[1])]
    x = np.stack([np.searchsorted(b, values[:, f], side="left") for f, b in enumerate(bins)], axis=1)
    share = labels.mean()
    base = float(np.log(share / (1 - share)))
    score, trees = np.full(len(labels), base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        tree = _tree(x, bins, labels - p, p * (1 - p), np.arange(len(labels)), DEPTH)
        trees.append(tree)
        score += raw_scores(values, {"base": 0.0, "trees": [tree]})
    return {"statistics": STATISTICS, "base": base, "trees": trees, "slope": 1.0, "shift": 0.0}


def calibrate(model: dict, values: np.ndarray, labels: np.ndarray) -> dict:
    """Slope and shift of the logistic curve, by Newton steps with a little shrinkage."""
    raw = raw_scores(values, model)
    weights = np.array([1.0, 0.0])
    design = np.stack([raw, np.ones_like(raw)], axis=1)
    target = np.where(labels == 1, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
    def loss(w: np.ndarray) -> float:
        z = design @ w
        return float(np.sum(np.logaddexp(0, z) - target * z) + 0.5e-3 * np.sum((w - [1, 0]) ** 2))

    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (p - target) + 1e-3 * (weights - [1, 0])
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, slope)
        while loss(weights - step) > loss(weights) and np.abs(step).max() > 1e-9:
            step = step / 2
        weights = weights - step
    return model | {"slope": float(weights[0]), "shift": float(weights[1])}


def main(train_dir: str, holdout_dir: str, holdout_csv: str, out: str) -> None:
    from millrace.session import build_session, table

    spark = build_session()
    common = common_word_set(table(spark, train_dir, "common_words"))
    with open(holdout_csv, encoding="utf-8") as file:
        checked = {int(r["doc_id"]): int(r["prose"]) for r in csv.DictReader(file)}
    wanted = spark.createDataFrame(sorted(checked.items()), "doc_id bigint, prose int")
    held = {r.doc_id: r.text for r in table(spark, holdout_dir, "documents").join(wanted, "doc_id", "left_semi").select("doc_id", "text").dropDuplicates(["doc_id"]).collect()}
    texts = table(spark, train_dir, "documents").select("text").filter("text is not null")
    rows = texts.withColumn("place", F.xxhash64("text")).orderBy("place").limit(MAX_ROWS).select("text").collect()
    unseen = set(held.values())
    data = [statistics(r.text, common) for r in rows if r.text not in unseen]
    train = [(v, weak_label(v)) for v in data if v is not None]
    train = [(v, y) for v, y in train if y is not None]
    model = boost(np.array([v for v, _ in train]), np.array([y for _, y in train], dtype=float))
    # Every other document of the holdout calibrates; what is reported is measured on the rest.
    pairs = [(statistics(held[d], common), checked[d]) for d in sorted(held)]
    values, labels = np.array([v for v, _ in pairs]), np.array([y for _, y in pairs], dtype=float)
    model = calibrate(model, values[::2], labels[::2])
    rated = probabilities(values[1::2], model)
    right = int(((rated >= 0.5) == (labels[1::2] == 1)).sum())
    plain = sum((weak_label(list(v)) == y) for v, y in zip(values[1::2], labels[1::2]))
    with open(out, "w", encoding="utf-8") as file:
        json.dump(model, file)
    brier = float(np.mean((rated - labels[1::2]) ** 2))
    print(f"{len(train)} weakly labelled, {sum(y for _, y in train)} of them prose; of {len(rated)} documents checked by hand and not calibrated on {right} are right (the weak labels alone: {plain}), Brier score {brier:.4f}")


if __name__ == "__main__":
    main(*sys.argv[1:])
