"""Quality classifier: a sparse rule ensemble (operator 10).

Column expressions compute statistics of each text. Shallow boosted trees over
them, fitted on a bounded sample of labelled rows (``SAMPLE`` at most, taken by
the digest of their id), give conjunctive rules: every path from a root to a
node. A lasso logistic regression over the rules keeps few of them; those are
compiled into one Spark column expression, so scoring is a narrow projection
without Python.

Defined results: null text counts as empty and is scored like any text; labels
that are null are not learned from; of repeated label rows of an id the mean
counts (ties learn as 1); without labels of both kinds every score is the share
of label 1 (0.5 without any); an empty table gives an empty result; other
columns are kept and not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled rows to learn from; more labels only make the sample denser.
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE = 40, 3, 32, 0.3
LASSO, ROUNDS = 0.002, 400
CUT = 0.3
PREFIX = "__q_"


def statistics(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """Adds one double column for each statistic of the text; their names."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn("__w", F.filter(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), lambda w: w != ""))
    df = df.withColumn("__l", F.split(text, "\n"))
    n, m = F.greatest(F.length(text), F.lit(1)), F.greatest(F.size("__w"), F.lit(1))
    lines = F.size("__l")
    long = F.aggregate("__w", F.lit(0), lambda a, w: F.greatest(a, F.length(w)))
    again = F.aggregate(F.zip_with("__w", F.slice("__w", 2, m), lambda a, b: (a == b).cast("int")), F.lit(0),
                        lambda a, x: a + F.coalesce(x, F.lit(0)))
    short = F.aggregate("__w", F.lit(0), lambda a, w: a + (F.length(w) <= 2).cast("int"))
    count = lambda p: F.regexp_count(text, F.lit(p))
    found = {
        "chars": F.log1p(F.length(text)), "words": F.log1p(F.size("__w")), "word_len": n / m, "longest": long,
        "kinds": F.size(F.array_distinct("__w")) / m, "kinds_root": F.size(F.array_distinct("__w")) / F.sqrt(m), "again": again / m, "short": short / m,
        "upper": count(r"\p{Lu}") / n, "digit": count("[0-9]") / n, "sign": count(r"[^\p{L}\p{N}\s]") / n,
        "bang": (n - F.length(F.translate(text, "!?", ""))) / n, "bar": (n - F.length(F.translate(text, "|<>{}", ""))) / n,
        "dots": (F.length(text) - F.length(F.translate(text, ".,", ""))) / m,
        "wide": (F.octet_length(text) - F.length(text)) / n,
        "lines": lines / m, "line_kinds": F.size(F.array_distinct("__l")) / lines,
    }
    names = [PREFIX + k for k in found]
    return df.withColumns({PREFIX + k: v.cast("double") for k, v in found.items()}).drop("__w", "__l"), names


class Rules:
    """Conjunctions of (statistic, below, bound) with their weights."""

    def __init__(self, bias: float, rules: list[tuple[tuple[tuple[int, bool, float], ...], float]]):
        self.bias, self.rules = bias, rules

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for rule, weight in self.rules:
            z += weight * np.all([(x[:, f] <= b) == below for f, below, b in rule], axis=0)
        return 1 / (1 + np.exp(-z))

    def column(self, names: list[str]) -> Column:
        z = F.lit(self.bias)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for f, below, bound in rule:
                holds = holds & ((F.col(names[f]) <= bound) if below else (F.col(names[f]) > bound))
            z = z + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def _tree(codes: np.ndarray, grad: np.ndarray, hess: np.ndarray, edges: list[np.ndarray]):
    """(leaf value of each row, paths to all nodes) of one Newton tree over binned statistics."""
    width = BINS
    node, value, paths = np.zeros(len(codes), dtype=np.int64), np.zeros(len(codes)), []
    rules: dict[int, tuple] = {0: ()}
    flat = codes + np.arange(codes.shape[1]) * width
    for _ in range(DEPTH):
        grown: dict[int, tuple] = {}
        for k, path in rules.items():
            own = np.flatnonzero(node == k)
            if len(own) < 40:
                continue
            at = flat[own].ravel()
            g = np.bincount(at, np.repeat(grad[own], codes.shape[1]), codes.shape[1] * width).reshape(-1, width).cumsum(1)
            h = np.bincount(at, np.repeat(hess[own], codes.shape[1]), codes.shape[1] * width).reshape(-1, width).cumsum(1)
            total_g, total_h = g[0, -1], h[0, -1]
            gain = g ** 2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g ** 2 / (total_h + 1)
            gain[(h < 3) | (total_h - h < 3)] = 0
            for f, e in enumerate(edges):
                gain[f, len(e):] = 0
            f, b = np.unravel_index(np.argmax(gain), gain.shape)
            if gain[f, b] <= 1e-6:
                continue
            below = codes[own, f] <= b
            for side, rows, name in ((True, own[below], 2 * k + 1), (False, own[~below], 2 * k + 2)):
                grown[name] = (*path, (int(f), side, float(edges[f][b])))
                node[rows] = name
                value[rows] = grad[rows].sum() / (hess[rows].sum() + 1)
                paths.append(grown[name])
        rules = grown
    return value, paths


def fit(x: np.ndarray, y: np.ndarray) -> Rules:
    """Rules and weights from at most SAMPLE rows."""
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or share in (0.0, 1.0):
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Rules(math.log(share / (1 - share)), [])
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    codes = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    z = np.full(len(y), math.log(share / (1 - share)))
    found: dict[tuple, None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        value, paths = _tree(codes, y - p, p * (1 - p), edges)
        z += RATE * value
        found.update(dict.fromkeys(tuple(sorted(set(q))) for q in paths))
    rules = list(found)
    hold = np.zeros((len(y), len(rules)))
    for i, r in enumerate(rules):
        hold[:, i] = np.all([(x[:, f] <= b) == below for f, below, b in r], axis=0)
    keep = (hold.mean(0) > 0.002) & (hold.mean(0) < 0.998)
    hold, rules = hold[:, keep], [r for r, k in zip(rules, keep, strict=True) if k]
    if not rules:  # too few rows to split
        return Rules(math.log(share / (1 - share)), [])
    mean, sd = hold.mean(0), hold.std(0)
    a = (hold - mean) / sd
    w, v, bias, t = np.zeros(a.shape[1]), np.zeros(a.shape[1]), math.log(share / (1 - share)), 1.0
    size = 4 * len(y) / np.linalg.norm(a, 2) ** 2
    for _ in range(ROUNDS):  # accelerated proximal gradient steps
        p = 1 / (1 + np.exp(-(a @ v + bias)))
        bias -= 2 * (p - y).mean()
        new = v - size * (a.T @ (p - y)) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - size * LASSO, 0)
        t, before = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        v, w = new + (before - 1) / t * (new - w), new
    weight = w / sd
    kept = [(r, float(c)) for r, c in zip(rules, weight, strict=True) if abs(c) > 1e-9]
    return Rules(float(bias - (mean * weight).sum()), kept)


def train(docs: DataFrame, labels: DataFrame, where: Column | None = None, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality") -> Rules:
    """Fits on the labelled documents, those of ``where`` (over ``id_col``) only."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.where(where) if where is not None else known
    known = known.groupBy(F.col(id_col).alias("__id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("__y"))
    # at most SAMPLE rows of an id and a label, so the broadcast is bounded
    chosen = known.orderBy(F.xxhash64("__id"), "__id").limit(SAMPLE)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")).join(F.broadcast(chosen), "__id")
    df, names = statistics(texts, "__t")
    rows = df.orderBy("__id", *names).select("__y", *names).limit(2 * SAMPLE).toPandas().to_numpy(dtype=np.float64)
    return fit(rows[:, 1:], rows[:, 0])


def score(docs: DataFrame, rules: Rules, text_col: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 from CUT on)."""
    df, names = statistics(docs, text_col)
    df = df.withColumn("score", rules.column(names)).drop(*names)
    return df.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
