"""Histogram gradient boosting for several targets at once.

Every feature is cut once into at most 255 ranges of about equally many rows, from
exact value counts. The coded training rows are packed into numpy blocks, written
once in a fixed layout and kept as a persisted RDD: each of the hundreds of short
passes reads them again, and a DataFrame job would plan a query for each (the one
place of this library that needs an RDD). A pass over the blocks serves all targets:
it routes the rows through the trees under way and adds up (residual sum, rows) per
leaf, feature and code. The partial histograms are added up in tasks, ``FAN`` sets at
most in one, always in the order of the partitions, and stay in the cluster: the driver
gets the rows, the residual sum and the best split of each leaf, whose size follows
neither features nor codes. Only the smaller child of a split is counted, its sibling
is the parent less it; the leaves' histograms are persisted from one level to the next.

A tree grows level by level by the splits of greatest gain, to at most ``leaves``
leaves and ``levels`` levels: one pass a level, and none for the last leaves, whose
sums their parents know. The first pass of a round also brings the running forecasts
up to date and adds up the validation errors of the trees so far; a target stops when
``patience`` rounds have not bettered it, and the trees up to its best round stay.
The lineage of the blocks is cut in the checkpoint folder every ``CUT`` rounds.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, materialize, reach
from .profiles import ranked_values

CODES = 255
#: Rounds between two cuts of the blocks' lineage.
CUT = 32
#: Sets of partial histograms that one task adds up.
FAN = 32
#: Rows that a prediction holds at once.
STEP = 4096
NODE_FIELDS = ("feature", "cut", "left", "right", "value", "gain", "rows")
NODE_TYPES = (np.int32, np.float64, np.int32, np.int32, np.float64, np.float64, np.int64)
NODE_SCHEMA = ("horizon string, tree int, node int, feature int, cut double, left int, right int, value double, "
               "gain double, rows long")


@dataclass
class Trees:
    """The boosted trees of one target. A tree is one array a field of ``NODE_FIELDS``;
    ``feature`` is -1 in a leaf, and a value not above ``cut`` goes left."""

    base: float
    trees: list[dict[str, np.ndarray]]

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += t["value"][_route(t["feature"], t["cut"], t["left"], t["right"], x)]
        return out


def _route(feature, cut, left, right, x) -> np.ndarray:
    """The leaf of every row of ``x`` (values against cuts, or codes against codes)."""
    at = np.zeros(len(x), dtype=np.int64)
    rows = np.arange(len(x))
    while True:
        f = feature[at]
        if (f < 0).all():
            return at
        go = x[rows, np.maximum(f, 0)] <= cut[at]
        at = np.where(f < 0, at, np.where(go, left[at], right[at]))


def feature_cuts(rows: DataFrame, features: Sequence[str], codes: int = CODES) -> list[np.ndarray]:
    """Per feature the greatest value of each range but the last: at most codes - 1."""
    ranked = ranked_values(rows, features)
    first = F.col("last") - F.col("c")                       # rows before the value's first
    cut = (ranked.groupBy("column_name", F.floor(first * codes / F.col("n")).alias("code"))
           .agg(F.max("v").alias("cut")).collect())          # codes rows a feature at most
    found: dict[str, list[float]] = {f: [] for f in features}
    for r in cut:
        found[r["column_name"]].append(r["cut"])
    return [np.array(sorted(found[f])[:-1], dtype=np.float64) for f in features]


def starts(cuts: list[np.ndarray]) -> np.ndarray:
    """The first code of each feature in one row of codes, and the end of the last."""
    return np.concatenate([[0], np.cumsum([len(c) + 1 for c in cuts])])


def _packed(rows: DataFrame, features: Sequence[str], targets: Sequence[str], val_col: str, order: Sequence[str],
            cuts: list[np.ndarray], parts: int) -> DataFrame:
    """(block, data): the coded rows in the layout that keys and ``parts`` fix."""
    start = starts(cuts)
    if start[-1] > 1 << 16:
        raise ValueError("too many features for 16-bit codes")
    x, y = (F.array(*[F.col(c).cast("double") for c in cols]) for cols in (features, targets))
    placed = (rows.select(*order, x.alias("x"), y.alias("y"), F.col(val_col).alias("val"))
              .repartition(parts, *order).sortWithinPartitions(*order)
              .select(F.spark_partition_id().alias("part"), "x", "y", "val"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(list(batches)) if batches else None
        if held is None or not held.num_rows:
            return
        flat = [np.asarray(held.column(c).combine_chunks().flatten()) for c in ("x", "y")]
        x, y = flat[0].reshape(-1, len(features)), flat[1].reshape(-1, len(targets))
        codes = np.stack([start[j] + np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], axis=1).astype(np.uint16)
        val = held.column("val").to_numpy()
        data = pickle.dumps((codes, y, val))
        yield pa.RecordBatch.from_arrays([held.column("part").slice(0, 1).combine_chunks(), pa.array([data], pa.binary())],
                                         names=["block", "data"])

    reach(rows.sparkSession)
    return placed.mapInArrow(work, "block int, data binary")


def _histograms(blocks, plans: dict[int, dict], total: int, errors: bool):
    """(target, (partition, sums)) for each target of ``plans`` and partition of the blocks:
    the histograms (slot, code) of residual sums and rows over the target's wanted leaves,
    and the validation errors."""
    def work(number, part):
        out = {}
        for _, codes, y, val, now in part:
            fit = ~val
            for h, plan in plans.items():
                r = y[:, h] - now[:, h]
                own, slots = codes[fit], len(plan["want"])
                slot_of = np.full(len(plan["feature"]), -1)
                slot_of[plan["want"]] = np.arange(slots)
                slot = slot_of[_route(plan["feature"], plan["code"], plan["left"], plan["right"], own)]
                some = slot >= 0
                own, slot, g = own[some], slot[some], r[fit][some]
                index, size = (slot[:, None] * total + own).ravel(), slots * total
                got = [np.bincount(index, np.repeat(g, own.shape[1]), size), np.bincount(index, minlength=size),
                       (r[val] @ r[val], float(val.sum())) if errors else (0.0, 0.0)]
                have = out.get(h)
                out[h] = got if have is None else _added(have, got)
        for h, sums in out.items():
            yield h, (number, sums)

    return blocks.mapPartitionsWithIndex(work)


def _added(a, b):
    return [a[0] + b[0], a[1] + b[1], (a[2][0] + b[2][0], a[2][1] + b[2][1])]


def _add_up(sets):
    """(key, (first number, sum)) of the (key, (number, sums)) at hand, added in the order
    of their numbers: the same sums on every run."""
    found: dict = {}
    for key, numbered in sets:
        found.setdefault(key, []).append(numbered)
    for key, own in found.items():
        own.sort(key=lambda s: s[0])
        yield key, (own[0][0], reduce(_added, [s for _, s in own]))


def _fewer(sums, fan: int, targets: int, groups: int):
    """Each ``fan`` neighbouring sets of a target as one; ``groups`` remain of it."""
    near = sums.map(lambda s: ((s[0], s[1][0] // fan), s[1])).partitionBy(targets * groups, lambda k: k[0] * groups + k[1])
    return near.mapPartitions(_add_up).map(lambda s: (s[0][0], (s[0][1], s[1][1])))


def _grown(sums, held, made: dict[int, list], targets: int, total: int):
    """(target, (-1, (leaf -> histograms, errors))): the leaves that ``made`` lists as
    (parent, smaller child, larger child), from the sums over the smaller ones and the
    parents in ``held``; a root has no parent and no sibling. A target's sets meet in one
    partition, where its parents are already."""
    sets = sums.getNumPartitions()
    if sets == 1:
        both = sums if held is None else held.union(sums).coalesce(1)
    else:
        while sets > FAN:
            sets = -(-sets // FAN)
            sums = _fewer(sums, FAN, targets, sets)
        both = sums.partitionBy(targets)
        if held is not None:
            both = held.union(both).partitionBy(targets)     # placed alike, so nothing moves

    def work(part):
        parents, new = {}, []
        for h, (number, what) in part:
            if number < 0:
                parents[h] = what[0]
            else:
                new.append((h, (number, what)))
        for h, (_, (g, n, errors)) in _add_up(new):
            g, n, leaves = g.reshape(-1, total), n.reshape(-1, total), {}
            for i, (parent, small, large) in enumerate(made[h]):
                leaves[small] = (g[i], n[i])
                if parent is not None:
                    leaves[large] = (parents[h][parent][0] - g[i], parents[h][parent][1] - n[i])
            yield h, (-1, (leaves, errors))

    return both.mapPartitions(work, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)


def _best_split(g: np.ndarray, n: np.ndarray, start: np.ndarray, min_rows: int):
    """(residual sum, rows, best split) of a leaf's histogram; the split is (gain, feature,
    code, residual sum and rows of the left side), or None."""
    total, rows = g[:start[1]].sum(), n[:start[1]].sum()
    # sums up to each code of its feature: running sums less what came before the feature
    gl, nl = (np.cumsum(a) - np.repeat(np.concatenate([[0], np.cumsum(a)])[start[:-1]], np.diff(start)) for a in (g, n))
    able = np.flatnonzero((nl >= min_rows) & (rows - nl >= min_rows))
    best = None
    if len(able):
        gl, nl = gl[able], nl[able]
        gain = gl * gl / nl + (total - gl) ** 2 / (rows - nl) - total * total / rows
        i = int(gain.argmax())
        if gain[i] > 1e-9:
            feature = int(np.searchsorted(start, able[i], side="right")) - 1
            best = (float(gain[i]), feature, int(able[i]), float(gl[i]), int(nl[i]))
    return float(total), int(rows), best


def _splits(held, start: np.ndarray, min_rows: int) -> dict[int, tuple[dict, tuple]]:
    """What the driver gets of a pass: target -> (leaf -> its best split, errors)."""
    def best(what):
        leaves, errors = what[1]
        return {i: _best_split(g, n, start, min_rows) for i, (g, n) in leaves.items()}, errors

    return dict(held.mapValues(best).collect())


class _Tree:
    """A tree under way: its nodes, and the best splits of leaves that may be split."""

    def __init__(self, cuts, rate: float):
        self.cuts, self.start, self.rate = cuts, starts(cuts), rate
        self.nodes = {f: [] for f in (*NODE_FIELDS, "code")}
        self.best = {}
        self.add(0.0, 0)

    def add(self, total: float, rows: int) -> int:
        for f, v in zip((*NODE_FIELDS, "code"), (-1, 0.0, -1, -1, self.rate * total / max(rows, 1), 0.0, rows, 0), strict=True):
            self.nodes[f].append(v)
        return len(self.nodes["feature"]) - 1

    def learn(self, found: dict[int, tuple]) -> None:
        """Keeps the leaves' sums and best splits (``_best_split``)."""
        for node, (total, rows, best) in found.items():
            self.nodes["rows"][node], self.nodes["value"][node] = rows, self.rate * total / max(rows, 1)
            if best:
                self.best[node] = (*best, total, rows)

    def split(self, count: int) -> list[tuple[int, int, int]]:
        """Splits the ``count`` best leaves: (parent, smaller child, larger child)."""
        made = []
        for node in sorted(self.best, key=lambda i: (-self.best[i][0], i))[:count]:
            gain, feature, code, gl, nl, total, rows = self.best.pop(node)
            left, right = self.add(gl, nl), self.add(total - gl, rows - nl)
            cut = float(self.cuts[feature][code - self.start[feature]])
            for f, v in (("feature", feature), ("code", code), ("cut", cut), ("left", left),
                         ("right", right), ("gain", gain)):
                self.nodes[f][node] = v
            made.append((node, left, right) if nl * 2 <= rows else (node, right, left))
        return made

    def plan(self, want: list[int]) -> dict:
        arrays = {f: np.array(self.nodes[f], dtype=np.int64) for f in ("feature", "code", "left", "right")}
        return {**arrays, "want": np.array(want, dtype=np.int64)}

    def done(self) -> dict[str, np.ndarray]:
        return {f: np.array(self.nodes[f], dtype=t) for f, t in zip(NODE_FIELDS, NODE_TYPES, strict=True)}


def fit(rows: DataFrame, features: Sequence[str], targets: Sequence[tuple[str, str]], val_col: str, order: Sequence[str],
        rounds: int = 500, rate: float = 0.05, leaves: int = 31, levels: int = 5, min_rows: int = 20,
        patience: int = 50, rows_per_block: int = 250_000) -> dict[str, Trees]:
    """Boosted trees of every (name, column) of ``targets``. ``order`` names the
    columns that identify a row: with the row count they fix the layout, so the same
    rows give the same trees. Rows with ``val_col`` only judge."""
    spark = rows.sparkSession
    cuts = feature_cuts(rows.where(~F.col(val_col)), features)
    n = rows.count()
    parts = max(1, -(-n // rows_per_block))
    packed = materialize(_packed(rows, features, [c for _, c in targets], val_col, order, cuts, parts), "boost-blocks")
    checkpoint_dir(spark)
    loaded = packed.rdd.map(lambda r: (r["block"], *pickle.loads(r["data"])))
    sums = loaded.map(lambda b: (b[0], (b[1 + 1][~b[3]].sum(0), int((~b[3]).sum())))).collect()   # one row a block
    sums = [s for _, s in sorted(sums, key=lambda s: s[0])]
    count = sum(c for _, c in sums)
    if not count:
        raise ValueError("no training rows")
    base = np.sum([t for t, _ in sums], axis=0) / count
    state = loaded.map(lambda b: (*b, np.tile(base, (len(b[1]), 1)))).persist(StorageLevel.MEMORY_AND_DISK)
    grown: dict[int, list] = {h: [] for h in range(len(targets))}
    best: dict[int, tuple[float, int]] = {}
    going, older, start = list(grown), None, starts(cuts)
    total = int(start[-1])
    for turn in range(rounds + 1):
        trees = {h: _Tree(cuts, rate) for h in going}
        made = {h: [(None, 0, None)] for h in going}
        held = _grown(_histograms(state, {h: t.plan([0]) for h, t in trees.items()}, total, True), None, made, len(targets), total)
        found = _splits(held, start, min_rows)
        if older is not None:
            older.unpersist()                                # the pass has filled the blocks that follow it
        for h in list(going):
            error, judged = found[h][1]
            if judged and (h not in best or error < best[h][0]):
                best[h] = (error, turn)
            if judged and turn - best[h][1] >= patience:
                going.remove(h)
        if turn == rounds or not going:
            held.unpersist()
            break
        for h in going:
            trees[h].learn(found[h][0])
        budget = dict.fromkeys(going, leaves - 1)
        for level in range(levels):
            made = {h: trees[h].split(budget[h]) for h in going}
            for h, m in made.items():
                budget[h] -= len(m)
            made = {h: m for h, m in made.items() if m and budget[h]}
            if not made or level == levels - 1:
                break
            sums = _histograms(state, {h: trees[h].plan([c for _, c, _ in m]) for h, m in made.items()}, total, False)
            parents, held = held, _grown(sums, held, made, len(targets), total)
            found = _splits(held, start, min_rows)
            parents.unpersist()
            for h in made:
                trees[h].learn(found[h][0])
        held.unpersist()
        for h in going:
            grown[h].append(trees[h].done())
        older, state = state, _updated(state, {h: trees[h].plan([]) | {"value": grown[h][-1]["value"]} for h in going}, (turn + 1) % CUT == 0)
    state.unpersist()
    return {name: Trees(float(base[h]), grown[h][:best[h][1]] if h in best else grown[h]) for h, (name, _) in enumerate(targets)}


def _updated(state, plans: dict[int, dict], cut: bool):
    """The blocks with this round's trees added to the running forecasts."""
    def add(block):
        number, codes, y, val, now = block
        now = now.copy()
        for h, p in plans.items():
            now[:, h] += p["value"][_route(p["feature"], p["code"], p["left"], p["right"], codes)]
        return number, codes, y, val, now

    new = state.map(add).persist(StorageLevel.MEMORY_AND_DISK)
    if cut:
        new.checkpoint()
    return new


def predict(df: DataFrame, models: dict[str, Trees], features: Sequence[str], prefix: str = "pred_") -> DataFrame:
    """``df`` with one column a model, no forecast below 0. One Arrow UDF over the
    feature columns; the models travel as one broadcast, whose size follows the rounds
    and leaves (3 x 500 x 61 nodes of 40 bytes at the defaults)."""
    spark = df.sparkSession
    reach(spark)
    shared = spark.sparkContext.broadcast(models)
    names = list(models)
    out = ", ".join(f"`{h}` double" for h in names)

    @F.pandas_udf(out)
    def scores(*columns):
        import pandas as pd
        x = np.column_stack([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns])
        got = {h: np.concatenate([np.maximum(m.predict(x[lo:lo + STEP]), 0.0) for lo in range(0, max(len(x), 1), STEP)])
               for h, m in shared.value.items()}
        return pd.DataFrame(got)

    made = df.withColumn("__scores", scores(*[F.col(c).cast("double") for c in features]))
    return made.withColumns({f"{prefix}{h}": F.col("__scores").getField(h) for h in names}).drop("__scores")


def node_table(spark: SparkSession, models: dict[str, Trees]) -> DataFrame:
    """One row a node; the model's only stored form beside its base values."""
    columns: dict[str, list] = {c: [] for c in ("horizon", "tree", "node", *NODE_FIELDS)}
    for h, m in models.items():
        for i, t in enumerate(m.trees):
            size = len(t["feature"])
            for c, v in (("horizon", [h] * size), ("tree", np.full(size, i, np.int32)), ("node", np.arange(size, dtype=np.int32))):
                columns[c].append(v)
            for f in NODE_FIELDS:
                columns[f].append(t[f])
    kinds = (pa.string(), pa.int32(), pa.int32(), *(pa.from_numpy_dtype(t) for t in NODE_TYPES))
    flat = [pa.array([x for part in columns[c] for x in part] if c == "horizon" else
                     np.concatenate(columns[c]) if columns[c] else [], k) for c, k in zip(columns, kinds, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(flat, names=list(columns)), NODE_SCHEMA)


def models_of(nodes: DataFrame, bases: dict[str, float]) -> dict[str, Trees]:
    """The models back from their node table (bounded by rounds and leaves)."""
    t = nodes.orderBy("horizon", "tree", "node").toArrow()
    horizon, tree = np.array(t.column("horizon").to_pylist(), dtype=object), t.column("tree").to_numpy()
    out = {}
    for h, base in bases.items():
        own = horizon == h
        fields = {f: t.column(f).to_numpy()[own].astype(k) for f, k in zip(NODE_FIELDS, NODE_TYPES, strict=True)}
        ends = np.flatnonzero(np.append(tree[own][1:] != tree[own][:-1], True)) + 1 if own.any() else []
        starts = [0, *ends[:-1]] if own.any() else []
        out[h] = Trees(base, [{f: v[lo:hi] for f, v in fields.items()} for lo, hi in zip(starts, ends, strict=True)])
    return out
