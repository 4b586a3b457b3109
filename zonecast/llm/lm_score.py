"""LM scoring with a log-bilinear model trained by noise-contrastive estimation (operator 4).

Spark counts every training word and every pair of neighbouring word classes.
The number of classes grows with the V distinct words: the ``CLASSES`` +
``GROWTH`` sqrt(V) most frequent words have a class of their own, all others
(unseen ones too) share ``GROWTH`` sqrt(V) classes by their hash, so every word
has a vector as target and as context. A word's probability is that of its
class after the class before it, times its smoothed share of its class. The
class model is log-bilinear: the vector of the class before, carried through a
context matrix, times the vector of the next class plus a bias. It is trained
in numpy on the driver over the class pair counts, a sparse table that Spark
gathers: at most one row for each pair of classes, so it grows as V does. The
noise-contrastive objective with ``NOISE`` draws from the unigram distribution
for each pair is taken in expectation, so there is no sampling error; work and
memory go by blocks of ``ROWS`` classes. Tasks get the vectors and the
normaliser of each class, not a table of pairs.

Counts of the words of at most ``HOT`` rows (the most frequent ones) go to the
tasks; all other tokens are joined with the count table by their hash, which
grows with the corpus and never leaves Spark.

Defined results: null or empty text is the end token alone; without training
text every count is 0 and a score is that of the uniform model over the unseen
word; a null id is never held out; repeated rows are scored alike; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.arrow import U64, blocks, map_batches, mix, words
from zonecast.session import materialize

CLASSES, GROWTH, SIZE, NOISE, STEPS = 768, 2, 24, 16, 160
#: Classes whose pairs are held at once in training; tokens at once in scoring.
ROWS, SPAN = 256, 1 << 16
HOT = 1 << 18
#: Pairs of tokens a task combines before it hands counts on.
HELD = 1 << 22
END = int(mix(np.array([0xE0D], dtype=U64)).view(np.int64)[0])


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, tokens before each row): words, then one end, by row."""
    found, before = words(data, offs)
    out = np.full(len(found) + len(offs) - 1, END, dtype=np.int64)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(before))
    out[np.arange(len(found)) + row] = found.view(np.int64)
    return out, before + np.arange(len(offs))


def _combined(kept: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    keys, counts = (np.concatenate(x) for x in zip(*kept, strict=True))
    keys, at = np.unique(keys, return_inverse=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys), pa.array(np.bincount(at, counts, len(keys)).astype(np.int64))], names=["h", "c"])


def _counted(texts: DataFrame, keys) -> DataFrame:
    """(h, c): how often each key occurs; ``keys`` maps (tokens, starts) of a
    block to int64 keys. Tasks combine before the shuffle."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for batch in batches:
            for _, _, data, offs in blocks(batch.column(0)):
                found, n = np.unique(keys(*tokens(data, offs)), return_counts=True)
                kept.append((found, n))
                size += len(found)
                if size > HELD:
                    yield _combined(kept)
                    kept, size = [], 0
        if kept:
            yield _combined(kept)

    return map_batches(texts, work, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


class Model:
    """Counts of the hot words, class numbers and the class model."""

    def __init__(self, counts: DataFrame, hot: np.ndarray, hot_counts: np.ndarray, n: int, v: int):
        self.counts, self.n, self.v = counts, n, v
        order = np.argsort(hot)
        self.hot, self.hot_counts = hot[order], hot_counts[order]
        grown = math.ceil(GROWTH * math.sqrt(v))
        most = np.lexsort((self.hot, -self.hot_counts))[:CLASSES + grown]
        self.n_own, self.n_shared = len(most), max(grown, 1)
        self.rank = np.full(len(hot), -1, dtype=np.int32)  # class of each hot word, -1: shared
        self.rank[most] = np.arange(len(most))
        self.n_classes = self.n_own + self.n_shared
        self.shared_log = self._shared_log(most)
        self.vectors: dict = {}

    def _shared_log(self, own: np.ndarray) -> np.ndarray:
        """log10(tokens + words + 1) of each shared class, without the words
        that have a class of their own."""
        found = self.counts.groupBy(F.pmod("h", F.lit(self.n_shared)).alias("k")).agg(
            (F.sum("c") + F.count("c")).alias("size")).toArrow()
        size = np.zeros(self.n_shared, dtype=np.int64)
        size[found.column("k").to_numpy()] = found.column("size").to_numpy()
        np.subtract.at(size, self.hot[own] % self.n_shared, self.hot_counts[own] + 1)
        return np.log10(size + 1.0)

    def classes(self, found: np.ndarray) -> np.ndarray:
        shared = self.n_own + found % self.n_shared
        if not len(self.hot):
            return shared
        at = np.minimum(np.searchsorted(self.hot, found), len(self.hot) - 1)
        return np.where((self.hot[at] == found) & (self.rank[at] >= 0), self.rank[at], shared)

    def pairs(self, found: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class before, class) of each token; the start is a class of its own."""
        cls = self.classes(found).astype(np.int64)
        prev = np.empty_like(cls)
        prev[1:] = cls[:-1]
        prev[starts[:-1]] = self.n_classes
        return prev, cls

    def logs(self, prev: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """log10 P(class | class before) of each token."""
        x, out = self.vectors, np.empty(len(cls))
        for lo in range(0, len(cls), SPAN):
            a, b = prev[lo:lo + SPAN], cls[lo:lo + SPAN]
            out[lo:lo + SPAN] = np.einsum("ij,ij->i", x["h"][a], x["q"][b]) + x["b"][b] - x["z"][a]
        return out / math.log(10)

    @property
    def log10p(self) -> np.ndarray:
        """The table of all pairs, classes before in rows; for small models."""
        return _table(self.vectors)


def _table(x: dict) -> np.ndarray:
    return (x["h"] @ x["q"].T + x["b"] - x["z"][:, None]) / math.log(10)


def train(pairs: np.ndarray) -> np.ndarray:
    """log10 P(class | class before) from a table of pair counts."""
    rows, cols = pairs.shape
    key = np.flatnonzero(pairs)
    return _table(learn(_by_block([(key, pairs.ravel()[key])], rows, cols), rows, cols))


def _by_block(found: Iterable[tuple[np.ndarray, np.ndarray]], rows: int, cols: int) -> list:
    """(place, count) of the pairs of each block of ROWS classes before, by
    place, from pieces of (class before * cols + class, count)."""
    held: list = [[] for _ in range(-(-rows // ROWS))]
    for key, n in found:
        order = np.argsort(key)
        block, place = np.divmod(key[order], ROWS * cols)
        place, n = place.astype(np.uint32), n[order].astype(np.float32)
        at = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block)) if len(block) else [0]
        for lo, hi in zip(at, at[1:], strict=False):
            held[block[lo]].append((place[lo:hi].copy(), n[lo:hi].copy()))
    for k, pieces in enumerate(held):
        place = np.concatenate([x for x, _ in pieces] or [np.zeros(0, np.uint32)])
        n = np.concatenate([x for _, x in pieces] or [np.zeros(0, np.float32)])
        order = np.argsort(place)
        held[k] = place[order], n[order]
    return held


def _gathered(pairs: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The counted pairs, a batch at a time: the driver holds one partition
    beside what it keeps."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([c.to_numpy(zero_copy_only=False).tobytes()], pa.binary()) for c in batch.columns],
                names=["h", "c"])

    for r in map_batches(pairs, packed, "h binary, c binary").toLocalIterator(prefetchPartitions=True):
        yield np.frombuffer(r.h, np.int64), np.frombuffer(r.c, np.int64)


def learn(pairs: list, rows: int, cols: int) -> dict:
    """Vectors of the classes before (h), of the next ones (q), their biases (b)
    and log normalisers (z) from the counted pairs by block, by noise-contrastive
    estimation of a log-bilinear model, full batch, Adam steps."""
    of_col, of_row = np.zeros(cols), np.zeros(rows)
    for k, (place, n) in enumerate(pairs):
        of_col += np.bincount(place % cols, n, cols)
        found = np.bincount(place // cols, n)
        of_row[k * ROWS:k * ROWS + len(found)] = found
    total = of_row.sum()
    if not total:
        return {"h": np.zeros((rows, SIZE)), "q": np.zeros((cols, SIZE)), "b": np.zeros(cols),
                "z": np.full(rows, math.log(cols))}
    noise = (of_col + 1.0) / (total + cols)
    before = of_row / total
    drawn = (NOISE * cols * noise).astype(np.float32)
    cuts = [*range(0, rows, ROWS), rows]
    rng = np.random.default_rng(7)
    p = {"r": rng.normal(0, 0.1, (rows, SIZE)), "c": np.eye(SIZE), "q": rng.normal(0, 0.1, (cols, SIZE)),
         "b": np.log(noise)}
    m = {k: np.zeros_like(x) for k, x in p.items()}
    s = {k: np.zeros_like(x) for k, x in p.items()}
    shift = np.log(NOISE * noise)
    for step in range(1, STEPS + 1):
        h = p["r"] @ p["c"]
        h32, q32, b32 = h.astype(np.float32), p["q"].astype(np.float32), (p["b"] - shift).astype(np.float32)
        gb, gq, gh = np.zeros(cols), np.zeros((cols, SIZE)), np.empty((rows, SIZE))
        for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
            real = h32[lo:hi] @ q32.T
            real += b32
            np.negative(real, out=real)
            np.exp(np.minimum(real, 80, out=real), out=real)
            real += 1
            np.reciprocal(real, out=real)  # that a pair is data, not noise
            here, n = pairs[k]
            gain = n * np.float32(cols / total) * (1 - real.ravel()[here])
            real *= drawn
            real *= -before[lo:hi, None].astype(np.float32)
            real.ravel()[here] += gain
            gb += real.sum(0)
            gq += real.T @ h32[lo:hi]
            gh[lo:hi] = real @ q32
        grad = {"b": gb, "q": gq, "c": p["r"].T @ gh, "r": gh @ p["c"].T}
        rate = 0.03 * (1 - step / (STEPS + 1))
        for k, g in grad.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.99 * s[k] + 0.01 * g * g
            p[k] = p[k] + rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-10)
    h, z = p["r"] @ p["c"], np.empty(rows)
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        x = h[lo:hi] @ p["q"].T + p["b"]
        top = x.max(1)
        z[lo:hi] = top + np.log(np.exp(x - top[:, None]).sum(1))
    return {"h": h, "q": p["q"], "b": p["b"], "z": z}


def fit(texts: DataFrame) -> Model:
    """Learns from a one-column table of texts."""
    counts = materialize(_counted(texts, lambda found, starts: found), "op4-counts")
    bins = counts.groupBy(F.floor(F.log2("c") * 8).alias("k")).agg(
        F.count("c").alias("words"), F.sum("c").alias("tokens"), F.min("c").alias("least")).collect()
    n, v = sum(b["tokens"] for b in bins), sum(b["words"] for b in bins)
    least, taken = 1, 0
    for b in sorted(bins, key=lambda b: -b["k"]):  # the most frequent words, at most HOT
        taken += b["words"]
        if taken > HOT:
            break
        least = b["least"]
    else:
        taken = 0
    hot = counts.where(F.col("c") >= least).toArrow() if bins and (taken == 0 or least > 1) else None
    keys = hot.column("h").to_numpy() if hot else np.zeros(0, np.int64)
    model = Model(counts, keys, hot.column("c").to_numpy() if hot else np.zeros(0, np.int64), n, v)
    width = model.n_classes
    shared = texts.sparkSession.sparkContext.broadcast(model_parts(model))
    found = _counted(texts, lambda f, starts: _pair_keys(from_parts(shared.value), f, starts, width))
    model.vectors = learn(_by_block(_gathered(found), width + 1, width), width + 1, width)
    return model


def model_parts(model: Model) -> dict:
    """What tasks need of a model: numpy arrays of the hot words and the classes."""
    return {k: x for k, x in vars(model).items() if k != "counts"}


def from_parts(parts: dict) -> Model:
    model = Model.__new__(Model)
    vars(model).update(parts)
    return model


def _pair_keys(model: Model, found: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    prev, cls = model.pairs(found, starts)
    return prev * width + cls


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each row's values; every row has at least its end token."""
    return np.add.reduceat(values, starts[:-1]) if len(starts) > 1 else np.zeros(0)


def _scored(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row of sums for each text, and one for each text and rare word; columns
    from the third on are handed through with the sums."""
    for batch in batches:
        for lo, hi, data, offs in blocks(batch.column("text")):
            found, starts = tokens(data, offs)
            row = np.repeat(np.arange(hi - lo), np.diff(starts))
            prev, cls = model.pairs(found, starts)
            at = np.minimum(np.searchsorted(model.hot, found), max(len(model.hot) - 1, 0))
            hot = model.hot[at] == found if len(model.hot) else np.zeros(len(found), dtype=bool)
            logs = np.zeros(len(found))
            if hot.any():
                logs[hot] = np.log10(model.hot_counts[at[hot]] + 1.0)
            keys = batch.column("row").to_numpy()[lo:hi]
            own = model.logs(prev, cls)
            among = np.flatnonzero(cls >= model.n_own)  # the share of a word in a shared class
            own[among] += logs[among] - model.shared_log[cls[among] - model.n_own]
            out = [keys, np.full(hi - lo, None), np.diff(starts), _sums(hot.astype(np.int64), starts),
                   _sums(logs, starts), _sums(own, starts)]
            names = ["row", "h", "n", "known", "logs", "model"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            through = batch.columns[2:]
            kept = batch.schema.names[2:]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, type=k) for x, k in zip(out, kinds, strict=True)), *(c.slice(lo, hi - lo) for c in through)],
                names=names + kept)
            cold = np.flatnonzero(~hot)
            if len(cold):  # one row for each document and rare word
                order = np.lexsort((found[cold], row[cold]))
                r, f = row[cold][order], found[cold][order]
                new = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (f[1:] != f[:-1])))
                times = np.diff(np.append(new, len(r)))
                none = pa.nulls(len(new), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[r[new]]), pa.array(f[new]), pa.array(times), none,
                     none.cast(pa.float64()), none.cast(pa.float64()),
                     *(pa.nulls(len(new), c.type) for c in through)], names=names + kept)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds n_tokens, n_known, train_tokens, base_score and score to the
    documents' other columns. Texts are read once and not shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model_parts(model))
    kept = [c for c in docs.columns if c != text_col]
    named = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"),
                        *(F.col(c).alias(f"k{i}") for i, c in enumerate(kept)))
    kinds = "".join(f", k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(kept))
    found = materialize(map_batches(
        named, lambda batches: _scored(from_parts(shared.value), batches),
        "row long, h long, n long, known long, logs double, model double" + kinds), "op4-scored")
    rare = (found.where("h is not null").select("row", "h", "n")
            .join(model.counts, "h", "left")
            .groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
                                F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("rare_logs")))
    whole = found.where("h is null").drop("h").join(rare, "row", "left")
    more, rare_known = F.coalesce("rare_logs", F.lit(0.0)), F.coalesce("rare_known", F.lit(0))
    base = F.col("logs") + more - F.col("n") * F.lit(math.log10(model.n + model.v + 1))
    own = F.col("model") + more
    return whole.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(kept)),
                        F.col("n").alias("n_tokens"), (F.col("known") + rare_known).alias("n_known"),
                        F.lit(model.n).cast("long").alias("train_tokens"), base.alias("base_score"), own.alias("score"))
