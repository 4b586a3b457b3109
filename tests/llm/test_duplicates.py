import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.llm import components, jaccard_join, multi_index, suffix_dedup

from .conftest import prose


def groups(links, ids):
    of = {i: i for i in ids}

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        of[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def test_components_of_chains(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60) if i % 7] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)]
    ids = {x for e in edges for x in e if e[0] != e[1]}
    want = groups([e for e in edges if e[0] != e[1]], ids)
    got = components.components(spark.createDataFrame([*edges, (5, None), (7, 7)], "a long, b long"))
    assert {r.id: r.component for r in got.collect()} == want


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_jaccard_equals_all_pairs(spark, k, percent, monkeypatch):
    """Near copies at every distance, tiny sets and a large group, with chunks
    and combining small enough that every branch is taken."""
    monkeypatch.setattr(jaccard_join, "CHUNK", 16)
    monkeypatch.setattr(jaccard_join, "HELD", 500)
    rng = random.Random(7)
    texts = []
    for n in (3, 4, 6, 9, 14, 25, 60, 150, 400):
        base = prose(rng, n).split()
        for _ in range(9):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, n // 12))):
                w[rng.randrange(len(w))] = prose(rng, 1)
            texts.append(" ".join(w))
    base = prose(rng, 200).split()
    for _ in range(70):  # a group of near copies
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = prose(rng, 1)
        texts.append(" ".join(w))
    sets = [shingles(t, k) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = groups(links, range(len(sets)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df, k, percent).collect()}
    assert got == {i: (len(s), want[i]) for i, s in enumerate(sets)}


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2 ** 63, 300).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 2 ** 63, 20).astype(np.uint64)]))
        x, y = jaccard_join.folded([jaccard_join.sketch(a), jaccard_join.sketch(b)])
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_jaccard_odd_rows(odd, odd_rows, empty):
    got = collections.Counter(map(tuple, jaccard_join.near_duplicates(odd, 3, 90).collect()))
    sets = [shingles(t, 3) for _, t, *_ in odd_rows]
    named = [r[0] for r in odd_rows]
    links = [(a, b) for a in range(len(sets)) for b in range(a)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    of = groups(links, range(len(sets)))
    least = {}
    for i, g in of.items():
        if sets[i] and named[i] is not None:
            least[g] = min(least.get(g, named[i]), named[i])
    want = collections.Counter((named[i], len(s), least.get(of[i]) if s else named[i]) for i, s in enumerate(sets))
    assert got == want
    assert jaccard_join.near_duplicates(empty).count() == 0


def covered(texts, size=200):
    out, seen = [np.zeros(len(t), bool) for t in texts], {}
    for i, t in enumerate(texts):
        for p in range(len(t) - size + 1):
            w = t[p:p + size]
            if w in seen:
                out[i][p:p + size] = True
                j, q = seen[w]
                out[j][q:q + size] = True
            else:
                seen[w] = (i, p)
    return out


@pytest.mark.parametrize("group", [2000, 3])
def test_suffix_dedup_equals_all_windows(spark, odd_rows, empty, group, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rng = random.Random(11)
    shared = prose(rng, 70)
    texts = [t for _, t, *_ in odd_rows if t is None or len(t) < 20_000]
    texts += [prose(rng, 30) + shared + prose(rng, 20) for _ in range(6)] + ["ab" * 400, "Is " * 300]
    texts += [shared[:199], shared[:200], shared[40:], shared + " " + shared]
    rows = list(enumerate(texts))
    rows.append(rows[-1])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept)) for r in suffix_dedup.deduplicate(df).collect())
    raw = [(t or "").encode() for _, t in rows]
    want = collections.Counter()
    for (i, _), t, m in zip(rows, raw, covered(raw), strict=True):
        runs = int((np.diff(np.concatenate([[0], m.astype(int), [0]])) == 1).sum())
        want[(i, len(t), int(m.sum()), runs, bytes(np.frombuffer(t, np.uint8)[~m]))] += 1
    assert got == want
    assert suffix_dedup.deduplicate(empty).count() == 0


def test_suffix_anchors_of_pieces_agree(monkeypatch):
    data = np.frombuffer((prose(random.Random(4), 900) + "ab" * 500).encode(), np.uint8)
    whole = suffix_dedup.anchors(data)
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    for a, b in zip(whole, suffix_dedup.anchors(data), strict=True):
        assert a.tolist() == b.tolist()
    assert suffix_dedup._substrings(data, whole[0], 40).tolist() == suffix_dedup.Prefix(data).of(whole[0], 40).tolist()


def test_merge_sort_orders_suffixes():
    data = np.frombuffer((prose(random.Random(9), 400) * 2).encode(), np.uint8)
    start = np.arange(0, len(data) - 200, 3)
    group = np.sort(np.random.default_rng(1).integers(0, 5, len(start)))
    s = suffix_dedup.Suffixes(data, start)
    raw = data.tobytes()
    want = sorted(range(len(start)), key=lambda i: (group[i], raw[start[i]:start[i] + 200], i))
    assert suffix_dedup.merge_sorted(s, group).tolist() == want


def test_embeddings_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "CHUNK", 40)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(260, 16))
    v[100:180] = v[0] + 0.12 * rng.normal(size=(80, 16))  # a hot cell
    v[180:200] = v[1]
    rows = [(i, [float(y) for y in np.float32(x)], i % 2 if i < 100 else 0) for i, x in enumerate(v)]
    rows += [(300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] * 16, 0), (303, [None] * 16, 0), (304, [], 0),
             (305, rows[0][1], None), (306, [float("inf")] * 16, 0), (307, [1.0, 2.0], 0), (308, [2.0, 4.0], 0),
             (309, [1e-30 * y for y in rows[0][1]], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in multi_index.near_duplicates(df).collect()}
    good = {i: np.array(x, dtype=np.float32).astype(float) for i, x, lab in rows
            if lab is not None and x and None not in x and np.isfinite(x).all() and any(x)}
    lab = {i: y for i, _, y in rows}
    cos = lambda a, b: a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)
    links = [(a, b) for a in good for b in good
             if a != b and lab[a] == lab[b] and len(good[a]) == len(good[b]) and cos(good[a] / abs(good[a]).max(), good[b] / abs(good[b]).max()) >= 0.93]
    n = collections.Counter(a for a, _ in links)
    assert all(got[i].n_links <= n[i] for i in lab)
    assert sum(r.n_links for r in got.values()) >= 0.9 * len(links)
    of = groups(links, lab)
    assert sum(got[i].component_id == of[i] and got[i].kept == (of[i] == i) for i in lab) >= 0.98 * len(lab)
    assert {i for i in range(300, 307) if got[i].n_links or got[i].component_id != i} == set()
    assert got[307].component_id == got[308].component_id == 307 and got[309].component_id == 0
    assert multi_index.near_duplicates(df.where("false")).count() == 0


def test_multi_sequence_walk_visits_nearest_cells():
    rng = np.random.default_rng(1)
    grid = multi_index.Grid(rng.normal(size=(9, 4)), rng.normal(size=(9, 4)), 7)
    x = rng.normal(size=(30, 8))
    a, b = grid.halves(x)
    cost = (a[:, :, None] + b[:, None, :]).reshape(30, -1)
    assert (np.sort(np.take_along_axis(cost, grid.visited(x), 1)) == np.sort(cost, axis=1)[:, :7]).all()


def by_hand(rows, k, percent):
    """(sets, group number of each row, smallest id of each group) by all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    links = [(a, b) for a in range(len(sets)) for b in range(a)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    of, least = groups(links, range(len(sets))), {}
    for i, g in of.items():
        if rows[i][0] is not None:
            least[g] = min(least.get(g, rows[i][0]), rows[i][0])
    return sets, of, least


def ids_that_repeat(seed):
    """The verdict's rows (different linked texts under one id; a near copy under a null
    id), and many texts, copies and near copies under few ids, a fifth of them null."""
    rng = random.Random(seed)
    a, b, c = (prose(rng, 120) for _ in range(3))
    rows = [(10, a), (10, b), (2, a + " tail"), (3, b + " tail"), (None, c), (5, c + " tail"), (None, c), (None, ""), (7, ""), (7, None)]
    base = [prose(rng, rng.randrange(8, 90)) for _ in range(25)]
    for _ in range(150):
        t = rng.choice(base)
        t = rng.choice([t, t + " more", "more " + t, t.rsplit(" ", 1)[0]])
        rows.append((None if rng.random() < 0.2 else rng.randrange(20, 50), t))
    only = prose(rng, 60)  # a chain that hangs together by a row without an id only
    return rows + [(60, only), (None, only + " x y"), (None, only + " x y z u"), (61, prose(rng, 60))]


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_jaccard_with_repeated_and_null_ids_equals_all_pairs(spark, k, percent):
    rows = ids_that_repeat(k)
    sets, of, least = by_hand(rows, k, percent)
    want = collections.Counter((i, len(s), least.get(of[n]) if s else i) for n, ((i, _), s) in enumerate(zip(rows, sets, strict=True)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert collections.Counter(map(tuple, jaccard_join.near_duplicates(df, k, percent).collect())) == want


def test_one_row_of_each_group_is_left(spark):
    rows = ids_that_repeat(8)
    sets, of, least = by_hand(rows, 5, 80)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("__row", F.lit(1))
    left = jaccard_join.one_of_each(df)
    assert left.columns == df.columns
    got = [(r.doc_id, r.text) for r in left.collect()]
    group_of = {(i, t): of[n] for n, (i, t) in enumerate(rows)}
    full = [x for x in got if shingles(x[1], 5)]
    found = collections.Counter(group_of[x] for x in full)
    assert found == collections.Counter({of[n] for n, s in enumerate(sets) if s})
    assert all(x[0] == least.get(group_of[x]) for x in full)
    assert sorted((str(i), t or "") for i, t in got if not shingles(t, 5)) == [("7", ""), ("None", "")]
