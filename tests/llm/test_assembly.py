"""Centroid tree, best-fit packing and fill-in-middle against plain Python."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zonecast.llm import best_fit, centroid_tree, fill_middle

from .conftest import prose

# ------------------------------------------------------------- op11


@pytest.mark.parametrize("k", [1, 2, 5, 17, 300])
def test_tree_equals_all_centroids(k):
    """Small integers in three dimensions: many ties and equal centroids."""
    rng = np.random.default_rng(k)
    c, v = rng.integers(-4, 5, (k, 3)), rng.integers(-6, 7, (1500, 3))
    number, best = centroid_tree.nearest(centroid_tree.build(c), v)
    d = ((v[:, None] - c[None]) ** 2).sum(-1)
    assert (best == d.min(1)).all()
    assert (number == d.argmin(1)).all()


def test_tree_opens_few_leaves():
    """In well separated groups most of the centroids are never compared."""
    rng = np.random.default_rng(4)
    c = rng.integers(-1000, 1001, (512, 3))
    v = c[rng.integers(0, 512, 200)] + rng.integers(-2, 3, (200, 3))
    tree, seen = centroid_tree.build(c), 0
    plain = centroid_tree._squared

    def counted(a, b):
        nonlocal seen
        seen += np.broadcast_shapes(a.shape, b.shape)[0] * np.broadcast_shapes(a.shape, b.shape)[1]
        return plain(a, b)

    centroid_tree._squared = counted
    try:
        number, _ = centroid_tree.nearest(tree, v)
    finally:
        centroid_tree._squared = plain
    assert (number == ((v[:, None] - c[None]) ** 2).sum(-1).argmin(1)).all()
    assert seen < 0.3 * 200 * 512


def lloyd(rows, k, rounds, dim, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"1:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cents = [v for _, v in sorted(kept, key=key)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        of = assign()
        for j in range(len(cents)):
            mine = [v for (_, v), (_, a) in zip(kept, of, strict=True) if a == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    of, per = assign(), collections.Counter()
    for d, j in of:
        per[j] += d
    return sorted(((i, j, d, per[j], sum(per.values()), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest())
                   for (i, _), (d, j) in zip(kept, of, strict=True)), key=repr)


def test_clusters_equal_plain_rounds_on_odd_rows(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, -0.25, 0.0, 0.26, 0.5]) for _ in range(4)]) for i in range(90)]
    rows += [rows[3], rows[3], (None, rows[4][1]), (None, [0.1] * 4), (200, None), (201, [0.1] * 3), (202, []),
             (203, [0.1, None, 0.1, 0.1]), (204, [0.1, float("nan"), 0.1, 0.1]), (205, [float("inf")] * 4)]
    rows += [(300 + i, rows[0][1]) for i in range(60)]     # copies
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    df = df.withColumns({c: F.lit(1) for c in ("id", "v", "cluster", "n", "s", "label")})
    for k, rounds in ((6, 3), (5, 0), (400, 2)):
        got = centroid_tree.cluster(df, k=k, rounds=rounds, dim=4).collect()
        assert sorted(map(tuple, got), key=repr) == lloyd(rows, k, rounds, 4)
    none = centroid_tree.cluster(df.where("vec_id < 0"), dim=4)
    assert none.count() == 0
    assert none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_huge_components_are_refused(spark):
    df = spark.createDataFrame([(1, [3e38, 0.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match=r"(?i)passes|overflow|cast"):
        centroid_tree.cluster(df, dim=2).collect()


# ------------------------------------------------------------- op12

CODER = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def checked(packed, capacity):
    """The sequences of packed rows are gapless and not too long; their number."""
    of = collections.defaultdict(list)
    for r in packed:
        of[r.sequence_id].append((r.offset, r.length))
    for rows in of.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= capacity
    return len(of)


def expected_pieces(tokenizer, rows, capacity):
    want = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want += [(i, j, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for j, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    return sorted(want, key=repr)


def test_pieces_equal_the_library(spark, odd, odd_rows):
    more = [(500, "a <|endoftext|> b<|endoftext|>"), (501, "0" * 40_000), (502, "\n \t" * 5000), (503, "é" * 2047), (504, " word" * 2047)]
    rows = [(r[0], r[1]) for r in odd_rows] + more
    df = odd.select("doc_id", "text", "id", "n").unionByName(
        spark.createDataFrame(more, "doc_id long, text string").withColumns({"id": F.lit(2), "n": F.lit(2)}))
    got = best_fit.pieces(df, *CODER).collect()
    assert sorted(map(tuple, got), key=repr) == expected_pieces(Tokenizer.from_file(CODER[0]), rows, 2048)


def test_coder_gives_way_to_the_library():
    """A text that the fast expressions give up on has the same ids."""
    text = " " * 2_000_000 + "end"
    c = best_fit.Coder(*CODER)
    assert c.ids(text).tolist() == Tokenizer.from_file(CODER[0]).encode(text, add_special_tokens=False).ids


def test_brackets_pair_each_piece_with_its_best_gap():
    rng = random.Random(2)
    for _ in range(60):
        rows = sorted(((-rng.randrange(1, 9), rng.random() < 0.5) for _ in range(rng.randrange(1, 40))), key=lambda r: (r[0], r[1]))
        stack, want = [], set()
        for i, (_, piece) in enumerate(rows):
            if not piece:
                stack.append(i)
            elif stack:
                want.add((stack.pop(), i))
        _, gaps, taken = best_fit.brackets(np.array([p for _, p in rows]))
        assert set(zip(gaps.tolist(), taken.tolist(), strict=True)) == want


@pytest.mark.parametrize("rows", [7, 10_000])
def test_match_across_ranges_equals_one_stack(spark, rows):
    """Pairs found inside ranges and by rank between ranges are those of one sweep."""
    rng = random.Random(rows)
    pieces = [(i, rng.randrange(1, 60), (i,)) for i in range(150)]
    gaps = [(i, rng.randrange(1, 70), 1) for i in range(90)]
    active = spark.createDataFrame(pieces, "uid long, size long, row struct<i: long>")
    slots = spark.createDataFrame(gaps, "seq long, size long, slot long")
    done, rest = best_fit.match(active, slots, 240, rows)
    got = {r.uid: r.seq for r in done.collect()}
    assert sorted([*got, *(r.uid for r in rest.collect())]) == list(range(150))
    stack, want = [], {}
    for size, piece, i in sorted([(-s, 1, i) for i, s, _ in pieces] + [(-s, 0, i) for i, s, _ in gaps]):
        if not piece:
            stack.append(i)
        elif stack:
            want[i] = stack.pop()
    assert got == want


@pytest.mark.parametrize(("name", "rows"), [("uniform", 10_000), ("small", 10_000), ("thirds", 10_000), ("hot", 10_000), ("uniform", 60)])
def test_packing_is_whole_and_near_the_best(spark, name, rows):
    rng = random.Random(8)
    sizes = {"uniform": [rng.randrange(1, 257) for _ in range(700)], "small": [rng.randrange(1, 9) for _ in range(900)],
             "thirds": [rng.randrange(70, 100) for _ in range(500)],
             "hot": [100] * 300 + [256] * 20 + [rng.randrange(1, 257) for _ in range(300)]}[name]
    df = spark.createDataFrame([(i, n, "x") for i, n in enumerate(sizes)], "doc_id long, length long, uid string").repartition(3)
    got = best_fit.pack(df, 256, rows=rows).collect()
    assert sorted((r.doc_id, r.length, r.uid) for r in got) == [(i, n, "x") for i, n in enumerate(sizes)]
    room = [0] * 257            # best fit decreasing, by free room
    bins = 0
    for n in sorted(sizes, reverse=True):
        fit = next((f for f in range(n, 257) if room[f]), None)
        if fit is None:
            bins += 1
            fit = 256
        else:
            room[fit] -= 1
        room[fit - n] += 1
    assert checked(got, 256) <= bins * 1.02 + 1


def test_packed_sequences_hold_their_ids(spark, odd, empty):
    made = best_fit.pack(best_fit.pieces(odd, *CODER, capacity=64, with_ids=True), 64)
    rows = made.collect()
    checked(rows, 64)
    seqs = {r.sequence_id: r.ids for r in best_fit.sequences(made).collect()}
    for r in rows:
        assert seqs[r.sequence_id][r.offset:r.offset + r.length] == r.ids
    assert best_fit.pack(best_fit.pieces(empty, *CODER)).count() == 0
    with pytest.raises(ValueError, match="outside"):
        best_fit.pack(spark.createDataFrame([(1, 70)], "doc_id long, length long"), 64)


# ------------------------------------------------------------- op13


def filled(key, text):
    text = text or ""
    n = len(text)
    h = hashlib.sha256(f"1:{'null' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not n or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return key, n, "plain", None, None, text
    if h4 % 100 < 20:
        return key, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return key, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def middle_rows(odd_rows):
    rng = random.Random(11)
    bits = ["<", ">", "P", "S", "M", "<P", "S>", "M>", "x", "é", "🎉"]
    return [(r[0], r[1]) for r in odd_rows] + [(1000 + i, "".join(rng.choice(bits) for _ in range(rng.randrange(0, 12)))) for i in range(300)]


@pytest.mark.parametrize("unit", [1, 2, 3, 64, 1 << 16])
def test_fill_middle_equals_plain_python(spark, odd_rows, unit):
    """Texts full of pieces of marks, cut into chunks so small that marks straddle them."""
    rows = [r for r in middle_rows(odd_rows) if unit > 3 or len(r[1] or "") < 3000]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "row", "n", "form", "pos")})
    want = [filled(*r) for r in rows]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = fill_middle.digests(df, unit=unit).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        ((*w[:5], sha(w[5]), sha(r[1] or "")) for w, r in zip(want, rows, strict=True)), key=repr)


def test_reader_finds_marks_across_chunks():
    for form, output in (("psm", "<P><<S><P>a<M>b<M"), ("spm", "<S>s<P>p<<M>m<"), ("psm", "<P><S><M>")):
        whole = collections.Counter()
        for step in range(1, len(output) + 1):
            reader, found = fill_middle.Reader(form), collections.defaultdict(bytes)
            for i in range(0, len(output), step):
                for place, body in reader.feed(output[i:i + step].encode()):
                    found[place] += body
            for place, body in reader.rest():
                found[place] += body
            whole[tuple(sorted(found.items()))] += 1
        assert len(whole) == 1


def test_fill_middle_texts_and_back(spark, odd_rows, empty):
    rows = middle_rows(odd_rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = fill_middle.outputs(df)
    assert sorted(map(tuple, made.collect()), key=repr) == sorted((filled(*r) for r in rows), key=repr)
    back = fill_middle.restored(made).select("doc_id", "text").collect()
    assert sorted(map(tuple, back), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert fill_middle.digests(empty).count() == fill_middle.outputs(empty).count() == 0
