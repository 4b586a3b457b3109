import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from zonecast.llm import lm_score, quality_rules, secret_scan, source_mix, winnowing
from zonecast.llm.queries import QUERIES, SQL, remainder

from .conftest import SCHEMA, prose
from .test_duplicates import groups, shingles

SF = "/root/testdata/sf0.001"


def winnow(text):
    """The fingerprint's hashes in order, from plain loops."""
    low = 0x7FFFFFFF

    def longs(values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest((v % 2 ** 64).to_bytes(8, "little"), seed=seed)
        return seed & low

    h = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    if len(h) < winnowing.K:  # Spark hashes an array element by element
        return [longs(h)] if h else []
    g = [longs(h[i:i + winnowing.K]) for i in range(len(h) - winnowing.K + 1)]
    out = []
    for lo in range(max(1, len(g) - winnowing.W + 1)):
        window = range(lo, min(lo + winnowing.W, len(g)))
        at = min(window, key=lambda i: (g[i], -i))
        if at not in out:
            out.append(at)
    return list(dict.fromkeys(g[i] for i in out))


def test_winnowing_equals_plain_loops(odd, odd_rows, empty, monkeypatch):
    monkeypatch.setattr(winnowing, "LEVELS", (2, 1, 1))
    got = winnowing.edited_likeness(odd).collect()
    rows = sorted(((i, t or "") for i, t, *_ in odd_rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        f, e, x = winnow(t), winnow(edited), winnow(after)
        like = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), ",".join(f"{v:X}" for v in f),
                     ",".join(f"{v:X}" for v in e), like(f, e), like(f, x)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert winnowing.edited_likeness(empty).count() == 0


def test_winnowing_guarantee_and_positions(spark):
    rng = random.Random(2)
    shared = prose(rng, winnowing.W + winnowing.K - 1)
    df = spark.createDataFrame([(i, f"{prose(rng, 40)} {shared} {prose(rng, 40)}") for i in range(20)], "doc_id long, text string")
    found = winnowing.fingerprint(df).collect()
    sets = [{x["hash"] for x in r.fingerprint} for r in found]
    assert all(a & b for a in sets for b in sets)
    assert all([x["pos"] for x in r.fingerprint] == sorted({x["pos"] for x in r.fingerprint}) for r in found)


def test_winnowing_of_texts_without_white_space(spark, tmp_path):
    """Near copies of Chinese, Thai and minified text are alike; short words stay whole."""
    rng = random.Random(5)
    rows = []
    for k, letters in enumerate(("天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往秋收冬藏", "กขคงจฉชซญดตถทนบปผพ", "abcdef01(){};=+.🎉")):
        text = "".join(rng.choice(letters) for _ in range(600))
        rows += [(4 * k, text), (4 * k + 1, text[:300] + "#" + text[301:])]
    rows.append((20, f"{'w' * winnowing.RUN} {'v' * (winnowing.RUN + 1)} 中x文"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op6_winnowing"](spark, str(tmp_path)).collect()}
    assert all(got[4 * k].near_next > 0.8 and got[4 * k].near_edited > 0.3 and got[4 * k + 1].near_edited > 0.2 for k in range(3))
    units = df.where("doc_id = 20").select(F.regexp_extract_all("text", F.lit(winnowing.MIXED), F.lit(0))).first()[0]
    assert units == ["w" * winnowing.RUN, *"v" * (winnowing.RUN + 1), "中", "x", "文"]


def base_spans(text):
    pats = [(secret_scan.ASSIGN, 2, 6), (secret_scan.ACCESS, 0, 20), (secret_scan.HEX, 0, 24)]
    return sorted((m.start(), k, m.end()) for k, (p, g, n) in enumerate(pats) for m in re.finditer(p, text or "") if len(m.group(g)) >= n)


@pytest.fixture(scope="module")
def leaks(spark):
    rng = random.Random(6)
    letters = secret_scan.BASE64[:62]
    key = lambda n: "".join(rng.choice(letters) for _ in range(n))
    rows = [(i, prose(rng, 60) + " internationalisation/localisation some_snake_case_identifier " + prose(rng, 20)) for i in range(300)]
    planted = {}
    for i in range(0, 60, 2):
        planted[i] = key(40)
        rows[i] = (i, f"{prose(rng, 9)} 🎉 {planted[i]} {prose(rng, 9)}")
    rows += [(400, 'Token: "abc" token:token: abcdefg PASSWORD = hunter22 api-key=x api_key=\'q1w2e3r4\''), (401, "AKIA" + "Q7" * 9 + " " + "ab" * 16),
             (402, "password=" + "🎉" + " secret=abcdef"), (403, None), (404, ""), (405, "0" * 5000 + " " + "a1" * 40), (405, "0" * 5000)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("__kind", F.lit(1)), rows, planted


def test_secret_scan(leaks, empty):
    df, rows, planted = leaks
    found = secret_scan.find(df).collect()
    want = collections.Counter((i, str(base_spans(t))) for i, t in rows)
    assert collections.Counter((r.doc_id, str([(b.start, b.kind, b.end) for b in r.base])) for r in found) == want
    text = dict(rows)
    extra = {r.doc_id: [text[r.doc_id][s.start:s.end] for s in r.spans if s.kind == 3] for r in found if any(s.kind == 3 for s in r.spans)}
    assert sum(extra.get(i) == [k] for i, k in planted.items()) >= 0.8 * len(planted)
    assert set(extra) <= set(planted)
    assert secret_scan.find(empty).count() == 0


def battery(run):
    """(length, steps against text, whether a key is not rejected) of a run, by numpy."""
    body = run.rstrip("=").translate(str.maketrans("-_", "+/"))
    letters = next((a for p, a in secret_scan.ENCODINGS if re.match(p, body)), secret_scan.BASE64)
    s, a, n = np.array([letters.index(c) for c in body]), len(letters), len(body)
    chi = (np.bincount(s) ** 2).sum() * a / n - n
    up = s >= a / 2
    mean = 1 + 2 * up.sum() * (n - up.sum()) / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    runs = ((up[1:] != up[:-1]).sum() + 1 - mean) / math.sqrt(var) if var > 0 else 99.0
    d = s - s.mean()
    r = (d[1:] * d[:-1]).sum() / (d * d).sum() if d.any() else None
    serial = (r + 1 / n) * math.sqrt(n) if d.any() else 99.0
    key = max((chi - (a - 1)) / math.sqrt(2 * (a - 1)), 0) ** 2 + runs ** 2 + serial ** 2
    equal = max(secret_scan.TEXT_EQUAL * a, 1.3)
    even = ((a - 1) + (n - 1) * (equal - 1) - chi) / math.sqrt(2 * (a - 1) * equal + 4 * (n - 1) * (equal - 1))
    kind = [1 if c.isdigit() else 2 if c.isupper() else 3 if c.islower() else 4 for c in body]
    c = secret_scan.TEXT_CHANGE
    change = (sum(x != y for x, y in zip(kind, kind[1:])) - (n - 1) * c) / math.sqrt((n - 1) * c * (1 - c))
    calm = (secret_scan.TEXT_SERIAL - (1.0 if r is None else r)) * math.sqrt(n)
    z = np.dot(secret_scan.WEIGHTS, (even, change, calm)) / np.linalg.norm(secret_scan.WEIGHTS)
    p = (z * z / 2 + math.log((z + math.sqrt(z * z + 2.546479)) * 1.2533141)) / math.log(10) if z > 0 else 0.0
    return n, min(math.floor(p * secret_scan.STEPS), secret_scan.MOST), key <= secret_scan.VETO


def all_spans(rows):
    """Every span of every row, from loops and the false-discovery rule by hand."""
    tested = [[(m.start(), m.end(), *battery(m.group())) for m in re.finditer(secret_scan.RUN, t or "")] for _, t in rows]
    band = lambda n: sum(n >= b for b in secret_scan.BANDS)
    least = {}
    for b in range(1, len(secret_scan.BANDS) + 1):
        steps = sorted((x[3] for r in tested for x in r if band(x[2]) == b), reverse=True)
        good = [v for v in set(steps) if 10 ** (-v / secret_scan.STEPS) <= secret_scan.FALSE_SHARE * sum(u >= v for u in steps) / len(steps)]
        least[b] = min(good, default=math.inf)
    out = []
    for (_, t), runs in zip(rows, tested, strict=True):
        base = base_spans(t)
        out.append(sorted(base + [(s, 3, e) for s, e, n, v, ok in runs
                                  if ok and v >= least[band(n)] and not any(x < e and s < y for x, _, y in base)]))
    return out


def test_added_spans_equal_numpy(leaks):
    df, rows, _ = leaks
    got = collections.Counter((r.doc_id, str([(s.start, s.kind, s.end) for s in r.spans])) for r in secret_scan.find(df).collect())
    assert got == collections.Counter((i, str(s)) for (i, _), s in zip(rows, all_spans(rows), strict=True))


def test_secrets_of_a_text_with_thousands_of_keys(spark):
    """All spans and the redacted text, in time that follows the length."""
    rng = random.Random(9)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    b64 = lambda n: "".join(rng.choice(secret_scan.BASE64[:62]) for _ in range(n))
    one = [f"{'é🎉' * (k % 3)}{hexes(32)} token={b64(12)} {b64(40)}{hexes(3) if k % 2 else ''}" for k in range(4000)]
    rows = [(0, " ".join(one)), (1, "password=" + "ab" * 30_000 + "\n" + b64(36)), (2, "plain words only"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = all_spans(rows)
    start = time.monotonic()
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans] for r in secret_scan.find(df).collect()}
    assert got == {i: s for (i, _), s in zip(rows, want, strict=True)} and len(got[0]) > 9000
    done = {r.doc_id: r.text for r in secret_scan.redact(df).collect()}
    assert time.monotonic() - start < 60
    for (i, text), found in zip(rows, want, strict=True):
        out, at = [], 0
        for s, _, e in found:
            if s >= at:
                out += [text[at:s], "[SECRET]"]
            at = max(at, e)
        assert done[i] == (None if text is None else "".join(out) + text[at:])


def test_secret_report_and_redaction(leaks):
    df, rows, _ = leaks
    report = {(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secret_scan.report(secret_scan.find(df)).collect()}
    for i, t in rows:
        b = base_spans(t)
        line = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in b)
        n = collections.Counter(k for _, k, _ in b)
        assert (i, n[0], n[1], n[2], hashlib.sha256(line.encode()).hexdigest()) in report
    spans = {r.doc_id: r.spans for r in secret_scan.find(df.where("doc_id < 403")).collect()}
    done = secret_scan.redact(df.where("doc_id < 403"))
    assert done.columns == df.columns
    for r in done.collect():
        text, out, at = dict(rows)[r.doc_id], "", 0
        for s in spans[r.doc_id]:
            if s.end > at:
                out += (text[at:s.start] + "[SECRET]") if s.start >= at else ""
                at = s.end
        assert r.text == out + text[at:]


def test_tail_steps(spark):
    for z in (0.5, 1.0, 3.0, 6.0, 12.0):
        exact = -math.log10(math.erfc(z / math.sqrt(2)) / 2) * secret_scan.STEPS
        assert abs(spark.range(1).select(secret_scan._tail_steps(F.lit(z))).first()[0] - exact) <= 1.5


def test_source_mix(spark, odd, odd_rows, empty):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(1, 40)), "en", "big" if i % 10 else f"s{i % 30}", 1) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = source_mix.plan(df, repeat=3.0).collect()
    total = collections.Counter()
    for r in got:
        total[r["__source"]] += r["__tokens"]
    a = max(0.0, 1 - math.log(3) / math.log(max(total.values()) / min(total.values())))
    want = {s: (t / max(total.values())) ** (a - 1) for s, t in total.items()}
    taken = collections.Counter()
    for r in got:
        assert r["copies"] >= 1 and abs(r["epochs"] - want[r["__source"]]) < 1e-5
        taken[r["__source"]] += r["__tokens"] * r["copies"]
    most = max(r["__tokens"] for r in got)
    assert all(want[s] * total[s] - most <= taken[s] <= want[s] * total[s] + 1e-3 for s in total)
    assert abs(sum({r["__source"]: r["weight"] for r in got}.values()) - 1) < 1e-9
    entropy = {r["__source"]: r["weight"] for r in source_mix.plan(df, repeat=50.0, entropy=0.9).collect()}
    assert abs(-sum(w * math.log(w) for w in entropy.values()) / math.log(len(entropy)) - 0.9) < 1e-4
    out = source_mix.apply(odd)
    assert out.columns == odd.columns
    assert {r[0] for r in out.collect()} == {r[0] for r in odd_rows}
    assert source_mix.apply(empty).count() == 0 and source_mix.apply(df.where("source = 'big'")).count() == sum(r[3] == "big" for r in rows)


@pytest.mark.parametrize("share", [0.0, 0.3, 0.9, 1.7, 5.0])
def test_source_mix_budget(spark, share):
    """Documents out below the corpus, repeated above it, no source over the limit."""
    rng = random.Random(12)
    rows = [(i, prose(rng, rng.randrange(1, 40)), "en", "big" if i % 10 else f"s{i % 40}" if i % 70 else None, 1) for i in range(900)]
    rows += [(1000, None, None, "silent", 0), (1001, "", "en", "silent", 0), (None, "a b c", "en", "big", 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    size, total = {}, collections.Counter()
    for i, t, _, s, _ in rows:
        size[s, i] = len((t or "").split())
        total[s] += size[s, i]
    every = sum(total.values())
    budget = int(share * every)
    got = source_mix.plan(df, budget=budget).collect()
    assert len(got) == len(rows)
    b, shares = min(budget, 2 * every), sorted(t / every for t in total.values() if t)
    most = lambda a: b / every * shares[0] ** (a - 1) / sum(x ** a for x in shares)
    low, high = 0.0, 0.0 if most(0) <= 2 else 1.0
    for _ in range(45):
        m = (low + high) / 2
        low, high = (low, m) if most(m) <= 2 else (m, high)
    want = {s: b * (t / every) ** high / sum(x ** high for x in shares) / t if t else 1.0 for s, t in total.items()}
    want_copies = {}
    for s, n in want.items():
        left = (round(n, 6) - math.floor(round(n, 6))) * total[s]
        key = lambda i: hashlib.md5(f"mix:{math.floor(round(n, 6))}:{'null' if i is None else i}".encode()).hexdigest()  # noqa: B023, E731
        for i in sorted((i for x, i in size if x == s), key=key):
            left -= size[s, i]
            want_copies[s, i] = math.floor(round(n, 6)) + (left >= 0 and size[s, i] > 0)
    assert {(r["__source"][1:] or None, r["__id"]): r["copies"] for r in got} == want_copies
    assert max(want.values()) <= 2 + 1e-6 and sum(want_copies[k] * size[k] for k in size) <= b
    out = [(r.source, r.doc_id) for r in source_mix.apply(df, budget=budget).collect()]
    assert collections.Counter(out) == collections.Counter({k: n for k, n in want_copies.items() if n})
    # in the order of the mix: a half of it has a half of each large source, an epoch ends before the next one, and epochs differ
    if share == 1.7:
        half = collections.Counter(s for s, _ in out[:len(out) // 2])
        assert abs(half["big"] / sum(s == "big" for s, _ in out) - 0.5) < 0.08
        seen = [i for s, i in out if s == "big"]
        n = len({*seen})
        assert len(set(seen[:n])) == n and seen[n:] != [i for i in seen[:n] if i in set(seen[n:])]


def test_quality_rules(spark, odd, odd_rows, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rules = quality_rules.train(docs, labels, remainder("doc_id", 5) != 0)
    held = quality_rules.score(docs, rules).join(labels, "doc_id").where(remainder("doc_id", 5) == 0).select("score", "predicted", "quality").toPandas()
    assert len(held) > 40 and (held.predicted == held.quality).mean() > 0.93
    df, names = quality_rules.statistics(odd)
    rows = df.withColumn("s", rules.column(names)).select("s", *names).toPandas().to_numpy(float)
    assert np.allclose(rows[:, 0], rules.score(rows[:, 1:])) and len(rows) == len(odd_rows)
    assert quality_rules.score(empty, rules).count() == 0
    none = quality_rules.train(docs, labels.where("false"))
    assert quality_rules.score(odd, none).select("score").distinct().count() == 1
    twice = labels.unionByName(labels).unionByName(labels.selectExpr("doc_id", "cast(null as int) quality", "toxic"))
    assert quality_rules.train(docs, twice, remainder("doc_id", 5) != 0).rules == rules.rules


def test_rules_recover_a_conjunction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 5))
    y = ((x[:, 0] > 0.6) & (x[:, 3] <= 0.5)).astype(float)
    assert ((quality_rules.fit(x, y).score(x) > 0.5) == y).mean() > 0.97


def test_lm_score(spark, odd, odd_rows, empty, monkeypatch):
    monkeypatch.setattr(lm_score, "HOT", 300)
    monkeypatch.setattr(lm_score, "CLASSES", 40)
    train = [t for i, t, *_ in odd_rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    held = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    docs = odd.select("doc_id", "text", held.alias("held_out"))
    model = lm_score.fit(odd.where(remainder("doc_id", 7) != 2).select("text"))
    end = object()
    words = lambda t: [*(t or "").encode().lower().split(), end]
    c = collections.Counter(w for t in train for w in words(t))
    n, v = sum(c.values()), len(c)
    assert (model.n, model.v) == (n, v) and np.allclose((10 ** model.log10p).sum(1), 1)
    got = collections.Counter()
    for r in lm_score.score(docs, model).collect():
        got[r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)] += 1
        assert r.score <= 0
    want = collections.Counter()
    for i, t, *_ in odd_rows:
        w = words(t)
        want[i, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 3)] += 1
    assert got == want
    assert lm_score.score(empty.select("doc_id", "text"), model).count() == 0
    none = lm_score.fit(empty.select("text"))
    assert none.n == 0 and lm_score.score(docs, none).count() == len(odd_rows)


def test_lm_learns_word_order():
    """Pairs with structure: held-out likelihood above the unigram's, near the true one's."""
    rng = np.random.default_rng(4)
    truth = rng.dirichlet(np.full(20, 0.2), 20)
    pairs = np.zeros((21, 20))
    for a in range(20):
        pairs[a] = rng.multinomial(3000, truth[a])
    log10p = lm_score.train(pairs)
    assert np.allclose((10 ** log10p).sum(1), 1)
    flat = np.log10(pairs.sum(0) / pairs.sum())
    best = (truth * np.log10(np.maximum(truth, 1e-12))).sum() / 20
    mine, uni = (truth * log10p[:20]).sum() / 20, (truth * flat).sum() / 20
    assert uni + 0.8 * (best - uni) < mine


def test_lm_classes_grow_with_the_vocabulary(spark, monkeypatch):
    """Words beyond the CLASSES most frequent ones keep a class and a context:
    each of 300 words has one next word."""
    monkeypatch.setattr(lm_score, "CLASSES", 4)
    rng = random.Random(11)
    rows = []
    for i in range(400):
        at = rng.randrange(300)
        rows.append((i, " ".join(f"w{(at + k) % 300}" for k in range(60))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm_score.fit(df.where("doc_id < 360").select("text"))
    grown = math.ceil(lm_score.GROWTH * math.sqrt(model.v))
    assert (model.v, model.n_own, model.n_shared) == (301, 4 + grown, grown)
    assert (np.bincount(model.classes(model.hot), minlength=model.n_classes)[model.n_own:] > 0).sum() > 0.9 * grown
    held = lm_score.score(df.where("doc_id >= 360"), model).toPandas()
    assert (held.score - held.base_score).sum() / held.n_tokens.sum() > 0.5
    with_unseen = lm_score.score(spark.createDataFrame([(0, "w1 never seen")], "doc_id long, text string"), model).first()
    assert with_unseen.n_known == 2 and with_unseen.score < 0


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left, rows = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, left, SF)
        assert name == "encode" or out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        left = spark.read.parquet(f"{tmp_path}/{name}")
        rows[name] = left.collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in rows["quality"]}
    assert sum((i in kept) == bool(q) for i, q in labels.items()) > 0.93 * len(labels)
    sets = {r.doc_id: shingles(r.text, 5) for r in rows["quality"]}
    links = [(a, b) for a in sets for b in sets if a > b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert {r.doc_id for r in rows["near_duplicates"]} == set(groups(links, sets).values())
    assert all(not base_spans(r.text) and r.n_chars == len(r.text) for r in rows["secrets"])
    before = {r.doc_id: r.text for r in rows["near_duplicates"]}
    assert all(r.text == before[r.doc_id] for r in rows["secrets"] if "[SECRET]" not in r.text)
    assert {r.doc_id for r in rows["secrets"]} == set(before) == {r.doc_id for r in rows["mix"]}
    text = {r.doc_id: r.text for r in rows["mix"]}
    assert len(rows["encode"]) == len(rows["mix"])
    assert all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() and r.n_tokens == len(r.ids) for r in rows["encode"])


def test_pipeline_odd_and_empty_tables(spark, odd, odd_rows, empty, tmp_path):
    for df, least in ((odd, 1), (empty.withColumn("score", F.lit(1)), 0)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, df, SF)
            assert out.count() >= (least if k else 0)
            if name != "encode":
                assert out.columns == df.columns


def test_registered():
    import __spark_entry__ as e
    ops = sorted((int(m[1]) for q in e.queries() if (m := re.match(r"op(\d+)_", q))))
    assert ops == list(range(1, 14)) and "pipeline" in e.queries()
    assert set(SQL) <= set(QUERIES) and [n for n, _ in corpus_pipeline.STAGES] and corpus_pipeline.ORACLE_SQL is None
