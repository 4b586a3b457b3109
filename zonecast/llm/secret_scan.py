"""Secret scans by a randomness test battery (operator 7), Spark SQL functions only.

Fixed patterns find the base spans (assignments, access keys, hex runs). The
battery adds spans that no pattern names: every run of 16 or more key
characters gets an inferred encoding (hex, base 32, base 36, base 64) and, on
its symbol numbers,

* a chi-squared test of a uniform alphabet,
* a runs test (against a key: runs of the upper or lower half of the alphabet;
  against text: runs of one character class, digit, upper, lower or sign),
* a lag-1 serial correlation test.

Each gives a normal score against a random key and one against ordinary text
(how far the chi-squared value lies below what letters of a language give, how
much oftener the class changes, how much less neighbours agree). The scores
against a key are combined by their squares (chi-squared, 3 degrees of freedom),
those against text as one weighted normal score. A run counts as random when a
random key is not rejected at 0.001 and its combined p-value as text survives
the Benjamini-Hochberg rule at ``FALSE_SHARE`` among the runs of its length
band, over all documents. For that rule the p-values are counted in steps of a
20th of a power of ten, so the corpus gathers bands x 801 counts at most,
whatever its size.

A text's cost grows as n log n with its matches n: positions and overlaps come
from running sums and maxima of whole arrays in doubling steps (``running``).

Defined results: null or empty text has no spans; a run that overlaps a base
span is not added; base spans of different kinds may overlap; repeated rows are
scanned alike; an empty table gives an empty result; other columns are kept by
``redact`` and not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.session import materialize

# The base patterns and their least lengths.
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "random")

RUN = r"[A-Za-z0-9+/_-]{16,}={0,2}"
#: Lower lengths of the bands of the false-discovery rule.
BANDS = (16, 20, 24, 32, 40, 64, 128)
FALSE_SHARE = 0.001
VETO = 16.266  # 0.999 quantile of chi-squared with 3 degrees of freedom
STEPS, MOST = 20, 800
#: Share of equal pairs of symbols in running text, and of class changes inside its words.
TEXT_EQUAL, TEXT_CHANGE = 0.075, 0.08
#: Lag-1 correlation of symbol numbers in running text, and the tests' weights: it tells text from keys least.
TEXT_SERIAL, WEIGHTS = 0.1, (1.0, 1.0, 0.5)
UPPER, LOWER, DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = (
    ("^[0-9a-f]+$", DIGIT + "abcdef"),
    ("^[0-9A-F]+$", DIGIT + "ABCDEF"),
    ("^[A-Z2-7]+$", UPPER + "234567"),
    ("^[0-9a-z]+$", DIGIT + LOWER),
    ("^[0-9A-Z]+$", DIGIT + UPPER),
)
BASE64 = UPPER + LOWER + DIGIT + "+/"
#: Code points of a part of a text that is cut apart.
PART = 4096


def running(rows: Column, join) -> Column:
    """Prefix results of an array of structs: ``join(row, earlier)`` puts the
    earlier row's value (null: none) into the row. Every step doubles the reach,
    so an array is passed over log2 of its size times."""
    return F.aggregate(
        F.array(*(F.lit(1 << i) for i in range(31))), rows,
        lambda acc, d: F.when(d >= F.size(acc), acc).otherwise(F.transform(acc, lambda x, i: join(x, F.get(acc, i - d)))))


def _let(value: Column, f) -> Column:
    """f of a value that is computed once, however often f reads it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def matches(text: Column, pattern: str, group: int) -> Column:
    """array<struct<start, end, size>> of all matches, in code points; size is
    the length of the group. The lengths of matches and of the pieces between them
    add up to the positions."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.arrays_zip(F.transform(whole, F.length).alias("m"), F.transform(part, F.length).alias("g"),
                        F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(whole)), F.length).alias("p"))
    ends = running(F.transform(rows, lambda x: F.struct((x["p"] + x["m"]).alias("end"), x["m"].alias("m"), x["g"].alias("size"))),
                   lambda x, y: F.struct((x["end"] + F.coalesce(y["end"], F.lit(0))).alias("end"), x["m"].alias("m"), x["size"].alias("size")))
    return F.transform(ends, lambda x: F.struct((x["end"] - x["m"]).alias("start"), x["end"].alias("end"), x["size"].alias("size")))


def _none() -> Column:
    return F.expr("cast(array() as array<struct<start:int,end:int,size:int>>)")


def _found(text: Column, pattern: str, group: int, least: int, needs: str) -> Column:
    return F.when(text.rlike(needs), F.filter(matches(text, pattern, group), lambda x: x["size"] >= least)).otherwise(_none())


def _named(kind: int):
    return lambda x: F.struct(x["start"], x["end"], F.lit(kind).alias("kind"))


def _tail_steps(z: Column) -> Column:
    """-log10 of the upper normal tail of z in whole steps (a close closed form)."""
    p = (z * z / 2 + F.log((z + F.sqrt(z * z + 2.546479)) * 1.2533141)) / F.log(F.lit(10.0))
    return F.when(z <= 0, 0).otherwise(F.least(F.floor(p * STEPS), F.lit(MOST))).cast("int")


def _encoded(c: Column) -> Column:
    """A run's body and the alphabet of its inferred encoding."""
    body = F.translate(F.rtrim(F.translate(c["run"], "=", " ")), "-_", "+/")
    alphabet = F.lit(BASE64)
    for pattern, letters in reversed(ENCODINGS):
        alphabet = F.when(body.rlike(pattern), F.lit(letters)).otherwise(alphabet)
    return F.struct(c["start"].alias("start"), c["end"].alias("end"), alphabet.alias("alphabet"),
                    F.filter(F.split(body, ""), lambda x: x != "").alias("chars"))


# What a nested lambda reads is a field of the step before, not an expression:
# Spark would evaluate an expression anew for every symbol.

def _symbols(c: Column) -> Column:
    """Alphabet size, symbol numbers and character classes of a run."""
    return F.struct(
        c["start"].alias("start"), c["end"].alias("end"), F.length(c["alphabet"]).cast("double").alias("a"),
        F.transform(c["chars"], lambda x: F.instr(c["alphabet"], x) - 1).alias("s"),
        F.transform(c["chars"], lambda x: F.when(x.between("0", "9"), 1).when(x.between("A", "Z"), 2)
                    .when(x.between("a", "z"), 3).otherwise(4)).alias("k"))


def _centred(c: Column) -> Column:
    return F.struct(c["start"].alias("start"), c["end"].alias("end"), c["a"].alias("a"), c["s"].alias("s"), c["k"].alias("k"),
                    (_sum(c["s"], lambda x: x) / F.size(c["s"])).alias("mean"), (c["a"] / 2).alias("half"))


def _sum(a: Column, f) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda t, x: t + f(x).cast("double"))


def _pairs(a: Column, f) -> Column:
    """f of neighbours."""
    return F.zip_with(F.slice(a, 1, F.size(a) - 1), F.slice(a, 2, F.size(a) - 1), f)


def _sums(c: Column) -> Column:
    half, mean = c["half"], c["mean"]
    return F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["a"].alias("a"), F.size(c["s"]).cast("double").alias("n"),
        _sum(F.transform(F.array_distinct(c["s"]), lambda v: F.pow(F.size(F.filter(c["s"], lambda x: x == v)), F.lit(2.0))),
             lambda x: x).alias("squares"),
        _sum(_pairs(c["s"], lambda x, y: (x >= half) != (y >= half)), lambda x: x.cast("int")).alias("turns"),
        _sum(c["s"], lambda x: (x >= half).cast("int")).alias("high"),
        _sum(_pairs(c["s"], lambda x, y: (x - mean) * (y - mean)), lambda x: x).alias("lagged"),
        _sum(c["s"], lambda x: (x - mean) * (x - mean)).alias("spread"),
        _sum(_pairs(c["k"], lambda x, y: x != y), lambda x: x.cast("int")).alias("changes"))


def _verdict(c: Column) -> Column:
    """start, end, band, evidence against ordinary text in steps, and whether a
    random key is not rejected."""
    n, a = c["n"], c["a"]
    chi = a / n * c["squares"] - n
    uniform = (chi - (a - 1)) / F.sqrt(2 * (a - 1))
    low = n - c["high"]
    runs_mean = 1 + 2 * c["high"] * low / n
    runs_var = (runs_mean - 1) * (runs_mean - 2) / (n - 1)
    runs = F.when(runs_var > 0, (c["turns"] + 1 - runs_mean) / F.sqrt(runs_var)).otherwise(99.0)
    serial = F.when(c["spread"] > 0, (c["lagged"] / c["spread"] + 1 / n) * F.sqrt(n)).otherwise(99.0)
    equal = F.greatest(F.lit(TEXT_EQUAL) * a, F.lit(1.3))  # language letters within this alphabet
    text_mean = (a - 1) + (n - 1) * (equal - 1)
    text_sd = F.sqrt(2 * (a - 1) * equal + 4 * (n - 1) * (equal - 1))
    even = (text_mean - chi) / text_sd
    change = (c["changes"] - (n - 1) * TEXT_CHANGE) / F.sqrt((n - 1) * TEXT_CHANGE * (1 - TEXT_CHANGE))
    calm = (F.lit(TEXT_SERIAL) - F.when(c["spread"] > 0, c["lagged"] / c["spread"]).otherwise(1.0)) * F.sqrt(n)
    against_text = sum(w * z for w, z in zip(WEIGHTS, (even, change, calm), strict=True)) / math.sqrt(sum(w * w for w in WEIGHTS))
    against_key = F.pow(F.greatest(uniform, F.lit(0.0)), F.lit(2.0)) + runs * runs + serial * serial
    band = F.lit(len(BANDS))
    for i in range(len(BANDS) - 1, 0, -1):
        band = F.when(n < BANDS[i], F.lit(i)).otherwise(band)
    return F.struct(c["start"], c["end"], band.cast("int").alias("band"), _tail_steps(against_text).alias("steps"),
                    (against_key <= VETO).alias("even"))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds __base (array<struct<start, end, kind>>) and __runs, the tested runs."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = [
        _found(text, ASSIGN, 2, LEAST["assign"], r"(?i:password|passwd|secret|token|api_?key)"),
        _found(text, ACCESS, 0, LEAST["access"], "AKIA"),
        _found(text, HEX, 0, LEAST["hex"], "[0-9a-f]{%d}" % LEAST["hex"]),
    ]
    kinds = [F.transform(a, _named(i)) for i, a in enumerate(base)]
    whole = F.regexp_extract_all(text, F.lit(RUN), F.lit(0))
    run = F.when(text.rlike(RUN), F.transform(
        F.arrays_zip(matches(text, RUN, 0).alias("at"), whole.alias("run")),
        lambda x: F.struct(x["at"]["start"].alias("start"), x["at"]["end"].alias("end"), x["run"].alias("run"))))
    empty = F.expr("cast(array() as array<struct<start:int,end:int,band:int,steps:int,even:boolean>>)")
    return (docs.withColumn("__base", F.concat(*kinds))
            .withColumn("__runs", run)
            .withColumn("__runs", F.transform("__runs", _encoded))
            .withColumn("__runs", F.transform("__runs", _symbols))
            .withColumn("__runs", F.transform("__runs", _centred))
            .withColumn("__runs", F.transform("__runs", _sums))
            .withColumn("__runs", F.coalesce(F.transform("__runs", _verdict), empty)))


def thresholds(scanned: DataFrame, share: float = FALSE_SHARE) -> dict[int, int]:
    """Benjamini-Hochberg: the least evidence step of each length band at which
    expected false discoveries are at most ``share`` of the discoveries. The
    driver gets one row for each band and step at most."""
    counts = (scanned.select(F.explode("__runs").alias("r"))
              .groupBy(F.col("r.band").alias("band"), F.col("r.steps").alias("steps")).count().collect())
    out = {}
    for band in {r["band"] for r in counts}:
        own = sorted(((r["steps"], r["count"]) for r in counts if r["band"] == band), reverse=True)
        total, above = sum(n for _, n in own), 0
        for steps, n in own:
            above += n
            if 10 ** (-steps / STEPS) <= share * above / total:
                out[band] = steps
    return out


def spans(least: dict[int, int]) -> Column:
    """All spans (array<struct<start, end, kind>>) of a scanned row: the base
    ones and the accepted runs beside them, by start, then kind."""
    def enough(r: Column) -> Column:
        limit = F.lit(MOST + 1)
        for band, steps in least.items():
            limit = F.when(r["band"] == band, F.lit(steps)).otherwise(limit)
        return r["steps"] >= limit

    # by start (base) or end (run): the ends of all base spans that start before a run's end lie before it
    event = lambda key, base, x, kind, top: F.struct(
        key.alias("key"), base.alias("base"), x["start"].alias("start"), x["end"].alias("end"), kind.alias("kind"), top.alias("top"))
    events = F.array_sort(F.concat(
        F.transform("__base", lambda b: event(b["start"], F.lit(1), b, b["kind"], b["end"])),
        F.transform(F.filter("__runs", lambda r: r["even"] & enough(r)),
                    lambda r: event(r["end"], F.lit(0), r, F.lit(KINDS.index("random")), F.lit(0)))))
    seen = running(events, lambda x, y: event(x["key"], x["base"], x, x["kind"], F.greatest(x["top"], y["top"])))
    return in_order(F.filter(seen, lambda x: (x["base"] == 1) | (x["top"] <= x["start"])))


def in_order(found: Column) -> Column:
    """By start, then kind."""
    by = F.array_sort(F.transform(found, lambda x: F.struct(x["start"], x["kind"], x["end"])))
    return F.transform(by, lambda x: F.struct(x["start"], x["end"], x["kind"]))


def as_text(found: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(found, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): arrays of struct<start, end, kind>. One pass over the
    texts, written without them; the accepted runs follow from the counts."""
    seen = materialize(scan(docs.select(id_col, text_col), text_col).select(id_col, "__base", "__runs"), "op7-scan")
    return seen.select(id_col, in_order(F.col("__base")).alias("base"), spans(thresholds(seen)).alias("spans"))


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(k))).cast("long")
    return found.select(id_col, count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        as_text(F.col("spans")).alias("spans"))


def _cut(parts: Column, lo: Column, hi: Column) -> Column:
    """Code points lo to hi (exclusive) of a text in parts of ``PART``."""
    def piece(k: Column) -> Column:
        first = F.greatest(lo - k * PART, F.lit(0))
        return F.substring(F.get(parts, k), first + 1, F.least(hi - k * PART, F.lit(PART)) - first)

    at = F.sequence(F.floor(lo / PART).cast("int"), F.floor((hi - 1) / PART).cast("int"))
    return F.when(hi > lo, F.array_join(F.transform(at, piece), "")).otherwise("")


def splice(text: Column, found: Column, mark: str) -> Column:
    """The text with every span (by start) replaced, overlapping spans by one mark."""
    tops = running(F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("top"))),
                   lambda x, y: F.struct(x["start"].alias("start"), F.greatest(x["top"], y["top"]).alias("top")))

    def done(c: Column) -> Column:
        def piece(x: Column, i: Column) -> Column:
            before = F.coalesce(F.get(c["tops"], i - 1)["top"], F.lit(0))
            return F.when(x["start"] >= before, F.concat(_cut(c["parts"], before, x["start"]), F.lit(mark))).otherwise("")

        return F.concat(F.array_join(F.transform(c["tops"], piece), ""),
                        _cut(c["parts"], F.element_at(c["tops"], -1)["top"], c["n"]))

    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))
    return _let(F.struct(parts.alias("parts"), tops.alias("tops"), F.length(text).alias("n")), done)


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by ``mark`` (overlapping spans
    by one). The texts are scanned once and written with what was found; nothing
    is shuffled."""
    rows = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text_col).alias("__text"))
    seen = materialize(scan(rows, "__text").select("__row", "__base", "__runs"), "op7-redact")
    text = F.col("__row")[text_col]
    df = seen.select("__row", spans(thresholds(seen)).alias("__spans"))
    clean = F.when(F.size("__spans") > 0, splice(text, F.col("__spans"), mark)).otherwise(text)
    return df.select("__row", clean.alias("__clean")).select(
        *(F.col("__clean").alias(c) if c == text_col else F.col("__row")[c].alias(c) for c in docs.columns))
