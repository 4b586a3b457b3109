"""Document fingerprints by winnowing (operator 6), Spark SQL functions only.

A text's units are hashed, every run of ``K`` units is hashed from those, and of
each ``W`` neighbouring k-grams the one with the least hash is kept, the
rightmost of equals, with its position. Two texts that share ``W + K - 1`` units
in a row share a fingerprint element.

Units are words (runs without white space), or with ``unit="mixed"`` words of at
most ``RUN`` code points and the single code points of longer runs and of
scripts written without spaces, so that such texts have windows too.

A kept element is one long: 31 hash bits above 31 bits that fall with the
position, so that the least long of a window is its least hash and, of equals,
the rightmost. The minima of all windows come from three shifted ``least``
passes, not from a slice per window.

Defined results: null text counts as empty; a text without units has an empty
fingerprint; one with fewer than ``K`` units has one element, the hash of all
its units; two empty fingerprints are alike (1.0), an empty and another are not
(0.0); repeated ids are ordered by their text; a null id comes before all
others; the only document follows itself; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.session import materialize

K = 4
W = 6
RUN = 32
_SPACE = r" \t\n\x0B\f\r"
_WIDE = "".join(rf"\p{{Is{x}}}" for x in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan")) + r"\u30FC"
_PLAIN = f"[^{_SPACE}{_WIDE}]"
#: A whole short run, else a single code point; linear in the text.
MIXED = f"(?<!{_PLAIN}){_PLAIN}{{1,{RUN}}}+(?!{_PLAIN})|[^{_SPACE}]"
_LOW = 0x7FFFFFFF
#: Documents of one block differ in the low bits of their id only, so a block's
#: window holds at most 2^11 ids; the levels above it take 2^17 blocks each.
LEVELS = (11, 17, 17)


def unit_hashes(text: Column, unit: str = "word") -> Column:
    if unit == "mixed":
        return F.transform(F.regexp_extract_all(text, F.lit(MIXED), F.lit(0)), lambda w: F.xxhash64(w))
    plain = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.transform(F.filter(F.split(plain, " "), lambda w: w != ""), lambda w: F.xxhash64(w))


def _shifted_least(a: Column, by: int) -> Column:
    """Least of a[i] and a[i+by]; the array keeps its length."""
    return F.zip_with(a, F.slice(a, by + 1, F.size(a)), lambda x, y: F.least(x, y))


def elements(docs: DataFrame, text: str, out: str, unit: str = "word") -> DataFrame:
    """Adds ``out``: array<long>, the kept elements in text order."""
    def pack(h: Column, i: Column) -> Column:
        return F.shiftleft(F.xxhash64(h).bitwiseAND(F.lit(_LOW)), 31).bitwiseOR(F.lit(_LOW).cast("long") - i)

    h, g = "__h", "__g"
    grams = F.transform(
        F.slice(F.col(h), 1, F.size(h) - (K - 1)),
        lambda x, i: F.shiftleft(
            F.xxhash64(x, *(F.get(F.col(h), i + j) for j in range(1, K))).bitwiseAND(F.lit(_LOW)), 31)
        .bitwiseOR(F.lit(_LOW).cast("long") - i))
    df = docs.withColumn(h, unit_hashes(F.coalesce(F.col(text), F.lit("")), unit))
    df = df.withColumn(g, F.when(F.size(h) >= K, grams)
                       .when(F.size(h) > 0, F.array(pack(F.col(h), F.lit(0))))
                       .otherwise(F.array().cast("array<long>")))
    four = _shifted_least(_shifted_least(F.col(g), 1), 2)
    df = df.withColumn(out, F.when(
        F.size(g) > W, F.array_distinct(F.slice(_shifted_least(four, W - 4), 1, F.size(g) - (W - 1))))
        .when(F.size(g) > 0, F.array(F.array_min(g)))
        .otherwise(F.col(g)))
    return df.drop(h, g)


def hashes(kept: Column) -> Column:
    """The distinct hashes of kept elements."""
    return F.array_distinct(F.transform(kept, lambda x: F.shiftright(x, 31).cast("int")))


def positions(kept: Column) -> Column:
    """(hash, unit position) of kept elements, for match guarantees."""
    return F.transform(kept, lambda x: F.struct(
        F.shiftright(x, 31).cast("int").alias("hash"),
        (F.lit(_LOW).cast("long") - x.bitwiseAND(F.lit(_LOW).cast("long"))).cast("int").alias("pos")))


def as_text(found: Column) -> Column:
    return F.concat_ws(",", F.transform(found, lambda x: F.hex(x)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two hash sets."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "word") -> DataFrame:
    """(id, fingerprint array<struct<hash, pos>>) of every text."""
    base = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    return elements(base, "__text", "__kept", unit).select(id_col, positions(F.col("__kept")).alias("fingerprint"))


def _block(of: Column, bits: int) -> Column:
    return F.coalesce(F.shiftright(of, bits), F.lit(-(1 << 62)))


def block_heads(ids: DataFrame) -> DataFrame:
    """(__head, __to): the least id of each block, and the block before it (the
    last one for the first), to which that document is also sent. Reads ids
    only; every window is bounded by LEVELS."""
    # a struct orders null ids first and tells an absent row from a null id
    one = ids.groupBy(_block(F.col("__id"), LEVELS[0]).alias("b0")).agg(F.min(F.struct(F.col("__id"))).alias("h0"))
    level = one.select(F.col("b0").alias("b"), F.struct("b0", "h0").alias("first"),
                       F.struct("b0", "h0").alias("last"))
    links = []
    for bits in (*LEVELS[1:], None):
        up = F.lit(0).cast("long") if bits is None else _block(F.col("b"), bits)
        w = Window.partitionBy("up").orderBy("b")
        level = materialize(level.withColumn("up", up), "op6-level")
        links.append(level.select(F.lag("last").over(w).alias("before"), F.col("first").alias("head"))
                     .where("before is not null"))
        level = (level.groupBy("up").agg(F.min_by("first", "b").alias("first"), F.max_by("last", "b").alias("last"))
                 .withColumnRenamed("up", "b"))
    links.append(level.select(F.col("last").alias("before"), F.col("first").alias("head")))  # round to the start
    out = links[0]
    for x in links[1:]:
        out = out.unionByName(x)
    return out.select(F.col("head.h0.__id").alias("__head"), F.col("before.b0").alias("__to"))


def with_next(docs: DataFrame, id_col: str, text_col: str, unit: str = "word") -> DataFrame:
    """(__id, __text, __fp, __next_text, __next_fp): each document beside the
    next one by id. One shuffle of the texts, into blocks of bounded size; the
    first document of a block also goes to the block before."""
    base = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    heads = materialize(block_heads(base.select("__id")), "op6-heads")
    own = _block(F.col("__id"), LEVELS[0])
    # a null id can head one block only; eqNullSafe keeps it
    sent = base.join(heads, F.col("__id").eqNullSafe(F.col("__head")), "left")
    sent = elements(sent, "__text", "__kept", unit).select(
        "__id", "__text", hashes(F.col("__kept")).alias("__fp"),
        F.explode(F.when(F.col("__to").isNull(), F.array(F.struct(own.alias("block"), F.lit(False).alias("extra"))))
                  .otherwise(F.array(F.struct(own.alias("block"), F.lit(False).alias("extra")),
                                     F.struct(F.col("__to").alias("block"), F.lit(True).alias("extra"))))).alias("__at"))
    w = Window.partitionBy("__at.block").orderBy("__at.extra", "__id", "__text")
    return sent.select("__id", "__text", "__fp", F.col("__at.extra").alias("__extra"),
                       F.lead("__text").over(w).alias("__next_text"),
                       F.lead("__fp").over(w).alias("__next_fp")).where("not __extra").drop("__extra")


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "word") -> DataFrame:
    """The fingerprint of each text, of its edited text (the last half replaced
    by the first code points of the next document), and their likeness."""
    n = F.length("__text")
    half = F.floor(n / 2).cast("int")
    df = with_next(docs, id_col, text_col, unit)
    df = df.withColumn("__edited", F.concat(F.substring("__text", F.lit(1), n - half),
                                            F.substring("__next_text", F.lit(1), half)))
    df = elements(df, "__edited", "__kept", unit).withColumn("__efp", hashes(F.col("__kept")))
    return df.select(
        F.col("__id").alias(id_col), n.cast("long").alias("n_chars"),
        F.sha2(F.col("__edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("__fp")).alias("fingerprint"), as_text(F.col("__efp")).alias("edited_fingerprint"),
        likeness(F.col("__fp"), F.col("__efp")).alias("near_edited"),
        likeness(F.col("__fp"), F.col("__next_fp")).alias("near_next"))
