"""Mixing sources to target weights (operator 9), DataFrame functions only.

Temperature mixing: a source's weight is its token share raised to an exponent
between 0 (all alike) and 1 (as they come). The exponent is bisected to meet a
target entropy or, as here by default, a repetition limit: the least exponent
at which no source is repeated more than ``repeat`` times, when the budget is
just large enough that every source is taken whole at least once. Each round
sums 31 exponents at once over the source table, five halvings in one pass;
the driver gets those sums only.

A budget of tokens, if given, replaces "just large enough": the epochs of a source
are its weight's part of the budget over its tokens, so a budget below the corpus
leaves documents out and one above it repeats them, no source more than ``repeat``
times (a budget above ``repeat`` times the corpus counts as just that).

The weights are realised as budgeted block permutations, one for each epoch: a
document's place in an epoch is a digest of seed, epoch and id, its first hex
digits are its block. Of the last, partial epoch, blocks are taken in that order
until the fractional part of the epochs is spent: the running token count goes
over block sums first and then inside each block, so no window holds a source; a
hot source is dealt over its 4096 blocks. ``apply`` returns the rows in the order
of the mix: every source runs through its epochs at an even pace, so that each
stretch of the order has the target weights.

Defined results: a null source is a source of its own; null text has no tokens,
and a document without tokens is taken once for every whole epoch of its source;
sources without tokens are taken once, whatever the budget; repeated rows share one place and are
taken alike (a row counts its own tokens); one source alone is taken once; an
empty table gives an empty result; other columns are kept by ``apply``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.session import materialize

SEED = "mix"
REPEAT = 2.0
BLOCK_DIGITS = 3
HALVINGS, ROUNDS = 5, 9


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def place(epoch: Column, of: Column) -> Column:
    """Where a document stands in an epoch's permutation (hex digits)."""
    return F.md5(F.concat(F.lit(f"{SEED}:"), epoch.cast("string"), F.lit(":"), F.coalesce(of.cast("string"), F.lit("null"))).cast("binary"))


def sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(source key, id, tokens): one row for each source and id."""
    tokens = F.coalesce(F.regexp_count(text_col, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return (docs.select(_key(F.col(source_col)).alias("__source"), F.col(id_col).alias("__id"), tokens.alias("t"))
            .groupBy("__source", "__id").agg(F.sum("t").alias("__tokens")))


def _exponent(totals: DataFrame, good) -> float:
    """Bisects (0, 1) for the least exponent that ``good`` accepts; ``good``
    takes (ln of the weights' sum, mean ln share, ln of the largest and least
    share, exponent) and is false below some exponent and true from it on."""
    share = F.col("t") / F.col("every")
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (high - low) / 2 ** HALVINGS
        tried = [low + i * step for i in range(2 ** HALVINGS)]
        sums = [F.sum(F.pow(share, F.lit(e))).alias(f"z{i}") for i, e in enumerate(tried)]
        logs = [F.sum(F.pow(share, F.lit(e)) * F.log(share)).alias(f"l{i}") for i, e in enumerate(tried)]
        r = totals.agg(*sums, *logs, F.max(F.log(share)).alias("most"), F.min(F.log(share)).alias("least")).first()
        if r["most"] is None:
            return 1.0
        for i, e in enumerate(tried):
            if good(math.log(r[f"z{i}"]), r[f"l{i}"] / r[f"z{i}"], r["most"], r["least"], e):
                high = e
                low = max(low, e - step)
                break
        else:
            low = tried[-1]
        if high == low:
            break
    return high


def epochs(rows: DataFrame, repeat: float = REPEAT, entropy: float | None = None, budget: float | None = None) -> DataFrame:
    """(source key, tokens, weight, epochs) of each source. ``entropy``, if
    given, is the share of the largest possible entropy that the weights are to
    reach; the repetition limit holds in any case. ``budget``: tokens to take."""
    total = rows.groupBy("__source").agg(F.sum("__tokens").alias("t"))
    total = materialize(total, "op9-sources")
    some = total.where("t > 0")
    every, count = some.agg(F.sum("t"), F.count("t")).first()
    some = some.withColumn("every", F.lit(float(every or 1)))
    if budget is not None:
        budget = min(max(float(budget), 0.0), repeat * float(every or 0))

    def limited(lnz, mean, most, least, e):
        if budget is None:  # repeats of the least source when the largest is taken once
            return (1 - e) * (most - least) <= math.log(repeat) + 1e-12
        if not budget:
            return True
        return math.log(budget / every) + (e - 1) * least - lnz <= math.log(repeat) + 1e-12

    found = _exponent(some, limited)
    if entropy is not None and count and count > 1:
        # entropy falls with the exponent: the largest that reaches it, if the limit allows
        found = max(found, _exponent(some, lambda lnz, mean, most, least, e: lnz - e * mean < entropy * math.log(count)))
    share = F.col("t") / F.lit(float(every or 1))
    raw = total.withColumn("weight", F.when(F.col("t") > 0, F.pow(share, F.lit(found))).otherwise(0.0))
    norm, ratio = raw.agg(F.sum("weight"), F.min(F.when(F.col("t") > 0, F.col("weight") / F.col("t")))).first()
    times = F.col("weight") / F.col("t") / F.lit(ratio or 1.0)
    if budget is not None:
        times = F.col("weight") / F.lit(norm or 1.0) * F.lit(budget) / F.col("t")
    return raw.select("__source", "t", (F.col("weight") / F.lit(norm or 1.0)).alias("weight"),
                      F.when(F.col("t") > 0, F.round(times, 6)).otherwise(1.0).alias("epochs"))


def taken(rows: DataFrame, repeat: float = REPEAT, entropy: float | None = None, budget: float | None = None) -> DataFrame:
    """The rows of ``sizes`` (and what else they carry) with weight, epochs,
    __place (in the last, partial epoch) and copies."""
    own = rows.columns
    mixed = rows.join(materialize(epochs(rows, repeat, entropy, budget), "op9-epochs"), "__source")
    mixed = mixed.withColumn("__place", place(F.floor("epochs"), F.col("__id"))).withColumn("__block", F.substring("__place", 1, BLOCK_DIGITS))
    of_block = mixed.groupBy("__source", "__block").agg(F.sum("__tokens").alias("bt"))
    w = Window.partitionBy("__source").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = of_block.select("__source", "__block", F.coalesce(F.sum("bt").over(w), F.lit(0)).alias("before"))
    # every block's rows meet in one window of a 4096th of a source; that is the permutation's unit
    inside = Window.partitionBy("__source", "__block").orderBy("__place", "__id").rowsBetween(Window.unboundedPreceding, 0)
    placed = mixed.withColumn("upto", F.sum("__tokens").over(inside)).join(before, ["__source", "__block"])
    rest = (F.col("epochs") - F.floor("epochs")) * F.col("t")
    more = (F.col("before") + F.col("upto") <= rest) & (F.col("__tokens") > 0)
    return placed.select(*own, "weight", "epochs", "__place", (F.floor("epochs") + more.cast("int")).cast("long").alias("copies"))


def plan(docs: DataFrame, repeat: float = REPEAT, entropy: float | None = None, id_col: str = "doc_id",
         source_col: str = "source", text_col: str = "text", budget: float | None = None) -> DataFrame:
    """(__source, __id, __tokens, weight, epochs, __place, copies): how often
    each document is taken."""
    return taken(materialize(sizes(docs, id_col, source_col, text_col), "op9-sizes"), repeat, entropy, budget)


def apply(docs: DataFrame, repeat: float = REPEAT, entropy: float | None = None, id_col: str = "doc_id",
          source_col: str = "source", text_col: str = "text", budget: float | None = None) -> DataFrame:
    """The documents, each as often as the mix takes it, in the order of the mix."""
    picks = plan(docs, repeat, entropy, id_col, source_col, text_col, budget).select(
        "__source", "__id", F.col("epochs").alias("__epochs"), F.col("copies").alias("__copies"))
    rows = docs.select(F.struct(*docs.columns).alias("__row"), _key(F.col(source_col)).alias("__key"), F.col(id_col).alias("__doc"))
    both = rows.join(picks, (F.col("__key") == F.col("__source")) & F.col("__doc").eqNullSafe(F.col("__id")))
    each = both.where("__copies >= 1").withColumn("__epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)))
    within = F.conv(F.substring(place(F.col("__epoch"), F.col("__id")), 1, 13), 16, 10).cast("double") / float(16 ** 13)
    return (each.withColumn("__at", (F.col("__epoch") + within) / F.col("__epochs"))
            .orderBy("__at", "__id").select("__row.*"))
