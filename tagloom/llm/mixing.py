"""Mixing sources to target weights by entropy balancing (native).

Every document gets a rate r >= 0, its expected number of copies.  Among all
rates that give each source its target words, those nearest to one copy each
(smallest relative entropy, at most ``MAX_COPIES``) are
``min(MAX_COPIES, exp(l * size))`` with one multiplier ``l`` per source, the
solution of the convex dual.  Newton steps find all multipliers together; each
step is one distributed aggregate over (source, size, count) rows, kept inside
a shrinking bracket so that it cannot diverge.  The terms are summed as
decimals, so that the order of addition never changes a result.

Rates become copies by a threshold: a document gets floor(r) copies and one
more if u - (r - floor(r)) < c, with u drawn from a hash of the row and, among
equal rows, of its turn.  For each
source, c is fitted so that the words taken come nearest to the target: a
histogram of ``BINS`` bins of words, then one of the bin that the target falls
into, and so on, ``ROUNDS`` times.  So a source misses its target by about one
document, nothing is sorted, and no source is gathered in one task.

Targets: the sources in code point order, null last, weigh 3, 1, 2 in turn and
share ``BUDGET`` times all words; a target stops at ``MAX_COPIES`` times the
words of its source, and what is above is shared anew.

Defined results: a null or blank text has size 0 and takes 0 words (its rate
is 1: one copy); of rows that repeat as many get one more copy as the target
asks for, so no source is missed by a group of copies; a source without words
has target 0; an empty table gives an empty result; further columns pass
through.  Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .words import n_words

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_COPIES = 2
TOLERANCE = 1e-4
MAX_STEPS = 60
BINS = 1024
ROUNDS = 3
BOUND = 1e9
SALTS = 64
MAX_BROADCAST_SOURCES = 100_000


def targets(sources: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """(source, source_size, longest) -> the same and target.  One row per
    source, so the windows over all sources see as many rows as sources.

    The shares are min(cap, t * weight); sources whose cap per weight is
    smallest stop first, so t follows from running sums in that order."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.withColumn("weight", w.cast("double")).withColumn("cap", F.col("source_size") * float(MAX_COPIES))
    everything = Window.partitionBy()
    up_to = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = up_to.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything) * budget
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumn("t", left / weight_left)
    s = s.withColumn("stops", F.col("cap") <= F.col("t") * F.col("weight"))
    level = F.min(F.when(~F.col("stops"), F.struct(F.col("cap") / F.col("weight"), F.col("t").alias("t")))).over(everything)["t"]
    return (s.withColumn("target", F.when(F.col("stops"), F.col("cap")).otherwise(level * F.col("weight")))
            .select("source", "source_size", "longest", "target"))


def rate(multiplier: Column, size: Column, longest: Column) -> Column:
    """min(MAX_COPIES, exp(multiplier * size / longest))."""
    tilt = multiplier * size / F.greatest(longest, F.lit(1))
    return F.exp(F.least(tilt, F.log(F.lit(float(MAX_COPIES)))))


def _exact(c: Column) -> Column:
    return F.sum(c.cast("decimal(38,9)")).cast("double")


def multipliers(histogram: DataFrame, goals: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(source, source_size, longest, target, m): Newton on the dual of every
    source at once.  ``histogram``: source, size, n with size > 0."""
    done = F.abs(F.col("words") - F.col("target")) <= F.col("target") * tolerance
    full = F.col("target") >= F.col("source_size") * float(MAX_COPIES)
    state = goals.select("*", F.when(full, BOUND).otherwise(0.0).alias("m"), F.lit(-BOUND).alias("lo"),
                         F.lit(BOUND).alias("hi"), full.alias("done"))
    state = materialize(state, "multipliers")
    cells = histogram.select(F.col("source").alias("s"), "size", "n")
    for _ in range(MAX_STEPS):
        if state.where(~F.col("done")).isEmpty():
            break
        r = rate(F.col("m"), F.col("size"), F.col("longest"))
        slope = F.when(r < MAX_COPIES, F.col("n") * F.col("size") * r * F.col("size") / F.col("longest")).otherwise(0.0)
        at = (cells.join(state.where(~F.col("done")), F.col("s").eqNullSafe(F.col("source")))
              .groupBy("s").agg(_exact(F.col("n") * F.col("size") * r).alias("words"), _exact(slope).alias("slope")))
        new = state.join(at, F.col("s").eqNullSafe(F.col("source")), "left")
        low = F.col("words") < F.col("target")
        lo = F.when(low, F.col("m")).otherwise(F.col("lo"))
        hi = F.when(low, F.col("hi")).otherwise(F.col("m"))
        step = F.col("m") + (F.col("target") - F.col("words")) / F.nullif(F.col("slope"), F.lit(0.0))
        middle = F.when(lo == -BOUND, F.least(F.col("m") * 2, F.lit(-1.0))).when(
            hi == BOUND, F.greatest(F.col("m") * 2, F.lit(1.0))).otherwise((lo + hi) / 2)
        inside = F.coalesce((step > lo) & (step < hi), F.lit(False))
        moved = (~F.col("done") & ~F.coalesce(done, F.lit(True)))
        state = materialize(new.select(
            "source", "source_size", "longest", "target",
            F.when(moved, F.when(inside, step).otherwise(middle)).otherwise(F.col("m")).alias("m"),
            F.when(moved, lo).otherwise(F.col("lo")).alias("lo"), F.when(moved, hi).otherwise(F.col("hi")).alias("hi"),
            (F.col("done") | F.coalesce(done, F.lit(True))).alias("done")), "multipliers")
    return state.select("source", "source_size", "longest", "target", "m")


def draw(key: Column, turn: Column) -> Column:
    """Uniform in [0, 1) from a hash of the row and its turn among equal rows."""
    return F.pmod(F.xxhash64(F.lit(20), key, turn), F.lit(1 << 40)) / float(1 << 40)


def _key(doc_id: Column, source: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, source, text)


def with_turn(rows: DataFrame) -> DataFrame:
    """``rows`` with ``turn``: 0, 1, 2 ... among the rows of one ``key``, which are
    equal, so it does not matter which gets which.

    Keys that stand once, mostly all, are only counted.  The rows of the others
    are numbered in ``SALTS`` parts each, which are then put one behind another."""
    often = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("key").alias("k")),
                        "repeated-rows")
    zero = F.lit(0).cast("bigint")
    if often.isEmpty():
        return rows.withColumn("turn", zero)
    same = F.col("key") == F.col("k")
    again = rows.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).join(often, same, "left_semi")
    again = materialize(again, "repeated-rows")  # the parts are to be the same in both uses
    before = Window.partitionBy("k").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = (again.groupBy(F.col("key").alias("k"), F.col("part").alias("p")).agg(F.count(F.lit(1)).alias("n"))
             .select("k", "p", F.coalesce(F.sum("n").over(before), zero).alias("first")))
    own = F.row_number().over(Window.partitionBy("key", "part").orderBy("part")) - 1
    turned = (again.withColumn("own", own).join(parts, same & (F.col("part") == F.col("p")))
              .withColumn("turn", (F.col("first") + F.col("own")).cast("bigint")))
    return rows.join(often, same, "left_anti").withColumn("turn", zero).unionByName(turned.select(*rows.columns, "turn"))


def thresholds(cells: DataFrame, solved: DataFrame) -> DataFrame:
    """``solved`` and c, the rounding threshold of each source.  ``cells``:
    source, size, whole (copies for sure) and v = u - fraction in [-1, 1), null
    where no further copy is allowed."""
    taken = cells.groupBy(F.col("source").alias("s")).agg(F.sum(F.col("whole") * F.col("size")).alias("whole"))
    state = solved.join(taken, F.col("s").eqNullSafe(F.col("source")), "left").select(
        *solved.columns, (F.col("target") - F.coalesce("whole", F.lit(0))).alias("need"),
        F.lit(-1.0).alias("lo"), F.lit(2.0).alias("width"))
    for _ in range(ROUNDS):
        state = materialize(state, "thresholds")
        narrow = F.col("width") / BINS
        bins = (cells.select(F.col("source").alias("s"), "size", "v")
                .join(_by_source(state.select("source", "lo", "width")), F.col("s").eqNullSafe(F.col("source")))
                .where((F.col("v") >= F.col("lo")) & (F.col("v") < F.col("lo") + F.col("width")))
                .groupBy("s", F.floor((F.col("v") - F.col("lo")) / narrow).alias("bin")).agg(F.sum("size").alias("words")))
        run = F.sum("words").over(Window.partitionBy("s").orderBy("bin"))
        fits = F.col("run") <= F.col("need")
        known = (bins.withColumn("run", run)
                 .join(state.select("source", "need"), F.col("s").eqNullSafe(F.col("source")))
                 .groupBy("s").agg(F.max(F.when(fits, F.col("run"))).alias("run"),
                                   F.min_by(F.struct("bin", "words"), F.when(~fits, F.col("bin"))).alias("over")))
        state = state.join(known, F.col("s").eqNullSafe(F.col("source")), "left").select(
            *solved.columns, (F.col("need") - F.coalesce("run", F.lit(0))).alias("need"),
            (F.col("lo") + F.coalesce("over.bin", F.lit(BINS)) * narrow).alias("lo"), narrow.alias("width"),
            F.col("over.words").alias("next"))
    # The next document is taken too if that comes nearer to the target.
    nearer = F.coalesce(F.col("next") < 2 * F.col("need"), F.lit(False))
    return state.select(*solved.columns, (F.col("lo") + F.when(nearer, F.col("width")).otherwise(0.0)).alias("c"))


def _by_source(table: DataFrame, max_broadcast: int = MAX_BROADCAST_SOURCES) -> DataFrame:
    """A table of one row per source: broadcast if it is counted to be short."""
    return F.broadcast(table) if table.count() <= max_broadcast else table


def solved(docs: DataFrame) -> DataFrame:
    """source, source_size, longest, target, m, c of every source of ``docs``."""
    sized = docs.select(_key(F.col("doc_id"), F.col("source"), F.col("text")).alias("key"), "source", n_words(F.col("text")).alias("size"))
    sized = with_turn(materialize(sized, "document-sizes"))
    histogram = materialize(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "size-histogram")
    sources = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"),
                                              F.max("size").alias("longest"))
    rates = materialize(multipliers(histogram.where("size > 0"), targets(sources)), "rates")
    cells = (sized.where("size > 0").withColumnRenamed("source", "s")
             .join(_by_source(rates), F.col("s").eqNullSafe(F.col("source")))
             .select("source", "size", "key", "turn", rate(F.col("m"), F.col("size"), F.col("longest")).alias("r"))
             .select("source", "size", *_split(F.col("r"))))
    return thresholds(cells, rates)


def _split(r: Column) -> list[Column]:
    """Copies for sure, and v where one more is possible."""
    whole = F.floor(r)
    return [whole.alias("whole"), F.when(whole < MAX_COPIES, draw(F.col("key"), F.col("turn")) - (r - whole)).alias("v")]


def _decided(docs: DataFrame) -> DataFrame:
    """``doc`` (the row as it came), size, the columns of ``solved``, copies."""
    table = materialize(solved(docs), "mixing-rates")
    rows = docs.select(F.struct("*").alias("doc")).select(
        "doc", _key(F.col("doc.doc_id"), F.col("doc.source"), F.col("doc.text")).alias("key"), n_words(F.col("doc.text")).alias("size"))
    rows = with_turn(rows)
    joined = rows.join(_by_source(table), F.col("doc.source").eqNullSafe(F.col("source")), "left")
    r = rate(F.col("m"), F.col("size"), F.col("longest"))
    return (joined.select("doc", "size", "source_size", "target", "c", *_split(r))
            .withColumn("copies", F.col("whole") + F.coalesce((F.col("v") < F.col("c")) & (F.col("size") > 0),
                                                              F.lit(False)).cast("int")))


def plan(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every document."""
    return _decided(docs).select(F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target",
                                 (F.col("copies") * F.col("size")).cast("bigint").alias("taken"),
                                 F.col("copies").cast("bigint").alias("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix: each row as often as its copies."""
    copies = F.explode_outer(F.array_repeat("doc", F.col("copies").cast("int"))).alias("copy")
    return _decided(docs).select(copies).where("copy is not null").select("copy.*")
