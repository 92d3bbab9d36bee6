"""Mixing sources to target weights by entropy balancing (operator 4), in DataFrame operations only.

Each source has a token target. Among all document rates r in [0, 2] whose tokens meet it, entropy balancing takes the
one closest to 1 in the sense of the sum of r ln r - r + 1. Its dual has one variable L for each source, and its solution
is an exponential tilt: r = min(2, exp(L * size / mean size)). Safeguarded Newton steps solve all duals at once; each step
is an aggregation over (source, size) counts, which stand for all documents exactly, as a rate depends on nothing else.

Rates become whole copies by systematic rounding in order of size, so that what one size loses the next gains. Of 16
offsets each source takes the one that meets its target best, and two single copies are moved to close what is left. A
window sees one row for each size of a source; what a size gets is dealt to its cells, of about CELL documents each, by a
second window over the cells of one size. Which documents of a cell get the further copy is decided by a hash of doc_id and
text: those up to a cut, of which there is one a cell. The mix itself applies the cuts to the documents where they lie, so
texts are not shuffled as long as there are at most BROADCAST_CELLS cells; beyond that they are joined by shuffling.

Targets need an order of the sources, for their weights, and the level at which the excess of full sources is spread. The
order comes from ranges of names that are numbered one by one, the level from rounds of one sum each, so no task and no
driver sees all sources. A solution that does not converge is an error, not a result.

Defined results: null text has size 0 and takes nothing; null source is a source of its own, the last; repeated rows are
documents of their own, and of those with equal doc_id and text as many as the cut leaves get a further copy; an empty
table gives an empty result; extra columns take no part, those named like an output are replaced; very long texts count by
their words like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialise, release

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
CELL = 10_000
OFFSETS = 16
STEPS, JOBS = 4, 50
BROADCAST_CELLS = 500_000
TOLERANCE = 1e-9


def token_size(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_key(source: str = "source") -> Column:
    """A key that is never null; '' stands for the null source."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def _numbered(names: DataFrame, parts: int = 64) -> DataFrame:
    """(s, place): the place of each name in code point order, the null source last. Ranges are numbered each for itself."""
    order = [F.col("s") == "", F.col("s")]
    ranged, _ = materialise(names.select("s").repartitionByRange(parts, *order).select("s", F.spark_partition_id().alias("part")), "mix-names")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.alias("a").join(F.broadcast(sizes.alias("b")), F.col("b.part") < F.col("a.part"), "left").groupBy("a.part").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    return ranged.withColumn("i", F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1).join(F.broadcast(before), "part").select("s", (F.col("before") + F.col("i")).alias("place"))


def targets(hist: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(s, source_size, n_docs, least, target) of each source from (s, size, n).

    target = min(cap * source_size, level * weight). The level spends share * total: it starts as if no source were full,
    and what the full ones leave is spread over the others until none is above its limit; each round is one sum.
    """
    totals = hist.groupBy("s").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("n_docs"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(kinds, (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    ranked, _ = materialise(totals.join(_numbered(totals), "s").withColumn("w", weight).withColumn("limit", F.col("source_size") * cap).drop("place"), "mix-sources")
    budget, level, full = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share, None, -1
    while True:
        capped = F.lit(False) if level is None else F.col("limit") <= F.lit(level) * F.col("w")
        spent, open_w, n = ranked.agg(F.sum(F.when(capped, F.col("limit")).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("w"))), F.count_if(capped)).first()
        if not open_w or n == full:
            break
        level, full = (budget - spent) / open_w, n
    target = F.col("limit") if level is None or not open_w else F.least(F.col("limit"), F.lit(level) * F.col("w"))
    return ranked.select("s", "source_size", "n_docs", "least", target.alias("target"))


def _rate(lam: Column, x: Column, cap: float) -> Column:
    return F.when(lam * x >= F.log(F.lit(cap)), F.lit(cap)).otherwise(F.exp(lam * x))


def _start(sources: DataFrame, cap: float) -> DataFrame:
    """The state of each source's dual: lam between lo and hi, and how far its tokens are from the target."""
    ratio = F.col("target") / F.col("source_size")
    x_min = F.col("least") * F.col("n_docs") / F.col("source_size")
    state = sources.where((F.col("source_size") > 0) & (F.col("target") > 0) & (F.col("target") < cap * F.col("source_size")))
    state = state.withColumn("lo", F.when(ratio < 1, F.log(ratio) / x_min).otherwise(F.lit(0.0))).withColumn("hi", F.when(ratio > 1, F.log(F.lit(cap)) / x_min).otherwise(F.lit(0.0)))
    return state.select("s", "source_size", "n_docs", "target", "lo", "hi", F.log(ratio).alias("lam"), F.lit(1.0).alias("off"))


def _step(state: DataFrame, hist: DataFrame, cap: float) -> DataFrame:
    """One Newton step of every source, kept inside a bracket that each evaluation narrows."""
    x = F.col("size") * F.col("n_docs") / F.col("source_size")
    mass = (F.col("size") * F.col("n")).cast("double")
    rate = _rate(F.col("lam"), x, cap)
    keys = ["s", "source_size", "n_docs", "target", "lo", "hi", "lam"]
    sums = hist.join(state, "s").groupBy(*keys).agg(F.sum(mass * rate).alias("f"), F.sum(F.when(rate < cap, mass * x * rate).otherwise(0.0)).alias("g"))
    high = F.col("f") > F.col("target")
    sums = sums.withColumn("hi", F.when(high, F.col("lam")).otherwise(F.col("hi"))).withColumn("lo", F.when(high, F.col("lo")).otherwise(F.col("lam")))
    newton = F.when(F.col("g") > 0, F.col("lam") - (F.col("f") - F.col("target")) / F.col("g"))
    # a bracket that cannot be halved any more is as good as double precision gets
    closed = F.col("hi") - F.col("lo") <= 1e-14 * (F.abs("lo") + F.abs("hi"))
    off = F.when(closed, 0.0).otherwise(F.abs(F.col("f") / F.col("target") - 1))
    inside = (newton > F.col("lo")) & (newton < F.col("hi"))
    moved = F.when(off <= TOLERANCE, F.col("lam")).when(inside, newton).otherwise((F.col("lo") + F.col("hi")) / 2)
    return sums.select("s", "source_size", "n_docs", "target", "lo", "hi", moved.alias("lam"), off.alias("off"))


def solve(hist: DataFrame, sources: DataFrame, cap: float = CAP) -> DataFrame:
    """(s, source_size, n_docs, target, lam) for all sources; lam is null where the target is 0 or the cap."""
    spark = hist.sparkSession
    state, path = materialise(_start(sources, cap), "mix-state")
    for _ in range(JOBS):
        new = state
        for _ in range(STEPS):
            new = _step(new, hist, cap)
        old = path
        state, path = materialise(new, "mix-state")
        release(spark, old)
        worst = state.agg(F.max("off")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    else:
        raise ArithmeticError(f"the rates of a source are off its target by {worst:.3g} after {STEPS * JOBS} steps")
    return sources.join(state.select("s", F.round("lam", 9).alias("lam")), "s", "left")


def rated(hist: DataFrame, solved: DataFrame, cap: float = CAP) -> DataFrame:
    """(s, size, n, rate, base, target): every document of a source and size gets base copies, some of them one more."""
    x = F.col("size") * F.col("n_docs") / F.col("source_size")
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("lam").isNotNull(), _rate(F.col("lam"), x, cap)).when(F.col("target") > 0, F.lit(cap)).otherwise(0.0)
    return hist.join(solved, "s").withColumn("rate", rate).withColumn("base", F.floor("rate")).select("s", "size", "n", "rate", "base", "target")


def _choose(sizes: DataFrame) -> DataFrame:
    """Adds `extra`, how many documents get one copy more, to rows (s, size, n, base, rate, target)."""
    order = Window.partitionBy("s").orderBy("size")
    expect = F.col("n") * (F.col("rate") - F.col("base"))
    sizes = sizes.withColumn("e", expect).withColumn("total", F.sum("e").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    extra = lambda u: F.least(F.col("n"), F.greatest(F.lit(0), F.floor(F.col("total") + u) - F.floor(F.col("total") - F.col("e") + u)))
    offsets = [(j + 0.5) / OFFSETS for j in range(OFFSETS)]
    taken = [F.sum(F.col("size") * (F.col("n") * F.col("base") + extra(F.lit(u)))) for u in offsets]
    # windows of one partitioning and not joins with sums: one shuffle, where each join doubled the plan and its broadcasts
    source = Window.partitionBy("s")
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{j}") - F.col("target")).alias("off"), F.lit(u).alias("u"), (F.col("target") - F.col(f"t{j}")).alias("gap")) for j, u in enumerate(offsets)]))
    sizes = sizes.select("*", *[t.over(source).alias(f"t{j}") for j, t in enumerate(taken)]).select("s", "size", "n", "base", "rate", "total", "e", best.alias("best"))
    sizes = sizes.select("s", "size", "n", "base", "rate", extra(F.col("best.u")).cast("long").alias("extra"), F.col("best.gap").alias("gap"))
    for _ in range(2):
        move = lambda delta: F.struct(F.abs(F.col("gap") - delta * F.col("size")).alias("off"), F.col("size").alias("size"), F.lit(delta).alias("delta"))
        up = F.when((F.col("extra") < F.col("n")) & (F.col("base") < CAP) & (F.col("gap") > 0), move(1))
        down = F.when((F.col("extra") > 0) & (F.col("gap") < 0), move(-1))
        sizes = sizes.withColumn("m", F.min(F.coalesce(up, down)).over(source))
        better = F.coalesce(F.col("m.off") < F.abs(F.col("gap")), F.lit(False))
        here = better & (F.col("m.size") == F.col("size"))
        sizes = sizes.select("s", "size", "n", "base", "rate", (F.col("extra") + F.when(here, F.col("m.delta")).otherwise(0)).alias("extra"), F.when(better, F.col("gap") - F.col("m.delta") * F.col("m.size")).otherwise(F.col("gap")).alias("gap"))
    return sizes.select("s", "size", "n", "base", "rate", "extra")


def _dealt(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(s, size, salt, base, rate, extra): what each size gets, dealt to its cells (s, size, salt, c) in proportion."""
    upto = F.sum("c").over(Window.partitionBy("s", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, 0))
    share = lambda c: F.expr(f"({c} * extra) div n")
    return counts.join(sizes, ["s", "size"]).withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("c")).select("s", "size", "salt", "base", "rate", (share("upto") - share("before")).alias("extra"))


def _hash(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.col(text))


def _solution(docs: DataFrame, text: str, source: str, doc_id: str, weights: tuple[float, ...], share: float, cap: float, cell: int) -> tuple[DataFrame, DataFrame]:
    """(rows (doc_id, s, size, h, salt, rank), cells (s, size, salt, parts, base, rate, extra, source_size, target))."""
    sizes, _ = materialise(docs.select(F.col(doc_id).alias("doc_id"), source_key(source).alias("s"), token_size(text).alias("size"), _hash(doc_id, text).alias("h")), "mix-sizes")
    hist, _ = materialise(sizes.groupBy("s", "size").agg(F.count("*").alias("n")), "mix-hist")
    solved, _ = materialise(solve(hist, targets(hist, weights, share, cap), cap), "mix-solved")
    chosen, _ = materialise(_choose(rated(hist, solved, cap)).withColumn("parts", F.ceil(F.col("n") / F.lit(float(cell)))), "mix-chosen")
    salted = sizes.join(chosen.select("s", "size", "parts"), ["s", "size"]).withColumn("salt", F.pmod("h", "parts"))
    rank = F.row_number().over(Window.partitionBy("s", "size", "salt").orderBy("h", "doc_id"))
    rows, _ = materialise(salted.withColumn("rank", rank).select("doc_id", "s", "size", "h", "salt", "rank"), "mix-ranked")
    counts = rows.groupBy("s", "size", "salt").agg(F.count("*").alias("c"))
    cells = _dealt(counts, chosen.drop("parts")).join(chosen.select("s", "size", "parts"), ["s", "size"]).join(solved.select("s", "source_size", "target"), "s")
    cells, _ = materialise(cells, "mix-cells")
    return rows, cells


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, cell: int = CELL) -> DataFrame:
    """doc_id, s, size, source_size, target, rate, copies and taken of every row of docs."""
    rows, cells = _solution(docs, text, source, doc_id, weights, share, cap, cell)
    copies = (F.col("base") + F.when(F.col("rank") <= F.col("extra"), 1).otherwise(0)).cast("long")
    placed = rows.join(cells, ["s", "size", "salt"]).withColumn("copies", copies)
    return placed.select("doc_id", "s", "size", "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, cell: int = CELL, broadcast_cells: int = BROADCAST_CELLS) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its columns and the number of the copy."""
    rows, cells = _solution(docs, text, source, doc_id, weights, share, cap, cell)
    # the hash up to which the documents of a cell get a further copy; `taken` of the rows with just that hash do
    chosen = rows.join(cells.where("extra > 0").select("s", "size", "salt", "extra"), ["s", "size", "salt"]).where(F.col("rank") <= F.col("extra"))
    cut = chosen.groupBy("s", "size", "salt").agg(F.max("h").alias("cut"))
    tied = rows.join(cut, ["s", "size", "salt"]).where("h = cut").join(cells.select("s", "size", "salt", "extra"), ["s", "size", "salt"]).groupBy("s", "size", "salt").agg(F.count("*").alias("at_cut"), F.count_if(F.col("rank") <= F.col("extra")).alias("taken"))
    plan, _ = materialise(cells.select("s", "size", "salt", "parts", "base").join(cut, ["s", "size", "salt"], "left").join(tied, ["s", "size", "salt"], "left"), "mix-plan")
    plan = plan.select(F.col("s").alias("__s"), F.col("size").alias("__size"), F.col("salt").alias("__salt"), F.col("base").alias("__base"), F.col("cut").alias("__cut"), F.col("at_cut").alias("__ties"), F.col("taken").alias("__taken"), F.col("parts").alias("__parts"))
    parts = plan.groupBy("__s", "__size").agg(F.first("__parts").alias("__parts"))
    few = plan.count() <= broadcast_cells
    side = lambda d: F.broadcast(d) if few else d
    keyed = docs.select(F.struct(*docs.columns).alias("__row"), source_key(source).alias("__s"), token_size(text).alias("__size"), _hash(doc_id, text).alias("__h"))
    joined = keyed.join(side(parts), ["__s", "__size"]).withColumn("__salt", F.pmod("__h", "__parts")).join(side(plan.drop("__parts")), ["__s", "__size", "__salt"])
    below = F.coalesce((F.col("__h") < F.col("__cut")) | (F.col("__h") == F.col("__cut")) & (F.col("__ties") == F.col("__taken")), F.lit(False))
    divided = F.coalesce((F.col("__h") == F.col("__cut")) & (F.col("__ties") > F.col("__taken")), F.lit(False))
    joined = joined.withColumn("__more", below.cast("int")).withColumn("__divided", divided)
    # only rows with equal doc_id and text can share the hash at the cut; they are counted off
    nth = F.row_number().over(Window.partitionBy("__s", "__size", "__salt").orderBy(F.xxhash64("__row")))
    split = joined.where("__divided").withColumn("__more", (nth <= F.col("__taken")).cast("int"))
    names = [c for c in docs.columns if c != "copy"]
    shape = lambda d: d.select("__row", (F.col("__base") + F.col("__more")).cast("int").alias("__n"))
    out = shape(joined.where("NOT __divided")) if not plan.where("__ties > __taken").limit(1).count() else shape(joined.where("NOT __divided")).unionByName(shape(split))
    return out.where("__n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*[F.col("__row")[c].alias(c) for c in names], "copy")
