"""Mixing sources to target sizes by entropy balancing: exponentially tilted document rates, rounded to copies.

Every source has a target number of words.  Among all rates in [0, cap] that reach it, entropy balancing takes
those nearest (in relative entropy) to rate 1; the solution is ``min(cap, exp(lambda * size / max_size))`` with
one multiplier per source, the root of the convex dual.  Each Newton step is one aggregate over the cells
(source, size, number of documents), joined to the sources' multipliers; a bracket guards the step.

Rates become whole copies per cell by systematic rounding over the sizes of a source; the few words still
missing are settled on one cell per power-of-two size class.  Sums are taken over integers, so the result
does not depend on partitioning or order and reruns agree.  Only DataFrame functions are used.

Defined cases: NULL text has size 0; NULL source is a source of its own, the last one; a source without words
has target 0 and rate 1; rows with equal ids are told apart as rows in ``plan`` and, if they differ in any column, in
``mix``, where only rows equal in all columns get equal copies; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import rank_within, stage_table, words

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
MAX_STEPS = 60
ROWS_PER_TASK = 200_000
#: Fixed point of rates in the systematic rounding, and of words in the Newton sums.
RATE_ONE = 1 << 20
WORD_ONE = 1000


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(sid, source, source_size, max_size, target) of the table (source, source_size, max_size).

    The wanted total is shared by weight; no target exceeds ``cap`` sizes, and the excess goes to the others by
    weight.  Sorted by ``cap * size / weight``, the capped sources are a prefix, so one pass of running sums
    finds the water level."""
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sources.withColumn("sid", (F.row_number().over(ordered) - 1).cast("int"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("sid") % len(weights) + 1)
    everything = Window.partitionBy()
    filled = Window.orderBy("ratio", "sid")
    rows = (numbered.withColumn("weight", weight)
            .withColumn("most", (cap * F.col("source_size")).cast("double"))
            .withColumn("ratio", F.col("most") / F.col("weight"))
            .withColumn("wanted", share * F.sum("source_size").over(everything))
            .withColumn("taken", F.coalesce(F.sum("most").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("left_weight", F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("level", (F.col("wanted") - F.col("taken")) / F.col("left_weight"))
            .withColumn("capped", F.col("ratio") <= F.col("level"))
            .withColumn("water", F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)))
    return rows.select("sid", "source", "source_size", "max_size",
                       F.when(F.col("capped"), F.col("most")).otherwise(F.col("weight") * F.col("water")).alias("target"))


def _rate(size: Column, cap: int) -> Column:
    tilted = F.exp(F.least(F.col("lam") * size / F.greatest(F.col("max_size"), F.lit(1)), F.lit(50.0)))
    return F.when(F.col("full"), F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), tilted))


def solve(cells: DataFrame, sources: DataFrame, cap: int = CAP, max_steps: int = MAX_STEPS) -> DataFrame:
    """``sources`` with the multiplier ``lam`` (and ``full``, where every document is taken ``cap`` times).

    ``cells``: (sid, size, n).  Stops when every source is within a hundredth of a word or 1e-7 of its target; sources
    that are not after ``max_steps`` are an error."""
    width = F.greatest(F.col("max_size"), F.lit(1)).cast("double")
    state = stage_table(sources.withColumn("full", F.col("target") >= cap * F.col("source_size") * (1 - 1e-12))
                        .withColumn("lam", F.lit(0.0)).withColumn("lo", -50.0 * width)
                        .withColumn("hi", 2.0 * width).withColumn("open", ~F.col("full")), "mix-state")
    for _ in range(max_steps):
        if state.filter("open").isEmpty():
            return state
        mass = F.col("n") * F.col("size") * F.col("rate")
        slope = F.when(F.col("rate") < cap, mass * F.col("size") / F.col("max_size")).otherwise(0.0)
        fixed = lambda x: F.sum(F.round(x * WORD_ONE).cast("long")) / WORD_ONE
        sums = (cells.join(state.filter("open").select("sid", "lam", "max_size", "full"), "sid")
                .withColumn("rate", _rate(F.col("size"), cap))
                .groupBy("sid").agg(fixed(mass).alias("reached"), fixed(slope).alias("slope")))
        miss = F.col("reached") - F.col("target")
        lo = F.when(miss < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(miss > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - miss / F.when(F.col("slope") > 0, F.col("slope"))
        inside = (newton > F.col("lo2")) & (newton < F.col("hi2"))
        done = F.abs(miss) <= F.greatest(F.lit(0.01), 1e-7 * F.col("target"))
        state = stage_table(
            state.join(sums, "sid", "left").withColumn("lo2", lo).withColumn("hi2", hi)
            .withColumn("stays", F.coalesce(~F.col("open") | done, F.lit(True)))
            .withColumn("lam", F.when(F.col("stays"), F.col("lam")).when(inside, newton)
                        .otherwise((F.col("lo2") + F.col("hi2")) / 2))
            .select("sid", "source", "source_size", "max_size", "target", "full", "lam",
                    F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), (~F.col("stays")).alias("open")), "mix-state")
    if not state.filter("open").isEmpty():
        raise RuntimeError(f"the dual of some sources is still open after {max_steps} steps")
    return state


def round_cells(cells: DataFrame, solved: DataFrame, cap: int = CAP) -> DataFrame:
    """(sid, size, n, copies): whole copies per cell whose words come near each source's target."""
    by_size = Window.partitionBy("sid").orderBy("size")
    rated = cells.join(solved.select("sid", "lam", "full", "max_size", "target"), "sid").withColumn(
        "upto", F.sum(F.col("n") * F.round(_rate(F.col("size"), cap) * RATE_ONE).cast("long")).over(by_size))
    whole = lambda c: F.floor((c + RATE_ONE // 2) / RATE_ONE)
    rounded = stage_table(rated.withColumn("copies", (whole(F.col("upto")) - whole(F.coalesce(
        F.lag("upto").over(by_size), F.lit(0)))).cast("long")).select("sid", "size", "n", "copies", "target"), "mix-cells")
    gap = rounded.groupBy("sid").agg((F.round(F.max("target")) - F.sum(F.col("copies") * F.col("size"))).cast("long").alias("gap"))
    free = F.when(F.col("gap") > 0, cap * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
    classes = (rounded.join(gap, "sid").withColumn("free", free).filter("size > 0 and free > 0 and gap <> 0 and size <= abs(gap)")
               .groupBy("sid", F.floor(F.log2("size")).alias("class"))
               .agg(F.max("gap").alias("gap"), F.max_by(F.struct("size", "free"), F.struct("free", -F.col("size"))).alias("cell")))
    # at most one cell per power of two: a list of bounded length per source
    per_source = classes.groupBy("sid").agg(F.max("gap").alias("gap"), F.sort_array(F.collect_list("cell"), False).alias("cells"))
    start = F.struct(F.abs(F.col("gap")).alias("left"), F.array().cast("array<struct<size:bigint,k:bigint>>").alias("took"))

    def settle(acc: Column, cell: Column) -> Column:
        k = F.least(cell["free"], F.floor(acc["left"] / cell["size"])).cast("long")
        return F.struct((acc["left"] - k * cell["size"]).cast("long").alias("left"),
                        F.concat(acc["took"], F.array(F.struct(cell["size"].cast("long").alias("size"), k.alias("k")))).alias("took"))

    fixes = (per_source.select("sid", F.signum("gap").cast("long").alias("sign"), F.aggregate("cells", start, settle)["took"].alias("took"))
             .select("sid", "sign", F.explode("took").alias("t")).select("sid", F.col("t.size").alias("size"), (F.col("sign") * F.col("t.k")).alias("fix")))
    return rounded.join(fixes, ["sid", "size"], "left").select(
        "sid", "size", "n", (F.col("copies") + F.coalesce("fix", F.lit(0))).alias("copies"))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, carried: tuple[Column, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per document.

    ``carried``: named columns that tell rows of one id apart; they break ties of the draw and come last."""
    sized = stage_table(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                    F.size(words(F.col(text_col))).cast("long").alias("size"), *carried), "mix-sizes")
    extra = sized.columns[3:]
    counts = stage_table(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    sources = stage_table(targets(counts.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.max("size").alias("max_size")), weights, share, cap), "mix-sources")
    named = sources.select("sid", F.col("source").alias("named"), "source_size", "target")
    cells = stage_table(counts.join(named, counts["source"].eqNullSafe(F.col("named"))).select("sid", "size", "n"), "mix-cells-in")
    copies = round_cells(cells, solve(cells, sources, cap), cap)
    cell = copies.join(named, "sid").select("named", F.col("size").alias("cell_size"), "n", "copies", "source_size", "target")
    ranked = rank_within(sized.withColumn("draw", F.xxhash64("doc_id", "size")), ["source", "size"], ["draw", "doc_id", *extra], ROWS_PER_TASK)
    own = F.floor(F.col("copies") / F.col("n")) + (F.col("rank") < F.col("copies") % F.col("n")).cast("long")
    return (ranked.join(cell, ranked["source"].eqNullSafe(F.col("named")) & (F.col("size") == F.col("cell_size")))
            .select("doc_id", "source", "size", "source_size", "target", own.cast("long").alias("copies"),
                    (own * F.col("size")).cast("long").alias("taken"), *extra))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """The mixed corpus: every row as often as its copies, with its columns.

    Rows are told apart by id and the hash of their columns; rows equal in all columns get equal copies."""
    copy, row = (f"{c}_{uuid.uuid4().hex}" for c in ("copy", "row"))  # no columns of the documents have these names
    own = F.xxhash64(*[docs[c] for c in docs.columns])
    drawn = (plan(docs, id_col, text_col, source_col, **kw, carried=(own.alias(row),)).groupBy("doc_id", row)
             .agg(F.round(F.avg("copies")).cast("int").alias("_copies")).filter("_copies > 0")
             .select(F.col("doc_id").alias("_id"), row, "_copies"))
    return (docs.join(drawn, docs[id_col].eqNullSafe(drawn["_id"]) & (own == drawn[row]))
            .select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), drawn["_copies"])).alias(copy)).drop(copy))
