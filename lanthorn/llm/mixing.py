"""Mixing sources to target weights by entropy balancing.

Each source's token target is a constraint.  Among all document rates r with
``sum(size * r) = target`` per source and ``0 <= r <= cap`` the balanced ones have the largest
entropy; the convex dual has one multiplier per source and its solution
is the exponentially tilted rate ``min(cap, exp(lambda * size / scale))`` with the source's mean
size as scale.  Newton steps on the dual run as Spark aggregations over
the distinct (source, size) cells, kept inside a bracket so that they always converge.

The rates become whole copies by systematic rounding: along each source, ordered by size, running
sums of the rates (fixed point, exact) are rounded, and a document gets the
difference of two neighbouring sums, so the copies of any stretch of sizes are off by one at most.
The words still missing or too many, about one document's, are settled on the smallest documents.

Defined cases: null text has size 0, and a document of size 0 is taken 0 times; a null
source is a source of its own, last in the order; repeated rows are separate documents;
a source without words has target 0; an empty table gives an empty result; extra columns are not read; null ids sort first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanthorn.llm.common import free_names, written

WEIGHTS = (1, 2, 3)
CAP = 3
NEWTON_STEPS = 60
TOLERANCE = 1e-7
UNIT_BITS = 30


def word_count(text: Column) -> Column:
    """Number of words: white space runs become one blank each, so words are blanks plus one."""
    trimmed = F.trim(F.regexp_replace(text.cast("string"), r"[\x20\x09-\x0D]+", " "))
    words = F.when(F.length(trimmed) > 0, F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "))) + 1).otherwise(0)
    return F.coalesce(words, F.lit(0)).cast("bigint")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size): number of words of each text, counted by the scan itself."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       word_count(F.col(text_col)).alias("size"))


def targets(totals: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code point order (null last) weigh ``weights`` in turn and share all words; a target
    stops at ``cap`` times its source's size and the excess is shared again by weight among the
    others until none is above.  That ends at the level L with ``sum(min(weight * L, cap * size))`` equal to all words:
    sorted by ``cap * size / weight`` the stopped sources are a prefix, found with running sums.
    Holds one row per source.
    """
    ordered = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = totals.withColumn("place", F.row_number().over(ordered) - 1).withColumn("weight", weight)
    rows = rows.withColumn("stop", F.lit(float(cap)) * F.col("source_size"))
    by_level = Window.orderBy((F.col("stop") / F.col("weight")), "place")
    everything = Window.partitionBy()
    rows = (rows.withColumn("all_words", F.sum("source_size").over(everything).cast("double"))
            .withColumn("all_weight", F.sum("weight").over(everything))
            .withColumn("stopped", F.sum("stop").over(by_level.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("gone", F.sum("weight").over(by_level.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("level", (F.col("all_words") - F.coalesce("stopped", F.lit(0.0)))
                        / (F.col("all_weight") - F.coalesce("gone", F.lit(0.0)))))
    free = F.when(F.col("weight") * F.col("level") <= F.col("stop"), F.col("level"))
    first_free = F.min_by(free, F.when(free.isNotNull(), F.struct(F.col("stop") / F.col("weight"), F.col("place")))).over(everything)
    rows = rows.withColumn("final", first_free)
    return rows.select("source", "source_size",
                       F.least("stop", F.coalesce(F.col("weight") * F.col("final"), F.col("stop"))).alias("target"))


def tilts(cells: DataFrame, wanted: DataFrame, cap: int = CAP, steps: int = NEWTON_STEPS) -> DataFrame:
    """(source, lam, scale, target, source_size): the dual solution per source.

    ``cells`` holds (source, size, n), ``wanted`` the targets.  A step is one aggregation over the cells;
    the state is one row per source.  ``lam`` is null where every document takes the cap.
    """
    state = (cells.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"))
             .join(wanted.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
             .where("source_size > 0"))
    full = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    state = state.select("source", "scale", "target", "source_size",
                         F.when(full, F.lit(None).cast("double")).otherwise(F.lit(0.0)).alias("lam"),
                         F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
                         full.alias("done"))
    state = written(state, "mix-state")
    few = _few(state)
    for _ in range(steps):
        z = F.col("size") / F.col("scale")
        raw = F.exp(F.least(F.col("lam") * z, F.lit(50.0)))
        rate = F.least(F.lit(float(cap)), raw)
        open_ = state.where("not done").select(F.col("source").alias("s"), "lam", "scale")
        sums = (cells.join(F.broadcast(open_) if few else open_, F.col("source").eqNullSafe(F.col("s")))
                .groupBy("source").agg(
                    F.sum(F.col("n") * F.col("size") * rate).alias("have"),
                    F.sum(F.when(raw < cap, F.col("n") * F.col("size") * z * raw).otherwise(0.0)).alias("slope")))
        sums = sums.withColumnRenamed("source", "s")
        new = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left")
        gap = F.col("have") - F.col("target")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap >= 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - gap / F.col("slope")
        middle = F.when(F.col("lo2").isNull(), F.col("hi2") - 2 * (1 + F.abs("hi2"))).when(
            F.col("hi2").isNull(), F.col("lo2") + 2 * (1 + F.abs("lo2"))).otherwise((F.col("lo2") + F.col("hi2")) / 2)
        inside = ((F.col("slope") > 0) & (F.col("lo2").isNull() | (newton > F.col("lo2")))
                  & (F.col("hi2").isNull() | (newton < F.col("hi2"))) & (F.abs(newton - F.col("lam")) <= 4 * (1 + F.abs("lam"))))
        met = F.abs(gap) <= TOLERANCE * F.greatest(F.col("target"), F.lit(1.0))
        new = (new.withColumn("lo2", lo).withColumn("hi2", hi)
               .withColumn("met", F.col("done") | met | (F.col("lo2").isNotNull() & F.col("hi2").isNotNull()
                                                         & (F.col("hi2") - F.col("lo2") < 1e-13 * (1 + F.abs("lam")))))
               .withColumn("next", F.when(F.col("met"), F.col("lam")).when(inside, newton).otherwise(middle)))
        state = written(new.select("source", "scale", "target", "source_size", F.col("next").alias("lam"),
                                   F.col("lo2").alias("lo"), F.col("hi2").alias("hi"),
                                   F.coalesce("met", F.lit(False)).alias("done")), "mix-state")
        if state.where("not done").isEmpty():
            break
    return state


def _few(rows: DataFrame, bound: int = 4096) -> bool:
    """Whether a per-source table is small enough to broadcast (checked, else it is joined)."""
    return rows.limit(bound + 1).count() <= bound


def mixed(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every document; written once."""
    rows = written(sizes(docs, id_col, text_col, source_col), "mix-sizes")
    cells = written(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-cells")
    wanted = written(targets(cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")),
                             weights, cap), "mix-targets")
    lam = tilts(cells.where("size > 0"), wanted, cap)
    lam = lam.select(F.col("source").alias("s"), "lam", "scale", F.lit(True).alias("has"))
    rates = (wanted.join(lam, F.col("source").eqNullSafe(F.col("s")), "left")
             .select(F.col("source").alias("of"), "source_size", "target", "lam", "scale", F.col("has").isNull().alias("empty")))
    rates = F.broadcast(rates) if _few(rates) else rates
    rate = F.when(F.col("empty") | (F.col("size") == 0), 0.0).when(F.col("lam").isNull(), float(cap)).otherwise(
        F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * F.col("size") / F.col("scale"), F.lit(50.0)))))
    rated = rows.join(rates, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "source_size", "target",
        F.round(rate * float(1 << UNIT_BITS)).cast("bigint").alias("units"))
    return rounded(rated, cap)


def rounded(rated: DataFrame, cap: int = CAP) -> DataFrame:
    """Copies by systematic rounding of the running sums of ``units`` along (source, size, id).

    The rows are range-partitioned and written, so their parts stay fixed; a part's running sum
    starts from the sum of its source's earlier parts, a table of one row per part and source at most.
    What then is still missing from a source's target (about one document's words) is
    added to or taken from its smallest documents, one copy each, by a second running sum.
    """
    parts = int(rated.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rated.withColumn("h", F.xxhash64("doc_id")).repartitionByRange(parts, "source", "size", "h")
    fixed = written(spread.withColumn("part", F.spark_partition_id()), "mix-rows")
    half = 1 << (UNIT_BITS - 1)
    run = _running(fixed, {"units": "units"})
    after = F.shiftright(F.col("units_upto") + half, UNIT_BITS)
    before = F.shiftright(F.col("units_upto") - F.col("units") + half, UNIT_BITS)
    first = written(run.withColumn("copies", after - before)
                    .withColumn("more", F.when(F.col("copies") < cap, F.col("size")).otherwise(0))
                    .withColumn("less", F.when(F.col("copies") > 0, F.col("size")).otherwise(0))
                    .drop("units_upto"), "mix-copies")
    gaps = (first.groupBy("source").agg((F.round(F.max("target")) - F.sum(F.col("copies") * F.col("size"))).cast("bigint").alias("gap"))
            .withColumnRenamed("source", "g"))
    gaps = F.broadcast(gaps) if _few(gaps) else gaps
    last = _running(first, {"more": "more", "less": "less"}).join(gaps, F.col("source").eqNullSafe(F.col("g")))
    step = (F.when((F.col("gap") > 0) & (F.col("more") > 0) & (F.col("more_upto") <= F.col("gap")), 1)
            .when((F.col("gap") < 0) & (F.col("less") > 0) & (F.col("less_upto") <= -F.col("gap")), -1).otherwise(0))
    copies = F.col("copies") + step
    return last.select("doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def _running(fixed: DataFrame, columns: dict) -> DataFrame:
    """``fixed`` with ``<name>_upto``: running sum of each column along its source, this row included."""
    sums = fixed.groupBy("source", "part").agg(*[F.sum(c).alias(n) for n, c in columns.items()])
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s"), F.col("part").alias("p"),
                         *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n + "_start") for n in columns])
    local = Window.partitionBy("part", "source").orderBy("size", "h", "doc_id", "units").rowsBetween(
        Window.unboundedPreceding, 0)
    run = fixed.withColumns({n + "_local": F.sum(c).over(local) for n, c in columns.items()})
    run = run.join(starts, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
    return run.select(*fixed.columns, *[(F.col(n + "_local") + F.col(n + "_start")).alias(n + "_upto") for n in columns])


def repeated(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its copies, dropped at none.

    Rows of one id, source and size are told apart by their order, so repeated rows get their own copies.
    """
    mix_id, mix_size, mix_copies, mix_words, mix_n, mix_copy = free_names(docs, "mix_id", "mix_size", "mix_copies", "mix_words", "mix_n", "mix_copy")
    taken = mixed(docs, weights, cap, id_col, text_col, source_col)
    per = taken.groupBy(F.col("doc_id").alias(mix_id), F.col("size").alias(mix_size)).agg(
        F.sort_array(F.collect_list("copies"), asc=False).alias(mix_copies)).hint("merge")
    sized = docs.withColumn(mix_words, word_count(F.col(text_col)))
    rows = sized.join(per, F.col(id_col).cast("bigint").eqNullSafe(F.col(mix_id)) & (F.col(mix_words) == F.col(mix_size)))
    order = Window.partitionBy(mix_id, mix_size).orderBy(*[F.col(c) for c in (source_col, text_col)])
    few = F.size(mix_copies) == 1
    rows = rows.withColumn(mix_n, F.when(few, F.element_at(mix_copies, 1)).otherwise(
        F.element_at(mix_copies, F.row_number().over(order).cast("int"))))
    rows = rows.where(F.col(mix_n) > 0).withColumn(mix_copy, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(mix_n))))
    return rows.select(*docs.columns)
