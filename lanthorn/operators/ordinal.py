"""Global ordinals and running sums without a one-task window.

``row_number() over (order by k)`` with no partition clause pulls every row
into a single task.  Here the rows are range-partitioned on the order keys
(Spark samples the keys, so a hot first key is split by the later keys),
sorted inside each partition, numbered locally, and shifted by the sizes
of the partitions before them.  The per-partition table has one row per
partition, so broadcasting it has a proven size bound.

The order keys must form a total order (add a unique tie-break column):
the local numbering then does not depend on how shuffle blocks arrive.

The totals and the numbered rows must see one and the same partition
assignment.  Two range exchanges in one plan each sample their own bounds,
so the ranged, sorted rows are written once with ``checkpoint()`` to the
shared folder named by ``spark.checkpoint.dir``; both branches read those
files.  This also cuts the lineage, so a lost executor costs a re-read,
not a re-sort.  Narrow the frame to the columns needed before calling on
very wide tables.

One path serves every size.  The input runs once: it is checkpointed, and both
the sampling of the range bounds and the exchange read those files.  The number
of range partitions is that of the input, the session's setting at least.
A caller whose rows are bounded by a report (classes, categories, columns,
probabilities) says so with ``bounded=True`` and gets a plain window; nothing
is counted to find out.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanthorn.session import small_side

_PID = "__pid"
_LOCAL = "__local"


def _cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _ranged(df: DataFrame, order: Sequence[Column | str], partitions: int | None, stored: bool = False) -> DataFrame:
    keys = _cols(order)
    once = df if stored else df.checkpoint(eager=True)
    partitions = partitions or max(once.rdd.getNumPartitions(),
                                   int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = once.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys).checkpoint(eager=True)
    return ranged.withColumn(_PID, F.spark_partition_id())


def _offsets(tagged: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Per-partition totals turned into exclusive prefix offsets (tiny)."""
    totals = tagged.groupBy(_PID).agg(*[m.alias(k) for k, m in measures.items()])
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(totals.select(
        _PID, *[F.coalesce(F.sum(k).over(w), F.lit(0)).alias(f"{k}__off") for k in measures]))


def global_ordinal(df: DataFrame, order: Sequence[Column | str], name: str = "ordinal",
                   partitions: int | None = None, bounded: bool = False) -> DataFrame:
    """Add ``name`` = 1..n following ``order`` (a total order)."""
    if bounded:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*_cols(order))).cast("long"))
    tagged = _ranged(df, order, partitions)
    # monotonically_increasing_id keeps the partition index in the upper
    # 31 bits and the position inside the partition in the lower 33 bits.
    tagged = tagged.withColumn(
        _LOCAL, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33) + 1)
    offsets = _offsets(tagged, {"n": F.count(F.lit(1))})
    return (tagged.join(offsets, _PID)
            .withColumn(name, F.col(_LOCAL) + F.col("n__off"))
            .drop(_PID, _LOCAL, "n__off"))


def running_sums(df: DataFrame, order: Sequence[Column | str], values: dict[str, str],
                 ordinal: str | None = None, partitions: int | None = None, bounded: bool = False,
                 stored: bool = False) -> DataFrame:
    """Running (inclusive) sums of numeric columns along a global total order.

    ``values`` maps output name -> input column.  Sums are carried in
    doubles for fractional columns and in longs for integral ones.  With
    ``ordinal`` set, a 1..n position column is added as well.  ``stored``:
    the caller has checkpointed ``df`` itself.
    """
    if bounded:
        w = Window.orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = df
        for name, src in values.items():
            integral = isinstance(df.schema[src].dataType,
                                  (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
            out = out.withColumn(name, F.coalesce(F.sum(F.coalesce(F.col(src), F.lit(0))).over(w), F.lit(0))
                                 .cast("long" if integral else "double"))
        if ordinal:
            out = out.withColumn(ordinal, F.row_number().over(Window.orderBy(*_cols(order))).cast("long"))
        return out
    tagged = _ranged(df, order, partitions, stored)
    kinds = {c: tagged.schema[src].dataType for c, src in values.items()}
    measures = {out: F.sum(F.col(src)) for out, src in values.items()}
    if ordinal:
        measures[ordinal] = F.count(F.lit(1))
    offsets = _offsets(tagged, measures)

    out_fields = list(tagged.schema.fields)
    for out, kind in kinds.items():
        integral = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
        out_fields.append(T.StructField(out, T.LongType() if integral else T.DoubleType()))
    if ordinal:
        out_fields.append(T.StructField(ordinal, T.LongType()))
    out_schema = T.StructType(out_fields)
    pairs = list(values.items())

    def local_cumsum(batches):
        # Called once per partition; batches arrive in the sorted order.
        carry = {out: 0 for out, _ in pairs}
        seen = 0
        for pdf in batches:
            for out, src in pairs:
                s = pdf[src].fillna(0).cumsum() + carry[out]
                if len(s):
                    carry[out] = s.iloc[-1]
                pdf[out] = s
            if ordinal:
                pdf[ordinal] = pd.RangeIndex(seen + 1, seen + 1 + len(pdf)).to_numpy()
                seen += len(pdf)
            yield pdf

    local = tagged.mapInPandas(local_cumsum, out_schema)
    result = local.join(offsets, _PID)
    for out in measures:
        result = result.withColumn(out, F.col(out) + F.col(f"{out}__off"))
    return result.drop(_PID, *[f"{k}__off" for k in measures])


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                name: str = "rank_in_group", partitions: int | None = None) -> DataFrame:
    """row_number() per group along ``order`` without one task per group.

    A group that holds a third of all rows is split across range
    partitions like any other key range: the global ordinal over
    (group, order) minus the group's first ordinal.  The table of first
    ordinals has one row per group; it is broadcast where its size is
    checked to allow it, else joined (AQE splits skewed partitions).
    """
    ordered = global_ordinal(df, [*group, *order], "__g_ord", partitions)
    starts = ordered.groupBy(*group).agg(F.min("__g_ord").alias("__g_start"))
    return (ordered.join(small_side(starts), list(group))
            .withColumn(name, F.col("__g_ord") - F.col("__g_start") + 1)
            .drop("__g_ord", "__g_start"))
