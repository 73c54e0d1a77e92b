"""Joins, ordered positions, comparison of frames and other relational work."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanthorn.operators.ordinal import global_ordinal

def join_order() -> list[Column]:
    """Order of the catalog join result: category asc, rating desc, book id asc."""
    return [F.col("category").asc(), F.col("rating").desc(), F.col("book_id").asc()]


def lookup_join(df: DataFrame, dictionary: DataFrame, key: str, dict_key: str,
                value: str) -> DataFrame:
    """Map ``key`` to ``value`` through a dictionary table (left join).

    Unmatched keys get null; ``quality.expect_not_null`` on the result is
    the gate.  No broadcast hint: AQE broadcasts the dictionary when its
    measured size is under the threshold and keeps a shuffle join when not.
    """
    return (df.join(dictionary.select(F.col(dict_key).alias("__k"), F.col(value)),
                    df[key] == F.col("__k"), "left").drop("__k"))


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent row (left anti join)."""
    return child.join(parent.select(F.col(parent_key).alias("__pk")).distinct(),
                      child[child_key] == F.col("__pk"), "left_anti")


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def append_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; duplicates are kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """Sorted first k rows: planned as TakeOrderedAndProject (per-task top-k)."""
    return df.orderBy(*order).limit(k)


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """1..n position along ``order`` (must be total) without a one-task window."""
    return global_ordinal(df, order, name)


def catalog_join_df(books: DataFrame, categories: DataFrame) -> DataFrame:
    """The catalog join through the frame API: merge, rename, cast, project."""
    joined = books.join(categories, "category_id", "inner")
    return (joined.withColumnRenamed("category_name", "category")
            .withColumn("in_stock", F.col("in_stock").cast("int"))
            .select("book_id", "title", "price_gbp", "price_inr", "rating", "in_stock",
                    "category"))


def positional_zip(left: DataFrame, right: DataFrame, order: Sequence[Column],
                   left_prefix: str = "left_", right_prefix: str = "right_") -> DataFrame:
    """Put two equally ordered frames side by side by row position.

    Each side is numbered along the same total order and the two are full
    outer joined on the position, so a longer side shows nulls opposite.
    """
    lp = prefix_columns(with_position(left, order, "__pos"), left_prefix) \
        .withColumnRenamed(left_prefix + "__pos", "__lpos")
    rp = prefix_columns(with_position(right, order, "__pos"), right_prefix) \
        .withColumnRenamed(right_prefix + "__pos", "__rpos")
    joined = lp.join(rp, F.col("__lpos") == F.col("__rpos"), "full_outer")
    return (joined.withColumn("position", F.coalesce("__lpos", "__rpos"))
            .drop("__lpos", "__rpos")
            .select("position", *[c for c in joined.columns if c not in ("__lpos", "__rpos")]))


def bag_sums(df: DataFrame) -> tuple:
    """Number of rows and two exact sums of two 64-bit hashes over them: equal bags of rows have equal sums.

    One pass with map-side sums; the order of the rows does not matter and copies count.
    """
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    # a null anywhere leaves a hash as it was, so which fields are null goes in by itself
    nulls = F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in df.columns]) if df.columns else F.lit("")
    hashes = [F.xxhash64(row, nulls), F.xxhash64(F.lit("second"), nulls, row)]
    return tuple(df.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)) for h in hashes]).first())


def _hashable(kind) -> bool:
    return not any(word in kind.simpleString() for word in ("map<", "variant"))


def frames_equal(left: DataFrame, right: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """One row: equal?, sizes and the bag differences both ways.

    Column names and types must match.  With ``order`` (a total order of the rows) the row
    order is compared too.  Missing equals missing, as ``exceptAll`` compares nulls as equal.

    The bags are compared by sums of row hashes first, one pass per side without a shuffle of rows; equal
    bags under one total order are equal sequences.  Only where the sums differ are rows counted one by one,
    with their positions if ``order`` is given.
    """
    same_schema = [(f.name, f.dataType) for f in left.schema.fields] == \
        [(f.name, f.dataType) for f in right.schema.fields]
    if same_schema and all(_hashable(f.dataType) for f in left.schema.fields):
        sums = bag_sums(left)
        if sums == bag_sums(right):
            return left.sparkSession.createDataFrame(
                [(True, sums[0], sums[0], 0, 0)], "equal boolean, left_rows bigint, right_rows bigint, left_only bigint, right_only bigint")
    if order is not None:
        left, right = with_position(left, order, "__pos"), with_position(right, order, "__pos")
    if not same_schema:
        lo = left.agg(F.count(F.lit(1)).alias("left_rows"))
        ro = right.agg(F.count(F.lit(1)).alias("right_rows"))
        return lo.join(ro, how="inner").select(F.lit(False).alias("equal"), "left_rows",
                                               "right_rows", F.lit(None).cast("long").alias("left_only"),
                                               F.lit(None).cast("long").alias("right_only"))
    tagged = (left.select(F.struct(*left.columns).alias("__r"), F.lit(1).alias("__l"), F.lit(0).alias("__rt"))
              .unionByName(right.select(F.struct(*right.columns).alias("__r"), F.lit(0).alias("__l"),
                                        F.lit(1).alias("__rt"))))
    # Per distinct row: how many copies on each side (one shuffle).
    per_row = tagged.groupBy("__r").agg(F.sum("__l").alias("nl"), F.sum("__rt").alias("nr"))
    return per_row.agg(
        F.coalesce(F.sum("nl"), F.lit(0)).cast("long").alias("left_rows"),
        F.coalesce(F.sum("nr"), F.lit(0)).cast("long").alias("right_rows"),
        F.coalesce(F.sum(F.greatest(F.col("nl") - F.col("nr"), F.lit(0))), F.lit(0)).cast("long").alias("left_only"),
        F.coalesce(F.sum(F.greatest(F.col("nr") - F.col("nl"), F.lit(0))), F.lit(0)).cast("long").alias("right_only"),
    ).select((F.col("left_only") + F.col("right_only") == 0).alias("equal"),
             "left_rows", "right_rows", "left_only", "right_only")


def category_grid(df: DataFrame, row_key: str, col_key: str, value: Column,
                  name: str = "value") -> DataFrame:
    """Aggregate ``value`` for every (row_key, col_key) combination.

    A bare groupBy loses empty combinations.  The grid is every distinct row
    value beside the array of distinct column values (one row, as wide as
    the grid itself), exploded; the aggregate joins it, and an empty
    combination keeps a null measure.
    """
    known = df.where(F.col(row_key).isNotNull() & F.col(col_key).isNotNull())
    cols = known.agg(F.collect_set(col_key).alias("__cols"))
    grid = known.select(row_key).distinct().join(F.broadcast(cols)) \
        .select(row_key, F.explode("__cols").alias(col_key))
    return grid.join(known.groupBy(row_key, col_key).agg(value.alias(name)), [row_key, col_key], "left")


def argmax_row(df: DataFrame, by: str, tie_break: Sequence[str]) -> DataFrame:
    """The row with the largest ``by``; ties go to the smallest tie-break."""
    return df.orderBy(F.col(by).desc(), *[F.col(c).asc() for c in tie_break]).limit(1)
