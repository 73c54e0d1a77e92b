"""Record cleaning, quarantine, normalised tables and the quota prefix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanthorn.functions import text as tx
from lanthorn.operators.ordinal import global_ordinal, running_sums

CLEAN_COLUMNS = ["title", "price", "star_rating", "availability", "category",
                 "price_gbp", "rating", "in_stock", "price_inr"]


def parse_fields(raw: DataFrame, price="price", rating="star_rating",
                 availability="availability") -> DataFrame:
    """Add the three parsed columns next to the raw text."""
    return (raw.withColumn("price_gbp", tx.parse_price(price))
               .withColumn("rating", tx.parse_rating(rating))
               .withColumn("in_stock", tx.parse_availability(availability)))


def invalid_reasons(title="title", category="category"):
    """Array of the rules a parsed row breaks (empty when valid)."""
    checks = [
        (tx.is_blank(title), "blank_title"),
        (tx.is_blank(category), "blank_category"),
        (F.col("price_gbp").isNull(), "no_price"),
        (F.col("rating").isNull(), "no_rating"),
        (F.col("in_stock").isNull(), "no_availability"),
    ]
    return F.filter(F.array(*[F.when(c, F.lit(name)) for c, name in checks]),
                    lambda x: x.isNotNull())


def mark_invalid(raw: DataFrame, rate: float = tx.GBP_TO_INR) -> DataFrame:
    """Parsed rows with ``is_invalid`` (never null) and ``reasons``."""
    parsed = parse_fields(raw).withColumn("reasons", invalid_reasons())
    return (parsed.withColumn("is_invalid", F.size("reasons") > 0)
                  .withColumn("price_inr", F.col("price_gbp") * F.lit(rate)))


def split_clean(raw: DataFrame, rate: float = tx.GBP_TO_INR,
                keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(clean, dropped): the mask and its negation partition the rows.

    Clean rows get the fixed 9-column projection with typed values; the
    dropped rows keep their input columns, the parsed ones and the reasons.
    """
    marked = mark_invalid(raw, rate)
    clean = (marked.filter(~F.col("is_invalid"))
             .select(*keep, F.col("title"), "price", "star_rating", "availability", "category",
                     F.col("price_gbp").cast("double").alias("price_gbp"),
                     F.col("rating").cast("int").alias("rating"),
                     F.col("in_stock").cast("boolean").alias("in_stock"),
                     F.col("price_inr").cast("double").alias("price_inr")))
    dropped = (marked.filter(F.col("is_invalid"))
               .drop("is_invalid", "price_inr")
               .withColumn("reasons", F.array_join("reasons", ",")))
    return clean, dropped


def row_counts(raw: DataFrame) -> DataFrame:
    """raw / dropped / clean totals and distinct clean categories in one pass."""
    marked = mark_invalid(raw)
    return marked.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(F.col("is_invalid")).alias("dropped_rows"),
        F.count_if(~F.col("is_invalid")).alias("clean_rows"),
        F.count_distinct(F.when(~F.col("is_invalid"), F.col("category"))).alias("clean_categories"),
    )


def categories_table(clean: DataFrame, category="category") -> DataFrame:
    """categories(category_id 1..n by code-point order of the name)."""
    names = clean.select(F.col(category).alias("category_name")).distinct()
    return (global_ordinal(names, ["category_name"], "category_id")
            .select(F.col("category_id").cast("int"), "category_name"))


def books_table(clean: DataFrame, categories: DataFrame, arrival: str,
                category="category") -> DataFrame:
    """books(book_id by arrival, ..., category_id) through a lookup join.

    The category dictionary is one row per distinct name; Catalyst/AQE
    broadcast it when it is small and fall back to a shuffle join when
    not.  The lookup must find every name (checked by ``fk_audit``).
    """
    joined = clean.join(categories, clean[category] == categories["category_name"], "left")
    numbered = global_ordinal(joined, [arrival], "book_id")
    return numbered.select(
        F.col("book_id").cast("int").alias("book_id"), "title", "price_gbp", "price_inr",
        "rating", F.col("in_stock").cast("int").alias("in_stock"),
        F.col("category_id").cast("int").alias("category_id"))


def quota_prefix(raw: DataFrame, category: str, category_order: str,
                 min_rows: int = 60, min_categories: int = 3) -> DataFrame:
    """Raw rows of the shortest category prefix that meets both quotas.

    Categories are taken in ``category_order`` (their listing position).
    The reference re-cleans everything after each category; here the clean
    count of every category is computed once, running sums give the clean
    rows and non-empty categories up to each position, and the first
    position meeting both quotas bounds a semi join back to the raw rows.
    Raises ``ValueError`` when the quotas are never met.
    """
    marked = mark_invalid(raw)
    per_cat = (marked.groupBy(category)
               .agg(F.min(category_order).alias("__pos"),
                    F.count_if(~F.col("is_invalid")).alias("__clean"))
               .withColumn("__nonempty", (F.col("__clean") > 0).cast("long")))
    cum = running_sums(per_cat, ["__pos", category],
                       {"__cum_rows": "__clean", "__cum_cats": "__nonempty"})
    stop = cum.filter((F.col("__cum_rows") >= min_rows) & (F.col("__cum_cats") >= min_categories)) \
              .agg(F.min("__pos").alias("__stop"))
    last = stop.first()["__stop"]  # one number
    if last is None:
        raise ValueError(f"never {min_rows} clean rows in {min_categories} categories")
    chosen = per_cat.where(F.col("__pos") <= F.lit(last)).select(category)
    return raw.join(chosen, category, "left_semi")
