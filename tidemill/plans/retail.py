"""Reports over a product table (brand, category, price, rating, stock)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import at_least, below
from ..operators.ranking import top_k, with_share

# Report labels and their limits.
PRICES = ((100, "Under $100"), (500, "$100-500"), (1000, "$500-1000"), (5000, "$1000-5000"))
HIGHEST_PRICE = "Over $5000"
RATINGS = (
    (4.5, "Excellent (4.5+)"),
    (4.0, "Very Good (4.0-4.5)"),
    (3.0, "Good (3.0-4.0)"),
    (2.0, "Fair (2.0-3.0)"),
)
LOWEST_RATING = "Poor (<2.0)"
TIERS = ((500, "Budget"), (2000, "Mid-Range"))
HIGHEST_TIER = "Premium"


def price_number(text: Column) -> Column:
    """A price written like ``$1,200`` as a number; text that is no price gives NULL."""
    return F.regexp_replace(text, "[,$]", "").try_cast("double")


def product_overview(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.count_distinct("brand").alias("unique_brands"),
        F.count_distinct("category").alias("unique_categories"),
        F.min("actual_price").alias("min_price"),
        F.max("actual_price").alias("max_price"),
        F.avg("actual_price").alias("avg_price"),
    )


def top_brands(df: DataFrame, brands: int = 20) -> DataFrame:
    grouped = (
        df.filter(F.col("brand").isNotNull())
        .groupBy("brand")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            F.avg("actual_price").alias("avg_price"),
            F.avg("average_rating").alias("avg_rating"),
        )
    )
    return top_k(grouped, brands, F.desc("product_count"), F.col("brand"))


def category_profile(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("products"),
            F.avg("actual_price").alias("avg_price"),
            F.min("actual_price").alias("min_price"),
            F.max("actual_price").alias("max_price"),
            F.avg("average_rating").alias("avg_rating"),
            F.count_if(F.col("out_of_stock") == F.lit(True)).alias("out_of_stock_count"),
        )
        .orderBy(F.desc("products"), "category")
    )


def price_ranges(df: DataFrame) -> DataFrame:
    grouped = df.groupBy(below(F.col("actual_price"), PRICES, HIGHEST_PRICE).alias("price_range")).agg(
        F.count(F.lit(1)).alias("product_count"), F.min("actual_price").alias("_from")
    )
    return with_share(grouped, "product_count").orderBy("_from").drop("_from")


def rating_groups(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("average_rating").isNotNull())
        .groupBy(at_least(F.col("average_rating"), RATINGS, LOWEST_RATING).alias("rating_category"))
        .agg(
            F.count(F.lit(1)).alias("products"),
            F.avg("actual_price").alias("avg_price"),
            F.min("average_rating").alias("_from"),
        )
        .orderBy(F.desc("_from"))
        .drop("_from")
    )


def stock_status(df: DataFrame) -> DataFrame:
    return df.groupBy("out_of_stock").agg(
        F.count(F.lit(1)).alias("products"),
        F.avg("actual_price").alias("avg_price"),
        F.avg("average_rating").alias("avg_rating"),
    )


def _rated(df: DataFrame, price: str, rating: str) -> DataFrame:
    return df.filter(F.col(price).isNotNull() & F.col(rating).isNotNull())


def brand_quality(
    df: DataFrame, price: str = "price_text", rating: str = "rating_text", ratings: str = "no_of_ratings", least: int = 10
) -> DataFrame:
    """Brands with at least ``least`` products, from columns that hold numbers as text."""
    return (
        _rated(df, price, rating)
        .groupBy("brand")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            F.avg(price_number(F.col(price))).alias("avg_price"),
            F.avg(F.col(rating).try_cast("double")).alias("avg_rating"),
            F.avg(F.col(ratings).try_cast("int")).alias("avg_num_ratings"),
        )
        .filter(F.col("product_count") >= least)
        .orderBy(F.desc("avg_rating"))
    )


def rating_by_price(df: DataFrame, price: str = "price_text", rating: str = "rating_text") -> DataFrame:
    tier = below(price_number(F.col(price)), TIERS, HIGHEST_TIER)
    return (
        _rated(df, price, rating)
        .groupBy(tier.alias("price_category"))
        .agg(F.avg(F.col(rating).try_cast("double")).alias("avg_rating"), F.count(F.lit(1)).alias("product_count"))
    )
