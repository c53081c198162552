import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill.operators.distinct import DistinctCounts
from tidemill.plans import views
from tidemill.plans.retail import product_overview


def found(df):
    return {tuple(r)[:-1]: r[-1] for r in df.collect()}


def test_loads_fold_to_the_count_over_all(spark, place):
    counts = DistinctCounts(spark, place, ["a", "b.c"])
    first = spark.createDataFrame([(1, "x"), (2, None), (2, "y"), (None, "x")], "a int, `b.c` string")
    second = spark.createDataFrame([(2, "z"), (3, ""), (3, "x")], "a int, `b.c` string")
    counts.add(first, "one")
    assert found(counts.counts()) == {("a",): 2, ("b.c",): 2}
    counts.add(second, "2")
    assert found(counts.counts()) == {("a",): 3, ("b.c",): 4}
    assert found(counts.counts(["2"])) == {("a",): 2, ("b.c",): 3}
    by_load = {("one", "a"): 2, ("one", "b.c"): 2, ("2", "a"): 2, ("2", "b.c"): 3}
    assert found(counts.counts_by_load()) == by_load


def test_a_load_added_again_replaces_itself(spark, place):
    counts = DistinctCounts(spark, place, ["a"])
    counts.add(spark.range(10).toDF("a"), "x")
    counts.add(spark.range(5, 20).toDF("a"), "y")
    counts.add(spark.range(10).toDF("a"), "x")
    assert found(counts.counts()) == {("a",): 20}
    counts.add(spark.range(2).toDF("a"), "x")
    assert found(counts.counts()) == {("a",): 17}
    counts.add(spark.range(0).toDF("a"), "y")
    assert found(counts.counts()) == {("a",): 2}
    assert found(counts.counts_by_load()) == {("x", "a"): 2, ("y", "a"): 0}


def test_many_values_reach_several_bitmaps(spark, place):
    counts = DistinctCounts(spark, place, ["a", "b"])
    rows = spark.range(100_000).select(F.col("id").alias("a"), (F.col("id") / 2).cast("bigint").alias("b"))
    counts.add(rows, "x")
    counts.add(rows.select((F.col("a") + 50_000).alias("a"), "b"), "y")
    assert found(counts.counts()) == {("a",): 150_000, ("b",): 50_000}


def test_values_are_told_apart_as_count_distinct_does(spark, place):
    rows = spark.createDataFrame(
        [(0.0, b"\x00", dt.date(2024, 1, 1)), (-0.0, b"", dt.date(2024, 1, 2)), (float("nan"), b"\x00", None)],
        "d double, b binary, t date",
    )
    counts = DistinctCounts(spark, place, ["d", "b", "t"])
    counts.add(rows, "x")
    plain = rows.agg(*[F.count_distinct(c).alias(c) for c in rows.columns]).first().asDict()
    assert found(counts.counts()) == {(c,): n for c, n in plain.items()}


def test_nothing_added_and_bad_columns(spark, place):
    assert found(DistinctCounts(spark, place, ["a"]).counts()) == {("a",): 0}
    with pytest.raises(ValueError, match="twice"):
        DistinctCounts(spark, place, ["a", "a"])
    with pytest.raises(ValueError, match="plain"):
        DistinctCounts(spark, place, ["a"]).add(spark.sql("SELECT array(1) AS a"), "x")


def test_product_overview_by_bitmaps(spark, place):
    products = views.retail(spark, "/root/testdata/sf0.001")
    row = product_overview(products).first()
    counts = DistinctCounts(spark, place, ["brand", "category"])
    cheap = F.coalesce(F.col("actual_price") < 1000, F.lit(False))
    counts.add(products.filter(cheap), "cheap")
    counts.add(products.filter(~cheap), "dear")
    assert found(counts.counts()) == {("brand",): row["unique_brands"], ("category",): row["unique_categories"]}
