"""Exact quotas from hash cuts: repeated keys, null targets, empty tables."""

import math
from collections import Counter

from pyspark.sql import functions as F

from tidewatch.operators.split import order_hash, quota_cuts, random_split, stratified_split


def _sizes(split):
    return Counter(r["split"] for r in split.select("split").collect())


def test_a_key_that_a_third_of_the_rows_share_is_cut_exactly(spark):
    rows = spark.range(300).select(F.when(F.col("id") < 100, F.lit(7)).otherwise(F.col("id")).alias("k"), (F.col("id") % 10).alias("y"), "id")
    for share in (0.2, 0.5, 0.77):
        first = random_split(rows, ["k"], share)
        assert _sizes(first)["test"] == math.ceil(share * 300)
        again = random_split(rows.repartition(5), ["k"], share)
        assert sorted(first.collect()) == sorted(again.collect())
    assert _sizes(stratified_split(rows, "y", ["k"])) == {"test": 60, "val": 38, "train": 202}


def test_rows_that_are_the_same_in_every_column(spark):
    rows = spark.range(100).select(F.lit(1).alias("k"), F.lit(2.5).alias("y"))
    assert _sizes(random_split(rows, ["k"], 0.2)) == {"test": 20, "train": 80}
    assert _sizes(stratified_split(rows, "y", ["k"])) == {"test": 20, "val": 13, "train": 67}


def test_null_and_nan_targets_and_empty_tables(spark):
    y = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(float("nan"))).otherwise(F.col("id").cast("double"))
    assert _sizes(stratified_split(spark.range(90).select("id", y.alias("y")), "y", ["id"])) == {"test": 18, "val": 12, "train": 60}
    assert _sizes(stratified_split(spark.range(0).select("id", F.col("id").alias("y")), "y", ["id"])) == {}
    assert random_split(spark.range(0), ["id"]).count() == 0


def test_a_cut_is_refined_until_it_falls_between_two_prefixes(spark):
    rows = spark.range(200_000).select("id", order_hash(42, ["id"]).alias("_h"))
    cuts = quota_cuts(rows, F.lit(0), F.col("_h"), 0.2)  # three rows a prefix of 16 bits
    assert len(cuts) == 1 and cuts[0].need == cuts[0].n and len(cuts[0].prefix) in (4, 8, 12)
    assert rows.filter(F.col("_h") < cuts[0].prefix + "g").count() == 40_000
