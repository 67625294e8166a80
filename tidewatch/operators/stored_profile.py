"""Stored reference profiles with running sums (ST2, ST3, A14–A17).

A profile is written once and then only looked up.  Numeric features: one row
per distinct value with its running count, in ranges of bounded size, the
table bucketed by (feature, range).  Categories: one row per (feature,
category), bucketed by them.  New data are dealt to the same buckets, so a
test shuffles the new counts alone and reads the profile where it lies:

* KS needs the reference's share at, and just below, each *new* value only:
  between two new values the new share is constant and the reference's grows,
  so the largest gap is at one of their ends.  A union of both bucketed sides
  and one window per range finds the last profile row at or below each value;
* chi-square needs the new categories and one sum: every category that the
  new data lack adds (n_cur / n_ref) * r, so together they add
  (n_cur / n_ref) * (their reference rows).

Several groups (windows of a stream) are tested at once against one profile.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions.stats import chi2_sf
from tidewatch.operators.ks import ks_p, mean_shift
from tidewatch.operators.longform import CATEGORICAL, NUMERICAL, Feature, single_counts
from tidewatch.operators.prefix import ROWS_PER_BUCKET, in_ranges, range_offsets, running_sums
from tidewatch.session import shared_dir, stage_table

#: Counts of new data: group, feature, value or category, rows.
NEW_COUNTS = "g long, fid int, num double, cat string, c long"


@dataclass
class StoredProfile:
    features: list[Feature]
    values: str  # table (fid, part, num, n, cum), bucketed by (fid, part)
    categories: str  # table (fid, cat, n), bucketed by (fid, cat)
    totals: DataFrame  # one row per feature: n_ref, mean_ref, k_ref
    ranges: DataFrame  # one row per numeric feature: borders, their parts and the rows before them
    buckets: int

    def drop(self, spark: SparkSession) -> None:
        for name in (self.values, self.categories):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _save_bucketed(df: DataFrame, keys: list[str], buckets: int, name: str) -> str:
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", shared_dir(df.sparkSession, name)).saveAsTable(table))
    return table


def build_profile(ref: DataFrame, features: list[Feature], rows_per_range: int = ROWS_PER_BUCKET, buckets: int | None = None) -> StoredProfile:
    """Profile of a reference table; ``buckets`` (default: the shuffle partitions) grow with the table, like those."""
    spark = ref.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = stage_table(single_counts(ref, features), "profile-counts")
    numeric = counts.filter(F.col("num").isNotNull()).select("fid", "num", "n")
    dealt = in_ranges(numeric, ["fid"], "num", max(1, -(-numeric.count() // rows_per_range)))
    offsets = stage_table(range_offsets(dealt, ["fid"], "num", ["n"]), "profile-ranges")
    running = Window.partitionBy("fid", "_part").orderBy("num").rowsBetween(Window.unboundedPreceding, 0)
    values = (dealt.join(F.broadcast(offsets), ["fid", "_part"])  # one row per range
              .select("fid", F.col("_part").alias("part"), "num", "n", (F.col("_off_n") + F.sum("n").over(running)).alias("cum")))
    categories = counts.filter(F.col("cat").isNotNull()).select("fid", "cat", "n")
    totals = stage_table(counts.groupBy("fid").agg(
        F.sum("n").alias("n_ref"), F.try_divide(F.sum(F.col("num") * F.col("n")), F.sum("n")).alias("mean_ref"),
        F.count("cat").alias("k_ref")), "profile-totals")
    entry = F.array_sort(F.collect_list(F.struct("_first", F.col("_part").alias("part"), F.col("_off_n").alias("before"))))
    ranges = offsets.groupBy("fid").agg(entry.alias("r")).select("fid", F.col("r._first").alias("borders"), F.col("r.part").alias("parts"),
                                                                  F.col("r.before").alias("before"))
    return StoredProfile(features, _save_bucketed(values, ["fid", "part"], buckets, "profile_values"),
                         _save_bucketed(categories, ["fid", "cat"], buckets, "profile_categories"), totals, ranges, buckets)


def _at_most(borders: Column, value: Column) -> Column:
    """How many of the ascending ``borders`` are at most ``value``: a binary search as a fold of 32 halvings."""
    def halve(span: Column, _: Column) -> Column:
        mid = ((span["lo"] + span["hi"]) / 2).cast("int")
        right = (span["lo"] < span["hi"]) & (F.get(borders, mid) <= value)
        return F.struct(F.when(right, mid + 1).otherwise(span["lo"]).alias("lo"),
                        F.when(right | (span["lo"] >= span["hi"]), span["hi"]).otherwise(mid).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(32)), F.struct(F.lit(0).alias("lo"), F.size(borders).alias("hi")), halve, lambda s: s["lo"])


def _numeric(profile: StoredProfile, new: DataFrame) -> DataFrame:
    """(g, fid, n_cur, mean_cur, d): largest gap between the shares."""
    spark = new.sparkSession
    num = new.filter(F.col("num").isNotNull()).select("g", "fid", "num", "c")
    size = num.groupBy("g", "fid").agg(F.sum("c").alias("n_cur"), F.try_divide(F.sum(F.col("num") * F.col("c")), F.sum("c")).alias("mean_cur"))
    own = running_sums(num, ["g", "fid"], "num", ["c"])
    placed = (own.join(F.broadcast(profile.ranges), "fid", "left")  # one row per feature
              .withColumn("at", F.greatest(_at_most(F.col("borders"), F.col("num")) - 1, F.lit(0)))
              .select("g", "fid", "num", "c", "cum_c", F.get("parts", "at").alias("part"), F.coalesce(F.get("before", "at"), F.lit(0)).alias("before")))
    stored = spark.table(profile.values).select("fid", "part", "num", F.struct("num", "cum", "n").alias("row"))
    blank = lambda c, kind: F.lit(None).cast(kind).alias(c)
    both = stored.select("fid", "part", "num", "row", blank("g", "long"), blank("c", "long"), blank("cum_c", "long"), blank("before", "long")).unionByName(
        placed.repartition(profile.buckets, "fid", "part").select("fid", "part", "num", blank("row", "struct<num double, cum long, n long>"), "g", "c", "cum_c", "before"))
    up_to = Window.partitionBy("fid", "part").orderBy("num", F.col("row").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.select("*", F.last("row", ignorenulls=True).over(up_to).alias("last")).filter(F.col("row").isNull())
    at = F.coalesce(F.col("last.cum"), F.col("before"))
    below = F.when(F.col("last.num") == F.col("num"), F.col("last.cum") - F.col("last.n")).otherwise(at)
    counts = found.select("g", "fid", "c", "cum_c", at.alias("at"), below.alias("below"))
    sized = counts.join(size, ["g", "fid"]).join(F.broadcast(profile.totals.select("fid", "n_ref")), "fid", "left")  # one row per feature

    def gap(cur: Column, ref: Column) -> Column:
        return F.abs(F.try_divide(cur, F.col("n_cur")) - F.try_divide(ref, F.col("n_ref")))

    d = sized.groupBy("g", "fid").agg(F.max(F.greatest(gap(F.col("cum_c"), F.col("at")), gap(F.col("cum_c") - F.col("c"), F.col("below")))).alias("d"))
    return size.join(d, ["g", "fid"], "left")


def _categorical(profile: StoredProfile, new: DataFrame) -> DataFrame:
    """(g, fid, n_cur, k, x): categories of both sides and the chi-square sum (Yates at two categories)."""
    cat = new.filter(F.col("cat").isNotNull()).select("g", "fid", "cat", "c")
    stored = new.sparkSession.table(profile.categories).select("fid", "cat", F.col("n").alias("r"))
    cells = (cat.repartition(profile.buckets, "fid", "cat").join(stored, ["fid", "cat"], "left")
             .select("g", "fid", "c", F.coalesce("r", F.lit(0)).alias("r"), F.col("r").isNull().alias("fresh")))
    size = cells.groupBy("g", "fid").agg(F.sum("c").alias("n_cur"), F.sum("r").alias("r_seen"), F.count("*").alias("k_seen"), F.count_if("fresh").alias("fresh"))
    size = (size.join(F.broadcast(profile.totals.select("fid", "n_ref", "k_ref")), "fid", "left")  # one row per feature
            .withColumns({"n_ref": F.coalesce("n_ref", F.lit(0)), "k": F.coalesce("k_ref", F.lit(0)) + F.col("fresh")}))
    n = (F.col("n_ref") + F.col("n_cur")).cast("double")

    def terms(r: Column, c: Column) -> Column:
        def term(o: Column, side: str) -> Column:
            e = F.try_divide(F.col(side) * (r + c).cast("double"), n)
            gap = F.abs(o - e)
            gap = F.when(F.col("k") == 2, F.greatest(gap - 0.5, F.lit(0.0))).otherwise(gap)
            return F.try_divide(gap * gap, e)

        return term(r, "n_ref") + term(c, "n_cur")

    seen = (cells.join(size.select("g", "fid", "n_ref", "n_cur", "k"), ["g", "fid"])
            .groupBy("g", "fid").agg(F.sum(terms(F.col("r"), F.col("c"))).alias("x_seen")))
    rest = F.col("n_ref") - F.col("r_seen")
    unseen = F.when(F.col("k") == 2, terms(rest, F.lit(0))).otherwise(F.try_divide(F.col("n_cur") * rest.cast("double"), F.col("n_ref")))
    out = size.join(seen, ["g", "fid"], "left")
    return out.select("g", "fid", "n_cur", "k", (F.col("x_seen") + F.when(rest > 0, F.coalesce(unseen, F.lit(0.0))).otherwise(F.lit(0.0))).alias("x"))


def stats_against(profile: StoredProfile, new: DataFrame, exact_up_to: int = 0) -> DataFrame:
    """One row per (g, fid) that the ``new`` counts (see NEW_COUNTS) hold, with the columns that decisions need."""
    totals = F.broadcast(profile.totals)  # one row per feature
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    num = _numeric(profile, new).join(totals, "fid", "left")
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    num = num.select("g", "fid", "n_ref", "n_cur", F.when(both, F.col("d")).alias("statistic"),
                     ks_p(F.when(both, F.col("d")), F.col("n_ref"), F.col("n_cur"), exact_up_to).alias("p_value"), "mean_ref", "mean_cur",
                     mean_shift(F.col("mean_ref"), F.col("mean_cur")).alias("mean_shift"), none("dof", "long"))
    cat = _categorical(profile, new).join(totals.select("fid", "n_ref"), "fid", "left").withColumn("n_ref", F.coalesce("n_ref", F.lit(0)))
    valid = both & (F.col("k") > 1)
    dof = (F.col("k") - 1).cast("long")
    cat = cat.select("g", "fid", "n_ref", "n_cur", F.when(valid, F.col("x")).otherwise(F.lit(0.0)).alias("statistic"),
                     F.when(valid, chi2_sf(F.col("x"), dof)).otherwise(F.lit(1.0)).alias("p_value"), none("mean_ref", "double"),
                     none("mean_cur", "double"), none("mean_shift", "double"), dof.alias("dof"))
    kinds = {f.kind for f in profile.features}
    parts = [x for kind, x in ((NUMERICAL, num), (CATEGORICAL, cat)) if kind in kinds]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
