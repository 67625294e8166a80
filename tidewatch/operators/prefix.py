"""Exact running sums over ordered values without one-task-per-group windows.

A plain ``Window.partitionBy(group).orderBy(value)`` puts a whole group (a
whole continuous column) into one task.  Instead the rows are dealt into
ranges of (group, value) by Spark's sampled range partitioner and written
with their range number; range totals get exclusive prefix sums over a tiny
table, and the running sum inside each ``(group, range)`` partition is offset
by its range's prefix.  The number of ranges follows from the number of rows
alone, so a range holds about ``rows_per_bucket`` rows at every size; the
offset table has one row per range and group border and is broadcast (rows /
``rows_per_bucket`` + groups rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import stage_table


ROWS_PER_BUCKET = 1_000_000
# Above this many distinct values in one group, quantiles switch from the
# single-task ``percentile`` map to the bucketed running sums.
EXACT_MAP_LIMIT = 2_000_000


def auto_buckets(df: DataFrame, keys: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Buckets so that one running-sum task holds about ``rows_per_bucket`` rows.

    One small aggregate (one row per group) decides the plan.
    """
    widest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    return max(1, -(-int(widest) // rows_per_bucket))


def in_ranges(df: DataFrame, keys: list[str], order_col: str, ranges: int) -> DataFrame:
    """``df`` dealt into ranges of (keys, order_col), written once, with the range's number ``_part``.

    Written because the partitioner samples: its borders are settled when the rows are dealt."""
    dealt = df.repartitionByRange(ranges, *keys, order_col).withColumn("_part", F.spark_partition_id())
    return stage_table(dealt, "ranges")


def range_offsets(dealt: DataFrame, keys: list[str], order_col: str, weights: list[str]) -> DataFrame:
    """Per (keys, _part): ``_off_<w>``, the sum of ``w`` over the group's earlier ranges, and the next range's first value."""
    totals = dealt.groupBy(*keys, "_part").agg(*[F.sum(c).alias(c) for c in weights], F.min(order_col).alias("_first"))
    order = Window.partitionBy(*keys).orderBy("_part")  # one row per range
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, "_part", "_first", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_off_{c}") for c in weights],
                         F.lead("_first").over(order).alias("_next_first"))


def running_sums(
    df: DataFrame,
    keys: list[str],
    order_col: str,
    weights: list[str],
    buckets: int | None = None,
    with_next: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add ``cum_<w>`` = sum of ``w`` over rows of the group with ``order_col`` <= this row's.

    ``df`` must hold one row per (keys, order_col) value.  ``with_next``
    also adds ``next_<order_col>``, the next larger value in the group.
    ``buckets`` (ranges of the widest group) follows from ``rows_per_bucket`` unless given; 1 is one window per group.
    """
    rows, widest = 0, 0
    if buckets != 1:
        sizes = df.groupBy(*keys).count().agg(F.sum("count").alias("rows"), F.max("count").alias("widest")).first()
        rows, widest = sizes["rows"] or 0, sizes["widest"] or 0
        per_range = max(1, -(-widest // buckets)) if buckets else rows_per_bucket
    # An explicit partition count: the window stage is CPU-bound (a sort per
    # bucket), so AQE must not coalesce it down to a couple of tasks.
    nparts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if buckets == 1 or widest <= per_range:
        w = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
        extra = [F.lead(order_col).over(Window.partitionBy(*keys).orderBy(order_col)).alias(f"next_{order_col}")] if with_next else []
        src = df.repartition(nparts, *keys)
        return src.select("*", *[F.sum(c).over(w).alias(f"cum_{c}") for c in weights], *extra)

    ranges = -(-rows // per_range)
    dealt = in_ranges(df, keys, order_col, ranges)
    offsets = range_offsets(dealt, keys, order_col, weights).drop("_first")
    joined = dealt.join(F.broadcast(offsets), keys + ["_part"]).repartition(max(nparts, ranges), *keys, "_part")
    wv = Window.partitionBy(*keys, "_part").orderBy(order_col)
    extra = [F.coalesce(F.lead(order_col).over(wv), F.col("_next_first")).alias(f"next_{order_col}")] if with_next else []
    up_to = wv.rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        *df.columns, *[(F.col(f"_off_{c}") + F.sum(c).over(up_to)).alias(f"cum_{c}") for c in weights], *extra
    )


def exact_quantiles(
    cum: DataFrame,
    keys: list[str],
    value: str,
    weight: str,
    totals: DataFrame,
    total_col: str,
    probs: list[float],
    out: str = "q",
) -> DataFrame:
    """Linear-interpolated quantiles (``percentile`` / ``quantile_cont`` semantics).

    ``cum`` comes from :func:`running_sums` (``cum_<weight>`` inclusive);
    ``totals`` holds one row per group with the group's total weight.
    Returns ``keys + [prob, out]``.  Only the rows that own the needed ranks
    are touched: the rank table (groups x probs x 2) is broadcast.
    """
    rk = [f"_rk{i}" for i in range(len(keys))]
    probs_arr = F.array(*[F.lit(float(p)) for p in probs])
    ranks = (
        totals.filter(F.col(total_col) > 0)
        .select(*[F.col(k).alias(r) for k, r in zip(keys, rk)], F.col(total_col).alias("_tot"),
                F.posexplode(probs_arr).alias("pi", "prob"))  # groups x |probs| rows
        .select(*rk, "pi", "prob", (F.col("prob") * (F.col("_tot") - 1)).alias("_pos"))
        .select(
            *rk, "pi", "prob", "_pos",
            F.explode(F.array(F.floor("_pos").cast("long"), F.ceil("_pos").cast("long"))).alias("_rank"),
        )
        .dropDuplicates(rk + ["pi", "_rank"])
    )
    cw = f"cum_{weight}"
    c = cum.filter(F.col(weight) > 0).select(*keys, F.col(value).alias("_v"), F.col(weight).alias("_w"), F.col(cw).alias("_cw"))
    cond = [F.col(k) == F.col(r) for k, r in zip(keys, rk)] + [
        (F.col("_cw") - F.col("_w")) <= F.col("_rank"),
        F.col("_rank") < F.col("_cw"),
    ]
    hit = c.join(F.broadcast(ranks), cond).select(*keys, "pi", "prob", "_pos", "_rank", "_v")
    agg = hit.groupBy(*keys, "pi", "prob", "_pos").agg(
        F.min_by("_v", "_rank").alias("_lo"), F.max_by("_v", "_rank").alias("_hi")
    )
    return agg.select(
        *keys,
        "prob",
        # the same arithmetic as ``percentile``: equal to the last bit on either path
        F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(
            (F.ceil("_pos") - F.col("_pos")) * F.col("_lo") + (F.col("_pos") - F.floor("_pos")) * F.col("_hi")).alias(out),
    )


def weighted_quantiles(
    cnt: DataFrame,
    keys: list[str],
    value: str,
    weight: str,
    probs: list[float],
    out: str = "q",
    map_limit: int = EXACT_MAP_LIMIT,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group of a (value, weight) table.

    One small aggregate (one row per group) measures the widest group.  If it
    has at most ``map_limit`` distinct values, Spark's exact ``percentile``
    with a frequency column does the work (its per-group map is then
    bounded); otherwise the bucketed running sums do, with no group in one
    task.  Returns ``keys + [prob, out]``.
    """
    c = cnt.filter(F.col(weight) > 0)
    stats = c.groupBy(*keys).agg(F.count("*").alias("_d"), F.sum(weight).alias("_t"))
    widest = stats.agg(F.max("_d")).first()[0] or 0
    if widest <= map_limit:
        q = c.groupBy(*keys).agg(F.percentile(F.col(value), F.array(*[F.lit(float(p)) for p in probs]), F.col(weight)).alias("_qs"))
        pr = cnt.sparkSession.createDataFrame([(i, float(p)) for i, p in enumerate(probs)], "_pi int, prob double")
        e = q.select(*keys, F.posexplode("_qs").alias("_pi", out))
        return e.join(F.broadcast(pr), "_pi").select(*keys, "prob", out)
    cum = running_sums(c, keys, value, [weight])
    return exact_quantiles(cum, keys, value, weight, stats, "_t", probs, out=out)
