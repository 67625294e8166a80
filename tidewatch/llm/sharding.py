"""Sampled splitters: spread records over shards of nearly equal bytes.

Keys are hashes of the text, so equal texts are neighbours in key order.  A
size-weighted sample of keys gives quantile boundaries; records fall into the
ranges between them; a range that holds more than its share is subdivided by
key, and by row only within a text with very many copies.  Exact totals of the pieces, summed in order, give
each record its place in one global byte stream, and a shard is an eighth of
that stream.  A group of equal texts up to ``group_slack`` of a shard is placed
as one; larger groups are split between neighbouring shards.

Only the slim columns (id, size, checksum, key) are shuffled; texts are read
once.  Everything is DataFrame expressions.

Defined results: a null text has size 1 and the checksum of the empty text; an
empty table gives no rows; repeated rows each get a slot of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import range_index, read_table
from tidewatch.session import stage_table

LAW = "bytes"


def splitters(slim: DataFrame, total: int, n_ranges: int, sample_size: int) -> list[int]:
    """Range boundaries: quantiles of a sample that takes a row with
    probability size * sample_size / total.  A key that fills several quantiles
    gets a range of its own."""
    unit = F.xxhash64("row", F.lit(17)).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)
    sample = slim.filter(unit < F.col("size") * (float(sample_size) / total))
    steps = [k / n_ranges for k in range(1, n_ranges)]
    found = sample.agg(F.percentile_approx("key", steps, 20 * n_ranges).alias("q")).first()["q"] or []
    hot = {a + 1 for a, b in zip(found, found[1:]) if a == b and a < (1 << 63) - 1}
    return sorted(set(found) | hot)


def shard(docs: DataFrame, n_shards: int = 8, n_ranges: int = 1024, sample_size: int = 16_384,
          group_slack: float = 0.02, id_col: str = "doc_id") -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = stage_table(docs.select(
        F.col(id_col).alias(id_col), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64("text").alias("key"),
        F.xxhash64(F.monotonically_increasing_id()).alias("row")), "sharding")
    total = slim.agg(F.sum("size")).first()[0] or 1

    bounds = splitters(slim, total, n_ranges, sample_size)
    ranged = slim.withColumn("rng", range_index(F.col("key"), bounds))
    share = max(1, 2 * total // n_ranges)
    # at most one number per range comes back, and the groups placed in pieces (n_shards / group_slack at most)
    sizes = {r["rng"]: r["b"] for r in ranged.groupBy("rng").agg(F.sum("size").alias("b")).collect()}
    slack = int(group_slack * total / n_shards)
    full = [r for r, b in sizes.items() if b > share]
    large = (ranged.filter(F.col("rng").isin(full)).groupBy("rng", "key").agg(F.sum("size").alias("b"))
             .filter(F.col("b") > slack).orderBy("key").collect()) if full else []
    for r in large:
        sizes[r["rng"]] -= r["b"]
    # what is left of a range is cut by key, so equal texts share a piece; the pieces of its large groups follow
    parts = [-(-sizes.get(r, 0) // share) or 1 for r in range(len(bounds) + 1)]
    sub = F.pmod(F.col("key"), F.get(F.array(*[F.lit(p) for p in parts]), F.col("rng")))
    if large:
        behind, after, pieces = list(parts), [], [-(-r["b"] // share) for r in large]
        for r, n in zip(large, pieces):
            after.append(behind[r["rng"]])
            behind[r["rng"]] += n
        at = range_index(F.col("key"), [r["key"] for r in large]) - 1

        def own(values: list) -> Column:
            return F.get(F.array(*[F.lit(v) for v in values]), at)

        sub = F.when(own([r["key"] for r in large]) == F.col("key"), own(after) + F.pmod(F.col("row"), own(pieces))).otherwise(sub)
    ranged = ranged.withColumn("sub", sub.cast("int"))

    # exact totals per piece (about 1.5 * n_ranges rows at most), summed in key order
    before = Window.orderBy("rng", "sub").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (ranged.groupBy("rng", "sub").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
              .select("rng", "sub", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte_shift"),
                      F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("row_shift")))
    running = Window.partitionBy("rng", "sub").orderBy("key", "row").rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy("rng", "sub", "key")
    whole = F.col("group_bytes") <= slack
    placed = (ranged.join(F.broadcast(shifts), ["rng", "sub"])
              .withColumn("start", F.col("byte_shift") + F.sum("size").over(running) - F.col("size"))
              .withColumn("idx", F.col("row_shift") + F.row_number().over(running) - 1)
              .withColumn("group_start", F.min("start").over(group))
              .withColumn("group_bytes", F.sum("size").over(group))
              # twice the middle of what is placed as one
              .withColumn("middle", F.when(whole, 2 * F.col("group_start") + F.col("group_bytes"))
                          .otherwise(2 * F.col("start") + F.col("size")))
              .withColumn("shard", F.least(F.expr(f"(middle * {n_shards}) div {2 * total}"), F.lit(n_shards - 1)).cast("int")))
    placed = stage_table(placed.select(id_col, "size", "text_crc32", "shard", "idx"), "sharding-placed")
    first = placed.groupBy("shard").agg(F.min("idx").alias("first_idx"))  # n_shards rows
    return (placed.join(F.broadcast(first), "shard")
            .select(id_col, "size", "text_crc32", "shard", (F.col("idx") - F.col("first_idx")).alias("slot")))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 7 of all ``documents`` under the law ``bytes``."""
    return (shard(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
