"""Quantile bins and exact, deterministic splits.

Row order for sampling is ``md5(seed | key)`` with the key as tie-break,
so a split depends only on the data, never on partitioning.  Exact quotas
per bin are met without a per-bin window over all rows: rows are counted
per (bin, 16-bit hash prefix), then the one prefix where a bin's quota is
crossed is counted by its next 16 bits, until the crossing falls between two
prefixes.  The quota is then one hash per bin, and membership a comparison
with it.  Only rows of one and the same hash (equal keys) that a quota cuts
are ranked, by their other columns.

Small fitted values come back to the driver as literals — the bin edges
(n_bins + 1 numbers) and one hash per bin — so the row-level work
is plain codegen'd predicates over the source, with no joins and no copy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.config import SplitConfig
from tidewatch.operators.profile import quantiles_by_column


def order_hash(seed: int, key_cols: list[str]) -> Column:
    parts = [F.lit(str(seed))] + [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in key_cols]
    return F.md5(F.concat_ws("|", *parts))


def quantile_edges(df: DataFrame, column: str, n_bins: int, known_small: bool = False) -> list[float]:
    """Distinct quantiles at 0, 1/n, ..., 1 (duplicates dropped), ascending."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    if known_small:  # one aggregate
        y = F.col(f"`{column}`").cast("double")
        found = df.agg(F.percentile(F.when(~F.isnan(y), y), F.array(*[F.lit(p) for p in probs]))).first()[0]
        return [float(q) for i, q in enumerate(found or []) if i == 0 or q != found[i - 1]]
    rows = quantiles_by_column(df, [column], probs, known_small=known_small).collect()  # n_bins + 1 values
    edges = []
    for r in sorted(rows, key=lambda r: r["prob"]):
        if r["q"] is not None and (not edges or r["q"] != edges[-1]):
            edges.append(float(r["q"]))
    return edges


def bin_expr(y: Column, edges: list[float]) -> Column:
    """Number of inner edges strictly below y (right-closed bins, lowest
    edge included); NULL stays NULL."""
    inner = edges[1:-1]
    b = F.lit(0)
    for e in inner:
        b = b + F.when(y > F.lit(e), 1).otherwise(0)
    return F.when(y.isNull(), F.lit(None).cast("int")).otherwise(b.cast("int"))


def with_quantile_bin(df: DataFrame, column: str, n_bins: int = 5, out: str = "bin") -> DataFrame:
    edges = quantile_edges(df, column, n_bins)
    return df.withColumn(out, bin_expr(F.col(f"`{column}`").cast("double"), edges))


@dataclass(frozen=True)
class Cut:
    """Where a group's quota ends: among its rows whose hash starts with ``prefix``, ``n`` of them, of which ``need`` belong to it."""

    group: object
    prefix: str
    need: int
    n: int


PREFIX = 4  # hash characters a level looks at: at most 65536 counts per group
HASH = 32


def boundaries_of_counts(bt: DataFrame, take_frac: float) -> list:
    """One action over the (group, hash-prefix) count table: per group, the
    prefix bucket where its exact quota is crossed, its size and how many rows of that
    bucket are still needed.  Quotas: total = ceil(frac * n); floor shares;
    the largest remainders (ties by group) get one more row.  A null group is a group."""
    bt = bt.repartition(1)  # <= 65536 rows per group: every window below is over this one partition
    whole, mine = Window.partitionBy(F.lit(1)), Window.partitionBy("_g")
    in_order = mine.orderBy("_hb").rowsBetween(Window.unboundedPreceding, 0)
    q = bt.select("*", F.sum("_n").over(mine).alias("_size"), F.sum("_n").over(whole).alias("_all"),
                  F.sum("_n").over(in_order).alias("_cum"), F.row_number().over(mine.orderBy("_hb")).alias("_row"))
    q = q.withColumn("_total", F.ceil(F.lit(float(take_frac)) * F.col("_all")).cast("long"))
    # products of two row counts pass 2^63 from about 7e9 rows on: exact decimals
    q = q.withColumn("_product", F.col("_total").cast("decimal(19,0)") * F.col("_size").cast("decimal(18,0)"))
    q = q.withColumns({"_fl": F.expr("_product div _all"), "_rem": F.col("_product") % F.col("_all")})
    left = F.col("_total") - F.sum(F.when(F.col("_row") == 1, F.col("_fl"))).over(whole)
    rank = F.dense_rank().over(Window.orderBy(F.desc("_rem"), F.asc("_g")))
    q = q.withColumn("_left", left).withColumn("_need", F.col("_fl") + F.when(rank <= F.col("_left"), 1).otherwise(0) - F.col("_cum") + F.col("_n"))
    return q.filter((F.col("_need") > 0) & (F.col("_need") <= F.col("_n"))).select("_g", "_hb", "_need", "_n").collect()


def _inside(cuts: list[Cut], group: Column, h: Column) -> Column:
    """Rows whose hash starts with their group's prefix."""
    found = F.lit(False)
    for c in cuts:
        found = found | (group.eqNullSafe(F.lit(c.group)) & h.startswith(c.prefix))
    return found


def quota_cuts(df: DataFrame, group: Column, h: Column, take_frac: float) -> list[Cut]:
    """One cut per group that has a quota above 0.

    A cut that falls inside a prefix is looked for again among the rows of that
    prefix alone; after the whole hash, only rows of equal keys are left."""
    def counts(rows: DataFrame, at: int) -> DataFrame:
        return rows.groupBy(group.alias("_g"), F.substring(h, at + 1, PREFIX).alias("_hb")).agg(F.count("*").alias("_n"))

    done, open_ = [], [Cut(r["_g"], r["_hb"], r["_need"], r["_n"]) for r in boundaries_of_counts(counts(df, 0), take_frac)]
    for at in range(PREFIX, HASH, PREFIX):
        done += [c for c in open_ if c.need == c.n]
        open_ = [c for c in open_ if c.need < c.n]
        if not open_:
            break
        up_to = Window.partitionBy("_g").orderBy("_hb").rowsBetween(Window.unboundedPreceding, 0)  # <= 65536 rows per group
        wanted = F.lit(0)
        for c in open_:
            wanted = F.when(F.col("_g").eqNullSafe(F.lit(c.group)), F.lit(c.need)).otherwise(wanted)
        need = (wanted - F.col("_cum") + F.col("_n")).alias("_need")
        found = (counts(df.filter(_inside(open_, group, h)), at).withColumn("_cum", F.sum("_n").over(up_to))
                 .select("_g", "_hb", "_n", need).filter((F.col("_need") > 0) & (F.col("_need") <= F.col("_n"))).collect())  # one row per group
        before = {c.group: c.prefix for c in open_}
        open_ = [Cut(r["_g"], before[r["_g"]] + r["_hb"], r["_need"], r["_n"]) for r in found]
    return done + open_


def flag_first(df: DataFrame, group: Column, h: Column, tiebreak: list[str], cuts: list[Cut], out: str, among: Column | None = None) -> DataFrame:
    """Flag the rows up to their group's cut in (h, tiebreak) order; rows outside ``among`` (if given) get false.

    One comparison per row.  Rows of one hash that a cut divides are ranked by all
    their columns, so membership stays deterministic where keys repeat."""
    among = F.lit(True) if among is None else among
    end = F.lit(None).cast("string")
    for c in cuts:  # "g" follows every hexadecimal digit
        end = F.when(group.eqNullSafe(F.lit(c.group)), F.lit(c.prefix + ("g" if c.need == c.n else ""))).otherwise(end)
    first = F.coalesce(among & (h < end), F.lit(False))
    divided = [c for c in cuts if c.need < c.n]
    if not divided:
        return df.withColumn(out, first)
    atomic = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
    rest = [f.name for f in df.schema.fields if f.name not in tiebreak and f.name != "_h" and isinstance(f.dataType, atomic)]
    need = F.lit(0)
    for c in divided:
        need = F.when(group.eqNullSafe(F.lit(c.group)), F.lit(c.need)).otherwise(need)
    at = F.coalesce(among & _inside(divided, group, h), F.lit(False))
    within = Window.partitionBy(group).orderBy(*[F.col(f"`{c}`") for c in [*tiebreak, *rest]])
    return df.filter(~at).withColumn(out, first).unionByName(df.filter(at).withColumn(out, F.row_number().over(within) <= need))


def stratified_split(df: DataFrame, target: str, key_cols: list[str], config: SplitConfig = SplitConfig()) -> DataFrame:
    """M6: adds ``split`` in {train, val, test}; sizes are exact.

    test = ceil(test_size * n) stratified on target quantile bins; val =
    ceil(val_size / (1 - test_size) * rest) stratified on bins recomputed on
    the rest; train = the remainder.  Rows with a null target are a bin of their own.

    The table is not copied: each quota is one table of counts per (bin, hash
    prefix), and the result is one projection of the source.
    """
    from tidewatch.operators.prefix import EXACT_MAP_LIMIT

    y = F.col(f"`{target}`").cast("double")
    n_values = df.agg(F.count(F.when(~F.isnan(y), y))).first()[0] or 0  # bounds the distinct count, of a part of the table too
    small = n_values <= EXACT_MAP_LIMIT
    rows, h = df.withColumn("_h", order_hash(config.seed, key_cols)), F.col("_h")
    bins = bin_expr(y, quantile_edges(df, target, config.n_bins, known_small=small))
    tested = flag_first(rows, bins, h, key_cols, quota_cuts(rows, bins, h, config.test_size), "_is_test")
    rest = tested.filter("NOT _is_test")
    bins = bin_expr(y, quantile_edges(rest, target, config.n_bins, known_small=small))
    cuts = quota_cuts(rest, bins, h, config.val_size / (1 - config.test_size))
    both = flag_first(tested, bins, h, key_cols, cuts, "_is_val", ~F.col("_is_test"))
    split = F.when(F.col("_is_test"), "test").when(F.col("_is_val"), "val").otherwise("train")
    return both.select(*[F.col(f"`{c}`") for c in df.columns], split.alias("split"))


def stratified_folds(df: DataFrame, target: str, key_cols: list[str], folds: int = 5, config: SplitConfig = SplitConfig(),
                     out: str = "fold") -> DataFrame:
    """Adds ``out``, 0 to ``folds`` - 1: in every target bin, in md5(seed | key) order, fold f gets the
    rows from floor(n f / folds) to floor(n (f + 1) / folds), so a bin's folds differ by one row at most.

    One table of counts per (bin, hash prefix) gives all borders; only the rows of the prefixes that a
    border cuts are ranked.  Equal keys share a hash and are told apart by their other columns."""
    y = F.col(f"`{target}`").cast("double")
    bins = bin_expr(y, quantile_edges(df, target, config.n_bins))
    rows = df.select("*", bins.alias("_bin"), order_hash(config.seed, key_cols).alias("_h")).withColumn("_hb", F.substring("_h", 1, 4))
    counts = rows.groupBy("_bin", "_hb").agg(F.count("*").alias("_n"))
    up_to = Window.partitionBy("_bin").orderBy("_hb").rowsBetween(Window.unboundedPreceding, 0)  # <= 65536 rows per bin
    size = F.sum("_n").over(Window.partitionBy("_bin"))
    quota = F.explode(F.transform(F.sequence(F.lit(1), F.lit(folds - 1)), lambda f: (F.col("_size") * f / folds).cast("long")))
    cut = (counts.select("_bin", "_hb", "_n", F.sum("_n").over(up_to).alias("_cum"), size.alias("_size")).select("*", quota.alias("_q"))
           .filter((F.col("_cum") - F.col("_n") <= F.col("_q")) & (F.col("_q") < F.col("_cum")))
           .select("_bin", "_hb", (F.col("_q") - (F.col("_cum") - F.col("_n"))).alias("_need")).collect()) if folds > 1 else []  # folds - 1 rows per bin
    def here(r, hb: Column) -> Column:
        return F.col("_bin").eqNullSafe(F.lit(r["_bin"]).cast("int")) & hb

    at = F.lit(False)
    fold = F.lit(0)
    for r in cut:  # a border is passed by later prefixes, and inside its own prefix from rank need + 1 on
        at = at | here(r, F.col("_hb") == r["_hb"])
        passed = here(r, (F.col("_hb") > r["_hb"]) | ((F.col("_hb") == r["_hb"]) & (F.col("_rank") > r["_need"])))
        fold = fold + F.when(passed, 1).otherwise(0)
    atomic = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
    rest = [f.name for f in df.schema.fields if f.name not in key_cols and isinstance(f.dataType, atomic)]
    within = Window.partitionBy("_bin", "_hb").orderBy("_h", *[F.col(f"`{c}`") for c in [*key_cols, *rest]])
    ranked = rows.filter(~at).withColumn("_rank", F.lit(0)).unionByName(rows.filter(at).withColumn("_rank", F.row_number().over(within)))
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], fold.alias(out))


def random_split(df: DataFrame, key_cols: list[str], test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """M7: exact ceil(test_size * n) test rows in md5(seed | key) order; adds ``split``."""
    rows, h = df.withColumn("_h", order_hash(seed, key_cols)), F.col("_h")
    t = flag_first(rows, F.lit(0), h, key_cols, quota_cuts(rows, F.lit(0), h, test_size), "_is_test")
    return t.select(*[F.col(f"`{c}`") for c in df.columns], F.when(F.col("_is_test"), "test").otherwise("train").alias("split"))
