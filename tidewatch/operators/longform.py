"""Long form of two tables: per column kind (numeric, other) one scan, one Generate, one map-side-combined shuffle.

Every shared column becomes rows ``(fid, num, cat)``; numeric features fill
``num`` (double), everything else fills ``cat`` (string).  Counting by
``(fid, num, cat)`` with the side as two conditional counts collapses ties
and hot values before the shuffle, so a value holding a third of all rows
costs one row per map task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERICAL = "numerical"
CATEGORICAL = "categorical"


@dataclass(frozen=True)
class Feature:
    fid: int
    name: str
    kind: str  # NUMERICAL | CATEGORICAL


def is_numeric_type(dt: T.DataType) -> bool:
    # bool counts as numeric, like the reference's dtype test; timestamps do not.
    return isinstance(dt, (T.NumericType, T.BooleanType))


def common_features(ref: DataFrame, cur: DataFrame, exclude=(), columns=None) -> list[Feature]:
    """Shared columns in reference order, typed by the reference side."""
    cur_cols = set(cur.columns)
    wanted = columns if columns is not None else ref.columns
    names = [c for c in wanted if c in cur_cols and c not in set(exclude)]
    if not names:
        raise ValueError("No common columns found between reference and current tables.")
    types = dict((f.name, f.dataType) for f in ref.schema.fields)
    return [Feature(i, n, NUMERICAL if is_numeric_type(types[n]) else CATEGORICAL) for i, n in enumerate(names)]


def feature_frame(spark: SparkSession, features: list[Feature]) -> DataFrame:
    """Small driver-built metadata table: one row per feature (bounded by schema width)."""
    return spark.createDataFrame(
        [(f.fid, f.name, f.kind) for f in features], "fid int, feature string, type string"
    )


def as_double(df: DataFrame, name: str) -> Column:
    dt = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if is_numeric_type(dt):
        return c.cast("double")
    return F.expr(f"try_cast(`{name}` AS DOUBLE)")


def _side_rows(df: DataFrame, side, features: list[Feature], kind: str) -> DataFrame:
    """Rows ``(side, fid, v)`` of the features of one kind (``v`` double or string)."""
    args: list[Column] = []
    for f in features:
        if f.kind != kind:
            continue
        v = as_double(df, f.name) if kind == NUMERICAL else F.col(f"`{f.name}`").cast("string")
        args += [F.lit(f.fid), v]
    side_col = side if isinstance(side, Column) else F.lit(side)
    rows = df.select(side_col.alias("side"), F.stack(F.lit(len(args) // 2), *args).alias("fid", "v"))
    ok = F.col("v").isNotNull() & (~F.isnan("v") if kind == NUMERICAL else F.lit(True))
    return rows.filter(F.col("side").isNotNull() & ok)


def _counts_by_kind(side_rows, features: list[Feature], aggs) -> DataFrame:
    """Numeric and categorical features are counted in separate aggregates:
    a (int, double) key keeps Spark's fast primitive-key hash map, and column
    pruning makes each branch read only its own columns."""
    parts = []
    for kind in (NUMERICAL, CATEGORICAL):
        if not any(f.kind == kind for f in features):
            continue
        g = side_rows(kind).groupBy("fid", "v").agg(*aggs)
        if kind == NUMERICAL:
            g = g.select("fid", F.col("v").alias("num"), F.lit(None).cast("string").alias("cat"), *[a for a in g.columns[2:]])
        else:
            g = g.select("fid", F.lit(None).cast("double").alias("num"), F.col("v").alias("cat"), *[a for a in g.columns[2:]])
        parts.append(g)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _rc():
    return [F.count_if(F.col("side") == 0).alias("r"), F.count_if(F.col("side") == 1).alias("c")]


def long_counts(ref: DataFrame, cur: DataFrame, features: list[Feature]) -> DataFrame:
    """``(fid, num, cat, r, c)``: per-feature distinct values with counts per side."""
    return _counts_by_kind(
        lambda kind: _side_rows(ref, 0, features, kind).unionByName(_side_rows(cur, 1, features, kind)), features, _rc()
    )


def long_counts_split(df: DataFrame, current: Column, features: list[Feature]) -> DataFrame:
    """Like :func:`long_counts` when both sides live in one table: the side is
    a per-row expression (``current`` true -> current, false -> reference,
    NULL -> neither), so the table is scanned once instead of twice."""
    side = F.when(current, F.lit(1)).when(~current, F.lit(0))
    return _counts_by_kind(lambda kind: _side_rows(df, side, features, kind), features, _rc())


def single_counts(df: DataFrame, features: list[Feature]) -> DataFrame:
    """``(fid, num, cat, n)`` for one table (profiles, stored reference profiles)."""
    return _counts_by_kind(lambda kind: _side_rows(df, 0, features, kind), features, [F.count("*").alias("n")])
