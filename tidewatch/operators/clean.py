"""Cleaning, request validation and defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalar import yes_to_int
from tidewatch.schema import BINARY, FORM_DEFAULTS, RANGES, STUDENT_COLUMNS, TARGET


def clean_binary(df: DataFrame, columns=BINARY) -> DataFrame:
    """yes/no string columns -> 1/0 in one projection.

    Columns that are already numeric/boolean pass through unchanged, so
    cleaning twice gives the same table (the reference zeroes them).
    """
    wanted = set(columns)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in wanted and isinstance(f.dataType, T.StringType):
            out.append(yes_to_int(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def split_target(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, str | None]:
    """Features without the target, and the target name if present."""
    if target in df.columns:
        return df.drop(target), target
    return df, None


def fill_defaults(df: DataFrame, defaults: dict = FORM_DEFAULTS) -> DataFrame:
    """Fill NULLs of present columns and add absent ones with fixed defaults."""
    present = {k: v for k, v in defaults.items() if k in df.columns}
    out = df.fillna(present) if present else df
    missing = {k: F.lit(v) for k, v in defaults.items() if k not in df.columns}
    return out.withColumns(missing) if missing else out


def validate_rows(
    df: DataFrame,
    required=tuple(c for c in STUDENT_COLUMNS if c != TARGET),
    ranges: dict = RANGES,
) -> DataFrame:
    """Add ``violations`` (array of rule names) and ``is_valid``.

    A field is violated when absent, NULL, or outside its closed range.
    """
    checks = []
    for c in required:
        if c not in df.columns:
            checks.append(F.lit(f"{c}:missing"))
            continue
        col = F.col(f"`{c}`")
        checks.append(F.when(col.isNull(), F.lit(f"{c}:missing")))
        if c in ranges:
            lo, hi = ranges[c]
            checks.append(F.when((col < lo) | (col > hi), F.lit(f"{c}:out_of_range")))
    for c, (lo, hi) in ranges.items():
        if c not in required and c in df.columns:
            col = F.col(f"`{c}`")
            checks.append(F.when((col < lo) | (col > hi), F.lit(f"{c}:out_of_range")))
    v = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")
    return df.withColumn("violations", v).withColumn("is_valid", F.size("violations") == 0)


def split_valid(df: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """Valid rows and the quarantine (with their violations)."""
    checked = validate_rows(df, **kw)
    return (
        checked.filter("is_valid").drop("violations", "is_valid"),
        checked.filter(~F.col("is_valid")).drop("is_valid"),
    )


# Quality-gate thresholds (good, acceptable) of the reference.
GATES = {
    "mae": (2.0, 3.0),        # lower is better
    "r2": (0.80, 0.70),       # higher is better
    "within_1": (70.0, 60.0),  # percent, higher is better
    "test_r2": (0.85, 0.75),
}
GATE_LABELS = ("EXCELLENT", "GOOD", "FAIR")


def quality_gates(metrics: DataFrame) -> DataFrame:
    """Label each metric of a metrics row against its two thresholds."""
    out = []
    for name, (good, ok) in GATES.items():
        if name not in metrics.columns:
            continue
        x = F.col(name)
        if name == "mae":
            lab = F.when(x < good, GATE_LABELS[0]).when(x < ok, GATE_LABELS[1]).otherwise(GATE_LABELS[2])
        else:
            lab = F.when(x > good, GATE_LABELS[0]).when(x > ok, GATE_LABELS[1]).otherwise(GATE_LABELS[2])
        out.append(lab.alias(f"{name}_gate"))
    return metrics.select("*", *out)


def remove_zero_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows without a zero in any of ``columns``; NULL and NaN are no zero."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & (F.col(f"`{c}`").isNull() | (F.col(f"`{c}`") != 0))
    return df.filter(keep)
