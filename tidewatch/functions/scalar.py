"""Row-level expressions (all JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error-band labels and their upper bounds (absolute error).
ERROR_BANDS = [(1.0, "Excellent"), (2.0, "Good"), (3.0, "Fair")]
ERROR_BAND_ELSE = "Poor"
SHORT_ERROR_BANDS = [(1.0, "Excellent"), (2.0, "Good")]
SHORT_ERROR_BAND_ELSE = "Fair"


def yes_to_int(c: Column) -> Column:
    """lower(str(v)) == 'yes' -> 1 else 0; NULL -> 0; no trimming."""
    return F.when(F.lower(c.cast("string")) == "yes", F.lit(1)).otherwise(F.lit(0))


def quoted_number(c: Column) -> Column:
    """Strip surrounding double quotes and parse; malformed -> NULL (ANSI-safe)."""
    stripped = F.regexp_replace(c.cast("string"), r'^"+|"+$', "")
    return stripped.try_cast("double")


def half_even_int(c: Column) -> Column:
    """Round half to even, as an integer."""
    return F.bround(c, 0).cast("int")


def error_band(abs_err: Column, short: bool = False) -> Column:
    """<=1 Excellent, <=2 Good, <=3 Fair, else Poor; ``short``: everything above 2 is Fair."""
    e = None
    for bound, label in SHORT_ERROR_BANDS if short else ERROR_BANDS:
        e = (F.when(abs_err <= bound, F.lit(label)) if e is None else e.when(abs_err <= bound, F.lit(label)))
    return e.otherwise(F.lit(SHORT_ERROR_BAND_ELSE if short else ERROR_BAND_ELSE))


def version_label(v: Column) -> Column:
    """``v{n}`` display label."""
    return F.concat(F.lit("v"), v.cast("string"))


def version_from_name(name: Column) -> Column:
    """``model_v12.pkl`` -> 12; anything else -> NULL."""
    return F.regexp_extract(name, r"_v(\d+)", 1).try_cast("int")
